"""Packing of token sequences by minimum bin slack.

Every document is cut into whole windows and one remainder.  What has to be
packed is then a histogram of at most ``window - 1`` remainder lengths, whatever
the size of the corpus, so the plan is made on counts: the longest remainder is
fixed, a bitset subset-sum over the other lengths finds the multiset that fills
the window closest to capacity, its counts are backtracked, and the pattern is
used as often as the counts allow.  Slack that no multiset closes is filled by
cutting one more remainder.  What is left in the end, less than a window, goes
into windows of powers of two, so nothing is padded.

Nulls and empty texts are one end id.  Rows with the same id are separate
documents.  Extra columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartero.llm.bpe import encoder, with_end
from cartero.llm.common import binaries, bytes_of, narrow, ragged, slices, stage

WINDOW = 1024
ROWS = ("doc_id long, part int, n long, rest int, rank_in_part long, full_in_part long, crcs binary, ids binary")
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


# -------------------------------------------------------------------- the plan
def closest_fill(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """Multiset of at most counts[l] pieces of each length with the largest sum <= room."""
    mask, reach, seen = (1 << (room + 1)) - 1, 1, []
    for size in lengths:
        if size > room:
            continue
        seen.append((size, reach))
        left, step = min(counts[size], room // size), 1
        while left:
            use = min(step, left)
            reach |= (reach << (use * size)) & mask
            left, step = left - use, step * 2
        if reach >> room & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for size, before in reversed(seen):
        n = 0
        while not before >> at & 1:
            at, n = at - size, n + 1
        if n:
            used[size] = n
    return used


class Plan:
    """Which ranks of which remainder length go where; a few rows per pattern."""

    def __init__(self, histogram: dict[int, int], window: int):
        #: length -> runs of equal pieces (root length, first rank, number, offset in the remainder)
        self.pool = {r: [(r, 0, n, 0)] for r, n in histogram.items() if n}
        self.counts = {r: n for r, n in histogram.items() if n}
        self.rows: list[tuple[int, int, int, int, int, int, int]] = []
        self.sequences = 0
        left = sum(r * n for r, n in self.counts.items())
        while left:
            room = window if left >= window else 1 << (left.bit_length() - 1)
            left -= room * self._pattern(room)

    def _take(self, size: int, n: int) -> list[tuple[int, int, int, int]]:
        out, runs = [], self.pool[size]
        self.counts[size] -= n
        while n:
            root, first, number, at = runs.pop()
            use = min(n, number)
            out.append((root, first, use, at))
            if use < number:
                runs.append((root, first + use, number - use, at))
            n -= use
        if not self.counts[size]:
            del self.counts[size], self.pool[size]
        return out

    def _place(self, runs, length: int, offset: int) -> None:
        seq = self.sequences
        for root, first, n, at in runs:
            self.rows.append((root, first, n, at, length, seq, offset))
            seq += n

    def _pattern(self, room: int) -> int:
        """Fill windows of ``room`` by one pattern, as often as it can be had; their number."""
        lengths = sorted(self.counts, reverse=True)
        seed = next((x for x in lengths if x <= room), None)
        need = {} if seed is None else {seed: 1}
        if seed is not None and seed < room:
            rest = dict(self.counts)
            rest[seed] -= 1
            for size, n in closest_fill([x for x in lengths if rest[x]], rest, room - seed).items():
                need[size] = need.get(size, 0) + n
        slack = room - sum(s * n for s, n in need.items())
        times = min((self.counts[s] // n for s, n in need.items()), default=self.counts[lengths[0]])
        cut = None
        if slack:
            often = {s: self.counts[s] // (need.get(s, 0) + 1) for s in lengths if s > slack}
            cut = max(often, key=lambda s: (often[s], s))
            times = min(times, often[cut])
        offset = 0
        for size, n in need.items():
            for _ in range(n):
                self._place(self._take(size, times), size, offset)
                offset += size
        if cut:
            runs = self._take(cut, times)
            self._place(runs, slack, offset)
            self.pool.setdefault(cut - slack, []).extend((r, f, n, at + slack) for r, f, n, at in runs)
            self.counts[cut - slack] = self.counts.get(cut - slack, 0) + times
        self.sequences += times
        return times

    def lookup(self) -> dict[int, tuple[np.ndarray, list[np.ndarray]]]:
        """root -> (first ranks of stretches, rows (at, length, sequence - rank, offset) of each stretch)."""
        by: dict[int, list] = {}
        for row in self.rows:
            by.setdefault(row[0], []).append(row[1:])
        out = {}
        for root, rows in by.items():
            edges = np.unique([x for f, n, *_ in rows for x in (f, f + n)])
            cells: list[list] = [[] for _ in edges]
            for f, n, at, length, seq, offset in rows:
                for i in range(np.searchsorted(edges, f), np.searchsorted(edges, f + n)):
                    cells[i].append((at, length, seq - f, offset))
            out[root] = edges, [np.array(sorted(c), np.int64).reshape(-1, 4) for c in cells]
        return out


# -------------------------------------------------------------------- in tasks
def _cut(path, window, batches):
    from pyspark import TaskContext
    part, full_at, ranks = TaskContext.get().partitionId(), 0, np.zeros(window, np.int64)
    enc = encoder(path)
    for b in slices(batches):
        ids, n = with_end(*enc.encode(*bytes_of(b.column("text"))))
        ids, ends = ids.astype("<u4"), np.cumsum(n)
        full, rest = n // window, (n % window).astype(np.int64)
        cuts = ragged(np.zeros(len(n), np.int64), full) * window + np.repeat(ends - n, full)
        view = memoryview(ids.tobytes())
        crcs = np.array([zlib.crc32(view[4 * c:4 * (c + window)]) for c in cuts.tolist()], "<u4")
        # Rank of a row among the rows of the same remainder in this part.
        order = np.argsort(rest, kind="stable")
        same = rest[order]
        first = np.r_[True, same[1:] != same[:-1]]
        place = np.arange(len(n)) - np.maximum.accumulate(np.where(first, np.arange(len(n)), 0))
        rank = np.empty(len(n), np.int64)
        rank[order] = place + ranks[same]
        ranks += np.bincount(rest, minlength=window)
        tail = ids[ragged(ends - rest, rest)].astype(enc.dtype)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(np.full(len(n), part, np.int32)), pa.array(n), pa.array(rest.astype(np.int32)),
             pa.array(rank), pa.array(full_at + np.cumsum(full) - full), binaries(crcs, full), binaries(tail, rest)],
            [c.split()[0] for c in ROWS.split(", ")])
        full_at += int(full.sum())


def _assign(plan, window, sequences, dtype, batches):
    for b in batches:
        out: list[tuple] = []
        for r in b.to_pylist():
            doc, n, rest, crcs = r["doc_id"], r["n"], r["rest"], np.frombuffer(r["crcs"], "<u4")
            base = sequences + (r["part"] << 40) + r["full_in_part"]
            out.extend((doc, i * window, window, int(c), n, base + i, 0) for i, c in enumerate(crcs))
            if rest:
                edges, cells = plan[rest]
                ids = np.frombuffer(r["ids"], dtype).astype("<u4").tobytes()
                for at, length, shift, offset in cells[np.searchsorted(edges, r["rank"], "right") - 1].tolist():
                    out.append((doc, n - rest + at, length, zlib.crc32(ids[4 * at:4 * (at + length)]), n,
                                r["rank"] + shift, offset))
        names = [c.split()[0] for c in PIECES.split(", ")]
        cols = list(zip(*out)) if out else [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)


# --------------------------------------------------------------- the operator
def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Two passes: the first cuts, keeps remainders and numbers them within their
    part; the second gives every remainder its place in the plan.
    """
    rows = stage(narrow(docs, "doc_id", "text").mapInArrow(partial(_cut, tokenizer, window), ROWS), "remainders")
    counts = rows.filter("rest > 0").groupBy("part", "rest").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    histogram = {r["rest"]: r["n"] for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect()}  # < window rows
    plan = Plan(histogram, window)
    placed = rows.join(counts.select("part", "rest", "before"), ["part", "rest"], "left").select(
        "doc_id", "part", "n", "rest", "full_in_part", "crcs", "ids",
        (F.coalesce("before", F.lit(0)) + F.col("rank_in_part")).alias("rank"))
    task = partial(_assign, plan.lookup(), window, plan.sequences, encoder(tokenizer).dtype)
    return placed.mapInArrow(task, PIECES)
