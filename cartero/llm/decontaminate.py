"""Benchmark decontamination: a broadcast hash set of test n-grams against whole training texts.

Words are maximal runs of ASCII digits, letters (A-Z lower-cased) and non-ASCII
bytes.  A window is ``n`` consecutive item words; an item of fewer words, but not
none, is one window.  Token windows of the texts are looked up in the hash set and
every hit is verified word by word.

The hash set is built once and broadcast, in chunks of about CHUNK_WORDS words (some
30 bytes each), so a benchmark of any size is scanned in as many passes as it takes;
the number of words is counted first.

Null and empty texts have no words and are clean; null and empty items have no
windows; repeated items each count; repeated document rows are scanned each by
themselves.  Empty tables give empty results, or documents without hits.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartero.llm.common import LOWER, U64, bytes_of, narrow, ragged, runs, slices, span_hashes, window_hashes

WINDOW = 13
CHUNK_WORDS = 2_000_000
FILTER_BITS = 22
HITS = "n_words long, n_hit long, hits binary, items array<string>"

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def words_of(column: pa.Array):
    """(lower-cased bytes, text offsets, word starts, word ends, first word of each text)."""
    buf, offs = bytes_of(column)
    buf = LOWER[buf]
    starts, ends = runs(_WORD[buf], offs)
    return buf, offs, starts, ends, np.searchsorted(starts, offs)


class WindowSet:
    """Windows of benchmark items as sorted hashes, with the place of their words in one buffer.

    Arrays of about 24 bytes a window beside the words, built once and broadcast.
    """

    def __init__(self, items: list[tuple[str, str]], n: int):
        self.items = [ident for ident, _ in items]
        buf, _, starts, ends, bounds = words_of(pa.array([text for _, text in items], pa.string()))
        hashes, sizes = span_hashes(buf, starts, ends), np.diff(bounds)
        # The words of all items, each followed by one space.
        places = ragged(starts, ends - starts + 1)
        after = np.cumsum(ends - starts + 1)
        spaced = np.append(buf, np.uint8(32))[np.minimum(places, len(buf))]
        spaced[after - 1] = 32
        self.words, first = spaced.tobytes(), after - (ends - starts + 1)
        self.keys, self.low, self.high, self.owner = {}, {}, {}, {}
        for k in np.unique(np.minimum(sizes[sizes > 0], n)).tolist():
            own = np.flatnonzero((sizes >= n) if k == n else (sizes == k))
            at = ragged(bounds[own], sizes[own] - k + 1)
            h = window_hashes(hashes, k)[at]
            by = np.argsort(h, kind="stable")
            self.keys[k], self.low[k], self.high[k] = h[by], first[at][by], after[at + k - 1][by] - 1
            self.owner[k] = np.repeat(own, sizes[own] - k + 1).astype(np.int32)[by]

    def filters(self) -> dict[int, np.ndarray]:
        """Per window length, which leading bits of a hash occur."""
        out = {}
        for k, keys in self.keys.items():
            out[k] = np.zeros(1 << FILTER_BITS, bool)
            out[k][(keys >> U64(64 - FILTER_BITS)).astype(np.int64)] = True
        return out

    def find(self, filters, buf, starts, ends, bounds):
        """Verified hits (first word, number of words, item ids) in the words of a batch."""
        hashes = span_hashes(buf, starts, ends)
        for k, keys in self.keys.items():
            h = window_hashes(hashes, k)
            at = np.flatnonzero(filters[k][(h >> U64(64 - FILTER_BITS)).astype(np.int64)])
            text = np.searchsorted(bounds, at, "right")
            at = at[at + k <= bounds[np.minimum(text, len(bounds) - 1)]]  # windows do not cross texts
            low, high = np.searchsorted(keys, h[at]), np.searchsorted(keys, h[at], "right")
            for i, a, z in zip(*(x[low < high].tolist() for x in (at, low, high))):
                own = b" ".join([buf[s:e].tobytes() for s, e in zip(starts[i:i + k], ends[i:i + k])])
                ids = [self.items[o] for o, s, e in zip(self.owner[k][a:z].tolist(), self.low[k][a:z].tolist(), self.high[k][a:z].tolist())
                       if self.words[s:e] == own]
                if ids:
                    yield i, k, ids


def _scan(windows, carry, batches):
    found = windows.value
    filters = found.filters()
    for b in slices(batches):
        buf, offs, starts, ends, bounds = words_of(b.column("text"))
        marks = np.zeros(len(starts) + 1, np.int64)
        ids: list[set] = [set() for _ in range(b.num_rows)]
        for i, k, own in found.find(filters, buf, starts, ends, bounds[1:]):
            marks[i] += 1
            marks[i + k] -= 1
            ids[int(np.searchsorted(bounds, i, "right")) - 1].update(own)
        hit = np.cumsum(marks[:-1]) > 0
        covered = np.concatenate([[0], np.cumsum(hit)])
        bits = [np.packbits(hit[s:e]).tobytes() if g else b"" for s, e, g in zip(bounds[:-1], bounds[1:], ids)]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in carry), pa.array(np.diff(bounds)), pa.array(covered[bounds[1:]] - covered[bounds[:-1]]),
             pa.array(bits, pa.binary()), pa.array([sorted(g) for g in ids], pa.list_(pa.string()))],
            [*carry, "n_words", "n_hit", "hits", "items"])


def _merge(batches):
    """Join the hits of several passes, which follow each other in the array columns."""
    for b in batches:
        out = b.to_pydict()
        merged = []
        for n, hits in zip(out["n_words"], out["hits"]):
            bits = np.zeros((n + 7) // 8, np.uint8)
            for h in hits:
                if h:
                    bits |= np.frombuffer(h, np.uint8)
            merged.append(bits.tobytes() if any(hits) else b"")
        rest = [b.column(c) for c in b.schema.names if c != "hits"]
        count = [int(np.unpackbits(np.frombuffer(m, np.uint8)).sum()) for m in merged]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(count, pa.int64()), pa.array(merged, pa.binary())],
                                         [*[c for c in b.schema.names if c != "hits"], "n_hit", "hits"])


def scan(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, chunk_words: int = CHUNK_WORDS,
         carry: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """(carried columns, n_words, n_hit, hits as packed bits per word, items array<string>) of every document."""
    source = narrow(docs, *dict.fromkeys(["doc_id", "text", *carry]))
    kept = "".join(f"`{c}` {source.schema[c].dataType.simpleString()}, " for c in carry)
    items = narrow(benchmark, "item_id", "text").filter("text is not null").select(
        F.col("item_id").cast("string").alias("item_id"), "text")
    total = items.agg(F.sum(F.size(F.split("text", "[^0-9A-Za-z\\x{80}-\\x{10FFFF}]+")).cast("long"))).first()[0] or 0
    chunks = max(1, -(-int(total) // chunk_words))

    def broadcast(rows):
        return docs.sparkSession.sparkContext.broadcast(WindowSet(rows, n))

    if chunks == 1:
        rows = [(r["item_id"], r["text"]) for r in items.collect()]  # at most chunk_words words
        return source.mapInArrow(partial(_scan, broadcast(rows), carry), kept + HITS)
    # Several passes: rows of one text meet again by a key; equal rows have equal hits.
    ident = source.schema["doc_id"].dataType.simpleString()
    keyed, out = source.withColumn("row", F.xxhash64("doc_id", "text")), None
    for i in range(chunks):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)) == i)
        rows = [(r["item_id"], r["text"]) for r in mine.collect()]  # about chunk_words words
        part = keyed.mapInArrow(partial(_scan, broadcast(rows), ("doc_id", "row")), f"doc_id {ident}, row long, {HITS}")
        out = part if out is None else out.unionByName(part)
    one = out.groupBy("doc_id", "row", "n_words").agg(
        F.collect_set("hits").alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    merged = one.select(F.col("doc_id").alias("_doc"), "row", "n_words", "items", "hits").mapInArrow(
        _merge, f"_doc {ident}, row long, n_words long, items array<string>, n_hit long, hits binary")
    same = keyed.doc_id.eqNullSafe(merged["_doc"]) & (keyed.row == merged.row)
    return keyed.join(merged, same).select(*carry, "n_words", "n_hit", "hits", "items")


def report(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(carried columns, n_words, n_hit, items, contaminated): contaminated from 1 word in 20."""
    found = scan(docs, benchmark, n, carry=carry)
    return found.select(*carry, "n_words", "n_hit", "items").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def _strip(batches):
    for b in batches:
        texts = []
        for text, hits in zip(b.column("text").to_pylist(), b.column("hits").to_pylist()):
            if hits:
                buf, _, s, e, _ = words_of(pa.array([text], pa.string()))
                hit = np.unpackbits(np.frombuffer(hits, np.uint8))[:len(s)].astype(bool)
                raw, parts, at = text.encode(), [], 0
                for a, z in zip(*runs(hit, np.array([0, len(hit)]))):
                    parts.append(raw[at:s[a]])
                    at = e[z - 1]
                text = b"".join([*parts, raw[at:]]).decode()
            texts.append(text)
        yield b.set_column(b.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(doc_id, text, n_words, n_hit, hits, items) with every covered run of words cut out of the text."""
    found = scan(docs, benchmark, n)
    return found.mapInArrow(_strip, found.schema)


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))  # columns may clash with those of the report
    return report(rows, benchmark, n, ("_row",)).filter("not contaminated").select("_row.*")
