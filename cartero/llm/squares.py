"""Runs of words: online dyadic square catching.

A run is a stretch of consecutive words with smallest period q (words q apart are the
same) that no neighbouring word extends; it counts with at least ``max(LEAST, 2 q)`` words.

``Catchers`` takes words as they come.  On level h (1, 2, 4, ...) every completed block of h
words at a multiple of h opens a catcher for the periods 2h to 4h - 1: a square of such a
period holds a whole block in its first half, and the block comes again one period later.
So each appended word ends one suffix of h words per level, and that suffix is compared with
the two blocks whose catchers wait for it.  A catch is compared word by word to both
sides; squares of one period that touch are one stretch, which later words lengthen.  A
catch inside a known run whose period divides its own adds nothing and is passed over, so a
text of one word repeated costs no more than any other.  The work is a few array
steps per level, O(n log n) comparisons in all.

Texts of a batch follow each other with a word of their own between them, which equals no
other, so no run crosses texts and short texts share the array steps.

Null and empty texts have no words and no runs.  Rows that repeat an id are each judged by
themselves; a null id is carried.  Extra columns are ignored unless carried; an empty table
gives an empty result.  A text is held whole in one task: about 100 bytes of memory a word.
Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartero.llm.common import U64, bytes_of, mix, ragged, runs, slices, span_hashes

LEAST = 12  # words of the shortest run that counts
DIRECT = 8  # periods below are compared at every place: their catchers' blocks have one or two words
_SPACE = np.zeros(256, bool)
_SPACE[32] = _SPACE[9:14] = True


class Catchers:
    """Runs of a sequence of 64-bit words that is appended to, piece by piece."""

    def __init__(self, least: int = LEAST):
        self.least, self.n = least, 0
        self.words = np.zeros(0, np.uint64)
        self.levels = [self.words]  # hashes of 1, 2, 4, ... words at every place
        self.found: dict[int, list[list[int]]] = {}  # period -> stretches [start, end), in order; short ones too while they may grow

    def append(self, words: np.ndarray) -> None:
        old, self.n = self.n, self.n + len(words)
        self.levels[0] = self.words = np.concatenate([self.words, words])
        for period, stretches in self.found.items():
            if stretches[-1][1] == old:
                stretches[-1][1] = self._forward(old, period)
        for period in range(1, min(DIRECT, self.n)):
            self._direct(period, old)
        h, level = 1, 0
        while 3 * h <= self.n:
            if 2 * h >= DIRECT:
                self._catch(h, self.levels[level], old)
            h, level = 2 * h, level + 1
            self._suffixes(h, level)

    def _suffixes(self, h: int, level: int) -> None:
        """Hashes of ``h`` words from those of half as many; what was known is kept."""
        if level == len(self.levels):
            self.levels.append(self.words[:0])
        half, known = self.levels[level - 1], self.levels[level]
        at, n = len(known), max(self.n - h + 1, 0)
        if n > at:
            new = mix(half[at:n] * U64(0xD6E8FEB86659FD93) + half[at + h // 2:n + h // 2] + U64(h))
            self.levels[level] = np.concatenate([known, new])

    # ------------------------------------------------------------ comparisons
    def _forward(self, i: int, period: int) -> int:
        """The first place from ``i`` on whose word differs from the one a period before."""
        step = 64
        while i < self.n:
            z = min(i + step, self.n)
            differ = self.words[i:z] != self.words[i - period:z - period]
            at = int(differ.argmax())
            if differ[at]:
                return i + at
            i, step = z, step * 4
        return self.n

    def _backward(self, i: int, period: int) -> int:
        """The smallest start such that words from it up to ``i`` equal those a period later."""
        step = 64
        while i > 0:
            a = max(i - step, 0)
            differ = (self.words[a:i] != self.words[a + period:i + period])[::-1]
            at = int(differ.argmax())
            if differ[at]:
                return i - at
            i, step = a, step * 4
        return 0

    def _add(self, start: int, end: int, period: int) -> None:
        own = self.found.setdefault(period, [])
        for other in reversed(own):
            if other[0] == start:
                other[1] = max(other[1], end)
                return
            if other[0] < start:
                break
        own.append([start, end])
        if len(own) > 1 and own[-2][0] > start:
            own.sort()

    def _direct(self, period: int, old: int) -> None:
        """Stretches of a short period that reach into the new words."""
        least = max(period, self.least - period)
        first = max(old - least, period)
        same = self.words[first:] == self.words[first - period:self.n - period]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
        a, z = edge[::2] + first, edge[1::2] + first
        long = (z - a >= least) | (a == first)
        for start, end in zip(a[long].tolist(), z[long].tolist()):
            start = self._backward(start - period, period)
            if end - start >= max(self.least, 2 * period):
                self._add(start, end, period)

    def _catch(self, h: int, suffixes: np.ndarray, old: int) -> None:
        """Compare every new suffix of ``h`` words with the two blocks that wait for it."""
        first = max(old - h + 1, 2 * h)
        if first >= len(suffixes):
            return
        begin = first - first % h  # whole rows of h places: one block waits for all places of a row
        rows = -(-(len(suffixes) - begin) // h)
        at, block = [], []
        for back in (2, 3):
            lead = begin - back * h
            waiting = suffixes[max(lead, 0):lead + rows * h:h]
            skip = max(-lead, 0) // h
            places = suffixes[begin + skip * h:]
            waiting = waiting[:-(-len(places) // h)]
            hit = np.flatnonzero(places == np.repeat(waiting, h)[:len(places)])
            at.append(hit + begin + skip * h)
            block.append((hit // h + skip - back) * h + begin)
        at, block = np.concatenate(at), np.concatenate(block)
        new = at >= first
        at, block = at[new], block[new]
        period = at - block
        fresh = self._fresh(block, at + h, period)
        order = np.lexsort((block[fresh], period[fresh]))
        block, period = block[fresh][order], period[fresh][order]
        edges = np.flatnonzero(np.diff(period)) + 1
        for a, z in zip(np.r_[0, edges].tolist(), np.r_[edges, len(period)].tolist()):
            blocks = block[a:z]
            while len(blocks):
                b, p = int(blocks[0]), int(period[a])
                end = self._forward(b + p, p)
                if end - b - p < h:  # equal hashes of unequal words
                    blocks = blocks[1:]
                    continue
                start = self._backward(b, p)
                if end - start >= max(self.least, 2 * p) or end == self.n:
                    self._add(start, end, p)
                blocks = blocks[np.searchsorted(blocks + p + h, end, "right"):]

    def _fresh(self, block: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
        """False for catches that lie in a known run whose period divides theirs."""
        known = np.array([(s, e, q) for q, own in self.found.items() for s, e in own if e - s >= 2 * q], np.int64).reshape(-1, 3)
        if not len(known) or not len(block):
            return np.ones(len(block), bool)
        known = known[np.lexsort((known[:, 2], known[:, 0]))]
        reach = np.maximum.accumulate(known[:, 1])
        last = np.maximum.accumulate(np.where(np.diff(reach, prepend=-1) > 0, np.arange(len(known)), 0))
        i = np.searchsorted(known[:, 0], block, "right") - 1
        run = known[last[np.maximum(i, 0)]]
        return ~((i >= 0) & (run[:, 1] >= end) & (period % run[:, 2] == 0))

    def runs(self) -> np.ndarray:
        """(start, length, period) of all runs so far, by start, then period."""
        least: dict[tuple[int, int], int] = {}
        for q in sorted(self.found):
            for s, e in self.found[q]:
                if e - s >= max(self.least, 2 * q):
                    least.setdefault((s, e), q)  # a multiple of the smallest period has the same ends
        out = np.array([(s, e - s, q) for (s, e), q in least.items()], np.int64).reshape(-1, 3)
        return out[np.lexsort((out[:, 2], out[:, 0]))]


def words_of(column: pa.Array):
    """(bytes, word starts, word ends, first word of each text): words are maximal runs of no white space."""
    buf, offs = bytes_of(column)
    starts, ends = runs(~_SPACE[buf], offs)
    return buf, starts, ends, np.searchsorted(starts, offs)


def periodic(firsts: np.ndarray, counts: np.ndarray, anchor: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Word numbers after the words of each text from ``anchor`` on were made periodic (period 0: left as they are)."""
    at = ragged(np.zeros(len(counts), np.int64), counts)
    a, p = np.repeat(anchor, counts), np.repeat(period, counts)
    turned = a + (at - a) % np.maximum(p, 1)
    return np.repeat(firsts, counts) + np.where((p > 0) & (at >= a), turned, at)


def batch_runs(hashes: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> list[np.ndarray]:
    """(start, length, period) of the runs of every text; text i has the words bounds[i] to bounds[i + 1]."""
    counts = np.diff(bounds)
    spaced = np.zeros(len(hashes) + len(counts), np.uint64)
    place = bounds[:-1] + np.arange(len(counts))
    own = np.ones(len(spaced), bool)
    ends = place + counts
    own[ends] = False
    spaced[own] = hashes
    spaced[ends] = mix(np.arange(len(counts), dtype=np.uint64) + U64(0x5EED5EED5EED5EED))
    catchers = Catchers(least)
    catchers.append(spaced)
    found = catchers.runs()
    text = np.searchsorted(place, found[:, 0], "right") - 1
    found[:, 0] -= place[text]
    cuts = np.searchsorted(text, np.arange(len(counts) + 1))
    return [found[a:z] for a, z in zip(cuts[:-1], cuts[1:])]


def kept_words(n: int, found: np.ndarray) -> np.ndarray:
    """False for words that a run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def _join(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words, joined by one space."""
    lengths = ends - starts + 1
    if not len(starts):
        return b""
    out = np.append(buf, np.uint8(32))[np.minimum(ragged(starts, lengths), len(buf))]
    out[np.cumsum(lengths) - 1] = 32
    return out[:-1].tobytes()


def _find(least, plant, carry, batches):
    for b in slices(batches):
        buf, starts, ends, bounds = words_of(b.column("text"))
        counts = np.diff(bounds)
        if plant:
            anchor, period = (np.asarray(b.column(c).fill_null(0), np.int64) for c in ("anchor", "turns"))
            order = periodic(bounds[:-1], counts, anchor % np.maximum(counts, 1), _turned(counts, anchor, period))
            starts, ends = starts[order], ends[order]
        rows = []
        for a, z, found in zip(bounds[:-1], bounds[1:], batch_runs(span_hashes(buf, starts, ends), bounds, least)):
            keep = kept_words(z - a, found)
            rows.append(([dict(zip(("start", "length", "period"), r)) for r in found.tolist()],
                         _join(buf, starts[a:z][keep], ends[a:z][keep]).decode()))
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in carry), pa.array(counts), pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())],
            [*carry, "n_words", "runs", "collapsed"])


def _turned(counts: np.ndarray, anchor: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """Period of the planted stretch: 0 where none is asked for."""
    a = anchor % np.maximum(counts, 1)
    return np.where((turns > 0) & (counts > 0), 1 + (counts - a) // np.maximum(turns, 1), 0)


def find_runs(docs: DataFrame, least: int = LEAST, carry: tuple[str, ...] = ("doc_id",), plant: tuple | None = None) -> DataFrame:
    """(carried columns, n_words, runs array<struct<start, length, period>>, collapsed) of every text.

    ``collapsed`` has the words that no run holds after its first period, joined by spaces.  ``plant``
    gives two columns (anchor, turns) that make texts periodic before they are judged: each
    word i >= a becomes word a + (i - a) % p, with a = anchor % n and p = 1 + floor((n - a) / turns);
    turns of 0 or null leave a text as it is.
    """
    columns = [F.col(c) for c in dict.fromkeys([*carry, "text"])]
    if plant:
        columns += [plant[0].cast("long").alias("anchor"), plant[1].cast("long").alias("turns")]
    source = docs.select(*columns)
    kept = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carry)
    return source.mapInArrow(partial(_find, least, bool(plant), carry),
                             kept + "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def longest(runs):
    """The run of greatest length; ties: smallest start, then period (null if there is none)."""
    key = F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(key.isNotNull(), F.struct((-key["start"]).alias("start"), key["length"].alias("length"), (-key["period"]).alias("period")))
