"""Line dedup by winnowing: later copies of runs of lines are deleted.

A line is stripped of outer white space; blank lines take no part and stay.  A run
counts when it has WINDOW lines or more that stand one after the
other (blank lines between them aside).  With ``words`` a run of fewer lines, one line
also, counts too when it has more than so many words.

1. Of every WINDOW consecutive line hashes the smallest is a fingerprint, so every run
   of WINDOW lines holds one.  A shorter run that counts by its words is a fingerprint of
   its own, unless it holds a shorter one that counts.  Fingerprints are counted over the
   corpus.
2. Positions are joined with the fingerprints that occur twice or more, and every
   match is extended to both sides: all runs that count around the position.
3. The first place (smallest doc_id, then line) of every such run is a grouped
   minimum; lines of a run with an earlier place are deleted.

Both groupings pre-aggregate before the shuffle and no pairs are formed, so a line
in a third of all documents costs no more than any other.  The first copy always
stays, judged on the input and not on what is left.

Null and empty texts stay as they are; rows that repeat an id count as one place
(equal rows keep their lines, as neither is later).  A row without an id, or whose id is no
integer, is left as it is and is no earlier place of another.  Extra columns are ignored by
``repeated`` and kept by ``delete_runs``, whatever their names (lines_removed and runs_removed
are replaced); an empty table gives an empty result.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartero.llm.common import U64, bytes_of, narrow, slices, span_hashes, stage, window_hashes
from cartero.llm.decontaminate import words_of

WINDOW = 3
_BLANK = np.zeros(256, bool)
_BLANK[32] = _BLANK[9:14] = True


def lines_of(buf: np.ndarray, offs: np.ndarray):
    """(starts, ends, stripped starts, stripped ends, first line of each text); ends exclude the line feed."""
    feed = np.flatnonzero(buf == 10)
    starts = np.unique(np.concatenate([offs[:-1], feed + 1]))
    starts = starts[starts <= len(buf)]
    text = np.searchsorted(offs[1:], starts, "right")
    keep = text < len(offs) - 1
    starts, text = starts[keep], text[keep]
    ends = np.minimum(np.append(starts[1:], len(buf)), offs[1:][text])
    cut = (ends > starts) & (buf[np.maximum(ends - 1, 0)] == 10) if len(buf) else np.zeros(len(starts), bool)
    ends = ends - cut
    solid = np.flatnonzero(~_BLANK[buf])
    a, z = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    empty = a >= z
    s = np.where(empty, starts, solid[np.minimum(a, len(solid) - 1)] if len(solid) else starts)
    e = np.where(empty, starts, solid[np.maximum(z - 1, 0)] + 1 if len(solid) else starts)
    return starts, ends, s, e, np.searchsorted(starts, offs)


def _line_hashes(column: pa.Array, words: int | None):
    """Per text: (hashes of lines that are not blank, their numbers of words if ``words`` asks for them)."""
    buf, offs = bytes_of(column)
    starts, _, s, e, bounds = lines_of(buf, offs)
    hashes, full = span_hashes(buf, s, e), e > s
    n_words = np.zeros(len(s), np.int64)
    if words is not None:
        begin = words_of(column)[2]
        n_words = np.searchsorted(begin, e) - np.searchsorted(begin, s)
    for a, b in zip(bounds[:-1], bounds[1:]):
        used = np.flatnonzero(full[a:b])
        yield hashes[a:b][used], n_words[a:b][used]


def _counts(n_words: np.ndarray, k: int, window: int, words: int | None) -> np.ndarray:
    """Whether the run of ``k`` lines at every start counts."""
    n = max(len(n_words) - k + 1, 0)
    if k == window:
        return np.ones(n, bool)
    if words is None:
        return np.zeros(n, bool)
    total = np.concatenate([[0], np.cumsum(n_words)])
    return total[k:] - total[:-k] > words if n else np.zeros(0, bool)


def _prints(hashes: np.ndarray, n_words: np.ndarray, window: int, words: int | None):
    """(places, fingerprints) of a text."""
    at = winnow(hashes, window)
    places, prints = [at], [hashes[at]]
    if words is not None:
        held = np.zeros(len(hashes) + 1, bool)  # runs of k - 1 lines that count
        for k in range(1, window):
            own = _counts(n_words, k, window, words)
            new = np.flatnonzero(own & ~held[:len(own)] & ~held[1:len(own) + 1])
            places.append(new)
            prints.append(window_hashes(hashes, k)[new])
            held = np.append(own, False)
    return np.concatenate(places), np.concatenate(prints)


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the rightmost minimum of every window of consecutive hashes."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(hashes, window)[:, ::-1]
    return np.unique(np.arange(n) + window - 1 - np.argmin(view, axis=1))


def _marks(window, words, batches):
    for b in slices(batches):
        ids, prints, places = b.column("doc_id").to_numpy(False), [], []
        for (hashes, n_words), ident in zip(_line_hashes(b.column("text"), words), ids):
            p, found = _prints(hashes, n_words, window, words)
            prints.append(found)
            places.append((ident, p))
        doc = np.repeat(ids, [len(p) for _, p in places])
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(np.concatenate([p for _, p in places])), pa.array(np.concatenate(prints).view(np.int64))],
            ["doc_id", "place", "print"])


def _extend(window, words, batches):
    """Runs that count around repeated fingerprints."""
    for b in slices(batches):
        ids, out = b.column("doc_id").to_numpy(False), ([], [], [], [])
        for (hashes, n_words), ident, places in zip(_line_hashes(b.column("text"), words), ids, b.column("places").to_pylist()):
            for k in range(1 if words is not None else window, window + 1):
                runs, own = window_hashes(hashes, k), _counts(n_words, k, window, words)
                at = np.unique(np.add.outer(np.array(places, np.int64), np.arange(1 - k, 1)))
                at = at[(at >= 0) & (at < len(runs))]
                at = at[own[at]]
                out[0].append(np.full(len(at), ident))
                out[1].append(at)
                out[2].append(np.full(len(at), k))
                out[3].append(runs[at].view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out], ["doc_id", "place", "lines", "run"])


def repeated(docs: DataFrame, window: int = WINDOW, words: int | None = None) -> DataFrame:
    """(doc_id, starts array<struct<place, lines>>): later runs, counted in lines that are not blank."""
    source = docs.select(F.col("doc_id").try_cast("long").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    marks = stage(source.mapInArrow(partial(_marks, window, words), "doc_id long, place long, print long"), "marks")
    twice = stage(marks.groupBy("print").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("print"), "twice")
    places = marks.join(twice, "print").groupBy("doc_id").agg(F.collect_set("place").alias("places"))
    around = source.join(places, "doc_id").mapInArrow(partial(_extend, window, words), "doc_id long, place long, lines long, run long")
    around = stage(around, "runs")
    first = around.groupBy("run").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = stage(first.filter("n > 1").select("run", "first"), "first")
    later = around.join(first, "run").filter(F.struct("doc_id", "place") > F.col("first"))
    return later.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("place", "lines"))).alias("starts"))


def _delete(batches):
    for b in slices(batches):
        texts, removed, spans = [], [], []
        columns = b.column("text"), b.column("_starts").to_pylist()
        buf, offs = bytes_of(columns[0])
        starts, ends, s, e, bounds = lines_of(buf, offs)
        raw = buf.tobytes()
        for i, (a, z, at) in enumerate(zip(bounds[:-1], bounds[1:], columns[1])):
            if not at:
                texts.append(columns[0][i].as_py())
                removed.append(0)
                spans.append(0)
                continue
            full = np.flatnonzero(e[a:z] > s[a:z])
            edge = np.zeros(len(full) + 1, np.int64)
            place, n = (np.array([run[c] for run in at]) for c in ("place", "lines"))
            np.add.at(edge, place, 1)
            np.add.at(edge, place + n, -1)
            gone = np.cumsum(edge[:-1]) > 0
            keep = np.ones(z - a, bool)
            keep[full[gone]] = False
            texts.append(b"\n".join([raw[x:y] for x, y in zip(starts[a:z][keep], ends[a:z][keep])]).decode())
            removed.append(int(gone.sum()))
            spans.append(int((gone & ~np.r_[False, gone[:-1]]).sum()))
        yield pa.RecordBatch.from_arrays(
            [b.column("_row"), pa.array(texts, pa.string()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())],
            ["_row", "text", "lines_removed", "runs_removed"])


def delete_runs(docs: DataFrame, window: int = WINDOW, words: int | None = None) -> DataFrame:
    """All columns with the runs cut out of ``text``, and lines_removed, runs_removed."""
    found = repeated(docs, window, words).select(F.col("doc_id").alias("_id"), F.col("starts").alias("_starts"))
    rest = [c for c in docs.columns if c not in ("text", "lines_removed", "runs_removed")]
    rows = docs.select(F.col("doc_id").try_cast("long").alias("_key"), "text", F.struct(*rest).alias("_row"))  # names cannot clash inside
    joined = rows.join(found, F.col("_key") == F.col("_id"), "left").select("_row", "text", "_starts")
    schema = T.StructType([joined.schema["_row"], T.StructField("text", T.StringType()),
                           T.StructField("lines_removed", T.LongType()), T.StructField("runs_removed", T.LongType())])
    return joined.mapInArrow(_delete, schema).select("_row.*", "text", "lines_removed", "runs_removed")
