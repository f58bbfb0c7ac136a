"""Suffix-array dedup of bytes: repeated strings of LENGTH bytes by column-wise construction.

A byte goes if a string of LENGTH bytes that covers it also starts earlier (smaller
doc_id, or the same document and an earlier start), judged on the input.

1. Whole copies of a text are found by digest; only the first copy goes on.
2. Every string of LENGTH bytes holds WINDOW grams of GRAM bytes; the smallest (the
   rightmost of equal ones) is its anchor, which depends on the string alone.  Anchors
   are counted, and only strings whose anchor occurs twice can repeat.
3. The bytes around an anchor, as far as its strings reach, are one row; rows of one
   anchor meet in a task.  There the suffixes of all rows are ordered column by
   column, from the right: each round puts one symbol before the suffix of every row,
   which turns the order into the next one by a stable distribution over symbols (the
   Burrows-Wheeler step), and the common prefixes into 1 + the range minimum between
   rows of the same symbol.  Only the last order and its common prefixes are kept, as
   sequential arrays of a bounded chunk of rows; rounds read and write them in order.
   Neighbours with LENGTH symbols in common start the same string; all but the first
   are repeats.
4. Rows of an anchor with more than HOT rows are cut into stretches of COLUMNS starts,
   keyed by the bytes all their strings share, and pass a first round in SALTS parts
   that leaves only the first of equal strings.

Null texts are empty; texts under LENGTH bytes keep everything.  Rows that repeat an id
with the same text are one document, none earlier than the other.  A row without an id, or
whose id is no integer, keeps everything and is no earlier place of another.  Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartero.llm.common import U64, _BYTE, _powers, bytes_of, discard, mix, runs, slices, stage

LENGTH, GRAM = 100, 32
WINDOW = LENGTH - GRAM + 1
POSITION_BITS = 26
SEGMENT = 1 << 25  # starts whose anchors are found at once, so that places of equal grams compare
CHUNK_ROWS = 1 << 15
HOT, SALTS, COLUMNS = 100_000, 64, 9
PIECES = "key long, hot boolean, doc_id long, place long, reach int, piece binary"
SPANS = "key long, hot boolean, doc_id long, place long, low int, high int, piece binary, done boolean"


def anchors(buf: np.ndarray, offs: np.ndarray):
    """(gram hashes, start of every string of LENGTH bytes, place of its anchor)."""
    if len(buf) < LENGTH:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    parts = [_anchors(buf[a:a + SEGMENT + LENGTH - 1]) for a in range(0, len(buf) - LENGTH + 1, SEGMENT)]
    begin = np.arange(len(buf) - LENGTH + 1)
    place = np.concatenate([p + i * SEGMENT for i, (_, p) in enumerate(parts)])
    grams = np.concatenate([*(g[:SEGMENT] for g, _ in parts[:-1]), parts[-1][0]])
    inside = np.searchsorted(offs, begin, "right") == np.searchsorted(offs, begin + LENGTH - 1, "right")
    return grams, begin[inside], place[inside]


def _anchors(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram hashes, place of the anchor of the string at every start) of a buffer whose places fit POSITION_BITS."""
    n = len(buf)
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[buf] * up[:n], out=total[1:])
    grams = mix((total[GRAM:] - total[:-GRAM]) * down[:n - GRAM + 1])
    mask = U64((1 << POSITION_BITS) - 1)
    key = (grams & ~mask) | (mask - (np.arange(len(grams), dtype=np.uint64) & mask))
    width = 1
    while 2 * width <= WINDOW:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < WINDOW:
        key = np.minimum(key[:len(key) - (WINDOW - width)], key[WINDOW - width:])
    begin = np.arange(len(key))
    return grams, begin + (((mask - (key & mask)).astype(np.int64) - begin) & int(mask))


def _marks(batches):
    for b in slices(batches):
        buf, offs = bytes_of(b.column("text"))
        grams, _, place = anchors(buf, offs)
        place = np.unique(place)
        doc = np.searchsorted(offs, place, "right") - 1
        ids = b.column("doc_id").to_numpy(False)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[doc].astype(np.int64)), pa.array((place - offs[doc]).astype(np.int32)),
             pa.array(grams[place].view(np.int64))], ["doc_id", "place", "gram"])


def _pieces(batches):
    """The bytes around repeated anchors, cut into stretches where the anchor is hot."""
    for b in slices(batches):
        buf, offs = bytes_of(b.column("text"))
        grams, begin, place = anchors(buf, offs)
        ids, raw = b.column("doc_id").to_pylist(), buf.tobytes()
        change = np.flatnonzero(np.diff(place, prepend=-1))
        first, last, at = begin[change], begin[np.append(change[1:], len(begin)) - 1] if len(begin) else change, place[change]
        where, out = {p: i for i, p in enumerate(at.tolist())}, []
        for i, (doc, found) in enumerate(zip(ids, b.column("found").to_pylist())):
            for f in found or ():
                p = f["place"] + int(offs[i])
                j = where.get(p)
                if j is None:
                    continue
                lo, hi, gram = int(first[j]), int(last[j]), int(grams[p].view(np.int64))
                if not f["hot"]:
                    out.append((gram, False, doc, f["place"], p - lo, raw[lo:hi + LENGTH]))
                    continue
                for s in range(lo, hi + 1):  # stretches aligned to the anchor
                    if s == lo or (p - s + 1) % COLUMNS == 0:
                        e = min(hi, s + (p - s) % COLUMNS)
                        near = p - (p - s) // COLUMNS * COLUMNS  # the last start of a whole stretch
                        shared = raw[near:near + LENGTH - COLUMNS + 1]
                        core = hashlib.blake2b(shared, digest_size=8, key=f"{gram}:{p - near}".encode())
                        key = int.from_bytes(core.digest(), "little", signed=True)
                        out.append((key, True, doc, f["place"], p - s, raw[s:e + LENGTH]))
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        cols = list(zip(*out)) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [c.split()[0] for c in PIECES.split(", ")])


def repeats(reach: np.ndarray, pieces: list[bytes]) -> np.ndarray:
    """(row, column) -> the string that starts there repeats one of an earlier row.

    Rows are in order of their places; column c stands for a start c bytes before the
    anchor.  One symbol of every row is inserted per round.
    """
    n, left = len(pieces), WINDOW - 1
    lengths = np.array([len(p) for p in pieces])
    width = left + LENGTH
    symbols = np.zeros((n, width), np.uint8)
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    row = np.repeat(np.arange(n), lengths)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + left - reach[row]
    symbols[row, col] = flat
    symbols = np.ascontiguousarray(symbols.T)
    low, high = left - reach, left - reach + lengths - LENGTH
    order, common = np.arange(n), np.zeros(n, np.uint8)
    later = np.zeros((n, WINDOW), bool)
    for c in range(width - 1, -1, -1):
        sym = symbols[c][order]
        by = np.argsort(sym, kind="stable")
        new, sorted_sym = np.zeros(n, np.uint8), sym[by]
        cuts = np.concatenate([[0], np.flatnonzero(sorted_sym[1:] != sorted_sym[:-1]) + 1, [n]])
        for a, z in zip(cuts[:-1], cuts[1:]):
            x = by[a:z]  # old positions of the rows with this symbol, ascending
            if z - a > 1:
                new[a + 1:z] = np.minimum(np.minimum.reduceat(common[:x[-1] + 1], x[:-1] + 1), 250) + 1
        order, common = order[by], new
        if c <= left:
            same = common >= LENGTH
            if same.any():
                own = (low[order] <= c) & (c <= high[order])
                heads = np.flatnonzero(~same)
                least = np.minimum.reduceat(np.where(own, order, n), heads)
                least = np.repeat(least, np.diff(np.append(heads, n)))
                late = own & (order > least)
                later[order[late], left - c] = True
    return later


def _groups(batches):
    """Rows sorted by key, in chunks that end with a key."""
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows < CHUNK_ROWS:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        keys = t["key"].to_numpy()
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if cut:
            yield t.slice(0, cut)
            held, rows = t.slice(cut).to_batches(), len(t) - cut
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _order(survive, batches):
    """Later strings of every row as runs of starts; with ``survive`` also the rows that are not done."""
    for t in _groups(batches):
        docs, places = t["doc_id"].to_numpy(), t["place"].to_numpy()
        at = np.lexsort((places, docs))
        t = t.take(pa.array(at))
        docs, places, keys = docs[at], places[at], t["key"].to_numpy()
        pieces, reach = t["piece"].to_pylist(), t["reach"].to_numpy().astype(np.int64)
        later = repeats(reach, pieces)
        edge = np.diff(later.astype(np.int8), axis=1, prepend=0, append=0)
        r, a = np.nonzero(edge == 1)
        _, z = np.nonzero(edge == -1)
        out = [(keys[i], False, docs[i], places[i], int(p), int(q) - 1, None, True) for i, p, q in zip(r, a.tolist(), z.tolist())]
        if survive:
            sizes = np.array([len(p) for p in pieces])
            for i in range(len(pieces)):
                low, high = reach[i] - (sizes[i] - LENGTH), reach[i]
                left = np.flatnonzero(~later[i, low:high + 1]) + low
                if len(left):  # starts low..high before the anchor that are the first of their kind here
                    cut = pieces[i][reach[i] - left[-1]:reach[i] - left[0] + LENGTH]
                    out.append((keys[i], True, docs[i], places[i], int(left[-1]), 0, cut, False))
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_()]
        cols = list(zip(*out)) if out else [[]] * 8
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [c.split()[0] for c in SPANS.split(", ")])


def _grouped(pieces: DataFrame, survive: bool, *keys: str) -> DataFrame:
    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.repartition(parts, *keys).sortWithinPartitions(*dict.fromkeys([*[k for k in keys if k != "key"], "key"]))
    return dealt.select(*[c.split()[0] for c in PIECES.split(", ")]).mapInArrow(partial(_order, survive), SPANS)


def repeated_spans(docs: DataFrame, hot: int = HOT) -> tuple[DataFrame, DataFrame, list]:
    """(ids of whole later copies, spans (doc_id, starts array<struct<low, high>>), stages to discard)."""
    keep: list = []
    source = docs.select(F.col("doc_id").try_cast("long").alias("doc_id"), "text").filter(
        f"doc_id is not null and text is not null and octet_length(text) >= {LENGTH}")
    digests = stage(source.select("doc_id", F.unhex(F.md5("text")).alias("digest"), F.octet_length("text").alias("size")),
                    "digests", keep)
    first = digests.groupBy("digest", "size").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = stage(digests.join(first, ["digest", "size"]).filter("doc_id > first").select("doc_id").distinct(), "copies", keep)
    few = F.broadcast(copies) if copies.count() <= 1_000_000 else copies
    marks = source.mapInArrow(_marks, "doc_id long, place int, gram long").join(few, "doc_id", "left_anti")
    marks = stage(marks, "marks", keep)
    twice = marks.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    twice = stage(twice.select("gram", (F.col("n") > hot).alias("hot")), "twice", keep)
    found = marks.join(twice, "gram").groupBy("doc_id").agg(F.collect_list(F.struct("place", "hot")).alias("found"))
    pieces = stage(source.join(found, "doc_id").mapInArrow(_pieces, PIECES), "pieces", keep)
    cold = _grouped(pieces.filter("not hot"), False, "key")
    salted = pieces.filter("hot").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    once = stage(_grouped(salted, True, "salt", "key"), "once", keep)
    again = once.filter("not done").select("key", "hot", "doc_id", "place", F.col("low").alias("reach"), "piece")
    spans = cold.unionByName(once.filter("done")).unionByName(_grouped(again, False, "key"))
    # A start ``low`` to ``high`` bytes before the anchor: the run of starts place - high .. place - low.
    spans = spans.select("doc_id", F.struct((F.col("place") - F.col("high")).alias("from"),
                                            (F.col("place") - F.col("low")).alias("to")).alias("run"))
    return copies, stage(spans.groupBy("doc_id").agg(F.collect_list("run").alias("runs")), "spans"), keep


def _remove(batches):
    for b in slices(batches):
        buf, offs = bytes_of(b.column("text"))
        raw, n, gone_n, spans, digests, texts = buf.tobytes(), [], [], [], [], []
        for i, (found, copy) in enumerate(zip(b.column("runs").to_pylist(), b.column("copy").to_pylist())):
            own = raw[offs[i]:offs[i + 1]]
            size = len(own)
            edge = np.zeros(size + 1, np.int64)
            for f in found or ():
                edge[f["from"]] += 1
                edge[f["to"] + LENGTH] -= 1
            gone = np.ones(size, bool) if copy else np.cumsum(edge[:-1]) > 0
            s, e = runs(gone, np.array([0, size]))
            cuts = [0, *np.stack([s, e], 1).ravel().tolist(), size]
            left = b"".join([own[x:y] for x, y in zip(cuts[::2], cuts[1::2])])
            n.append(size)
            gone_n.append(int(gone.sum()))
            spans.append(len(s))
            digests.append(hashlib.sha256(left).hexdigest())
            texts.append(left)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in (n, gone_n, spans)), pa.array(digests), pa.array(texts, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every document row."""
    copies, spans, keep = repeated_spans(docs, hot)
    source = docs.select(F.col("doc_id").try_cast("long").alias("doc_id"), "text")
    flags = spans.join(copies.withColumn("copy", F.lit(True)), "doc_id", "full")
    flags = stage(flags.select("doc_id", "runs", F.coalesce("copy", F.lit(False)).alias("copy")), "flags")
    discard(docs.sparkSession, keep)
    joined = source.join(flags, "doc_id", "left").select("doc_id", "text", "runs", F.coalesce("copy", F.lit(False)).alias("copy"))
    return joined.mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
