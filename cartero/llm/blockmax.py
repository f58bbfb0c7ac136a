"""Ranked lexical search: an inverted index in shards, searched by Block-Max MaxScore.

**Index.**  A shard is a stretch of a partition of about SHARD_BYTES of text.  It has one row
per term: blocks of up to BLOCK postings, compressed to the bytes their gaps and counts
need, and of every block the first and last document and the postings no other one of the
block beats (more occurrences, or a shorter document).  From these the largest
part of a score that a block can give is known exactly, whatever the statistics of the
corpus are later.  One more row per shard carries its documents.  The index holds all
documents and all terms and is a written table: shards can be added without a rebuild.

**Search.**  The rows of the terms asked for are grouped by shard and group of at most
GROUP_ITEMS queries.  A task goes through its shard in stretches of WINDOW documents.  Lists
whose largest scores together stay below the score of the k-th document so far are not
essential: their documents are candidates only if an essential list has them.  Block maxima
of the other lists reject candidates before a block is unpacked; each list that is added
rejects again.  The k best of every shard are merged by a ranking per query.

A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))); a document scores for each term of
the query weight * (10**9 tf div (1000 tf + 20 m)), with m = 50 + 50 n N div L (N documents with
terms, L terms of all, n of the document).  Equal scores rank by ascending doc_id.

Null and empty texts have no terms: they are not counted and found by nothing.  Queries
without terms give no rows; equal queries count once; other texts of one item_id are ranked each
by itself.  Repeated doc_ids are documents each; a null doc_id ranks after all others of
its score.  Extra columns are ignored; empty tables give an empty result.  Terms are told
apart by 64-bit hashes.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartero.llm.common import binaries, ragged, slices, span_hashes, stage
from cartero.llm.decontaminate import words_of

SHARD_BYTES = 16 << 20
BLOCK = 128
WINDOW = 1024
GROUP_ITEMS = 256
BROADCAST_TERMS = 200_000  # rows (term, weight, queries) that may be sent to all executors
HEAD = np.dtype([("first", "<u4"), ("last", "<u4"), ("n", "u1"), ("gap", "u1"), ("count", "u1"), ("best", "u1")])
BEST = np.dtype([("tf", "<u4"), ("n", "<u4")])
INDEX = "shard long, term long, df long, n_terms long, heads binary, best binary, payload binary, doc_ids array<{}>"


# -------------------------------------------------------------------- index
def _width(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bytes (1, 2 or 4) the largest value of every block needs."""
    top = np.maximum.reduceat(values, starts)
    return np.where(top < 1 << 8, 1, np.where(top < 1 << 16, 2, 4))


def _pack(out: np.ndarray, at: np.ndarray, values: np.ndarray, width: np.ndarray) -> None:
    """Write ``values`` little-endian at their byte places."""
    for w in (1, 2, 4):
        own = np.flatnonzero(width == w)
        for k in range(w):
            out[at[own] + k] = (values[own] >> (8 * k)) & 255


def build_postings(terms: np.ndarray, docs: np.ndarray, lengths: np.ndarray):
    """Index rows (term, df, blocks, points, bytes; heads, best, payload) of word hashes with their documents, in document order."""
    order = np.argsort(terms, kind="stable")
    terms, docs = terms[order], docs[order]
    first = np.flatnonzero(np.r_[True, (terms[1:] != terms[:-1]) | (docs[1:] != docs[:-1])])
    tf = np.diff(np.r_[first, len(terms)])
    term, doc = terms[first], docs[first].astype(np.int64)
    row = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
    df = np.diff(np.r_[row, len(term)])
    place = ragged(np.zeros(len(df), np.int64), df)
    start = np.flatnonzero(place % BLOCK == 0)
    n = np.diff(np.r_[start, len(term)])
    block = np.repeat(np.arange(len(start)), n)
    gap = np.r_[0, np.diff(doc)]
    gap[start] = 0
    head = np.zeros(len(start), HEAD)
    head["first"], head["last"], head["n"] = doc[start], doc[start + n - 1], n
    head["gap"], head["count"] = _width(gap, start), _width(tf, start)
    size = n * (head["gap"].astype(np.int64) + head["count"])
    offset = np.cumsum(size) - size
    payload, own = np.zeros(int(size.sum()), np.uint8), place % BLOCK
    wide = head["gap"].astype(np.int64)[block]
    _pack(payload, offset[block] + own * wide, gap, wide)
    wide = head["count"].astype(np.int64)[block]
    _pack(payload, (offset + n * head["gap"])[block] + own * wide, tf, wide)
    # postings that no other of the block beats: by falling tf, each new smallest length
    order = np.lexsort((lengths[doc], -tf, block))
    key = lengths[doc][order] - block[order] * (int(lengths.max()) + 1)
    keep = np.r_[True, key[1:] < np.minimum.accumulate(key)[:-1]]
    best = np.zeros(int(keep.sum()), BEST)
    best["tf"], best["n"] = tf[order][keep], lengths[doc][order][keep]
    head["best"] = np.bincount(block[order][keep], minlength=len(start))
    blocks = -(-df // BLOCK)
    lead = np.cumsum(blocks) - blocks
    return term[row], df, blocks, np.add.reduceat(head["best"].astype(np.int64), lead), np.add.reduceat(size, lead), head, best, payload


def _index(shard_bytes, batches):
    from pyspark import TaskContext
    shard, held, rows = TaskContext.get().partitionId() << 24, 0, []
    names = [c.split()[0] for c in INDEX.split(", ")]

    def flush():
        lengths = np.concatenate([np.diff(r[2]) for r in rows])
        ids = pa.concat_arrays([r[0] for r in rows])
        words = np.concatenate([r[1] for r in rows])
        docs = np.repeat(np.arange(len(lengths)), lengths)
        one = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard]), pa.array([None], pa.int64()), pa.array([int((lengths > 0).sum())]), pa.array([int(lengths.sum())]),
             pa.array([None], pa.binary()), pa.array([None], pa.binary()), pa.array([lengths.astype("<i8").tobytes()], pa.binary()), one], names)
        if not len(words):
            return
        term, df, blocks, points, sizes, head, best, payload = build_postings(words, docs, lengths)
        n = len(term)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, shard)), pa.array(term.view(np.int64)), pa.array(df), pa.nulls(n, pa.int64()), binaries(head, blocks),
             binaries(best, points), binaries(payload, sizes), pa.nulls(n, pa.list_(ids.type))], names)

    for b in slices(batches):
        buf, offs, starts, ends, bounds = words_of(b.column("text"))
        rows.append((b.column("doc_id"), span_hashes(buf, starts, ends), bounds))
        held += len(buf)
        if held >= shard_bytes:
            yield from flush()
            shard, held, rows = shard + 1, 0, []
    if rows:
        yield from flush()


def build(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index of all ``docs`` (doc_id, text) as a written table."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stage(docs.select("doc_id", "text").mapInArrow(partial(_index, shard_bytes), INDEX.format(kind)), "postings")


# ------------------------------------------------------------------- search
class Shard:
    """The lists of some terms in one shard, unpacked block by block as they are needed."""

    def __init__(self, lengths: np.ndarray, n_docs: int, n_terms: int, rows: list[tuple]):
        self.fit = 50 * int(lengths.max(initial=0)) * n_docs < 1 << 62
        self.n_docs, self.n_terms, self.unpacked = n_docs, n_terms, 0
        self.m = self._m(lengths)
        self.lists = []
        for weight, heads, best, payload in rows:
            head, point = np.frombuffer(heads, HEAD), np.frombuffer(best, BEST)
            own = head["best"].astype(np.int64)
            part = self._part(point["tf"].astype(np.int64), self._m(point["n"].astype(np.int64)))
            top = weight * np.maximum.reduceat(part, np.cumsum(own) - own)
            size = head["n"].astype(np.int64) * (head["gap"].astype(np.int64) + head["count"])
            self.lists.append((weight, head, head["first"].astype(np.int64), head["last"].astype(np.int64), top,
                               np.cumsum(size) - size, payload, {}))

    def _m(self, n: np.ndarray) -> np.ndarray:
        if self.fit:
            return 50 + 50 * n * self.n_docs // max(self.n_terms, 1)
        return np.array([50 + 50 * int(x) * self.n_docs // self.n_terms for x in n], np.int64)

    @staticmethod
    def _part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * tf // (1000 * tf + 20 * m)

    def block(self, i: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of a block of list ``i``."""
        weight, head, _, _, _, offset, payload, cache = self.lists[i]
        if b not in cache:
            self.unpacked += 1
            h, at = head[b], int(offset[b])
            n, wide, count = int(h["n"]), int(h["gap"]), int(h["count"])
            docs = int(h["first"]) + np.cumsum(np.frombuffer(payload, f"<u{wide}", n, at).astype(np.int64))
            tf = np.frombuffer(payload, f"<u{count}", n, at + n * wide).astype(np.int64)
            cache[b] = docs, weight * self._part(tf, self.m[docs])
        return cache[b]

    def search(self, own: list[int], k: int, ids: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the ``k`` best by the lists ``own``; equal scores by ``ids``."""
        bound = {i: int(self.lists[i][4].max()) for i in own}
        own = sorted((i for i in own if bound[i]), key=bound.get)
        total = np.cumsum([bound[i] for i in own])
        docs, scores, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
        for lo in range(0, len(self.m), window):
            hi = min(lo + window, len(self.m))
            first = int(np.searchsorted(total, least))  # lists before it together stay below the least score
            if first == len(own):
                break
            score = np.zeros(hi - lo, np.int64)
            for i in own[first:]:
                begin, end = self.lists[i][2:4]
                for b in range(int(np.searchsorted(end, lo)), int(np.searchsorted(begin, hi))):
                    d, s = self.block(i, b)
                    if d[0] < lo or d[-1] >= hi:
                        a, z = np.searchsorted(d, (lo, hi))
                        d, s = d[a:z], s[a:z]
                    score[d - lo] += s
            found = np.flatnonzero(score) + lo
            score = score[found - lo]
            found, score = self._others(own[:first], found, score, least)
            good = score >= least
            docs, scores = np.concatenate([docs, found[good]]), np.concatenate([scores, score[good]])
            if len(docs) > k:
                best = np.lexsort((ids[docs], -scores))[:k]
                docs, scores = docs[best], scores[best]
            if len(docs) == k:
                least = max(least, int(scores.min()))
        return docs, scores

    def _others(self, own: list[int], found: np.ndarray, score: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Add lists that are not essential, the largest first; block maxima reject documents before."""
        if not own or not len(found):
            return found, score
        blocks, tops = [], []
        for i in own:
            begin, end, top = self.lists[i][2:5]
            b = np.minimum(np.searchsorted(end, found), len(end) - 1)
            inside = (begin[b] <= found) & (found <= end[b])
            blocks.append(np.where(inside, b, -1))
            tops.append(np.where(inside, top[b], 0))
        blocks, tops = np.array(blocks), np.array(tops)
        rest = tops.sum(axis=0)
        for j in range(len(own) - 1, -1, -1):
            good = score + rest >= least
            if not good.all():
                found, score, rest, blocks, tops = found[good], score[good], rest[good], blocks[:, good], tops[:, good]
            rest = rest - tops[j]
            for b in np.unique(blocks[j]).tolist():
                if b < 0:
                    continue
                d, s = self.block(own[j], b)
                asked = np.flatnonzero(blocks[j] == b)
                at = np.minimum(np.searchsorted(d, found[asked]), len(d) - 1)
                score[asked] += np.where(d[at] == found[asked], s[at], 0)
        return found, score


def _search(n_docs, n_terms, k, table):
    """The ``k`` best documents of a shard for every query of a group."""
    table = table.combine_chunks()
    term = table.column("weight")
    lead = pc.index(pc.is_null(term), True).as_py()
    lengths = np.frombuffer(table.column("payload")[lead].as_py(), "<i8")
    ids = table.column("doc_ids")[lead].values
    place = np.empty(len(ids), np.int64)  # rank of the id, so that any type of id breaks ties
    place[np.asarray(pc.array_sort_indices(ids))] = np.arange(len(ids))
    rows, asked = [], {}
    for i, (weight, heads, best, payload, queries) in enumerate(zip(*(table.column(c).to_pylist() for c in (
            "weight", "heads", "best", "payload", "queries")))):
        if i != lead:
            for q in queries:
                asked.setdefault(q, []).append(len(rows))
            rows.append((weight, heads, best, payload))
    shard = Shard(lengths, n_docs, n_terms, rows)
    out = [(q, *shard.search(own, k, place)) for q, own in sorted(asked.items())]
    docs = np.concatenate([o[1] for o in out]) if out else np.zeros(0, np.int64)
    return pa.Table.from_arrays(
        [pa.array(np.repeat([o[0] for o in out], [len(o[1]) for o in out]).astype(np.int64)), ids.take(pa.array(docs)),
         pa.array(np.concatenate([o[2] for o in out]) if out else docs)], ["query", "doc_id", "score"])


def _terms(carry, batches):
    for b in slices(batches):
        buf, _, starts, ends, bounds = words_of(b.column("text"))
        hashes = span_hashes(buf, starts, ends)
        own = [np.unique(hashes[a:z]) for a, z in zip(bounds[:-1], bounds[1:])]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in own])]).astype(np.int32)
        terms = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(own).view(np.int64)))
        yield pa.RecordBatch.from_arrays([b.column(carry), b.column("query"), terms], [carry, "query", "terms"])


def search(index: DataFrame, items: DataFrame, k: int = 50, ident: str = "item_id") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of ``index`` with the highest scores above 0 for every item."""
    lead = index.filter("term is null")
    counts = lead.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l"),
                      F.count(F.lit(1)).alias("shards")).first()
    kind = items.schema[ident].dataType.simpleString()
    asked = items.select(F.col(ident), "text").filter("text is not null").distinct().withColumn("query", F.xxhash64(ident, "text"))
    asked = stage(asked.mapInArrow(partial(_terms, ident), f"`{ident}` {kind}, query long, terms array<long>").filter("size(terms) > 0"), "asked")
    groups = max(1, -(-asked.count() // GROUP_ITEMS))
    used = asked.select(F.pmod("query", F.lit(groups)).alias("group"), "query", F.explode("terms").alias("term"))
    used = used.groupBy("term", "group").agg(F.collect_set("query").alias("queries"))  # at most about GROUP_ITEMS of a group
    few = stage(used, "used")
    small = few.count() <= BROADCAST_TERMS
    side = (lambda df: F.broadcast(df)) if small else (lambda df: df)
    df = index.join(side(few.select("term").distinct()), "term").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.ln((F.lit(2.0) * counts["n"] + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = stage(few.join(df.select("term", weight.alias("weight")), "term"), "weights")
    lists = index.select("shard", "term", "heads", "best", "payload", "doc_ids").join(side(weights), "term").drop("term")
    docs = lead.select("heads", "best", "payload", "doc_ids", F.lit(None).cast("long").alias("weight"), "shard",
                       F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")).alias("group"),
                       F.lit(None).cast("array<long>").alias("queries"))
    rows = lists.unionByName(docs)
    ids = index.schema["doc_ids"].dataType.elementType.simpleString()
    n_docs, n_terms = counts["n"], counts["l"]
    # Work goes by documents and queries, not by the few bytes moved: one task per shard and group, as far as that is sensible.
    parts = min(counts["shards"] * groups, 8 * int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    best = rows.repartition(max(1, parts), "shard", "group").groupBy("shard", "group").applyInArrow(
        lambda table: _search(n_docs, n_terms, k, table), f"query long, doc_id {ids}, score long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(asked.select(ident, "query"), "query").select(ident, "rank", "doc_id", "score")
