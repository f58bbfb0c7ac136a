"""Approximate nearest neighbours by largest inner product: a permutation index.

Vectors get one more component, sqrt(M**2 - |x|**2) with the largest norm M (0 for a
query), so that the largest inner product is the nearest direction.  Every vector is
represented by its ORDER nearest of at most PIVOTS pivots, drawn from a bounded sample
of SAMPLE vectors, and posted in the inverted files of those pivots, in blocks of about
BLOCK vectors.  A query reads the files of its own pivots, which give the footrule
distance of the two orders (a pivot missing from one counts as rank ORDER there); the
nearest FRACTION of the distinct vectors of a block, all ties and copies included, are
ranked again by the exact inner product.

A vector that is null, zero, or has null or non-finite components, or another number
of components than the sample's first, takes no part.  Equal scores go to the smaller
id.  Rows that share the query's id are its own.  Extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartero.llm.common import one_core, stage

PIVOTS, ORDER, SAMPLE = 512, 64, 4096
BLOCK, QUERIES = 16_384, 512
FRACTION = 0.2
QUERY_BYTES = 64 << 20
INDEX = "block long, ids binary, vectors binary, first binary, starts binary, posted binary, ranks binary"


def _valid(batches):
    for b in batches:
        rows = b.to_pydict()
        keep, out = [], []
        for i, v in enumerate(rows["embedding"]):
            if v is None or rows["vec_id"][i] is None or any(x is None for x in v):
                continue
            v = np.array(v, np.float64)
            if len(v) and np.isfinite(v).all() and v.any():
                keep.append(rows["vec_id"][i])
                out.append((v.tobytes(), len(v), float(v @ v)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keep, pa.int64()), pa.array([x[0] for x in out], pa.binary()),
             pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.float64())],
            ["vec_id", "vector", "size", "norm2"])


def _matrix(column, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, size)


def lift(x: np.ndarray, norm2: float) -> np.ndarray:
    extra = np.sqrt(np.maximum(norm2 - (x * x).sum(1), 0))
    return np.concatenate([x, extra[:, None]], 1)


def orders(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Indices of the nearest pivots of every row, nearest first."""
    m = min(ORDER, len(pivots))
    return np.argsort(-(x @ pivots.T), 1, kind="stable")[:, :m]


def _index(size, norm2, pivots, group: pa.Table) -> pa.Table:
    one_core()
    ids = group["vec_id"].to_numpy()
    at = np.argsort(ids, kind="stable")
    ids, x = ids[at], _matrix(group["vector"], size)[at]
    near = orders(lift(x, norm2), pivots)
    m = near.shape[1]
    row, rank = np.repeat(np.arange(len(x)), m), np.tile(np.arange(m), len(x))
    by = np.argsort(near.ravel(), kind="stable")
    starts = np.searchsorted(near.ravel()[by], np.arange(len(pivots) + 1))
    _, first = np.unique(x, axis=0, return_index=True)
    cols = [np.sort(first).astype("<i8"), starts.astype("<i8"), row[by].astype("<i4"), rank[by].astype("<i2")]
    return pa.table([pa.array([group["block"][0].as_py()], pa.int64()), pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                     pa.array([x.tobytes()], pa.binary()), *[pa.array([c.tobytes()], pa.binary()) for c in cols]],
                    names=[c.split()[0] for c in INDEX.split(", ")])


def _pack_queries(size, group: pa.Table) -> pa.Table:
    return pa.table({"chunk": group["chunk"].slice(0, 1), "query_ids": pa.array(
        [group["vec_id"].to_numpy().astype("<i8").tobytes()], pa.binary()),
        "queries": pa.array([_matrix(group["vector"], size).tobytes()], pa.binary())})


def footrule_gain(near: np.ndarray, n: int, starts, posted, ranks, m: int) -> np.ndarray:
    """Footrule distance to every vector, as m * (m + 1) minus this gain."""
    gain = np.zeros(n, np.int32)
    for i, p in enumerate(near.tolist()):
        a, z = starts[p], starts[p + 1]
        gain[posted[a:z]] += 2 * (m - np.maximum(ranks[a:z], i))
    return gain


def _search(size, pivots, k, batches):
    one_core()
    for b in batches:
        for r in b.to_pylist():
            ids, x = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["vectors"], np.float64).reshape(-1, size)
            first, starts = np.frombuffer(r["first"], "<i8"), np.frombuffer(r["starts"], "<i8")
            posted, ranks = np.frombuffer(r["posted"], "<i4"), np.frombuffer(r["ranks"], "<i2").astype(np.int32)
            asked, q = np.frombuffer(r["query_ids"], "<i8"), np.frombuffer(r["queries"], np.float64).reshape(-1, size)
            near = orders(np.concatenate([q, np.zeros((len(q), 1))], 1), pivots)
            want = min(len(first), max(20 * k, int(np.ceil(FRACTION * len(first)))))
            out = []
            for i in range(len(q)):
                gain = footrule_gain(near[i], len(x), starts, posted, ranks, near.shape[1])
                cut = np.partition(gain[first], len(first) - want)[len(first) - want]
                c = np.flatnonzero((gain >= cut) & (ids != asked[i]))
                score = x[c] @ q[i]
                if len(c) > k:  # keep ties with the k-th
                    edge = np.partition(score, len(c) - k)[len(c) - k]
                    c, score = c[score >= edge], score[score >= edge]
                best = np.lexsort((ids[c], -score))[:k]
                out.append((ids[c[best]], score[best]))
            sizes = pa.array(np.concatenate([[0], np.cumsum([len(o[0]) for o in out])]).astype(np.int32))
            found = pa.StructArray.from_arrays([pa.array(np.concatenate([o[0] for o in out])),
                                                pa.array(np.concatenate([o[1] for o in out]))], ["vec_id", "score"])
            yield pa.RecordBatch.from_arrays([pa.array(asked), pa.ListArray.from_arrays(sizes, found)], ["query_id", "found"])


def search(vectors: DataFrame, asks, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row that ``asks`` (a condition on vec_id) holds for."""
    spark = vectors.sparkSession
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    valid = stage(source.mapInArrow(_valid, "vec_id long, vector binary, size long, norm2 double"), "vectors")
    schema = "query_id long, rank int, vec_id long, score double"
    lengths = valid.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    size = lengths["size"]  # vectors of another length than most have no inner product with them
    valid = valid.filter(F.col("size") == size)
    sample = valid.orderBy(F.xxhash64("vec_id", "vector")).limit(SAMPLE).collect()  # SAMPLE rows
    stats = valid.agg(F.max("norm2").alias("norm2"), F.count(F.lit(1)).alias("n"),
                      F.count(F.when(asks, 1)).alias("q")).first()
    rows = np.unique([np.frombuffer(r["vector"], np.float64) for r in sample], axis=0)
    rows = rows[np.random.default_rng(11).permutation(len(rows))[:PIVOTS]]
    norm2 = stats["norm2"]
    pivots = lift(rows, norm2)
    blocks, chunks = -(-stats["n"] // BLOCK), max(1, -(-stats["q"] // QUERIES))
    dealt = valid.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("long"))
    index = stage(dealt.select("block", "vec_id", "vector").groupBy("block").applyInArrow(
        lambda group: _index(size, norm2, pivots, group), INDEX), "index")
    asked = valid.filter(asks).withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(chunks)).cast("long"))
    asked = stage(asked.select("chunk", "vec_id", "vector").groupBy("chunk").applyInArrow(
        lambda group: _pack_queries(size, group), "chunk long, query_ids binary, queries binary"), "queries")
    # Queries are broadcast in groups of at most QUERY_BYTES; every group meets every block.
    group, found = max(1, QUERY_BYTES // (QUERIES * size * 8)), None
    for low in range(0, chunks, group):
        some = F.broadcast(asked.filter(F.col("chunk").between(low, low + group - 1)))
        numbers = F.sequence(F.lit(low).cast("long"), F.lit(min(chunks, low + group) - 1).cast("long"))
        pairs = index.withColumn("chunk", F.explode(numbers)).repartition("block", "chunk").join(some, "chunk")
        part = pairs.mapInArrow(partial(_search, size, pivots, k), "query_id long, found array<struct<vec_id:long,score:double>>")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.select("query_id", F.inline("found")).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
