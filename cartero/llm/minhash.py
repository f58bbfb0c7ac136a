"""Near-duplicate documents: b-bit MinHash with band candidates and exact confirmation.

1. Every text becomes its set of five-word shingles (64-bit hashes), 250 minima,
   50 band keys of five minima each, and a signature of the low four bits of the
   minima.  A pair of similarity 0.75 shares no band with probability 1.3e-6.
2. Texts with the same set are one class; only its smallest id goes on.
3. Members of a band bucket are compared with the smallest id of the bucket: first
   the bit count of the signatures, corrected for chance collisions (pairs under
   ESTIMATE_CUT go; a pair of 0.75 falls there with probability below 1e-9), then
   the full sets.  The links give components.
4. In buckets that still hold several components, the members outside the largest
   one are compared with all members, in blocks; a task keeps a union-find of what
   it has joined and so returns fewer links than it has members.  No pairs are
   written out, and no bucket is capped.
5. Members of an open bucket of more than BLOCK are first posted again by their
   rarest shingles: of n shingles the first n - ceil(0.75 n) + 1, in one order for all
   texts, so that two texts of similarity 0.75 share one of them.  What many texts have
   in common (a header, say) comes last in the order and is not posted, and texts that
   share nothing else no longer meet.  The order is by counts in 2**SLOTS hashed slots;
   it decides how many texts meet, never which links are found.

Null, empty and blank texts have no shingles and link with nothing; fewer than five
words are one shingle.  Rows that repeat an id belong to one node.  Extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartero.llm.common import (LOWER, U64, bytes_of, mix, runs, sized, slices, span_hashes, stage,
                                window_hashes)
from cartero.llm.components import components

SHINGLE = 5
BANDS, ROWS, BITS = 50, 5, 4
THRESHOLD = 75  # per cent
ESTIMATE_CUT = 0.55
BLOCK = 512
SLOTS = 20  # 4 MB of counts in a task, whatever the number of texts
BROADCAST_IDS = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[32] = _SPACE[9:14] = True
_RNG = np.random.default_rng(1729)
_A = (_RNG.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
SIGNATURES = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, signature binary"


# -------------------------------------------------------------------- in tasks
def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    buf, offs = bytes_of(column)
    buf = LOWER[buf]
    starts, ends = runs(~_SPACE[buf], offs)
    words = span_hashes(buf, starts, ends)
    grams, bounds = window_hashes(words, SHINGLE), np.searchsorted(starts, offs)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        whole = b - a < SHINGLE
        out.append(np.unique(window_hashes(words[a:b], b - a) if whole and b > a else grams[a:max(a, b - SHINGLE + 1)]))
    return out


def _minima(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    short = (values >> U64(32)).astype(np.uint32)
    out = np.empty((len(starts), BANDS * ROWS), np.uint32)
    for i in range(BANDS * ROWS):
        out[:, i] = np.minimum.reduceat(short * _A[i] + _B[i], starts)
    return out


def _signatures(batches):
    for b in slices(batches):
        sets = shingle_sets(b.column("text"))
        sizes = np.array([len(s) for s in sets])
        full = np.flatnonzero(sizes)
        keys = np.zeros((len(sets), BANDS), np.int64)
        packed, ab = [b""] * len(sets), np.zeros((2, len(sets)), np.int64)
        if len(full):
            values = np.concatenate([sets[i] for i in full])
            starts = np.cumsum(sizes[full]) - sizes[full]
            low = _minima(values, starts)
            band = np.full((len(full), BANDS), 7, np.uint64) + np.arange(BANDS, dtype=np.uint64)
            for j in range(ROWS):
                band = mix(band * U64(31) + low.reshape(len(full), BANDS, ROWS)[:, :, j])
            keys[full] = band.view(np.int64)
            bits = (low & np.uint32((1 << BITS) - 1)).astype(np.uint8)
            bits = (bits[:, 0::2] << 4) | bits[:, 1::2]
            for i, row in zip(full.tolist(), bits):
                packed[i] = row.tobytes()
            ab[0, full] = np.add.reduceat(mix(values), starts).view(np.int64)
            ab[1, full] = np.add.reduceat(mix(values ^ U64(0x5851F42D4C957F2D)), starts).view(np.int64)
        bands = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(ab[0]),
                                          pa.array(ab[1]), bands, pa.array(packed, pa.binary())],
                                         [c.split()[0] for c in SIGNATURES.split(", ")])


def estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Similarity from signatures (uint8 rows), corrected for equal bits by chance."""
    diff = x ^ y
    same = ((diff & 15) == 0).sum(-1) + ((diff >> 4) == 0).sum(-1)
    chance = 2.0 ** -BITS
    return (same / (BANDS * ROWS) - chance) / (1 - chance)


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """The full sets are similar enough."""
    if 100 * min(len(x), len(y)) < THRESHOLD * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= THRESHOLD * (len(x) + len(y) - both)


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _estimated(batches):
    for b in batches:
        if b.num_rows:
            good = estimate(_rows(b.column("sig_a")), _rows(b.column("sig_b"))) >= ESTIMATE_CUT
            yield b.select(["a", "b"]).filter(pa.array(good))


def _sets(batches):
    for b in slices(batches):
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array([s.tobytes() for s in shingle_sets(b.column("text"))], pa.binary())],
            ["doc_id", "shingles"])


def _confirmed(batches):
    for b in batches:
        good = [linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64))
                for x, y in zip(b.column("set_a"), b.column("set_b"))]
        yield b.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _slots(batches):
    """How many of the shingles of these texts fall into every slot."""
    total = np.zeros(1 << SLOTS, np.int64)
    for b in batches:
        every = np.frombuffer(b"".join(b.column("shingles").to_pylist()), np.uint64)
        total += np.bincount((every >> U64(64 - SLOTS)).astype(np.int64), minlength=1 << SLOTS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["slot", "n"])


def prefix(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The rarest shingles of a set, so many that a set of enough similarity holds one of its own among them."""
    n = len(shingles)
    size = n - -(-THRESHOLD * n // 100) + 1
    order = np.lexsort((shingles, counts[(shingles >> U64(64 - SLOTS)).astype(np.int64)]))
    return shingles[order[:size]]


def _posted(counts, batches):
    for b in batches:
        found = [prefix(np.frombuffer(s.as_py(), np.uint64), counts) for s in b.column("shingles")]
        rows = np.repeat(np.arange(b.num_rows), [len(f) for f in found])
        keys = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), *(b.column(c).take(pa.array(rows)) for c in ("doc_id", "component"))],
                                         ["band", "doc_id", "component"])


def _across(group: pa.Table) -> pa.Table:
    """Links of a block between different components, at most one per component joined."""
    ids, comps = group["doc_id"].to_pylist(), group["component"].to_pylist()
    sigs = _rows(group["signature"].combine_chunks())
    sets = [np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()]
    parent = {c: c for c in comps}

    def find(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    out, asks = [], np.array(group["asks"].to_pylist())
    members = np.flatnonzero(~asks)
    for i in np.flatnonzero(asks).tolist():
        for j in members[estimate(sigs[i], sigs[members]) >= ESTIMATE_CUT].tolist():
            p, q = find(comps[i]), find(comps[j])
            if p != q and linked(sets[i], sets[j]):
                parent[p] = q
                out.append((ids[i], ids[j]))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


# --------------------------------------------------------------- the operator
def _sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Shingle sets of the given ids; the ids are broadcast only if they are few."""
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    wanted = docs.join(side, "doc_id").mapInArrow(_sets, "doc_id long, shingles binary")
    return stage(wanted.dropDuplicates(["doc_id"]), "sets")


def _open(named: DataFrame, rows: int) -> DataFrame:
    """(band, doc_id, component, size) of the buckets with several components.

    Where the same members meet in many buckets, one of them is enough.
    """
    open_ = named.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                      F.count(F.lit(1)).alias("size")).filter("lo != hi").select("band", "size")
    rest = stage(sized(named.join(open_, "band"), rows), "open")
    marks = rest.groupBy("band").agg(F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("mark"), F.max("size").alias("size"))
    once = marks.groupBy("mark", "size").agg(F.min("band").alias("band")).select("band")
    return stage(sized(rest.join(once, "band"), rows), "rest")


def _by_prefix(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(band, doc_id, component): the members posted by their rarest shingles, in place of their buckets."""
    held = stage(members.join(sets, "doc_id"), "held")
    slots = held.select("shingles").mapInArrow(_slots, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = slots.toArrow()  # at most 2**SLOTS rows
    counts = np.zeros(1 << SLOTS, np.uint32)
    counts[found["slot"].to_numpy()] = np.minimum(found["n"].to_numpy(), (1 << 32) - 1)
    return stage(held.mapInArrow(partial(_posted, counts), "band long, doc_id long, component long"), "posted")


def _dealt(rest: DataFrame, rows: int) -> DataFrame:
    """Members of open buckets, once for every block (band, x, y) they are compared in."""
    # A pair of different components has a member outside the bucket's largest one: those
    # few meet every block of members, and the members are dealt out once for them.
    parts = rest.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.groupBy("band").agg(F.max_by("component", F.struct("n", "component")).alias("largest"),
                                      F.max("n").alias("most"), F.sum("n").alias("all"))
    parts = stage(sized(parts, rows), "parts")
    rest = rest.join(parts, "band").withColumn("outside", F.col("component") != F.col("largest"))
    blocks = F.ceil(F.col("all") / BLOCK).cast("int")
    groups = F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int")
    spot = F.xxhash64("doc_id")
    left = rest.select("band", "doc_id", "component", F.lit(False).alias("asks"), F.pmod(spot, blocks).cast("long").alias("x"),
                       F.explode(F.sequence(F.lit(0), groups - 1)).alias("y"))
    right = rest.filter("outside").select(
        "band", "doc_id", "component", F.lit(True).alias("asks"),
        F.explode(F.sequence(F.lit(0).cast("long"), (blocks - 1).cast("long"))).alias("x"), F.pmod(spot, groups).cast("int").alias("y"))
    return left.unionByName(right)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document row."""
    source = docs.select(F.col("doc_id").try_cast("long").alias("doc_id"), "text")
    sigs = stage(source.mapInArrow(_signatures, SIGNATURES), "signatures")
    some, n = sigs.filter("n_shingles > 0 and doc_id is not null"), sigs.count()
    same = ["n_shingles", "set_a", "set_b"]
    classes = some.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = stage(sized(classes, n), "classes")
    copies = some.select("doc_id", *same).join(classes.filter("copies > 1"), same).select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b")).filter("a != b")
    reps = some.join(classes.select(*same, F.col("rep").alias("doc_id")), ["doc_id", *same]).dropDuplicates(["doc_id"])
    reps = stage(sized(reps.select("doc_id", "signature", "bands"), BANDS * n), "reps")
    posted = reps.select("doc_id", F.explode("bands").alias("band"))
    buckets = posted.groupBy("band").agg(F.min("doc_id").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = stage(sized(buckets, BANDS * n), "buckets")
    members = stage(posted.join(buckets, "band"), "members")

    light = reps.select("doc_id", "signature")
    pairs = members.filter("doc_id != hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    pairs = (pairs.join(light.select(F.col("doc_id").alias("a"), F.col("signature").alias("sig_a")), "a")
             .join(light.select(F.col("doc_id").alias("b"), F.col("signature").alias("sig_b")), "b")
             .select("a", "b", "sig_a", "sig_b").mapInArrow(_estimated, "a long, b long"))
    pairs = stage(pairs, "pairs")
    ids = stage(sized(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), n), "ids")
    sets = _sets_of(source, ids)
    found = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
             .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
             .select("a", "b", "set_a", "set_b").mapInArrow(_confirmed, "a long, b long"))
    links = stage(copies.unionByName(found), "confirmed")
    labels = stage(sized(components(links), n), "labels")

    # Buckets with several components: pairs of two members were all compared with their hub above.
    named = members.filter("n > 2").join(labels, members.doc_id == labels.id, "left").select(
        "band", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    rest = _open(stage(sized(named, BANDS * n), "named"), BANDS * n)
    large = stage(sized(rest.filter(F.col("size") > BLOCK).select("doc_id", "component").distinct(), n), "large")
    if not rest.isEmpty():
        sets = _sets_of(source, stage(sized(rest.select("doc_id").distinct(), n), "ids"))
        if not large.isEmpty():
            rest = rest.filter(F.col("size") <= BLOCK).unionByName(_open(_by_prefix(large, sets), BANDS * n))
        dealt = _dealt(rest, BANDS * n).join(sets, "doc_id").join(light, "doc_id")
        more = dealt.groupBy("band", "x", "y").applyInArrow(_across, "a long, b long")
        links = stage(links.unionByName(more), "confirmed")
        labels = stage(sized(components(links), n), "labels")
    out = sigs.select("doc_id", "n_shingles").join(labels, sigs.doc_id == labels.id, "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def first_of_groups(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of every group, with all its columns, whatever their names.

    Rows without an id pass.  Of rows that repeat an id, those of one text are one document; another
    text of the id is a document of its own, after all others, and goes only if it is linked to one.
    """
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")  # names cannot clash inside
    rows = docs.select(F.col("doc_id").try_cast("long").alias("id"), F.xxhash64("text").alias("mark"), "text", rest)
    many = rows.filter("id is not null").groupBy("id").agg(F.min("mark").alias("first"), F.max("mark").alias("last"))
    many = stage(many.filter("first < last").select(F.col("id").alias("again"), "first"), "repeated-ids")
    later = F.xxhash64("id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    keyed = rows.filter("id is not null").join(many, F.col("id") == F.col("again"), "left")
    keyed = keyed.withColumn("key", F.when(F.col("mark") > F.col("first"), later).otherwise(F.col("id"))).select("key", "text", "row")
    found = near_duplicates(keyed.select(F.col("key").alias("doc_id"), "text"))
    kept = found.filter("kept").select(F.col("doc_id").alias("kept")).distinct()
    one = keyed.join(kept, F.col("key") == F.col("kept"), "left_semi").dropDuplicates(["key"])
    return one.select("row.*", "text").unionByName(rows.filter("id is null").select("row.*", "text")).select(*docs.columns)
