"""Token ids in a binary format: static range asymmetric numeral system.

A written corpus is a folder of two Parquet tables:

* ``table``: one row, the frequency table all blocks share (quantised to 2**SCALE);
* ``blocks``: one row per block of whole documents in ascending ``doc_id`` order
  (``part``, ``start_in_part``).  A block is independent: interleaved lanes, a
  checkpoint of all lane states every CHECKPOINT steps, a crc32 of its words and
  one of its ids.  Any block, or any checkpoint in it, can be decoded alone.

Nulls and empty texts become one end id.  Repeated ids keep all their rows,
ordered by text; rows without an id come first and keep it so.  Extra columns are ignored; an empty table gives no blocks.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartero.llm.bpe import encoder, with_end
from cartero.llm.common import U64, binaries, bytes_of, discard, narrow, new_path, slices, stage

SCALE = 20
BLOCK_IDS = 1 << 18
MAX_LANES = 2048
CHECKPOINT = 64
LOW, WORD = U64(1 << 31), U64(32)
TOKENS = "doc_id long, part int, start_in_part long, n_tokens long, ids binary"
BLOCKS = ("part int, start_in_part long, doc_ids array<long>, doc_tokens binary, n_ids long, lanes int, "
          "states binary, words binary, checkpoints binary, words_crc long, ids_crc long")


# ----------------------------------------------------------------- the coder
def quantise(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies that sum to 2**scale, at least 1 for every id that occurs."""
    total, size = int(counts.sum()), 1 << scale
    if not total:
        return np.zeros(len(counts), np.uint64)
    freq = np.where(counts > 0, np.maximum(1, counts.astype(object) * size // total), 0).astype(np.int64)
    order = np.argsort(-freq, kind="stable")
    rest, i = size - int(freq.sum()), 0
    while rest:
        step = rest if rest > 0 else -min(-rest, max(0, int(freq[order[i]]) // 2))
        freq[order[i]] += step
        rest, i = rest - step, i + 1
    return freq.astype(np.uint64)


def encode_block(ids: np.ndarray, freq: np.ndarray, base: np.ndarray, lanes: int):
    """(final states, words, checkpoints): lane j carries the ids j, j + lanes, ..."""
    steps = -(-len(ids) // lanes)
    state, parts, marks, total = np.full(lanes, LOW, np.uint64), [], [], 0
    for t in range(steps - 1, -1, -1):
        own = ids[t * lanes:(t + 1) * lanes]
        n, f = len(own), freq[own]
        x = state[:n]
        full = x >= (f << U64(63 - SCALE))
        parts.append(x[full].astype(np.uint32))
        total += len(parts[-1])
        x = np.where(full, x >> WORD, x)
        q = x // f
        state[:n] = (q << U64(SCALE)) + (x - q * f) + base[own]
        if t and t % CHECKPOINT == 0:
            marks.append((t, total, state.copy()))
    words = np.concatenate(parts[::-1]) if parts else np.zeros(0, np.uint32)
    marks = [np.concatenate([np.array([t, total - at], np.uint64), s]) for t, at, s in reversed(marks)]
    return state, words, np.concatenate(marks) if marks else np.zeros(0, np.uint64)


def decode_block(n_ids: int, states: np.ndarray, words: np.ndarray, freq, base, symbol,
                 first: int = 0, last: int | None = None, word: int = 0) -> np.ndarray:
    """Ids of steps [first, last) from the lane states and the word position at ``first``."""
    lanes = len(states)
    steps = -(-n_ids // lanes)
    last = steps if last is None else last
    state, out = states.copy(), []
    for t in range(first, last):
        x = state[:min(lanes, n_ids - t * lanes)]
        slot = x & U64((1 << SCALE) - 1)
        own = symbol[slot.astype(np.int64)]
        x = freq[own] * (x >> U64(SCALE)) + slot - base[own]
        low = np.flatnonzero(x < LOW)
        x[low] = (x[low] << WORD) | words[word:word + len(low)].astype(np.uint64)
        word += len(low)
        state[:len(x)] = x
        out.append(own)
    return np.concatenate(out) if out else np.zeros(0, symbol.dtype)


def checkpoints_of(marks: np.ndarray, lanes: int) -> list[tuple[int, int, np.ndarray]]:
    """(step, word position, states) of every checkpoint in a block."""
    return [(int(m[0]), int(m[1]), m[2:]) for m in marks.reshape(-1, lanes + 2)]


# ------------------------------------------------------------------ in tasks
def _tokenise(path, batches):
    from pyspark import TaskContext
    part, at = TaskContext.get().partitionId(), 0
    enc = encoder(path)
    for b in slices(batches):
        ids, counts = with_end(*enc.encode(*bytes_of(b.column("text"))))
        start = at + np.cumsum(counts) - counts
        at += int(counts.sum())
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(np.full(len(counts), part, np.int32)), pa.array(start),
             pa.array(counts), binaries(ids, counts)], ["doc_id", "part", "start_in_part", "n_tokens", "ids"])


def _count(dtype, size, batches):
    total = np.zeros(size, np.int64)
    for b in batches:
        raw, _ = bytes_of(b.column("ids"))
        total += np.bincount(np.frombuffer(raw.tobytes(), dtype), minlength=size)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])


def _encode(freq, dtype, batches):
    base = np.cumsum(freq) - freq
    rows, held = [], 0

    def block():
        ids = np.frombuffer(b"".join(r[4] for r in rows), dtype)
        lanes = int(min(MAX_LANES, max(1, len(ids) // 64)))
        states, words, marks = encode_block(ids, freq, base, lanes)
        raw = words.astype("<u4").tobytes()
        return (rows[0][1], rows[0][2], [r[0] for r in rows],
                np.array([r[3] for r in rows], "<i8").tobytes(), len(ids), lanes, states.astype("<u8").tobytes(),
                raw, marks.astype("<u8").tobytes(), zlib.crc32(raw), zlib.crc32(ids.astype("<u4").tobytes()))

    def batch(values):
        names = [c.split()[0] for c in BLOCKS.split(", ")]
        kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int32(), *[pa.binary()] * 3,
                 pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    for b in batches:
        cols = [b.column(c) for c in ("doc_id", "part", "start_in_part", "n_tokens", "ids")]
        for i in range(b.num_rows):
            row = tuple(c[i].as_py() for c in cols)
            follows = rows and row[1] == rows[-1][1] and row[2] == rows[-1][2] + rows[-1][3]
            if rows and (not follows or held + row[3] > BLOCK_IDS):
                yield batch(block())
                rows, held = [], 0
            rows.append(row)
            held += row[3]
    if rows:
        yield batch(block())


def _decode(freq, dtype, offsets, batches):
    base = np.cumsum(freq) - freq
    symbol = np.repeat(np.arange(len(freq), dtype=dtype), freq.astype(np.int64))
    for b in batches:
        for r in b.to_pylist():
            if zlib.crc32(r["words"]) != r["words_crc"]:
                raise ValueError(f"block {r['part']}/{r['start_in_part']}: words do not match their checksum")
            ids = decode_block(r["n_ids"], np.frombuffer(r["states"], "<u8"), np.frombuffer(r["words"], "<u4"),
                               freq, base, symbol).astype("<u4")
            if zlib.crc32(ids.tobytes()) != r["ids_crc"]:
                raise ValueError(f"block {r['part']}/{r['start_in_part']}: ids do not match their checksum")
            counts = np.frombuffer(r["doc_tokens"], "<i8")
            start = offsets[r["part"]] + r["start_in_part"] + np.cumsum(counts) - counts
            yield pa.RecordBatch.from_arrays(
                [pa.array(r["doc_ids"], pa.int64()), pa.array(start), pa.array(counts), binaries(ids, counts)],
                ["doc_id", "start", "n_tokens", "ids"])


# ------------------------------------------------------------- the operators
def write_tokens(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Encode every text and write the corpus folder at ``path``."""
    spark, keep = docs.sparkSession, []
    enc = encoder(tokenizer)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = narrow(docs, "doc_id", "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    tokens = stage(ordered.mapInArrow(partial(_tokenise, tokenizer), TOKENS), "tokens", keep)
    counts = tokens.select("ids").mapInArrow(partial(_count, enc.dtype, enc.size), "id long, n long")
    total = np.zeros(enc.size, np.int64)
    for r in counts.groupBy("id").agg(F.sum("n").alias("n")).collect():  # at most one row per vocabulary entry
        total[r["id"]] = r["n"]
    freq = quantise(total)
    row = [(1, SCALE, enc.dtype.str, bytearray(freq.astype("<u8").tobytes()))]
    spark.createDataFrame(row, "version int, scale int, dtype string, freq binary").write.parquet(f"{path}/table")
    tokens.mapInArrow(partial(_encode, freq, enc.dtype), BLOCKS).write.option(
        "compression", "uncompressed").parquet(f"{path}/blocks")
    discard(spark, keep)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids as little-endian unsigned 32-bit integers) of a corpus folder."""
    head = spark.read.parquet(f"{path}/table").first()
    freq = np.frombuffer(bytes(head["freq"]), "<u8").astype(np.uint64)
    blocks = spark.read.parquet(f"{path}/blocks")
    ends = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # one row per written part
    offsets, at = {}, 0
    for r in ends:
        offsets[r["part"]], at = at, at + r["n"]
    return blocks.mapInArrow(partial(_decode, freq, np.dtype(head["dtype"]), offsets),
                             "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` to a new corpus folder and read it back, one row per document."""
    path = new_path(docs.sparkSession, "corpus")
    write_tokens(docs, tokenizer, path)
    return read_tokens(docs.sparkSession, path)
