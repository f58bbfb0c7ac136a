"""Shared folder, written stages, and byte-level helpers for text in Arrow batches."""

from __future__ import annotations

import ctypes
import glob
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20  # text handled at once inside a task; a longer text is handled alone
U64 = np.uint64


# ------------------------------------------------------------------ stages
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="cartero-code-"), "cartero.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = current.get() if current.isDefined() else None
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="cartero-llm-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/cartero-llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, keep: list | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; the path is added to ``keep``."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    if keep is not None:
        keep.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int, least: int = 12, per_task: int = 500_000) -> DataFrame:
    """``df`` in fewer tasks where a bound on its rows is known to be small; larger ones keep theirs."""
    parts = max(least, rows // per_task)
    return df.coalesce(parts) if parts < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def discard(spark: SparkSession, paths: list) -> None:
    """Delete stages that no later job reads."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    paths.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that extra columns with clashing names do no harm."""
    return docs.select(*[F.col(c) for c in columns])


def crc_mod(ident: str, m: int):
    """crc32 of an id as text, modulo m: the fixed folds of the contracts."""
    return F.crc32(F.col(ident).cast("string").cast("binary")) % m


def one_core() -> None:
    """Matrix products of this task on one core: the small ones here cost twice the time on two, and other cores have tasks of their own.

    Without effect where numpy has another library than OpenBLAS.
    """
    for path in glob.glob(os.path.join(os.path.dirname(np.__file__), os.pardir, "numpy.libs", "*openblas*")):
        library = ctypes.CDLL(os.path.realpath(path))
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                break


# ------------------------------------------------------------- texts as bytes
def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buffer, offsets) of a string array; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = column.buffers()[2]
    buf = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that each carries about SLICE_BYTES of text, and at least one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offs = bytes_of(batch.column(text))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offs, offs[at] + SLICE_BYTES, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def runs(member: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of maximal runs of True bytes; runs never cross offsets."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = member.copy()
    first[1:] &= ~member[:-1]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    first |= member & edge[:n]
    last = member.copy()
    last[:-1] &= ~member[1:]
    last |= member & edge[1:]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (splitmix64)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[i] = np.cumprod(p)
    return _POWERS[0], _POWERS[1]


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * _powers(len(buf) + 1)[0][:len(buf)], out=total[1:])
    return total


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, total: np.ndarray | None = None) -> np.ndarray:
    """64-bit content hashes of byte spans, from one prefix sum of a polynomial."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    down = _powers(len(buf) + 1)[1]
    total = prefix_sums(buf) if total is None else total
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive word hashes at every start where k words follow."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= U64(0xD6E8FEB86659FD93)
        out += words[j:j + n]
    return mix(out + U64(k))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges [start, start + length)."""
    total = int(lengths.sum())
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return shift + np.arange(total)


def binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Split one contiguous array into binary rows of counts[i] items each."""
    values = np.ascontiguousarray(values)
    offs = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts * values.itemsize, out=offs[1:])
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offs), pa.py_buffer(values)])
