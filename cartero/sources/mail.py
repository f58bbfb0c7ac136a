"""Reading and writing mail corpora and feedback logs."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_SCHEMA = T.StructType([
    T.StructField("message_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("label_text", T.StringType()),
    T.StructField("subject", T.StringType()),
    T.StructField("date", T.StringType()),
])

FEEDBACK_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("texto", T.StringType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("idioma", T.StringType()),
    T.StructField("p_spam", T.DoubleType()),
    T.StructField("pred_prev", T.StringType()),
    T.StructField("umbral", T.DoubleType()),
])

LOG_ROWS = 20_000       # lines of one file of a log


# ---------------------------------------------------------------- shared folder
def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; in local mode one of our own if it names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = current.get() if current.isDefined() else None
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="cartero-")
        spark.sparkContext.setCheckpointDir(named)
    return named


_SCOPES: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    path = os.path.join(shared_folder(spark), "cartero", f"{name}-{uuid.uuid4().hex}")
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def stage_scope(spark: SparkSession):
    """Remove what was written inside the scope when it is left.

    A result is lazy and may read stages, so write it to a path of your own (or
    collect it, if it is small) before the scope ends.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write a stage as Parquet in the shared folder and read it back.

    Later jobs start from the written table, so a lost executor costs one task
    and not the whole lineage, and a stage used twice is computed once.
    """
    path = new_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal an input of fewer splits than cores out over all cores.

    Costly text work would run in the few tasks of a small file otherwise.
    Inputs with enough splits, as on a cluster, are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; none where there is no folder."""
    if not path_exists(spark, path):
        return []
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return sorted(f.getPath().getName() for f in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root))


# ---------------------------------------------------------------------- readers
def read_splits(spark: SparkSession, paths: dict[str, str], source: str,
                schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """JSON-lines splits as one frame, tagged with ``split`` and ``fuente``."""
    out = None
    for split, path in paths.items():
        part = (spark.read.schema(schema).json(path)
                .withColumn("split", F.lit(split)).withColumn("fuente", F.lit(source)))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_any(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read by file suffix: Parquet, CSV, JSON lines or a JSON array."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if path.endswith(".csv"):
        return read_csv(spark, path, schema)
    if path.endswith(".jsonl"):
        return reader.json(path)
    if path.endswith(".json"):
        return reader.option("multiLine", True).json(path)
    return reader.parquet(path)


def readable(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The source, or None if it is missing or its first row cannot be read."""
    if not path_exists(spark, path):
        return None
    try:
        df = read_any(spark, path, schema)
        df.isEmpty()
    except (PySparkException, Py4JJavaError):
        return None
    return df


def read_first(spark: SparkSession, candidates: Sequence[str],
               schema: T.StructType | None = None) -> DataFrame:
    """First candidate that can be read; provenance and a default split are recorded."""
    found = (readable(spark, p, schema) for p in candidates)
    df = next((f for f in found if f is not None), None)
    if df is None:
        raise FileNotFoundError("no readable source among: " + ", ".join(candidates))
    split = F.coalesce(F.col("split"), F.lit("local")) if "split" in df.columns else F.lit("local")
    return df.withColumn("split", split).withColumn("fuente", F.lit("local_fallback"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV export; stages among themselves exchange Parquet."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_log(spark: SparkSession, path: str, schema: T.StructType = FEEDBACK_SCHEMA) -> DataFrame:
    """JSON-lines log; blank and malformed lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def append_log(df: DataFrame, path: str) -> None:
    """Append one JSON line per row, in lz4 files of at most ``LOG_ROWS`` lines (such files do not split)."""
    df.write.mode("append").option("compression", "lz4").option("maxRecordsPerFile", LOG_ROWS).json(path)


# ----------------------------------------------------------------------- schema
def resolve_aliases(df: DataFrame) -> DataFrame:
    """``Message`` from text/Message/message, in this order; needs one of them."""
    text = next((c for c in ("text", "Message", "message") if c in df.columns), None)
    if text is None:
        raise ValueError(f"no text column among {df.columns}")
    return df.withColumn("Message", F.col(text).cast("string"))


def label_column(df: DataFrame) -> str:
    for name in ("label_text", "label"):
        if name in df.columns:
            return name
    raise ValueError(f"no label column among {df.columns}")


def validate_schema(df: DataFrame, required: Sequence[str] = ("clean_en", "Category")) -> DataFrame:
    """Refuse empty frames and frames without the required columns."""
    if not df.columns or df.isEmpty():
        raise ValueError("entrada: el conjunto de datos está vacío")
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"entrada: faltan columnas {missing}; hay {df.columns}")
    return df


CORPUS_COLUMNS = ["message_id", "Message", "Label_Code", "Category", "subject", "message",
                  "date", "split", "fuente", "longitud_correo", "truncado"]


def keep_present(df: DataFrame, wanted: Sequence[str] = CORPUS_COLUMNS) -> DataFrame:
    """Ordered allow-list restricted to the columns that exist."""
    return df.select(*[c for c in wanted if c in df.columns])


def best_variant(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Preferred corpus first; the first that has been written is read."""
    return read_any(spark, next(p for p in paths if path_exists(spark, p)))


def best_text(base: DataFrame, variants: Sequence[DataFrame], key: str = "message_id",
              column: str = "texto_es") -> DataFrame:
    """Row-level preference: the first variant with a text for the key wins."""
    out = base
    for i, v in enumerate(variants):
        out = out.join(v.select(key, F.col(column).alias(f"_v{i}")), key, "left")
    picks = [F.col(f"_v{i}") for i in range(len(variants))]
    origin = F.coalesce(*[F.when(p.isNotNull(), F.lit(i)) for i, p in enumerate(picks)])
    return out.select(*base.columns, F.coalesce(*picks).alias(column), origin.alias("variante"))


def write_json_array(df: DataFrame, path: str) -> None:
    """One JSON array per output file, streamed row by row."""

    def brackets(batches):
        import pandas as pd
        opened = False
        for pdf in batches:
            lines = ["," + v for v in pdf["value"]]
            if lines and not opened:
                lines[0], opened = "[" + lines[0][1:], True
            yield pd.DataFrame({"value": lines})
        yield pd.DataFrame({"value": ["]" if opened else "[]"]})

    rows = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    rows.mapInPandas(brackets, "value string").write.mode("overwrite").text(path)
