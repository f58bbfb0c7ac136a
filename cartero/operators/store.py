"""Translations kept by content: a text that was translated once is never translated again.

An entry belongs to the 128-bit key of its text and to the version of the translator.  New texts are dealt to
chunks by key; a chunk's entries are written first and its manifest last, and readers see entries with a
manifest only.  A run that dies between two chunks is resumed by running it again: what is committed counts as
translated, the rest is open.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartero.functions.expressions import text_key
from cartero.operators.translate import ID
from cartero.sources.mail import child_names, new_path, path_exists

KEY = "clave"
ENTRY = "clave binary, texto_es string, num_fragmentos int, error string, lote string"
Work = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Filled:
    """Different texts of a run: found in the store, translated now, and those of them that failed."""

    textos: int
    reutilizados: int
    traducidos: int
    fallidos: int


@dataclass(frozen=True)
class TranslationStore:
    """Entries of one translator ``version`` under ``path``."""

    path: str
    version: str = "1"

    @property
    def _root(self) -> str:
        return f"{self.path}/v={self.version}"

    def chunks(self, spark: SparkSession) -> list[str]:
        """Committed chunks."""
        return [n for n in child_names(spark, f"{self._root}/manifests")
                if path_exists(spark, f"{self._root}/manifests/{n}/_SUCCESS")]

    def entries(self, spark: SparkSession) -> DataFrame:
        """(clave, texto_es, num_fragmentos, error), one row per key.

        Two writers at a time may store a text twice; a translation goes before a failure, then the
        smaller chunk name.  The aggregation and a join on the key share one exchange.
        """
        paths = [f"{self._root}/data/{n}" for n in self.chunks(spark)]
        rows = spark.read.schema(ENTRY).parquet(*paths) if paths else spark.createDataFrame([], ENTRY)
        kept = F.min_by(F.struct("texto_es", "num_fragmentos", "error"), F.struct(F.col("error").isNotNull(), "lote"))
        return rows.groupBy(KEY).agg(kept.alias("_e")).select(KEY, "_e.*")

    def fill(self, df: DataFrame, work: Work, text: str = "text", ident: str = ID, chunks: int = 8,
             retry: bool = False) -> Filled:
        """Translate the texts of ``df`` that the store has not got.

        ``work`` turns (id, text) into (id, texto_es, num_fragmentos[, error]), one row per id; a null
        ``texto_es`` is a failure.  Failures are kept with their error and asked for again
        with ``retry``.  ``ident`` is unique in ``df``; null texts are left out.  Only keys and
        ids meet the store and are made distinct; of equal texts the smallest id's is translated.
        """
        spark = df.sparkSession
        rows = df.filter(F.col(text).isNotNull()).select(ident, text, text_key(F.col(text)).alias(KEY))
        first = rows.select(ident, KEY).groupBy(KEY).agg(F.min(ident).alias(ident))
        known = self.entries(spark).select(KEY, F.col("error").isNull().alias("_ok"))
        state = first.join(known, KEY, "left").select(
            ident, KEY, F.col("_ok").isNotNull().alias("_known"),
            (F.col("_ok").isNull() | (~F.col("_ok") if retry else F.lit(False))).alias("_open"))
        path = new_path(spark, "open")
        state.write.parquet(path)
        state = spark.read.schema(state.schema).parquet(path)
        total = state.agg(F.count(F.lit(1)).alias("n"), F.count_if("_open").alias("open")).first()
        failed = 0
        if total["open"]:
            todo = rows.select(ident, text).join(state.filter("_open").select(ident, KEY), ident)
            todo = todo.withColumn("lote", F.pmod(F.hash(KEY), F.lit(chunks)))
            staged = new_path(spark, "todo")
            todo.write.partitionBy("lote").parquet(staged)
            todo = spark.read.schema(todo.schema).parquet(staged)
            for i in range(chunks):
                failed += self._chunk(todo.filter(F.col("lote") == i).drop("lote"), work, text, ident)
        return Filled(total["n"], total["n"] - total["open"], total["open"], failed)

    def _chunk(self, rows: DataFrame, work: Work, text: str, ident: str) -> int:
        """Translate and commit one chunk; returns its failures."""
        spark, name = rows.sparkSession, uuid.uuid4().hex
        out = work(rows.select(ident, text))
        error = F.col("error") if "error" in out.columns else F.lit(None).cast("string")
        out = out.withColumn("error", F.coalesce(error, F.when(F.col("texto_es").isNull(), "no translation")))
        out = out.withColumn("texto_es", F.when(F.col("error").isNull(), F.col("texto_es")))
        out.join(rows.select(ident, KEY), ident).select(
            KEY, "texto_es", F.col("num_fragmentos").cast("int").alias("num_fragmentos"), "error",
            F.lit(name).alias("lote")).write.parquet(f"{self._root}/data/{name}")
        counts = spark.read.schema(ENTRY).parquet(f"{self._root}/data/{name}").agg(
            F.count(F.lit(1)).alias("filas"), F.count("error").alias("fallidos")).first()
        if counts["filas"]:
            manifest = spark.createDataFrame([(counts["filas"], counts["fallidos"])], "filas long, fallidos long")
            manifest.coalesce(1).write.parquet(f"{self._root}/manifests/{name}")
        return counts["fallidos"]

    def apply(self, df: DataFrame, text: str = "text", ident: str = ID) -> DataFrame:
        """``df`` with texto_es, num_fragmentos and ``fallo``.

        A text whose translation failed, or that was never asked for, stays as it is: flagged with one fragment.  A null
        text has neither translation nor failure.  Keys and ids meet the store; ``df`` is joined by id.
        """
        keys = df.filter(F.col(text).isNotNull()).select(ident, text_key(F.col(text)).alias(KEY))
        found = keys.join(self.entries(df.sparkSession), KEY, "left").select(
            ident, F.col("texto_es").alias("_es"), F.col("num_fragmentos").alias("_n"))
        blank = F.col(text).isNull()
        return df.join(found, ident, "left").withColumn("texto_es", F.coalesce("_es", text)) \
            .withColumn("num_fragmentos", F.when(blank, 0).otherwise(F.coalesce("_n", F.lit(1)))) \
            .withColumn("fallo", ~blank & F.col("_es").isNull()).drop("_es", "_n")
