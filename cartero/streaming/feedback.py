"""Feedback as a stream: online learning, history log and retraining catalogue.

State lives in Parquet folders with one directory per micro-batch.  A batch
overwrites its own directories only and reads those of earlier batches only, so
a replayed batch gives the same result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartero.functions import text as tx
from cartero.functions.expressions import compute_once, text_key
from cartero.operators import bayes, history, online, score
from cartero.operators.features import ID, MODEL
from cartero.sources.mail import FEEDBACK_SCHEMA, LOG_ROWS, path_exists, stage_scope, write_stage

COMPACT_EVERY = 50      # batches between two snapshots of the counts

COUNT_SCHEMA = T.StructType([
    T.StructField(MODEL, T.StringType()), T.StructField("term", T.StringType()),
    T.StructField("idf", T.DoubleType()), T.StructField("w_ham", T.DoubleType()),
    T.StructField("w_spam", T.DoubleType())])
PRIOR_SCHEMA = T.StructType([
    T.StructField(MODEL, T.StringType()), T.StructField("n_ham", T.LongType()),
    T.StructField("n_spam", T.LongType())])
TEXT_SCHEMA = "clave binary, texto string"
ENTRY_SCHEMA = ("clave binary, veces_entrenado long, primero long, ultimo long, primera struct<idioma: string, fecha: string>, "
                "ultima struct<label: int, fecha: string, p: double>")


def read_events(spark: SparkSession, path: str, schema: T.StructType = FEEDBACK_SCHEMA,
                files_per_batch: int | None = None) -> DataFrame:
    """Stream of feedback events from a folder of JSON-line files."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


@dataclass(frozen=True)
class BatchState:
    """Tables of additive rows under ``path``: one delta per micro-batch, a snapshot now and then."""

    path: str

    def _folder(self, kind: str, batch: int, table: str) -> str:
        return f"{self.path}/{kind}/{batch}/{table}"

    def _before(self, spark: SparkSession, batch: int, last: str) -> tuple[int | None, list[int]]:
        """The latest snapshot before ``batch`` and the deltas after it; ``last`` is the table written last."""
        def whole(kind: str, b: int) -> bool:
            return path_exists(spark, self._folder(kind, b, last) + "/_SUCCESS")

        snap = next((b for b in range(batch - 1, -2, -1) if (b == -1 or (b + 1) % COMPACT_EVERY == 0) and whole("snapshot", b)), None)
        return snap, [b for b in range(-1 if snap is None else snap + 1, batch) if whole("delta", b)]


@dataclass(frozen=True)
class ModelState(BatchState):
    """Count tables of a served model, batch by batch, under ``path``."""

    max_rows: int
    alpha: float = bayes.ALPHA

    def start(self, model: bayes.NaiveBayes) -> "ModelState":
        """Store the trained model as the snapshot before batch 0."""
        self._write("snapshot", -1, model.counts.select(MODEL, "term", "idf", "w_ham", "w_spam"), model.priors)
        return self

    def _write(self, kind: str, batch: int, counts: DataFrame, priors: DataFrame) -> None:
        counts.write.mode("overwrite").parquet(self._folder(kind, batch, "counts"))
        priors.write.mode("overwrite").parquet(self._folder(kind, batch, "priors"))

    def _read(self, spark: SparkSession, kind: str, batches: list[int], table: str) -> DataFrame:
        schema = COUNT_SCHEMA if table == "counts" else PRIOR_SCHEMA
        return spark.read.schema(schema).parquet(*[self._folder(kind, b, table) for b in batches])

    def model_before(self, spark: SparkSession, batch: int) -> bayes.NaiveBayes:
        """Latest earlier snapshot plus the deltas that came after it."""
        snap, later = self._before(spark, batch, "priors")
        base = bayes.NaiveBayes(self._read(spark, "snapshot", [snap], "counts"),
                                self._read(spark, "snapshot", [snap], "priors"), self.max_rows, self.alpha)
        if not later:
            return base
        return bayes.add_counts(base, self._read(spark, "delta", later, "counts"),
                                self._read(spark, "delta", later, "priors"))

    def teach(self, spark: SparkSession, batch: int, features: DataFrame, gained: DataFrame | None = None) -> bayes.NaiveBayes:
        """Write the batch's own counts and return the model after it; ``gained`` are its sums by term, if they are known."""
        if gained is None:
            gained = bayes.class_sums(unit_terms(features, self.model_before(spark, batch)), [MODEL, "term"], F.col("x"))
        counts = gained.withColumn("idf", F.lit(None).cast("double"))
        self._write("delta", batch, counts.select(MODEL, "term", "idf", "w_ham", "w_spam"),
                    bayes.class_counts(features))
        after = self.model_before(spark, batch + 1)
        if (batch + 1) % COMPACT_EVERY == 0:
            self._write("snapshot", batch, after.counts, after.priors)
        return after


@dataclass(frozen=True)
class CatalogueState(BatchState):
    """The retraining catalogue: entries as mergeable rows per micro-batch, each text stored once.

    An entry is a key, two numbers and what its first and its last event say; texts lie in a table
    of their own by key, so neither a delta nor a snapshot grows with the length of the texts, and
    a text taught again is not written again.
    """

    def add(self, batch: int, events: DataFrame, posterior: str, texts: DataFrame | None = None) -> None:
        """Write the entries that the events (seq, timestamp, texto, label, idioma, posterior) of a batch add.

        With ``texts`` (clave, texto) the events carry the key in place of the text.
        """
        spark, rows = events.sparkSession, events
        if texts is None:
            rows = events.withColumn("texto", tx.sanitise(F.col("texto"))).filter(F.col("texto") != "")
            rows = rows.withColumn("clave", text_key(F.col("texto")))
        first = F.struct(F.upper("idioma").alias("idioma"), F.col("timestamp").alias("fecha"))
        last = F.struct("label", F.col("timestamp").alias("fecha"), F.col(posterior).alias("p"))
        entries = rows.groupBy("clave").agg(
            F.count(F.lit(1)).alias("veces_entrenado"), F.min("seq").alias("primero"), F.max("seq").alias("ultimo"),
            F.min_by(first, F.col("seq")).alias("primera"), F.max_by(last, F.col("seq")).alias("ultima"))
        if texts is None:
            texts = rows.groupBy("clave").agg(F.any_value("texto").alias("texto"))
        known = [self._folder("delta", b, "texts") for b in self._all(spark, batch)]
        if known:
            texts = texts.join(spark.read.schema(TEXT_SCHEMA).parquet(*known).select("clave"), "clave", "left_anti")
        texts.write.mode("overwrite").parquet(self._folder("delta", batch, "texts"))
        entries.write.mode("overwrite").parquet(self._folder("delta", batch, "entries"))
        if (batch + 1) % COMPACT_EVERY == 0:
            self.entries(spark, batch + 1).write.mode("overwrite").parquet(self._folder("snapshot", batch, "entries"))

    def _all(self, spark: SparkSession, batch: int) -> list[int]:
        return [b for b in range(batch) if path_exists(spark, self._folder("delta", b, "entries") + "/_SUCCESS")]

    def entries(self, spark: SparkSession, batch: int) -> DataFrame:
        """The entries after all batches before ``batch``."""
        snap, later = self._before(spark, batch, "entries")
        paths = [self._folder("snapshot", snap, "entries")] if snap is not None else []
        rows = spark.read.schema(ENTRY_SCHEMA).parquet(*paths, *[self._folder("delta", b, "entries") for b in later])
        return rows.groupBy("clave").agg(
            F.sum("veces_entrenado").alias("veces_entrenado"), F.min("primero").alias("primero"), F.max("ultimo").alias("ultimo"),
            F.min_by("primera", "primero").alias("primera"), F.max_by("ultima", "ultimo").alias("ultima"))

    def current(self, spark: SparkSession, batch: int, stretch: int = history.STRETCH) -> DataFrame:
        """The catalogue after all batches before ``batch``, with ids in order of first arrival."""
        out = history.numbered(self.entries(spark, batch).withColumn("_all", F.lit(1)), ["_all"], "primero", stretch)
        texts = spark.read.schema(TEXT_SCHEMA).parquet(*[self._folder("delta", b, "texts") for b in self._all(spark, batch)])
        return out.join(texts, "clave").select(
            F.format_string("fb_%03d", "numero").alias("id"), F.col("primera.fecha").alias("fecha"),
            F.col("primera.idioma").alias("idioma"), history.label_name(F.col("ultima.label")).alias("etiqueta"),
            F.col("ultima.label").alias("label"), "texto", "veces_entrenado",
            F.when(F.col("veces_entrenado") > 1, F.col("ultima.fecha")).alias("ultima_fecha"),
            F.col("ultima.p").alias("ultima_probabilidad_spam"))


def unit_terms(features: DataFrame, model: bayes.NaiveBayes) -> DataFrame:
    """(modelo, id, Label_Code, term, x): known terms of taught mails under the frozen idf."""
    return bayes.tfidf(features, model.counts, model.max_rows, "Label_Code")


def _taught_model():
    return F.when(F.lower("idioma") == "en", "en").otherwise("es").alias(MODEL)


def taught_features(events: DataFrame) -> DataFrame:
    """Features of taught mails under the model of their language (English, else Spanish).

    An event is a sample of its own, so its arrival number is its row id.
    """
    rows = events.withColumn("texto", tx.sanitise(F.col("texto"))).filter(F.col("texto") != "")
    routed = rows.select(
        _taught_model(), F.col("seq").alias(ID),
        F.col("label").alias("Label_Code"), tx.clean_text(F.col("texto")).alias("texto_procesado"))
    return score.routed_features(routed, "Label_Code")


def keyed_batch(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, texts), written: the events with the key ``clave`` in place of the text, and every different text once.

    Texts are trimmed and blank ones refused.  Copies are left out where they are read, so no text moves per event.
    """
    rows = compute_once(batch, texto=tx.sanitise(F.col("texto"))).filter(F.col("texto") != "")
    rows = rows.withColumn("clave", text_key(F.col("texto")))
    texts = rows.select("clave", "texto").mapInArrow(_first_of_each(), "clave binary, texto string")
    return write_stage(rows.drop("texto"), "batch"), write_stage(texts.dropDuplicates(["clave"]), "batch_texts")


def _first_of_each():
    """Rows of a partition whose key has not come before; holds 16 bytes a different text."""

    def run(batches):
        import pyarrow as pa

        seen = set()
        for batch in batches:
            new = []
            for key in batch.column("clave").to_pylist():
                new.append(key not in seen)
                seen.add(key)
            yield batch.filter(pa.array(new, pa.bool_()))

    return run


def taught_texts(events: DataFrame, texts: DataFrame) -> DataFrame:
    """(modelo, id = key, texto_procesado): the cleaned texts of keyed events, once per model and text."""
    pairs = events.select(MODEL, "clave").distinct().join(texts, "clave")
    return pairs.select(MODEL, F.col("clave").alias(ID), tx.clean_text(F.col("texto")).alias("texto_procesado"))


def _write_log(scored: DataFrame, texts: DataFrame, path: str) -> None:
    records = history.with_texts(history.feedback_records(scored), texts).drop("clave")
    records.write.mode("overwrite").option("compression", "lz4").option("maxRecordsPerFile", LOG_ROWS).json(path)


def learn(events: DataFrame, state: ModelState, log_path: str, checkpoint: str,
          catalogue: CatalogueState | None = None) -> StreamingQuery:
    """Teach the model with each micro-batch, append the history records and keep the catalogue.

    Every mail is scored again by the model that has just learnt it, in arrival order; neither
    scores nor counts depend on the batches.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with stage_scope(spark):
            rows, texts = keyed_batch(batch)
            taught = rows.select(_taught_model(), F.col("seq").alias(ID), F.col("label").alias("Label_Code"), "clave")
            before = state.model_before(spark, batch_id)
            vocab, cells = online.text_cells(taught_texts(taught, texts), before)
            taught = online.weighted_events(taught, cells)
            known = online.stretch_texts(taught, cells)
            added = online.stretch_gains(known)
            state.teach(spark, batch_id, taught, online.gains(added, vocab))
            after = online.posterior_after_each(taught, vocab, cells, before, known=(known, added))
            after = after.select(F.col(ID).alias("seq"), "p_posterior")
            scored = write_stage(rows.drop("p_posterior").join(after, "seq"), "taught_scores")
            _write_log(scored, texts, f"{log_path}/batch={batch_id}")
            if catalogue is not None:
                catalogue.add(batch_id, scored, "p_posterior", texts)

    return (events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def keep_catalogue(events: DataFrame, state: CatalogueState, checkpoint: str, posterior: str) -> StreamingQuery:
    """Keep the catalogue of events that carry their score after teaching in ``posterior``."""

    def add(batch: DataFrame, batch_id: int) -> None:
        with stage_scope(batch.sparkSession):
            rows, texts = keyed_batch(batch)
            state.add(batch_id, rows, posterior, texts)

    return (events.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def batches_done(run: StreamingQuery) -> int:
    """The number after the last micro-batch of a finished run."""
    return max((p["batchId"] for p in run.recentProgress), default=-1) + 1
