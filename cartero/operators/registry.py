"""Trained models as whole, versioned units.

A unit is a model with all that belongs to it: its counts, its decision thresholds, the metrics it
was accepted with and its strongest terms.  ``commit`` writes the tables of a new version
first and its manifest last; a reader takes the newest version that has a manifest, so a
half-written version is never read, and a reader of an old version is not disturbed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartero.operators import bayes
from cartero.operators.features import MODEL
from cartero.sources.mail import path_exists

TABLES = ("thresholds", "metrics", "terms")
MANIFEST = "version long, folder string, kind string"


@dataclass(frozen=True)
class ModelUnit:
    """A model with one threshold per ``modelo``, its metrics and its strongest terms."""

    model: bayes.NaiveBayes
    thresholds: DataFrame
    metrics: DataFrame
    terms: DataFrame
    version: int = 0

    def predict(self, features: DataFrame, *carry: str, decimals: int = 6) -> DataFrame:
        """(modelo, id, carried, p_spam, umbral, pred) by the unit's own thresholds."""
        scored = bayes.score(features, self.model, *carry).withColumn("p_spam", F.round("p_spam", decimals))
        scored = scored.join(F.broadcast(self.thresholds.select(MODEL, "umbral")), MODEL)  # one row per model
        return bayes.predict(scored, F.col("umbral"))


@dataclass(frozen=True)
class ModelStore:
    """Versions of a unit under ``path``."""

    path: str

    def versions(self, spark: SparkSession) -> list[int]:
        """The versions that are whole, oldest first."""
        if not path_exists(spark, f"{self.path}/manifests"):
            return []
        root = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests")
        found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
        names = [f.getPath().getName() for f in found]
        return sorted(int(n) for n in names if n.isdigit() and path_exists(spark, f"{self.path}/manifests/{n}/_SUCCESS"))

    def commit(self, unit: ModelUnit) -> int:
        """Write a new version and return its number.

        Two writers that take the same number write to folders of their own; the second to
        write the manifest fails there and takes the next number.
        """
        spark = unit.model.priors.sparkSession
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        unit.model.save(f"{folder}/model")
        for name in TABLES:
            getattr(unit, name).write.parquet(f"{folder}/{name}")
        while True:
            version = max(self.versions(spark), default=0) + 1
            row = spark.createDataFrame([(version, folder, "naive-bayes")], MANIFEST)
            try:
                row.coalesce(1).write.mode("error").parquet(f"{self.path}/manifests/{version}")
                return version
            except AnalysisException:
                if version not in self.versions(spark):  # a manifest that was begun and not ended: its number is given up
                    self._give_up(spark, version)

    def _give_up(self, spark: SparkSession, version: int) -> None:
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests/{version}")
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

    def load(self, spark: SparkSession, version: int | None = None) -> ModelUnit:
        """The newest whole version, or the one asked for."""
        known = self.versions(spark)
        if not known or version is not None and version not in known:
            raise FileNotFoundError(f"no whole version {'' if version is None else version} under {self.path}")
        number = known[-1] if version is None else version
        folder = spark.read.schema(MANIFEST).parquet(f"{self.path}/manifests/{number}").first()["folder"]
        tables = {name: spark.read.parquet(f"{folder}/{name}") for name in TABLES}
        return ModelUnit(bayes.NaiveBayes.load(spark, f"{folder}/model"), version=number, **tables)
