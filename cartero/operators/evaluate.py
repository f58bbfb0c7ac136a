"""Evaluation of scored mails: (modelo, id, Label_Code, p_spam[, pred])."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartero.functions.expressions import ratio
from cartero.operators.features import ID, MODEL
from cartero.sources.mail import write_stage

STRETCHES = 256     # score stretches of the two-level prefix sum


def _cells() -> list[Column]:
    y, p = F.col("Label_Code"), F.col("pred")
    return [F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp")]


def confusion_matrix(pred: DataFrame) -> DataFrame:
    """One row per model with tn, fp, fn, tp."""
    return pred.groupBy(MODEL).agg(*_cells())


def metric_columns() -> dict[str, Column]:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return {"accuracy": F.round(ratio(tp + tn, tp + tn + fp + fn), 4),
            "precision": F.round(ratio(tp, tp + fp), 4),
            "recall": F.round(ratio(tp, tp + fn), 4),
            "f1": F.round(ratio(2 * tp, 2 * tp + fp + fn), 4)}


def classification_metrics(pred: DataFrame) -> DataFrame:
    cells = confusion_matrix(pred)
    return cells.select(MODEL, (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("n"),
                        *[c.alias(k) for k, c in metric_columns().items()])


def cumulative(scored: DataFrame) -> DataFrame:
    """(modelo, p_spam, pos, neg, tp, fp, p, n): counts at or above each distinct score.

    Rows with one score are merged first.  The prefix sum then has two levels:
    scores are cut into stretches of equal row counts, stretch totals are summed
    up (at most 257 rows a model), and only inside a stretch is there a sort.
    """
    groups = write_stage(scored.groupBy(MODEL, "p_spam").agg(
        F.count_if(F.col("Label_Code") == 1).alias("pos"),
        F.count_if(F.col("Label_Code") == 0).alias("neg")), "scores")
    marks = [i / STRETCHES for i in range(1, STRETCHES)]
    cuts = groups.groupBy(MODEL).agg(
        F.array_distinct(F.percentile_approx("p_spam", marks, 10_000)).alias("_cuts"))
    placed = groups.join(F.broadcast(cuts), MODEL).withColumn(
        "_s", F.size(F.filter("_cuts", lambda c: c > F.col("p_spam")))).drop("_cuts")
    totals = placed.groupBy(MODEL, "_s").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    before = Window.partitionBy(MODEL).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(MODEL)
    base = totals.select(MODEL, "_s", F.coalesce(F.sum("_p").over(before), F.lit(0)).alias("_tp"),
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_fp"),
                         F.sum("_p").over(whole).alias("p"), F.sum("_n").over(whole).alias("n"))
    inside = Window.partitionBy(MODEL, "_s").orderBy(F.desc("p_spam")).rowsBetween(
        Window.unboundedPreceding, 0)
    return placed.join(F.broadcast(base), [MODEL, "_s"]).select(
        MODEL, "p_spam", "pos", "neg", (F.col("_tp") + F.sum("pos").over(inside)).alias("tp"),
        (F.col("_fp") + F.sum("neg").over(inside)).alias("fp"), "p", "n")


def ranking_metrics(scored: DataFrame) -> DataFrame:
    """(modelo, roc_auc, pr_auc): ties count half; precision steps; 0 with one class only."""
    c = cumulative(scored)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    steps = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")).cast("double"))
    out = c.groupBy(MODEL).agg(area.alias("_a"), steps.alias("_s"), F.max("p").alias("_p"),
                               F.max("n").alias("_n"))
    both = (F.col("_p") > 0) & (F.col("_n") > 0)
    return out.select(
        MODEL, F.round(F.when(both, ratio(F.col("_a"), F.col("_p") * F.col("_n"))).otherwise(0.0), 4)
        .alias("roc_auc"),
        F.round(F.when(both, ratio(F.col("_s"), F.col("_p"))).otherwise(0.0), 4).alias("pr_auc"))


def roc_curve(scored: DataFrame) -> DataFrame:
    return cumulative(scored).select(MODEL, F.col("p_spam").alias("umbral"),
                                     ratio(F.col("fp"), F.col("n")).alias("fpr"),
                                     ratio(F.col("tp"), F.col("p")).alias("tpr"))


def pr_curve(scored: DataFrame) -> DataFrame:
    return cumulative(scored).select(MODEL, F.col("p_spam").alias("umbral"),
                                     ratio(F.col("tp"), F.col("p")).alias("recall"),
                                     ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))


def evaluate(pred: DataFrame) -> DataFrame:
    """The full metric row per model."""
    return classification_metrics(pred).join(ranking_metrics(pred), MODEL)


def first_errors(pred: DataFrame, limit: int = 100, ident: str = ID) -> DataFrame:
    """The ``limit`` wrong mails that ``error_audit`` lists, before their texts are fetched."""
    return pred.filter(F.col("pred") != F.col("Label_Code")).orderBy(ident).limit(limit)


def error_audit(pred: DataFrame, text: str, limit: int = 100, ident: str = ID) -> DataFrame:
    """First wrong mails (a report of ``limit`` rows)."""
    return first_errors(pred, limit, ident).select(
        ident, F.col(text).alias("texto"), F.col("Label_Code").alias("real"),
        F.round("p_spam", 3).alias("p_spam"), "pred",
        F.when(F.col("pred") == 1, "FP").otherwise("FN").alias("tipo"))


def error_totals(pred: DataFrame) -> DataFrame:
    cells = confusion_matrix(pred)
    return cells.select(MODEL, F.col("fp").alias("falsos_positivos"), F.col("fn").alias("falsos_negativos"))


def metrics_long(metrics: DataFrame, columns: list[str]) -> DataFrame:
    """Wide metric rows -> (modelo, metrica, valor, valor_x100)."""
    long = metrics.unpivot([MODEL], columns, "metrica", "valor")
    return long.withColumn("valor_x100", F.round(F.col("valor") * 100, 2))
