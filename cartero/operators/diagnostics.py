"""The numbers behind the corpus charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def length_histogram(df: DataFrame, value: str, by: str, bins: int = 60) -> DataFrame:
    """(class, bin, lower edge, count) with log10-spaced bins over the whole range."""
    rows = df.select(by, F.col(value).alias("_v")).filter(F.col("_v") > 0)
    span = rows.agg(F.log10(F.min("_v").cast("double")).alias("_lo"), F.log10(F.max("_v").cast("double")).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    at = F.floor(F.try_divide(F.round(F.log10(F.col("_v").cast("double")) - F.col("_lo"), 9), width))
    binned = rows.crossJoin(F.broadcast(span)).withColumn(
        "bin", F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1)).cast("int"))
    return binned.groupBy(by, "bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("conteo")).select(
        by, "bin", F.round(F.pow(F.lit(10.0), F.col("_lo") + F.col("bin") * width), 4).alias("desde"), "conteo")


def log_density(df: DataFrame, value: str, by: str, grid: int = 50, resolution: float = 0.01) -> DataFrame:
    """(class, x, densidad): Gaussian kernel density of log10(value), Scott's bandwidth.

    Rows are folded into cells of ``resolution`` first, so the kernel runs over
    cells x grid points and not over rows x grid points.
    """
    cells = df.filter(F.col(value) > 0).select(
        by, F.round(F.log10(F.col(value).cast("double")) / resolution).cast("int").alias("_c")
    ).groupBy(by, "_c").agg(F.count(F.lit(1)).alias("_w"))
    x = F.col("_c") * resolution
    moments = cells.groupBy(by).agg(F.sum("_w").alias("_n"), F.sum(F.col("_w") * x).alias("_s"),
                                    F.sum(F.col("_w") * x * x).alias("_ss"), F.min("_c").alias("_lo"),
                                    F.max("_c").alias("_hi"))
    mean = F.col("_s") / F.col("_n")
    var = (F.col("_ss") - F.col("_n") * mean * mean) / F.greatest(F.col("_n") - 1, F.lit(1))
    bw = F.greatest(F.sqrt(F.greatest(var, F.lit(0.0))) * F.pow(F.col("_n").cast("double"), F.lit(-0.2)),
                    F.lit(resolution))
    params = moments.select(by, "_n", "_lo", "_hi", bw.alias("_bw"))
    point = (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("i") / float(grid - 1)) * resolution
    z = (x - F.col("x")) / F.col("_bw")
    kernel = F.col("_w") * F.exp(-0.5 * z * z) / (F.col("_n") * F.col("_bw") * F.sqrt(F.lit(2.0) * F.pi()))
    points = params.select("*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i")).withColumn("x", point)
    return cells.join(F.broadcast(points), by).groupBy(by, "i", "x").agg(F.sum(kernel).alias("densidad")).select(
        by, F.col("i").alias("punto"), F.round("x", 6).alias("x"), F.round("densidad", 6).alias("densidad"))


def boxplot(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles and 1.5 IQR whiskers by class.

    Lengths are counted per distinct value first; the quartiles and whiskers
    then run over at most as many rows as there are lengths.
    """
    cells = df.groupBy(by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_w"))
    q = cells.groupBy(by).agg(F.expr("percentile(_v, array(0.25, 0.5, 0.75), _w)").alias("_q"),
                              F.sum("_w").alias("n"))
    q = q.select(by, "n", *[F.col("_q")[i].alias(x) for i, x in enumerate(("q1", "mediana", "q3"))])
    iqr: Column = F.col("q3") - F.col("q1")
    inside = (F.col("_v") >= F.col("q1") - 1.5 * iqr) & (F.col("_v") <= F.col("q3") + 1.5 * iqr)
    return cells.join(q, by).filter(inside).groupBy(by, "n", "q1", "mediana", "q3").agg(
        F.min("_v").alias("bigote_inf"), F.max("_v").alias("bigote_sup"))
