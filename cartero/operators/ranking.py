"""Top rows per group for large k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartero.sources.mail import write_stage


def top_per_group(df: DataFrame, group: str, weight: str, tie: str, k: int, rank: str = "rango") -> DataFrame:
    """The k rows of largest integer ``weight`` per group, ties by ``tie``, with their rank.

    A plain rank would sort a whole group in one task.  Rows are counted per
    weight first, which gives the smallest weight that can still be among the
    top k; what lies below is dropped before any sort.  The rest (the top rows
    and the ties at the border) is ranked in parts and the parts' winners once
    more, so the result is exact however many ties there are.
    """
    df = write_stage(df, "ranked")      # read twice: for the counts and for the rows
    cells = df.groupBy(group, weight).agg(F.count(F.lit(1)).alias("_m"))
    higher = Window.partitionBy(group).orderBy(F.desc(weight)).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_above", F.coalesce(F.sum("_m").over(higher), F.lit(0)))
    cuts = cells.filter(F.col("_above") < k).groupBy(group).agg(F.min(weight).alias("_cut"))
    rows = df.join(F.broadcast(cuts), group).filter(F.col(weight) >= F.col("_cut")).drop("_cut")

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc(weight), F.asc(tie)]
    rows = rows.withColumn("_part", F.pmod(F.hash(tie), F.lit(parts)))
    first = Window.partitionBy(group, "_part").orderBy(*order)
    rows = rows.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= k).drop("_part", "_r")
    last = Window.partitionBy(group).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(last)).filter(F.col(rank) <= k)
