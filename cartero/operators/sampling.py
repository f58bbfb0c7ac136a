"""Deterministic samples, splits and folds.

Rows are ordered by a hash of their id.  A sample of n rows per class is "hash
position up to the n-th smallest", so one cut point per class is all that is
needed: it is found on narrow (class, hash, id) rows and the corpus itself is
only filtered, never shuffled or ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartero.functions.expressions import hash_order

ID = "message_id"
BUCKET_BITS = 20      # 2**32 hash positions in 4096 buckets


def _positions(df: DataFrame, strata: Column, ident: str, seed: int | str) -> DataFrame:
    pos = df.select(strata.alias("_c"), hash_order(F.col(ident), seed).alias("_h"),
                    F.col(ident).alias("_id"))
    return pos.withColumn("_b", F.shiftright("_h", BUCKET_BITS))


def class_sizes(df: DataFrame, strata: Column) -> DataFrame:
    sizes = df.groupBy(strata.alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.withColumn("_all", F.sum("_n").over(Window.partitionBy()))


def cut_points(df: DataFrame, strata: Column, targets: DataFrame, ident: str = ID,
               seed: int | str = 42) -> DataFrame:
    """Hash position and id of the ``_k``-th row of each class.

    ``targets`` has (_c, _cut, _k).  Ranks are exact: rows are counted per
    (class, bucket), counts are prefix-summed, and only the buckets that hold a
    target rank are sorted (1/4096 of a class each, whatever its share).  The
    broadcast sides hold a row per class and cut; the strata are the classes of
    a labelled corpus, so these are a handful of rows.
    """
    pos = _positions(df, strata, ident, seed)
    sizes = pos.groupBy("_c", "_b").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy("_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    sizes = sizes.withColumn("_end", F.sum("_n").over(run))
    edge = sizes.join(F.broadcast(targets), "_c").filter(
        (F.col("_k") <= F.col("_end")) & (F.col("_k") > F.col("_end") - F.col("_n"))
    ).select("_c", "_b", "_cut", (F.col("_k") - F.col("_end") + F.col("_n")).alias("_r"))
    ranked = pos.join(F.broadcast(edge.select("_c", "_b").distinct()), ["_c", "_b"], "left_semi").withColumn(
        "_r", F.row_number().over(Window.partitionBy("_c", "_b").orderBy("_h", "_id")))
    return ranked.join(F.broadcast(edge), ["_c", "_b", "_r"]).select(
        "_c", "_cut", F.struct("_h", "_id").alias("_at"))


def _with_cuts(df: DataFrame, strata: Column, targets: DataFrame, ident: str, seed: int | str) -> DataFrame:
    """df plus ``_cuts``: the cut points its row lies beyond (null: class without a cut)."""
    cuts = cut_points(df, strata, targets, ident, seed).groupBy("_c").agg(
        F.collect_list(F.struct("_cut", "_at")).alias("_pts"))
    here = F.struct(hash_order(F.col(ident), seed).alias("_h"), F.col(ident).alias("_id"))
    return (df.withColumn("_c", strata).join(F.broadcast(cuts), "_c", "left")
            .withColumn("_past", F.size(F.filter("_pts", lambda p: here > p["_at"])))
            .drop("_pts"))


def _take(df: DataFrame, strata: Column, sizes: DataFrame, ident: str, seed: int | str) -> DataFrame:
    """First ``_k`` rows per class; classes with ``_k`` = 0 give none."""
    targets = sizes.filter("_k > 0").select("_c", F.lit(1).alias("_cut"), "_k")
    out = _with_cuts(df, strata, targets, ident, seed)
    return out.filter(F.col("_past") == 0).drop("_c", "_past")


def strata_of(df: DataFrame) -> Column:
    for name in ("Category", "Label_Code"):
        if name in df.columns:
            return F.col(name)
    return F.lit("all")


def stratified_sample(df: DataFrame, n: int, ident: str = ID, seed: int | str = 42) -> DataFrame:
    """About n rows with class shares kept: max(1, round-half-even(n * share)) per class."""
    if not n or n <= 0:
        return df
    strata = strata_of(df)
    sizes = class_sizes(df, strata)
    wanted = F.greatest(F.lit(1), F.bround(F.lit(float(n)) * F.col("_n") / F.col("_all")).cast("long"))
    k = F.when(F.lit(n) >= F.col("_all"), F.col("_n")).otherwise(F.least(wanted, F.col("_n")))
    return _take(df, strata, sizes.withColumn("_k", k), ident, seed)


def balanced_sample(df: DataFrame, n: int, ident: str = ID, seed: int | str = 42) -> DataFrame:
    """min(class size, n // 2) rows per class."""
    strata = strata_of(df)
    sizes = class_sizes(df, strata).withColumn("_k", F.least(F.col("_n"), F.lit(n // 2)))
    return _take(df, strata, sizes, ident, seed)


def random_sample(df: DataFrame, n: int, ident: str = ID, seed: int | str = 42) -> DataFrame:
    """n rows, same rows for the same seed."""
    strata = F.lit("all")
    sizes = class_sizes(df, strata).withColumn("_k", F.least(F.col("_n"), F.lit(n)))
    return _take(df, strata, sizes, ident, seed)


def stratified_split(df: DataFrame, fractions: dict[str, float], ident: str = ID,
                     seed: int | str = 42, column: str = "parte") -> DataFrame:
    """Label rows with the part they fall into, class shares kept.

    ``fractions`` is ordered; each part but the last ends after
    round-half-even(cumulated fraction x class size) rows of a class.
    """
    names, total, strata = list(fractions), 0.0, strata_of(df)
    sizes, ends = class_sizes(df, strata), []
    for i, name in enumerate(names[:-1], start=1):
        total += fractions[name]
        ends.append(F.struct(F.lit(i).alias("_cut"),
                             F.bround(F.lit(total) * F.col("_n")).cast("long").alias("_k")))
    targets = sizes.select("_c", F.inline(F.array(*ends)))
    empty = targets.filter("_k <= 0").groupBy("_c").agg(F.count(F.lit(1)).alias("_e"))
    out = _with_cuts(df, strata, targets.filter("_k > 0"), ident, seed)
    out = out.join(F.broadcast(empty), "_c", "left")
    part = F.greatest(F.col("_past"), F.lit(0)) + F.coalesce("_e", F.lit(0))
    return out.withColumn(column, F.get(F.array(*[F.lit(x) for x in names]), part)).drop(
        "_c", "_past", "_e")


def stratified_kfold(df: DataFrame, k: int = 3, ident: str = ID, seed: int | str = 42,
                     column: str = "pliegue") -> DataFrame:
    """Fold number 0..k-1: hash order cut into k equal stretches per class."""
    return stratified_split(df, {str(i): 1.0 / k for i in range(k)}, ident, seed, column) \
        .withColumn(column, F.col(column).cast("int"))


def shuffle(df: DataFrame, ident: str = ID, seed: int | str = 42) -> DataFrame:
    """Seeded permutation: ``posicion`` is the exact rank (from 1) in hash order.

    Rows are numbered inside buckets of hash positions, on ids alone, and bucket
    sizes are prefix-summed, so no task sorts everything.
    """
    pos = _positions(df, F.lit(0), ident, seed)
    sizes = pos.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    start = sizes.select("_b", F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("_h", "_id"))
    ranked = pos.join(start, "_b").select(F.col("_id").alias(ident), (F.col("_start") + inside).alias("posicion"))
    return df.join(ranked, ident)
