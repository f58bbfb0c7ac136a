"""Connected components of a table of links: alternating large-star and small-star steps.

Every step is a grouped minimum joined back to the links, so a node with a third
of all links is pre-aggregated and its rows are split by the skew join.  Each round
is written to the shared folder.  No link, node or component reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartero.llm.common import discard, sized, stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id with a link: the smallest id it reaches.

    ``links`` has two integer columns; order, repeats and self-links do not matter.
    """
    a, b = links.columns
    spark, n = links.sparkSession, links.count()
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    old: list = []
    edges = stage(sized(edges, n), "links", old)
    state = _state(edges)
    while state[0]:
        new: list = []
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = stage(sized(least, 2 * n), "star", old)
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(sized(large, 2 * n), "large", old)
        least = stage(sized(large.groupBy("u").agg(F.min("v").alias("m")), 2 * n), "star", old)
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = stage(sized(small, 2 * n), "links", new)
        discard(spark, old)
        old, before, state = new, state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots).distinct()
