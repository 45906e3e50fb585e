"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def _star(pairs: DataFrame, small: bool) -> DataFrame:
    """One step over directed pairs (u, v). Minima come from partial aggregates and are joined back, so
    the neighbours of a hub are never gathered."""
    both = pairs if small else pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if small:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    if small:
        moved = both.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v) links -> (node, root): root is the smallest node reachable; only linked nodes appear."""
    pairs = cut(links.select("u", "v").where("u <> v").distinct())
    mark = None
    while True:
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == mark or state[0] == 0:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark, pairs = state, cut(_star(_star(pairs, small=False), small=True))
