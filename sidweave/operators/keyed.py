"""Joins that hold when one key carries a third of all rows.

There is one path for all sizes and no copying of tables beforehand. Catalyst broadcasts a side only if
its size, measured at run time, is under the session's threshold. Beyond it both sides shuffle on the key,
and adaptive execution (spark.sql.adaptive.skewJoin) cuts the partition of each hot key, however many
there are, into pieces that join the same entries of the other side in tasks of their own. By itself Spark leaves a hot
partition whole where splitting it would cost one more exchange (an aggregate on the join's keys follows); `session.prepare`
tells it to split there too.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch


def lookup_join(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join rows against a table with unique keys."""
    return rows.join(table, keys, how)


def bucketed(table: DataFrame, keys: list[str], buckets: int | None = None) -> DataFrame:
    """The table, written once in buckets of its keys (a table of the session's catalog, next to the checkpoints).

    Joins on all of these keys then read its buckets as they lie: only the other side moves, however often the table is
    used. `buckets` defaults to the shuffle partitions, so that the other side arrives in the same number.
    """
    spark = table.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = table.write.format("parquet").bucketBy(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortBy(*keys)
    writer.option("path", scratch(spark, name)).saveAsTable(name)
    return spark.table(name)


def with_group_stats(rows: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
    """rows + aggregates of their group + `group_rows`.

    A window over the key would put a hot group into one task; the statistics come from a partially
    aggregated groupBy and are joined back.
    """
    stats = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows"), *aggs)
    return lookup_join(rows, stats, keys, "left")


def with_totals(rows: DataFrame, aggs: list[Column], source: DataFrame | None = None) -> DataFrame:
    """rows + global aggregates; the joined side is a single row by construction."""
    one = (source if source is not None else rows).agg(*aggs)
    return rows.crossJoin(F.broadcast(one))
