"""Global ranks and running sums without an unpartitioned window over the data."""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.common import key_text
from ..session import cut
from .keyed import lookup_join

BUCKET_DIGITS = 4


def ordered_parts(df: DataFrame, order: list[Column]) -> DataFrame:
    """Range-partition and sort by a unique order, then freeze the layout with a checkpoint.

    `_part` is the partition number, `_seq` the row's place inside it. Without the
    checkpoint a second evaluation could sample other range bounds.
    """
    laid = cut(df.repartitionByRange(*order).sortWithinPartitions(*order))
    return laid.withColumn("_part", F.spark_partition_id()).withColumn(
        "_seq", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    )


def _offsets(parts: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Exclusive prefix sums per partition: one row per shuffle partition, so small."""
    per_part = parts.groupBy("_part").agg(*[F.sum(c).alias(f"_sum_{k}") for k, c in sums.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(
        "_part", *[F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)).alias(f"_off_{k}") for k in sums]
    )


def row_numbers(df: DataFrame, order: list[Column], name: str = "rn") -> DataFrame:
    """1-based global position under a unique order."""
    parts = ordered_parts(df, order)
    off = _offsets(parts, {"n": F.lit(1)})
    out = parts.join(F.broadcast(off), "_part")
    return out.withColumn(name, F.col("_off_n") + F.col("_seq") + 1).drop("_part", "_seq", "_off_n")


def first_keys(df: DataFrame, size: int, order: list[Column]) -> list[tuple]:
    """The order key of every size-th row. Only keys are numbered and kept; one key per `size` rows comes to the driver."""
    names = [f"_k{i}" for i in range(len(order))]
    keys = row_numbers(df.select(*[c.alias(n) for c, n in zip(order, names)]), [F.col(n) for n in names])
    return [tuple(r) for r in keys.where((F.col("rn") - 1) % size == 0).orderBy("rn").select(*names).collect()]


def shard_of(bounds: list[tuple], spark: SparkSession, order: list[Column]) -> Column:
    """Number of the last of `first_keys` at or before a row's key."""
    shared = spark.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def one_key(keys: pd.Series) -> pd.Series:
        firsts = pd.Series([b[0] for b in shared.value]).to_numpy()
        return pd.Series(firsts.searchsorted(keys.to_numpy(), "right") - 1, dtype="int32")

    @F.pandas_udf("int")
    def many_keys(keys: pd.DataFrame) -> pd.Series:
        rows = zip(*[keys[c].astype(object) for c in keys.columns])
        return pd.Series([bisect_right(shared.value, k) - 1 for k in rows], dtype="int32")

    return one_key(order[0]) if len(order) == 1 else many_keys(F.struct(*[c.alias(f"_k{i}") for i, c in enumerate(order)]))


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Exclusive running sums under a unique order, one output column per entry."""
    parts = ordered_parts(df, order)
    off = _offsets(parts, sums)
    inside = Window.partitionBy("_part").orderBy("_seq").rowsBetween(Window.unboundedPreceding, -1)
    out = parts.select(
        "*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_in_{k}") for k, c in sums.items()]
    ).join(F.broadcast(off), "_part")
    for k in sums:
        out = out.withColumn(k, F.col(f"_in_{k}") + F.col(f"_off_{k}")).drop(f"_in_{k}", f"_off_{k}")
    return out.drop("_part", "_seq")


def group_row_numbers(df: DataFrame, keys: list[str], order: list[Column], row_id: str,
                      name: str = "rn") -> DataFrame:
    """1-based position inside each group; a hot group is spread over many range partitions."""
    numbered = row_numbers(df, [*[F.col(k) for k in keys], *order], "_global")
    starts = numbered.groupBy(*keys).agg(
        F.min("_global").alias("_start"), F.count(F.lit(1)).alias("_members")
    )
    out = lookup_join(numbered, starts, keys, "left")
    return out.withColumn(name, F.col("_global") - F.col("_start") + 1).drop(
        "_global", "_start", "_members"
    )


def with_hash_key(df: DataFrame, seed, id_cols: list[str]) -> DataFrame:
    """Seeded md5 order key and its bucket (first hex digits, so evenly filled)."""
    return df.withColumn("_h", F.md5(key_text(seed, *[F.col(c) for c in id_cols]))).withColumn(
        "_bucket", F.substring("_h", 1, BUCKET_DIGITS)
    )


def _bucket_offsets(keyed: DataFrame, within: list[str] | None = None) -> DataFrame:
    """Rows before each hash bucket: at most 16**BUCKET_DIGITS rows per `within` group."""
    within = within or []
    counts = keyed.groupBy(*within, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *within, "_bucket", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))


def hash_rank(df: DataFrame, seed, id_cols: list[str], name: str = "rn",
              within: list[str] | None = None) -> DataFrame:
    """1-based position in a seeded shuffle, overall or inside each `within` group.

    The same for any partitioning. A hot group is still spread over its hash buckets.
    """
    keys = [*(within or []), "_bucket"]
    keyed = with_hash_key(df, seed, id_cols)
    w = Window.partitionBy(*keys).orderBy("_h", *id_cols)
    ranked = keyed.withColumn("_in", F.row_number().over(w))
    offsets = _bucket_offsets(keyed, within)
    if within:
        out = lookup_join(ranked, offsets, keys)
    else:
        out = ranked.join(F.broadcast(offsets), keys)
    return out.withColumn(name, F.col("_before") + F.col("_in")).drop("_h", "_bucket", "_in", "_n", "_before")


def hash_first(df: DataFrame, n, seed, id_cols: list[str], flag: str = "chosen") -> DataFrame:
    """Flag exactly the n rows that come first in a seeded shuffle.

    Whole buckets are decided by the bucket histogram; only the one bucket holding the
    n-th row is sorted. `n` may be an int or a column over `_total`.
    """
    keyed = with_hash_key(df, seed, id_cols)
    hist = _bucket_offsets(keyed).withColumn("_total", F.sum("_n").over(Window.partitionBy()))
    marks = hist.withColumn("_need", n if isinstance(n, Column) else F.lit(n))
    rows = keyed.join(F.broadcast(marks), "_bucket")
    split_here = (F.col("_before") < F.col("_need")) & (F.col("_before") + F.col("_n") > F.col("_need"))
    whole = rows.where(~split_here).withColumn(flag, F.col("_before") + F.col("_n") <= F.col("_need"))
    w = Window.partitionBy("_bucket").orderBy("_h", *id_cols)
    edge = rows.where(split_here).withColumn(
        flag, F.col("_before") + F.row_number().over(w) <= F.col("_need")
    )
    return whole.unionByName(edge).drop("_h", "_bucket", "_n", "_before", "_total", "_need")


def group_running_sums(df: DataFrame, keys: list[str], order: list[Column], row_id: str,
                       sums: dict[str, Column]) -> DataFrame:
    """Exclusive running sums inside each group, without sorting a group in one task."""
    run = running_sums(df, [*[F.col(k) for k in keys], *order], sums)
    first = F.struct(*order)
    starts = run.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_members"), *[F.min_by(k, first).alias(f"_start_{k}") for k in sums])
    out = lookup_join(run, starts, keys, "left")
    for k in sums:
        out = out.withColumn(k, F.col(k) - F.col(f"_start_{k}")).drop(f"_start_{k}")
    return out.drop("_members")
