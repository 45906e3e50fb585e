"""Batch-table verbs: a batch is a DataFrame with a `row_id` that numbers its rows from 0."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keyed import with_totals
from .numbering import row_numbers


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select("row_id", *columns)


def pop(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(popped columns, rest); an unknown column is an error."""
    unknown = set(columns) - set(df.columns)
    if unknown:
        raise KeyError(f"no such columns: {sorted(unknown)}")
    return df.select("row_id", *columns), df.drop(*columns)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def pick_rows(df: DataFrame, index: DataFrame) -> DataFrame:
    """Rows in the order of an index table (position, row_id); repeats are allowed."""
    return index.join(df, "row_id").drop("row_id").withColumnRenamed("position", "row_id")


def slice_rows(df: DataFrame, start: int, end: int, step: int = 1) -> DataFrame:
    r = F.col("row_id")
    return df.where((r >= start) & (r < end) & ((r - start) % step == 0)).withColumn(
        "row_id", F.floor((r - start) / step))


def union_columns(a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns of both batches; shared columns must agree on every row and both must have the same rows."""
    shared = [c for c in a.columns if c in b.columns and c != "row_id"]
    own = [c for c in b.columns if c not in a.columns]
    right = b.select(F.col("row_id").alias("_row"), F.lit(1).alias("_b"), *[F.col(c).alias(f"_b_{c}") for c in shared], *own)
    both = a.withColumn("_a", F.lit(1)).join(right, F.col("row_id") == F.col("_row"), "full")
    same = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    for c in shared:
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    checked = F.when(same, F.col("row_id")).otherwise(F.raise_error(F.lit("batches differ")).cast("bigint"))
    return both.select(checked.alias("row_id"), *[c for c in a.columns if c != "row_id"], *own)


def concat(parts: list[DataFrame]) -> DataFrame:
    """Rows of all batches, numbered on in the given order."""
    out = None
    for i, p in enumerate(parts):
        tagged = p.withColumn("_b", F.lit(i))
        out = tagged if out is None else out.unionByName(tagged)
    return row_numbers(out, [F.col("_b"), F.col("row_id")], "_rn").withColumn("row_id", F.col("_rn") - 1).drop("_b", "_rn")


def chunk(df: DataFrame, chunks: int) -> DataFrame:
    """Adds `chunk`; the number of rows must be a multiple of `chunks`."""
    s = with_totals(df, [F.count(F.lit(1)).alias("_n")])
    uneven = F.raise_error(F.lit("rows do not divide into equal chunks")).cast("bigint")
    size = F.when(F.col("_n") % chunks == 0, F.floor(F.col("_n") / chunks)).otherwise(uneven)
    return s.withColumn("chunk", F.floor(F.col("row_id") / size)).drop("_n")


def split(df: DataFrame, size: int) -> DataFrame:
    """Adds `chunk` of at most `size` rows."""
    return df.withColumn("chunk", F.floor(F.col("row_id") / size))


def reorder(df: DataFrame, permutation: DataFrame) -> DataFrame:
    """`permutation`: position -> row_id; the picked row takes the position."""
    return pick_rows(df, permutation)


def inverse(permutation: DataFrame) -> DataFrame:
    return permutation.select(F.col("row_id").alias("position"), F.col("position").alias("row_id"))


def repeat(df: DataFrame, times: int, interleave: bool = True) -> DataFrame:
    """Every row `times` times, next to each other or as whole tiles."""
    s = with_totals(df, [F.count(F.lit(1)).alias("_n")]).withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    at = F.col("row_id") * times + F.col("_k") if interleave else F.col("_k") * F.col("_n") + F.col("row_id")
    return s.withColumn("row_id", at).drop("_n", "_k")


def repeat_each(df: DataFrame, times: str) -> DataFrame:
    """Every row as often as its own count says; zero drops it."""
    s = df.where(F.col(times) > 0).withColumn("_k", F.explode(F.sequence(F.lit(1), F.col(times).cast("int"))))
    return row_numbers(s, [F.col("row_id"), F.col("_k")], "_rn").withColumn("row_id", F.col("_rn") - 1).drop("_k", "_rn")


def pad_to_multiple(df: DataFrame, size: int) -> DataFrame:
    """Recycle rows from the head until the row count is a multiple of `size`; pads are flagged."""
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    pads = total.select("_n", F.explode(F.expr(
        f"CASE WHEN _n % {size} = 0 THEN array() ELSE sequence(0L, {size} - _n % {size} - 1) END")).alias("_i"))
    index = pads.select((F.col("_n") + F.col("_i")).alias("position"), (F.col("_i") % F.col("_n")).alias("row_id"))
    extra = pick_rows(df, index).withColumn("padded", F.lit(True))
    return df.withColumn("padded", F.lit(False)).unionByName(extra)


def unpad(df: DataFrame) -> DataFrame:
    return df.where(~F.col("padded")).drop("padded")


def unfold(df: DataFrame, columns: list[str], parts: int) -> DataFrame:
    """Cut array columns into `parts` equal pieces, one row each; other columns repeat."""
    s = df.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    for c in columns:
        size = F.floor(F.size(c) / parts).cast("int")
        s = s.withColumn(c, F.slice(c, F.col("_k") * size + 1, size))
    return s.withColumn("row_id", F.col("row_id") * parts + F.col("_k")).drop("_k")


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """A batch from any table: `row_id` from a unique order."""
    return row_numbers(df, [F.col(c) for c in order], "_rn").withColumn("row_id", F.col("_rn") - 1).drop("_rn")
