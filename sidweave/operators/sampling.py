"""Exact sampling, splitting, shuffling, repetition and resampling.

Every order is a seeded md5 of a row id, so results do not depend on partitioning and a
lost task reproduces its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import hash_int
from ..session import cut
from .keyed import with_totals
from .numbering import hash_first, hash_rank, ordered_parts, row_numbers, running_sums


def sample_exact(df: DataFrame, n: int, seed, ids: list[str]) -> DataFrame:
    """Exactly min(n, rows) rows without replacement."""
    if n <= 0:
        raise ValueError("n must be positive")
    return hash_first(df, n, seed, ids, "_chosen").where("_chosen").drop("_chosen")


def split_exact(df: DataFrame, test_size: int, seed, ids: list[str]) -> DataFrame:
    """Adds `part`: exactly test_size rows 'test', the rest 'train'."""
    return hash_first(df, test_size, seed, ids, "_chosen").withColumn(
        "part", F.when(F.col("_chosen"), "test").otherwise("train")).drop("_chosen")


def split_ratio(df: DataFrame, ratio: float, seed, ids: list[str]) -> DataFrame:
    """Adds `part` by position in a seeded shuffle: the first floor(ratio * rows) are 'train'."""
    need = F.floor(F.lit(ratio) * F.col("_total"))
    return hash_first(df, need, seed, ids, "_chosen").withColumn(
        "part", F.when(F.col("_chosen"), "train").otherwise("test")).drop("_chosen")


def shuffled(df: DataFrame, seed, ids: list[str], name: str = "rn") -> DataFrame:
    """Position of every row in a seeded shuffle."""
    return hash_rank(df, seed, ids, name)


def corpus_split(tables: list[DataFrame], test_size: int, seed: int, ids: list[str]) -> DataFrame:
    """Union of chat tables, exact test split over the union, each part shuffled with its own seed."""
    merged = tables[0]
    for t in tables[1:]:
        merged = merged.unionByName(t)
    # The split and the two shuffles read their input several times: build the union once. The split adds a flag to it
    # from its own ids, so that is cheap to do again.
    parts = split_exact(cut(merged), test_size, seed, ids)
    train = hash_rank(parts.where("part = 'train'"), seed + 1000, ids)
    test = hash_rank(parts.where("part = 'test'"), seed + 2000, ids)
    return train.unionByName(test)


def cap_rows(df: DataFrame, max_samples: int, shuffle: bool, seed, row_id: str) -> DataFrame:
    """At most max_samples rows: a seeded choice, or the first by id."""
    if shuffle:
        return sample_exact(df, max_samples, seed, [row_id])
    return row_numbers(df, [F.col(row_id)], "_rn").where(F.col("_rn") <= max_samples).drop("_rn")


def split_positional(df: DataFrame, fraction: float, order: list[Column]) -> DataFrame:
    numbered = row_numbers(df, order)
    total = with_totals(numbered, [F.count(F.lit(1)).alias("_total")])
    return total.withColumn(
        "part", F.when(F.col("rn") <= F.floor(F.col("_total") * fraction), "first").otherwise("last")
    ).drop("_total")


def repeat_by_source(df: DataFrame, times: dict[str, int], source: str = "source") -> DataFrame:
    """Each row as often as its source asks; sources not listed appear once."""
    table = F.create_map(*[F.lit(x) for kv in times.items() for x in kv])
    k = F.coalesce(F.get(F.array(F.try_element_at(table, F.col(source))), 0), F.lit(1))
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), k)))


def expand_epochs(files: DataFrame, epochs: int, seed) -> DataFrame:
    """Every file once per epoch, reshuffled in each; `position` counts inside the epoch."""
    tagged = files.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    ranked = hash_rank(tagged, seed, ["epoch", "file"], "_at", within=["epoch"])
    return ranked.withColumn("position", F.col("_at") - 1).drop("_at")


def assign_workers(files: DataFrame, position: str, world: int, workers: int) -> DataFrame:
    """Round robin over world * workers slots: slot = rank * workers + worker."""
    slot = F.pmod(F.col(position), F.lit(world * workers))
    return files.withColumn("rank", F.floor(slot / workers).cast("int")).withColumn(
        "worker", (slot % workers).cast("int"))


def shuffle_key(uuid: Column, source: Column, epoch: Column) -> Column:
    """First 64 bits of md5(uuid, source, epoch) as 16 hex digits."""
    return F.substring(F.md5(F.concat(uuid, source, F.lit("@ep"), epoch.cast("string"))), 1, 16)


def duplicate_keys(rows: DataFrame) -> DataFrame:
    """Rows a hash-keyed buffer would overwrite: same uuid, source and epoch."""
    return rows.groupBy("uuid", "source", "epoch").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unread(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows whose (file, epoch, sample_index) is not in the ledger of finished samples."""
    return rows.join(ledger, ["file", "epoch", "sample_index"], "left_anti")


def append_ledger(ledger: DataFrame, done: DataFrame) -> DataFrame:
    keys = ["file", "epoch", "sample_index"]
    return ledger.select(*keys).unionByName(done.select(*keys)).distinct()


def resample_weights(rows: DataFrame, method: str = "pow", power: float = 2.0) -> DataFrame:
    """Adds `weight` from `score`."""
    s = F.col("score")
    if method == "pow":
        out = rows.withColumn("weight", F.pow(F.abs(s), F.lit(power)))
    elif method == "max_min":
        ext = with_totals(rows, [F.max("score").alias("_hi"), F.min("score").alias("_lo")])
        out = ext.withColumn("weight", F.when((s == F.col("_hi")) | (s == F.col("_lo")), 1.0).otherwise(0.0))
    elif method == "max_random":
        ext = with_totals(rows, [F.max("score").alias("_hi")])
        out = ext.withColumn("weight", F.when(s == F.col("_hi"), 0.4).otherwise(0.1))
    else:
        raise ValueError(f"unknown method {method}")
    return out.drop("_hi", "_lo").withColumn("weight", F.col("weight") + 1e-8)


def whole_weights(weighted: DataFrame, total_digits: int = 18) -> DataFrame:
    """Adds `units`: weights as whole numbers, in units of the power of ten that gives their sum `total_digits` digits;
    a weight under one unit counts as one."""
    total = weighted.agg(F.ceil(F.log10(F.sum("weight"))).alias("_digits"))
    scale = F.pow(F.lit(10.0), (F.lit(total_digits) - F.col("_digits")).cast("double"))
    scaled = weighted.crossJoin(F.broadcast(total))  # one row
    return scaled.withColumn("units", F.greatest(F.floor(F.col("weight") * scale), F.lit(1)).cast("decimal(20,0)")).drop("_digits")


def resample(rows: DataFrame, row_id: str, seed, **kw) -> DataFrame:
    """As many weighted draws with replacement as rows: (draw, row_id).

    Weights are whole numbers, so sums are exact in any order and any engine draws the same rows. Rows lie end to end
    on a line of their units; draw points are placed on it by 62 bits of hash. Rows and points are sorted together in
    range partitions and each point takes the last row start before it, carried over partition borders, so neither
    heavy nor tiny weights pile up.
    """
    weighted = cut(whole_weights(resample_weights(rows.select(row_id, "score"), **kw)).select(row_id, "units"))
    line = running_sums(weighted, [F.col(row_id)], {"start": F.col("units")})
    total = weighted.agg(F.sum("units").cast("decimal(20,0)").alias("_w"))
    high, low = (hash_int(seed, name, F.col(row_id)) for name in ("draw", "draw low"))
    bits = (F.shiftleft(F.shiftright(high, 1), 31) + F.shiftright(low, 1)).cast("decimal(19,0)")
    points = weighted.crossJoin(F.broadcast(total)).select(
        F.col(row_id).alias("draw"), bits.alias("_bits"), "_w").selectExpr("draw", f"CAST((_bits * _w) DIV CAST({1 << 62} AS DECIMAL(19, 0)) AS DECIMAL(38, 0)) AS x")
    both = line.select(F.col("start").cast("decimal(38,0)").alias("x"), F.lit(0).alias("kind"), F.col(row_id).alias("item")).unionByName(
        points.select("x", F.lit(1).alias("kind"), F.col("draw").alias("item")))
    parts = ordered_parts(both, [F.col("x"), F.col("kind"), F.col("item")])
    owner = F.when(F.col("kind") == 0, F.col("item"))
    inside = Window.partitionBy("_part").orderBy("_seq")
    last = parts.groupBy("_part").agg(F.max(F.when(F.col("kind") == 0, F.struct("_seq", "item"))).alias("_l"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select("_part", F.last("_l.item", ignorenulls=True).over(earlier).alias("_carry"))
    filled = parts.withColumn("_own", F.last(owner, ignorenulls=True).over(inside)).join(
        F.broadcast(carry), "_part")
    return filled.where("kind = 1").select(
        F.col("item").alias("draw"), F.coalesce("_own", "_carry").alias(row_id))
