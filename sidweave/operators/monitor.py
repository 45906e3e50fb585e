"""Training-log monitoring over packed rows and step logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def source_loss(packs: DataFrame, loss: str = "loss") -> DataFrame:
    """Loss per source of packed rows (sample_idx, sources, loss, loss_mask); padding tokens (-1) do not count."""
    z = F.arrays_zip(F.col("sample_idx").alias("i"), F.col(loss).alias("l"), F.col("loss_mask").alias("m"))
    t = packs.select("sources", F.explode(z).alias("t")).where("t.i >= 0")
    by = t.select(F.get("sources", F.col("t.i")).alias("source"), "t.l", "t.m")
    return by.groupBy("source").agg(
        F.count(F.lit(1)).alias("tokens"), F.sum((F.col("m") != 0).cast("int")).alias("valid_tokens"),
        (F.sum("l") / (F.count(F.lit(1)) + F.lit(1e-6))).alias("loss"))


def source_ratios(packs: DataFrame) -> DataFrame:
    """Share of samples and of tokens per source."""
    samples = packs.select(F.posexplode("sources").alias("i", "source"), F.col("sample_idx"))
    per = samples.select("source", F.size(F.filter("sample_idx", lambda x: x == F.col("i"))).alias("n"))
    by = per.groupBy("source").agg(F.count(F.lit(1)).alias("samples"), F.sum("n").alias("tokens"))
    every = Window.partitionBy()  # one row per source
    return by.select("source", "samples", "tokens", (F.col("samples") / F.sum("samples").over(every)).alias("sample_ratio"),
                     (F.col("tokens") / F.sum("tokens").over(every)).alias("token_ratio"))


def token_kind_loss(packs: DataFrame, loss: Column, itemic: Column) -> DataFrame:
    """Mean loss over code tokens and over text tokens."""
    t = packs.select(F.explode(F.arrays_zip(loss.alias("l"), itemic.alias("m"))).alias("t"))
    m, x = F.col("t.m"), F.col("t.l")
    return t.agg((F.sum(m * x) / (F.sum(m) + 1e-6)).alias("itemic_loss"),
                 (F.sum((1 - m) * x) / (F.sum(1 - m) + 1e-6)).alias("text_loss"))


def period_aggregates() -> list[Column]:
    """Counters of one logging period over step rows (loss, tokens, samples, valid_tokens, seconds)."""
    return [
        F.count(F.lit(1)).alias("steps"), F.avg("loss").alias("loss"), F.sum("tokens").alias("tokens"),
        F.sum("samples").alias("samples"), F.sum("valid_tokens").alias("valid_tokens"),
        F.sum("seconds").alias("seconds"),
    ]


def with_rates(periods: DataFrame, devices: int) -> DataFrame:
    s = F.col("seconds")
    return periods.select(
        "*", (s / F.col("steps")).alias("sec_per_step"), F.try_divide(F.col("tokens"), s * devices).alias("tokens_per_sec"),
        F.try_divide(F.col("samples"), s * devices).alias("samples_per_sec"),
        F.try_divide(F.col("valid_tokens"), F.col("tokens")).alias("valid_token_ratio"))


def period_counters(steps: DataFrame, every: int, devices: int) -> DataFrame:
    """One row per `every` steps."""
    period = F.floor(F.col("step") / every).alias("period")
    return with_rates(steps.groupBy(period).agg(*period_aggregates()), devices)
