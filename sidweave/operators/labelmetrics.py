"""Yes/no prediction metrics, utilisation roll-up and result bookkeeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import strip
from ..functions.sid import after_last_think
from .numbering import running_sums

# The answer characters of the label task.
YES = "是"
NO = "否"


def label_from_answer(answer: Column, yes: str = YES, no: str = NO) -> Column:
    """1 when the yes character occurs anywhere, else 0 for the no character, else -1."""
    return F.when(F.contains(answer, F.lit(yes)), 1).when(F.contains(answer, F.lit(no)), 0).otherwise(-1)


def positive_probability(generation: Column, yes: str = YES, no: str = NO) -> Column:
    """p(yes) / (p(yes) + p(no)) from the JSON after the last think end, NULL when unusable."""
    probs = F.from_json(strip(after_last_think(generation)), "map<string,double>")
    p, n = F.try_element_at(probs, F.lit(yes)), F.try_element_at(probs, F.lit(no))
    return F.when(p + n > 0, p / (p + n))


def sample_probability(generations: Column, yes: str = YES, no: str = NO) -> Column:
    """Mean over the generations; one unusable generation rejects the sample."""
    each = F.transform(generations, lambda g: positive_probability(g, yes, no))
    usable = (F.size(each) > 0) & F.forall(each, lambda x: x.isNotNull())
    total = F.aggregate(each, F.lit(0.0), lambda s, x: s + x)
    return F.when(usable, total / F.size(each))


def auc(rows: DataFrame, score: str, label: str, keys: list[str] | None = None) -> DataFrame:
    """Rank AUC with half credit for ties; one class gives 0.5.

    Rows are first collapsed to counts per distinct score; the running count of negatives is a
    distributed prefix sum over the score order, so no group is sorted in one task.
    """
    keys = keys or []
    pos, neg = (F.sum((F.col(label) == v).cast("bigint")) for v in (1, 0))
    counts = rows.where(F.col(score).isNotNull() & F.col(label).isin(0, 1)).groupBy(*keys, score).agg(
        pos.alias("_p"), neg.alias("_n"))
    run = running_sums(counts, [*[F.col(k) for k in keys], F.col(score)], {"_below": F.col("_n")})
    # _below runs over all groups; a group's own start is its smallest value.
    agg = run.groupBy(*keys).agg(
        F.sum("_p").alias("positives"), F.sum("_n").alias("negatives"),
        F.sum(F.col("_p") * (F.col("_below") + F.col("_n") / 2)).alias("_area"), F.min("_below").alias("_start"))
    p, n = F.col("positives"), F.col("negatives")
    value = F.when((p == 0) | (n == 0), 0.5).otherwise((F.col("_area") - p * F.col("_start")) / (p * n))
    empty = F.when(p.isNull(), 0.0).otherwise(value)
    return agg.select(*keys, F.coalesce(p, F.lit(0)).alias("positives"),
                      F.coalesce(n, F.lit(0)).alias("negatives"), empty.alias("auc"))


def accuracy_buckets(rows: DataFrame, score: str, label: str, keys: list[str]) -> DataFrame:
    """Correct / incorrect / invalid counts and accuracy at one half."""
    known = F.col(label).isin(0, 1)
    s = F.col(score)
    right = ((s > 0.5) & (F.col(label) == 1)) | ((s <= 0.5) & (F.col(label) == 0))
    scored = known & s.isNotNull()
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_samples"), F.sum(known.cast("int")).alias("valid_samples"),
        F.sum((scored & right).cast("int")).alias("correct"), F.sum((scored & ~right).cast("int")).alias("incorrect"),
        F.sum((~scored).cast("int")).alias("invalid"),
        F.avg(F.when(scored, right.cast("double"))).alias("accuracy"))


def stage_totals(samples: DataFrame, keys: list[str]) -> DataFrame:
    """Token sums and the slowest time per generation stage."""
    stages = samples.select(*keys, F.posexplode(F.arrays_zip("input_tokens", "output_tokens", "times")).alias("stage", "x"))
    return stages.groupBy(*keys, "stage").agg(
        F.sum("x.input_tokens").alias("input_tokens"), F.sum("x.output_tokens").alias("output_tokens"),
        F.max("x.times").alias("time"))


def utilisation(stages: DataFrame, params: Column, tflops: Column, devices: Column) -> DataFrame:
    """2 * params * tokens / (peak * devices * time) to six digits; NULL when an input is missing or not positive."""
    tokens = F.coalesce("input_tokens", F.lit(0)) + F.coalesce("output_tokens", F.lit(0))
    peak = tflops * 1e12 * devices * F.col("time")
    usable = (params > 0) & (tflops > 0) & (devices > 0) & (F.col("time") > 0) & (tokens > 0)
    return stages.withColumn("utilisation", F.when(usable, F.round(params * 2 * tokens / peak, 6)))


def cache_complete(results: DataFrame, required: list[str], keys: list[str]) -> DataFrame:
    """Whether every required metric is present, per result set."""
    have = F.count_distinct(F.when(F.col("metric").isin(required), F.col("metric")))
    return results.groupBy(*keys).agg((have == len(set(required))).alias("reuse"))


def write_back(samples: DataFrame, metrics: DataFrame, keys: list[str]) -> DataFrame:
    return samples.join(metrics, keys, "left")


def model_total_time(results: DataFrame) -> DataFrame:
    """Sum over tasks and splits; names starting with an underscore are bookkeeping."""
    return results.where(~F.startswith("task", F.lit("_"))).groupBy("model").agg(
        F.sum(F.coalesce("total_time", F.lit(0.0))).alias("total_time"))
