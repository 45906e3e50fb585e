"""Validation roll-ups over rollout tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import hash_int, key_text
from ..session import cut
from .keyed import lookup_join
from .numbering import group_row_numbers, group_running_sums
from .resampling import PRIME, resampled


GROUP_VOTES, PART_VOTES, TASKS_PER_CORE = 4_000_000, 500_000, 4


def long_form(rows: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """keys, variable, value; text columns are not variables."""
    types = dict(rows.dtypes)
    numeric = [v for v in variables if types[v] != "string"]
    return rows.select(*keys, *[F.col(v).cast("double").alias(v) for v in numeric]).unpivot(
        keys, numeric, "variable", "value")


def prompt_statistics(rows: DataFrame, variables: list[str], prompt: str = "uid") -> DataFrame:
    """Mean and population std per (source, prompt, variable) with the group size n."""
    long = long_form(rows, ["data_source", prompt], variables)
    return long.groupBy("data_source", prompt, "variable").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def _draw_sizes(n: Column) -> Column:
    """2, 4, 8, ... below n, then n itself."""
    powers = F.transform(F.sequence(F.lit(1), F.lit(62)), lambda i: F.pow(F.lit(2.0), i).cast("bigint"))
    return F.when(n > 1, F.array_append(F.filter(powers, lambda p: p < n), n))


def best_worst(values: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean and std of the best and worst of k draws with replacement, k = 2, 4, ..., n.

    The limit of the resampling estimate in closed form: with F the empirical distribution,
    P(max = x) = F(x)^k - F(x-)^k. Values are collapsed to counts, and the distribution comes
    from a distributed running sum.
    """
    counts = values.groupBy(*keys, F.col(value).alias("x")).agg(F.count(F.lit(1)).alias("c"))
    sizes = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    run = group_running_sums(counts, keys, [F.col("x")], "x", {"below": F.col("c")})
    both = lookup_join(run, sizes, keys, "left").withColumn("k", F.explode(_draw_sizes(F.col("n"))))
    lo, hi, k = F.col("below") / F.col("n"), (F.col("below") + F.col("c")) / F.col("n"), F.col("k")
    top = F.pow(hi, k) - F.pow(lo, k)
    low = F.pow(1 - lo, k) - F.pow(1 - hi, k)
    x = F.col("x")
    moments = both.groupBy(*keys, "k").agg(
        F.sum(x * top).alias("best"), F.sum(x * x * top).alias("_b2"),
        F.sum(x * low).alias("worst"), F.sum(x * x * low).alias("_w2"))

    def std(second: str, mean: str) -> Column:
        return F.sqrt(F.greatest(F.col(second) - F.col(mean) * F.col(mean), F.lit(0.0)))

    return moments.select(*keys, "k", F.col("best").alias("best_mean"), std("_b2", "best").alias("best_std"),
                          F.col("worst").alias("worst_mean"), std("_w2", "worst").alias("worst_std"))


def majority_value(votes: DataFrame, keys: list[str], pred: str, value: str, order: str) -> DataFrame:
    """Value of the first vote for the most frequent prediction; ties go to the prediction seen first."""
    per_pred = votes.groupBy(*keys, pred).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))).alias("_first"))
    best = F.max_by("_first.v", F.struct("_n", (-F.col("_first.o")).alias("o")))
    return per_pred.groupBy(*keys).agg(best.alias("majority"))


def majority_bootstrap(votes: DataFrame, keys: list[str], pred: str, value: str, row_id: str, seed,
                       trials: int = 1000, group_votes: int = GROUP_VOTES) -> DataFrame:
    """Mean and std of the majority value over resamples of k votes, k = 2, 4, ..., n.

    Each trial has a hash, and its draws are multiples of it modulo a prime: indexes into the numbered
    votes of the group. A group of at most `group_votes` votes is resampled where it lies; only votes move. Groups over
    PART_VOTES go to several tasks, each with all votes and some of the trials. The draws of a group over `group_votes`
    are rows of a join. Groups with a NULL key are left out.
    """
    rows = votes.select(*keys, row_id, pred, value).dropna(subset=keys)
    least = min(group_votes, PART_VOTES)
    large = cut(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > least))  # few by construction
    most = large.agg(F.max("_n")).first()[0] or 0
    if not most:
        whole = rows.withColumn("_part", F.lit(0)).withColumn("_parts", F.lit(1))
        return _resampled(whole, keys, keys, pred, value, row_id, seed, trials).drop("_count")
    marked = rows.join(F.broadcast(large), keys, "left")
    parts = F.ceil(F.coalesce("_n", F.lit(1)) / PART_VOTES).cast("int")
    own = marked.where(F.coalesce("_n", F.lit(0)) <= group_votes).withColumn("_parts", parts).withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    out = _merged(_resampled(own, keys, [*keys, "_part"], pred, value, row_id, seed, trials), keys)
    if most <= group_votes:
        return out
    joined = marked.where(F.col("_n") > group_votes).drop("_n")
    return out.unionByName(_joined_bootstrap(joined, keys, pred, value, row_id, seed, trials))


def _resampled(votes: DataFrame, keys: list[str], by: list[str], pred: str, value: str, row_id: str, seed, trials: int) -> DataFrame:
    """keys, k, _count, maj_mean, maj_std of each part of a group; tasks are as many as cores at least, as they compute much on few bytes."""
    spark = votes.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    at = F.row_number().over(Window.partitionBy(*by).orderBy(F.col(row_id).asc_nulls_last()))
    lying = votes.repartition(tasks, *by).withColumn("_at", at)
    text = F.when(F.col("_at") == 1, key_text(seed, *[F.col(x) for x in keys])).alias("_key")
    types = dict(votes.dtypes)
    return lying.select(*keys, "_part", "_parts", "_at", text, F.col(pred).alias("_p"), F.col(value).cast("double").alias("_v")).mapInArrow(
        resampled(keys, trials), ", ".join(f"`{x}` {types[x]}" for x in keys) + ", k bigint, _count bigint, maj_mean double, maj_std double")


def _merged(moments: DataFrame, keys: list[str]) -> DataFrame:
    """One row of the parts of a group and k, by their counts, means and stds."""
    whole = moments.groupBy(*keys, "k").agg(F.sum("_count").alias("_of"), F.collect_list(F.struct("_count", "maj_mean", "maj_std")).alias("_x"))
    some = whole.withColumn("_x", F.filter("_x", lambda x: x["_count"] > 0)).withColumn("maj_mean", F.when(F.col("_of") > 0, F.aggregate(
        "_x", F.lit(0.0), lambda s, x: s + x["_count"] * x["maj_mean"]) / F.col("_of")))
    spread = F.aggregate("_x", F.lit(0.0), lambda s, x: s + x["_count"] * (
        x["maj_std"] * x["maj_std"] + (x["maj_mean"] - F.col("maj_mean")) * (x["maj_mean"] - F.col("maj_mean"))))
    return some.select(*keys, "k", "maj_mean", F.when(F.col("_of") > 0, F.sqrt(spread / F.col("_of"))).alias("maj_std"))


def _joined_bootstrap(votes: DataFrame, keys: list[str], pred: str, value: str, row_id: str, seed, trials: int) -> DataFrame:
    """Draws as rows of a join, for groups too large for one task."""
    numbered = group_row_numbers(votes.select(*keys, row_id, pred, value), keys, [F.col(row_id)], row_id, "at")
    sizes = votes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    names = [F.col(x) for x in keys]
    draws = sizes.select(*keys, "n", F.explode(_draw_sizes(F.col("n"))).alias("k")).withColumn(
        "trial", F.explode(F.sequence(F.lit(0), F.lit(trials - 1)))).withColumn(
        "h", hash_int(seed, *names, F.col("k"), F.col("trial"))).repartition(*keys, "k", "trial").withColumn(
        "j", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("k"))))
    picked = draws.withColumn("at", (F.col("h") * (2 * F.col("j") + 1) + F.col("j") * F.col("j") * 40503) % PRIME % F.col("n") + 1).drop("h")
    # by their estimate the draws look small enough to broadcast; they are rows in proportion to votes and trials
    voted = picked.hint("merge").join(numbered, [*keys, "at"])
    per_trial = majority_value(voted, [*keys, "k", "trial"], pred, value, "j")
    return per_trial.groupBy(*keys, "k").agg(F.avg("majority").alias("maj_mean"), F.stddev_pop("majority").alias("maj_std"))


def over_prompts(stats: DataFrame, metrics: list[str]) -> DataFrame:
    """Mean over prompts per (source, variable, n, metric)."""
    long = stats.unpivot(["data_source", "variable", "n"], metrics, "metric", "value")
    return long.where("value IS NOT NULL").groupBy("data_source", "variable", "n", "metric").agg(F.avg("value").alias("value"))


def core_labels(summary: DataFrame, core: str = "acc", fallback: str = "reward") -> DataFrame:
    """'val-core' for mean/maj/best/pass metrics of the core variable at its largest n, else 'val-aux'."""
    per_source = summary.groupBy("data_source").agg(F.max((F.col("variable") == core).cast("int")).alias("_has"))
    largest = summary.groupBy("data_source", "variable").agg(F.max("n").alias("_max"))
    s = summary.join(largest, ["data_source", "variable"]).join(per_source, "data_source")
    main = F.when(F.col("_has") == 1, F.lit(core)).otherwise(F.lit(fallback))
    lead = F.rlike(F.col("metric"), F.lit("^(mean|maj|best|pass)"))
    is_core = (F.col("variable") == main) & lead & (F.col("n") == F.col("_max"))
    return s.withColumn("section", F.when(is_core, "val-core").otherwise("val-aux")).drop("_has", "_max")


def repeated_prompts(rows: DataFrame, prompt: str) -> DataFrame:
    return rows.groupBy(prompt).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def length_summary(rows: DataFrame, length: str, turns: str) -> DataFrame:
    return rows.agg(
        F.avg(length).alias("length_mean"), F.max(length).alias("length_max"), F.min(length).alias("length_min"),
        F.avg(turns).alias("turns_mean"), F.max(turns).alias("turns_max"), F.min(turns).alias("turns_min"))


def best_truth_reward(probes: DataFrame, key: str, log_probs: str, truth_len: str) -> DataFrame:
    """Mean log-probability of the truth tail per probe, the largest per original row."""
    lp, n = F.col(log_probs), F.col(truth_len)
    tail = F.slice(lp, F.greatest(F.size(lp) - n, F.lit(0)) + 1, n)
    mean = F.aggregate(tail, F.lit(0.0), lambda s, x: s + x) / F.size(tail)
    return probes.groupBy(key).agg(F.max(mean).alias("reward"), F.count(F.lit(1)).alias("probes"))
