"""Group statistics over rollout tables: one row per rollout, token values as arrays.

`uid` names the prompt group. Group aggregates come from a partially aggregated groupBy that
is joined back (keyed.with_group_stats), so one huge group neither sorts nor buffers in a
single task. Whitening statistics are one global aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import array_sum
from ..session import cut
from .keyed import lookup_join, with_group_stats, with_totals
from .numbering import group_row_numbers, group_running_sums, ordered_parts, row_numbers

# Guard and bound of the published formulas; result names below follow them too.
EPS = 1e-6
BOUND = 20.0
NO_GAP = 1e-12  # a weight of label gaps under this is rounding


def outcome(rows: DataFrame) -> DataFrame:
    """Adds `score` = sum of the token rewards."""
    return rows.withColumn("score", array_sum(F.col("token_rewards")))


def masked(values: Column, mask: Column) -> Column:
    """Values where the mask is set."""
    return F.transform(F.filter(F.arrays_zip(values.alias("v"), mask.alias("m")), lambda x: x["m"] == 1),
                       lambda x: x["v"])


def times_mask(values: Column, mask: Column) -> Column:
    return F.zip_with(values, mask, lambda v, m: v * m)


def spread(value: Column, mask: Column) -> Column:
    """A per-row value on every unmasked token."""
    return F.transform(mask, lambda m: value * m)


def masked_mean(values: Column, mask: Column) -> Column:
    kept = masked(values, mask)
    return array_sum(kept) / (F.size(kept) + F.lit(1e-8))


def whiten(rows: DataFrame, values: str, mask: str = "mask", out: str = "advantage") -> DataFrame:
    """Zero mean, unit variance over all unmasked tokens of the table."""
    token = rows.select(F.explode(masked(F.col(values), F.col(mask))).alias("x"))
    stats = token.agg(F.avg("x").alias("_mean"), F.var_samp("x").alias("_var"))
    both = rows.crossJoin(F.broadcast(stats))  # one row
    scaled = F.transform(F.col(values), lambda v: (v - F.col("_mean")) / F.sqrt(F.col("_var") + 1e-8))
    return both.withColumn(out, scaled).drop("_mean", "_var")


# ---- advantages -------------------------------------------------------------------------

def group_normalised(rows: DataFrame, by_std: bool = True, eps: float = EPS) -> DataFrame:
    """(score - mean) / (std + eps); a lone rollout keeps mean 0 and std 1."""
    s = with_group_stats(outcome(rows), ["uid"],
                         [F.avg("score").alias("_mean"), F.stddev_samp("score").alias("_std")])
    alone = F.col("group_rows") == 1
    diff = F.col("score") - F.when(alone, 0.0).otherwise(F.col("_mean"))
    std = F.when(alone, 1.0).otherwise(F.col("_std"))
    return s.withColumn("advantage", diff / (std + eps) if by_std else diff).drop("_mean", "_std", "group_rows")


def best_versus_second(rows: DataFrame, by_std: bool = True, eps: float = EPS) -> DataFrame:
    """Only the best rollout of a group is credited, with its lead over the second.

    The two best rows come from a rank filter that prunes inside every map task.
    """
    scored = outcome(rows)
    w = Window.partitionBy("uid").orderBy(F.desc("score"), "row_id")
    top = scored.select("uid", "row_id", "score").withColumn("_r", F.row_number().over(w)).where("_r <= 2")
    lead = top.groupBy("uid").agg((F.max("score") - F.min("score")).alias("_lead"),
                                  F.min_by("row_id", "_r").alias("_best"))
    spread_ = scored.groupBy("uid").agg(F.stddev_samp("score").alias("_std"), F.count(F.lit(1)).alias("_members"))
    s = lookup_join(scored, lead.join(spread_, "uid"), ["uid"], "left")
    value = F.col("_lead") / (F.col("_std") + eps) if by_std else F.col("_lead")
    lone = F.raise_error(F.lit("a group needs at least two rollouts")).cast("double")
    adv = F.when(F.col("_members") < 2, lone).when(F.col("row_id") == F.col("_best"), value).otherwise(0.0)
    return s.withColumn("advantage", adv).drop("_lead", "_best", "_std", "_members")


def _baseline(rows: DataFrame, agg: Column) -> DataFrame:
    s = with_group_stats(rows, ["uid"], [agg.alias("_base")])
    return s.withColumn("_base", F.when(F.col("group_rows") == 1, 0.0).otherwise(F.col("_base")))


def mean_baseline_whitened(rows: DataFrame) -> DataFrame:
    s = _baseline(outcome(rows), F.avg("score"))
    s = s.withColumn("_tok", spread(F.col("score") - F.col("_base"), F.col("mask")))
    out = whiten(s, "_tok", out="advantages")
    return out.withColumn("advantages", times_mask(F.col("advantages"), F.col("mask"))).drop("_tok", "_base", "group_rows")


def leave_one_out(rows: DataFrame) -> DataFrame:
    s = _baseline(outcome(rows), F.avg("score"))
    n = F.col("group_rows")
    adv = F.when(n == 1, F.col("score")).otherwise((F.col("score") - F.col("_base")) * n / (n - 1))
    return s.withColumn("advantage", adv).drop("_base", "group_rows")


def length_weighted(rows: DataFrame) -> DataFrame:
    s = outcome(rows).withColumn("_len", F.aggregate("mask", F.lit(0), lambda a, m: a + m))
    s = _baseline(s, F.sum(F.col("_len") * F.col("score")) / F.sum("_len"))
    return s.withColumn("advantage", F.col("score") - F.col("_base")).drop("_base", "_len", "group_rows")


def batch_scaled(rows: DataFrame, f_norm: float = 1.0) -> DataFrame:
    s = _baseline(outcome(rows), F.avg("score"))
    s = with_totals(s, [(F.count(F.lit(1)) / F.greatest(F.sum((F.col("score") != 0).cast("int")), F.lit(1)))
                        .alias("_alpha")], outcome(rows))
    return s.withColumn("advantage", F.col("_alpha") * (F.col("score") - F.col("_base")) / f_norm).drop(
        "_base", "_alpha", "group_rows")


# ---- scans along the tokens of a row: one numpy step per token position, all rows of an Arrow batch at once

def _grid(col: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Rows right-aligned in a matrix, so that the last token of every row is the last column."""
    sizes = col.map(len).to_numpy()
    grid = np.zeros((len(col), int(sizes.max(initial=0))))
    for i, x in enumerate(col):
        if len(x):
            grid[i, grid.shape[1] - len(x):] = x
    return grid, sizes


def _ungrid(grid: np.ndarray, sizes: np.ndarray) -> pd.Series:
    width = grid.shape[1]
    return pd.Series([grid[i, width - n:].tolist() for i, n in enumerate(sizes)])


def discounted_return(rewards: Column, mask: Column, gamma: float) -> Column:
    """Reverse discounted sum that starts anew behind a masked token."""
    @F.pandas_udf("array<double>")
    def scan(r: pd.Series, m: pd.Series) -> pd.Series:
        (rg, sizes), (mg, _) = _grid(r), _grid(m)
        out, run = np.zeros_like(rg), np.zeros(len(rg))
        for t in range(rg.shape[1] - 1, -1, -1):
            run = rg[:, t] + gamma * run
            out[:, t] = run
            run = run * mg[:, t]
        return _ungrid(out, sizes)
    return scan(rewards, mask)


def suffix_sum(values: Column) -> Column:
    @F.pandas_udf("array<double>")
    def scan(v: pd.Series) -> pd.Series:
        grid, sizes = _grid(v)
        return _ungrid(np.cumsum(grid[:, ::-1], axis=1)[:, ::-1], sizes)
    return scan(values)


def gae(rewards: Column, values: Column, mask: Column, gamma: float, lam: float) -> Column:
    """Generalised advantage estimate; masked tokens carry value and estimate through."""
    @F.pandas_udf("array<double>")
    def scan(r: pd.Series, v: pd.Series, m: pd.Series) -> pd.Series:
        (rg, sizes), (vg, _), (mg, _) = _grid(r), _grid(v), _grid(m)
        out, nxt, last = np.zeros_like(rg), np.zeros(len(rg)), np.zeros(len(rg))
        for t in range(rg.shape[1] - 1, -1, -1):
            keep = mg[:, t]
            fresh = rg[:, t] + gamma * nxt - vg[:, t] + gamma * lam * last
            nxt = vg[:, t] * keep + nxt * (1 - keep)
            last = fresh * keep + last * (1 - keep)
            out[:, t] = last
        return _ungrid(out, sizes)
    return scan(rewards, values, mask)


def discounted_whitened(rows: DataFrame, gamma: float = 1.0) -> DataFrame:
    s = rows.withColumn("returns", discounted_return(F.col("token_rewards"), F.col("mask"), gamma))
    out = whiten(s, "returns", out="advantages")
    return out.withColumn("advantages", times_mask(F.col("advantages"), F.col("mask")))


def return_minus_baseline(rows: DataFrame, baseline: Column) -> DataFrame:
    s = rows.withColumn("returns", suffix_sum(times_mask(F.col("token_rewards"), F.col("mask"))))
    return s.withColumn("advantages", F.zip_with("returns", "mask", lambda r, m: r - baseline * m))


def gae_whitened(rows: DataFrame, gamma: float, lam: float) -> DataFrame:
    s = rows.withColumn("_gae", gae(F.col("token_rewards"), F.col("token_values"), F.col("mask"), gamma, lam))
    s = s.withColumn("returns", F.zip_with("_gae", "token_values", lambda a, v: a + v))
    return whiten(s, "_gae", out="advantages").drop("_gae")


def multi_source_leave_one_out(rows: DataFrame, acc: str, token_share: float, acc_share: float) -> DataFrame:
    """Leave-one-out per reward source (token rewards, accuracy on the last token), summed, then suffix sums."""
    mask, r = F.col("mask"), F.col("token_rewards")
    s = rows.withColumn("_tok", array_sum(masked(r, mask)) / F.aggregate("mask", F.lit(0), lambda a, m: a + m))
    s = with_group_stats(s, ["uid"], [F.sum("_tok").alias("_st"), F.sum(acc).alias("_sa")])
    n = F.col("group_rows")
    scale = n / (n - 1)
    token = F.transform(F.arrays_zip(r.alias("r"), mask.alias("m")), lambda x: F.when(
        x["m"] == 1, (x["r"] * scale - F.col("_st") / (n - 1)) * token_share).otherwise(0.0))
    last = F.col(acc) * scale - F.col("_sa") / (n - 1)
    total = F.transform(token, lambda t, i: t + F.when(i == F.col("_valid") - 1, last * acc_share).otherwise(0.0))
    s = s.withColumn("_valid", F.size("mask"))
    s = s.withColumn("returns", suffix_sum(times_mask(total, mask)))
    return whiten(s, "returns", out="advantages").drop("_tok", "_st", "_sa", "_valid", "group_rows")


def varied_groups(rows: DataFrame, prompts: int, per_prompt: int) -> DataFrame:
    """Rollouts of groups whose score varies (or with one rollout), in arrival order (row_id), cut to
    prompts * per_prompt trajectories."""
    stats = rows.groupBy("uid").agg(F.stddev_pop("score").alias("_sd"), F.count(F.lit(1)).alias("_n"))
    kept = lookup_join(rows, stats.where("_sd > 0 OR _n = 1").select("uid"), ["uid"])
    return kept.orderBy("row_id").limit(prompts * per_prompt)


# ---- divergence -------------------------------------------------------------------------

def kl_terms(kind: str):
    forms = {
        "k1": lambda a, b: a - b,
        "abs": lambda a, b: F.abs(a - b),
        "k2": lambda a, b: 0.5 * (a - b) * (a - b),
        "k3": lambda a, b: _clamp(F.exp(_clamp(b - a, BOUND)) - _clamp(b - a, BOUND) - 1, 10.0),
    }
    return forms[kind]


def _clamp(x: Column, bound: float) -> Column:
    return F.greatest(F.least(x, F.lit(bound)), F.lit(-bound))


def kl(a: Column, b: Column, kind: str) -> Column:
    return F.zip_with(a, b, kl_terms(kind))


def penalised(rows: DataFrame, beta: float, kind: str = "k1") -> DataFrame:
    """token_rewards - beta * kl on unmasked tokens; `row_kl` = mean kl of the row."""
    s = rows.withColumn("_kl", times_mask(kl(F.col("old_lp"), F.col("ref_lp"), kind), F.col("mask")))
    return s.withColumn("penalised", F.zip_with("token_rewards", "_kl", lambda r, k: r - beta * k)).withColumn(
        "row_kl", masked_mean(F.col("_kl"), F.col("mask"))).drop("_kl")


def adaptive_beta(steps: DataFrame, keys: list[str], order: str, start: float, target: float, horizon: float) -> DataFrame:
    """Coefficient after each step: start * product of (1 + clip(kl/target - 1) * n / horizon)."""
    err = F.greatest(F.least(F.col("kl") / target - 1, F.lit(0.2)), F.lit(-0.2))
    s = steps.withColumn("_ln", F.log(1 + err * F.col("n_steps") / horizon))
    run = group_running_sums(s, keys, [F.col(order)], order, {"_before": F.col("_ln")})
    return run.withColumn("beta", F.lit(start) * F.exp(F.col("_before") + F.col("_ln"))).drop("_ln", "_before")


def aggregate_loss(rows: DataFrame, loss: str) -> DataFrame:
    """The four aggregation modes in one pass; the last one divides by the longest mask."""
    kept = masked(F.col(loss), F.col("mask"))
    s = rows.select(array_sum(kept).alias("total"), F.size(kept).alias("tokens"), F.size("mask").alias("width"))
    return s.agg(
        (F.sum("total") / (F.sum("tokens") + 1e-8)).alias("token_mean"),
        F.avg("total").alias("seq_mean_token_sum"),
        F.avg(F.col("total") / F.col("tokens")).alias("seq_mean_token_mean"),
        (F.sum("total") / F.max("width")).alias("seq_mean_token_sum_norm"))


def distillation_advantage(rows: DataFrame) -> DataFrame:
    """Teacher minus student log-probability per token."""
    return rows.withColumn("advantages", F.zip_with("ref_lp", "old_lp", lambda t, s: t - s))


# ---- importance weights -----------------------------------------------------------------

def importance_weights(rows: DataFrame, level: str, upper: float, lower: float | None = None,
                       mode: str = "truncate", veto: float | None = None) -> DataFrame:
    """Adds `raw_weights`, `weights`, `kept_mask`, `log_ratio`, `row_log`, `catastrophic`."""
    lower = 1.0 / upper if lower is None else lower
    mask = F.col("mask")
    s = rows.withColumn("log_ratio", F.zip_with("old_lp", "rollout_lp", lambda o, r: o - r))
    ratio = masked(F.col("log_ratio"), mask)
    if level == "token":
        s = s.withColumn("row_log", F.lit(None).cast("double"))
        raw = F.transform("log_ratio", lambda x: F.exp(_clamp(x, BOUND)))
    elif level in ("sequence", "geometric"):
        s = s.withColumn("row_log", array_sum(ratio) if level == "sequence" else masked_mean(F.col("log_ratio"), mask))
        raw = F.transform("mask", lambda m: F.exp(_clamp(F.col("row_log"), BOUND)))
    else:
        raise ValueError(f"unknown level {level}")
    if veto is None:
        bad = F.transform("mask", lambda m: F.lit(0))
    else:
        cutoff = float(np.log(veto))
        bad = F.zip_with("log_ratio", "mask", lambda x, m: ((x < cutoff) & (m == 1)).cast("int"))
    s = s.withColumn("raw_weights", raw).withColumn("catastrophic", bad)
    alive = F.when(F.exists("catastrophic", lambda x: x == 1), 0).otherwise(1)
    if mode == "truncate":
        weights = F.transform("raw_weights", lambda x: F.least(x, F.lit(upper)))
        kept = F.transform("mask", lambda m: m * alive)
    elif mode == "mask":
        weights = F.col("raw_weights")
        kept = F.zip_with("mask", "raw_weights", lambda m, x: m * x.between(lower, upper).cast("int") * alive)
    else:
        raise ValueError(f"unknown mode {mode}")
    return s.withColumn("weights", times_mask(weights, mask)).withColumn("kept_mask", kept)


def weight_diagnostics(weighted: DataFrame, level: str, upper: float, lower: float | None = None,
                       mode: str = "truncate") -> DataFrame:
    """One row of importance-weight diagnostics over a table from importance_weights."""
    lower = 1.0 / upper if lower is None else lower
    token = weighted.select(F.explode(F.filter(
        F.arrays_zip(F.col("raw_weights").alias("w"), F.col("mask").alias("m"), F.col("catastrophic").alias("c")),
        lambda x: x["m"] == 1)).alias("t"), "row_log")
    w = F.col("t.w")
    clamped = F.greatest(F.least(w, F.lit(upper)), F.lit(lower))
    n = F.count(F.lit(1)) + F.lit(1e-8)
    inside = w.between(lower, upper)
    token_aggs = [
        (F.sum("t.c") / n).alias("catastrophic_token_fraction"), (F.sum(w) / n).alias("mean"),
        F.max(w).alias("_wmax"), F.min(w).alias("_wmin"),
        (F.sum((w > upper).cast("int")) / n).alias("_high"), (F.sum((w < lower).cast("int")) / n).alias("_low"),
        (F.sum((F.col("row_log") > float(np.log(upper))).cast("int")) / n).alias("_glog_high"),
        (F.sum((F.col("row_log") < float(np.log(lower))).cast("int")) / n).alias("_glog_low"),
        (F.sum(clamped) / n).alias("_c1"), (F.sum(clamped * clamped) / n).alias("_c2"),
        (F.sum((~inside).cast("int")) / n).alias("masked_fraction"),
    ]
    kept = masked(F.col("raw_weights"), F.col("mask"))
    seq = weighted.select(
        (array_sum(kept) / (F.size(kept) + F.lit(1e-8))).alias("s"), "row_log",
        F.exists("catastrophic", lambda x: x == 1).cast("int").alias("dead"),
        (F.exists(kept, lambda x: ~x.between(lower, upper)) if level == "token"
         else ~F.col("raw_weights")[0].between(lower, upper)).cast("int").alias("out"))
    s = F.col("s")
    seq_aggs = [
        F.avg("dead").alias("veto_fraction"), F.avg(s).alias("seq_mean"),
        F.coalesce(F.stddev_samp(s), F.lit(0.0)).alias("seq_std"), F.max(s).alias("seq_max"), F.min(s).alias("seq_min"),
        F.max(F.abs(s - 1.0)).alias("seq_max_deviation"), F.avg((s > upper).cast("int")).alias("seq_fraction_high"),
        F.avg((s < lower).cast("int")).alias("seq_fraction_low"), F.avg("out").alias("seq_masked_fraction"),
        F.exp(F.least(F.max("row_log"), F.lit(BOUND))).alias("_lmax"), F.exp(F.min("row_log")).alias("_lmin"),
        F.avg((F.col("row_log") > float(np.log(upper))).cast("int")).alias("_slog_high"),
        F.avg((F.col("row_log") < float(np.log(lower))).cast("int")).alias("_slog_low"),
    ]
    both = token.agg(*token_aggs).crossJoin(seq.agg(*seq_aggs))  # one row each
    source = {"token": ("_wmax", "_wmin", "_high", "_low"), "sequence": ("_lmax", "_lmin", "_slog_high", "_slog_low"),
              "geometric": ("_lmax", "_lmin", "_glog_high", "_glog_low")}[level]
    std = F.sqrt(F.greatest(F.col("_c2") - F.col("_c1") * F.col("_c1"), F.lit(0.0)))
    size = (F.col("_c1") + 1e-8) * (F.col("_c1") + 1e-8) / F.col("_c2")
    names = ["mean", "catastrophic_token_fraction", "veto_fraction", "seq_mean", "seq_std", "seq_max", "seq_min",
             "seq_max_deviation", "seq_fraction_high", "seq_fraction_low"]
    extra = ["masked_fraction", "seq_masked_fraction"] if mode == "mask" else []
    return both.select(
        *[F.col(c).alias(a) for c, a in zip(source, ("max", "min", "ratio_fraction_high", "ratio_fraction_low"))],
        std.alias("std"), size.alias("eff_sample_size"), *names, *extra)


def mismatch_metrics(rows: DataFrame) -> DataFrame:
    """Divergence and perplexity of training against rollout policy, one row."""
    mask = F.col("mask")
    seq = rows.select(masked_mean(F.col("old_lp"), mask).alias("o"), masked_mean(F.col("rollout_lp"), mask).alias("r"))
    d = F.col("r") - F.col("o")
    per_seq = seq.agg(
        F.avg(F.exp(-F.col("o"))).alias("training_ppl"), F.avg(-F.col("o")).alias("training_log_ppl"),
        F.avg(F.exp(-F.col("r"))).alias("rollout_ppl"), F.avg(-F.col("r")).alias("rollout_log_ppl"),
        F.avg(d).alias("log_ppl_diff"), F.avg(F.abs(d)).alias("log_ppl_abs_diff"), F.max(d).alias("log_ppl_diff_max"),
        F.min(d).alias("log_ppl_diff_min"), F.avg(F.exp(d)).alias("ppl_ratio"))
    token = rows.select(F.explode(masked(F.zip_with("old_lp", "rollout_lp", lambda o, r: o - r), mask)).alias("x"))
    x, n = F.col("x"), F.count(F.lit(1)) + F.lit(1e-8)
    per_token = token.agg((F.sum(-x) / n).alias("kl"), (F.sum(F.exp(x) - x - 1) / n).alias("k3_kl"))
    return per_seq.crossJoin(per_token)  # one row each


def probability_gap(rows: DataFrame) -> DataFrame:
    """|p_rollout - p_training| over unmasked tokens and the correlation of the two."""
    pairs = F.filter(F.arrays_zip(F.col("old_lp").alias("o"), F.col("rollout_lp").alias("r"), F.col("mask").alias("m")),
                     lambda x: x["m"] == 1)
    t = rows.select(F.explode(pairs).alias("x")).select(F.exp("x.o").alias("o"), F.exp("x.r").alias("r"))
    gap = F.abs(F.col("o") - F.col("r"))
    return t.agg(F.max(gap).alias("diff_max"), F.avg(gap).alias("diff_mean"), F.stddev_samp(gap).alias("diff_std"),
                 F.corr("o", "r").alias("pearson"))


def token_differences(a: Column, b: Column, mask: Column) -> Column:
    """Unmasked positions where two token arrays differ; unlike lengths count as all different."""
    z = F.arrays_zip(a.alias("a"), b.alias("b"), mask.alias("m"))
    n = F.size(F.filter(z, lambda x: (x["m"] == 1) & (x["a"] != x["b"])))
    return F.when((F.size(a) == F.size(b)) & (F.size(a) == F.size(mask)), n).otherwise(F.size(a))


# ---- ranking accuracy -------------------------------------------------------------------

def rising_weight(group: np.ndarray, time: np.ndarray, a: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each point j the sum of n_i (a_j - a_i) over points i of its group with an earlier time and a smaller a.

    Two times differ first at one binary digit, so each pair is met at one level: there the later point needs the
    count and sum of the smaller values among the earlier half, which are running sums in order of a.
    """
    out = np.zeros(len(a))
    for level in range(int(time.max()).bit_length() if len(time) else 0):
        left = 1 - (time >> level & 1)
        order = np.lexsort((left, a, time >> level + 1, group))
        block = np.flatnonzero(np.concatenate([[True], (np.diff(group[order]) != 0) | (np.diff(time[order] >> level + 1) != 0)]))
        size = np.diff(np.append(block, len(a)))
        sums = []
        for value in (left * n, left * n * a):
            run = np.cumsum(value[order])
            sums.append(run - np.repeat(run[block] - value[order][block], size))
        out[order] += (1 - left[order]) * (a[order] * sums[0] - sums[1])
    return out


def _table(batches: Iterator[pa.RecordBatch], schema: list[str]) -> pa.Table | None:
    batches = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(batches).select(schema) if batches else None


def _runs_of(values: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the run of equal values each row is in, first row of each run)."""
    code = values.combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
    first = np.flatnonzero(np.concatenate([[True], np.diff(code) != 0]))
    return np.repeat(np.arange(len(first)), np.diff(np.append(first, len(code)))), first


def _bucket_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights of the pairs inside one range bucket, per group; rows come by group and then score."""
    rows = _table(batches, ["uid", "a", "_part"])
    if rows is None:
        return
    group, first = _runs_of(rows["uid"])
    a, time = rows["a"].to_numpy(), np.arange(len(group)) - first[group]
    one = np.ones(len(a))
    right = np.add.reduceat(rising_weight(group, time, a, one), first)
    order = np.lexsort((a, group))
    members = np.diff(np.append(first, len(a)))
    total = np.add.reduceat(a[order] * (2 * time + 1 - members[group]), first)  # groups are runs, so places in them stay
    yield pa.RecordBatch.from_arrays([rows["uid"].combine_chunks().take(pa.array(first)), rows["_part"].combine_chunks().take(pa.array(first)),
                                      pa.array(right), pa.array(total)], ["uid", "_part", "_right", "_total"])


def _label_weights(shared):
    """Weights of pairs across buckets, and of all pairs, of groups that fill several; rows come by group and label.

    shared: for a partition the counts and sums per bucket that the partitions before it hold of its first group.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _table(batches, ["uid", "a", "bucket", "n", "_part"])
        if rows is None:
            return
        group, first = _runs_of(rows["uid"])
        a, bucket, n = (rows[c].to_numpy() for c in ("a", "bucket", "n"))
        right, run_n, run_s = n * rising_weight(group, bucket, a, n), np.cumsum(n), np.cumsum(n * a)
        below_n, below_s = (r - v - (r - v)[first][group] for r, v in ((run_n, n), (run_s, n * a)))
        total = n * (a * below_n - below_s)
        if (carry := shared.value.get(rows["_part"][0].as_py())) is not None:
            buckets, counts, sums = carry
            head = group == 0
            at = np.searchsorted(buckets, bucket[head], "left")
            before_n, before_s = (np.concatenate([[0], np.cumsum(x)]) for x in (counts, sums))
            right[head] += n[head] * (a[head] * before_n[at] - before_s[at])
            total[head] += n[head] * (a[head] * before_n[-1] - before_s[-1])
        yield pa.RecordBatch.from_arrays([rows["uid"].combine_chunks().take(pa.array(first)), pa.array(np.add.reduceat(right, first)),
                                          pa.array(np.add.reduceat(total, first))], ["uid", "_right", "_total"])
    return run


def _carried(parts: DataFrame) -> dict:
    """Of each partition's first group: counts and sums per bucket in the partitions before. Only groups that run over a
    border have any, so this holds numbers per (partition, bucket) and no labels."""
    held = parts.groupBy("uid", "_part", "bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("a")).alias("s"))
    firsts = parts.groupBy("_part").agg(F.min_by("uid", "_seq").alias("uid"))
    over = held.alias("h").join(F.broadcast(firsts).alias("f"), (F.col("h.uid").eqNullSafe(F.col("f.uid"))) & (F.col("h._part") < F.col("f._part")))
    pdf = over.groupBy("f._part", "h.bucket").agg(F.sum("h.n").alias("n"), F.sum("h.s").alias("s")).toPandas().sort_values("bucket")
    return {int(p): tuple(x[c].to_numpy() for c in ("bucket", "n", "s")) for p, x in pdf.groupby("_part")}


def ranking_accuracy(rows: DataFrame, acc: str = "acc", score: str = "score") -> DataFrame:
    """Pairwise ranking accuracy per group, weighted by the label gap, without forming pairs.

    In (score, row) order the right weight is the sum of acc_j - acc_i over i before j with acc_i below acc_j. Rows
    are cut into range buckets by group and score; pairs inside a bucket are counted by merging in its task. A group
    that runs over a border (at most one for each border) also has pairs between buckets: its labels become a
    histogram by bucket, which is read in label order with the counts per bucket carried along. Rows without a label
    or score count in no pair.
    """
    base = rows.select("uid", "row_id", F.col(acc).cast("double").alias("a"), F.col(score).alias("s")).where("a IS NOT NULL AND s IS NOT NULL")
    parts = ordered_parts(base, [F.col("uid"), F.col("s"), F.col("row_id")])
    uid = dict(base.dtypes)["uid"]
    inside = cut(parts.select("uid", "a", "_part").mapInArrow(_bucket_weights, f"uid {uid}, _part int, _right double, _total double"))
    sums = inside.groupBy("uid").agg(F.sum("_right").alias("_right"), F.sum("_total").alias("_total"), F.count(F.lit(1)).alias("_buckets"))
    whole, wide = sums.where("_buckets = 1"), sums.where("_buckets > 1")  # of the latter, one for each border at most
    spread_out = parts.join(F.broadcast(wide.select(F.col("uid").alias("w"))), F.col("uid").eqNullSafe(F.col("w")), "left_semi")
    labels = spread_out.groupBy("uid", "a", F.col("_part").cast("bigint").alias("bucket")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    by_label = ordered_parts(labels, [F.col("uid"), F.col("a"), F.col("bucket")])
    shared = rows.sparkSession.sparkContext.broadcast(_carried(by_label))
    across = by_label.select("uid", "a", "bucket", "n", "_part").mapInArrow(_label_weights(shared), f"uid {uid}, _right double, _total double")
    both = wide.select("uid", "_right", F.lit(0.0).alias("_total")).unionByName(across)
    weights = whole.select("uid", "_right", "_total").unionByName(both.groupBy("uid").agg(F.sum("_right").alias("_right"), F.sum("_total").alias("_total")))
    return weights.select("uid", F.when(F.col("_total") > NO_GAP, F.col("_right") / F.col("_total")).otherwise(0.5).alias("accuracy"))


def mean_ranking_accuracy(rows: DataFrame, acc: str = "acc", score: str = "score") -> DataFrame:
    """Mean over the groups."""
    return ranking_accuracy(rows, acc, score).agg(F.avg("accuracy").alias("accuracy"))


def sign_accuracy(rows: DataFrame, acc: str = "acc", score: str = "score") -> DataFrame:
    same = F.signum(F.col(score)) == F.signum(F.col(acc) * 2 - 1)
    return rows.agg(F.avg(same.cast("double")).alias("accuracy"))


# ---- summaries --------------------------------------------------------------------------

def rollout_summary(rows: DataFrame, max_response: int, max_prompt: int) -> DataFrame:
    """Scores, rewards, token-level advantage / return / value statistics and lengths in two aggregates."""
    def three(name: str, col: Column) -> list[Column]:
        return [F.avg(col).alias(f"{name}_mean"), F.max(col).alias(f"{name}_max"), F.min(col).alias(f"{name}_min")]

    seq = rows.agg(
        *three("score", F.col("score")), *three("reward", F.col("reward")), *three("response_length", F.col("response_length")),
        F.avg((F.col("response_length") == max_response).cast("int")).alias("response_clip_ratio"),
        *three("prompt_length", F.col("prompt_length")),
        F.avg((F.col("prompt_length") == max_prompt).cast("int")).alias("prompt_clip_ratio"), *three("turns", F.col("turns")))
    z = F.filter(F.arrays_zip(F.col("advantages").alias("a"), F.col("returns").alias("r"),
                              F.col("token_values").alias("v"), F.col("mask").alias("m")), lambda x: x["m"] == 1)
    tok = rows.select(F.explode(z).alias("x")).agg(
        *three("advantage", F.col("x.a")), *three("return", F.col("x.r")), *three("value", F.col("x.v")),
        (1.0 - F.var_samp(F.col("x.r") - F.col("x.v")) / (F.var_samp("x.r") + 1e-5)).alias("explained_variance"))
    return seq.crossJoin(tok)  # one row each


def throughput(rows: DataFrame, timings: DataFrame, devices: int) -> DataFrame:
    """Per phase: seconds, milliseconds per token (generation counts response tokens only) and, for
    the whole step, tokens per second and device. `timings`: phase, seconds - one row per phase."""
    totals = rows.agg(F.sum("prompt_length").alias("_p"), F.sum("response_length").alias("_r"))
    t = timings.crossJoin(F.broadcast(totals))  # one row
    every = F.col("_p") + F.col("_r")
    known = F.col("phase").isin("ref", "values", "adv", "update_critic", "update_actor")
    base = F.when(F.col("phase") == "gen", F.col("_r")).when(known, every)
    return t.select("phase", "seconds", (F.col("seconds") * 1000 / base).alias("ms_per_token"),
                    F.when(F.col("phase") == "step", every / (F.col("seconds") * devices)).alias("throughput"))


def reduce_metrics(long: DataFrame) -> DataFrame:
    """metric, value rows to one value per metric: max or min by name, mean otherwise."""
    m = F.col("metric")
    return long.groupBy("metric").agg(
        F.max("value").alias("_hi"), F.min("value").alias("_lo"), F.avg("value").alias("_mid")).select(
        "metric", F.when(F.contains(m, F.lit("max")), F.col("_hi")).when(F.contains(m, F.lit("min")), F.col("_lo"))
        .otherwise(F.col("_mid")).alias("value"))


def group_index(rows: DataFrame, label: str) -> DataFrame:
    """Adds `gidx`: whole-number labels keep their value, any other set of labels is numbered by sorted order.

    As in the table-wide rule, one label that is not a whole number makes all of them symbols.
    """
    groups = rows.groupBy(F.col(label).cast("string").alias("_label")).agg(F.count(F.lit(1)).alias("_members"))
    number = F.col("_label").try_cast("double")
    whole = F.coalesce(F.abs(number - F.round(number)) <= 1e-6, F.lit(False))
    numbered = row_numbers(groups.withColumn("_whole", whole), [F.col("_label")], "_rn")
    verdict = with_totals(numbered, [F.min("_whole").alias("_all_whole")])
    indexed = verdict.select("_label", "_members", F.when(
        F.col("_all_whole"), F.round(F.col("_label").try_cast("double")).try_cast("bigint")).otherwise(
        F.col("_rn") - 1).alias("gidx"))
    keyed = rows.withColumn("_label", F.col(label).cast("string"))
    return lookup_join(keyed, indexed, ["_label"], "left").drop("_label", "_members")


def floored_group_stats(rows: DataFrame, group: str, score: str, eps: float = EPS) -> DataFrame:
    """mean, std = sqrt(max(var, eps)) and count per group; a lone row gives (0, 1)."""
    alone = F.count(F.lit(1)) == 1
    return rows.groupBy(group).agg(
        F.when(alone, 0.0).otherwise(F.avg(score)).alias("mean"),
        F.when(alone, 1.0).otherwise(F.sqrt(F.greatest(F.var_samp(score), F.lit(eps)))).alias("std"),
        F.count(F.lit(1)).alias("n"))
