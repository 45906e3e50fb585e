"""Hit metrics of recommendation generations.

One row per sample holds its bounded list of generations, so candidate ordering, id parsing
and the at-k metrics are array expressions without a shuffle. Only the id-to-item lookup
explodes the list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import bound, hash_int, head, non_blank
from ..functions.sid import after_last_think, answer_sids, generation_sids, packed_from_text
from .keyed import lookup_join

STRATEGIES = ("most_popular_originally", "most_popular_after_downsampling", "random")


def by_logprob(generations: Column, logprobs: Column) -> Column:
    """Stable descending sort; texts stay paired with their place."""
    ranked = F.transform(
        F.arrays_zip(generations.alias("g"), logprobs.alias("l")),
        lambda x, i: F.struct((-x["l"]).alias("o"), i.alias("i"), x["g"].alias("g")),
    )
    return F.transform(F.array_sort(ranked), lambda x: x["g"])


def select_candidates(generations: Column, logprobs: Column, strategy: str) -> Column:
    """`first_k` keeps the order; `top_k_by_logprobs` sorts and drops repeated texts."""
    if strategy == "first_k":
        return generations
    if strategy != "top_k_by_logprobs":
        raise ValueError(f"unknown strategy {strategy}")
    bad = (F.size(generations) > 0) & (F.size(generations) != F.coalesce(F.size(logprobs), F.lit(-1)))
    return F.when(bad, F.raise_error(F.lit("logprobs missing or of another length"))).otherwise(
        F.array_distinct(by_logprob(generations, logprobs)))


def unique_ids(generations: Column, limit: int, logprobs: Column | None = None,
               exclude: Column | None = None, sources: Column | None = None) -> Column:
    """First `limit` distinct ids as structs (id, source); blanks and excluded ids do not count."""
    src = sources if sources is not None else F.transform(generations, lambda g: F.lit(None).cast("string"))
    lp = logprobs if logprobs is not None else F.transform(generations, lambda g: F.lit(0.0))
    order = F.array_sort(F.transform(
        F.arrays_zip(generations.alias("g"), lp.alias("l"), src.alias("s")),
        lambda x, i: F.struct((-x["l"]).alias("o"), i.alias("i"), x["g"].alias("g"), x["s"].alias("s"))))
    full = F.filter(order, lambda x: non_blank(x["g"]))
    pairs = bound(full, lambda f: F.arrays_zip(
        generation_sids(F.transform(f, lambda x: x["g"])).alias("id"),
        F.transform(f, lambda x: x["s"]).alias("source")))
    banned = exclude if exclude is not None else F.array().cast("array<string>")

    def chosen(both: Column) -> Column:
        def add(acc: Column, x: Column) -> Column:
            skip = (F.size(acc) >= limit) | (x["id"] == "") | F.array_contains(both["banned"], x["id"]) | F.exists(
                acc, lambda a: a["id"] == x["id"])
            return F.when(skip, acc).otherwise(F.concat(acc, F.array(x)))

        return F.aggregate(both["pairs"], F.array().cast("array<struct<id:string,source:string>>"), add)

    return bound(F.struct(pairs.alias("pairs"), banned.alias("banned")), chosen)


def best_items(mapping: DataFrame, strategy: str = STRATEGIES[0], seed: int = 42) -> DataFrame:
    """Collapse collision lists to one item per code, by partial aggregation.

    Ties and the random strategy are decided by a seeded hash per (code, item), so a code
    always names the same item.
    """
    pid = F.col("pid")
    if strategy == STRATEGIES[0]:
        chosen = F.min_by(pid, F.col("ord"))
    elif strategy == STRATEGIES[1]:
        chosen = F.max_by(pid, F.struct("count_ds", hash_int(seed, F.col("code"), pid), pid))
    elif strategy == STRATEGIES[2]:
        chosen = F.max_by(pid, F.struct(hash_int(seed, F.col("code"), pid), pid))
    else:
        raise ValueError(f"unknown strategy {strategy}")
    return mapping.groupBy("code").agg(chosen.alias("pid"))


def generations_to_items(samples: DataFrame, keys: list[str], candidates: Column, items: DataFrame) -> DataFrame:
    """keys + `items`: one item id per candidate, 0 where no code or no item is known."""
    text = samples.select(*keys, F.posexplode(candidates).alias("at", "text"))
    coded = text.select(*keys, "at", packed_from_text(after_last_think(F.col("text"))).alias("code"))
    found = lookup_join(coded, items.select("code", "pid"), ["code"], "left")
    entry = F.struct("at", F.coalesce("pid", F.lit(0).cast("bigint")).alias("pid"))
    return found.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["pid"]).alias("items"))


def truth_items(pid_list: Column, iid_list: Column | None = None) -> Column:
    """Distinct non-zero item ids in order; JSON text is parsed, the iid list is the fallback."""
    both = pid_list if iid_list is None else F.coalesce(pid_list, iid_list)
    return F.array_distinct(F.filter(both, lambda x: x != 0))


def parse_item_json(text: Column) -> Column:
    return F.from_json(text, "array<bigint>")


def hits(pred: Column, truth: Column, ks: list[int], prefix: str = "", ignore: Column | None = None) -> dict[str, Column]:
    """pass@k, position1_pass@k and recall@k; samples without prediction or truth score nothing."""
    usable = F.coalesce((F.size(pred) > 0) & (F.size(truth) > 0), F.lit(False))
    out: dict[str, Column] = {}
    for k in ks:
        top = head(pred, k)
        if ignore is not None:
            top = F.array_remove(top, ignore)
        hit = F.coalesce(usable & F.arrays_overlap(top, truth), F.lit(False))
        first = F.coalesce(usable & F.array_contains(top, F.get(truth, 0)), F.lit(False))
        share = F.size(F.array_intersect(top, truth)) / F.size(truth)
        out[f"{prefix}pass@{k}"] = hit
        out[f"{prefix}position1_pass@{k}"] = first
        out[f"{prefix}recall@{k}"] = F.when(usable, share).otherwise(0.0)
    return out


def sid_metrics(samples: DataFrame, ks: list[int], strategy: str = "first_k") -> DataFrame:
    """Per-sample SID metrics; `samples` has generations, logprobs, answer."""
    chosen = samples.withColumn(
        "_pred", generation_sids(select_candidates(F.col("generations"), F.col("logprobs"), strategy))
    ).withColumn("_truth", answer_sids(F.col("answer")))
    scored = chosen.select("*", *[c.alias(n) for n, c in hits(F.col("_pred"), F.col("_truth"), ks).items()])
    return scored.drop("_pred", "_truth")


def item_metrics(samples: DataFrame, keys: list[str], ks: list[int], items: DataFrame,
                 strategy: str = "first_k") -> DataFrame:
    """Per-sample item-id metrics with a pid_ prefix, plus the mapped ids."""
    chosen = select_candidates(F.col("generations"), F.col("logprobs"), strategy)
    mapped = generations_to_items(samples, keys, chosen, items)
    rows = samples.select(*keys, truth_items(F.col("answer_pid")).alias("_truth")).join(mapped, keys, "left")
    return rows.select(*keys, *_item_columns(ks))


def _item_columns(ks: list[int]) -> list[Column]:
    """Item metrics of a row with `items` and `_truth`."""
    metrics = hits(F.col("items"), F.col("_truth"), ks, "pid_", F.lit(0).cast("bigint"))
    mapped = F.coalesce("items", F.array().cast("array<bigint>")).alias("pid_generations")
    return [mapped, *[c.alias(n) for n, c in metrics.items()]]


def overall(per_sample: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Mean over all samples, failures included."""
    return per_sample.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("samples"),
        *[F.avg(F.col(f"`{m}`").cast("double")).alias(m) for m in metrics])


def merged_metrics(samples: DataFrame, keys: list[str], ks: list[int], items: DataFrame,
                   strategy: str = "first_k") -> DataFrame:
    """SID and item metrics of every sample side by side."""
    sid = sid_metrics(samples, ks, strategy)
    names = [n for n in sid.columns if "@" in n]
    chosen = select_candidates(F.col("generations"), F.col("logprobs"), strategy)
    mapped = generations_to_items(samples, keys, chosen, items)
    rows = sid.select(*keys, *[f"`{n}`" for n in names], truth_items(F.col("answer_pid")).alias("_truth")).join(
        mapped, keys, "left")
    return rows.select(*keys, *[f"`{n}`" for n in names], *_item_columns(ks))


def debug_rows(samples: DataFrame, keys: list[str], ks: list[int]) -> DataFrame:
    """Top-10 ids, truth, pass flags and a shortened prompt."""
    scored = sid_metrics(samples, ks)
    prompt = F.col("prompt")
    snippet = F.when(F.length(prompt) > 200, F.concat(F.substring(prompt, 1, 200), F.lit("..."))).otherwise(prompt)
    truth = answer_sids(F.col("answer"))
    return scored.select(
        *keys, truth.alias("truth"), F.coalesce(F.get(truth, 0), F.lit("")).alias("first_truth"),
        generation_sids(head(F.col("generations"), 10)).alias("top_ids"),
        *[f"`{n}`" for n in scored.columns if "pass@" in n], snippet.alias("prompt_snippet"))


def fan_out(samples: DataFrame, keys: list[str], marker: str = "") -> DataFrame:
    """Stage two input: one row per (sample, thinking text) with its composed prompt."""
    rows = samples.select(*keys, "prompt", F.posexplode("thinkings").alias("idx", "thinking"))
    return rows.withColumn("stage2_prompt", F.concat("prompt", "thinking", F.lit("</think>\n" + marker)))


def regroup(stage2: DataFrame, keys: list[str], marker: str = "") -> DataFrame:
    """Thinking text, marker and each stage-two output back to one ordered list per sample.

    `stage2`: keys, idx, thinking, outputs[], input_tokens, output_tokens, time. Tokens add up,
    stage time is the slowest candidate.
    """
    joined = F.transform("outputs", lambda o: F.concat(F.col("thinking"), F.lit("</think>\n" + marker), o))
    return stage2.groupBy(*keys).agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("idx", joined.alias("t")))), lambda x: x["t"]))
        .alias("generations"),
        F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"),
        F.max("time").alias("time"))
