"""Rule rewards: every scorer is a Column over prediction and truth, so a reward pass is one
projection; only the roll-ups aggregate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import answers as A
from ..functions.common import bound, once
from ..functions.sid import THINK_BEGIN, THINK_END, code_triples
from .keyed import lookup_join


def _zero() -> Column:
    return F.lit(0.0)


def _flag(cond: Column) -> Column:
    return F.when(cond, 1.0).otherwise(0.0)


def think_format(pred: Column) -> Column:
    """1 when the first think block holds more than ten characters besides white space."""
    start = F.instr(pred, THINK_BEGIN)
    end = F.instr(pred, THINK_END)
    inside = F.substring(pred, start + len(THINK_BEGIN), end - start - len(THINK_BEGIN))
    letters = F.length(F.regexp_replace(inside, r"[ \n\r\t]", ""))
    return _flag((start > 0) & (end >= start + len(THINK_BEGIN)) & (letters > 10))


def after_first_think(pred: Column) -> Column:
    """Text behind the first think end, NULL unless both marks occur."""
    both = F.contains(pred, F.lit(THINK_BEGIN)) & F.contains(pred, F.lit(THINK_END))
    return F.when(both, F.substring(pred, F.instr(pred, THINK_END) + len(THINK_END), F.length(pred)))


def _partial(named: Column, goals: Column) -> Column:
    def mean(both: Column) -> Column:
        p_all, g_all = both["p"], both["g"]
        # The goals as one text, so that a prefix of a triple is found there and no goal is cut for it.
        listed = F.concat(F.lit(";"), F.array_join(g_all, ";"), F.lit(";"))
        each = bound(listed, lambda text: F.transform(p_all, lambda p: F.when(F.contains(text, F.concat(F.lit(";"), p, F.lit(";"))), 100.0)
                     .when(F.contains(text, F.concat(F.lit(";"), F.substring_index(p, ",", 2), F.lit(","))), 10.0)
                     .when(F.contains(text, F.concat(F.lit(";"), F.substring_index(p, ",", 1), F.lit(","))), 1.0).otherwise(0.0)))
        total = F.aggregate(each, F.lit(0.0), lambda s, x: s + x)
        return F.when((F.size(p_all) > 0) & (F.size(g_all) > 0), total / F.size(p_all)).otherwise(_zero())

    return bound(F.struct(named.alias("p"), goals.alias("g")), mean)


def _ratio(named: Column, goals: Column) -> Column:
    return bound(F.struct(named.alias("p"), goals.alias("g")), lambda x: F.when(
        (F.size(x["p"]) > 0) & (F.size(x["g"]) > 0), F.size(F.array_intersect(x["p"], x["g"])) / F.size(x["p"])).otherwise(_zero()))


def _goals(truth: Column, parsed: bool) -> Column:
    """Triples of a truth text; `parsed`: the column holds them already, as one truth of many predictions should."""
    return truth if parsed else code_triples(truth)


def _first(named: Column, goals: Column) -> Column:
    return _flag(F.coalesce(F.array_contains(goals, F.get(named, 0)), F.lit(False)))


def _any(named: Column, goals: Column) -> Column:
    return _flag(F.coalesce(F.arrays_overlap(named, goals), F.lit(False)))


def partial_hit(pred: Column, truth: Column, parsed: bool = False) -> Column:
    """Mean over predicted triples of 100 / 10 / 1 for a match on three, two or one level."""
    return _partial(code_triples(pred), _goals(truth, parsed))


def hit_ratio(pred: Column, truth: Column, parsed: bool = False) -> Column:
    """Distinct hits behind the think block over the number of predictions, repeats counted."""
    return _ratio(code_triples(after_first_think(pred)), _goals(truth, parsed))


def first_hit(pred: Column, truth: Column, parsed: bool = False) -> Column:
    return _first(code_triples(after_first_think(pred)), _goals(truth, parsed))


def pass_rate(pred: Column, truth: Column, parsed: bool = False) -> Column:
    """1 when any triple of the whole text, thinking included, is in the truth."""
    return _any(code_triples(pred), _goals(truth, parsed))


def recommendation_scores(rows: DataFrame, pred: str, truth: str, parsed: bool = False) -> DataFrame:
    """All recommendation rewards of a table; every text is searched for triples once."""
    p = F.col(pred)
    parts = dict(_all=code_triples(p), _end=code_triples(after_first_think(p)))
    s = once(rows, **parts) if parsed else once(rows, **parts, _goal=code_triples(F.col(truth)))
    goal = F.col(truth if parsed else "_goal")  # goals that a column holds stay there
    first = _first(F.col("_end"), goal)
    return s.withColumns({
        "score": first, "format_reward": think_format(p), "partial_hit_reward": _partial(F.col("_all"), goal),
        "hit_reward": _ratio(F.col("_end"), goal), "pass_rate": _any(F.col("_all"), goal),
        "pass_at_1": first}).drop("_all", "_end", "_goal")


def number_score(pred: Column, truth: Column, flexible: bool = False, format_score: float = 0.0) -> Column:
    got = A.final_number(pred, flexible)
    return F.when(got.isNull(), 0.0).when(got == truth, 1.0).otherwise(float(format_score))


def boxed_score(pred: Column, truth: Column) -> Column:
    return _flag(A.same_math(A.boxed_answer(pred), truth))


def final_answer_scores(pred: Column, truth: Column) -> dict[str, Column]:
    """+1 / -1 on the last answer line of the clipped solution."""
    got = A.tidy_final(A.final_line(A.last_chars(pred, A.CLIP)))
    ok = got == A.tidy_final(truth)
    return {"score": F.when(ok, 1.0).otherwise(-1.0), "acc": ok, "pred": got}


def strict_box_scores(pred: Column, truth: Column) -> dict[str, Column]:
    """+1 / -1 on the boxed content within the last hundred characters, compared as it is."""
    got = A.boxed_span(A.last_chars(pred, 100))
    ok = F.coalesce(got == truth, F.lit(False))
    return {"score": F.when(ok, 1.0).otherwise(-1.0), "acc": ok, "pred": got}


def qa_score(pred: Column, truths: Column, substring: bool = False, format_score: float = 0.0) -> Column:
    """Exact (or contained) answer after tidying; more than ten answer tags cost three quarters."""
    raw = A.tagged_answer(pred)
    got = A.tidy_qa(raw)
    goals = F.transform(truths, A.tidy_qa)
    if substring:
        ok = F.exists(goals, lambda g: F.contains(got, g))
        worth = F.lit(1.0)
    else:
        ok = F.array_contains(goals, got)
        many = (A.occurrences(pred, "<answer>") > 10) | (A.occurrences(pred, "</answer>") > 10)
        worth = F.when(many, 0.25).otherwise(1.0)
    return F.when(raw.isNull(), 0.0).when(ok, worth).otherwise(float(format_score))


def blended_score(pred: Column, truth: Column, format_share: float = 0.1) -> Column:
    shaped = F.rlike(pred, F.lit(r"(?s)^<think>.*</think>.*\\boxed\{.*\}.*$"))
    return boxed_score(pred, truth) * (1.0 - format_share) + _flag(shaped) * format_share


def overlong_penalty(length: Column, max_len: int, buffer: int, factor: float) -> Column:
    exceed = length - (max_len - buffer)
    return F.least(-exceed / F.lit(float(buffer)) * factor, _zero())


def choice_score(pred: Column, truth: Column) -> Column:
    return _flag(F.coalesce(A.choice_letter(pred) == truth, F.lit(False)))


def error_step_scores(pred: Column, truth: Column, steps: Column) -> dict[str, Column]:
    """Boxed step number against the true first error step; -1 stands for no error."""
    raw = F.trim(A.boxed_span(A.last_chars(pred, A.CLIP))).try_cast("int")
    got = F.when((raw == -1) | ((raw >= 0) & (raw < steps)), raw)
    near = F.lit(1.0) - F.abs(got - truth) / steps
    score = (F.when(got.isNull(), -1.0).when(truth == -1, F.when(got == -1, 1.0).otherwise(-1.0))
             .when(got == -1, -1.0).otherwise(near))
    right = F.when(got.isNull(), F.lit(False)).otherwise((truth == -1) == (got == -1))
    return {"score": score, "acc": right, "pred": got}


def new_turn_tokens(messages: Column, prompt_size: Column) -> Column:
    """White-space tokens of the turns behind the prompt."""
    later = F.slice(messages, prompt_size + 1, F.greatest(F.size(messages) - prompt_size, F.lit(0)))
    return F.aggregate(later, F.lit(0), lambda s, m: s + F.size(
        F.filter(F.split(m["content"], r"\s+"), lambda w: w != "")))


def dispatch(source: Column, scorers: dict[tuple[str, ...], Column]) -> Column:
    """Score by data source; a source without a scorer is an error."""
    out = None
    for names, score in scorers.items():
        hit = source.isin(*names)
        out = F.when(hit, score) if out is None else out.when(hit, score)
    return out.otherwise(F.raise_error(F.concat(F.lit("no reward for "), source)).cast("double"))


def conversation_reward(metrics: DataFrame, weights: DataFrame, row: str = "row_id") -> DataFrame:
    """Per metric: weight * mean over repeats, clamped to [-1, 1]; then the sum over metrics.

    `metrics`: row, metric, value (NULL = failed, counts 0); `weights`: metric, weight (one row per metric name).
    """
    mean = metrics.groupBy(row, "metric").agg(F.avg(F.coalesce("value", F.lit(0.0))).alias("_m"))
    weighted = lookup_join(mean, weights, ["metric"]).withColumn(
        "_w", F.greatest(F.least(F.col("_m") * F.col("weight"), F.lit(1.0)), F.lit(-1.0)))
    return weighted.groupBy(row).agg(F.sum("_w").alias("reward"))


def offline_evaluation(responses: DataFrame, row: list[str], source: str = "data_source",
                       score: str = "score") -> DataFrame:
    """Mean over a row's responses, then the mean of rows per source."""
    per_row = responses.groupBy(source, *row).agg(F.avg(score).alias("_mean"))
    return per_row.groupBy(source).agg(F.avg("_mean").alias("test_score"))


def resolve_source(df: DataFrame, candidates: list[str]) -> Column:
    """First present source column, else 'unknown'."""
    for c in candidates:
        if c in df.columns:
            return F.coalesce(F.col(c), F.lit("unknown"))
    return F.lit("unknown")


def task_statistics(rows: DataFrame, keys: list[str], source: Column) -> DataFrame:
    """mean / max / min / count per (source, reward key), plus the 'all' rows."""
    long = rows.select(source.alias("source"), *[F.col(k).cast("double").alias(k) for k in keys]).unpivot(
        ["source"], keys, "key", "value")
    out = long.groupingSets([["source", "key"], ["key"]], "source", "key").agg(
        F.avg("value").alias("mean"), F.max("value").alias("max"), F.min("value").alias("min"),
        F.count(F.lit(1)).alias("n"), F.grouping("source").alias("_all"))
    return out.withColumn("source", F.when(F.col("_all") == 1, "all").otherwise(F.col("source"))).drop("_all")


REGISTRY: dict[str, Callable] = {
    "number": number_score, "boxed": boxed_score, "choice": choice_score, "qa": qa_score,
    "blend": blended_score,
}
