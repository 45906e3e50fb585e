"""Information-point and judge metrics. The judge itself is a caller-supplied function
`pandas.Series -> iterable of replies`, called once per Arrow batch inside the tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import non_empty, once, strip
from ..functions.sid import after_last_think
from ..session import cut

Judge = Callable[[pd.Series], "pd.Series | list"]
POINTS = "array<struct<info_point:string,importance_score:int>>"
MATCHES = (
    "struct<matches:array<struct<gt_wip:struct<info_point:string,importance_score:int>,"
    "model_wip:struct<info_point:string,importance_score:int>,match_quality:double>>,"
    f"unmatched_model_wips:{POINTS},unmatched_gt_wips:{POINTS}>"
)
KEYWORD = "精炼推理"  # fixed value: heading in front of the refined reasoning
CORE = 5
CALL_BYTES = 8_000_000  # prompts that a worker holds as Python texts


def batch_call(rows: DataFrame, key: str, prompt: str, judge: Judge) -> DataFrame:
    """key, result, error, success for every row; a failing batch is retried row by row.

    The judge is called for runs of rows with about CALL_BYTES of prompts, a single longer prompt alone.
    """
    key_type = dict(rows.dtypes)[key]

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CALL_BYTES, "right")))
                asked = batch.column(1).slice(at, to - at).to_pandas()
                try:
                    replies, errors = list(judge(asked)), [None] * len(asked)
                except Exception:  # noqa: BLE001 - one bad prompt must not fail its batch
                    replies, errors = [], []
                    for i in range(len(asked)):
                        try:
                            replies += list(judge(asked.iloc[i:i + 1]))
                            errors.append(None)
                        except Exception as exc:  # noqa: BLE001
                            replies.append(None)
                            errors.append(str(exc))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), pa.array(replies, pa.string(), from_pandas=True), pa.array(errors, pa.string()),
                     pa.array([e is None for e in errors], pa.bool_())], ["key", "result", "error", "success"])
                at = to

    asked = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{prompt}`").cast("string").alias("prompt"))
    replied = asked.mapInArrow(call, f"key {key_type}, result string, error string, success boolean")
    return replied.withColumnRenamed("key", key)


def _unfence(text: Column) -> Column:
    t = strip(text)
    t = F.regexp_replace(t, r"^```(json)?", "")
    return strip(F.regexp_replace(t, r"```$", ""))


def tolerant_json(text: Column, schema: str) -> Column:
    """Reply as a struct: code fence removed, else the first flat {...} in the text."""
    whole = _unfence(text)
    flat = F.regexp_extract(text, r"(?s)\{[^{}]*\}", 0)
    usable = F.when(F.try_parse_json(whole).isNotNull(), whole).when(F.try_parse_json(flat).isNotNull(), flat)
    return F.from_json(usable, schema)


def extract_points(texts: DataFrame, judge: Judge, out: str = "wips") -> DataFrame:
    """sample_id, points for texts whose reply is a non-empty JSON list."""
    replies = batch_call(texts, "sample_id", "text", judge)
    points = F.from_json(_unfence(F.col("result")), POINTS)
    return once(replies.select("sample_id", "result"), **{out: points}).drop("result").where(F.size(out) > 0)


def match_points(truth: DataFrame, model: DataFrame, judge: Judge) -> DataFrame:
    """sample_id, match for samples with points on both sides and a complete reply."""
    both = truth.where(F.size("gt_wips") > 0).join(model.where(F.size("model_wips") > 0), "sample_id")
    asked = both.select("sample_id", F.to_json(F.struct("gt_wips", "model_wips")).alias("pair"))
    replies = batch_call(asked, "sample_id", "pair", judge).select("sample_id", "result")
    parsed = once(replies, match=F.from_json(_unfence(F.col("result")), MATCHES)).drop("result")
    complete = [F.col(f"match.{k}").isNotNull() for k in ("matches", "unmatched_model_wips", "unmatched_gt_wips")]
    return parsed.where(complete[0] & complete[1] & complete[2])


def fill_quality(matched: DataFrame, similarity: Callable[[pd.Series, pd.Series], pd.Series]) -> DataFrame:
    """match_quality where missing and both texts are set; a sample's match list is bounded by the judge reply."""
    measure = F.pandas_udf(similarity, "double")
    flat = matched.select("sample_id", F.posexplode("match.matches").alias("at", "m"))
    need = F.col("m.match_quality").isNull() & non_empty(F.col("m.gt_wip.info_point")) & non_empty(
        F.col("m.model_wip.info_point"))
    todo = flat.where(need).select(
        "sample_id", "at", measure(F.col("m.gt_wip.info_point"), F.col("m.model_wip.info_point")).alias("q"))
    per_sample = todo.groupBy("sample_id").agg(F.map_from_entries(F.collect_list(F.struct("at", "q"))).alias("_q"))
    return matched.join(per_sample, "sample_id", "left").withColumn(
        "match", F.col("match").withField("matches", F.transform(
            F.col("match.matches"),
            lambda m, i: m.withField("match_quality", F.coalesce(m["match_quality"], F.try_element_at(F.col("_q"), i)))
        ))).drop("_q")


def with_cache(cached: DataFrame, wanted: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Cached rows of the wanted ids plus computed rows for ids not in the cache."""
    missing = wanted.join(cached.select("sample_id"), "sample_id", "left_anti")
    kept = cached.join(wanted.select("sample_id"), "sample_id", "left_semi")
    return kept.unionByName(compute(missing))


def _score(point: Column) -> Column:
    return F.coalesce(point["importance_score"], F.lit(1)).cast("double")


def _total(arr: Column, value: Callable[[Column], Column]) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda s, x: s + value(x))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    size = 2 * tp + fp + fn
    return F.when(size > 0, 2 * tp / size).otherwise(0.0)


def f1_scores(core: int = CORE) -> dict[str, Column]:
    """Six F1 scores of a `match` struct: plain, importance-weighted and double-weighted, overall and core."""
    matches, extra, missed = (F.col(f"match.{k}") for k in ("matches", "unmatched_model_wips", "unmatched_gt_wips"))

    def single(weight: Callable[[Column], Column]):
        tp = _total(matches, lambda m: weight(m["gt_wip"]))
        return _f1(tp, _total(extra, weight), _total(missed, weight))

    def core_only(weight):
        return lambda p: F.when(_score(p) >= core, weight(p)).otherwise(0.0)

    def double(keep: Callable[[Column], Column]):
        def part(value):
            return _total(matches, lambda m: F.when(m["match_quality"].isNotNull(), value(m)).otherwise(0.0))
        tp = part(lambda m: keep(m["gt_wip"]) * m["match_quality"])
        fn = part(lambda m: keep(m["gt_wip"]) * (1 - m["match_quality"]))
        fp = part(lambda m: keep(m["model_wip"]) * (1 - m["match_quality"]))
        return _f1(tp, fp + _total(extra, keep), fn + _total(missed, keep))

    one = lambda p: F.lit(1.0)
    return {
        "wip_unweighted_f1": single(one), "wip_unweighted_core_f1": single(core_only(one)),
        "wip_importance_weighted_f1": single(_score), "wip_importance_weighted_core_f1": single(core_only(_score)),
        "wip_double_weighted_f1": double(_score), "wip_double_weighted_core_f1": double(core_only(_score)),
    }


def score_matches(matched: DataFrame, core: int = CORE) -> DataFrame:
    return matched.select("sample_id", *[c.alias(n) for n, c in f1_scores(core).items()])


def macro(per_sample: DataFrame) -> DataFrame:
    names = [c for c in per_sample.columns if c.startswith("wip_")]
    return per_sample.agg(*[F.coalesce(F.avg(n), F.lit(0.0)).alias("macro_" + n) for n in names],
                          F.count(F.lit(1)).alias("wip_num_samples"))


def evaluate_points(predictions: DataFrame, references: DataFrame, extract: Judge, match: Judge,
                    similarity, max_samples: int | None = None, core: int = CORE) -> tuple[DataFrame, DataFrame]:
    """(macro scores, per-sample scores). Samples without a match score 0 but do not enter the macro mean."""
    ids = predictions.select("sample_id").join(references.select("sample_id"), "sample_id")
    if max_samples is not None:
        ids = ids.orderBy("sample_id").limit(max_samples)
    # Every judge reply is kept in a checkpoint: it is asked for once, however often it is read.
    truth = cut(extract_points(references.join(ids, "sample_id"), extract, "gt_wips"))
    # Model texts are only worth a judge call where the truth gave points.
    model_ids = truth.select("sample_id")
    model = extract_points(predictions.join(model_ids, "sample_id"), extract, "model_wips")
    scored = cut(score_matches(fill_quality(cut(match_points(truth, model, match)), similarity), core))
    names = [c for c in scored.columns if c != "sample_id"]
    every = ids.join(scored, "sample_id", "left").select(
        "sample_id", *[F.coalesce(n, F.lit(0.0)).alias(n) for n in names])
    return macro(scored), every


def refined_reasoning(text: Column, keyword: str = KEYWORD) -> Column:
    """Text after the last heading without leading marks, else the whole trimmed text."""
    after = F.element_at(F.split(text, keyword, -1), -1)
    cleaned = strip(F.regexp_replace(after, r"^[\s*#：:]+", ""))
    whole = strip(text)
    return F.when(F.contains(text, F.lit(keyword)) & (cleaned != ""), cleaned).otherwise(whole)


def reasoning_text(generation: Column) -> Column:
    tail = F.when(F.contains(generation, F.lit("</think>")), strip(after_last_think(generation))).otherwise(generation)
    return refined_reasoning(tail)


VERDICT = "struct<llm_score:string,llm_reason:string>"


def judge_score(reply: Column) -> Column:
    """Score of a reply: required key, anything not a number in 1..5 becomes 3."""
    raw = tolerant_json(reply, VERDICT)["llm_score"]
    number = raw.try_cast("double")
    return F.when(raw.isNotNull(), F.when(number.between(1, 5), number).otherwise(3.0))


def judge_pairs(pairs: DataFrame, judge: Judge) -> DataFrame:
    """sample_id, llm_score, llm_reason for (sample_id, gt, model) rows with both texts."""
    asked = pairs.where(non_empty(F.col("gt")) & non_empty(F.col("model"))).select(
        "sample_id", F.to_json(F.struct("gt", "model")).alias("pair"))
    reply = F.col("result")
    return batch_call(asked, "sample_id", "pair", judge).select(
        "sample_id", judge_score(reply).alias("llm_score"), tolerant_json(reply, VERDICT)["llm_reason"].alias("llm_reason")
    ).where("llm_score IS NOT NULL")


def evaluate_reasoning(predictions: DataFrame, references: DataFrame, judge: Judge, cached: DataFrame) -> DataFrame:
    """Per-sample judge scores: join, extract the refined part, reuse the cache, judge the rest."""
    pairs = predictions.select("sample_id", reasoning_text(F.col("text")).alias("model")).join(
        references.select("sample_id", reasoning_text(F.col("text")).alias("gt")), "sample_id")
    return cut(with_cache(cached, pairs, lambda missing: judge_pairs(missing, judge)))


def judge_summary(scores: DataFrame) -> DataFrame:
    s = F.when(F.col("llm_score").between(1, 5), F.col("llm_score"))
    return scores.agg(F.avg(s).alias("llm_score"), F.count(F.lit(1)).alias("llm_eval_num_samples"))


def detailed_rows(ids: DataFrame, *tables: DataFrame) -> DataFrame:
    """Everything known about each sample side by side, for a result sink."""
    for t in tables:
        ids = ids.join(t, "sample_id", "left")
    return ids

