"""Steps that are done once a row or a sample, and what their plans move."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sidweave.functions.sid import code_triples
from sidweave.llm import repair_ids, strata_search
from sidweave.operators import builders as B
from sidweave.operators import judge as J
from sidweave.operators import quantizer as Q
from sidweave.operators import recmetrics as R
from sidweave.operators import retrieval as R2
from sidweave.operators import rewards as W
from sidweave.operators import rollups as L
from sidweave.plans import testbed as TB
from sidweave.plans.all_queries import QUERIES
from sidweave.session import one_row_batches

SID = "<|sid_begin|><s_a_{}><s_b_{}><s_c_{}><|sid_end|>"


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_samples_move_codes_not_texts(spark, sf):
    """Ids become text behind the last shuffle of the sample's rows."""
    plan = optimized(TB.generations(spark, sf).select("sample_id", "generations"))
    assert "format_string" not in plan
    assert "RepartitionByExpression [cust" in plan


def test_unique_ids_parses_a_sample_once(spark, sf):
    plan = optimized(QUERIES["H8_unique_ids"](spark, sf))
    assert plan.count("array_distinct") == 1
    rows = spark.createDataFrame([([SID.format(1, 2, 3), " ", SID.format(1, 2, 3), "x", SID.format(4, 5, 6)], [0.0, 9.0, 1.0, -1.0, -2.0], SID.format(4, 5, 6))],
                                 "g array<string>, l array<double>, answer string")
    got = rows.select(R.unique_ids(F.col("g"), 3, F.col("l"), F.array(F.lit("<s_a_4><s_b_5><s_c_6>"))).alias("u")).first().u
    assert [(x.id, x.source) for x in got] == [("<s_a_1><s_b_2><s_c_3>", None), ("x", None)]


def test_partial_hit_searches_each_text_once(spark):
    rows = spark.createDataFrame([("<s_a_1><s_b_2><s_c_3> <s_a_1><s_b_2><s_c_9><s_a_1><s_b_8><s_c_9><s_a_7><s_b_8><s_c_9>", SID.format(1, 2, 3)), ("no", SID.format(1, 2, 3)),
                                  (None, SID.format(1, 2, 3)), (SID.format(1, 2, 3), "")], "p string, t string")
    out = rows.select(W.partial_hit(F.col("p"), F.col("t")).alias("v"))
    assert optimized(out).count("regexp_extract_all") == 2
    assert [r.v for r in out.collect()] == [111 / 4, 0.0, 0.0, 0.0]


def test_hit_ratio_searches_each_text_once(spark):
    rows = spark.createDataFrame([("<think>a</think>" + SID.format(1, 2, 3) * 2 + SID.format(4, 5, 6), SID.format(1, 2, 3)), ("x", SID.format(1, 2, 3))], "p string, t string")
    out = rows.select(W.hit_ratio(F.col("p"), F.col("t")).alias("v"))
    assert optimized(out).count("regexp_extract_all") == 2
    assert [r.v for r in out.collect()] == [1 / 3, 0.0]


def test_score_bundle_takes_triples_of_an_answer(spark, sf):
    rows = spark.createDataFrame([("<think>a</think>" + SID.format(1, 2, 3), SID.format(1, 2, 3))], "p string, t string")
    plain = W.recommendation_scores(rows, "p", "t").drop("p", "t").first()
    once = W.recommendation_scores(rows.withColumn("t", code_triples(F.col("t"))), "p", "t", parsed=True).drop("p", "t").first()
    assert plain == once and plain.score == 1.0 and plain.hit_reward == 1.0
    assert optimized(QUERIES["J7_score_bundle"](spark, sf)).count("explode") == 4  # interactions; per sample the answer, then its outputs; each output


def test_partial_hit_cuts_predictions_only(spark):
    rows = spark.createDataFrame([(SID.format(1, 2, 3) + SID.format(11, 2, 3) + SID.format(1, 22, 3) + SID.format(1, 2, 33), ["1,2,3", "21,2,3"])], "p string, g array<string>")
    out = rows.select(W.partial_hit(F.col("p"), F.col("g"), parsed=True).alias("v"))
    assert optimized(out).count("substring_index") == 2
    assert out.first().v == (100 + 0 + 1 + 10) / 4


def test_score_bundle_leaves_given_goals_where_they_are(spark):
    rows = spark.createDataFrame([("x", ["1,2,3"])], "p string, t array<string>")
    assert "_goal" not in optimized(W.recommendation_scores(rows, "p", "t", parsed=True))


def test_outputs_become_rows_before_texts(spark, tmp_path):
    def put(name, rows, ddl):
        spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / f"{name}.parquet"))

    put("customer", [(1, 5.0, "A"), (2, -1.0, "B"), (3, 0.0, "C"), (3, 0.0, "C"), (4, None, "D"), (5, 1.0, "E"), (None, 1.0, "F")],
        "c_custkey bigint, c_acctbal double, c_mktsegment string")
    put("orders", [(k, k % 4 + 1 if k else None, "1995-01-02") for k in range(24)], "o_orderkey bigint, o_custkey bigint, o_orderdate string")
    put("lineitem", [(k, n, (k * 5 + n) % 9 if k % 7 else None, n, 1.0 * n, 30.0, 0.1, "AN"[n % 2], "F") for k in range(24) for n in range(4)],
        "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double, l_quantity double, l_discount double, l_returnflag string, l_linestatus string")
    put("part", [(k, 10) for k in range(12)] + [(4, 10), (5, 2), (None, 10)], "p_partkey bigint, p_size int")
    whole = TB.generations(spark, str(tmp_path)).select("sample_id", "answer", F.posexplode("generations").alias("at", "text"))
    rows = TB.outputs(spark, str(tmp_path), goals=code_triples(F.col("answer")))
    want = sorted((r.sample_id, r.answer, r.at, r.text) for r in whole.collect())
    got = sorted((r.sample_id, r.answer, r.at, r.text) for r in rows.drop("goals").collect())
    assert want == got and len(got) > 50
    assert all(len(r.goals) == r.answer.count("<s_a_") for r in rows.collect())
    plan = optimized(rows)
    assert "isnotnull(c_acctbal" in plan and plan.count("likes item") == 1 and "posexplode(g" in plan


def test_shards_are_expanded_once(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"some words {i} " * 5) for i in range(40)], "doc_id bigint, text string")
    repair_ids.write_shards(docs, public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "shards"), block=64)
    found = repair_ids.read_shards(spark, str(tmp_path / "shards"))
    assert "MapInArrow" not in optimized(found) and found.count() == 40


def test_ids_of_a_row_become_text_behind_the_regrouping(spark, shuffled_joins):
    rows = spark.createDataFrame([(1, [5, 6, 5, 9]), (2, [9])], "uid bigint, h array<bigint>")
    ids = spark.createDataFrame([("video", 5, [1, 2, 3]), ("video", 6, [9, 0, 0]), ("video", 6, [10, 0, 0])], "domain string, pid bigint, sid array<int>")
    out = B.sequences_to_sids(rows, ["uid"], {"hist": (F.col("h"), "video")}, ids)
    plan = optimized(out)
    assert "format_string" not in plan[plan.index("Join"):]
    assert [tuple(r) for r in out.collect()] == [(1, "".join(SID.format(*c) for c in ((1, 2, 3), (10, 0, 0), (9, 0, 0), (1, 2, 3))))]


def test_regroup_joins_lengths_not_prompts(spark, sf):
    plan = optimized(QUERIES["H16_two_stage_regroup"](spark, sf))
    join = plan[plan.index("Join Inner"):]
    assert "length(concat(" in join


def test_chunk_sizes_reach_samples_without_dealing_them_by_split(spark, tmp_path, shuffled_joins):
    from sidweave.sources import files, sinks
    rows = [("m", "t", f"s{i % 2}", str(i), (f"p{i}",)) for i in range(9)] + [("m", None, "s0", "x", ("p",))]
    samples = spark.createDataFrame(rows, "model string, task string, split string, sample_id string, payload struct<prompt:string>")
    seen = []
    kind, join = type(samples), type(samples).join
    kind.join = lambda self, other, *a, **k: (seen.append(other._jdf.queryExecution().analyzed().toString()), join(self, other, *a, **k))[1]
    try:
        sinks.write_generations(samples, str(tmp_path / "out"), chunk=2)
    finally:
        kind.join = join
    assert len(seen) == 1 and "broadcast" in seen[0].lower()
    back = files.load_generations(spark, str(tmp_path / "out"), multiline=False)
    assert sorted((r.sample_id, r.prompt) for r in back.collect()) == [(str(i), f"p{i}") for i in range(9)]


def test_segments_are_written_and_read_a_few_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(strata_search, "SEGMENT_GROUP", 1)
    docs = spark.createDataFrame([(i, f"word{i} both") for i in range(20)], "doc_id bigint, text string").coalesce(1)
    with one_row_batches(spark):
        strata_search.build_index(docs, str(tmp_path / "index"))
    groups = [pq.ParquetFile(f).metadata for f in (tmp_path / "index").glob("*.parquet")]
    assert sum(m.num_rows for m in groups) == 20 and sum(m.num_row_groups for m in groups) >= 5

    def rows(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int32())], ["n"])

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    with one_row_batches(spark):
        assert {r.n for r in docs.mapInArrow(rows, "n int").collect()} == {1}
    assert spark.conf.get(key) == before


def test_groups_are_resampled_where_they_lie(spark):
    """The same estimate as by a join of draws, which only groups over `group_votes` take."""
    rows = [(i, "hot" if i % 3 else f"g{i % 5}", float(i * 7 % 11) if i % 13 else None, [None, "a", "b", "c"][i * i % 4]) for i in range(90)] + [(90, None, 1.0, "a"), (91, "one", 1.0, "a")]
    votes = spark.createDataFrame(rows, "row_id bigint, uid string, score double, pred string").repartition(3)

    def found(limit):
        out = L.majority_bootstrap(votes, ["uid"], "pred", "score", "row_id", 17, trials=40, group_votes=limit)
        return {(r.uid, r.k): (round(r.maj_mean, 9), round(r.maj_std, 9)) for r in out.collect()}

    lies = found(1000)
    assert lies == found(0) == found(20) and ("hot", 32) in lies and not any(uid in (None, "one") for uid, _ in lies)
    assert "Join Inner" not in optimized(L.majority_bootstrap(votes, ["uid"], "pred", "score", "row_id", 17, trials=2))
    joined = L.majority_bootstrap(votes, ["uid"], "pred", "score", "row_id", 17, trials=2, group_votes=0)
    assert "strategy=merge" in optimized(joined)


def test_points_and_matches_are_parsed_once(spark, sf):
    assert optimized(QUERIES["I6_point_matching"](spark, sf)).count("from_json") == 3  # truth, model, matches


def test_judge_is_called_for_bounded_runs(spark):
    rows = spark.createDataFrame([(i,) for i in range(30)], "id bigint").coalesce(1).withColumn("text", F.repeat(F.lit("x"), F.when(F.col("id") == 7, 9_000_000).otherwise(1_000_000).cast("int")))
    got = J.batch_call(rows, "id", "text", lambda texts: [str(texts.str.len().sum())] * len(texts)).collect()
    assert sorted(r.id for r in got) == list(range(30)) and all(r.success for r in got)
    assert {r.id: int(r.result) for r in got}[7] == 9_000_000 and max(int(r.result) for r in got if r.id != 7) <= J.CALL_BYTES


def test_decoded_rows_are_rows_of_a_matrix():
    book = [np.arange(12, dtype=np.float32).reshape(3, 4), np.ones((2, 4), np.float32)]
    out = Q._decoder(SimpleNamespace(value=book), 0).func(pd.Series([np.array([2, 1]), np.array([0, 0])]))
    assert all(isinstance(v, np.ndarray) for v in out) and [v.tolist() for v in out] == [[9, 10, 11, 12], [1, 2, 3, 4]]
    coded = Q._encoder(SimpleNamespace(value=book), True).func(pd.Series([np.array([8.0, 9, 10, 11])]))
    assert coded["codes"][0].tolist() == [2, 0] and coded["rest"][0] is None


def test_reachable_lists_hold_a_bounded_matrix():
    rng = np.random.default_rng(1)
    x, pivots, n = rng.normal(size=(20_000, 8)), rng.normal(size=(50, 8)), 1000
    x, pivots = x / np.linalg.norm(x, axis=1)[:, None], pivots / np.linalg.norm(pivots, axis=1)[:, None]
    lists = rng.integers(0, 50, n), np.full(n, 0.1), np.full(n, 0.2)
    run = R2._reachable(SimpleNamespace(value=pivots), SimpleNamespace(value=lists), 3).func
    tracemalloc.start()
    got = run(pd.Series(list(x)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20_000 * n * 8  # one full matrix of rows and lists
    some = [0, 1, 1999, 2000, 19_999]
    assert all((a == b).all() for a, b in zip(got[some], run(pd.Series(list(x[some])))))
