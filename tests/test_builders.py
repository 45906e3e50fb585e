"""Builder edge rows against a plain-Python model."""

import json

import pytest
from pyspark.sql import functions as F

from sidweave.operators import builders as B
from sidweave.operators import templates as T

EVENTS = B.EVENTS
SCHEMA = ("uid bigint, split int, hist_video_pid array<bigint>, target_video_pid array<bigint>, "
          + ", ".join(f"{s}_video_{e} array<int>" for s in ("hist", "target") for e in EVENTS)
          + ", hist_longview_video_list array<bigint>, hist_ad_pid array<bigint>, target_ad_pid array<bigint>, "
            "hist_goods_pid array<bigint>, target_goods_pid array<bigint>, inter_user_profile_with_sid string, "
            "inter_keyword_to_items string, reco_gsu_caption string, reco_target_caption string, reco_cot string, target_pid bigint")


def user(uid, split=0, **kw):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return tuple({"uid": uid, "split": split, **kw}.get(n) for n in names)


def sid_of(p):
    return f"<|sid_begin|><s_a_{p}><s_b_{p + 1}><s_c_{p + 2}><|sid_end|>"


def text(pids):
    return "".join(sid_of(p) for p in pids if p % 5)


@pytest.fixture(scope="module")
def sid_map(spark):
    rows = [("video", p, [p, p + 1, p + 2]) for p in range(1, 700) if p % 5]
    return spark.createDataFrame(rows, "domain string, pid bigint, sid array<int>")


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def answers(df, key="uid"):
    """The user's and the assistant's text, the last two turns."""
    return {r[key]: tuple(m["content"][0]["text"] for m in json.loads(r.messages)[-2:]) for r in df.collect()}


def test_video_edges(spark, sid_map):
    long = list(range(1, 601))
    got = answers(B.video_rows(table(
        spark, user(1, hist_video_pid=None, target_video_pid=[1]), user(2, hist_video_pid=[5, 10], target_video_pid=[1]),
        user(3, hist_video_pid=long, target_video_pid=list(range(1, 21))), user(4, hist_video_pid=[1, 1, 2], target_video_pid=[3]),
        user(5, split=1, hist_video_pid=[1], target_video_pid=[2]), user(6, hist_video_pid=[1], target_video_pid=None)), sid_map))
    assert set(got) == {3, 4}
    assert got[3][1] == text(range(1, 11)) and text(long[-512:]) in got[3][0] and sid_of(88) not in got[3][0]
    assert text([1, 1, 2]) in got[4][0]


def test_small_caps(spark, sid_map):
    got = answers(B.video_rows(table(spark, user(1, hist_video_pid=[1, 2, 3, 4], target_video_pid=[6, 7, 8])), sid_map, 2, 2))
    assert got[1][1] == text([6, 7]) and text([3, 4]) in got[1][0] and sid_of(2) not in got[1][0]


def test_ad_parts(spark, sid_map):
    got = answers(B.ad_rows(table(
        spark, user(1, hist_ad_pid=[1], target_ad_pid=[2]), user(2, hist_longview_video_list=[3], target_ad_pid=[4]),
        user(3, hist_ad_pid=[1], target_ad_pid=[]), user(4, target_ad_pid=[4])), sid_map))
    assert set(got) == {1, 2}
    assert "Long views" not in got[1][0] and "Ad clicks" not in got[2][0]


def masks(n, on, side):
    return {f"{side}_video_{e}": [1 if e == on else 0] * n for e in EVENTS}


def test_label_rows(spark, sid_map):
    base = dict(hist_video_pid=[1, 2, 3], target_video_pid=[5, 6, 7])
    good = user(1, **base, **masks(3, "like", "hist"), **{**masks(3, "like", "target"), "target_video_longview": [1, 0, 1]})
    short = user(2, **base, **{**masks(3, "like", "hist"), "hist_video_like": [1, 1]}, **masks(3, "like", "target"))
    users = table(spark, good, short)
    rows = B.label_pred_rows(users, sid_map).orderBy("pos").collect()
    assert [(r.uid, r.pos, r.label) for r in rows] == [(1, 1, 0), (1, 2, 1)]  # pid 5 has no id
    assert any(lead + text([1, 2, 3]) in rows[0].messages for lead in T.LEADS["like"])
    cond = B.label_cond_rows(users, sid_map).collect()
    assert [r.uid for r in cond] == [1]
    event = json.loads(cond[0].metadata)["target_interaction"]
    assert answers(B.label_cond_rows(users, sid_map))[1][1] == text([5, 6, 7] if event == "like" else [5, 7])


def test_interactive_edges(spark, sid_map):
    def row(uid, profile, kw):
        return user(uid, inter_user_profile_with_sid=profile, inter_keyword_to_items=kw)
    rows = B.interactive_rows(table(
        spark, row(1, "p", '{"k": [1, 5, 2], "": [1], "e": [], "u": [5]}'), row(2, "p", '{"k": [1]'), row(3, None, '{"k": [1]}'),
        row(4, "", '{"k": [1]}'), row(5, " ", '{"k": [1]}')), sid_map).collect()
    assert sorted((r.uid, r.keyword) for r in rows) == [(1, "k"), (5, "k")]


def test_reason_edges(spark):
    def row(uid, profile="p", target="t", cot="c", gsu=None):
        return user(uid, inter_user_profile_with_sid=profile, reco_target_caption=target, reco_cot=cot, reco_gsu_caption=gsu, target_pid=1)
    got = answers(B.reason_rows(table(spark, row(1), row(2, cot="  "), row(3, target="\n"), row(4, profile=None), row(5, gsu="h"))))
    assert set(got) == {1, 5} and "History: None" in got[1][0] and "History: h" in got[5][0]


def test_missing_split_is_training(spark, sid_map):
    users = table(spark, user(1, split=1, hist_video_pid=[1], target_video_pid=[2])).drop("split")
    assert B.video_rows(users, sid_map).count() == 1


def test_shuffled_join_keeps_every_row(spark, sid_map, shuffled_joins):
    users = table(spark, *[user(u, hist_video_pid=[7] * 40 + [u % 600 + 1], target_video_pid=[7]) for u in range(1, 60)])
    got = answers(B.video_rows(users, sid_map))
    assert all(text([7] * 40 + [u % 600 + 1]) in got[u][0] for u in range(1, 60))


def test_scans_are_pruned(spark, sf):
    from sidweave.plans import testbed as TB
    scan = TB.read(spark, sf, "orders").where("o_custkey > 5").select("o_orderkey")
    text_ = scan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in text_ and "o_totalprice" not in text_


def test_tally(spark):
    df = spark.createDataFrame([(1,), (0,), (1,)], "label int")
    assert {r.label: r.n for r in B.label_tally(df).collect()} == {0: 1, 1: 2}
    assert df.select(F.lit(1)).count() == 3


def test_braces_in_the_data_stay(spark, sid_map):
    row = user(1, inter_user_profile_with_sid="likes {keyword} and {profile}", inter_keyword_to_items='{"k{hist}": [1, 2]}',
               reco_target_caption="{target} {hist}", reco_cot="c", reco_gsu_caption="{profile}")
    said = json.loads(B.interactive_rows(table(spark, row), sid_map).first().messages)[1]["content"][0]["text"]
    assert "likes {keyword} and {profile}" in said and "k{hist}" in said
    said = json.loads(B.reason_rows(table(spark, row)).first().messages)[0]["content"][0]["text"]
    assert "likes {keyword} and {profile}" in said and "{target} {hist}" in said and "History: {profile}" in said


def test_label_answers_are_read_by_the_metrics(spark, sid_map):
    from sidweave.operators.labelmetrics import label_from_answer

    row = user(1, hist_video_pid=[1, 2], target_video_pid=[3, 4, 6], **{f"hist_video_{e}": [1, 1] for e in EVENTS}, target_video_longview=[1, 0, 1])
    rows = B.label_pred_rows(table(spark, row), sid_map).withColumn("said", F.get_json_object("messages", "$[2].content[0].text"))
    got = rows.select("label", label_from_answer(F.col("said")).alias("read")).collect()
    assert len(got) == 3 and all(r.label == r.read for r in got)
    assert [m["role"] for m in json.loads(rows.first().messages)] == ["system", "user", "assistant"]


def test_old_clicks_of_a_long_history_count(spark, tmp_path):
    """500 old ad clicks and 1500 newer other interactions: the builder's window holds the last 200 clicks."""
    from sidweave.plans import testbed as TB

    day = "timestamp_seconds(1700000000 + {} * 86400)"
    spark.sql("SELECT 7L AS c_custkey, 'n' AS c_name, 1 AS c_nationkey, 1.0D AS c_acctbal, 'M' AS c_mktsegment").write.parquet(str(tmp_path / "customer.parquet"))
    spark.sql(f"SELECT id AS o_orderkey, 7L AS o_custkey, {day.format('id')} AS o_orderdate FROM range(2000)").write.parquet(str(tmp_path / "orders.parquet"))
    spark.sql("SELECT id AS l_orderkey, id + 1 AS l_partkey, id + 1 AS l_suppkey, 1 AS l_linenumber, 1.0D AS l_quantity, 1.0D AS l_extendedprice, 0.0D AS l_discount, "
              "'N' AS l_returnflag, CASE WHEN id < 500 THEN 'F' ELSE 'O' END AS l_linestatus FROM range(2000)").write.parquet(str(tmp_path / "lineitem.parquet"))
    users = TB.user_meta(spark, str(tmp_path))
    clicks = users.select(F.size("hist_ad_pid").alias("n"), F.size("hist_video_pid").alias("all")).first()
    assert (clicks.n, clicks["all"]) == (500, 1988)
    assert TB.interactions(spark, str(tmp_path)).count() == 2000
