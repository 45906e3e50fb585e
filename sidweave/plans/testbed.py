"""Recommendation tables derived from the driver's star schema, entirely on Spark.

An order line is an interaction of its customer with its part. A user table row has the 12 newest
interactions as target and all before them as history: the builders cut each slot at its own window,
some of them after a filter, so no shorter history gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.common import once
from ..functions.sid import pack, sid_text_of
from ..session import read, spread

TARGET = 12
SAMPLE, SAMPLES_PER_USER = 12, 1_000_000
EVENTS = ["longview", "like", "follow", "forward", "not_interested"]


def interactions(spark: SparkSession, sf: str) -> DataFrame:
    """All interactions per user, ranked 1 = newest."""
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = spread(read(spark, sf, "lineitem")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_discount", "l_returnflag", "l_linestatus",
    )
    w = Window.partitionBy("o_custkey").orderBy(*[
        F.desc(c) for c in ("o_orderdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                            "l_extendedprice")
    ])
    ranked = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
        "rk", F.row_number().over(w)
    )
    return ranked.select(
        F.col("o_custkey").alias("uid"), "rk", F.col("l_partkey").alias("pid"),
        F.col("l_suppkey").alias("ad_pid"),
        (F.col("l_quantity") >= 25).cast("int").alias("longview"),
        (F.col("l_discount") >= 0.05).cast("int").alias("like"),
        (F.col("l_returnflag") == "A").cast("int").alias("follow"),
        (F.col("l_linestatus") == "F").cast("int").alias("forward"),
        (F.col("l_returnflag") == "R").cast("int").alias("not_interested"),
        F.col("l_returnflag").alias("keyword"),
    )


def user_meta(spark: SparkSession, sf: str) -> DataFrame:
    per_user = interactions(spark, sf).groupBy("uid").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("rk")).alias("o"), "pid", "ad_pid", *EVENTS, "keyword"))).alias("seq"))
    halves = per_user.selectExpr("uid", "seq", f"filter(seq, x -> x.o < -{TARGET}) AS h", f"filter(seq, x -> x.o >= -{TARGET}) AS t")
    arrays = halves.selectExpr(
        "uid", "h.pid AS hist_video_pid", "t.pid AS target_video_pid",
        *[f"h.`{e}` AS hist_video_{e}" for e in EVENTS], *[f"t.`{e}` AS target_video_{e}" for e in EVENTS],
        "filter(h, x -> x.longview = 1).pid AS hist_longview_video_list",
        "filter(h, x -> x.forward = 1).ad_pid AS hist_ad_pid", "filter(t, x -> x.forward = 1).ad_pid AS target_ad_pid",
        "filter(h, x -> x.keyword = 'N').pid AS hist_goods_pid", "filter(t, x -> x.keyword = 'N').pid AS target_goods_pid",
        *[f"array_join(filter(seq, x -> x.keyword = '{k}').pid, ',') AS kw_{k}" for k in "ANR"],
        "get(t.pid, 0) AS target_pid",
    )
    cust = read(spark, sf, "customer")
    rows = cust.join(arrays, F.col("c_custkey") == F.col("uid"), "left")
    return rows.selectExpr(
        "c_custkey AS uid", "CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS split", "hist_video_pid", "target_video_pid",
        *[f"hist_video_{e}" for e in EVENTS if e != "forward"],
        "CASE WHEN c_nationkey = 24 THEN slice(hist_video_forward, 1, greatest(size(hist_video_forward) - 1, 0)) "
        "ELSE hist_video_forward END AS hist_video_forward",
        *[f"target_video_{e}" for e in EVENTS],
        "hist_longview_video_list", "hist_ad_pid", "target_ad_pid", "hist_goods_pid", "target_goods_pid",
        "CASE c_nationkey WHEN 19 THEN NULL WHEN 18 THEN '' WHEN 17 THEN '  ' ELSE concat_ws(' ', c_name, c_mktsegment) END "
        "AS inter_user_profile_with_sid",
        "concat('{\"A\":[', kw_A, '],\"N\":[', kw_N, '],\"\":[', kw_R, CASE WHEN c_nationkey = 23 THEN ']' ELSE ']}' END) "
        "AS inter_keyword_to_items",
        "CASE WHEN c_mktsegment <> 'BUILDING' THEN concat('saw ', c_mktsegment) END AS reco_gsu_caption",
        "CASE WHEN c_nationkey = 22 THEN '   ' ELSE concat('item ', target_pid) END AS reco_target_caption",
        "CASE WHEN c_nationkey <> 21 THEN concat('fits ', c_mktsegment) END AS reco_cot", "target_pid",
    )


def _codes(key, a: int, b: int, c: int):
    three = F.floor(F.col(key) / 3)  # neighbouring items share an id
    return F.array(*[(three * m % 8192).cast("int") for m in (a, b, c)])


def pid2sid(spark: SparkSession, sf: str) -> DataFrame:
    """Id map: videos and goods from parts, ads share the video domain in the builders.
    Parts of size 1-3 (videos) and 48-50 (goods) have no id."""
    part = read(spark, sf, "part").select("p_partkey", "p_size")
    video = part.where("p_size > 3").select(
        F.lit("video").alias("domain"), F.col("p_partkey").alias("pid"),
        _codes("p_partkey", 1, 31, 131).alias("sid"))
    goods = part.where("p_size < 48").select(
        F.lit("product").alias("domain"), F.col("p_partkey").alias("pid"),
        _codes("p_partkey", 7, 53, 211).alias("sid"))
    return video.unionByName(goods)


def captions(spark: SparkSession, sf: str) -> DataFrame:
    """Captions of parts; ECONOMY parts have none, parts priced under 905 an empty one."""
    part = read(spark, sf, "part")
    text = F.when(F.col("p_type") == "ECONOMY", F.lit(None)).when(
        F.col("p_retailprice") < 905, F.lit("")).otherwise(F.concat_ws(" ", "p_name", "p_type", "p_brand"))
    return part.select(F.col("p_partkey").alias("pid"), text.alias("dense_caption"))


def sid2pid(spark: SparkSession, sf: str) -> DataFrame:
    """Collision lists: coarse codes shared by several parts, with sale counts."""
    sold = read(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("pid")).agg(
        F.count(F.lit(1)).alias("count"), F.countDistinct("l_suppkey").alias("count_ds"))
    m = pid2sid(spark, sf).where("domain = 'video'")
    code = F.expr("sid[0] * 67108864L + sid[1] * 8192L + sid[2]")
    return m.select("pid", code.alias("code")).join(sold, "pid").select("code", "pid", "count", "count_ds")


def _samples(spark: SparkSession, sf: str) -> DataFrame:
    """cust, uid and the sorted entries (rk, pid, code) that a sample's answer (t) and outputs (g) name.

    Codes travel as one number and become text when a sample is complete. Rows are dealt out by customer before they are
    collected, so a sample's lists are made where its rows arrive and the join with the customers moves them no more.
    """
    mapping = pid2sid(spark, sf).where("domain = 'video'").select("pid", pack(*[F.col("sid")[i] for i in range(3)]).alias("code"))
    number = F.col("uid") * SAMPLES_PER_USER + F.floor((F.col("rk") - 1) / SAMPLE)
    inter = interactions(spark, sf).select(F.col("uid").alias("cust"), number.alias("uid"), ((F.col("rk") - 1) % SAMPLE + 1).alias("rk"), "pid")
    truth, guess, same = (F.lit(k).cast("tinyint").alias("kind") for k in (0, 1, 2))  # same: both name this item
    named = F.when(F.col("rk") % 3 == 1, F.array(F.struct(same, F.col("pid").alias("pid")))).otherwise(F.array(
        F.struct(truth, F.col("pid").alias("pid")), F.struct(guess, (F.col("pid") + F.col("rk")).alias("pid"))))
    both = inter.select("cust", "uid", "rk", F.explode(named).alias("x")).select("cust", "uid", "rk", "x.*")
    entry = F.struct("rk", "pid", "code")
    return both.join(mapping, "pid", "left").repartition("cust").groupBy("cust", "uid").agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") != 1, entry))).alias("t"),
        F.array_sort(F.collect_list(F.when(F.col("kind") != 0, entry))).alias("g"),
    )


def _spell(x: Column) -> Column:
    """Text of the output that names entry x."""
    s = F.coalesce(sid_text_of(x["code"]), F.lit("nothing"))
    v = (F.col("uid") + x["rk"] * 3) % 5
    return (
        F.when(v == 0, F.concat(F.lit("<think>likes item "), x["pid"].cast("string"),
                                F.lit(" a lot</think>\n"), s))
        .when(v == 1, s)
        .when(v == 2, F.concat(F.lit("try "), s))
        .when(v == 3, F.replace(s, F.lit("<|sid_end|>"), F.lit("")))
        .otherwise(F.when(x["rk"] == 9, F.lit("  ")).otherwise(F.concat(s, F.lit(" "), s)))
    )


def _answer() -> Column:
    return F.coalesce(F.array_join(F.transform("t", lambda x: sid_text_of(x["code"])), ""), F.lit(""))


def outputs(spark: SparkSession, sf: str, **per_sample: Column) -> DataFrame:
    """The outputs of `generations` as rows: sample_id, answer, at (from 0), text.

    `per_sample` columns may use the answer; each is computed once per sample. An output becomes a row before it becomes
    text, and customers in debt, who have no outputs, leave before that.
    """
    solvent = read(spark, sf, "customer").where("c_acctbal >= 0").select("c_custkey")
    rows = solvent.join(_samples(spark, sf), F.col("c_custkey") == F.col("cust")).select("uid", "g", _answer().alias("answer"))
    rows = once(rows, **per_sample) if per_sample else rows
    named = rows.select("uid", "answer", *per_sample, F.posexplode("g").alias("at", "x"))
    return named.select(F.col("uid").cast("string").alias("sample_id"), "answer", *per_sample, "at", _spell(F.col("x")).alias("text"))


def generations(spark: SparkSession, sf: str) -> DataFrame:
    """Model outputs and the truth they are scored against, one row for each 12 interactions of a customer.

    uid is the sample's number: the customer, and which 12 of the customer's interactions. Output i names the i-th newest item (0, 3, 6 ...) or a part with a nearby key, in one of
    five spellings; customers in debt have no outputs at all.
    """
    hit = _samples(spark, sf)
    rows = read(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment").join(
        hit, F.col("c_custkey") == F.col("cust"), "left")
    real = F.coalesce(F.col("c_acctbal") >= 0, F.lit(False)) & F.col("g").isNotNull()
    none = lambda t: F.array().cast(f"array<{t}>")
    return rows.withColumn("uid", F.coalesce("uid", F.col("c_custkey") * SAMPLES_PER_USER)).select(
        F.lit("base").alias("model"), F.lit("video").alias("task"),
        F.lower("c_mktsegment").alias("split"),
        F.col("uid").cast("string").alias("sample_id"),
        F.concat(F.lit("Watched by "), F.col("uid").cast("string"), F.lit(": "),
                 F.repeat(F.lit("clip "), F.lit(45))).alias("prompt"),
        F.when(real, F.transform("g", _spell)).otherwise(none("string")).alias("generations"),
        F.when(real, F.transform("g", lambda x: -((F.col("uid") * 7 + x["rk"] * 5) % 11).cast("double") / 4))
        .otherwise(none("double")).alias("logprobs"),
        _answer().alias("answer"),
        F.coalesce(F.transform("t", lambda x: F.when(x["code"].isNull(), F.lit(0)).otherwise(x["pid"])),
                   none("bigint")).alias("answer_pid"),
        F.when(real, F.transform("g", lambda x: F.length(_spell(x)).cast("bigint"))).otherwise(none("bigint"))
        .alias("output_tokens"),
        F.when(real, F.transform("g", lambda x: (x["rk"] * 3 + F.col("uid") % 7).cast("double") / 8))
        .otherwise(none("double")).alias("times"),
    )


def rollouts(spark: SparkSession, sf: str) -> DataFrame:
    """One rollout per event: prompt group = user, reward = value, token arrays from arithmetic."""
    e = F.col("event_id")
    length = (3 + e * 13 % 6).cast("int")
    idx = F.sequence(F.lit(0), length - 1)

    def tokens(a: int, b: int, shift: float):
        return F.transform(idx, lambda i: ((e * a + i * b) % 97).cast("double") / 64 - shift)

    return spread(read(spark, sf, "events")).select(
        e.alias("row_id"), F.col("user_id").alias("uid"), F.col("event_type").alias("data_source"),
        F.col("value").alias("score"), F.get_json_object("props", "$.k").alias("pred"),
        length.cast("bigint").alias("len"), (e % 10).alias("step"),
        F.transform(idx, lambda i: F.when((i == length - 1) & (e % 3 == 0), 0).otherwise(1)).alias("mask"),
        tokens(31, 17, 1.0).alias("token_rewards"), tokens(37, 11, 1.0).alias("token_values"),
        tokens(41, 19, 2.5).alias("old_lp"), tokens(43, 23, 2.5).alias("ref_lp"),
        F.transform(idx, lambda i: ((e * 41 + i * 19) % 97).cast("double") / 64 - 2.5
                    + ((e * 7 + i * 29) % 31 - 15).cast("double") / 64).alias("rollout_lp"),
    )


def chats(spark: SparkSession, sf: str) -> DataFrame:
    """Chat rows of at most eight consecutive turns: chat_id, part, messages[role, content]."""
    c = read(spark, sf, "conversations").withColumn("part", F.floor(F.col("turn") / 8))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return c.groupBy(F.col("conv_id").alias("chat_id"), "part").agg(
        F.transform(ordered, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
        .alias("messages"))
