"""Rule reward queries (J*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import answers as A
from ..functions.common import r6
from ..functions.sid import code_triples
from ..operators import rewards as W
from ..session import read
from . import oracle as O
from . import testbed as TB
from .catalog import query

_PAT = "<s_a_(\\d+)><s_b_(\\d+)><s_c_(\\d+)>"


def _trip(x):
    return f"[regexp_replace(z, '{_PAT}', '\\1,\\2,\\3') FOR z IN regexp_extract_all({x}, '{_PAT}')]"


_BOTH = "(contains(text,'<think>') AND contains(text,'</think>'))"
_CUT = "substr(text, instr(text,'</think>')+8)"
_RW = dict(
    rw=f"SELECT sample_id, rk, text, answer, {_trip('text')} p, {_trip('answer')} g, "
       f"CASE WHEN {_BOTH} THEN {_trip(_CUT)} ELSE [] END q FROM gen JOIN truth USING (sample_id)")


def _pairs(spark, sf):
    """One row per output; the triples of a sample's answer are found once, before its outputs become rows."""
    rows = TB.outputs(spark, sf, goals=code_triples(F.col("answer")))
    return rows.select("sample_id", (F.col("at") + 1).alias("rk"), "text", "goals")


def _pair_query(name, sql_expr, make):
    def run(spark, sf):
        return _pairs(spark, sf).select("sample_id", "rk", make(F.col("text"), F.col("goals")).alias("value"))
    query(name, O.sql(f"SELECT sample_id, rk::INT AS rk, {sql_expr} AS value FROM rw", **_RW))(run)


_FMT = ("CASE WHEN " + _BOTH + " AND instr(text,'</think>')>=instr(text,'<think>')+7 AND length(regexp_replace("
        "substr(text, instr(text,'<think>')+7, instr(text,'</think>')-instr(text,'<think>')-7), '[ \\n\\r\\t]', '', 'g'))>10 "
        "THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END")
_PART = ("CASE WHEN len(p)>0 AND len(g)>0 THEN " + O.r6(
    "list_sum([CASE WHEN list_contains(g,z) THEN 100.0 WHEN list_contains([string_split(y,',')[1]||','||string_split(y,',')[2] FOR y IN g], "
    "string_split(z,',')[1]||','||string_split(z,',')[2]) THEN 10.0 WHEN list_contains([string_split(y,',')[1] FOR y IN g], "
    "string_split(z,',')[1]) THEN 1.0 ELSE 0.0 END FOR z IN p])/len(p)") + " ELSE 0.0::DOUBLE END")
_HITR = f"CASE WHEN len(q)>0 AND len(g)>0 THEN {O.r6('len(list_intersect(list_distinct(q),g))/len(q)::DOUBLE')} ELSE 0.0::DOUBLE END"
_FIRST = "CASE WHEN len(q)>0 AND list_contains(g,q[1]) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
_PASS = "CASE WHEN list_has_any(p,g) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"

_pair_query("J1_code_triples", "coalesce(array_to_string(p,';'),'')", lambda p, t: F.array_join(code_triples(p), ";"))
_pair_query("J2_think_format", _FMT, lambda p, t: W.think_format(p))
_pair_query("J3_partial_hit", _PART, lambda p, t: r6(W.partial_hit(p, t, parsed=True)))
_pair_query("J4_hit_ratio", _HITR, lambda p, t: r6(W.hit_ratio(p, t, parsed=True)))
_pair_query("J5_first_hit", _FIRST, lambda p, t: W.first_hit(p, t, parsed=True))
_pair_query("J6_pass_rate", _PASS, lambda p, t: W.pass_rate(p, t, parsed=True))


@query("J7_score_bundle", O.sql(
    f"SELECT sample_id, rk::INT AS rk, {_FIRST} AS score, {_FMT} AS format_reward, {_PART} AS partial_hit_reward, "
    f"{_HITR} AS hit_reward, {_PASS} AS pass_rate, {_FIRST} AS pass_at_1 FROM rw", **_RW))
def j7(spark, sf):
    scored = W.recommendation_scores(_pairs(spark, sf), "text", "goals", parsed=True).drop("text", "goals")
    return scored.select("sample_id", "rk", *[r6(F.col(c)).alias(c) for c in scored.columns[2:]])


def _solutions(spark, sf):
    """Documents as solutions; the length is the true answer."""
    t, n = F.col("text"), F.col("n_chars").cast("string")
    sol = (F.when(F.col("lang") == "en", F.concat(t, F.lit(" #### "), n))
           .when(F.col("lang") == "fr", F.concat(t, F.lit(" it is #### 1,"), n, F.lit(" . ")))
           .when(F.col("lang") == "de", F.concat(t, F.lit(" ends with "), n)).otherwise(t))
    return read(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars", sol.alias("solution"), n.alias("truth"))


_SOL = ("SELECT doc_id, lang, source, n_chars, n_chars::VARCHAR truth, CASE lang WHEN 'en' THEN text||' #### '||n_chars WHEN 'fr' THEN "
        "text||' it is #### 1,'||n_chars||' . ' WHEN 'de' THEN text||' ends with '||n_chars ELSE text END solution FROM documents")
_STRICT = "replace(list_last(regexp_extract_all(right(solution,300),'#### (\\-?[0-9\\.\\,]+)',1)),',','')"
_FLEX = ("coalesce(list_last([z FOR z IN regexp_extract_all(right(solution,300),'(\\-?[0-9\\.\\,]+)',1) IF z<>'.']), "
         "regexp_extract_all(right(solution,300),'(\\-?[0-9\\.\\,]+)',1)[1])")


def _num(x):
    return f"CASE WHEN {x} IS NULL THEN 0.0::DOUBLE WHEN {x}=truth THEN 1.0::DOUBLE ELSE 0.1::DOUBLE END"


@query("J8_dispatch", O.sql(
    f"SELECT doc_id, CASE WHEN lang IN ('en','fr') THEN {_num(_STRICT)} ELSE {_num(_FLEX)} END AS score FROM sol", sol=_SOL))
def j8(spark, sf):
    s, t = F.col("solution"), F.col("truth")
    others = ("de", "es")
    score = W.dispatch(F.col("lang"), {("en", "fr"): W.number_score(s, t, format_score=0.1),
                                       others: W.number_score(s, t, flexible=True, format_score=0.1)})
    return _solutions(spark, sf).select("doc_id", score.alias("score"))


@query("J9_final_number", O.sql(
    f"SELECT doc_id, {_STRICT} AS strict_answer, {_FLEX} AS flexible_answer, {_num(_STRICT)} AS strict_score, "
    f"{_num(_FLEX)} AS flexible_score FROM sol", sol=_SOL))
def j9(spark, sf):
    s, t = F.col("solution"), F.col("truth")
    return _solutions(spark, sf).select(
        "doc_id", A.final_number(s).alias("strict_answer"), A.final_number(s, True).alias("flexible_answer"),
        W.number_score(s, t, format_score=0.1).alias("strict_score"),
        W.number_score(s, t, True, 0.1).alias("flexible_score"))


def _by_type(**arms):
    out = None
    for name, col in arms.items():
        cond = F.col("event_type") == name
        out = F.when(cond, col) if out is None else out.when(cond, col)
    return out


def _case(**arms):
    return "CASE event_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in arms.items()) + " END"


def _math_rows(spark, sf):
    """Boxed answers in several spellings, built from an event's number."""
    k = F.get_json_object("props", "$.k")
    box = F.lit("\\boxed{")
    pred = _by_type(
        view=F.concat(F.lit("<think>t</think> so "), box, F.lit("\\dfrac{1}{"), k, F.lit("}}")),
        click=F.concat(F.lit("first "), box, k, F.lit("} then "), box, F.lit("x=0.5}")),
        signup=F.concat(box, k, F.lit("/7} done")),
        error=F.concat(F.lit("no box "), k),
        purchase=F.concat(box, F.lit("\\sqrt{"), k, F.lit("+{1}}} or "), box, F.lit("\\sqrt{"), k, F.lit("}")))
    truth = _by_type(view=F.concat(F.lit("\\frac1{"), k, F.lit("}")), click=F.lit("\\frac12"),
                     signup=F.concat(F.lit("\\frac{"), k, F.lit("}{7}")), error=k, purchase=k)
    return read(spark, sf, "events").select("event_id", "event_type", "value", "user_id", k.alias("k"), pred.alias("pred"),
                                            truth.alias("truth"))


@query("J10_boxed_answer", "SELECT event_id, CASE event_type WHEN 'view' THEN '\\dfrac{1}{'||k||'}' WHEN 'click' THEN 'x=0.5' "
       "WHEN 'signup' THEN k||'/7' END AS boxed, CASE WHEN event_type IN ('view','click','signup') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END "
       "AS score FROM (SELECT *, json_extract_string(props,'$.k') k FROM events)")
def j10(spark, sf):
    return _math_rows(spark, sf).select("event_id", A.boxed_answer(F.col("pred")).alias("boxed"),
                                        W.boxed_score(F.col("pred"), F.col("truth")).alias("score"))


def _final_rows(spark, sf):
    k = F.get_json_object("props", "$.k")
    pred = _by_type(
        view=F.concat(F.lit("work\nAnswer: the total is x = "), k, F.lit(" dollars")),
        click=F.concat(F.lit("Answer: 3\nANSWER : \\boxed{1,"), k, F.lit("}\nbye")),
        signup=F.concat(F.lit("nothing at all "), k),
        error=F.concat(F.lit("Answer: "), (k.cast("int") + 1).cast("string")),
        purchase=F.concat(F.lit("Answer: $\\frac23$ km\nAnswer: \\sqrt"), F.substring(k, 1, 1)))
    truth = _by_type(view=k, click=F.concat(F.lit("1"), k), signup=k, error=k,
                     purchase=F.concat(F.lit("\\sqrt{"), F.substring(k, 1, 1), F.lit("}")))
    return read(spark, sf, "events").select("event_id", pred.alias("pred"), truth.alias("truth"))


@query("J11_final_line", "SELECT event_id, event_type IN ('view','click','purchase') AS acc, CASE WHEN event_type IN "
       "('view','click','purchase') THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS score, " + _case(
           view="k", click="'1'||k", signup="'[INVALID]'", error="(k::INT+1)::VARCHAR", purchase="'\\sqrt{'||k[1]||'}'")
       + " AS pred FROM (SELECT *, json_extract_string(props,'$.k') k FROM events)")
def j11(spark, sf):
    s = W.final_answer_scores(F.col("pred"), F.col("truth"))
    return _final_rows(spark, sf).select("event_id", *[c.alias(n) for n, c in s.items()])


@query("J11_strict_box", "SELECT event_id, event_type='view' AS acc, " + _case(
    view="'\\dfrac{1}{'||k||'}'", click="'x=0.5'", signup="k||'/7'", error="NULL", purchase="NULL")
       + " AS pred FROM (SELECT *, json_extract_string(props,'$.k') k FROM events)")
def j11b(spark, sf):
    """Strict form: the boxed text must equal the truth as it is written."""
    s = W.strict_box_scores(F.col("pred"), F.concat(F.lit("\\dfrac{1}{"), F.col("k"), F.lit("}")))
    return _math_rows(spark, sf).select("event_id", s["acc"].alias("acc"),
                                        s["pred"].alias("pred"))


_PUNCT = "[!-/:-@\\[-`{-~]"


def tidy_sql(x):
    words = f"regexp_split_to_array(regexp_replace(lower({x}),'{_PUNCT}','','g'), '\\s+')"
    return f"array_to_string([w FOR w IN {words} IF w NOT IN ('','a','an','the')],' ')"


@query("J12_qa_match", "WITH t AS (SELECT a.conv_id, a.turn, a.text, b.text nxt FROM conversations a LEFT JOIN conversations b "
       "ON b.conv_id=a.conv_id AND b.turn=a.turn+1), n AS (SELECT conv_id, turn, " + tidy_sql("text") + " g, coalesce(" + tidy_sql("nxt")
       + ",'none') o FROM t) SELECT conv_id, turn, CASE turn WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.25::DOUBLE WHEN 2 THEN 0.0::DOUBLE ELSE "
       "CASE WHEN g=o THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS exact, CASE turn WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE WHEN 2 "
       "THEN 0.0::DOUBLE ELSE CASE WHEN contains(g,o) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS contained FROM n")
def j12(spark, sf):
    """Turn 0: the truth with other case and punctuation; turn 1: many tags; turn 2: no tag; later: the next turn as truth."""
    c = read(spark, sf, "conversations")
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("nxt"))
    t = F.col("text")
    block = F.concat(F.lit("<answer> "), t, F.lit(" </answer>"))
    pred = (F.when(F.col("turn") == 1, F.concat(F.repeat(F.lit("<answer>x</answer>"), F.lit(11)), block))
            .when(F.col("turn") == 2, t).otherwise(F.concat(F.lit("<think>hm</think>"), block)))
    same = F.array(F.lit("zzz"), F.concat(F.lit("The "), t, F.lit("!")))
    truths = F.when(F.col("turn") <= 2, same).otherwise(F.array(F.coalesce("nxt", F.lit("none"))))
    rows = c.join(nxt, ["conv_id", "turn"], "left")
    return rows.select("conv_id", "turn", W.qa_score(pred, truths).alias("exact"),
                       W.qa_score(pred, truths, substring=True).alias("contained"))


@query("J13_blend", "SELECT event_id, " + _case(view=O.r6("1.0"), click=O.r6("0.9"), signup=O.r6("0.9"), error=O.r6("0"), purchase=O.r6("0"))
       + " AS score FROM events")
def j13(spark, sf):
    return _math_rows(spark, sf).select("event_id", r6(W.blended_score(F.col("pred"), F.col("truth"))).alias("score"))


@query("J14_overlong_penalty", "SELECT doc_id, " + O.r6("least(-(n_chars-(1500-500))/500.0::DOUBLE*0.7::DOUBLE,0.0)") + " AS penalty, "
       "least(-(n_chars-1000)/500.0::DOUBLE*0.7::DOUBLE,0.0)<0 AS overlong FROM documents")
def j14(spark, sf):
    p = W.overlong_penalty(F.col("n_chars"), 1500, 500, 0.7)
    return read(spark, sf, "documents").select("doc_id", r6(p).alias("penalty"), (p < 0).alias("overlong"))


@query("J15_offline_evaluation", "SELECT event_type AS data_source, " + O.r6("avg(m)") + " AS test_score FROM "
       "(SELECT event_type, user_id, avg(value) m FROM events GROUP BY 1,2) GROUP BY 1")
def j15(spark, sf):
    e = read(spark, sf, "events").select(F.col("event_type").alias("data_source"), "user_id", F.col("value").alias("score"))
    return W.offline_evaluation(e, ["user_id"]).withColumn("test_score", r6(F.col("test_score")))


@query("J16_task_statistics", O.sql(
    "SELECT coalesce(source,'all') AS source, key, " + O.r6("avg(value)") + " AS mean, " + O.r6("max(value)") + " AS max, "
    + O.r6("min(value)") + " AS min, count(*) AS n FROM (SELECT data_source source, unnest(['score','len']) key, "
    "unnest([score, len::DOUBLE]) AS value FROM rollouts) GROUP BY GROUPING SETS ((source,key),(key))"))
def j16(spark, sf):
    r = TB.rollouts(spark, sf)
    s = W.task_statistics(r, ["score", "len"], W.resolve_source(r, ["reward_source", "source", "data_source"]))
    return s.select("source", "key", *[r6(F.col(c)).alias(c) for c in ("mean", "max", "min")], "n")


@query("J17_choice", "SELECT event_id, " + _case(view="'B'", click="'d'", signup="NULL", error="'A'", purchase="'C'") + " AS letter, "
       + _case(view="1.0::DOUBLE", click="0.0::DOUBLE", signup="0.0::DOUBLE", error="0.0::DOUBLE", purchase="1.0::DOUBLE") + " AS score FROM events")
def j17(spark, sf):
    k = F.get_json_object("props", "$.k")
    pred = _by_type(view=F.concat(F.lit("see "), k, F.lit(" Answer: $B$")), click=F.lit("answer:d"), signup=F.concat(F.lit("Answer: "), k),
                    error=F.lit("ANSWER :\tA or Answer: B"), purchase=F.lit("Answer: C."))
    truth = _by_type(view=F.lit("B"), click=F.lit("D"), signup=F.lit("A"), error=F.lit("B"), purchase=F.lit("C"))
    return read(spark, sf, "events").select("event_id", A.choice_letter(pred).alias("letter"), W.choice_score(pred, truth).alias("score"))


@query("J18_error_step", "SELECT event_id, CASE WHEN got IS NULL THEN -1.0::DOUBLE WHEN truth=-1 THEN CASE WHEN got=-1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END "
       "WHEN got=-1 THEN -1.0::DOUBLE ELSE " + O.r6("1.0-abs(got-truth)/60.0::DOUBLE") + " END AS score, got IS NOT NULL AND (truth=-1)=(got=-1) AS acc, got::INT AS pred FROM "
       "(SELECT event_id, CASE WHEN event_type='view' THEN -1 ELSE (user_id%60) END truth, CASE WHEN event_type='error' THEN NULL WHEN k<20 THEN -1 WHEN k<60 THEN k END got "
       "FROM (SELECT *, json_extract_string(props,'$.k')::INT k FROM events))")
def j18(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    shown = F.when(k < 20, F.lit("-1")).otherwise(k.cast("string"))
    pred = F.when(F.col("event_type") == "error", F.lit("\\boxed{step two}")).otherwise(F.concat(F.lit("thus \\boxed{"), shown, F.lit("}.")))
    truth = F.when(F.col("event_type") == "view", F.lit(-1)).otherwise((F.col("user_id") % 60).cast("int"))
    s = W.error_step_scores(pred, truth, F.lit(60))
    return read(spark, sf, "events").select("event_id", r6(s["score"]).alias("score"), s["acc"].alias("acc"), s["pred"].alias("pred"))


@query("J19_new_turn_tokens", "SELECT conv_id AS chat_id, (turn//8)::BIGINT AS part, sum(CASE WHEN turn%8>=2 THEN "
       "len([w FOR w IN regexp_split_to_array(text,'\\s+') IF w<>'']) ELSE 0 END)::INT AS tokens FROM conversations GROUP BY ALL")
def j19(spark, sf):
    return TB.chats(spark, sf).select("chat_id", "part", W.new_turn_tokens(F.col("messages"), F.lit(2)).alias("tokens"))


@query("J20_conversation_reward", "SELECT user_id, " + O.r6("sum(greatest(least(m*w,1),-1))") + " AS reward FROM (SELECT user_id, event_type, "
       "avg(CASE WHEN value>200 THEN 0 ELSE value END) m, (length(event_type)-6)/100.0::DOUBLE w FROM events GROUP BY ALL) GROUP BY 1")
def j20(spark, sf):
    e = read(spark, sf, "events")
    metrics = e.select("user_id", F.col("event_type").alias("metric"), F.when(F.col("value") <= 200, F.col("value")).alias("value"))
    weights = e.select(F.col("event_type").alias("metric")).distinct().withColumn("weight", (F.length("metric") - 6) / 100.0)
    return W.conversation_reward(metrics, weights, "user_id").select("user_id", r6(F.col("reward")).alias("reward"))
