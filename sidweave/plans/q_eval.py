"""Generation scoring queries (B8, H*, I*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import once, r6
from ..functions.sid import answer_sids, generation_sid
from ..operators import judge as J
from ..operators import labelmetrics as LM
from ..operators import recmetrics as R
from ..session import read, scratch
from . import oracle as O
from . import stubs
from . import testbed as TB
from .catalog import query
from .q_corpus import _COLL, _ordered_collisions

KS = [1, 3, 10]


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _tail(x: str) -> str:
    return strip(f"string_split({x}, '</think>')[-1]")


def gsid(x: str) -> str:
    """SQL twin of functions.sid.generation_sid over a column `t` holding the tail."""
    parts = f"[q FOR q IN [{strip('''string_split(p, '<|sid_end|>')[1]''')} FOR p IN string_split({x}, '<|sid_begin|>')] IF q<>'']"
    return f"CASE WHEN contains({x}, '<|sid_begin|>') THEN coalesce({parts}[1], {x}) ELSE {x} END"


def asids(x: str) -> str:
    inner = (f"[q FOR q IN [{strip('''string_split(p, '<|sid_end|>')[1]''')} FOR p IN "
             f"[z FOR z IN string_split({x}, '<|sid_begin|>') IF contains(z, '<|sid_end|>')]] IF q<>'']")
    return inner


def first_seen(lst: str) -> str:
    return f"list_filter({lst}, lambda q, i: list_position({lst}, q)=i)"


_PRED = dict(
    tails=f"SELECT *, {_tail('text')} t FROM gen",
    pred=f"SELECT uid, sample_id, rk, lp, text, t, {gsid('t')} sid FROM tails",
    tru=f"SELECT *, {asids('answer')} raw FROM truth",
    tt=f"SELECT * EXCLUDE (raw), {first_seen('raw')} ids FROM tru",
)


def ks_sql(pred: str, truth: str, ks=KS, prefix="", drop_zero=False) -> str:
    cols = []
    for k in ks:
        top = f"{pred}[1:{k}]"
        if drop_zero:
            top = f"list_filter({top}, lambda z: z<>0)"
        use = f"(coalesce(len({pred}),0)>0 AND len({truth})>0)"
        cols += [
            f'({use} AND coalesce(list_has_any({top},{truth}),false)) AS "{prefix}pass@{k}"',
            f'({use} AND coalesce(list_contains({top},{truth}[1]),false)) AS "{prefix}position1_pass@{k}"',
            f'CASE WHEN {use} THEN {O.r6(f"len(list_intersect(list_distinct({top}),{truth}))/len({truth})::DOUBLE")} '
            f'ELSE 0.0::DOUBLE END AS "{prefix}recall@{k}"',
        ]
    return ", ".join(cols)


_H12 = dict(_PRED, pl="SELECT sample_id, list(sid ORDER BY rk) p FROM pred GROUP BY 1",
            j="SELECT tt.*, p FROM tt LEFT JOIN pl USING (sample_id)")


def _rounded(df):
    return df.select(*[r6(F.col(f"`{c}`")).alias(c) if "recall" in c else F.col(f"`{c}`") for c in df.columns])


@query("H1_truth_sids", O.sql("SELECT sample_id, array_to_string(ids,'~') AS ids FROM tt", **_PRED))
def h1(spark, sf):
    return TB.generations(spark, sf).select("sample_id", F.array_join(answer_sids(F.col("answer")), "~").alias("ids"))


@query("H2_first_truth_sid", O.sql("SELECT sample_id, coalesce(ids[1],'') AS id FROM tt", **_PRED))
def h2(spark, sf):
    first = F.get(answer_sids(F.col("answer")), 0)
    return TB.generations(spark, sf).select("sample_id", F.coalesce(first, F.lit("")).alias("id"))


@query("H3_generation_sid", O.sql("SELECT sample_id, (rk-1)::INT AS at, sid FROM pred", **_PRED))
def h3(spark, sf):
    g = TB.generations(spark, sf).select("sample_id", F.posexplode("generations").alias("at", "g"))
    return g.select("sample_id", "at", generation_sid(F.col("g")).alias("sid"))


_CODE = "regexp_extract(t,'<s_a_(\\d+)><s_b_(\\d+)><s_c_(\\d+)>',{})"
_ITEMS = dict(_PRED, coll=_COLL,
              best='SELECT code, arg_min(pid, ord) pid FROM coll GROUP BY 1',
              coded="SELECT sample_id, rk, lp, text, " + "try_cast(" + _CODE.format(1) + " AS BIGINT)*67108864+try_cast("
                    + _CODE.format(2) + " AS BIGINT)*8192+try_cast(" + _CODE.format(3) + " AS BIGINT) code FROM pred",
              mapped="SELECT sample_id, rk, lp, text, coalesce(pid,0) pid FROM coded LEFT JOIN best USING (code)")


@query("H4_generation_items", O.sql(
    "SELECT sample_id, array_to_string(list(pid ORDER BY rk),',') AS items FROM mapped GROUP BY 1", **_ITEMS))
def h4(spark, sf):
    items = R.best_items(_ordered_collisions(spark, sf))
    out = R.generations_to_items(TB.generations(spark, sf), ["sample_id"], F.col("generations"), items)
    return out.select("sample_id", F.array_join("items", ",").alias("items"))


_H = O.h("42", "code", "pid")


@query("H5_item_strategies", O.sql(
    f"SELECT code, arg_min(pid, ord) AS first_pid, arg_max(pid, (count_ds, hh, pid)) AS sampled_pid, "
    f"arg_max(pid, (hh, pid)) AS random_pid FROM (SELECT *, {_H} hh FROM coll) GROUP BY 1", coll=_COLL))
def h5(spark, sf):
    m = _ordered_collisions(spark, sf)
    names = ["first_pid", "sampled_pid", "random_pid"]
    a, b, c = (R.best_items(m, s).withColumnRenamed("pid", n) for s, n in zip(R.STRATEGIES, names))
    return a.join(b, "code").join(c, "code")


@query("H6_truth_items", O.sql(
    "SELECT sample_id, array_to_string(l,',') AS items, coalesce(l[1],0) AS first_item FROM (SELECT sample_id, "
    + first_seen("nz") + " l FROM (SELECT sample_id, list_filter(answer_pid, lambda z: z<>0) nz FROM truth))"))
def h6(spark, sf):
    g = TB.generations(spark, sf).withColumn("as_json", F.to_json("answer_pid"))
    ids = R.truth_items(R.parse_item_json(F.col("as_json")))
    return g.select("sample_id", F.array_join(ids, ",").alias("items"),
                    F.coalesce(F.get(ids, 0), F.lit(0).cast("bigint")).alias("first_item"))


@query("H7_candidate_order", O.sql(
    "SELECT sample_id, array_to_string(list(text ORDER BY lp DESC, rk),'~') AS texts FROM "
    "(SELECT sample_id, text, max(lp) lp, arg_min(rk, (-lp, rk)) rk FROM gen GROUP BY 1,2) GROUP BY 1"))
def h7(spark, sf):
    g = TB.generations(spark, sf).where(F.size("generations") > 0)
    chosen = R.select_candidates(F.col("generations"), F.col("logprobs"), "top_k_by_logprobs")
    return g.select("sample_id", F.array_join(chosen, "~").alias("texts"))


@query("H8_unique_ids", O.sql(
    "SELECT sample_id, array_to_string(list(sid ORDER BY lp DESC, rk)[1:4],'~') AS ids, "
    "array_to_string(list(src ORDER BY lp DESC, rk)[1:4],'~') AS sources FROM (SELECT sample_id, sid, max(lp) lp, "
    "arg_min(rk, (-lp, rk)) rk, arg_min(CASE WHEN rk%2=0 THEN 'even' ELSE 'odd' END, (-lp, rk)) src "
    "FROM pred JOIN tt USING (sample_id) WHERE trim(text)<>'' AND sid<>'' AND sid IS DISTINCT FROM ids[1] GROUP BY 1,2) GROUP BY 1",
    **_PRED))
def h8(spark, sf):
    g = TB.generations(spark, sf).where(F.size("generations") > 0)
    truth = answer_sids(F.col("answer"))
    src = F.transform("generations", lambda x, i: F.when(i % 2 == 1, "even").otherwise("odd"))
    ids = R.unique_ids(F.col("generations"), 4, F.col("logprobs"), F.slice(truth, 1, 1), src)
    out = once(g, u=ids).where(F.size("u") > 0)
    return out.select("sample_id", F.array_join(F.col("u.id"), "~").alias("ids"),
                      F.array_join(F.col("u.source"), "~").alias("sources"))


def _metric_query(kind: str):
    def run(spark, sf):
        m = _rounded(R.sid_metrics(TB.generations(spark, sf), KS))
        return m.select("sample_id", *[f"`{c}`" for c in m.columns if c.startswith(kind)])
    names = ", ".join(f'"{kind}@{k}"' for k in KS)
    query(f"{ {'pass': 'H9', 'position1_pass': 'H10', 'recall': 'H11'}[kind]}_{kind}_at_k",
          O.sql(f"SELECT sample_id, {names} FROM (SELECT sample_id, {ks_sql('p', 'ids')} FROM j)", **_H12))(run)


for _kind in ("pass", "position1_pass", "recall"):
    _metric_query(_kind)


@query("H12_sample_metrics", O.sql(
    f"SELECT sample_id, split, {ks_sql('p', 'ids')} FROM j",
    **dict(_H12, pl="SELECT sample_id, list(sid ORDER BY lp DESC, rk) p FROM (SELECT sample_id, text, any_value(sid) sid, "
                    "max(lp) lp, arg_min(rk,(-lp,rk)) rk FROM pred GROUP BY 1,2) GROUP BY 1")))
def h12(spark, sf):
    m = _rounded(R.sid_metrics(TB.generations(spark, sf), KS, "top_k_by_logprobs"))
    return m.select("sample_id", "split", *[f"`{c}`" for c in m.columns if "@" in c])


_NAMES = [f"{m}@{k}" for k in KS for m in ("pass", "position1_pass", "recall")]


@query("H13_overall_metrics", O.sql(
    "SELECT model, task, split, count(*) AS samples, " + ", ".join(
        O.r6(f'avg("{n}"::DOUBLE)') + f' AS "{n}"' for n in _NAMES)
    + f" FROM (SELECT 'base' model, 'video' task, split, {ks_sql('p', 'ids')} FROM j) GROUP BY ALL", **_H12))
def h13(spark, sf):
    out = R.overall(_rounded(R.sid_metrics(TB.generations(spark, sf), KS)), ["model", "task", "split"], _NAMES)
    return out.select("model", "task", "split", "samples", *[r6(F.col(f"`{n}`")).alias(n) for n in _NAMES])


@query("H14_merged_modes", O.sql(
    f"SELECT j.sample_id, {ks_sql('p', 'ids')}, {ks_sql('q', 'il', prefix='pid_', drop_zero=True)}, "
    "coalesce(array_to_string(q,','),'') AS pid_generations FROM j JOIN (SELECT sample_id, " + first_seen("nz") +
    " il FROM (SELECT sample_id, list_filter(answer_pid, lambda z: z<>0) nz FROM truth)) USING (sample_id) LEFT JOIN "
    "(SELECT sample_id, list(pid ORDER BY rk) q FROM mapped GROUP BY 1) USING (sample_id)",
    **{**_ITEMS, **_H12}))
def h14(spark, sf):
    items = R.best_items(_ordered_collisions(spark, sf))
    m = _rounded(R.merged_metrics(TB.generations(spark, sf), ["sample_id"], KS, items))
    return m.withColumn("pid_generations", F.array_join("pid_generations", ","))


@query("H15_debug_rows", O.sql(
    "SELECT sample_id, array_to_string(ids,'~') AS truth, coalesce(ids[1],'') AS first_truth, "
    "coalesce(array_to_string(p[1:10],'~'),'') AS top_ids, "
    "CASE WHEN length(prompt)>200 THEN prompt[1:200]||'...' ELSE prompt END AS prompt_snippet, "
    '"pass@3", "position1_pass@3" FROM (SELECT *, ' + ks_sql("p", "ids", [3]) + " FROM j)", **_H12))
def h15(spark, sf):
    d = R.debug_rows(TB.generations(spark, sf), ["sample_id"], [3])
    return d.withColumn("truth", F.array_join("truth", "~")).withColumn("top_ids", F.array_join("top_ids", "~"))


_OUT = "replace(text,'<|sid_end|>','')"


@query("H16_two_stage_regroup", O.sql(
    "SELECT sample_id, count(*)*2 AS n, md5(string_agg(text||'</think>'||chr(10)||'>'||'a'||rk||'~'||text||'</think>'||"
    "chr(10)||'>'||'b'||rk, '~' ORDER BY rk)) AS generations_md5, "
    "sum(length('Watched by '||uid||': '||repeat('clip ',45)||text||'</think>'||chr(10)||'>'))::BIGINT AS input_tokens, "
    "sum(rk)::BIGINT AS output_tokens, max(tm) AS time FROM gen GROUP BY 1"))
def h16(spark, sf):
    g = TB.generations(spark, sf).withColumn("thinkings", F.col("generations"))
    fan = R.fan_out(g.select("sample_id", "prompt", "thinkings", "times"), ["sample_id"], ">")
    # the composed prompts are counted where they are made: the join moves their length
    fan = fan.withColumn("input_tokens", F.length("stage2_prompt").cast("bigint")).drop("prompt", "stage2_prompt")
    times = g.select("sample_id", F.posexplode("times").alias("idx", "time"))
    rank = (F.col("idx") + 1).cast("string")
    stage2 = fan.join(times, ["sample_id", "idx"]).select(
        "sample_id", "idx", "thinking", F.array(F.concat(F.lit("a"), rank), F.concat(F.lit("b"), rank)).alias("outputs"),
        "input_tokens", (F.col("idx") + 1).cast("bigint").alias("output_tokens"), "time")
    out = R.regroup(stage2, ["sample_id"], ">")
    return out.select("sample_id", F.size("generations").cast("bigint").alias("n"),
                      F.md5(F.array_join("generations", "~")).alias("generations_md5"),
                      "input_tokens", "output_tokens", "time")


# ---- label prediction -------------------------------------------------------------------

def _label_rows(spark, sf):
    """Judged documents with yes/no probability JSON from their length."""
    d = read(spark, sf, "documents").join(read(spark, sf, "labels"), "doc_id")
    p = F.round(F.least(F.col("n_chars"), F.lit(4000)) / 400).cast("int")
    js = F.concat(F.lit('{"是": '), (p / 10).cast("string"), F.lit(', "否": '), ((12 - p) / 10).cast("string"), F.lit("}"))
    gen = F.when(F.col("lang") == "de", F.concat(F.lit("<think>hm</think> "), js)).otherwise(js)
    gens = F.when(F.col("n_chars") < 150, F.array(gen, F.lit("unsure"))).when(
        F.col("toxic") == 1, F.array(gen, F.lit('{"是": 0.5, "否": 0.5}'))).otherwise(F.array(gen))
    answer = F.when(F.col("quality") == 1, "是").when(F.col("n_chars") > 3000, "?").otherwise("否")
    return d.select("doc_id", "lang", answer.alias("answer"), gens.alias("generations"))


_LAB = dict(
    lr="SELECT doc_id, lang, toxic, n_chars, quality, round(least(n_chars,4000)/400.0)::INT p, "
       "CASE WHEN quality=1 THEN 1 WHEN n_chars>3000 THEN -1 ELSE 0 END AS label "
       "FROM documents JOIN labels USING (doc_id)",
    lp="SELECT doc_id, lang, label, CASE WHEN n_chars<150 THEN NULL WHEN toxic=1 THEN ((p/10.0::DOUBLE)/1.2::DOUBLE+0.5)/2 "
       "ELSE (p/10.0::DOUBLE)/1.2::DOUBLE END score FROM lr",
    sc="SELECT doc_id, lang, label, round(score,6)+0.0 score FROM lp",
)


def _scored(spark, sf):
    return _label_rows(spark, sf).select(
        "doc_id", "lang", LM.label_from_answer(F.col("answer")).alias("label"),
        r6(LM.sample_probability(F.col("generations"))).alias("score"))


@query("I1_answer_label", O.sql("SELECT doc_id, label FROM lr", **_LAB))
def i1(spark, sf):
    return _label_rows(spark, sf).select("doc_id", LM.label_from_answer(F.col("answer")).alias("label"))


@query("I2_positive_probability", O.sql("SELECT doc_id, score FROM sc", **_LAB))
def i2(spark, sf):
    return _scored(spark, sf).select("doc_id", "score")


_AUC = ("SELECT {cols} sum((label=1)::INT)::BIGINT AS positives, sum((label=0)::INT)::BIGINT AS negatives, "
        "CASE WHEN sum((label=1)::INT)=0 OR sum((label=0)::INT)=0 THEN 0.5::DOUBLE ELSE "
        + O.r6("sum(CASE WHEN label=1 THEN below+ties/2.0 END)/(sum((label=1)::INT)*sum((label=0)::INT))") + " END AS auc FROM "
        "(SELECT *, (SELECT count(*) FROM sc b WHERE b.label=0 AND {same} b.score<a.score) below, "
        "(SELECT count(*) FROM sc b WHERE b.label=0 AND {same} b.score=a.score) ties FROM sc a "
        "WHERE score IS NOT NULL AND label IN (0,1)) {grp}")


@query("I3_auc", O.sql(_AUC.format(cols="", same="", grp=""), **_LAB))
def i3(spark, sf):
    return LM.auc(_scored(spark, sf), "score", "label").withColumn("auc", r6(F.col("auc")))


@query("I3_auc_by_language", O.sql(_AUC.format(cols="lang,", same="b.lang=a.lang AND", grp="GROUP BY lang"), **_LAB))
def i3b(spark, sf):
    return LM.auc(_scored(spark, sf), "score", "label", ["lang"]).withColumn("auc", r6(F.col("auc")))


@query("I4_accuracy_buckets", O.sql(
    "SELECT lang, count(*) AS total_samples, sum((label IN (0,1))::INT)::BIGINT AS valid_samples, "
    "sum((ok AND r)::INT)::BIGINT AS correct, sum((ok AND NOT r)::INT)::BIGINT AS incorrect, "
    "sum((NOT ok)::INT)::BIGINT AS invalid, " + O.r6("avg(CASE WHEN ok THEN r::INT END)") + " AS accuracy FROM "
    "(SELECT *, label IN (0,1) AND score IS NOT NULL ok, coalesce((score>0.5)=(label=1),false) r FROM sc) GROUP BY 1", **_LAB))
def i4(spark, sf):
    return LM.accuracy_buckets(_scored(spark, sf), "score", "label", ["lang"]).withColumn("accuracy", r6(F.col("accuracy")))


# ---- information points -----------------------------------------------------------------

def _point_texts(spark, sf):
    """Truth = caption of an item, prediction = caption of the next item."""
    c = TB.captions(spark, sf).where("dense_caption <> ''")
    truth = c.select(F.col("pid").cast("string").alias("sample_id"), F.col("dense_caption").alias("text"))
    model = c.select((F.col("pid") - 1).cast("string").alias("sample_id"), F.col("dense_caption").alias("text"))
    return truth, model


_CAP = dict(
    cap="SELECT pid, list_distinct(string_split(dense_caption,' ')) w FROM captions WHERE dense_caption<>''",
    pair="SELECT a.pid::VARCHAR sample_id, a.w g, b.w m FROM cap a JOIN cap b ON b.pid=a.pid+1",
    sets="SELECT sample_id, list_filter(g, lambda x: list_contains(m,x)) hit, list_filter(g, lambda x: NOT list_contains(m,x)) miss, "
         "list_filter(m, lambda x: NOT list_contains(g,x)) extra FROM pair",
)


def _f1(tp, fp, fn):
    return f"CASE WHEN 2*({tp})+({fp})+({fn})>0 THEN {O.r6(f'2*({tp})/(2*({tp})+({fp})+({fn}))::DOUBLE')} ELSE 0.0::DOUBLE END"


def _sum(lst, expr, cond="true"):
    return f"coalesce(list_sum([({expr})::DOUBLE FOR x IN {lst} IF {cond}]),0)"


_L, _C, _Q = "length(x)", "length(x)>=5", "(length(x)%5)/5.0::DOUBLE"
_SIX = {
    "wip_unweighted_f1": _f1(_sum("hit", "1"), _sum("extra", "1"), _sum("miss", "1")),
    "wip_unweighted_core_f1": _f1(_sum("hit", "1", _C), _sum("extra", "1", _C), _sum("miss", "1", _C)),
    "wip_importance_weighted_f1": _f1(_sum("hit", _L), _sum("extra", _L), _sum("miss", _L)),
    "wip_importance_weighted_core_f1": _f1(_sum("hit", _L, _C), _sum("extra", _L, _C), _sum("miss", _L, _C)),
    "wip_double_weighted_f1": _f1(_sum("hit", f"{_L}*{_Q}"), _sum("hit", f"{_L}*(1-{_Q})") + "+" + _sum("extra", _L),
                                  _sum("hit", f"{_L}*(1-{_Q})") + "+" + _sum("miss", _L)),
    "wip_double_weighted_core_f1": _f1(
        _sum("hit", f"{_L}*{_Q}", _C), _sum("hit", f"{_L}*(1-{_Q})", _C) + "+" + _sum("extra", _L, _C),
        _sum("hit", f"{_L}*(1-{_Q})", _C) + "+" + _sum("miss", _L, _C)),
}


@query("I5_point_extraction", O.sql(
    "SELECT pid::VARCHAR AS sample_id, len(w)::INT AS points, list_sum([length(x) FOR x IN w])::BIGINT AS weight FROM cap", **_CAP))
def i5(spark, sf):
    truth, _ = _point_texts(spark, sf)
    p = J.extract_points(truth, stubs.points)
    return p.select("sample_id", F.size("wips").alias("points"),
                    F.aggregate("wips", F.lit(0).cast("bigint"), lambda s, x: s + x["importance_score"]).alias("weight"))


def _matched(spark, sf):
    truth, model = _point_texts(spark, sf)
    return J.match_points(J.extract_points(truth, stubs.points, "gt_wips"),
                          J.extract_points(model, stubs.points, "model_wips"), stubs.match)


@query("I6_point_matching", O.sql(
    "SELECT sample_id, len(hit)::INT AS matched, len(extra)::INT AS extra, len(miss)::INT AS missed FROM sets", **_CAP))
def i6(spark, sf):
    return _matched(spark, sf).select(
        "sample_id", F.size("match.matches").alias("matched"), F.size("match.unmatched_model_wips").alias("extra"),
        F.size("match.unmatched_gt_wips").alias("missed"))


@query("I7_incremental_cache", O.sql(
    "SELECT sample_id, max(value) AS value FROM (SELECT sample_id, -1::BIGINT AS value FROM cached UNION ALL "
    "SELECT pid::VARCHAR, length(dense_caption) FROM captions WHERE dense_caption<>'' AND pid::VARCHAR NOT IN "
    "(SELECT sample_id FROM cached)) GROUP BY 1",
    cached="SELECT p_partkey::VARCHAR sample_id FROM part JOIN captions ON pid=p_partkey WHERE p_size>25 AND dense_caption<>''"))
def i7(spark, sf):
    wanted, _ = _point_texts(spark, sf)
    cached = read(spark, sf, "part").where("p_size > 25").select(
        F.col("p_partkey").cast("string").alias("sample_id"), F.lit(-1).cast("bigint").alias("value"))
    return J.with_cache(cached, wanted, lambda rows: rows.select("sample_id", F.length("text").cast("bigint").alias("value")))


@query("I8_match_quality", O.sql(
    f"SELECT sample_id, {O.r6(_sum('hit', _Q))} AS quality FROM sets", **_CAP))
def i8(spark, sf):
    from ..session import cut
    m = J.fill_quality(cut(_matched(spark, sf)), stubs.similarity)
    total = F.aggregate("match.matches", F.lit(0.0), lambda s, x: s + x["match_quality"])
    return m.select("sample_id", r6(total).alias("quality"))


def _match_table(spark, sf):
    """Match structs built from two word lists, no judge involved."""
    truth, model = _point_texts(spark, sf)
    pair = truth.select("sample_id", F.array_distinct(F.split("text", " ")).alias("g")).join(
        model.select("sample_id", F.array_distinct(F.split("text", " ")).alias("m")), "sample_id")

    def point(x):
        return F.struct(x.alias("info_point"), F.length(x).alias("importance_score"))

    hit = F.transform(F.array_intersect("g", "m"), lambda x: F.struct(
        point(x).alias("gt_wip"), point(x).alias("model_wip"), (F.length(x) % 5 / 5.0).alias("match_quality")))
    return pair.select("sample_id", F.struct(
        hit.alias("matches"), F.transform(F.array_except("m", "g"), point).alias("unmatched_model_wips"),
        F.transform(F.array_except("g", "m"), point).alias("unmatched_gt_wips")).alias("match"))


for _id, _kind in (("I9", "unweighted"), ("I10", "importance_weighted"), ("I11", "double_weighted")):
    def _run(spark, sf, kind=_kind):
        names = [f"wip_{kind}_f1", f"wip_{kind}_core_f1"]
        return J.score_matches(_match_table(spark, sf)).select("sample_id", *[r6(F.col(n)).alias(n) for n in names])
    query(f"{_id}_{_kind}_f1", O.sql("SELECT sample_id, " + ", ".join(
        f"{_SIX[n]} AS {n}" for n in (f"wip_{_kind}_f1", f"wip_{_kind}_core_f1")) + " FROM sets", **_CAP))(_run)


@query("I12_point_evaluation", O.sql(
    "SELECT " + ", ".join(f"{O.r6(f'avg({n})')} AS macro_{n}" for n in _SIX) + ", count(*) AS wip_num_samples FROM (SELECT "
    + ", ".join(f"{v} AS {n}" for n, v in _SIX.items()) + " FROM sets ORDER BY sample_id LIMIT 500)", **_CAP))
def i12(spark, sf):
    truth, model = _point_texts(spark, sf)
    overall, _ = J.evaluate_points(model, truth, stubs.points, stubs.match, stubs.similarity, max_samples=500)
    return overall.select(*[r6(F.col(c)).alias(c) if c.startswith("macro") else F.col(c) for c in overall.columns])


_REFINE = ("SELECT doc_id, lang, CASE WHEN lang='en' THEN '<think>a</think> x 精炼推理 **: '||text WHEN lang='de' THEN "
           "'精炼推理精炼推理： '||text ELSE text||' 精炼推理 #' END raw FROM documents")
_REFINED = dict(
    raw=_REFINE,
    th=f"SELECT doc_id, lang, CASE WHEN contains(raw,'</think>') THEN {_tail('raw')} ELSE raw END raw FROM raw",
    cl="SELECT doc_id, lang, raw, " + strip("regexp_replace(string_split(raw,'精炼推理')[-1], '^[\\s*#：:]+', '')") + " c FROM th",
    fin=f"SELECT doc_id, lang, CASE WHEN contains(raw,'精炼推理') AND c<>'' THEN c ELSE {strip('raw')} END refined FROM cl",
)


def _reason_texts(spark, sf):
    t = F.col("text")
    raw = F.when(F.col("lang") == "en", F.concat(F.lit("<think>a</think> x 精炼推理 **: "), t)).when(
        F.col("lang") == "de", F.concat(F.lit("精炼推理精炼推理： "), t)).otherwise(F.concat(t, F.lit(" 精炼推理 #")))
    return read(spark, sf, "documents").select("doc_id", raw.alias("raw"))


@query("I13_refined_reasoning", O.sql("SELECT doc_id, md5(refined) AS refined_md5 FROM fin", **_REFINED))
def i13(spark, sf):
    return _reason_texts(spark, sf).select("doc_id", F.md5(J.reasoning_text(F.col("raw"))).alias("refined_md5"))


def _replies(spark, sf):
    """Judge replies in the shapes seen in practice, one per event."""
    v = F.floor("value").cast("string")
    t = F.col("event_type")
    reply = (F.when(t == "view", F.concat(F.lit('```json\n{"llm_score": '), v, F.lit(', "llm_reason": "seen"}\n```')))
             .when(t == "click", F.concat(F.lit('Verdict: {"llm_score": '), v, F.lit("} done")))
             .when(t == "signup", F.concat(F.lit('{"llm_score": "high", "llm_reason": "r'), v, F.lit('"}')))
             .when(t == "error", F.lit("no json here")).otherwise(F.lit('{"llm_reason": "only"}')))
    return read(spark, sf, "events").select("event_id", "event_type", reply.alias("reply"))


_FL = "floor(value)::BIGINT"


@query("I14_tolerant_json", f"SELECT event_id, CASE event_type WHEN 'view' THEN {_FL}::VARCHAR WHEN 'click' THEN {_FL}::VARCHAR "
       f"WHEN 'signup' THEN 'high' END AS score, CASE event_type WHEN 'view' THEN 'seen' WHEN 'signup' THEN 'r'||{_FL} "
       "WHEN 'purchase' THEN 'only' END AS reason FROM events")
def i14(spark, sf):
    parsed = J.tolerant_json(F.col("reply"), J.VERDICT)
    return _replies(spark, sf).select("event_id", parsed["llm_score"].alias("score"), parsed["llm_reason"].alias("reason"))


@query("I15_judge_score", f"SELECT event_type, count(*) AS results, {O.r6('avg(s)')} AS llm_score FROM (SELECT event_type, "
       f"CASE WHEN event_type IN ('view','click') THEN CASE WHEN {_FL} BETWEEN 1 AND 5 THEN {_FL} ELSE 3 END "
       "WHEN event_type='signup' THEN 3 END s FROM events) WHERE s IS NOT NULL GROUP BY 1")
def i15(spark, sf):
    scored = _replies(spark, sf).select("event_type", J.judge_score(F.col("reply")).alias("s")).where("s IS NOT NULL")
    return scored.groupBy("event_type").agg(F.count(F.lit(1)).alias("results"), r6(F.avg("s")).alias("llm_score"))


@query("I16_reasoning_evaluation", O.sql(
    "SELECT d.doc_id::VARCHAR AS sample_id, CASE WHEN quality=0 THEN 2.0::DOUBLE WHEN length(refined)%7 BETWEEN 1 AND 5 "
    "THEN (length(refined)%7)::DOUBLE ELSE 3.0::DOUBLE END AS llm_score, CASE WHEN quality=0 THEN 'cached' ELSE 'length' END AS llm_reason "
    "FROM documents d JOIN fin USING (doc_id) LEFT JOIN labels USING (doc_id)", **_REFINED))
def i16(spark, sf):
    model = _reason_texts(spark, sf).select(F.col("doc_id").cast("string").alias("sample_id"), F.col("raw").alias("text"))
    truth = read(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("sample_id"), "text")
    cached = read(spark, sf, "labels").where("quality = 0").select(
        F.col("doc_id").cast("string").alias("sample_id"), F.lit(2.0).alias("llm_score"), F.lit("cached").alias("llm_reason"))
    return J.evaluate_reasoning(model, truth, stubs.verdict, cached)


@query("I16_reasoning_summary", O.sql(
    "SELECT " + O.r6("avg(s)") + " AS llm_score, count(*) AS llm_eval_num_samples FROM (SELECT CASE WHEN quality=0 THEN 2.0::DOUBLE "
    "WHEN length(refined)%7 BETWEEN 1 AND 5 THEN (length(refined)%7)::DOUBLE ELSE 3.0::DOUBLE END AS s "
    "FROM documents d JOIN fin USING (doc_id) LEFT JOIN labels USING (doc_id))", **_REFINED))
def i16b(spark, sf):
    return J.judge_summary(i16(spark, sf)).withColumn("llm_score", r6(F.col("llm_score")))


@query("I17_batch_call", "SELECT conv_id*100+turn AS idx, CASE WHEN length(text)>=40 THEN length(text)::VARCHAR END AS result, "
       "CASE WHEN length(text)<40 THEN 'prompt too short' END AS error, length(text)>=40 AS success FROM conversations")
def i17(spark, sf):
    c = read(spark, sf, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("idx"), "text")
    return J.batch_call(c, "idx", "text", stubs.echo)


@query("I18_utilisation", O.sql(
    "SELECT split, (rk-1)::INT AS stage, sum(ot)::BIGINT AS input_tokens, sum(ot)::BIGINT AS output_tokens, max(tm) AS time, "
    "round(1.7e9::DOUBLE*2*(2*sum(ot))/(0.0001::DOUBLE*1e12*8*max(tm)),6) AS utilisation FROM gen JOIN truth USING (sample_id) "
    "GROUP BY split, rk"))
def i18(spark, sf):
    g = TB.generations(spark, sf).withColumn("input_tokens", F.col("output_tokens"))
    stages = LM.stage_totals(g, ["split"])
    return LM.utilisation(stages, F.lit(1.7e9), F.lit(0.0001), F.lit(8))


_RESULT_ROWS = ("SELECT event_type AS model, 'm'||(user_id%4) AS metric, CASE WHEN user_id%9=0 THEN '_meta' ELSE 't'||user_id%3 END AS task, "
                "value AS total_time FROM events WHERE NOT (event_type='click' AND user_id%4=2)")


@query("I19_cache_decision", f"SELECT model, count(DISTINCT CASE WHEN metric IN ('m0','m2') THEN metric END)=2 AS reuse FROM ({_RESULT_ROWS}) GROUP BY 1")
def i19(spark, sf):
    return LM.cache_complete(_result_rows(spark, sf), ["m0", "m2"], ["model"])


def _result_rows(spark, sf):
    u = F.col("user_id")
    rows = read(spark, sf, "events").where("NOT (event_type = 'click' AND user_id % 4 = 2)")
    return rows.select(F.col("event_type").alias("model"), F.concat(F.lit("m"), (u % 4).cast("string")).alias("metric"),
                       F.when(u % 9 == 0, "_meta").otherwise(F.concat(F.lit("t"), (u % 3).cast("string"))).alias("task"),
                       F.col("value").alias("total_time"))


@query("I20_total_time", f"SELECT model, {O.r6('sum(total_time)')} AS total_time FROM ({_RESULT_ROWS}) WHERE task NOT LIKE '\\_%' ESCAPE '\\' GROUP BY 1")
def i20(spark, sf):
    return LM.model_total_time(_result_rows(spark, sf)).withColumn("total_time", r6(F.col("total_time")))


@query("I20_write_back", O.sql('SELECT sample_id, answer, "pass@1" FROM (SELECT sample_id, answer, ' + ks_sql("p", "ids", [1]) + " FROM j)", **_H12))
def i20b(spark, sf):
    g = TB.generations(spark, sf)
    metrics = R.sid_metrics(g, [1]).select("sample_id", "`pass@1`")
    return LM.write_back(g.select("sample_id", "answer"), metrics, ["sample_id"])


@query("B8_detailed_sink", O.sql(
    f"SELECT a.sample_id, a.text AS reference, b.text AS prediction, {_SIX['wip_unweighted_f1']} AS wip_unweighted_f1 FROM "
    "(SELECT pid::VARCHAR sample_id, dense_caption AS text FROM captions WHERE dense_caption<>'') a LEFT JOIN "
    "(SELECT (pid-1)::VARCHAR sample_id, dense_caption AS text FROM captions WHERE dense_caption<>'') b USING (sample_id) "
    "LEFT JOIN sets USING (sample_id)", **_CAP).replace("ELSE 0.0::DOUBLE END AS wip_unweighted_f1",
                                                        "WHEN hit IS NOT NULL THEN 0.0::DOUBLE END AS wip_unweighted_f1")
       .replace("CASE WHEN 2*(", "CASE WHEN hit IS NULL THEN NULL WHEN 2*("))
def b8(spark, sf):
    truth, model = _point_texts(spark, sf)
    scored = J.score_matches(_match_table(spark, sf)).select("sample_id", r6(F.col("wip_unweighted_f1")).alias("wip_unweighted_f1"))
    out = scratch(spark, "details")
    J.detailed_rows(truth.withColumnRenamed("text", "reference"), model.withColumnRenamed("text", "prediction"),
                    scored).write.parquet(out)
    return spark.read.parquet(out)
