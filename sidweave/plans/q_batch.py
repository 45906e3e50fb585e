"""Batch verb, balancing, preparation and monitoring queries (M*, N*, P*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import r6
from ..operators import balance as BL
from ..operators import batches as BT
from ..operators import monitor as MO
from ..operators import prep as PR
from ..operators import sampling
from ..operators import tokens as K
from ..session import read, scratch
from ..streaming import period_counters as SC
from . import oracle as O
from .catalog import query
from .q_corpus import md5_order
from .q_tokens import PAIR, chats, named_fold, pack_ctes, packs_of


def _batch(spark, sf, *cols):
    return read(spark, sf, "events").select(F.col("event_id").alias("row_id"), *cols)


# ---- batch verbs ------------------------------------------------------------------------

@query("M1_project_pop_rename", "SELECT event_id AS row_id, event_type AS kind, user_id AS who, value AS score FROM events")
def m1(spark, sf):
    b = BT.project(_batch(spark, sf, "event_type", "user_id", "value", "props"), ["event_type", "user_id", "value"])
    popped, rest = BT.pop(b, ["value"])
    return BT.rename(rest, {"event_type": "kind", "user_id": "who"}).join(BT.rename(popped, {"value": "score"}), "row_id")


@query("M2_pick_rows", "SELECT (SELECT max(event_id) FROM events)-event_id AS row_id, value FROM events WHERE event_type<>'view'")
def m2(spark, sf):
    b = _batch(spark, sf, "value")
    last = b.agg(F.max("row_id").alias("m"))
    index = _batch(spark, sf, "event_type").where("event_type <> 'view'").crossJoin(F.broadcast(last)).select(
        (F.col("m") - F.col("row_id")).alias("position"), "row_id")
    return BT.pick_rows(b, index)


@query("M2_slice_rows", "SELECT (event_id-100)//7 AS row_id, value FROM events WHERE event_id>=100 AND (event_id-100)%7=0")
def m2b(spark, sf):
    return BT.slice_rows(_batch(spark, sf, "value"), 100, 1 << 62, 7)


@query("M3_union_columns", "SELECT event_id AS row_id, event_type, value, props FROM events")
def m3(spark, sf):
    return BT.union_columns(_batch(spark, sf, "event_type", "value"), _batch(spark, sf, "value", "props"))


@query("M4_concat_chunk_split", "SELECT row_id, value, row_id//(n//2) AS half, row_id//900 AS chunk FROM (SELECT value, row_number() OVER (ORDER BY event_type='click', event_id)-1 row_id, "
       "count(*) OVER () n FROM (SELECT * FROM events WHERE event_type='view' UNION ALL SELECT * FROM events WHERE event_type='view' UNION ALL SELECT * FROM events WHERE event_type='click' "
       "UNION ALL SELECT * FROM events WHERE event_type='click'))")
def m4(spark, sf):
    view = _batch(spark, sf, "value", "event_type").where("event_type = 'view'").drop("event_type")
    click = _batch(spark, sf, "value", "event_type").where("event_type = 'click'").drop("event_type")
    twice = lambda d: BT.repeat_each(d.withColumn("k", F.lit(2)), "k").drop("k")
    both = BT.concat([twice(view), twice(click)])
    return BT.split(BT.chunk(both, 2).withColumnRenamed("chunk", "half"), 900)


@query("M5_reorder_and_back", f"SELECT event_id AS row_id, event_type, row_number() OVER (ORDER BY {md5_order(5, 'event_id')})-1 AS place FROM events")
def m5(spark, sf):
    b = _batch(spark, sf, "event_type")
    order = sampling.shuffled(_batch(spark, sf), 5, ["row_id"], "p").select((F.col("p") - 1).alias("position"), "row_id")
    mixed = BT.reorder(b, order).withColumn("place", F.col("row_id"))
    return BT.reorder(mixed, BT.inverse(order))


@query("M6_repeat", "SELECT 'interleave' AS mode, c_custkey*3+k AS row_id, c_custkey AS item FROM customer CROSS JOIN (SELECT unnest([0,1,2]) k) UNION ALL "
       "SELECT 'tile', k*(SELECT count(*) FROM customer)+c_custkey, c_custkey FROM customer CROSS JOIN (SELECT unnest([0,1,2]) k) UNION ALL "
       "SELECT 'each', row_number() OVER (ORDER BY c_custkey, k)-1, c_custkey FROM (SELECT c_custkey, unnest(range((c_nationkey%3)::BIGINT)) k FROM customer)")
def m6(spark, sf):
    c = read(spark, sf, "customer").select(F.col("c_custkey").alias("row_id"), F.col("c_custkey").alias("item"), (F.col("c_nationkey") % 3).alias("k"))
    out = BT.repeat(c, 3).withColumn("mode", F.lit("interleave")).unionByName(BT.repeat(c, 3, False).withColumn("mode", F.lit("tile")))
    return out.unionByName(BT.repeat_each(c, "k").withColumn("mode", F.lit("each"))).select("mode", "row_id", "item")


@query("M7_pad_to_multiple", "SELECT event_id AS row_id, value, false AS padded FROM events UNION ALL SELECT n+i, value, true FROM "
       "(SELECT n, unnest(range((64-n%64)%64)) i FROM (SELECT count(*) n FROM events)) JOIN events ON event_id=i%n")
def m7(spark, sf):
    return BT.pad_to_multiple(_batch(spark, sf, "value"), 64)


@query("M8_unfold", "SELECT vec_id*4+k AS row_id, label, " + O.r6("list_sum([x::DOUBLE FOR x IN embedding[k*16+1:k*16+16]])") + " AS total FROM embeddings CROSS JOIN (SELECT unnest([0,1,2,3]) k)")
def m8(spark, sf):
    e = read(spark, sf, "embeddings").select(F.col("vec_id").alias("row_id"), "embedding", "label")
    return BT.unfold(e, ["embedding"], 4).select("row_id", "label", r6(F.aggregate(
        "embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))).alias("total"))


# ---- balancing --------------------------------------------------------------------------

def _lengths(spark, sf):
    return _batch(spark, sf, (1 + F.floor("value")).alias("length"))


_LEN = "SELECT event_id row_id, event_id//100 batch, event_id%100 r, 1+floor(value)::BIGINT n FROM events"


@query("M9_balanced_parts", f"SELECT batch, 4::BIGINT AS parts, count(*) AS items, sum(n)::BIGINT AS tokens, 25::BIGINT AS equal_items, true AS tight FROM ({_LEN}) GROUP BY 1")
def m9(spark, sf):
    """Every row once, parts of equal size on request, and totals closer together than the longest row."""
    free = BL.balanced_parts(_lengths(spark, sf), 100, 4)
    equal = BL.balanced_parts(_lengths(spark, sf), 100, 4, equal=True)
    sums = free.groupBy("batch", "part").agg(F.sum("length").alias("s"), F.count(F.lit(1)).alias("n"), F.max("length").alias("m"))
    out = sums.groupBy("batch").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("items"), F.sum("s").alias("tokens"),
                                    (F.max("s") - F.min("s") <= F.max("m")).alias("tight"))
    even = equal.groupBy("batch", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("batch").agg(F.max("n").alias("equal_items"))
    return out.join(even, "batch")


_GREEDY = dict(
    ln=_LEN,
    gr="SELECT batch, r, n, 1::BIGINT p, [n,0::BIGINT,0::BIGINT,0::BIGINT] loads FROM ln WHERE r=0 UNION ALL SELECT t.batch, t.r, t.n, list_position(g.loads,list_min(g.loads))::BIGINT, "
       "list_transform(g.loads, lambda x, j: CASE WHEN j=list_position(g.loads,list_min(g.loads)) THEN x+t.n ELSE x END) FROM gr g JOIN ln t ON t.batch=g.batch AND t.r=g.r+1")


@query("M10_greedy_parts", O.sql("SELECT batch, batch*100+r AS row_id, n AS length, (p-1)::INT AS part FROM gr", **_GREEDY))
def m10(spark, sf):
    return BL.greedy_parts(_lengths(spark, sf), 100, 4)


@query("M11_micro_batches", f"SELECT batch, least(count(*),ceil(sum(n)/2000.0))::BIGINT AS parts, count(*) AS items, sum(n)::BIGINT AS tokens, true AS falling FROM ({_LEN}) GROUP BY 1")
def m11(spark, sf):
    parts = BL.micro_batches(_lengths(spark, sf), 100, 2000)
    sums = parts.groupBy("batch", "part").agg(F.sum("length").alias("s"), F.count(F.lit(1)).alias("n"), F.sum(F.col("length") * F.col("length")).alias("w"))
    order = F.transform(F.array_sort(F.collect_list(F.struct("part", "w"))), lambda x: x["w"])
    return sums.groupBy("batch").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("n").alias("items"), F.sum("s").alias("tokens"),
        (order == F.reverse(F.array_sort(order))).alias("falling"))


@query("M12_imbalance", O.sql(
    "SELECT batch, mn AS min, mx AS max, mx-mn AS minmax_diff, bmn AS balanced_min, bmx AS balanced_max, " + O.r6("tot/4.0") + " AS mean FROM "
    "(SELECT batch, min(s)::BIGINT mn, max(s)::BIGINT mx, sum(s) tot FROM (SELECT batch, r//25 c, sum(n) s FROM ln GROUP BY 1,2) GROUP BY 1) JOIN "
    "(SELECT batch, min(s)::BIGINT bmn, max(s)::BIGINT bmx FROM (SELECT batch, p, sum(n) s FROM gr GROUP BY 1,2) GROUP BY 1) USING (batch)", **_GREEDY))
def m12(spark, sf):
    return BL.imbalance(BL.greedy_parts(_lengths(spark, sf), 100, 4), 100, 4).withColumn("mean", r6(F.col("mean")))


# ---- preparation ------------------------------------------------------------------------

def _qa(spark, sf):
    m = F.col("messages")
    return chats(spark, sf).select("id", m[0]["content"].alias("q"), m[1]["content"].alias("a"))


def _flat(df, *cols):
    """RL rows as flat text columns."""
    return df.select("data_source", F.to_json("prompt").alias("prompt"), "ability", F.col("reward_model.style").alias("style"),
                     F.col("reward_model.ground_truth").alias("ground_truth"), F.to_json("extra_info").alias("extra_info"), *cols)


def _turns(*pairs):
    return "to_json([" + ",".join(f"{{'role':'{r}','content':{c}}}" for r, c in pairs) + "])::VARCHAR"


def _rl_sql(source, prompt, ability, style, truth, info, frm, **extra):
    return O.sql(f"SELECT {source} AS data_source, {prompt} AS prompt, '{ability}' AS ability, '{style}' AS style, {truth} AS ground_truth, "
                 f"to_json({{{info}}})::VARCHAR AS extra_info FROM {frm}", **extra)


_NH, _BH = O.lit(PR.NUMBER_HINT), O.lit(PR.BOX_HINT)


def _grade_rows(spark, sf):
    return _qa(spark, sf).select("id", F.col("q").alias("question"), F.concat("a", F.lit(" #### 1,"), F.col("id").cast("string")).alias("answer"))


_GINFO = "'split':'train','index':id,'answer':a||' #### 1,'||id,'question':q"


@query("N1_grade_school", _rl_sql("'grade_school'", _turns(("user", f"q||' '||{_NH}")), "math", "rule", "'1'||id", _GINFO, "pr", **PAIR))
def n1(spark, sf):
    return _flat(PR.grade_school(_grade_rows(spark, sf), "train", "id"))


@query("N1_grade_school_chat", O.sql("SELECT id, " + _turns(("user", f"q||' '||{_NH}"), ("assistant", "a||' #### 1,'||id")) + " AS messages FROM pr", **PAIR))
def n1b(spark, sf):
    return PR.grade_school_chat(_grade_rows(spark, sf)).select("id", F.to_json("messages").alias("messages"))


_K = "(SELECT *, json_extract_string(props,'$.k') k FROM events)"


@query("N2_competition_math", _rl_sql("'competition_math'", _turns(("user", f"'p'||event_id||' '||{_BH}")), "math", "rule", "'\\frac{1}{'||k||'}'",
                                      "'split':'test','index':event_id", _K))
def n2(spark, sf):
    e = read(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    rows = e.select("event_id", F.concat(F.lit("p"), F.col("event_id").cast("string")).alias("problem"),
                    F.concat(F.lit("so $\\boxed{2}$ or \\boxed{\\frac{1}{"), k, F.lit("}} end")).alias("solution"))
    return _flat(PR.competition_math(rows, "test", "event_id"))


def _tidy(x):
    return f"replace(regexp_replace(replace({x},' [title]','. '),'\\[.*?\\]','','g'),'  ',' ')"


@query("N3_sentence_completion", _rl_sql(
    "'sentence_completion'", _turns(("user", _tidy("'Chat: '||q||' [title] [note] x Ab '||lower(a)"))), "nlp", "model", "conv_id::VARCHAR",
    "'split':'train','index':id,'choices':[" + _tidy("q") + "," + _tidy("a||'  [x] y'") + "]", "pr WHERE turn<>2", **PAIR))
def n3(spark, sf):
    rows = _qa(spark, sf).select(
        "id", F.lit("Chat").alias("activity_label"), F.concat("q", F.lit(" [title] [note] x")).alias("ctx_a"), F.concat(F.lit("ab "), "a").alias("ctx_b"),
        F.array(F.col("q"), F.concat("a", F.lit("  [x] y"))).alias("endings"),
        F.when(F.col("id") % 100 == 2, "").otherwise(F.floor(F.col("id") / 100).cast("string")).alias("label"))
    return _flat(PR.sentence_completion(rows, "train", "id"))


def _prefs(spark, sf):
    return _qa(spark, sf).select("id", F.col("q").alias("prompt"), F.col("a").alias("chosen"), F.reverse("q").alias("rejected"))


@query("N4_preference_long", O.sql("SELECT id, q AS prompt, 0::INT AS side, a AS response FROM pr UNION ALL SELECT id, q, 1::INT, reverse(q) FROM pr", **PAIR))
def n4(spark, sf):
    return PR.preference_long(_prefs(spark, sf))


@query("N4_preference_pairs", O.sql(
    "SELECT id, q AS prompt, a AS chosen, reverse(q) AS rejected, CASE WHEN row_number() OVER (ORDER BY id)<=round(count(*) OVER ()*0.75::DOUBLE) THEN 'train' ELSE 'test' END AS part FROM pr", **PAIR))
def n4b(spark, sf):
    return PR.preference_pairs(_prefs(spark, sf), ["id"])


@query("N4_preference_prompts", _rl_sql("'preference'", _turns(("user", "q")), "alignment", "model", "a", "'split':'train','index':id", "pr", **PAIR))
def n4c(spark, sf):
    return _flat(PR.preference_prompts(_prefs(spark, sf).withColumnRenamed("chosen", "response"), "train", "id"))


_SQ = "'find doc '||doc_id"
_ST = "CASE WHEN lang='en' THEN source ELSE 'truth '||doc_id END"
_SD = "'search_'||CASE WHEN lang='es' THEN '' ELSE lang END"


@query("N5_search_questions", _rl_sql(
    _SD, _turns(("system", O.lit(PR.SEARCH_SYSTEM)), ("user", _SQ)), "qa", "rule", _ST,
    f"'split':'test','index':doc_id,'question':{_SQ},'need_tools_kwargs':true,'tools_kwargs':{{'search':{{'create_kwargs':{{'ground_truth':{_ST},'question':{_SQ},'data_source':{_SD}}}}}}}",
    "documents"))
def n5(spark, sf):
    d = read(spark, sf, "documents")
    reward = F.when(F.col("lang") != "en", F.struct(F.concat(F.lit("truth "), F.col("doc_id").cast("string")).alias("ground_truth")))
    rows = d.select("doc_id", F.concat(F.lit("find doc "), F.col("doc_id").cast("string")).alias("question"), reward.alias("reward_model"),
                    F.col("source").alias("golden_answers"), F.when(F.col("lang") != "es", F.col("lang")).alias("data_source"))
    return _flat(PR.search_questions(rows, "test", "doc_id"))


@query("N6_tool_arguments", O.sql(
    "SELECT id, to_json({" + _GINFO + ",'need_tools_kwargs':true,'tools_kwargs':{'grader':{'create_kwargs':{'ground_truth':'1'||id}}},"
    "'interaction_kwargs':{'name':'tutor','query':q,'ground_truth':'1'||id}})::VARCHAR AS extra_info FROM pr", **PAIR))
def n6(spark, sf):
    rows = PR.with_interaction(PR.with_tool(PR.grade_school(_grade_rows(spark, sf), "train", "id"), "grader"), "tutor")
    return rows.select(F.col("extra_info.index").alias("id"), F.to_json("extra_info").alias("extra_info"))


_W = "list_sort([{'h':md5(concat_ws('|','42',p_partkey::VARCHAR,i::VARCHAR)),'c':([p_brand,p_name||' x','none'])[i+1]} FOR i IN range(3)])"


@query("N7_multiple_choice", O.sql(
    "SELECT p_partkey, substr('ABCD',(g+1)::BIGINT,1) AS gold, p_name||'?'||chr(10)||chr(10)||'A) '||ch[1]||chr(10)||'B) '||ch[2]||chr(10)||'C) '||ch[3]||chr(10)||'D) '||ch[4]||chr(10)||chr(10)||"
    "'End with ''Answer: LETTER''.' AS query FROM (SELECT *, list_concat(list_concat(w[1:g],[p_type]),w[g+1:]) ch FROM "
    "(SELECT *, [x.c FOR x IN " + _W + "] w, " + O.h("42", "p_partkey", "'gold'") + "%4 g FROM part))"))
def n7(spark, sf):
    rows = read(spark, sf, "part").select(
        "p_partkey", F.concat("p_name", F.lit("?")).alias("question"), F.col("p_type").alias("correct"),
        F.array(F.col("p_brand"), F.concat("p_name", F.lit(" x")), F.lit("none")).alias("incorrect"))
    return PR.multiple_choice(rows, "p_partkey").select("p_partkey", "gold", "query")


@query("N8_contest_code", "SELECT event_id, 'q'||event_id||chr(10)||chr(10)||CASE WHEN user_id<20 THEN 'Start from:'||chr(10)||'def f()' ELSE 'Read stdin, write stdout.' END AS query, "
       "to_json({'inputs':['a',k],'outputs':['b','z'||k],'fn_name':CASE WHEN event_type='view' THEN 'go' END})::VARCHAR AS cases FROM " + _K
       + " WHERE strftime(ts,'%Y-%m-%dT%H:%M:%S')>='2024-01-03T00:00:00' AND strftime(ts,'%Y-%m-%dT%H:%M:%S')<'2024-01-20T00:00:00'")
def n8(spark, sf):
    k = F.get_json_object("props", "$.k")
    rows = read(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("contest_date"), F.concat(F.lit("q"), F.col("event_id").cast("string")).alias("question_content"),
        F.when(F.col("user_id") < 20, "def f()").otherwise("").alias("starter_code"), F.lit('[{"input":"a","output":"b"}]').alias("public_test_cases"),
        F.concat(F.lit('[{"input":"'), k, F.lit('","output":"z'), k, F.lit('"}]')).alias("private_test_cases"),
        F.when(F.col("event_type") == "view", '{"func_name":"go"}').otherwise("{}").alias("metadata"))
    return PR.contest_code(rows, "2024-01-03T00:00:00", "2024-01-20T00:00:00").select("event_id", "query", "cases")


@query("N9_task_union", _rl_sql("CASE lang WHEN 'en' THEN 'exam_en' WHEN 'fr' THEN 'exam_fr' ELSE 'quiz' END", _turns(("user", "source||'?'")), "Math", "rule", "n_chars::VARCHAR",
                                "'split':'test','index':doc_id", "documents WHERE lang IN ('en','fr','de')"))
def n9(spark, sf):
    d = read(spark, sf, "documents")

    def task(lang, name):
        return lambda: PR.question_rows(d.where(F.col("lang") == lang), name, "Math", "test", "doc_id",
                                        F.concat("source", F.lit("?")), F.col("n_chars").cast("string"))

    exam = lambda: task("en", "exam_en")().unionByName(task("fr", "exam_fr")())
    return _flat(PR.task_union({"exam": exam, "quiz": task("de", "quiz"), "unused": task("es", "other")}, ["exam", "quiz"]))


@query("N10_solved_math", "SELECT to_json([{'role':'user','content':'p'||event_id,'loss_mask':0},{'role':'assistant','content':'s'||k,'loss_mask':1}])::VARCHAR AS messages, "
       "to_json({'event_id':event_id,'problem_type':'has_answer_extracted'})::VARCHAR AS extra_info FROM " + _K + " WHERE event_type IN ('view','click')")
def n10(spark, sf):
    k = F.get_json_object("props", "$.k")
    rows = read(spark, sf, "events").select(
        "event_id", F.concat(F.lit("p"), F.col("event_id").cast("string")).alias("problem"), F.concat(F.lit("s"), k).alias("generated_solution"),
        F.when(F.col("event_type").isin("view", "click"), "has_answer_extracted").otherwise("no_answer").alias("problem_type"))
    return PR.solved_math(rows, ["event_id", "problem_type"]).select(F.to_json("messages").alias("messages"), F.to_json("extra_info").alias("extra_info"))


@query("N10_solved_math_evaluation", _rl_sql(
    "'olympiad'", _turns(("user", f"'p'||event_id||' '||{_BH}")), "math", "rule", "CASE event_type WHEN 'view' THEN k ELSE 'x \\boxed{'||k||'}' END",
    "'split':'test','index':event_id,'answer':CASE event_type WHEN 'view' THEN '\\boxed{'||k||'}' ELSE 'x \\boxed{'||k||'}' END,'question':'p'||event_id", _K))
def n10b(spark, sf):
    box = F.concat(F.lit("\\boxed{"), F.get_json_object("props", "$.k"), F.lit("}"))
    rows = read(spark, sf, "events").select(
        "event_id", F.concat(F.lit("p"), F.col("event_id").cast("string")).alias("problem"),
        F.when(F.col("event_type") == "view", box).otherwise(F.concat(F.lit("x "), box)).alias("solution"))
    return _flat(PR.solved_math_evaluation(rows, "olympiad", "event_id"))


@query("N11_collapse_rl", O.sql(
    "SELECT min(id) AS id, to_json([{'role':'system','content':" + O.lit(PR.SYSTEM) + "},{'role':'user','content':event_type||user_id}])::VARCHAR AS prompt, "
    "arg_min(CASE WHEN gt<>'' THEN gt WHEN st<>'' THEN st ELSE 'c'||id END, id) AS ground_truth, arg_min(score, id) AS score FROM "
    "(SELECT event_id id, event_type, user_id, value score, CASE WHEN value<10 THEN 'g'||event_id ELSE '' END gt, CASE WHEN value<30 THEN 's'||event_id ELSE '' END st FROM events) GROUP BY event_type, user_id"))
def n11(spark, sf):
    e = F.col("event_id").cast("string")
    rows = read(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.array(PR.turn("user", F.concat("event_type", F.col("user_id").cast("string")))).alias("prompt"),
        F.when(F.col("value") < 10, F.concat(F.lit("g"), e)).otherwise("").alias("ground_truth"),
        F.when(F.col("value") < 30, F.concat(F.lit("s"), e)).otherwise("").alias("single_turn_completion"),
        F.concat(F.lit("c"), e).alias("completion"), F.col("value").alias("score"))
    return PR.collapse_rl(rows, "id", ["score"]).select("id", F.to_json("prompt").alias("prompt"), "ground_truth", F.col("extra_info.score").alias("score"))


@query("N12_collapse_chat", "SELECT user_id AS conv_id, to_json([{'role':'system','content':" + O.lit(PR.SYSTEM) + "},{'role':'user','content':event_type},{'role':'assistant','content':event_id::VARCHAR}])::VARCHAR AS prompt "
       "FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY json_extract_string(props,'$.k')::INT DESC, value DESC) rn FROM events) WHERE rn=1")
def n12(spark, sf):
    rows = read(spark, sf, "events").select(
        F.col("user_id").alias("conv_id"), F.get_json_object("props", "$.k").cast("int").alias("turn_id"), F.col("value").alias("score"),
        F.array(PR.turn("user", F.col("event_type"))).alias("prompt"), F.col("event_id").cast("string").alias("completion"))
    return PR.collapse_chat(rows).select("conv_id", F.to_json("prompt").alias("prompt"))


@query("N13_tool_trace", O.sql(
    "SELECT id, md5('user:'||" + "regexp_replace(q,'^\\s+|\\s+$','','g')" + "||'|assistant:plan/print('||id||')|tool:out|assistant:'||CASE WHEN conv_id%2=0 THEN 'then/x=1' ELSE 'so '||"
    + "regexp_replace(a,'\\s+$','','g')" + " END||CASE WHEN conv_id%2=0 THEN '|tool:1|assistant:'||" + "regexp_replace('so '||a,'\\s+$','','g')" + " ELSE '' END) AS trace_md5, CASE WHEN conv_id%2=0 THEN 6 ELSE 4 END::INT AS turns FROM pr", **PAIR))
def n13(spark, sf):
    i = F.col("id").cast("string")
    q = F.concat(F.lit("sys *user question:* <answer>"), F.col("q"), F.lit("</answer>"))
    first = F.concat(F.lit("plan <code>x\n```python\nprint("), i, F.lit(")\n```</code> <interpreter> out </interpreter>"))
    more = F.when(F.floor(F.col("id") / 100) % 2 == 0, F.lit(" then <code>x=1</code><interpreter>1</interpreter>")).otherwise("")
    trace = PR.tool_trace(q, F.concat(first, more, F.lit(" so <answer>"), F.col("a"), F.lit("</answer>")))
    out = _qa(spark, sf).withColumn("t", trace)
    line = F.transform("t", lambda m: F.concat(m["role"], F.lit(":"), F.concat_ws("/", m["content"], m["code"])))
    return out.select("id", F.md5(F.array_join(line, "|")).alias("trace_md5"), F.size("t").alias("turns"))


@query("N14_multi_turn_tools", "SELECT 'chats' AS data_source, doc_id, false AS enable_thinking, part AS split, row_number() OVER (PARTITION BY part ORDER BY " + md5_order(8, "doc_id")
       + ")-1 AS index FROM (SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY " + md5_order(8, "doc_id") + ")<=floor(0.9::DOUBLE*count(*) OVER ()) THEN 'train' ELSE 'test' END part FROM documents)")
def n14(spark, sf):
    d = read(spark, sf, "documents").select("doc_id")
    out = PR.multi_turn_tools(d, "chats", ["doc_id"], 0.9, 8)
    return out.select("data_source", "doc_id", "enable_thinking", "extra_info.split", "extra_info.index")


# ---- monitoring -------------------------------------------------------------------------

_PK = dict(pack_ctes(True), us="SELECT shard, pack, place, source, take, n, i FROM fold JOIN tk USING (shard, r) WHERE (shard, pack) IN "
           "(SELECT (shard, pack) FROM fold JOIN tk USING (shard, r) GROUP BY shard, pack HAVING sum(take-(take=n)::INT)>0)",
           tt="SELECT source, unnest(i[1:take])%97/64.0::DOUBLE loss, (unnest(range(take))<>n-1)::INT m, unnest(i[1:take]) id FROM us")


def _loss_packs(spark, sf):
    p = packs_of(spark, sf, True)
    return p.withColumn("loss", F.transform("input_ids", lambda x: x % 97 / F.lit(64.0)))


@query("P1_source_loss", named_fold(O.sql("SELECT source, count(*) AS tokens, sum(m)::BIGINT AS valid_tokens, " + O.r6("sum(loss)/(count(*)+1e-6)") + " AS loss FROM tt GROUP BY 1", **_PK)))
def p1(spark, sf):
    return MO.source_loss(_loss_packs(spark, sf)).withColumn("loss", r6(F.col("loss")))


@query("P2_source_ratios", named_fold(O.sql(
    "SELECT source, samples, tokens, " + O.r6("samples/(sum(samples) OVER ())") + " AS sample_ratio, " + O.r6("tokens/(sum(tokens) OVER ())")
    + " AS token_ratio FROM (SELECT source, count(*) samples, sum(take)::BIGINT tokens FROM us GROUP BY 1)", **_PK)))
def p2(spark, sf):
    out = MO.source_ratios(packs_of(spark, sf, True))
    return out.withColumn("sample_ratio", r6(F.col("sample_ratio"))).withColumn("token_ratio", r6(F.col("token_ratio")))


@query("P3_token_kind_loss", named_fold(O.sql(
    "SELECT " + O.r6("sum((id<60000)::INT*loss)/(sum((id<60000)::INT)+1e-6)") + " AS itemic_loss, " + O.r6("sum((id>=60000)::INT*loss)/(sum((id>=60000)::INT)+1e-6)") + " AS text_loss FROM tt", **_PK)))
def p3(spark, sf):
    p = _loss_packs(spark, sf)
    ids = F.slice("input_ids", F.lit(1), F.col("tokens"))
    out = MO.token_kind_loss(p, F.slice("loss", F.lit(1), F.col("tokens")), K.itemic_mask(ids, 0, 59999))
    return out.select(*[r6(F.col(c)).alias(c) for c in out.columns])


_STEP = "SELECT event_id step, ts, value/100 loss, user_id+1 tokens, 1 samples, (user_id+1)//2 valid_tokens, value/700 secs FROM events"
_PER = ("count(*) AS steps, " + O.r6("avg(loss)") + " AS loss, sum(tokens)::BIGINT AS tokens, count(*) AS samples, sum(valid_tokens)::BIGINT AS valid_tokens, " + O.r6("sum(secs)")
        + " AS \"seconds\", " + O.r6("sum(secs)/count(*)") + " AS sec_per_step, " + O.r6("sum(tokens)/(sum(secs)*8)") + " AS tokens_per_sec, " + O.r6("count(*)/(sum(secs)*8)")
        + " AS samples_per_sec, " + O.r6("sum(valid_tokens)/sum(tokens)") + " AS valid_token_ratio")


def _steps(events):
    return events.select(F.col("event_id").alias("step"), F.col("ts").cast("timestamp").alias("ts"), (F.col("value") / 100).alias("loss"), (F.col("user_id") + 1).alias("tokens"), F.lit(1).alias("samples"),
                         F.floor((F.col("user_id") + 1) / 2).alias("valid_tokens"), (F.col("value") / 700).alias("seconds"))


def _rounded(df):
    types = dict(df.dtypes)
    return df.select(*[r6(F.col(c)).alias(c) if types[c] == "double" else F.col(c) for c in df.columns])


@query("P4_period_counters", f"SELECT step//100 AS period, {_PER} FROM ({_STEP}) GROUP BY 1")
def p4(spark, sf):
    return _rounded(MO.period_counters(_steps(read(spark, sf, "events")), 100, 8))


@query("P4_streaming_counters", f"SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS period_start, {_PER} FROM ({_STEP}) GROUP BY 1")
def p4b(spark, sf):
    """The same counters per hour from a stream over the event files, run to the end of what is there."""
    schema = read(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    table = scratch(spark, "periods")
    SC.start(_steps(stream), 8, table, scratch(spark, "stream")).awaitTermination()
    return _rounded(spark.read.parquet(table).withColumn("period_start", F.date_format("period_start", "yyyy-MM-dd HH:mm:ss")))
