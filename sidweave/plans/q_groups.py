"""Group statistic and roll-up queries (K*, L*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import r6
from ..operators import groupstats as G
from ..operators import rollups as L
from ..session import read
from . import oracle as O
from . import testbed as TB
from .catalog import query

_SC = dict(sc="SELECT row_id, uid, any_value(len) len, sum(r) score, sum(m)::BIGINT mlen, sum(r*m) mr FROM tok GROUP BY 1,2",
           gs="SELECT uid, avg(score) mean, stddev_samp(score) std, count(*) n, sum(mlen*score)/sum(mlen) lw FROM sc GROUP BY 1")


def _tokens(df, **cols):
    """Token arrays to one row per token."""
    z = F.arrays_zip(*[F.col(v).alias(k) for k, v in cols.items()])
    out = df.select("row_id", F.posexplode(z).alias("pos", "x"))
    return out.select("row_id", F.col("pos").cast("bigint").alias("pos"), *[r6(F.col(f"x.{k}")).alias(k) for k in cols])


def _adv(df):
    return df.select("row_id", r6(F.col("advantage")).alias("advantage"))


@query("K1_group_normalised", O.sql("SELECT row_id, " + O.r6("CASE WHEN n=1 THEN score/(1+1e-6) ELSE (score-mean)/(std+1e-6) END")
                                    + " AS advantage FROM sc JOIN gs USING (uid)", **_SC))
def k1(spark, sf):
    return _adv(G.group_normalised(TB.rollouts(spark, sf)))


@query("K2_best_versus_second", O.sql(
    "SELECT row_id, CASE WHEN k=1 THEN " + O.r6("(score-snd)/(std+1e-6)") + " ELSE 0.0::DOUBLE END AS advantage FROM "
    "(SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, row_id) k, lead(score) OVER (PARTITION BY uid ORDER BY score DESC, row_id) snd FROM sc) "
    "JOIN gs USING (uid)", **_SC))
def k2(spark, sf):
    return _adv(G.best_versus_second(TB.rollouts(spark, sf)))


def _white(x):
    """Whitened value of column x of CTE w(row_id, pos, m, x)."""
    return dict(st="SELECT avg(x) mu, var_samp(x) va FROM w WHERE m=1"), f"({x}-mu)/sqrt(va+1e-8)"


@query("K3_mean_baseline_whitened", O.sql(
    "SELECT row_id, pos, " + O.r6("(x-avg(x) FILTER (WHERE m=1) OVER ())/sqrt(var_samp(x) FILTER (WHERE m=1) OVER ()+1e-8)*m") + " AS advantage FROM w3",
    s3="SELECT row_id, uid, len, mask, list_sum(token_rewards) score FROM rollouts",
    b3="SELECT *, CASE WHEN count(*) OVER (PARTITION BY uid)=1 THEN 0 ELSE avg(score) OVER (PARTITION BY uid) END base FROM s3",
    w3="SELECT row_id, pos, m, (score-base)*m x FROM (SELECT row_id, score, base, unnest(range(len)) pos, unnest(mask) m FROM b3)"))
def k3(spark, sf):
    return _tokens(G.mean_baseline_whitened(TB.rollouts(spark, sf)), advantage="advantages")


@query("K4_leave_one_out", O.sql("SELECT row_id, " + O.r6("CASE WHEN n=1 THEN score ELSE (score-mean)*n/(n-1) END")
                                 + " AS advantage FROM sc JOIN gs USING (uid)", **_SC))
def k4(spark, sf):
    return _adv(G.leave_one_out(TB.rollouts(spark, sf)))


@query("K5_length_weighted", O.sql("SELECT row_id, " + O.r6("score-CASE WHEN n=1 THEN 0 ELSE lw END")
                                   + " AS advantage FROM sc JOIN gs USING (uid)", **_SC))
def k5(spark, sf):
    return _adv(G.length_weighted(TB.rollouts(spark, sf)))


@query("K6_batch_scaled", O.sql("SELECT row_id, " + O.r6("al*(score-CASE WHEN n=1 THEN 0 ELSE mean END)") + " AS advantage FROM sc JOIN gs "
                                "USING (uid) CROSS JOIN (SELECT count(*)/greatest(sum((score<>0)::INT),1)::DOUBLE al FROM sc)", **_SC))
def k6(spark, sf):
    return _adv(G.batch_scaled(TB.rollouts(spark, sf)))


_RUN = ("SELECT row_id, pos, r::DOUBLE run, m FROM tok WHERE pos=len-1 UNION ALL SELECT t.row_id, t.pos, t.r+0.9::DOUBLE*w0.run*w0.m, t.m "
        "FROM w0 JOIN tok t ON t.row_id=w0.row_id AND t.pos=w0.pos-1")


@query("K7_discounted_return", O.sql(
    "SELECT row_id, pos, " + O.r6("x") + " AS return, " + O.r6("(x-mu)/sqrt(va+1e-8)*m") + " AS advantage FROM w CROSS JOIN st",
    w0=_RUN, w="SELECT row_id, pos, run x, m FROM w0", **_white("x")[0]))
def k7(spark, sf):
    return _tokens(G.discounted_whitened(TB.rollouts(spark, sf), 0.9), **{"return": "returns", "advantage": "advantages"})


@query("K8_return_minus_baseline", O.sql(
    "SELECT row_id, pos, " + O.r6("sum(r*m) OVER (PARTITION BY row_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)-m*score/100")
    + " AS advantage FROM tok"))
def k8(spark, sf):
    return _tokens(G.return_minus_baseline(TB.rollouts(spark, sf), F.col("score") / 100), advantage="advantages")


_GAE = ("SELECT row_id, pos, m, v, CASE WHEN m=1 THEN r-v ELSE 0 END::DOUBLE la, CASE WHEN m=1 THEN v ELSE 0 END::DOUBLE nx FROM tok WHERE pos=len-1 "
        "UNION ALL SELECT t.row_id, t.pos, t.m, t.v, CASE WHEN t.m=1 THEN t.r+0.99::DOUBLE*ga.nx-t.v+0.99::DOUBLE*0.95::DOUBLE*ga.la ELSE ga.la END, "
        "CASE WHEN t.m=1 THEN t.v ELSE ga.nx END FROM ga JOIN tok t ON t.row_id=ga.row_id AND t.pos=ga.pos-1")


@query("K9_advantage_estimate", O.sql(
    "SELECT row_id, pos, " + O.r6("x+v") + " AS return, " + O.r6("(x-mu)/sqrt(va+1e-8)") + " AS advantage FROM w CROSS JOIN st",
    ga=_GAE, w="SELECT row_id, pos, la x, m, v FROM ga", **_white("x")[0]))
def k9(spark, sf):
    return _tokens(G.gae_whitened(TB.rollouts(spark, sf), 0.99, 0.95), **{"return": "returns", "advantage": "advantages"})


@query("K10_varied_groups", O.sql(
    "SELECT row_id, uid, f AS score FROM (SELECT *, least(score,20) f FROM rollouts) JOIN (SELECT uid FROM (SELECT uid, least(score,20) f FROM rollouts) "
    "GROUP BY uid HAVING stddev_pop(f)>0 OR count(*)=1) USING (uid) ORDER BY row_id LIMIT 800"))
def k10(spark, sf):
    r = TB.rollouts(spark, sf).select("row_id", "uid", F.least("score", F.lit(20.0)).alias("score"))
    return G.varied_groups(r, 100, 8)


_KL = {"k1": "o-f", "abs": "abs(o-f)", "k2": "0.5::DOUBLE*(o-f)*(o-f)",
       "k3": "greatest(least(exp(greatest(least(f-o,20),-20))-greatest(least(f-o,20),-20)-1,10),-10)"}


@query("K11_divergence_kinds", O.sql("SELECT row_id, pos, " + ", ".join(f"{O.r6(v)} AS {k}" for k, v in _KL.items()) + " FROM tok"))
def k11(spark, sf):
    r = TB.rollouts(spark, sf)
    for k in _KL:
        r = r.withColumn(k, G.kl(F.col("old_lp"), F.col("ref_lp"), k))
    return _tokens(r, **{k: k for k in _KL})


@query("K12_penalised_reward", O.sql(
    "SELECT row_id, pos, " + O.r6("r-(o-f)*m/7") + " AS penalised, " + O.r6("sum((o-f)*m) OVER (PARTITION BY row_id)/(sum(m) OVER (PARTITION BY row_id)+1e-8)")
    + " AS row_kl FROM tok"))
def k12(spark, sf):
    s = G.penalised(TB.rollouts(spark, sf), 1 / 7)
    s = s.withColumn("row_kls", F.transform("penalised", lambda x: F.col("row_kl")))
    return _tokens(s, penalised="penalised", row_kl="row_kls")


@query("K13_adaptive_coefficient", "SELECT event_type, event_id, " + O.r6(
    "0.1::DOUBLE*exp(sum(ln(1+greatest(least(value/100/0.5::DOUBLE-1,0.2),-0.2)*8/10000.0::DOUBLE)) OVER (PARTITION BY event_type ORDER BY event_id))")
       + " AS beta FROM events")
def k13(spark, sf):
    s = read(spark, sf, "events").select("event_type", "event_id", (F.col("value") / 100).alias("kl"), F.lit(8).alias("n_steps"))
    return G.adaptive_beta(s, ["event_type"], "event_id", 0.1, 0.5, 10000.0).select("event_type", "event_id", r6(F.col("beta")).alias("beta"))


@query("K14_loss_aggregation", O.sql(
    "SELECT " + O.r6("sum(t)/(sum(n)+1e-8)") + " AS token_mean, " + O.r6("avg(t)") + " AS seq_mean_token_sum, " + O.r6("avg(t/n)")
    + " AS seq_mean_token_mean, " + O.r6("sum(t)/max(w)") + " AS seq_mean_token_sum_norm FROM (SELECT sum(v*m) t, sum(m) n, count(*) w FROM tok GROUP BY row_id)"))
def k14(spark, sf):
    out = G.aggregate_loss(TB.rollouts(spark, sf), "token_values")
    return out.select(*[r6(F.col(c)).alias(c) for c in out.columns])


@query("K15_distillation_advantage", O.sql("SELECT row_id, pos, " + O.r6("f-o") + " AS advantage FROM tok"))
def k15(spark, sf):
    return _tokens(G.distillation_advantage(TB.rollouts(spark, sf)), advantage="advantages")


_UP, _VETO = 1.1, 0.8
_LEVELS = {"token": ("truncate", None), "sequence": ("mask", _VETO), "geometric": ("mask", None)}


def _is_ctes(level, veto):
    per = {"token": "o-ro", "sequence": "sum((o-ro)*m) OVER p", "geometric": "sum((o-ro)*m) OVER p/(sum(m) OVER p+1e-8)"}[level]
    cut = "0" if veto is None else f"max((o-ro<ln({veto}::DOUBLE) AND m=1)::INT) OVER p"
    cat = "0" if veto is None else f"(o-ro<ln({veto}::DOUBLE) AND m=1)::INT"
    return dict(
        lg=f"SELECT row_id, pos, m, {per} lr, {cut} dead, {cat} cat FROM tok WINDOW p AS (PARTITION BY row_id)",
        iw=f"SELECT *, exp(greatest(least(lr,20),-20)) w, exp(greatest(least(lr,20),-20)) BETWEEN {1/_UP}::DOUBLE AND {_UP}::DOUBLE inside FROM lg")


def _is_queries(level, mode, veto):
    weight = f"least(w,{_UP}::DOUBLE)*m" if mode == "truncate" else "w*m"
    kept = "m*(1-dead)" if mode == "truncate" else "m*inside::INT*(1-dead)"

    def weights(spark, sf):
        s = G.importance_weights(TB.rollouts(spark, sf), level, _UP, None, mode, veto)
        return _tokens(s, weight="weights", kept="kept_mask")

    query(f"K16_{level}_weights", O.sql(f"SELECT row_id, pos, {O.r6(weight)} AS weight, {O.r6(kept)} AS kept FROM iw", **_is_ctes(level, veto)))(weights)

    def diagnostics(spark, sf):
        s = G.importance_weights(TB.rollouts(spark, sf), level, _UP, None, mode, veto)
        d = G.weight_diagnostics(s, level, _UP, None, mode)
        return d.select(*[r6(F.col(c)).alias(c) for c in d.columns])

    lo = f"{1/_UP}::DOUBLE"
    up = f"{_UP}::DOUBLE"
    n = "(sum(m)+1e-8)"
    tok = {
        "mean": f"sum(w*m)/{n}", "catastrophic_token_fraction": f"sum(cat*m)/{n}",
        "std": f"sqrt(greatest(sum(cl*cl*m)/{n}-(sum(cl*m)/{n})**2,0))",
        "eff_sample_size": f"(sum(cl*m)/{n}+1e-8)**2/(sum(cl*cl*m)/{n})",
    }
    if level == "sequence":
        tok["max"], tok["min"] = "exp(least(max(lr),20))", "exp(min(lr))"
    else:
        tok["max"] = "max(CASE WHEN m=1 THEN w END)" if level == "token" else "exp(least(max(lr),20))"
        tok["min"] = "min(CASE WHEN m=1 THEN w END)" if level == "token" else "exp(min(lr))"
        x, hi, low = ("w", up, lo) if level == "token" else ("lr", f"ln({up})", f"ln({lo})")
        tok["ratio_fraction_high"] = f"sum(({x}>{hi})::INT*m)/{n}"
        tok["ratio_fraction_low"] = f"sum(({x}<{low})::INT*m)/{n}"
    seq = {
        "veto_fraction": "avg(dead)", "seq_mean": "avg(s)", "seq_std": "stddev_samp(s)", "seq_max": "max(s)", "seq_min": "min(s)",
        "seq_max_deviation": "max(abs(s-1))", "seq_fraction_high": f"avg((s>{up})::INT)", "seq_fraction_low": f"avg((s<{lo})::INT)",
    }
    if level == "sequence":
        seq["ratio_fraction_high"], seq["ratio_fraction_low"] = f"avg((lr>ln({up}))::INT)", f"avg((lr<ln({lo}))::INT)"
    if mode == "mask":
        tok["masked_fraction"] = f"sum((NOT inside)::INT*m)/{n}"
        seq["seq_masked_fraction"] = "avg(out)"
    sql = O.sql("SELECT " + ", ".join(f"{O.r6(k)} AS {k}" for k in [*tok, *seq]) + " FROM (SELECT "
                + ", ".join(f"{v} {k}" for k, v in tok.items()) + " FROM cw) CROSS JOIN (SELECT " + ", ".join(f"{v} {k}" for k, v in seq.items())
                + " FROM sw)", **_is_ctes(level, veto), cw=f"SELECT *, greatest(least(w,{up}),{lo}) cl FROM iw",
                sw="SELECT row_id, sum(w*m)/(sum(m)+1e-8) s, max(dead) dead, max(lr) lr, max((NOT inside AND m=1)::INT) out FROM iw GROUP BY 1")
    query(f"K17_{level}_diagnostics", sql)(diagnostics)


for _level, (_mode, _veto) in _LEVELS.items():
    _is_queries(_level, _mode, _veto)


@query("K18_policy_mismatch", O.sql(
    "SELECT " + ", ".join(f"{O.r6(v)} AS {k}" for k, v in {
        "training_ppl": "avg(exp(-a))", "training_log_ppl": "avg(-a)", "rollout_ppl": "avg(exp(-b))", "rollout_log_ppl": "avg(-b)",
        "log_ppl_diff": "avg(b-a)", "log_ppl_abs_diff": "avg(abs(b-a))", "log_ppl_diff_max": "max(b-a)", "log_ppl_diff_min": "min(b-a)",
        "ppl_ratio": "avg(exp(b-a))", "kl": "any_value(kl)", "k3_kl": "any_value(k3)"}.items())
    + " FROM (SELECT sum(o*m)/(sum(m)+1e-8) a, sum(ro*m)/(sum(m)+1e-8) b FROM tok GROUP BY row_id) CROSS JOIN "
    "(SELECT sum((ro-o)*m)/(sum(m)+1e-8) kl, sum((exp(o-ro)-(o-ro)-1)*m)/(sum(m)+1e-8) k3 FROM tok)"))
def k18(spark, sf):
    d = G.mismatch_metrics(TB.rollouts(spark, sf))
    return d.select(*[r6(F.col(c)).alias(c) for c in d.columns])


def _judged(spark, sf):
    r = TB.rollouts(spark, sf).select("row_id", "uid", F.floor("score").alias("score"))
    return r.withColumn("acc", (F.col("row_id") % 3) / 2.0)


_JD = dict(jd="SELECT row_id, uid, floor(score) score, (row_id%3)/2.0::DOUBLE acc FROM rollouts")


@query("K19_ranking_accuracy", O.sql(
    "SELECT uid, CASE WHEN sum(abs(a.acc-b.acc))=0 THEN 0.5::DOUBLE ELSE " + O.r6(
        "sum(CASE WHEN (a.score>b.score)=(a.acc>b.acc) THEN abs(a.acc-b.acc) ELSE 0 END)/sum(abs(a.acc-b.acc))")
    + " END AS accuracy FROM jd a JOIN jd b USING (uid) WHERE a.row_id<b.row_id GROUP BY uid", **_JD))
def k19(spark, sf):
    return G.ranking_accuracy(_judged(spark, sf)).withColumn("accuracy", r6(F.col("accuracy")))


@query("K19_mean_ranking_accuracy", O.sql(
    "SELECT " + O.r6("avg(accuracy)") + " AS accuracy FROM (SELECT uid, CASE WHEN sum(abs(a.acc-b.acc))=0 THEN 0.5::DOUBLE ELSE "
    "sum(CASE WHEN (a.score>b.score)=(a.acc>b.acc) THEN abs(a.acc-b.acc) ELSE 0 END)/sum(abs(a.acc-b.acc)) END AS accuracy "
    "FROM jd a JOIN jd b USING (uid) WHERE a.row_id<b.row_id GROUP BY uid)", **_JD))
def k19b(spark, sf):
    return G.mean_ranking_accuracy(_judged(spark, sf)).withColumn("accuracy", r6(F.col("accuracy")))


@query("K20_sign_accuracy", O.sql("SELECT " + O.r6("avg((sign(score-20)=sign(acc*2-1))::INT)") + " AS accuracy FROM jd", **_JD))
def k20(spark, sf):
    s = G.sign_accuracy(_judged(spark, sf).withColumn("score", F.col("score") - 20))
    return s.select(r6(F.col("accuracy")).alias("accuracy"))


_K21 = dict(
    ro2="SELECT row_id, any_value(uid) uid, sum(r*m)/sum(m) mr, any_value(row_id%2) acc FROM tok GROUP BY row_id",
    g2="SELECT uid, count(*) n, sum(mr) st, sum(acc) sa FROM ro2 GROUP BY 1",
    fr="SELECT t.row_id, t.pos, t.m, CASE WHEN t.m=1 THEN (r*n/(n-1)-st/(n-1))*0.318309886183790::DOUBLE ELSE 0 END + CASE WHEN pos=len-1 THEN "
       "(acc*n/(n-1)-sa/(n-1))*0.271828182845904::DOUBLE ELSE 0 END tot FROM tok t JOIN ro2 USING (row_id) JOIN g2 ON g2.uid=ro2.uid",
    w="SELECT row_id, pos, m, sum(tot*m) OVER (PARTITION BY row_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) x FROM fr")


@query("K21_multi_source_leave_one_out", O.sql(
    "SELECT row_id, pos, " + O.r6("x") + " AS return, " + O.r6("(x-mu)/sqrt(va+1e-8)") + " AS advantage FROM w CROSS JOIN st", **_K21, **_white("x")[0]))
def k21(spark, sf):
    r = TB.rollouts(spark, sf).withColumn("acc", F.col("row_id") % 2)
    out = G.multi_source_leave_one_out(r, "acc", 0.318309886183790, 0.271828182845904)
    return _tokens(out, **{"return": "returns", "advantage": "advantages"})


def _three(n, x):
    return {f"{n}_mean": f"avg({x})", f"{n}_max": f"max({x})", f"{n}_min": f"min({x})"}


_SEQ = {**_three("score", "score"), **_three("reward", "reward"), **_three("response_length", "ml"), "response_clip_ratio": "avg((ml=7)::INT)",
        **_three("prompt_length", "pl"), "prompt_clip_ratio": "avg((pl=9)::INT)", **_three("turns", "tu")}
_TOK = {**_three("advantage", "f"), **_three("return", "o"), **_three("value", "v"),
        "explained_variance": "1-var_samp(o-v)/(var_samp(o)+1e-5)"}


@query("K22_rollout_summary", O.sql(
    "SELECT " + ", ".join(f"{O.r6(k)} AS {k}" for k in [*_SEQ, *_TOK]) + " FROM (SELECT " + ", ".join(f"{v} {k}" for k, v in _SEQ.items())
    + " FROM (SELECT row_id, any_value(score) score, sum(r) reward, sum(m) ml, any_value(step) pl, any_value(row_id%4) tu FROM tok GROUP BY 1)) CROSS JOIN (SELECT "
    + ", ".join(f"{v} {k}" for k, v in _TOK.items()) + " FROM tok WHERE m=1)"))
def k22(spark, sf):
    r = TB.rollouts(spark, sf).select(
        "score", G.array_sum(F.col("token_rewards")).alias("reward"), F.aggregate("mask", F.lit(0), lambda a, m: a + m).alias("response_length"),
        F.col("step").alias("prompt_length"), (F.col("row_id") % 4).alias("turns"), F.col("ref_lp").alias("advantages"),
        F.col("old_lp").alias("returns"), "token_values", "mask")
    d = G.rollout_summary(r, 7, 9)
    return d.select(*[r6(F.col(c)).alias(c) for c in d.columns])


_PH = "CASE event_type WHEN 'view' THEN 'gen' WHEN 'click' THEN 'ref' WHEN 'purchase' THEN 'step' WHEN 'error' THEN 'adv' ELSE 'other' END"


@query("K23_throughput", O.sql(
    f"SELECT phase, {O.r6('s')} AS seconds, {O.r6('''s*1000/CASE WHEN phase='gen' THEN rt WHEN phase IN ('ref','adv') THEN rt+pt END''')} AS ms_per_token, "
    f"CASE WHEN phase='step' THEN {O.r6('(rt+pt)/(s*8)')} END AS throughput FROM (SELECT {_PH} phase, round(sum(value),2) s FROM events GROUP BY 1) "
    "CROSS JOIN (SELECT sum(len) rt, sum(step) pt FROM rollouts)"))
def k23(spark, sf):
    phase = F.expr(_PH)
    timings = read(spark, sf, "events").groupBy(phase.alias("phase")).agg(F.round(F.sum("value"), 2).alias("seconds"))
    rows = TB.rollouts(spark, sf).select(F.col("len").alias("response_length"), F.col("step").alias("prompt_length"))
    t = G.throughput(rows, timings, 8)
    return t.select("phase", *[r6(F.col(c)).alias(c) for c in ("seconds", "ms_per_token", "throughput")])


_MET = "event_type||'/'||(['max','min','mean'])[(user_id%3)::INT+1]"


@query("K24_reduce_metrics", f"SELECT metric, {O.r6('CASE WHEN contains(metric,$max$) THEN max(value) WHEN contains(metric,$min$) THEN min(value) ELSE avg(value) END')} "
       .replace("$max$", "'max'").replace("$min$", "'min'") + f"AS value FROM (SELECT {_MET} metric, value FROM events) GROUP BY 1")
def k24(spark, sf):
    name = F.concat("event_type", F.lit("/"), F.get(F.array(F.lit("max"), F.lit("min"), F.lit("mean")), (F.col("user_id") % 3).cast("int")))
    out = G.reduce_metrics(read(spark, sf, "events").select(name.alias("metric"), "value"))
    return out.select("metric", r6(F.col("value")).alias("value"))


@query("K25_probability_gap", O.sql(
    "SELECT " + O.r6("max(abs(exp(o)-exp(ro)))") + " AS diff_max, " + O.r6("avg(abs(exp(o)-exp(ro)))") + " AS diff_mean, "
    + O.r6("stddev_samp(abs(exp(o)-exp(ro)))") + " AS diff_std, " + O.r6("corr(exp(o),exp(ro))") + " AS pearson FROM tok WHERE m=1"))
def k25(spark, sf):
    d = G.probability_gap(TB.rollouts(spark, sf))
    return d.select(*[r6(F.col(c)).alias(c) for c in d.columns])


@query("K25_token_differences", O.sql("SELECT row_id, sum((m=1 AND floor(o*8)<>floor(ro*8))::INT)::INT AS differing FROM tok GROUP BY 1"))
def k25b(spark, sf):
    ids = [F.transform(c, lambda x: F.floor(x * 8)) for c in ("old_lp", "rollout_lp")]
    return TB.rollouts(spark, sf).select("row_id", G.token_differences(*ids, F.col("mask")).alias("differing"))


@query("K26_group_index", O.sql(
    "SELECT row_id, d.g AS by_source, uid AS by_user FROM rollouts JOIN (SELECT data_source, row_number() OVER (ORDER BY data_source)-1 g FROM "
    "(SELECT DISTINCT data_source FROM rollouts)) d USING (data_source)"))
def k26(spark, sf):
    r = TB.rollouts(spark, sf).select("row_id", "uid", "data_source")
    by_source = G.group_index(r, "data_source").withColumnRenamed("gidx", "by_source")
    return G.group_index(by_source, "uid").select("row_id", "by_source", F.col("gidx").alias("by_user"))


@query("K26_floored_stats", O.sql(
    "SELECT uid, CASE WHEN count(*)=1 THEN 0.0 ELSE " + O.r6("avg(s)") + " END AS mean, CASE WHEN count(*)=1 THEN 1.0 ELSE "
    + O.r6("sqrt(greatest(var_samp(s),1e-6))") + " END AS std, count(*) AS n FROM (SELECT uid, CASE WHEN uid%2=0 THEN 1.0::DOUBLE ELSE score END s FROM rollouts) GROUP BY 1"))
def k26b(spark, sf):
    r = TB.rollouts(spark, sf).withColumn("s", F.when(F.col("uid") % 2 == 0, 1.0).otherwise(F.col("score")))
    return G.floored_group_stats(r, "uid", "s").select("uid", r6(F.col("mean")).alias("mean"), r6(F.col("std")).alias("std"), "n")


# ---- validation -------------------------------------------------------------------------

_L1 = ("SELECT data_source, uid, variable, count(*) n, avg(value) mean, stddev_pop(value) std FROM (SELECT data_source, uid, "
       "unnest(['score','len']) variable, unnest([score, len::DOUBLE]) AS value FROM rollouts) GROUP BY ALL")


@query("L1_prompt_statistics", O.sql(f"SELECT data_source, uid, variable, n, {O.r6('mean')} AS mean, {O.r6('std')} AS std FROM ({_L1})"))
def l1(spark, sf):
    s = L.prompt_statistics(TB.rollouts(spark, sf), ["score", "len", "pred"])
    return s.select("data_source", "uid", "variable", "n", r6(F.col("mean")).alias("mean"), r6(F.col("std")).alias("std"))


_KSZ = ("SELECT data_source, uid, n, unnest(list_append([p FOR p IN [2,4,8,16,32,64,128,256,512,1024,2048,4096,8192,16384] IF p<n], n)) k "
        "FROM (SELECT data_source, uid, count(*) n FROM rollouts GROUP BY 1,2) WHERE n>1")


@query("L2_best_worst", O.sql(
    "SELECT data_source, uid, k, " + O.r6("b1") + " AS best_mean, " + O.r6("sqrt(greatest(b2-b1*b1,0))") + " AS best_std, "
    + O.r6("w1") + " AS worst_mean, " + O.r6("sqrt(greatest(w2-w1*w1,0))") + " AS worst_std FROM (SELECT data_source, uid, k, "
    "sum(x*(pow(i/n,k)-pow((i-1)/n,k))) b1, sum(x*x*(pow(i/n,k)-pow((i-1)/n,k))) b2, sum(x*(pow(1-(i-1)/n,k)-pow(1-i/n,k))) w1, "
    "sum(x*x*(pow(1-(i-1)/n,k)-pow(1-i/n,k))) w2 FROM (SELECT data_source, uid, score/7 x, (row_number() OVER (PARTITION BY data_source, uid "
    "ORDER BY score))::DOUBLE i FROM rollouts) JOIN ks USING (data_source, uid) GROUP BY 1,2,3)", ks=_KSZ))
def l2(spark, sf):
    b = L.best_worst(TB.rollouts(spark, sf).withColumn("score", F.col("score") / 7), ["data_source", "uid"], "score")
    return b.select("data_source", "uid", "k", *[r6(F.col(c)).alias(c) for c in b.columns if c not in ("data_source", "uid", "k")])


_MV = ("SELECT data_source, uid, pred, count(*) c, min(row_id) f, arg_min(score, row_id) v FROM rollouts GROUP BY ALL")


@query("L3_majority_value", O.sql(f"SELECT data_source, uid, arg_max(v, (c,-f)) AS majority FROM ({_MV}) GROUP BY 1,2"))
def l3(spark, sf):
    return L.majority_value(TB.rollouts(spark, sf), ["data_source", "uid"], "pred", "score", "row_id")


_H = O.h("17", "data_source", "uid", "k", "trial")


@query("L4_majority_bootstrap", O.sql(
    "SELECT data_source, uid, k, " + O.r6("avg(v)") + " AS maj_mean, " + O.r6("stddev_pop(v)") + " AS maj_std FROM (SELECT data_source, uid, k, trial, "
    "arg_max(v, (c,-f)) v FROM (SELECT d.data_source, d.uid, k, trial, pred, count(*) c, min(j) f, arg_min(score, j) v FROM dr d JOIN nu n ON "
    "n.data_source=d.data_source AND n.uid=d.uid AND n.place=d.pick GROUP BY ALL) GROUP BY 1,2,3,4) GROUP BY 1,2,3",
    ks=_KSZ, nu="SELECT data_source, uid, pred, score, row_number() OVER (PARTITION BY data_source, uid ORDER BY row_id) place FROM rollouts",
    tr=f"SELECT *, {_H} h FROM (SELECT data_source, uid, n, k, unnest(range(1000)) trial FROM ks)",
    dr="SELECT *, (h*(2*j+1)+j*j*40503)%2147483647%n+1 pick FROM (SELECT *, unnest(range(1,k+1)) j FROM tr)"))
def l4(spark, sf):
    b = L.majority_bootstrap(TB.rollouts(spark, sf), ["data_source", "uid"], "pred", "score", "row_id", 17)
    return b.select("data_source", "uid", "k", r6(F.col("maj_mean")).alias("maj_mean"), r6(F.col("maj_std")).alias("maj_std"))


_L5 = (f"SELECT data_source, variable, n, metric, avg(value) AS value FROM (SELECT data_source, variable, n, unnest(['mean','std']) metric, "
       f"unnest([mean,std]) AS value FROM ({_L1})) GROUP BY ALL")


def _l5(spark, sf):
    return L.over_prompts(L.prompt_statistics(TB.rollouts(spark, sf), ["score", "len"]), ["mean", "std"])


@query("L5_over_prompts", O.sql(f"SELECT data_source, variable, n, metric, {O.r6('value')} AS value FROM ({_L5})"))
def l5(spark, sf):
    return _l5(spark, sf).withColumn("value", r6(F.col("value")))


@query("L6_core_labels", O.sql(
    f"SELECT data_source, variable, n, metric, {O.r6('value')} AS value, CASE WHEN variable='score' AND metric='mean' AND n=max(n) OVER "
    f"(PARTITION BY data_source, variable) THEN 'val-core' ELSE 'val-aux' END AS section FROM ({_L5})"))
def l6(spark, sf):
    return L.core_labels(_l5(spark, sf), core="acc", fallback="score").withColumn("value", r6(F.col("value")))


@query("L7_repeated_prompts", "SELECT text AS prompt, count(*) AS n FROM conversations GROUP BY 1 HAVING count(*)>1 UNION ALL "
       "SELECT role, count(*) FROM conversations GROUP BY 1 HAVING count(*)>1")
def l7(spark, sf):
    c = read(spark, sf, "conversations")
    texts = L.repeated_prompts(c.select(F.col("text").alias("prompt")), "prompt")
    return texts.unionByName(L.repeated_prompts(c.select(F.col("role").alias("prompt")), "prompt"))


@query("L7_length_summary", "SELECT " + O.r6("avg(length(text))") + " AS length_mean, max(length(text))::INT AS length_max, min(length(text))::INT AS length_min, "
       + O.r6("avg(turn)") + " AS turns_mean, max(turn) AS turns_max, min(turn) AS turns_min FROM conversations")
def l7b(spark, sf):
    s = L.length_summary(read(spark, sf, "conversations").withColumn("length", F.length("text")), "length", "turn")
    return s.withColumn("length_mean", r6(F.col("length_mean"))).withColumn("turns_mean", r6(F.col("turns_mean")))


@query("L8_best_truth_reward", O.sql(
    "SELECT uid, " + O.r6("max(t)") + " AS reward, count(*) AS probes FROM (SELECT row_id, any_value(uid) uid, avg(o) t FROM tok WHERE pos>=len-(2+row_id%3) GROUP BY 1) GROUP BY 1"))
def l8(spark, sf):
    r = TB.rollouts(spark, sf).withColumn("truth_len", (2 + F.col("row_id") % 3).cast("int"))
    return L.best_truth_reward(r, "uid", "old_lp", "truth_len").withColumn("reward", r6(F.col("reward")))
