"""DuckDB twins of the derived tables, as named common table expressions."""

from __future__ import annotations

import re

from ..operators import templates as T
from ..operators.builders import SEED

EVENTS = list(T.EVENT_NAMES)
SID = "'<|sid_begin|><s_a_'||{0}||'><s_b_'||{1}||'><s_c_'||{2}||'><|sid_end|>'"


def h(*parts: str) -> str:
    """SQL twin of functions.common.hash_int; parts are SQL expressions."""
    text = "concat_ws('|'," + ",".join(f"({p})::VARCHAR" for p in parts) + ")"
    return f"('0x'||substr(md5({text}),1,8))::BIGINT"


def uuid(task: str, *keys: str) -> str:
    text = "md5(concat_ws('|','" + task + "'," + ",".join(f"({k})::VARCHAR" for k in keys) + "))"
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return "concat_ws('-'," + ",".join(f"substr({text},{a},{n})" for a, n in cuts) + ")"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def fill(options: list[str], values: dict[str, str], *key: str) -> str:
    def filled(option: str) -> str:
        pieces = [p for p in re.split(r"(\{\w+\})", option) if p]
        return "||".join(f"({values[p[1:-1]]})" if p[1:-1] in values else lit(p) for p in pieces)

    arms = " ".join(f"WHEN {i} THEN {filled(o)}" for i, o in enumerate(options))
    return f"(CASE {h(*key)} % {len(options)} {arms} END)"


def chat(query: str, answer: str, system: str | None = None) -> str:
    def msg(role, text):
        return f"{{'role':'{role}','content':[{{'type':'text','text':{text}}}]}}"
    first = "" if system is None else msg("system", system) + ","
    return f"to_json([{first}{msg('user', query)},{msg('assistant', answer)}])::VARCHAR"


def segments(text: str) -> str:
    return f"to_json([{{'type':'text','text':{text}}}])::VARCHAR"


def meta(**cols: str) -> str:
    return "to_json({" + ",".join(f"'{k}':{v}" for k, v in cols.items()) + "})::VARCHAR"


def r6(x: str) -> str:
    return f"(round(({x})::DOUBLE,6)+0.0)"


def tail(arr: str, n: int) -> str:
    return f"{arr}[greatest(len({arr})-{n},0)+1:]"


def head(arr: str, n: int) -> str:
    return f"{arr}[1:{n}]"


def _arr(side: str, expr: str, cond: str = "true") -> str:
    rk = "rk>12" if side == "h" else "rk<=12"
    return f"coalesce(list({expr} ORDER BY rk DESC) FILTER (WHERE {rk} AND {cond}), [])"


def _tok(a: int, b: int, s: float) -> str:
    return f"[((event_id*{a}+i*{b})%97)::DOUBLE/64-{s} FOR i IN range(len)]"


_SPELL = """CASE (uid+rk*3)%5
 WHEN 0 THEN '<think>likes item '||gp||' a lot</think>'||chr(10)||coalesce(gs,'nothing')
 WHEN 1 THEN coalesce(gs,'nothing')
 WHEN 2 THEN 'try '||coalesce(gs,'nothing')
 WHEN 3 THEN replace(coalesce(gs,'nothing'),'<|sid_end|>','')
 ELSE CASE WHEN rk=9 THEN '  ' ELSE coalesce(gs,'nothing')||' '||coalesce(gs,'nothing') END END"""

CTES: dict[str, str] = {
    "inter": """SELECT o_custkey uid, rk, l_partkey pid, l_suppkey ad_pid,
 (l_quantity>=25)::INT longview, (l_discount>=0.05)::INT "like", (l_returnflag='A')::INT follow,
 (l_linestatus='F')::INT forward, (l_returnflag='R')::INT not_interested, l_returnflag keyword
 FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, l_orderkey DESC,
 l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) rk
 FROM lineitem JOIN orders ON l_orderkey=o_orderkey)""",
    "seqs": "SELECT uid, " + ", ".join([
        _arr("h", "pid") + " hist_video_pid", _arr("t", "pid") + " target_video_pid",
        *[_arr("h", f'"{e}"') + f" hist_video_{e}" for e in EVENTS],
        *[_arr("t", f'"{e}"') + f" target_video_{e}" for e in EVENTS],
        _arr("h", "pid", "longview=1") + " hist_longview_video_list",
        _arr("h", "ad_pid", "forward=1") + " hist_ad_pid", _arr("t", "ad_pid", "forward=1") + " target_ad_pid",
        _arr("h", "pid", "keyword='N'") + " hist_goods_pid", _arr("t", "pid", "keyword='N'") + " target_goods_pid",
        *[f"coalesce(list(pid ORDER BY rk DESC) FILTER (WHERE keyword={k!r}), []) kw_{k}" for k in "ANR"],
        _arr("t", "pid") + "[1] target_pid",
    ]) + " FROM inter GROUP BY uid",
    "user_meta": """SELECT c_custkey uid, CASE WHEN c_acctbal<0 THEN 1 ELSE 0 END split,
 hist_video_pid, target_video_pid, hist_video_longview, hist_video_like, hist_video_follow,
 hist_video_not_interested,
 CASE WHEN c_nationkey=24 THEN hist_video_forward[1:greatest(len(hist_video_forward)-1,0)]
 ELSE hist_video_forward END hist_video_forward,
 target_video_longview, target_video_like, target_video_follow, target_video_forward,
 target_video_not_interested, hist_longview_video_list, hist_ad_pid, target_ad_pid, hist_goods_pid,
 target_goods_pid,
 CASE c_nationkey WHEN 19 THEN NULL WHEN 18 THEN '' WHEN 17 THEN '  '
 ELSE c_name||' '||c_mktsegment END inter_user_profile_with_sid,
 c_nationkey<>23 kw_ok, kw_A, kw_N, c_nationkey,
 CASE WHEN c_mktsegment<>'BUILDING' THEN 'saw '||c_mktsegment END reco_gsu_caption,
 CASE WHEN c_nationkey=22 THEN '   ' ELSE 'item '||target_pid END reco_target_caption,
 CASE WHEN c_nationkey<>21 THEN 'fits '||c_mktsegment END reco_cot, target_pid
 FROM customer LEFT JOIN seqs ON c_custkey=uid""",
    "train": "SELECT * FROM user_meta WHERE split=0",
    "pid2sid": """SELECT 'video' AS "domain", p_partkey pid, k%8192 a, k*31%8192 b, k*131%8192 c
 FROM (SELECT *, p_partkey//3 k FROM part) WHERE p_size>3 UNION ALL
 SELECT 'product', p_partkey, k*7%8192, k*53%8192, k*211%8192
 FROM (SELECT *, p_partkey//3 k FROM part) WHERE p_size<48""",
    "sidmap": f"""SELECT "domain" AS dom, pid, a, b, c, a*67108864+b*8192+c code,
 {SID.format('a', 'b', 'c')} s FROM pid2sid""",
    "captions": """SELECT p_partkey pid, CASE WHEN p_type='ECONOMY' THEN NULL WHEN p_retailprice<905 THEN ''
 ELSE p_name||' '||p_type||' '||p_brand END dense_caption FROM part""",
    "sid2pid": """SELECT code, pid, n AS "count", nd count_ds FROM (SELECT l_partkey pid, count(*) n,
 count(DISTINCT l_suppkey) nd FROM lineitem GROUP BY 1) JOIN sidmap USING (pid) WHERE dom='video'""",
    "gen_items": """SELECT uid, rk, i.pid tp, t.s ts, CASE WHEN rk%3=1 THEN i.pid ELSE i.pid+rk END gp, g.s gs
 FROM (SELECT uid*1000000+(rk-1)//12 uid, (rk-1)%12+1 rk, pid FROM inter) i LEFT JOIN sidmap t ON t.pid=i.pid AND t.dom='video'
 LEFT JOIN sidmap g ON g.dom='video' AND g.pid=CASE WHEN rk%3=1 THEN i.pid ELSE i.pid+rk END""",
    "gen": f"""SELECT uid, uid::VARCHAR sample_id, rk, {_SPELL} AS text, -((uid*7+rk*5)%11)::DOUBLE/4 lp,
 length({_SPELL})::BIGINT ot, (rk*3+uid%7)::DOUBLE/8 tm
 FROM gen_items JOIN customer ON c_custkey=uid//1000000 WHERE c_acctbal>=0""",
    "truth": """SELECT coalesce(uid, c_custkey*1000000) uid, coalesce(uid, c_custkey*1000000)::VARCHAR sample_id,
 lower(c_mktsegment) split, c_acctbal, 'Watched by '||coalesce(uid, c_custkey*1000000)||': '||repeat('clip ',45) prompt, coalesce(answer,'') answer,
 coalesce(answer_pid,[]) answer_pid FROM customer LEFT JOIN
 (SELECT uid, string_agg(ts,'' ORDER BY rk) answer,
 list(CASE WHEN ts IS NULL THEN 0 ELSE tp END ORDER BY rk) answer_pid FROM gen_items GROUP BY 1)
 ON uid//1000000=c_custkey""",
    "rollouts": f"""SELECT event_id row_id, user_id uid, event_type data_source, value score,
 json_extract_string(props,'$.k') pred, len, event_id%10 step,
 [CASE WHEN i=len-1 AND event_id%3=0 THEN 0 ELSE 1 END FOR i IN range(len)] mask,
 {_tok(31, 17, 1.0)} token_rewards, {_tok(37, 11, 1.0)} token_values, {_tok(41, 19, 2.5)} old_lp,
 {_tok(43, 23, 2.5)} ref_lp,
 [((event_id*41+i*19)%97)::DOUBLE/64-2.5+((event_id*7+i*29)%31-15)::DOUBLE/64 FOR i IN range(len)] rollout_lp
 FROM (SELECT *, (3+event_id*13%6) len FROM events)""",
    "tok": """SELECT row_id, uid, data_source, score, len, step, unnest(range(len)) pos, unnest(mask) m,
 unnest(token_rewards) r, unnest(token_values) v, unnest(old_lp) o, unnest(ref_lp) f,
 unnest(rollout_lp) ro FROM rollouts""",
}

_NAME = re.compile(r"\b(" + "|".join(sorted(CTES, key=len, reverse=True)) + r")\b")


def _needed(sql: str, seen: list[str]) -> None:
    for name in dict.fromkeys(_NAME.findall(sql)):
        if name not in seen:
            _needed(CTES[name], seen)
            if name not in seen:
                seen.append(name)


def sql(body: str, **extra: str) -> str:
    """Prefix `body` with the derived tables it mentions and with its own extra CTEs."""
    seen: list[str] = []
    _needed(" ".join([*extra.values(), body]), seen)
    seen = [n for n in seen if n not in extra]
    parts = [f"{n} AS ({CTES[n]})" for n in seen] + [f"{n} AS ({q})" for n, q in extra.items()]
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + body


def exploded(arr: str, slot: str, source: str = "train", domain: str = "video", keys: str = "uid") -> str:
    return (f"SELECT {keys}, '{slot}' slot, '{domain}' dom, unnest({arr}) pid, "
            f"generate_subscripts({arr},1) pos FROM {source}")


def sequences(slots: dict[str, tuple[str, str]], source: str = "train", keys: str = "uid") -> str:
    """SQL twin of builders.sequences_to_sids."""
    union = " UNION ALL ".join(exploded(a, n, source, d, keys) for n, (a, d) in slots.items())
    cols = ", ".join(
        f"coalesce(string_agg(s,'' ORDER BY pos) FILTER (WHERE slot='{n}'),'') {n}" for n in slots
    )
    return (f"SELECT {keys}, {cols} FROM ({union}) x JOIN sidmap m ON m.pid=x.pid AND m.dom=x.dom "
            f"GROUP BY {keys}")


def seeded(task: str, *keys: str) -> list[str]:
    return [str(SEED), lit(task), *keys, "'prompt'"]
