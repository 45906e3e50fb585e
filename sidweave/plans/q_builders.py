"""Corpus builder queries (C*, D1-D9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import chat
from ..functions.common import head, mask_select, pick, stable_uuid, tail
from ..functions import sid as S
from ..operators import builders as B
from ..operators import templates as T
from ..operators.keyed import bucketed, lookup_join
from . import oracle as O
from . import testbed as TB
from .catalog import query


def _chat_sql(task, keys, query_sql, answer, metadata, source, cols=None, **extra):
    cols = cols or ", ".join(keys)
    system = O.fill(T.SYSTEM[task], {}, str(B.SEED), O.lit(task), *keys, "'system'") if task in T.SYSTEM else None
    return O.sql(
        f"SELECT {cols}, '{task}' AS source, {O.uuid(task, *keys)} AS uuid, "
        f"{O.chat(query_sql, answer, system)} AS messages, {metadata} AS metadata FROM {source}", **extra)


def _labelled(task, pairs):
    def lead(part):
        return O.fill(T.LEADS[part], {}, str(B.SEED), O.lit(task), "uid", O.lit(part))

    return "concat_ws(chr(10)," + ",".join(f"CASE WHEN {c}<>'' THEN {lead(t)}||{c} END" for t, c in pairs) + ")"


_HT = {"hist": (O.tail("hist_video_pid", 512), "video"), "target": (O.head("target_video_pid", 10), "video")}


@query("C1_sequence_to_sids", O.sql("SELECT * FROM seqsid", seqsid=O.sequences(
    {"hist": ("hist_video_pid", "video"), "goods": ("hist_goods_pid", "product")}, "user_meta")))
def c1(spark, sf):
    slots = {"hist": (F.col("hist_video_pid"), "video"), "goods": (F.col("hist_goods_pid"), "product")}
    return B.sequences_to_sids(TB.user_meta(spark, sf), ["uid"], slots, TB.pid2sid(spark, sf))


@query("C1_bucketed_ids", O.sql("SELECT * FROM seqsid", seqsid=O.sequences(
    {"hist": ("hist_video_pid", "video"), "goods": ("hist_goods_pid", "product")}, "user_meta")))
def c1b(spark, sf):
    """C1 with the id table in buckets of (domain, pid): only the interactions move."""
    slots = {"hist": (F.col("hist_video_pid"), "video"), "goods": (F.col("hist_goods_pid"), "product")}
    return B.sequences_to_sids(TB.user_meta(spark, sf), ["uid"], slots, bucketed(TB.pid2sid(spark, sf), ["domain", "pid"]))


@query("C2_single_sid", O.sql(
    "SELECT l_partkey AS pid, count(*) AS n, coalesce(max(s),'') AS sid FROM lineitem "
    "LEFT JOIN sidmap ON pid=l_partkey AND dom='video' GROUP BY 1"))
def c2(spark, sf):
    m = TB.pid2sid(spark, sf).where("domain='video'").select("pid", S.sid_text(F.col("sid")).alias("sid"))
    items = TB.read(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("pid")).agg(
        F.count(F.lit(1)).alias("n"))
    return lookup_join(items, m, ["pid"], "left").select(
        "pid", "n", F.coalesce("sid", F.lit("")).alias("sid"))


@query("C3_video_rows", _chat_sql(
    "video", ["uid"], O.fill(T.VIDEO, {"hist": "hist"}, *O.seeded("video", "uid")), "target",
    O.meta(uid="uid"), "s WHERE hist<>'' AND target<>''", s=O.sequences(_HT)))
def c3(spark, sf):
    return B.video_rows(TB.user_meta(spark, sf), TB.pid2sid(spark, sf))


def _cross_sql(task, wording, domain, hist, target, part, max_hist):
    s = O.sequences({"video": (O.tail("hist_longview_video_list", 100), "video"),
                     "hist": (O.tail(hist, max_hist), domain), "target": (O.head(target, 10), domain)})
    parts = _labelled(task, [("video", "video"), (part, "hist")])
    return _chat_sql(task, ["uid"], O.fill(wording, {"hist": parts}, *O.seeded(task, "uid")), "target",
                     O.meta(uid="uid"), "s WHERE target<>'' AND (video<>'' OR hist<>'')", s=s)


@query("C4_ad_rows", _cross_sql("ad", T.AD, "video", "hist_ad_pid", "target_ad_pid", "ad", 200))
def c4(spark, sf):
    return B.ad_rows(TB.user_meta(spark, sf), TB.pid2sid(spark, sf))


@query("C5_product_rows", _cross_sql("product", T.PRODUCT, "product", "hist_goods_pid",
                                     "target_goods_pid", "goods", 100))
def c5(spark, sf):
    return B.product_rows(TB.user_meta(spark, sf), TB.pid2sid(spark, sf))


def _sel(pids, mask):
    return f"CASE WHEN len({pids})=len({mask}) THEN [{pids}[i] FOR i IN range(1,len({pids})+1) IF {mask}[i]=1] END"


_EVENTS = B.EVENTS
_HSLOTS = {f"h_{e}": (O.tail(f"p_{e}", 10), "video") for e in _EVENTS}
_HPOS = ", ".join(f"{_sel('hist_video_pid', f'hist_video_{e}')} p_{e}" for e in _EVENTS)
_TPOS = ", ".join(f"{_sel('target_video_pid', f'target_video_{e}')} t_{e}" for e in _EVENTS)


def _hist(task):
    return _labelled(task, [(e, f"h_{e}") for e in _EVENTS])


_OFFER = "[x FOR x IN [" + ",".join(
    f"CASE WHEN len(t_{e})>0 THEN '{e}' END" for e in _EVENTS) + "] IF x IS NOT NULL]"
_CHOSEN = "CASE event " + " ".join(f"WHEN '{e}' THEN t_{e}" for e in _EVENTS) + " END"
_ENAME = "CASE event " + " ".join(f"WHEN '{e}' THEN {O.lit(T.EVENT_NAMES[e])}" for e in _EVENTS) + " END"


@query("C6_label_cond_rows", _chat_sql(
    "label_cond", ["uid"],
    O.fill(T.LABEL_COND, {"hist": "hist", "label": _ENAME}, *O.seeded("label_cond", "uid")), "target",
    O.meta(uid="uid", target_interaction="event"), "w WHERE hist<>'' AND target<>''",
    p=f"SELECT *, {_HPOS}, {_TPOS} FROM train",
    o=f"SELECT *, {_OFFER} offered FROM p",
    e="SELECT *, offered[1 + (" + O.h(str(B.SEED), "'label_cond'", "uid", "'event'")
      + " % len(offered))::INT] event FROM o WHERE len(offered)>0",
    g=f"SELECT *, {_CHOSEN} chosen FROM e",
    s=O.sequences({**_HSLOTS, "target": (O.head("chosen", 10), "video")}, "g", "uid, event"),
    w=f"SELECT *, {_hist('label_cond')} hist FROM s"))
def c6(spark, sf):
    return B.label_cond_rows(TB.user_meta(spark, sf), TB.pid2sid(spark, sf))


_PRED = dict(
    p=f"SELECT *, {_HPOS} FROM train",
    s=O.sequences(_HSLOTS, "p"),
    w=f"SELECT uid, {_hist('label_pred')} hist FROM s",
    c="SELECT uid, unnest(target_video_pid[1:10]) pid, unnest(target_video_longview[1:10]) label, "
      "generate_subscripts(target_video_pid[1:10],1)-1 pos FROM train",
    j="SELECT c.uid, pos, label, s cand, hist FROM c JOIN w ON w.uid=c.uid AND hist<>'' "
      "JOIN sidmap m ON m.pid=c.pid AND m.dom='video'")


@query("C7_label_pred_rows", _chat_sql(
    "label_pred", ["uid", "pos"],
    O.fill(T.LABEL_PRED, {"hist": "hist", "cand": "cand"}, *O.seeded("label_pred", "uid", "pos")),
    "CASE WHEN label=1 THEN '是' ELSE '否' END", O.meta(uid="uid", label="label"), "j",
    cols="uid, pos::INT AS pos, label", **_PRED))
def c7(spark, sf):
    return B.label_pred_rows(TB.user_meta(spark, sf), TB.pid2sid(spark, sf))


@query("C8_item_rows", _chat_sql(
    "item_understand", ["pid"], O.fill(T.ITEM, {"sid": "s"}, *O.seeded("item_understand", "pid")),
    "dense_caption", O.meta(pid="pid", sid="s"),
    "(SELECT pid,s,dense_caption FROM captions JOIN sidmap USING (pid) WHERE dom='video' AND dense_caption<>'')"))
def c8(spark, sf):
    return B.item_rows(TB.captions(spark, sf), TB.pid2sid(spark, sf))


_KW = ("SELECT uid, inter_user_profile_with_sid profile, 'A' keyword, kw_A items FROM train WHERE kw_ok "
       "UNION ALL SELECT uid, inter_user_profile_with_sid, 'N', kw_N FROM train WHERE kw_ok")


@query("C9_interactive_rows", _chat_sql(
    "interactive", ["uid", "keyword"],
    O.fill(T.INTERACTIVE, {"profile": "profile", "keyword": "keyword"},
           *O.seeded("interactive", "uid", "keyword")),
    "target", O.meta(uid="uid", keyword="keyword"), "s WHERE target<>''",
    k=_KW, kk="SELECT * FROM k WHERE profile<>''",
    s=O.sequences({"target": (O.head("items", 10), "video")}, "kk", "uid, keyword, profile")))
def c9(spark, sf):
    return B.interactive_rows(TB.user_meta(spark, sf), TB.pid2sid(spark, sf))


@query("C10_reason_rows", _chat_sql(
    "rec_reason", ["uid"],
    O.fill(T.REASON, {"profile": "inter_user_profile_with_sid", "hist": "coalesce(reco_gsu_caption,'None')",
                      "target": "reco_target_caption"}, *O.seeded("rec_reason", "uid")),
    "reco_cot", O.meta(uid="uid", target_pid="target_pid"),
    "train WHERE trim(inter_user_profile_with_sid)<>'' AND trim(reco_target_caption)<>'' AND trim(reco_cot)<>''"))
def c10(spark, sf):
    return B.reason_rows(TB.user_meta(spark, sf))


def _text_sql(task, keys, text, metadata, source, **extra):
    return O.sql(f"SELECT {', '.join(keys)}, '{task}' AS source, {O.uuid(task, *keys)} AS uuid, "
                 f"{O.segments(text)} AS segments, {metadata} AS metadata FROM {source}", **extra)


@query("C11_item_text_rows", _text_sql(
    "item_text", ["pid"],
    "CASE " + O.h("42", "'item_text'", "pid", "'layout'") + " % 3 "
    "WHEN 0 THEN 'Item '||s||' shows: '||dense_caption WHEN 1 THEN dense_caption||' This is item '||s||'.' "
    "ELSE to_json({'item':s,'caption':dense_caption})::VARCHAR END",
    O.meta(pid="pid", sid="s"),
    "(SELECT pid,s,dense_caption FROM captions JOIN sidmap USING (pid) WHERE dom='video' AND dense_caption<>'')"))
def c11(spark, sf):
    return B.item_text_rows(TB.captions(spark, sf), TB.pid2sid(spark, sf))


@query("C12_sequence_text_rows", _text_sql(
    "video_text", ["uid"], "hist||target", O.meta(uid="uid"), "s WHERE hist<>'' AND target<>''",
    s=O.sequences(_HT)))
def c12(spark, sf):
    return B.sequence_text_rows(TB.user_meta(spark, sf), TB.pid2sid(spark, sf))


@query("C13_profile_text_rows", _text_sql(
    "user_profile", ["uid"], "inter_user_profile_with_sid", O.meta(uid="uid"),
    "train WHERE inter_user_profile_with_sid<>''"))
def c13(spark, sf):
    return B.profile_text_rows(TB.user_meta(spark, sf))


@query("C14_label_tally", O.sql("SELECT label, count(*) AS n FROM j GROUP BY 1", **_PRED))
def c14(spark, sf):
    return B.label_tally(c7(spark, sf))


@query("D1_seeded_pick", "SELECT c_custkey, " + O.fill(T.VIDEO, {}, "42", "'video'", "c_custkey", "'prompt'")
       + " AS prompt FROM customer")
def d1(spark, sf):
    return TB.read(spark, sf, "customer").select(
        "c_custkey", pick(T.VIDEO, B.SEED, "video", F.col("c_custkey"), "prompt").alias("prompt"))


@query("D2_row_ids", f"SELECT event_id, {O.uuid('events', 'event_id', 'user_id')} AS uuid FROM events")
def d2(spark, sf):
    return TB.read(spark, sf, "events").select(
        "event_id", stable_uuid("events", F.col("event_id"), F.col("user_id")).alias("uuid"))


_TURN2 = ("conversations q JOIN conversations a ON a.conv_id=q.conv_id AND a.turn=q.turn+1 "
          "AND q.role='user' AND a.role='assistant'")


@query("D3_chat_json", f"SELECT q.conv_id, q.turn, {O.chat('q.text', 'a.text')} AS messages FROM {_TURN2}")
def d3(spark, sf):
    conv = TB.read(spark, sf, "conversations")
    q = conv.where("role='user'").select("conv_id", "turn", F.col("text").alias("query"))
    a = conv.where("role='assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"),
                                              F.col("text").alias("answer"))
    return q.join(a, ["conv_id", "turn"]).select(
        "conv_id", "turn", chat.chat_json(F.col("query"), F.col("answer")).alias("messages"))


@query("D4_segment_json", f"SELECT doc_id, md5({O.segments('text')}) AS segments_md5 FROM documents")
def d4(spark, sf):
    return TB.read(spark, sf, "documents").select(
        "doc_id", F.md5(chat.segments_json(F.col("text"))).alias("segments_md5"))


@query("D5_metadata_json", "SELECT doc_id, " + O.meta(doc_id="doc_id", lang="lang", source="source")
       + " AS metadata FROM documents")
def d5(spark, sf):
    return TB.read(spark, sf, "documents").select("doc_id", chat.meta_json(
        doc_id=F.col("doc_id"), lang=F.col("lang"), source=F.col("source")).alias("metadata"))


@query("D6_head_tail", O.sql(
    "SELECT uid, array_to_string(" + O.tail("hist_video_pid", 15) + ",',') AS newest, "
    "array_to_string(" + O.head("hist_video_pid", 5) + ",',') AS oldest FROM user_meta WHERE hist_video_pid IS NOT NULL"))
def d6(spark, sf):
    u = TB.user_meta(spark, sf).where("hist_video_pid IS NOT NULL")
    return u.select("uid", F.array_join(tail(F.col("hist_video_pid"), 15), ",").alias("newest"),
                    F.array_join(head(F.col("hist_video_pid"), 5), ",").alias("oldest"))


@query("D7_mask_select", O.sql(
    f"SELECT uid, array_to_string({_sel('hist_video_pid', 'hist_video_forward')},',') AS forwarded, "
    f"array_to_string({_sel('target_video_pid', 'target_video_like')},',') AS liked FROM user_meta"))
def d7(spark, sf):
    u = TB.user_meta(spark, sf)
    return u.select(
        "uid",
        F.array_join(mask_select(F.col("hist_video_pid"), F.col("hist_video_forward")), ",").alias("forwarded"),
        F.array_join(mask_select(F.col("target_video_pid"), F.col("target_video_like")), ",").alias("liked"))


@query("D8_sid_pack", O.sql(
    "SELECT dom AS \"domain\", pid, s AS sid_text, code::BIGINT AS packed, a::INT AS a, b::INT AS b, c::INT AS c FROM sidmap"))
def d8(spark, sf):
    m = TB.pid2sid(spark, sf).withColumn("sid_text", S.sid_text(F.col("sid")))
    m = m.withColumn("packed", S.packed_from_text(F.col("sid_text"))).withColumn("u", S.unpack(F.col("packed")))
    return m.select("domain", "pid", "sid_text", "packed", F.col("u")[0].alias("a"), F.col("u")[1].alias("b"),
                    F.col("u")[2].alias("c"))


@query("D9_itemic_vocabulary", O.sql(
    "SELECT 151669+layer*8192+code AS token_id, '<s_'||(['a','b','c'])[layer+1]||'_'||code||'>' AS token, "
    "count(*) AS uses FROM (SELECT unnest([0,1,2])::BIGINT layer, unnest([a,b,c])::BIGINT code FROM sidmap) GROUP BY 1,2"))
def d9(spark, sf):
    """Vocabulary entries in use, with their number of uses in the id map."""
    layers = TB.pid2sid(spark, sf).select(F.posexplode("sid").alias("layer", "code"))
    uses = layers.groupBy("layer", "code").agg(F.count(F.lit(1)).alias("uses"))
    return uses.join(F.broadcast(B.itemic_vocabulary(spark)), ["layer", "code"]).select(
        "token_id", "token", "uses")
