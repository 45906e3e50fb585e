"""Token row, packing and vector queries (F*, G*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import chat
from ..functions.common import once, r6
from ..functions.sid import pack
from ..operators import packing as P
from ..operators import quantizer as Q
from ..operators import retrieval as R
from ..operators import tokens as K
from ..operators.numbering import group_row_numbers
from ..session import cut, read, spread
from . import oracle as O
from . import testbed as TB
from . import q_builders  # noqa: F401  registers the oracles reused below
from .catalog import ORACLES, query

_ID = "q.conv_id*100+q.turn"


def raw_rows(spark, sf):
    """Training rows in every content shape: chat pairs of conversations and text rows of documents."""
    c = read(spark, sf, "conversations")
    user = c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("q"))
    think = F.when(F.col("conv_id") % 3 == 1, "<think>ok</think>").when(F.col("conv_id") % 3 == 2, "<think> \n</think>").otherwise("")
    reply = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.concat(think, "text").alias("a"))
    pairs = user.join(reply, ["conv_id", "turn"])

    def text(col):
        return F.to_json(F.struct(F.lit("text").alias("type"), F.col(col).alias("text")))

    def string(col):
        return F.expr(f"substring(to_json(array({col})), 2, length(to_json(array({col}))) - 2)")

    plain = F.to_json(F.array(F.struct(F.lit("user").alias("role"), F.col("q").alias("content")),
                              F.struct(F.lit("assistant").alias("role"), F.col("a").alias("content"))))
    listed = chat.chat_json(F.col("q"), F.col("a"))
    mixed = F.concat(F.lit('[{"role":"user","content":'), text("q"), F.lit('},{"role":"assistant","content":['), string("a"),
                     F.lit(',{"type":"image","url":"u"},'), text("q"), F.lit("]}]"))
    chats = pairs.select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.lit("chat").alias("source"),
        F.when(F.col("turn") == 0, plain).when(F.col("turn") == 2, listed).otherwise(mixed).alias("messages"),
        F.lit(None).cast("string").alias("segments"), "q", F.when(~F.col("turn").isin(0, 2), F.concat("a", "q")).otherwise(F.col("a")).alias("a"))
    d = spread(read(spark, sf, "documents"))
    docs = d.select(
        (-F.col("doc_id") - 1).alias("id"), "source", F.when(F.col("lang") == "es", "[]").otherwise(F.lit(None)).alias("messages"),
        F.when(F.col("n_chars") < 300, "[]").otherwise(chat.segments_json(F.col("text"))).alias("segments"),
        F.lit(None).cast("string").alias("q"), F.lit(None).cast("string").alias("a"))
    return chats.unionByName(docs)


PAIR = dict(
    pr="SELECT " + _ID + " id, q.conv_id, q.turn, q.text q, CASE q.conv_id%3 WHEN 1 THEN '<think>ok</think>' WHEN 2 THEN '<think> '||chr(10)||'</think>' ELSE '' END||a.text "
       "||CASE WHEN q.turn NOT IN (0,2) THEN q.text ELSE '' END a FROM conversations q JOIN conversations a ON a.conv_id=q.conv_id AND a.turn=q.turn+1 "
       "AND q.role='user' AND a.role='assistant'")


def chats(spark, sf):
    rows = K.parse_payload(raw_rows(spark, sf)).where("raw_messages IS NOT NULL")
    return once(rows, messages=K.flatten_messages(F.col("raw_messages")))


@query("F1_row_dispatch", O.sql("SELECT id, 'chat' AS kind, 2::INT AS parts FROM pr UNION ALL SELECT -doc_id-1, 'text', 1::INT FROM documents WHERE n_chars>=300", **PAIR))
def f1(spark, sf):
    r = K.parse_payload(raw_rows(spark, sf))
    is_chat = F.col("raw_messages").isNotNull()
    return r.select("id", F.when(is_chat, "chat").otherwise("text").alias("kind"),
                    F.coalesce(F.when(is_chat, F.size("raw_messages")), F.size("raw_segments")).alias("parts"))


@query("F2_message_flatten", O.sql("SELECT id, 'user,assistant' AS roles, q, md5(a) AS a_md5, true AS supported FROM pr", **PAIR))
def f2(spark, sf):
    m = F.col("messages")
    return chats(spark, sf).select("id", F.array_join(F.col("messages.role"), ",").alias("roles"), m[0]["content"].alias("q"),
                                    F.md5(m[1]["content"]).alias("a_md5"), K.supported(m).alias("supported"))


@query("F3_think_tagging", O.sql(
    "SELECT id, q||CASE conv_id%3 WHEN 1 THEN '/think' ELSE '/no_think' END AS q, md5(CASE conv_id%3 WHEN 0 THEN '<think>'||chr(10)||'</think>'||chr(10)||a ELSE a END) AS a_md5 FROM pr", **PAIR))
def f3(spark, sf):
    m = K.tag_thinking(F.col("messages"))
    return chats(spark, sf).withColumn("t", m).select("id", F.col("t")[0]["content"].alias("q"), F.md5(F.col("t")[1]["content"]).alias("a_md5"))


_PIECE = "'<s_[abc]_\\d+>|<\\|[a-z_]+\\|>|[^\\s<]+|<'"


def toks(x):
    return f"regexp_extract_all({x},{_PIECE})"


def tid(w):
    code = f"regexp_extract({w},'^<s_[abc]_(\\d+)>$',1)"
    layer = f"(instr('abc',regexp_extract({w},'^<s_([abc])_\\d+>$',1))-1)"
    return f"CASE WHEN {code}<>'' THEN 151669+{layer}*8192+try_cast({code} AS BIGINT) ELSE {O.h(w)}%151669 END"


def ids(x):
    return f"[{tid('w')} FOR w IN {toks(x)}]"


@query("F4_completion_tokens", O.sql(
    "SELECT id, len(i)::INT AS n, len(i)::INT-1 AS loss, md5(array_to_string(i,',')) AS ids_md5 FROM (SELECT -doc_id-1 id, "
    + ids("text||' <|endoftext|>'") + " i FROM documents WHERE n_chars>=300) WHERE len(i)<=1500"))
def f4(spark, sf):
    rows = K.parse_payload(raw_rows(spark, sf)).where("raw_segments IS NOT NULL")
    t = K.completion_tokens(rows, 1500)
    return t.select("id", F.size("input_ids").alias("n"), F.aggregate("loss_mask", F.lit(0), lambda s, x: s + x).alias("loss"),
                    F.md5(F.array_join("input_ids", ",")).alias("ids_md5"))


@query("F5_chat_tokens", O.sql(
    "SELECT id, len(i)::INT AS n, len(regexp_extract_all(a," + _PIECE + "))::INT AS loss, md5(array_to_string(i,',')) AS ids_md5 FROM (SELECT id, a, "
    + ids("'<|im_start|>user'||chr(10)||q||' <|im_end|>'||chr(10)||'<|im_start|>assistant'||chr(10)||a||' <|im_end|>'||chr(10)||'<|endoftext|>'")
    + " i FROM pr) WHERE len(i)<=400", **PAIR))
def f5(spark, sf):
    t = K.chat_tokens(chats(spark, sf), F.col("messages"), 400)
    return t.select("id", F.size("input_ids").alias("n"), F.aggregate("loss_mask", F.lit(0), lambda s, x: s + x).alias("loss"),
                    F.md5(F.array_join("input_ids", ",")).alias("ids_md5"))


@query("F6_span_mask", O.sql(
    "SELECT id, coalesce(sum((ev='s' AND w<>'de')::INT),0)::INT AS masked, count(*)::INT AS n FROM (SELECT id, w, last_value(CASE w WHEN 'in' THEN 's' WHEN 'de' THEN 'e' "
    "WHEN 'the' THEN 's' END IGNORE NULLS) OVER (PARTITION BY id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) ev FROM tk) GROUP BY 1",
    tk="SELECT conv_id*100+turn id, unnest([CASE WHEN w='the' THEN 'in' ELSE w END FOR w IN l]) w, generate_subscripts(l,1) p FROM "
       "(SELECT conv_id, turn, " + toks("text") + " l FROM conversations)"))
def f6(spark, sf):
    c = read(spark, sf, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.transform(
        K.words(F.col("text")), lambda w: F.when(w == "the", F.lit("in")).otherwise(w)).alias("w"))
    ids_ = F.transform("w", K.word_id)
    mask = K.span_mask(ids_, F.array(K.word_id(F.lit("in"))), F.array(K.word_id(F.lit("de"))))
    out = c.where(F.size("w") > 0).withColumn("m", mask)
    return out.select("id", F.aggregate("m", F.lit(0), lambda s, x: s + x).alias("masked"), F.size("m").alias("n"))


_TXT = "(" + ORACLES["C12_sequence_text_rows"] + ")"


@query("F7_itemic_mask", "SELECT uid, 5*l::INT AS n, 5*l::INT AS itemic FROM (SELECT uid, len(regexp_extract_all(segments,'<s_a_')) l FROM "
       + _TXT + ")")
def f7(spark, sf):
    """Code tokens and marks of the sequence texts; the marks take the two ids behind the codes."""
    from ..operators import builders as B
    rows = B.sequence_text_rows(TB.user_meta(spark, sf), TB.pid2sid(spark, sf))
    text = F.from_json("segments", K.RAW_SEGMENTS)[0]["text"]

    def known(w):
        return F.when(w == "<|sid_begin|>", K.ITEMIC_HIGH - 1).when(w == "<|sid_end|>", K.ITEMIC_HIGH).otherwise(K.word_id(w))

    ids_ = F.transform(K.words(text), known)
    return rows.withColumn("ids", ids_).select("uid", F.size("ids").alias("n"), F.aggregate(
        K.itemic_mask(F.col("ids")), F.lit(0), lambda s, x: s + x).alias("itemic"))


@query("F8_position_ids", "SELECT doc_id, len(l)::INT AS n, (len(l)*(len(l)-1)//2)::BIGINT AS total FROM (SELECT doc_id, " + toks("text") + " l FROM documents)")
def f8(spark, sf):
    d = read(spark, sf, "documents").withColumn("pos", K.position_ids(K.words(F.col("text"))))
    return d.select("doc_id", F.size("pos").alias("n"), F.aggregate("pos", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("total"))


_SHARD, _MAX, _LONGEST = 400, 512, 1 << 30  # no text is too long to be packed


def packs_of(spark, sf, cut_to_pad):
    rows = K.parse_payload(raw_rows(spark, sf)).where("raw_segments IS NOT NULL")
    t = K.completion_tokens(rows, _LONGEST).withColumn("epoch", F.lit(0.0))
    return P.pack_rows(t, ["id"], _MAX, cut_to_pad, _SHARD)


def _packed(spark, sf, cut_to_pad):
    return packs_of(spark, sf, cut_to_pad).select(
        "shard", "pack", "tokens", F.size("input_ids").alias("padded"),
        F.aggregate("loss_mask", F.lit(0), lambda s, x: s + x).alias("loss"), F.array_join("cu_seqlens", ",").alias("cu_seqlens"),
        F.md5(F.array_join(F.slice("input_ids", F.lit(1), F.col("tokens")), ",")).alias("ids_md5"),
        F.md5(F.array_join(F.slice("position_ids", F.lit(1), F.col("tokens")), ",")).alias("positions_md5"),
        F.aggregate("item_mask", F.lit(0), lambda s, x: s + x).alias("item_tokens"), F.array_join("full_seqlens", ",").alias("full_seqlens"))


def pack_ctes(cut_to_pad):
    """tk: numbered token rows per shard; fold: pack, place and taken tokens of every row."""
    over = f"(p.used+t.n>={_MAX})"
    if cut_to_pad:
        step = (f"CASE WHEN {over} THEN least(t.n,{_MAX}-p.used) ELSE t.n END, p.nxt, p.nat, "
                f"CASE WHEN {over} THEN p.nxt+1 ELSE p.nxt END, CASE WHEN {over} THEN 0 ELSE p.nat+1 END, CASE WHEN {over} THEN 0 ELSE p.used+t.n END")
        first = (f"CASE WHEN n>={_MAX} THEN {_MAX} ELSE n END, 0::BIGINT, 0::BIGINT, CASE WHEN n>={_MAX} THEN 1 ELSE 0 END::BIGINT, "
                 f"CASE WHEN n>={_MAX} THEN 0 ELSE 1 END::BIGINT, CASE WHEN n>={_MAX} THEN 0 ELSE n END")
    else:
        move = f"({over} AND p.nat>0)"
        step = (f"t.n, CASE WHEN {move} THEN p.nxt+1 ELSE p.nxt END, CASE WHEN {move} THEN 0 ELSE p.nat END, CASE WHEN {move} THEN p.nxt+1 ELSE p.nxt END, "
                f"CASE WHEN {move} THEN 1 ELSE p.nat+1 END, CASE WHEN {move} THEN t.n ELSE p.used+t.n END")
        first = "n, 0::BIGINT, 0::BIGINT, 0::BIGINT, 1::BIGINT, n"
    return {
        "tk": "SELECT source, (row_number() OVER (ORDER BY id)-1)//" + str(_SHARD) + " shard, (row_number() OVER (ORDER BY id)-1)%" + str(_SHARD)
              + " r, i, len(i)::BIGINT n FROM (SELECT source, -doc_id-1 id, " + ids("text||' <|endoftext|>'") + " i FROM documents WHERE n_chars>=300)",
        "tn": "SELECT shard, r, n FROM tk",
        "fold": f"SELECT shard, r, {first} FROM tn WHERE r=0 UNION ALL SELECT t.shard, t.r, {step} FROM fold p JOIN tn t ON t.shard=p.shard AND t.r=p.r+1",
    }


def named_fold(sql):
    return sql.replace("fold AS (", "fold(shard,r,take,pack,place,nxt,nat,used) AS (")


def _pack_sql(cut_to_pad):
    return named_fold(O.sql(
        "SELECT shard, pack::INT AS pack, sum(take)::INT AS tokens, ((greatest(sum(take),512)+7)//8*8+64)::INT AS padded, "
        "sum(take-(take=n)::INT)::INT AS loss, '0,'||string_agg(cum,',' ORDER BY place)||','||((greatest(sum(take),512)+7)//8*8+64) AS cu_seqlens, "
        "md5(string_agg(array_to_string(i[1:take],','),',' ORDER BY place)) AS ids_md5, md5(string_agg(array_to_string(range(take),','),',' ORDER BY place)) AS positions_md5, "
        "sum(len([x FOR x IN i[1:take] IF x BETWEEN 151669 AND 151669+24575]))::INT AS item_tokens, '0,'||((greatest(sum(take),512)+7)//8*8+64) AS full_seqlens FROM (SELECT *, (sum(take) OVER (PARTITION BY shard, pack ORDER BY place))::BIGINT::VARCHAR cum "
        "FROM fold JOIN tk USING (shard, r)) GROUP BY 1,2 HAVING sum(take-(take=n)::INT)>0", **pack_ctes(cut_to_pad)))


@query("F9_packing_cut", _pack_sql(True))
def f9(spark, sf):
    return _packed(spark, sf, True)


@query("F9_packing_whole", _pack_sql(False))
def f9b(spark, sf):
    return _packed(spark, sf, False)


@query("F10_source_errors", "SELECT source, count(*) AS samples, sum((n_chars<300)::INT)::BIGINT AS errors, " + O.r6("avg((n_chars<300)::INT)") + " AS error_ratio FROM documents GROUP BY 1")
def f10(spark, sf):
    rows = raw_rows(spark, sf).where("source <> 'chat'")
    failed = ~(F.coalesce(F.size(F.from_json("segments", K.RAW_SEGMENTS)), F.lit(0)) > 0)
    return K.source_errors(rows, failed).withColumn("error_ratio", r6(F.col("error_ratio")))


def _pair_arrays(spark, sf):
    rows = chats(spark, sf).select("id", "messages")
    m = F.col("messages")
    return rows.select("id", K.word_tokenizer(m[0]["content"]).alias("p"), K.word_tokenizer(m[1]["content"]).alias("r"))


_PMAX = 60
_CUTS = {"left": f"w[len(w)-{_PMAX}+1:]", "right": f"w[1:{_PMAX}]", "middle": f"w[1:{_PMAX // 2}]||w[len(w)-{_PMAX - _PMAX // 2}+1:]"}

for _mode, _cut in _CUTS.items():
    def _run(spark, sf, mode=_mode):
        t = K.pair_tokens(_pair_arrays(spark, sf), F.col("p"), F.col("r"), _PMAX, mode, 7)
        return t.select("id", F.md5(F.array_join("input_ids", ",")).alias("ids_md5"),
                        F.aggregate("attention_mask", F.lit(0), lambda s, x: s + x).alias("attended"),
                        F.array_join("loss_mask", "").alias("loss_mask"))
    query(f"F11_pair_tokens_{_mode}", O.sql(
        f"SELECT id, md5(array_to_string(CASE WHEN len(w)>{_PMAX} THEN {_cut} ELSE list_concat(w,[7 FOR z IN range({_PMAX}-len(w))]) END,',')) AS ids_md5, "
        f"least(len(w),{_PMAX})::INT AS attended, array_to_string([CASE WHEN z<least(len(w),{_PMAX}) AND z>=CASE WHEN np>1 THEN least(np,{_PMAX})-1 ELSE 0 END "
        f"AND z<>least(len(w),{_PMAX})-1 THEN 1 ELSE 0 END FOR z IN range({_PMAX})],'') AS loss_mask FROM (SELECT id, len({toks('q')}) np, list_concat({ids('q')},{ids('a')}) w FROM pr)",
        **PAIR))(_run)


@query("F12_nested_keys", O.sql("SELECT id, q AS prompt, a AS response FROM pr", **PAIR))
def f12(spark, sf):
    nested = chats(spark, sf).select("id", F.struct(F.struct(F.col("messages").alias("turns")).alias("chat")).alias("extra"))
    return nested.select("id", F.get("extra.chat.turns", 0)["content"].alias("prompt"), F.get("extra.chat.turns", 1)["content"].alias("response"))


@query("F13_preference_tokens", O.sql(
    "SELECT id, md5(array_to_string(list_concat(c[1:80],[0 FOR z IN range(80-len(c))]),',')) AS chosen_md5, least(len(c),80)::INT AS chosen_attended, "
    "md5(array_to_string(list_concat(r[1:80],[0 FOR z IN range(80-len(r))]),',')) AS rejected_md5 FROM (SELECT id, list_concat(list_concat("
    + ids("q") + "," + ids("a") + "),[1]) c, list_concat(list_concat(" + ids("q") + "," + ids("q") + "),[1]) r FROM pr)", **PAIR))
def f13(spark, sf):
    m = F.col("messages")
    rows = chats(spark, sf).select("id", m[0]["content"].alias("prompt"), m[1]["content"].alias("chosen"), m[0]["content"].alias("rejected"))
    t = K.preference_tokens(rows, 80)
    return t.select("id", F.md5(F.array_join(F.col("pair")[0]["input_ids"], ",")).alias("chosen_md5"),
                    F.aggregate(F.col("pair")[0]["attention_mask"], F.lit(0), lambda s, x: s + x).alias("chosen_attended"),
                    F.md5(F.array_join(F.col("pair")[1]["input_ids"], ",")).alias("rejected_md5"))


@query("F14_short_prompts", O.sql(f"SELECT id, len({toks('q')})::INT AS n FROM pr WHERE len({toks('q')})<=30", **PAIR))
def f14(spark, sf):
    rows = chats(spark, sf).withColumn("n", F.size(K.words(F.col("messages")[0]["content"])))
    return K.short_prompts(rows, F.col("n"), 30).select("id", "n")


@query("F15_prompt_and_truth", O.sql("SELECT id, q||'/think' AS prompt, a AS ground_truth, 'rule' AS style FROM pr", **PAIR))
def f15(spark, sf):
    r = K.prompt_and_truth(chats(spark, sf), F.col("messages"), "/think")
    return r.select("id", F.array_join(F.col("prompt.content"), "|").alias("prompt"), "reward_model.ground_truth", "reward_model.style")


_FE = ("SELECT conv_id, list(role ORDER BY turn) rl, list(text ORDER BY turn) tx, min(CASE WHEN role='user' THEN turn END) u, min(CASE WHEN role='assistant' THEN turn END) a "
       "FROM conversations GROUP BY conv_id")


@query("F15_first_exchange", O.sql(
    "SELECT conv_id AS chat_id, array_to_string([CASE WHEN z[1]='user' THEN z[2]||CASE md WHEN 1 THEN ' /think' WHEN 2 THEN ' /no_think' ELSE '' END ELSE z[2] END "
    "FOR z IN list_transform(range(1,n), lambda k: [rl[k],tx[k]])],'|') AS prompt, tx[n] AS ground_truth FROM (SELECT *, CASE WHEN u IS NOT NULL AND a IS NOT NULL "
    "THEN (SELECT count(*) FROM conversations c WHERE c.conv_id=fe.conv_id AND c.turn<=greatest(u,a)) ELSE len(rl) END n, " + O.h("42", "'think'", "conv_id") + "%3 md FROM fe) "
    "WHERE n>=2", fe=_FE))
def f15b(spark, sf):
    r = K.first_exchange(TB.chats(spark, sf), F.col("messages"), "auto", F.col("chat_id"))
    return r.select("chat_id", F.array_join(F.col("prompt.content"), "|").alias("prompt"), "reward_model.ground_truth")


@query("F16_source_buckets", "SELECT lang AS data_source, count(*) AS n FROM documents WHERE lang IN ('en','fr') GROUP BY 1")
def f16(spark, sf):
    return K.source_buckets(read(spark, sf, "documents").withColumnRenamed("lang", "data_source"), ("en", "fr"))


@query("F17_benchmark_prompts", O.sql(
    "SELECT id::VARCHAR AS sample_id, '<|im_start|>user'||chr(10)||q||' <|im_end|>'||chr(10)||'<|im_start|>assistant'||chr(10)||a||' <|im_end|>'||chr(10) AS prompt, "
    "CASE WHEN conv_id%4=2 THEN '[1,2]' ELSE 'the answer '||id END AS ground_truth, '{\"uid\":'||id||'}' AS metadata, id AS row_index FROM pr WHERE conv_id%4<>1", **PAIR))
def f17(spark, sf):
    raw = raw_rows(spark, sf)
    answer = F.when(F.col("g") == 1, F.lit('"  "')).when(F.col("g") == 2, F.lit("[1,2]")).otherwise(
        F.concat(F.lit('" the answer '), F.col("id").cast("string"), F.lit(' "')))
    raw = raw.withColumn("g", F.floor(F.col("id") / 100) % 4).withColumn("metadata", F.when(F.col("source") != "chat", "{bad").otherwise(
        F.concat(F.lit('{"answer":'), answer, F.lit(',"uid":'), F.col("id").cast("string"), F.lit("}"))))
    return K.benchmark_prompts(raw, "id")


# ---- vectors ----------------------------------------------------------------------------

_DIM = 64


def _vectors(spark, sf, dim=_DIM):
    return Q.load_embeddings(read(spark, sf, "embeddings"), "vec_id", "embedding", dim)


@query("G1_embedding_load", "SELECT vec_id, len(e)::INT AS dim, " + O.r6("list_sum([x::DOUBLE FOR x IN e])") + " AS total FROM (SELECT vec_id, embedding[1:32] e FROM embeddings)")
def g1(spark, sf):
    return _vectors(spark, sf, 32).select("vec_id", F.size("embedding").alias("dim"), r6(F.aggregate(
        "embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))).alias("total"))


@query("G2_quantizer_training")
def g2(spark, sf):
    """Codes used per layer after training on all vectors."""
    v = cut(_vectors(spark, sf).withColumn("x", F.col("embedding").cast("array<double>")))
    coded = Q.encode(v, "x", Q.train(v, "vec_id", "x", n_layers=3, k=32, max_iter=20))
    return coded.select(F.posexplode("codes").alias("layer", "code")).groupBy("layer", "code").agg(F.count(F.lit(1)).alias("n"))


def _label_codebook(spark, sf):
    """Codebook derived from the data: label means, halved per layer, rounded to four digits."""
    el = read(spark, sf, "embeddings").select("label", F.posexplode(F.slice("embedding", 1, _DIM)).alias("pos", "x"))
    mean = el.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    layers = mean.withColumn("layer", F.explode(F.sequence(F.lit(0), F.lit(2))))
    value = F.round(F.col("m") / F.pow(F.lit(2.0), F.col("layer")), 4)
    rows = layers.groupBy("layer", F.col("label").alias("code")).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", value.alias("v")))), lambda s: s["v"]).alias("centre"))
    return Q.codebook_from_rows(rows, 3)


_CB = dict(
    el="SELECT label, unnest(range(64)) pos, unnest(embedding)::DOUBLE x FROM embeddings",
    mn="SELECT label, pos, avg(x) m FROM el GROUP BY 1,2",
    cb="SELECT layer, label code, list(round(m/pow(2.0::DOUBLE,layer),4) ORDER BY pos) c FROM mn CROSS JOIN (SELECT unnest([0,1,2]) layer) GROUP BY 1,2",
    v0="SELECT vec_id, [x::DOUBLE FOR x IN embedding] x FROM embeddings")


def _layers_sql():
    extra = dict(_CB)
    for i in range(3):
        extra[f"n{i}"] = (f"SELECT vec_id, arg_min(code, (round(list_sum(list_transform(range(1,65), lambda k: (x[k]-c[k])**2)),12), code)) code "
                          f"FROM v{i} JOIN cb ON layer={i} GROUP BY vec_id")
        extra[f"v{i + 1}"] = (f"SELECT vec_id, list_transform(range(1,65), lambda k: x[k]-c[k]) x FROM v{i} JOIN n{i} USING (vec_id) JOIN cb USING (code) WHERE layer={i}")
    return extra


_LAY = _layers_sql()


def _coded(spark, sf):
    v = _vectors(spark, sf).withColumn("x", F.col("embedding").cast("array<double>"))
    book = _label_codebook(spark, sf)
    return Q.encode(v, "x", book), book


def _lloyd_sql(steps=2, layers=2):
    """Lloyd steps from the label means, layer by layer, on what the layer before left over."""
    extra = dict(_CB)
    for la in range(layers):
        extra[f"c{la}_0"] = f"SELECT code, c FROM cb WHERE layer={la}"
        for st in range(steps + 1):
            extra[f"a{la}_{st}"] = (f"SELECT vec_id, any_value(x) x, arg_min(code, (round(list_sum(list_transform(range(1,65), lambda k: (x[k]-c[k])**2)),12), code)) code "
                                    f"FROM v{la} CROSS JOIN c{la}_{st} GROUP BY vec_id")
            extra[f"c{la}_{st + 1}"] = (f"SELECT code, list(m ORDER BY k) c, max(n) n FROM (SELECT code, k, count(*) n, floor(sum(floor(x[k]*1048576+0.5::DOUBLE)::HUGEINT)/1048576::DOUBLE/count(*)*1000000+0.5::DOUBLE)/1000000 m "
                                        f"FROM (SELECT code, x, unnest(range(1,65)) k FROM a{la}_{st}) GROUP BY 1,2) GROUP BY 1")
        extra[f"v{la + 1}"] = f"SELECT vec_id, list_transform(range(1,65), lambda k: x[k]-c[k]) x FROM a{la}_{steps} JOIN c{la}_{steps} USING (code)"
    return extra


@query("G2_lloyd_steps", O.sql(" UNION ALL ".join(
    f"SELECT {la}::INT AS layer, a.code::INT AS code, count(*) AS n, {O.r6('max(list_sum(c.c))')} AS centre_sum, {O.r6('max(c.c[1])')} AS first_value "
    f"FROM a{la}_2 a JOIN c{la}_2 c USING (code) GROUP BY a.code" for la in range(2)), **_lloyd_sql()))
def g2b(spark, sf):
    """Two Lloyd steps a layer from given centres."""
    v = cut(_vectors(spark, sf).withColumn("x", F.col("embedding").cast("array<double>")))
    book = Q.train(v, "vec_id", "x", n_layers=2, k=0, max_iter=2, start=_label_codebook(spark, sf))
    coded = Q.encode(v, "x", book).select(F.posexplode("codes").alias("layer", "code")).groupBy("layer", "code").agg(F.count(F.lit(1)).alias("n"))
    rows = [(la, c, float(x.sum()), float(x[0])) for la, layer in enumerate(book) for c, x in enumerate(layer)]
    sums = spark.createDataFrame(rows, "layer int, code int, centre_sum double, first_value double")
    return coded.join(F.broadcast(sums), ["layer", "code"]).select(
        "layer", "code", "n", r6(F.col("centre_sum")).alias("centre_sum"), r6(F.col("first_value")).alias("first_value"))


@query("G3_encode", O.sql("SELECT vec_id, n0.code||','||n1.code||','||n2.code AS codes FROM n0 JOIN n1 USING (vec_id) JOIN n2 USING (vec_id)", **_LAY))
def g3(spark, sf):
    return _coded(spark, sf)[0].select("vec_id", F.array_join("codes", ",").alias("codes"))


_DEC = dict(_LAY, de="SELECT v0.vec_id, v0.x, list_transform(range(1,65), lambda k: v0.x[k]-v3.x[k]) o FROM v0 JOIN v3 USING (vec_id)")


@query("G4_decode", O.sql("SELECT vec_id, k-1 AS pos, " + O.r6("o[k]") + " AS value FROM (SELECT vec_id, o, unnest(range(1,65)) k FROM de)", **_DEC))
def g4(spark, sf):
    coded, book = _coded(spark, sf)
    d = Q.decode(coded, "codes", book).select("vec_id", F.posexplode("decoded").alias("pos", "v"))
    return d.select("vec_id", F.col("pos").cast("bigint").alias("pos"), r6(F.col("v")).alias("value"))


@query("G5_reconstruction_loss", O.sql(
    "SELECT " + O.r6("avg((b-a)**2)") + " AS loss, " + O.r6("avg(abs(a-b)/(greatest(abs(a),abs(b))+1e-4))") + " AS rel_loss FROM (SELECT unnest(x) a, unnest(o) b FROM de)", **_DEC))
def g5(spark, sf):
    coded, book = _coded(spark, sf)
    loss = Q.reconstruction_loss(Q.decode(coded, "codes", book), "x", "decoded")
    return loss.select(r6(F.col("loss")).alias("loss"), r6(F.col("rel_loss")).alias("rel_loss"))


@query("G6_code_collisions", O.sql(
    "SELECT (n0.code*67108864+n1.code*8192+n2.code)::BIGINT AS packed, vec_id, row_number() OVER (PARTITION BY n0.code,n1.code,n2.code ORDER BY l.n DESC, vec_id) AS ord, l.n AS popularity "
    "FROM n0 JOIN n1 USING (vec_id) JOIN n2 USING (vec_id) JOIN (SELECT user_id, count(*) n FROM events GROUP BY 1) l ON l.user_id=vec_id", **_LAY))
def g6(spark, sf):
    """Items that share an id, most popular first; popularity from the event stream."""
    coded, _ = _coded(spark, sf)
    seen = read(spark, sf, "events").groupBy(F.col("user_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("popularity"))
    rows = coded.select("vec_id", pack(F.col("codes")[0], F.col("codes")[1], F.col("codes")[2]).alias("packed")).join(seen, "vec_id")
    return group_row_numbers(rows, ["packed"], [F.desc("popularity"), F.col("vec_id")], "vec_id", "ord")


@query("G7_dense_retrieval", "WITH u AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE/sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE*y::DOUBLE)))) v FROM embeddings), "
       "s AS (SELECT a.vec_id query_id, b.vec_id doc_id, round(list_sum(list_transform(range(1,65), lambda k: a.v[k]*b.v[k])),6)+0.0 score FROM u a CROSS JOIN u b WHERE a.vec_id%20=0) "
       "SELECT query_id, doc_id, score, \"rank\"::INT AS \"rank\" FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS \"rank\" FROM s) WHERE \"rank\"<=5")
def g7(spark, sf):
    e = read(spark, sf, "embeddings")
    out = R.dense_search(e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")),
                         e.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector")), 5, list_rows=256)
    return out.withColumn("score", r6(F.col("score")))


def _terms(x):
    return f"[w FOR w IN regexp_split_to_array(lower({x}),'\\s+') IF w<>'']"


@query("G8_lexical_retrieval", O.sql(
    "SELECT query_id, doc_id, score, \"rank\"::INT AS \"rank\", string_split(text,chr(10))[1] AS title FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS \"rank\" FROM "
    "(SELECT query_id, doc_id, round(sum(w),6)+0.0 score FROM qt JOIN wt USING (term) GROUP BY 1,2)) JOIN documents USING (doc_id) WHERE \"rank\"<=3 AND score>0",
    dl="SELECT doc_id, " + _terms("text") + " t FROM documents",
    pt="SELECT doc_id, len(t) dlen, unnest(t) term FROM dl",
    tf="SELECT doc_id, dlen, term, count(*) tf FROM pt GROUP BY ALL",
    qt="SELECT item_id query_id, unnest(" + _terms("text") + ") term FROM benchmark",
    dfq="SELECT term, count(*) df FROM tf WHERE term IN (SELECT term FROM qt) GROUP BY 1",
    wt="SELECT doc_id, term, ln(1+(nd-df+0.5::DOUBLE)/(df+0.5::DOUBLE))*tf*1.9::DOUBLE/(tf+0.9::DOUBLE*(1-0.4::DOUBLE+0.4::DOUBLE*dlen/av)) w FROM tf JOIN dfq USING (term) CROSS JOIN "
       "(SELECT count(*) nd, avg(len(t)) av FROM dl)"))
def g8(spark, sf):
    docs = spread(read(spark, sf, "documents").select("doc_id", "text"))
    q = read(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    title, _ = R.title_and_text(F.col("text"))
    best = R.lexical_search(q, docs, 3)
    return best.join(docs, "doc_id").select("query_id", "doc_id", r6(F.col("score")).alias("score"), "rank", title.alias("title"))
