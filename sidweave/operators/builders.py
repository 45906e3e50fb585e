"""User rows to training rows.

Every builder slices a user's arrays first (a bounded number of ids per row), explodes all
arrays of the row into one tagged id list, joins that list once against the id map and
regroups once per row. `uid` is the primary key of the user table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import chat
from ..functions.common import fill, head, mask_select, non_blank, non_empty, pick, pick_index, stable_uuid, tail
from ..functions.sid import CODE_RANGE, LAYER_LETTERS, SID_BEGIN, SID_END, sid_text, token_id
from . import templates as T
from .keyed import lookup_join
from .labelmetrics import NO, YES

SEED = 42
MAX_HIST, MAX_TARGET = 512, 10
MAX_CROSS_VIDEO, MAX_AD, MAX_GOODS = 100, 200, 100
MAX_LABEL = 10
EVENTS = list(T.EVENT_NAMES)


def training_users(users: DataFrame) -> DataFrame:
    """Rows of the training split; a table without the column counts as all-training."""
    return users.where(F.col("split") == 0) if "split" in users.columns else users


def _tag(slot: str, arr: Column, domain: str) -> Column:
    ids = F.coalesce(arr, F.array().cast("array<bigint>"))
    return F.transform(ids, lambda p, i: F.struct(
        F.lit(slot).alias("slot"), F.lit(domain).alias("domain"), i.alias("pos"), p.alias("pid")))


def sequences_to_sids(rows: DataFrame, keys: list[str], slots: dict[str, tuple[Column, str]],
                      sid_map: DataFrame, lists: tuple[str, ...] = ()) -> DataFrame:
    """Replace id arrays by concatenated SID text, one output column per slot.

    `slots` maps an output name to (id array, domain); `sid_map` has domain, pid, sid.
    Unmapped ids vanish, duplicates and order stay, a slot without mapped id is ''.
    Slots named in `lists` stay arrays of (pos, sid_text). Only rows with at least one mapped
    id come back.
    """
    tagged = F.flatten(F.array(*[_tag(name, arr, domain) for name, (arr, domain) in slots.items()]))
    ids = rows.select(*keys, F.explode(tagged).alias("x")).select(*keys, "x.*").where("pid IS NOT NULL")
    mapping = sid_map.select("domain", "pid", F.struct(*[F.col("sid")[i].alias(x) for i, x in enumerate(LAYER_LETTERS)]).alias("codes"))
    hits = lookup_join(ids, mapping, ["domain", "pid"])

    def ordered(name: str) -> Column:
        # Codes are regrouped and become text behind it: a row's partial lists are shuffled.
        found = F.collect_list(F.when(F.col("slot") == name, F.struct("pos", "codes")))
        return F.array_sort(F.transform(found, lambda x: F.struct(x["pos"].alias("pos"), sid_text([x["codes"][c] for c in LAYER_LETTERS]).alias("sid_text"))))

    return hits.groupBy(*keys).agg(*[
        (ordered(n) if n in lists else F.array_join(F.transform(ordered(n), lambda s: s["sid_text"]), "")).alias(n)
        for n in slots
    ])


def chat_rows(df: DataFrame, task: str, keys: list[str], query: Column, answer: Column,
              metadata: Column, keep: list[str] | None = None) -> DataFrame:
    ids = [F.col(k) for k in keys]
    system = pick(T.SYSTEM[task], SEED, task, *ids, "system") if task in T.SYSTEM else None
    return df.select(
        *(keep or keys),
        F.lit(task).alias("source"),
        stable_uuid(task, *ids).alias("uuid"),
        chat.chat_json(query, answer, system).alias("messages"),
        metadata.alias("metadata"),
    )


def text_rows(df: DataFrame, task: str, keys: list[str], text: Column, metadata: Column) -> DataFrame:
    return df.select(
        *keys,
        F.lit(task).alias("source"),
        stable_uuid(task, *[F.col(k) for k in keys]).alias("uuid"),
        chat.segments_json(text).alias("segments"),
        metadata.alias("metadata"),
    )


def video_rows(users: DataFrame, sid_map: DataFrame, max_hist: int = MAX_HIST,
               max_target: int = MAX_TARGET) -> DataFrame:
    """Next-video chat rows; a row needs mapped history and mapped target."""
    task = "video"
    slots = {
        "hist": (tail(F.col("hist_video_pid"), max_hist), "video"),
        "target": (head(F.col("target_video_pid"), max_target), "video"),
    }
    s = sequences_to_sids(training_users(users), ["uid"], slots, sid_map).where("hist <> '' AND target <> ''")
    uid = F.col("uid")
    query = fill(T.VIDEO, {"hist": F.col("hist")}, SEED, task, uid, "prompt")
    return chat_rows(s, task, ["uid"], query, F.col("target"), chat.meta_json(uid=uid))


def _labelled(task: str, part: str, col: str) -> Column:
    """A part of the history behind a wording picked for this user and part."""
    lead = pick(T.LEADS[part], SEED, task, F.col("uid"), part)
    return F.when(F.col(col) != "", F.concat(lead, F.col(col)))


def _cross_domain_rows(users: DataFrame, sid_map: DataFrame, task: str, wording: list[str], domain: str,
                       hist_col: str, target_col: str, part: str, max_video: int, max_hist: int,
                       max_target: int) -> DataFrame:
    slots = {
        "video": (tail(F.col("hist_longview_video_list"), max_video), "video"),
        "hist": (tail(F.col(hist_col), max_hist), domain),
        "target": (head(F.col(target_col), max_target), domain),
    }
    s = sequences_to_sids(training_users(users), ["uid"], slots, sid_map)
    s = s.where("target <> '' AND (video <> '' OR hist <> '')")
    parts = F.concat_ws("\n", _labelled(task, "video", "video"), _labelled(task, part, "hist"))
    uid = F.col("uid")
    query = fill(wording, {"hist": parts}, SEED, task, uid, "prompt")
    return chat_rows(s, task, ["uid"], query, F.col("target"), chat.meta_json(uid=uid))


def ad_rows(users: DataFrame, sid_map: DataFrame, max_video: int = MAX_CROSS_VIDEO, max_hist: int = MAX_AD,
            max_target: int = MAX_TARGET) -> DataFrame:
    """Cross-domain ad rows: long-view videos and ad clicks, either part may be missing.
    Ads live in the video id map."""
    return _cross_domain_rows(users, sid_map, "ad", T.AD, "video", "hist_ad_pid", "target_ad_pid",
                              "ad", max_video, max_hist, max_target)


def product_rows(users: DataFrame, sid_map: DataFrame, max_video: int = MAX_CROSS_VIDEO,
                 max_hist: int = MAX_GOODS, max_target: int = MAX_TARGET) -> DataFrame:
    """As ad_rows, with goods looked up in the product id map."""
    return _cross_domain_rows(users, sid_map, "product", T.PRODUCT, "product", "hist_goods_pid",
                              "target_goods_pid", "goods", max_video, max_hist, max_target)


def _positive_slots(max_label: int) -> dict[str, tuple[Column, str]]:
    pids = F.col("hist_video_pid")
    return {
        f"h_{e}": (tail(mask_select(pids, F.col(f"hist_video_{e}")), max_label), "video") for e in EVENTS
    }


def _event_history(task: str) -> Column:
    return F.concat_ws("\n", *[_labelled(task, e, f"h_{e}") for e in EVENTS])


def label_cond_rows(users: DataFrame, sid_map: DataFrame, max_label: int = MAX_LABEL,
                    max_target: int = MAX_TARGET) -> DataFrame:
    """Label-conditioned rows: the outcome is picked by hash among those with a positive target."""
    task = "label_cond"
    targets = F.col("target_video_pid")
    positives = {e: mask_select(targets, F.col(f"target_video_{e}")) for e in EVENTS}
    offered = F.filter(
        F.array(*[F.when(F.size(positives[e]) > 0, F.lit(e)) for e in EVENTS]), lambda x: x.isNotNull()
    )
    rows = training_users(users).withColumn("_offered", offered).where(F.size("_offered") > 0)
    at = pick_index(F.size("_offered"), SEED, task, F.col("uid"), "event")
    rows = rows.withColumn("event", F.get("_offered", at))
    chosen = reduce(lambda acc, e: acc.when(F.col("event") == e, positives[e]), EVENTS[1:],
                    F.when(F.col("event") == EVENTS[0], positives[EVENTS[0]]))
    slots = {**_positive_slots(max_label), "target": (head(chosen, max_target), "video")}
    s = sequences_to_sids(rows, ["uid", "event"], slots, sid_map)
    s = s.withColumn("hist", _event_history(task)).where("hist <> '' AND target <> ''")
    name = reduce(lambda acc, e: acc.when(F.col("event") == e, T.EVENT_NAMES[e]), EVENTS[1:],
                  F.when(F.col("event") == EVENTS[0], T.EVENT_NAMES[EVENTS[0]]))
    uid = F.col("uid")
    query = fill(T.LABEL_COND, {"hist": F.col("hist"), "label": name}, SEED, task, uid, "prompt")
    meta = chat.meta_json(uid=uid, target_interaction=F.col("event"))
    return chat_rows(s, task, ["uid"], query, F.col("target"), meta)


def _labelled_candidates(slot: str, label: int) -> Column:
    return F.transform(slot, lambda c: F.struct(
        c["pos"].alias("pos"), c["sid_text"].alias("cand"), F.lit(label).alias("label")))


def label_pred_rows(users: DataFrame, sid_map: DataFrame, max_label: int = MAX_LABEL,
                    max_target: int = MAX_TARGET) -> DataFrame:
    """Point-wise rows: one per mapped candidate among the first targets; the answer is the character
    that the label metrics read for a long view or none."""
    task = "label_pred"
    base = training_users(users).where(
        F.size("target_video_pid") == F.size("target_video_longview")
    )
    pid, mask = head(F.col("target_video_pid"), max_target), head(F.col("target_video_longview"), max_target)
    # History and candidates share one id lookup; NULL keeps a candidate's place in the other slot.
    slots = {
        **_positive_slots(max_label),
        "yes": (F.zip_with(pid, mask, lambda p, m: F.when(m == 1, p)), "video"),
        "no": (F.zip_with(pid, mask, lambda p, m: F.when(m == 1, F.lit(None)).otherwise(p)), "video"),
    }
    s = sequences_to_sids(base, ["uid"], slots, sid_map, lists=("yes", "no"))
    s = s.withColumn("hist", _event_history(task)).where("hist <> ''")
    label = F.col("label")
    sides = [_labelled_candidates("yes", 1), _labelled_candidates("no", 0)]
    rows = s.select("uid", "hist", F.explode(F.concat(*sides)).alias("c")).select("uid", "hist", "c.*")
    uid = F.col("uid")
    query = fill(T.LABEL_PRED, {"hist": F.col("hist"), "cand": F.col("cand")}, SEED, task, uid,
                 F.col("pos"), "prompt")
    answer = F.when(label == 1, YES).otherwise(NO)
    meta = chat.meta_json(uid=uid, label=label)
    return chat_rows(rows, task, ["uid", "pos"], query, answer, meta, keep=["uid", "pos", "label"])


def label_tally(label_rows: DataFrame) -> DataFrame:
    return label_rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def captioned_items(captions: DataFrame, sid_map: DataFrame) -> DataFrame:
    """pid, sid text and caption of mapped items with a caption."""
    mapping = sid_map.where("domain = 'video'").select("pid", sid_text(F.col("sid")).alias("sid_text"))
    return captions.where(non_empty(F.col("dense_caption"))).join(mapping, "pid")


def item_rows(captions: DataFrame, sid_map: DataFrame) -> DataFrame:
    """Item-understanding chat rows."""
    task = "item_understand"
    pid = F.col("pid")
    query = fill(T.ITEM, {"sid": F.col("sid_text")}, SEED, task, pid, "prompt")
    return chat_rows(captioned_items(captions, sid_map), task, ["pid"], query, F.col("dense_caption"),
                     chat.meta_json(pid=pid, sid=F.col("sid_text")))


def item_text_rows(captions: DataFrame, sid_map: DataFrame) -> DataFrame:
    """Item-understanding text rows in one of three layouts, the last one a JSON object."""
    task = "item_text"
    sid, caption, pid = F.col("sid_text"), F.col("dense_caption"), F.col("pid")
    layouts = [fill([option], {"sid": sid, "caption": caption}, pid) for option in T.ITEM_TEXT]
    layouts.append(F.to_json(F.struct(sid.alias("item"), caption.alias("caption"))))
    at = pick_index(len(layouts), SEED, task, pid, "layout")
    text = F.when(at == 0, layouts[0]).when(at == 1, layouts[1]).otherwise(layouts[2])
    return text_rows(captioned_items(captions, sid_map), task, ["pid"], text,
                     chat.meta_json(pid=pid, sid=sid))


def keyword_items(users: DataFrame) -> DataFrame:
    """One row per (user, keyword) of the keyword map; unparsable maps yield nothing."""
    col = F.col("inter_keyword_to_items")
    parsed = F.from_json(col, "map<string,array<bigint>>") if dict(users.dtypes)[
        "inter_keyword_to_items"] == "string" else col
    rows = users.where(non_empty(F.col("inter_user_profile_with_sid")))
    rows = rows.select("uid", F.col("inter_user_profile_with_sid").alias("profile"),
                       F.explode(parsed).alias("keyword", "items"))
    return rows.where(non_empty(F.col("keyword")) & (F.size("items") > 0))


def interactive_rows(users: DataFrame, sid_map: DataFrame, max_target: int = MAX_TARGET) -> DataFrame:
    task = "interactive"
    rows = keyword_items(training_users(users))
    keys = ["uid", "keyword"]
    slots = {"target": (head(F.col("items"), max_target), "video")}
    s = sequences_to_sids(rows, [*keys, "profile"], slots, sid_map).where("target <> ''")
    uid, keyword = F.col("uid"), F.col("keyword")
    query = fill(T.INTERACTIVE, {"profile": F.col("profile"), "keyword": keyword}, SEED, task, uid,
                 keyword, "prompt")
    return chat_rows(s, task, keys, query, F.col("target"), chat.meta_json(uid=uid, keyword=keyword))


def reason_rows(users: DataFrame) -> DataFrame:
    """Explanation rows; a missing history caption is written as None."""
    task = "rec_reason"
    rows = training_users(users).where(
        non_blank(F.col("inter_user_profile_with_sid"))
        & non_blank(F.col("reco_target_caption")) & non_blank(F.col("reco_cot"))
    )
    uid = F.col("uid")
    values = {
        "profile": F.col("inter_user_profile_with_sid"),
        "hist": F.coalesce(F.col("reco_gsu_caption"), F.lit("None")),
        "target": F.col("reco_target_caption"),
    }
    query = fill(T.REASON, values, SEED, task, uid, "prompt")
    return chat_rows(rows, task, ["uid"], query, F.col("reco_cot"),
                     chat.meta_json(uid=uid, target_pid=F.col("target_pid")))


def sequence_text_rows(users: DataFrame, sid_map: DataFrame, max_hist: int = MAX_HIST,
                       max_target: int = MAX_TARGET) -> DataFrame:
    task = "video_text"
    slots = {
        "hist": (tail(F.col("hist_video_pid"), max_hist), "video"),
        "target": (head(F.col("target_video_pid"), max_target), "video"),
    }
    s = sequences_to_sids(training_users(users), ["uid"], slots, sid_map).where("hist <> '' AND target <> ''")
    return text_rows(s, task, ["uid"], F.concat("hist", "target"), chat.meta_json(uid=F.col("uid")))


def profile_text_rows(users: DataFrame) -> DataFrame:
    """Profile text passes through; only NULL and '' are dropped, blanks stay."""
    task = "user_profile"
    rows = training_users(users).where(non_empty(F.col("inter_user_profile_with_sid")))
    return text_rows(rows, task, ["uid"], F.col("inter_user_profile_with_sid"),
                     chat.meta_json(uid=F.col("uid")))


def itemic_vocabulary(spark: SparkSession) -> DataFrame:
    """Layer-major code tokens, then the two marks; a fixed 3 * 8192 + 2 rows."""
    layers = len(LAYER_LETTERS)
    n = F.col("id")
    layer = F.floor(n / CODE_RANGE).cast("int")
    code = (n % CODE_RANGE).cast("int")
    letter = F.get(F.array(*[F.lit(x) for x in LAYER_LETTERS]), layer)
    mark = F.when(code == 0, SID_BEGIN).otherwise(SID_END)
    token = F.when(layer < layers, F.concat(F.lit("<s_"), letter, F.lit("_"), code.cast("string"), F.lit(">")))
    return spark.range(layers * CODE_RANGE + 2).select(
        layer.alias("layer"), code.alias("code"),
        token_id(F.lit(0), n).alias("token_id"), F.coalesce(token, mark).alias("token"))
