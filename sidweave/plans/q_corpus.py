"""Sources, sinks, validation, sampling and splitting queries (A*, B*, D10, D11, E*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import chat
from ..functions.common import r6, stable_uuid
from ..functions import sid as S
from ..operators import builders as B
from ..operators import quality, sampling
from ..operators.numbering import group_row_numbers
from ..session import read, scratch
from ..sources import files, sinks
from . import oracle as O
from . import testbed as TB
from . import q_builders  # noqa: F401  registers the oracles reused below
from .catalog import ORACLES, query

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def md5_order(seed: int, *ids: str) -> str:
    return f"md5(concat_ws('|','{seed}'," + ",".join(f"({i})::VARCHAR" for i in ids) + "))," + ",".join(ids)


@query("A1_directory_scan", " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS file, count(*) AS n FROM {t}" for t in TABLES))
def a1(spark, sf):
    """Row count of every Parquet file below a directory."""
    # One plan for files of any columns: no column is read, only the file names.
    rows = spark.read.schema(StructType([])).parquet(*files.find_parquet_files(spark, sf))
    table = F.regexp_extract("_metadata.file_path", r"([^/]+\.parquet)(/part-[^/]*)?$", 1)
    return rows.groupBy(table.alias("file")).agg(F.count(F.lit(1)).alias("n"))


@query("A2_path_collector", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def a2(spark, sf):
    paths = files.collect_parquet_files(
        spark, [f"{sf}/orders.parquet", f"{sf}/no_such.parquet", f"{sf}/orders.parquet"])
    return files.load_parquet_files(spark, paths).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("A3_column_union_load", "SELECT * FROM supplier UNION ALL BY NAME SELECT * FROM customer")
def a3(spark, sf):
    return files.load_parquet_files(spark, [f"{sf}/supplier.parquet", f"{sf}/customer.parquet"])


@query("A4_file_list_source", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def a4(spark, sf):
    manifest = scratch(spark, "list.json")
    sinks.write_text(spark, manifest, f'["{sf}/customer.parquet", "{sf}/readme.txt"]')
    return files.load_manifest(spark, manifest).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("A5_generation_results", O.sql(
    "SELECT 'base' AS model_name, 'video' AS task_name, split, t.sample_id, answer AS ground_truth, "
    "coalesce(array_to_string(list(text ORDER BY rk) FILTER (WHERE rk IS NOT NULL),'~'),'') AS generations, "
    "count(rk) AS n FROM truth t LEFT JOIN gen USING (sample_id) GROUP BY ALL"))
def a5(spark, sf):
    """Results written as JSON documents and read back, one row per sample."""
    out = scratch(spark, "results")
    g = TB.generations(spark, sf)
    payload = F.struct("prompt", "generations", F.col("answer").alias("ground_truth"), "logprobs",
                       "output_tokens", "times")
    sinks.write_generations(g.select("model", "task", "split", "sample_id", payload.alias("payload")), out)
    back = files.load_generations(spark, out, multiline=False)
    return back.select("model_name", "task_name", "split", "sample_id", "ground_truth",
                       F.array_join("generations", "~").alias("generations"),
                       F.size("generations").cast("bigint").alias("n"))


def _ordered_collisions(spark, sf):
    rows = TB.sid2pid(spark, sf)
    return group_row_numbers(rows, ["code"], [F.desc("count"), F.col("pid")], "pid").withColumn(
        "ord", F.col("rn") - 1)


_COLL = ('SELECT code::BIGINT AS code, (row_number() OVER (PARTITION BY code ORDER BY "count" DESC, pid) - 1)::BIGINT '
         'AS ord, pid, "count", count_ds FROM sid2pid')


@query("A6_pid_mapping", O.sql(_COLL.replace("::BIGINT AS ord", "::INT AS ord")))
def a6(spark, sf):
    out = scratch(spark, "sid2pid")
    sinks.write_pid_mapping(_ordered_collisions(spark, sf), out)
    return files.load_pid_mapping(spark, out, whole_file=False)


@query("A7_task_split_source", "SELECT item_id, length(text) AS chars FROM benchmark ORDER BY item_id LIMIT 25")
def a7(spark, sf):
    base = scratch(spark, "tasks")
    read(spark, sf, "benchmark").write.parquet(files.task_path(base, "qa", "test"))
    files.load_task(spark, base, "qa", "test", "item_id", 25)
    cached = files.load_task(spark, base, "qa", "test", "item_id", 25)
    return cached.select("item_id", F.length("text").cast("bigint").alias("chars"))


@query("A8_passage_corpus", "SELECT doc_id, md5(text) AS text_md5 FROM documents")
def a8(spark, sf):
    out = scratch(spark, "corpus")
    read(spark, sf, "documents").select("doc_id", "text").write.json(out)
    return files.load_corpus(spark, out, "doc_id bigint, text string").select("doc_id", F.md5("text").alias("text_md5"))


@query("A9_loader_sources", "SELECT source, count(DISTINCT lang) AS shards, count(*) AS nsamples FROM documents GROUP BY 1")
def a9(spark, sf):
    shards = read(spark, sf, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("nsamples"))
    config = shards.groupBy("source").agg(F.collect_list(F.struct(
        F.concat_ws("/", "source", "lang").alias("path"), "nsamples")).alias("shardlist"))
    return files.source_totals(config)


_SHARDS = ("SELECT shard, any_value(shards) AS shards, count(*) AS n, min({k}) AS lo, max({k}) AS hi FROM "
           "(SELECT {k}, ((row_number() OVER (ORDER BY {k})-1)//{m})::INT shard, "
           "ceil(count(*) OVER ()/{m}::DOUBLE)::INT shards FROM {t}) GROUP BY shard")


@query("B1_exact_shards", _SHARDS.format(k="event_id", m=700, t="events"))
def b1(spark, sf):
    """Shards written as files and read back: number, size and key range of each."""
    out = scratch(spark, "shards")
    names = sinks.write_shards(read(spark, sf, "events"), out, 700, [F.col("event_id")])
    name = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)-of-(\d+)\.parquet", 1).cast("int")
    total = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)-of-(\d+)\.parquet", 2).cast("int")
    back = spark.read.parquet(*names).select("event_id", name.alias("shard"), total.alias("shards"))
    return back.groupBy("shard").agg(F.max("shards").alias("shards"), F.count(F.lit(1)).alias("n"),
                                     F.min("event_id").alias("lo"), F.max("event_id").alias("hi"))


@query("B2_manifest_sink", "SELECT 'part-'||lpad(s::VARCHAR,5,'0')||'-of-'||lpad(t::VARCHAR,5,'0')||'.parquet' AS file, "
       "count(*) AS n FROM (SELECT (row_number() OVER (ORDER BY o_orderkey)-1)//4000 s, "
       "ceil(count(*) OVER ()/4000.0)::BIGINT t FROM orders) GROUP BY ALL")
def b2(spark, sf):
    out = scratch(spark, "listed")
    names = sinks.write_shards(read(spark, sf, "orders"), out, 4000, [F.col("o_orderkey")])
    rows = files.load_manifest(spark, sinks.write_manifest(spark, out, names))
    return rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"))


def _general(spark, sf):
    d = read(spark, sf, "documents")
    return d.select(F.lit("general").alias("source"), stable_uuid("general", F.col("doc_id")).alias("uuid"),
                    chat.segments_json(F.col("text")).alias("segments"),
                    chat.meta_json(doc_id=F.col("doc_id")).alias("metadata"))


_MERGED = ("SELECT 'general' source, " + O.uuid("general", "doc_id") + " uuid FROM documents UNION ALL "
           "SELECT 'user_profile', " + O.uuid("user_profile", "uid") + " FROM train WHERE inter_user_profile_with_sid<>''")


@query("B3_merge_and_shard", O.sql(
    "SELECT shard::VARCHAR AS shard, source, count(*) AS n, min(uuid) AS lo, max(uuid) AS hi FROM (SELECT *, "
    "lpad(((row_number() OVER (ORDER BY uuid)-1)//1000)::VARCHAR,5,'0') shard FROM m) GROUP BY ALL", m=_MERGED))
def b3(spark, sf):
    out = scratch(spark, "corpus")
    profiles = B.profile_text_rows(TB.user_meta(spark, sf)).drop("uid")
    manifest = sinks.merge_and_shard(_general(spark, sf), profiles, out, 1000, [F.col("uuid")])
    rows = files.load_manifest(spark, manifest)
    shard = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)-of", 1).alias("shard")
    return rows.groupBy(shard, "source").agg(F.count(F.lit(1)).alias("n"), F.min("uuid").alias("lo"),
                                             F.max("uuid").alias("hi"))


@query("B4_task_sink", O.sql(
    f"SELECT 'sft_item.parquet' AS file, count(*) AS n FROM ({ORACLES['C8_item_rows']}) UNION ALL "
    f"SELECT 'sft_reason.parquet', count(*) FROM ({ORACLES['C10_reason_rows']})"))
def b4(spark, sf):
    out = scratch(spark, "tasks")
    users, ids = TB.user_meta(spark, sf), TB.pid2sid(spark, sf)
    jobs = {
        "item": lambda: B.item_rows(TB.captions(spark, sf), ids),
        "reason": lambda: B.reason_rows(users),
        "video": lambda: B.video_rows(users, ids),
    }
    paths = sinks.run_tasks(jobs, {"item": True, "reason": True, "video": False}, "sft", out)
    return reduce(DataFrame.unionByName, [
        spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n")).select(F.lit(p.split("/")[-1]).alias("file"), "n")
        for p in paths])


@query("B5_rollout_dump", O.sql(
    "SELECT step::INT AS step, count(*) AS n, " + O.r6("sum(score)") + " AS score, min(input) AS lo FROM "
    "(SELECT step, score, row_id::VARCHAR AS input FROM rollouts) GROUP BY 1"))
def b5(spark, sf):
    out = scratch(spark, "dump")
    r = TB.rollouts(spark, sf)
    sinks.dump_rollouts(r.select(F.col("row_id").cast("string").alias("input"), F.col("pred").alias("output"),
                                 "score", "step", F.col("data_source").alias("ground_truth")), out)
    back = spark.read.schema("input string, output string, score double, ground_truth string, step int").json(out)
    return back.groupBy("step").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("score")).alias("score"),
                                    F.min("input").alias("lo"))


@query("B6_debug_sample", O.sql("SELECT sample_id, answer FROM truth ORDER BY sample_id LIMIT 100"))
def b6(spark, sf):
    return sinks.debug_sample(TB.generations(spark, sf).select("sample_id", "answer"))


@query("B7_debug_buckets", O.sql(
    "SELECT CASE WHEN g.n IS NULL THEN 'no_generation' WHEN hit THEN 'passed' ELSE 'failed' END AS bucket, "
    "count(*) AS n FROM truth LEFT JOIN g USING (sample_id) GROUP BY 1",
    g="SELECT sample_id, count(*) n, bool_or(regexp_extract(text,'<s_a_\\d+><s_b_\\d+><s_c_\\d+>')<>'' AND "
      "contains(answer, regexp_extract(text,'<s_a_\\d+><s_b_\\d+><s_c_\\d+>'))) hit FROM gen JOIN truth USING (sample_id) GROUP BY 1"))
def b7(spark, sf):
    g = TB.generations(spark, sf)
    named = F.transform("generations", lambda t: F.regexp_extract(t, S.TRIPLE, 0))
    hit = F.exists(named, lambda t: (t != "") & F.contains(F.col("answer"), t))
    return sinks.bucket_counts(g, F.when(F.size("generations") == 0, "no_generation").when(hit, "passed")
                               .otherwise("failed"))


_RES = ("SELECT 'base' model, 'video' task, split, 'samples' metric, count(*)::DOUBLE AS value FROM truth GROUP BY split")


@query("B9_results_upsert", O.sql(
    "SELECT * FROM old WHERE split NOT IN (SELECT split FROM new) UNION ALL SELECT * FROM new",
    old=_RES, new="SELECT 'base' model, 'video' task, split, 'samples' metric, count(DISTINCT t.sample_id)::DOUBLE AS value "
    "FROM truth t JOIN gen USING (sample_id) WHERE split IN ('building','household') GROUP BY split"))
def b9(spark, sf):
    g = TB.generations(spark, sf)

    def counted(rows):
        return rows.groupBy("model", "task", "split").agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            "model", "task", "split", F.lit("samples").alias("metric"), "value")

    fresh = g.where((F.size("generations") > 0) & F.col("split").isin("building", "household"))
    return sinks.upsert_results(counted(g), counted(fresh))


@query("D10_escape_repair", "SELECT conv_id, turn, " + O.segments("text") + " AS segments FROM conversations")
def d10(spark, sf):
    c = read(spark, sf, "conversations")
    raw = F.to_json(F.array(F.struct(F.lit("text").alias("type"), "text")),
                    {"writeNonAsciiCharacterAsCodePoint": "true"})
    return quality.repair_escapes(c.select("conv_id", "turn", raw.alias("segments")))


@query("D10_byte_repair", "SELECT doc_id, md5(CASE WHEN doc_id%2=0 THEN text||'x' ELSE text END) AS text_md5 FROM documents")
def d10b(spark, sf):
    """Binary cells, every other one with a broken byte sequence in it."""
    broken = F.concat(F.encode("text", "UTF-8"), F.lit(bytearray(b"\xff\xc3")), F.lit(bytearray(b"x")))
    cells = read(spark, sf, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 2 == 0, broken).otherwise(F.encode("text", "UTF-8")).alias("segments"))
    return quality.repair_escapes(cells).select("doc_id", F.md5("segments").alias("text_md5"))


def _contract_input(spark, sf):
    d = read(spark, sf, "documents")
    docs = d.select(
        F.when(F.col("lang") == "en", stable_uuid("doc", F.col("doc_id"))).otherwise(F.md5("text")).alias("uuid"),
        F.when(F.col("n_chars") < 300, "").otherwise(F.col("source")).alias("source"),
        F.when(F.col("n_chars") > 2000, "[1, 2").otherwise('{"a": 1}').alias("metadata"),
        F.lit(None).cast("string").alias("messages"),
        F.to_json(F.array(F.struct(F.when(F.col("lang") == "fr", "image").otherwise("text").alias("type"), "text")))
        .alias("segments"))
    c = read(spark, sf, "conversations")
    chats = c.select(
        stable_uuid("chat", F.col("conv_id")).alias("uuid"), F.lit("chat").alias("source"), F.lit("{}").alias("metadata"),
        F.to_json(F.array(F.struct(
            F.when(F.col("turn") == 5, "tool").otherwise(F.col("role")).alias("role"),
            F.array(F.struct(F.lit("text").alias("type"), "text")).alias("content")))).alias("messages"),
        F.lit(None).cast("string").alias("segments"))
    return docs.unionByName(chats)


@query("D11_contract_report", """WITH r AS (SELECT CASE WHEN n_chars<300 THEN '' ELSE source END source,
 CASE WHEN lang='en' THEN doc_id::VARCHAR ELSE 'm'||md5(text) END id, lang<>'en' bad_id, n_chars<300 bad_src,
 n_chars>2000 bad_meta, false bad_role, lang='fr' bad_seg FROM documents UNION ALL
 SELECT 'chat', 'c'||conv_id, false, false, false, turn=5, false FROM conversations),
 d AS (SELECT source, count(*) dup FROM (SELECT source, id FROM r GROUP BY ALL HAVING count(*)>1) GROUP BY 1)
 SELECT r.source, count(*) AS n, sum(bad_id::INT)::BIGINT AS uuid_form, sum(bad_src::INT)::BIGINT AS source_set,
 sum(bad_meta::INT)::BIGINT AS metadata_object, 0::BIGINT AS message_fields, sum(bad_role::INT)::BIGINT AS roles,
 0::BIGINT AS content_type, sum(bad_seg::INT)::BIGINT AS segment_type, 0::BIGINT AS has_payload,
 coalesce(any_value(dup),0)::BIGINT AS uuid_repeated FROM r LEFT JOIN d ON d.source=r.source GROUP BY 1""")
def d11(spark, sf):
    return quality.contract_report(_contract_input(spark, sf))


@query("E1_exact_sample", f"SELECT event_id FROM events ORDER BY {md5_order(7, 'event_id')} LIMIT 3333")
def e1(spark, sf):
    return sampling.sample_exact(read(spark, sf, "events").select("event_id"), 3333, 7, ["event_id"])


@query("E2_exact_test_split", "SELECT o_orderkey, CASE WHEN rn<=1000 THEN 'test' ELSE 'train' END AS part FROM "
       f"(SELECT o_orderkey, row_number() OVER (ORDER BY {md5_order(42, 'o_orderkey')}) rn FROM orders)")
def e2(spark, sf):
    return sampling.split_exact(read(spark, sf, "orders").select("o_orderkey"), 1000, 42, ["o_orderkey"])


@query("E3_full_shuffle", f"SELECT doc_id, row_number() OVER (ORDER BY {md5_order(1042, 'doc_id')}) AS rn FROM documents")
def e3(spark, sf):
    return sampling.shuffled(read(spark, sf, "documents").select("doc_id"), 1042, ["doc_id"])


_E4 = ["C3_video_rows", "C8_item_rows", "C9_interactive_rows", "C10_reason_rows", "C4_ad_rows"]


@query("E4_corpus_split", "WITH u AS (" + " UNION ALL ".join(
    f"(SELECT source, uuid FROM ({ORACLES[n]}))" for n in _E4) + "), s AS (SELECT *, CASE WHEN row_number() OVER "
    f"(ORDER BY {md5_order(42, 'uuid')})<=1000 THEN 'test' ELSE 'train' END part FROM u) "
    f"SELECT source, uuid, part, row_number() OVER (PARTITION BY part ORDER BY CASE part WHEN 'train' THEN "
    f"md5(concat_ws('|','1042',uuid)) ELSE md5(concat_ws('|','2042',uuid)) END, uuid) AS rn FROM s")
def e4(spark, sf):
    users, ids = TB.user_meta(spark, sf), TB.pid2sid(spark, sf)
    tables = [B.video_rows(users, ids), B.item_rows(TB.captions(spark, sf), ids), B.interactive_rows(users, ids),
              B.reason_rows(users), B.ad_rows(users, ids)]
    return sampling.corpus_split([t.select("source", "uuid") for t in tables], 1000, 42, ["uuid"])


@query("E5_cap_rows", f"SELECT 'first' AS mode, * FROM (SELECT conv_id, turn FROM conversations ORDER BY conv_id*100+turn LIMIT 300) "
       "UNION ALL SELECT 'choice', * FROM (SELECT conv_id, turn FROM conversations "
       f"ORDER BY {md5_order(3, 'conv_id*100+turn')} LIMIT 300)")
def e5(spark, sf):
    c = read(spark, sf, "conversations").select("conv_id", "turn", (F.col("conv_id") * 100 + F.col("turn")).alias("id"))
    first = sampling.cap_rows(c, 300, False, 3, "id").select(F.lit("first").alias("mode"), "conv_id", "turn")
    choice = sampling.cap_rows(c, 300, True, 3, "id").select(F.lit("choice").alias("mode"), "conv_id", "turn")
    return first.unionByName(choice)


@query("E6_ratio_split", "SELECT doc_id, CASE WHEN rn<=floor(0.9::DOUBLE*n) THEN 'train' ELSE 'test' END AS part FROM (SELECT doc_id, "
       f"row_number() OVER (ORDER BY {md5_order(5, 'doc_id')}) rn, count(*) OVER () n FROM documents)")
def e6(spark, sf):
    return sampling.split_ratio(read(spark, sf, "documents").select("doc_id"), 0.9, 5, ["doc_id"])


@query("E7_positional_split", "SELECT o_orderkey, rn, CASE WHEN rn<=floor(n*0.75::DOUBLE) THEN 'first' ELSE 'last' END AS part FROM "
       "(SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) rn, count(*) OVER () n FROM orders)")
def e7(spark, sf):
    return sampling.split_positional(read(spark, sf, "orders").select("o_orderkey"), 0.75, [F.col("o_orderkey")])


@query("E8_repeat_by_source", "SELECT source, doc_id, unnest(range(1, CASE source WHEN 'src1' THEN 20 WHEN 'src2' THEN 4 "
       "ELSE 1 END + 1))::INT AS copy FROM documents")
def e8(spark, sf):
    return sampling.repeat_by_source(read(spark, sf, "documents").select("source", "doc_id"), {"src1": 20, "src2": 4})


_FILES = "SELECT DISTINCT source||'/'||lang AS file FROM documents"


@query("E9_epoch_expansion", "SELECT epoch::INT AS epoch, file, row_number() OVER (PARTITION BY epoch ORDER BY "
       "md5(concat_ws('|','11',epoch::VARCHAR,file)), file) - 1 AS position FROM "
       f"({_FILES}) CROSS JOIN (SELECT unnest([0,1,2]) epoch)")
def e9(spark, sf):
    f = read(spark, sf, "documents").select(F.concat_ws("/", "source", "lang").alias("file")).distinct()
    return sampling.expand_epochs(f, 3, 11)


@query("E10_worker_assignment", "SELECT file, (((rn-1)%8)//4)::INT AS rank, ((rn-1)%4)::INT AS worker FROM "
       f"(SELECT file, row_number() OVER (ORDER BY file) rn FROM ({_FILES}))")
def e10(spark, sf):
    from ..operators.numbering import row_numbers
    f = read(spark, sf, "documents").select(F.concat_ws("/", "source", "lang").alias("file")).distinct()
    placed = row_numbers(f, [F.col("file")]).withColumn("position", F.col("rn") - 1)
    return sampling.assign_workers(placed, "position", 2, 4).select("file", "rank", "worker")


_CONV_KEYS = "SELECT conv_id::VARCHAR uuid, role AS source, 0 epoch, turn FROM conversations"


@query("E11_shuffle_keys", f"SELECT uuid, source, turn, substr(md5(uuid||source||'@ep'||epoch),1,16) AS key FROM ({_CONV_KEYS})")
def e11(spark, sf):
    c = read(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("uuid"),
                                                F.col("role").alias("source"), F.lit(0).alias("epoch"), "turn")
    return c.select("uuid", "source", "turn",
                    sampling.shuffle_key(F.col("uuid"), F.col("source"), F.col("epoch")).alias("key"))


@query("E11_duplicate_keys", f"SELECT uuid, source, epoch, count(*) AS n FROM ({_CONV_KEYS}) GROUP BY ALL HAVING count(*)>1")
def e11b(spark, sf):
    c = read(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("uuid"),
                                                F.col("role").alias("source"), F.lit(0).alias("epoch"))
    return sampling.duplicate_keys(c)


_LEDGER = "SELECT event_type AS file, 0 AS epoch, event_id AS sample_index, value FROM events"


@query("E12_resume_ledger", f"SELECT file, epoch, sample_index FROM ({_LEDGER}) WHERE NOT (value>50 OR file='click' AND value<5)")
def e12(spark, sf):
    rows = read(spark, sf, "events").select(F.col("event_type").alias("file"), F.lit(0).alias("epoch"),
                                            F.col("event_id").alias("sample_index"), "value")
    ledger = sampling.append_ledger(rows.where("value > 50"), rows.where("file = 'click' AND value < 5"))
    return sampling.unread(rows, ledger).select("file", "epoch", "sample_index")


@query("E13_resample_weights", "SELECT event_id, " + ", ".join([
    O.r6("abs(value)**2+1e-8") + " AS pow", O.r6("(value=hi OR value=lo)::INT+1e-8") + " AS max_min",
    O.r6("CASE WHEN value=hi THEN 0.4 ELSE 0.1 END+1e-8") + " AS max_random"]) +
    " FROM events CROSS JOIN (SELECT max(value) hi, min(value) lo FROM events)")
def e13(spark, sf):
    rows = read(spark, sf, "events").select("event_id", F.col("value").alias("score"))
    for method in ("pow", "max_min", "max_random"):
        rows = sampling.resample_weights(rows, method).withColumn(method, r6(F.col("weight"))).drop("weight")
    return rows.drop("score")


@query("E13_resample_draws", O.sql(
    "SELECT draw, arg_max(event_id, start) AS event_id FROM (SELECT draw, l.event_id, start FROM pt ASOF JOIN ln l ON pt.x >= l.start) GROUP BY draw",
    wt="SELECT event_id, greatest(floor((pow(abs(value),2.0::DOUBLE)+1e-8)*pow(10.0::DOUBLE,(18-d)::DOUBLE))::HUGEINT,1) units FROM events CROSS JOIN "
       "(SELECT ceil(log10(sum(pow(abs(value),2.0::DOUBLE)+1e-8))) d FROM events)",
    ln="SELECT event_id, coalesce(sum(units) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0)::HUGEINT start FROM wt",
    pt=f"SELECT event_id draw, (((({O.h('9', chr(39) + 'draw' + chr(39), 'event_id')}>>1)::HUGEINT*2147483648+({O.h('9', chr(39) + 'draw low' + chr(39), 'event_id')}>>1))"
       f"*(SELECT sum(units) FROM wt)::HUGEINT)//4611686018427387904)::HUGEINT x FROM events"))
def e13b(spark, sf):
    rows = read(spark, sf, "events").select("event_id", F.col("value").alias("score"))
    return sampling.resample(rows, "event_id", 9)
