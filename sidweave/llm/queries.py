"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..session import read, scratch
from . import (
    certified_packing, chat_format, edit_decontam, ftrl_toxicity, hat_collocations, rank_array_bpe, repair_ids, rule_quality, secret_novelty,
    simhash_trie, strata_search, threshold_sketch, token_counts,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _op1_oracle() -> str:
    """The same rows from plain string functions; formatted_chars counts the marks and the escapes."""
    def escaped(c: str) -> str:
        marks = " + ".join(f"(length({c}) - length(replace({c}, '{m}', ''))) // {len(m)}" for m in chat_format.CONTROLS)
        return f"length({c}) + length({c}) - length(replace({c}, chr(92), '')) + {marks}"

    said = "'</s>[INST] ok [/INST]'"
    frame = len(chat_format.OPEN) + len(chat_format.CLOSE) + 2
    return f"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', {said} UNION ALL SELECT -1, 1, 'assistant', {said}),
    g AS (
        SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
               coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS learnt,
               CAST(sum({frame} + {escaped('role')} + {escaped('text')}) AS BIGINT) AS formatted_chars
        FROM t GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256, formatted_chars FROM g"""


ORACLES["op1_chat_format"] = _op1_oracle()


@query
def op1_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    said = "'</s>[INST] ok [/INST]'"
    extra = spark.sql(f"SELECT -1L AS conv_id, array(named_struct('role', 'user', 'content', {said}), "
                      f"named_struct('role', 'assistant', 'content', {said})) AS messages")
    layouts = [read(spark, sf, "conversations"), extra]
    turns = [chat_format.canonical(table) for table in layouts]
    return chat_format.digests(chat_format.format_turns(turns[0].unionByName(turns[1])))


@query
def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


@query
def op3_simhash_trie(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash_trie.simhash_classes(read(spark, sf, "documents"), words=4, budget=4)
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op4_edit_decontam(spark: SparkSession, sf: str) -> DataFrame:
    return edit_decontam.leaks(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


@query
def op5_repair_ids(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "repair_ids")
    repair_ids.write_shards(read(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return repair_ids.read_shards(spark, path)


@query
def op6_threshold_sketch(spark: SparkSession, sf: str) -> DataFrame:
    return threshold_sketch.edited_likeness(read(spark, sf, "documents"))


@query
def op7_certified_packing(spark: SparkSession, sf: str) -> DataFrame:
    return certified_packing.best_fit_packing(read(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op8_secret_novelty(spark: SparkSession, sf: str) -> DataFrame:
    return secret_novelty.secret_scan(read(spark, sf, "documents"))


@query
def op9_ftrl_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return ftrl_toxicity.toxicity(read(spark, sf, "documents"), read(spark, sf, "labels"), threshold=0.5)


@query
def op10_rule_quality(spark: SparkSession, sf: str) -> DataFrame:
    return rule_quality.quality(read(spark, sf, "documents"), read(spark, sf, "labels"), threshold=0.3)


@query
def op13_rank_array_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return rank_array_bpe.round_trip(read(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


ORACLES["op11_strata_search"] = r"""
    WITH t AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
    p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
    d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
    s AS (SELECT count(*) AS size, CAST(sum(n) AS BIGINT) AS total FROM d),
    m AS (SELECT doc_id, 100 - 25 + (25 * n * size) // total AS m FROM d, s),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * size + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, size),
    q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    r AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
          FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM r WHERE score > 0 QUALIFY rank <= 20"""


@query
def op11_strata_search(spark: SparkSession, sf: str) -> DataFrame:
    return strata_search.ranked_search(read(spark, sf, "documents"), read(spark, sf, "benchmark"), k=20)


ORACLES["op12_hat_collocations"] = r"""
    WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM d),
    g AS (SELECT lang, unnest(flatten(list_transform(range(1, 5), lambda k:
              list_transform(range(1, greatest(len(ws) - k + 2, 1)), lambda s: ws[s:s + k - 1])))) AS ws FROM p WHERE len(ws) > 0),
    c AS (SELECT lang, ws, count(*) AS f FROM g GROUP BY ALL),
    n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM c WHERE len(ws) = 1 GROUP BY lang),
    often AS (SELECT * FROM c WHERE f >= 30),
    k AS (SELECT lang, ws, f AS a, unnest(range(1, len(ws))) AS k FROM often WHERE len(ws) > 1),
    s AS (SELECT k.lang, k.ws, k.a, k.k, x.f AS l, y.f AS r, CAST((2000000 * CAST(k.a AS HUGEINT)) // (x.f + y.f) AS BIGINT) AS score
          FROM k JOIN often x ON x.lang = k.lang AND x.ws = k.ws[1:k.k] JOIN often y ON y.lang = k.lang AND y.ws = k.ws[k.k + 1:]),
    w AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
    i AS (SELECT lang, f, unnest(flatten(list_transform(range(2, len(ws)), lambda z:
              list_transform(range(1, len(ws) - z + 2), lambda b: ws[b:b + z - 1])))) AS ws FROM often WHERE len(ws) > 2),
    m AS (SELECT lang, ws, max(f) AS f FROM i GROUP BY ALL),
    o AS (SELECT w.lang, array_to_string(w.ws, ' ') AS phrase, a, l, r, score FROM w LEFT JOIN m ON m.lang = w.lang AND m.ws = w.ws
          WHERE m.f IS NULL OR 100 * CAST(m.f AS HUGEINT) < 80 * CAST(a AS HUGEINT))
    SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM o JOIN n ON n.lang = o.lang QUALIFY rank <= 2000"""


@query
def op12_hat_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return hat_collocations.collocations(read(spark, sf, "documents"))
