"""Ranked lexical search against a plain scan of all documents."""

from collections import Counter

import pyarrow as pa

import __spark_entry__ as entry
from llm.conftest import EDGE
from parity import compare
from sidweave.llm import queries, strata_search
from sidweave.llm.strata_search import normaliser, terms_of, weight
from sidweave.session import scratch

ITEMS = [(1, "Alpha beta gamma the"), (2, "beta beta"), (3, None), (4, ""), (5, "日本語 tie"), (5, "日本語 tie"), (None, "ab of"), (6, "unknown-words only9")]


def brute(docs, items, k=20):
    counts = [(i, Counter(terms_of(t or ""))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    size, total = len(counts), sum(c.total() for _, c in counts)
    df, out = Counter(t for _, c in counts for t in c), []
    for item, text in items:
        asked, scored = terms_of(text or ""), []
        for i, c in counts:
            m = normaliser(c.total(), size, total)
            score = sum(weight(df[t], size) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in asked if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(str(item), rank, "None" if none else str(i), -s) for rank, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def rows(df):
    return sorted((str(r.item_id), r.rank, str(r.doc_id), r.score) for r in df.collect())


def test_edge_rows(edge, nothing, spark):
    items = spark.createDataFrame([(i, t, 7) for i, t in ITEMS], "item_id bigint, text string, score int")
    assert rows(strata_search.ranked_search(edge, items)) == brute(EDGE, ITEMS)
    assert rows(strata_search.ranked_search(edge, items, k=2, block_chars=10)) == brute(EDGE, ITEMS, 2)
    assert strata_search.ranked_search(nothing, items).count() == 0 == strata_search.ranked_search(edge, items.where("false")).count()


def test_pruned_strata_lose_nothing(spark):
    """Many lengths, hot words, ties and copies; small segments so that bounds stop the visits."""
    import random

    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(300)]
    docs = [(i, " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(300)], k=rng.randint(1, 400)))) for i in range(1500)]
    docs += [(2000 + i, "w0 w5 w9") for i in range(60)] + [(5000, "w1 " * 3000)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for k in range(40)] + [(99, "w0 w5 w9")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    assert rows(strata_search.ranked_search(table, asked)) == brute(docs, items)
    assert rows(strata_search.ranked_search(table, asked, k=3, block_chars=300)) == brute(docs, items, 3)


def test_bounds_skip_strata():
    docs = [(i, "rare " * (40 if i < 30 else 1) + "common " * i) for i in range(400)]
    made = strata_search.segment(pa.array([i for i, _ in docs]), pa.array([t for _, t in docs]), 400, sum(len(terms_of(t)) for _, t in docs))
    part = strata_search.Segment({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in made.items()}, pa.array(["rare"]))
    best, seen = strata_search.Best(20), 0
    import numpy as np
    for found, scores in part.visit(np.array([0]), np.array([5]), best.least):
        seen += len(found)
        best.add(scores, part.ids.take(pa.array(found)))
    assert len(best.scores) == 20 and best.ids.max() < 30 and seen < 200
    every = np.bincount(part.docs, 5 * part.impacts, len(part.ids)).astype(int)
    assert best.scores.tolist() == sorted(every.tolist(), reverse=True)[:20]


def test_index_file_holds_every_row(edge, spark):
    path = scratch(spark, "index")
    size, total = strata_search.build_index(edge, path)
    kept = [t for _, t in EDGE if terms_of(t or "")]
    assert (size, total) == (len(kept), sum(len(terms_of(t)) for t in kept))
    assert sum(len(r.ids) for r in spark.read.parquet(path).collect()) == size


def test_same_rows_as_sql(spark, duck, sf):
    assert compare(spark, duck, queries.QUERIES["op11_strata_search"], entry.oracle_sql()["op11_strata_search"], sf) == ""
