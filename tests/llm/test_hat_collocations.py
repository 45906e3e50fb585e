"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from llm.conftest import EDGE
from parity import compare
from pyspark.sql import functions as F
from sidweave.llm import hat_collocations as H
from sidweave.llm import queries


def brute(docs, least, top=2000):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, *words[s:s + k]) for s in range(len(words) - k + 1))
    often = {p: a for p, a in f.items() if a >= least}
    out = defaultdict(list)
    for (lang, *w), a in often.items():
        if len(w) < 2:
            continue
        cuts = [(2_000_000 * a // (f[lang, *w[:k]] + f[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        inside = [g for (other, *v), g in often.items() if other == lang and len(v) > len(w) and any(v[s:s + len(w)] == w for s in range(len(v)))]
        if not any(100 * g >= 80 * a for g in inside):
            out[lang].append((-score, -a, " ".join(w).encode(), f[lang, *w[:k]], f[lang, *w[k:]]))
    return sorted((lang, rank, p.decode(), -a, x, y, n[lang], -s) for lang, rows in out.items() for rank, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1))


def rows(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def made_up(rng, n, vocabulary):
    words = [f"w{k}" for k in range(vocabulary)] + ["É", "日本", "a\x00b", "\x1c"]
    for _ in range(n):
        text = "".join(rng.choice(words[:rng.choice([5, 30, len(words)])]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "\r", "!?", ", "]) for _ in range(rng.randint(0, 60)))
        yield rng.choice(["en", "en", "en", "fr", None, ""]), rng.choice([text, text, text.upper(), None if rng.random() < 0.1 else text])


@pytest.mark.parametrize("burst, held", [(1 << 16, 2_000_000), (40, 900)])
def test_equals_a_plain_count(spark, burst, held, monkeypatch):
    monkeypatch.setattr(H, "BURST", burst)
    monkeypatch.setattr(H, "HELD", held)
    docs = [*made_up(random.Random(3), 500, 60), *[("en", "of the same new york city hall.")] * 40, ("en", "hot pair " * 5000)]
    table = spark.createDataFrame([(i, lang, t, 1) for i, (lang, t) in enumerate(docs)], "doc_id bigint, lang string, text string, f int")
    got = rows(H.collocations(table.repartition(5), least=10))
    assert got == brute(docs, 10)
    assert rows(H.collocations(table, least=10, top=7)) == brute(docs, 10, 7)


def test_edge_rows(edge, nothing):
    docs = [("und", t) for _, t in EDGE]
    assert rows(H.collocations(edge.withColumn("lang", F.lit(None).cast("string")), least=2)) == brute(docs, 2)
    assert H.collocations(nothing.withColumn("lang", F.lit("en"))).count() == 0


def test_small_id_space_halves_stretches(monkeypatch):
    """A trie with room for few word ids spills and halves, and its runs add up to the same counts."""
    rng = np.random.default_rng(1)
    words = pa.array([f"x{k}" for k in range(90)])
    code, piece = rng.integers(0, 90, 4000), np.sort(rng.integers(0, 300, 4000))
    marks = np.full(1 << H.MAP_BITS - 6, (1 << 64) - 1, np.uint64)

    def total(room):
        trie = H.HatTrie("en", marks, 3)
        monkeypatch.setattr(trie, "_stretch", limited(trie, room))
        found = Counter()
        for part, run in [*trie.add(words, code, piece), *trie.spill(0)]:
            own, places, counts = H.unpacked(run)
            assert (np.lexsort(places.T[::-1]) == np.arange(len(places))).all() and own == sorted(own)
            for p, c in zip(places.tolist(), counts.tolist()):
                found[part, *(own[k - 1] for k in p if k)] += c
        return found

    def limited(trie, room):
        inner = type(trie)._stretch

        def run(texts, found, often, place, piece, begin, end):
            if end - begin > room:
                middle = (begin + end) // 2
                yield from run(texts, found, often, place, piece, begin, middle)
                yield from trie.spill(0)
                yield from run(texts, found, often, place, piece, middle, end)
            else:
                yield from inner(trie, texts, found, often, place, piece, begin, end)
        return run

    assert total(10**9) == total(70)


def test_containers_burst_at_word_borders(monkeypatch):
    monkeypatch.setattr(H, "BURST", 50)
    rng, tree, want = np.random.default_rng(2), H.Subtree(), Counter()
    for _ in range(30):
        ids = np.minimum(rng.zipf(1.4, (200, 4)), 400).astype(np.uint64)
        keys = (ids << H.SHIFTS).sum(1, dtype=np.uint64)
        want.update(keys.tolist())
        tree.add(keys)
    got = Counter()
    lows = tree.lows.tolist()
    assert lows == sorted(set(lows)) and len(lows) > 20 and max(leaf.depth for leaf in tree.leaves) > 1
    for leaf, low, above in zip(tree.leaves, lows, [*lows[1:], 1 << 64]):
        leaf.count()
        got.update(dict(zip(leaf.keys.tolist(), leaf.counts.tolist())))
        assert all(low <= k < above for k in leaf.keys.tolist())
    assert got == want


def test_bitmap_hash_is_sparks(spark):
    words = ["a", "é", "日本語", "x" * 40, ""]
    df = spark.createDataFrame([("fr", w) for w in words], "lang string, word string").select(F.xxhash64("lang", "word").alias("h"))
    assert [r.h for r in df.collect()] == H.hashes("fr", words).astype(np.int64).tolist()


def test_same_rows_as_sql(spark, duck, sf):
    assert compare(spark, duck, queries.QUERIES["op12_hat_collocations"], entry.oracle_sql()["op12_hat_collocations"], sf) == ""
