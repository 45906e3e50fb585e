"""Distributed numbering, sampling, joins, packing, balancing and retrieval against brute force."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sidweave.operators import balance as BL
from sidweave.operators import groupstats as G
from sidweave.operators import keyed
from sidweave.operators import labelmetrics as LM
from sidweave.operators import numbering as N
from sidweave.operators import packing as P
from sidweave.operators import quantizer as Q
from sidweave.operators import retrieval as R
from sidweave.operators import rollups as L
from sidweave.operators import sampling as E


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belong to one group."""
    rng = random.Random(1)
    rows = [(i, "hot" if i % 3 == 0 else f"g{i % 17}", float(rng.randrange(50)), rng.choice(["a", "b", "c"])) for i in range(900)]
    return rows, spark.createDataFrame(rows, "row_id bigint, uid string, score double, pred string").repartition(7)


def test_row_numbers(skewed):
    rows, df = skewed
    got = {r.row_id: r.rn for r in N.row_numbers(df, [F.desc("score"), F.col("row_id")]).collect()}
    want = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])))}
    assert got == want


def test_group_row_numbers(skewed, shuffled_joins):
    rows, df = skewed
    got = {r.row_id: r.rn for r in N.group_row_numbers(df, ["uid"], [F.col("score"), F.col("row_id")], "row_id").collect()}
    pdf = pd.DataFrame(rows, columns=["row_id", "uid", "score", "pred"]).sort_values(["uid", "score", "row_id"])
    pdf["rn"] = pdf.groupby("uid").cumcount() + 1
    assert got == dict(zip(pdf["row_id"], pdf["rn"]))


def test_running_sums(skewed):
    rows, df = skewed
    got = {r.row_id: r.s for r in N.running_sums(df, [F.col("row_id")], {"s": F.col("score")}).collect()}
    total = 0.0
    for r in rows:
        assert got[r[0]] == total
        total += r[2]


def test_group_statistics(skewed, shuffled_joins):
    rows, df = skewed
    got = keyed.with_group_stats(df, ["uid"], [F.sum("score").alias("s")]).collect()
    want = pd.DataFrame(rows, columns=["row_id", "uid", "score", "pred"]).groupby("uid")["score"].agg(["sum", "size"])
    assert len(got) == 900
    assert all(r.s == want.loc[r.uid, "sum"] and r.group_rows == want.loc[r.uid, "size"] for r in got)


def test_hot_keys_are_split(spark, shuffled_joins):
    """1500 keys of many rows each and a hotter one: its partition is read by several tasks."""
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1500)
        rows = spark.range(200_000).repartition(16).select(key.alias("k"), "id")
        joined = keyed.lookup_join(rows, spark.range(-1, 1500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), ["k"])
        assert joined.where("v = 2 * k").count() == 200_000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_hot_keys_are_split_before_an_aggregate(spark, shuffled_joins):
    """The same with a group-by on the join's key behind it, which Spark alone would leave in one task."""
    from sidweave.session import SKEW_SETTINGS, prepare

    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in [*small, *SKEW_SETTINGS]}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        plans = {}
        for forced in (False, True):
            if forced:
                prepare(spark)
            key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1500)
            rows = spark.range(200_000).repartition(16).select(key.alias("k"), "id")
            joined = keyed.lookup_join(rows, spark.range(-1, 1500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), ["k"])
            sums = joined.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))
            got = {r.k: (r.n, r.v) for r in sums.collect()}
            assert got[-1] == (66_667, -133_334) and sum(n for n, _ in got.values()) == 200_000
            plans[forced] = sums._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plans[True]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("n", [1, 450, 899, 900, 5000])
def test_exact_sample(skewed, n):
    _, df = skewed
    a = sorted(r.row_id for r in E.sample_exact(df, n, 3, ["row_id"]).collect())
    b = sorted(r.row_id for r in E.sample_exact(df.repartition(3), n, 3, ["row_id"]).collect())
    assert a == b and len(a) == len(set(a)) == min(n, 900)


def test_sample_needs_a_size(skewed):
    with pytest.raises(ValueError):
        E.sample_exact(skewed[1], 0, 3, ["row_id"])


def test_split_and_shuffle_are_permutations(skewed):
    _, df = skewed
    out = E.corpus_split([df.select("row_id")], 100, 5, ["row_id"]).collect()
    assert sorted(r.row_id for r in out) == list(range(900))
    assert sorted(r.rn for r in out if r.part == "test") == list(range(1, 101))
    assert sorted(r.rn for r in out if r.part == "train") == list(range(1, 801))


def test_resample_follows_weights(spark):
    df = spark.createDataFrame([(i, 10.0 if i == 3 else 0.0) for i in range(200)], "row_id bigint, score double")
    drawn = [r.row_id for r in E.resample(df, "row_id", 1).collect()]
    assert len(drawn) == 200 and set(drawn) == {3}
    flat = spark.createDataFrame([(i, 1.0) for i in range(500)], "row_id bigint, score double")
    drawn = [r.row_id for r in E.resample(flat, "row_id", 1).collect()]
    assert len(drawn) == 500 and 250 < len(set(drawn)) < 400


@pytest.mark.parametrize("world,workers", [(1, 1), (1, 4), (2, 2), (4, 2), (2, 8)])
def test_worker_assignment(spark, world, workers):
    files = spark.range(100).withColumnRenamed("id", "position")
    got = E.assign_workers(files, "position", world, workers).collect()
    seats = pd.DataFrame([(r["rank"], r["worker"]) for r in got]).value_counts()
    assert len(got) == 100 and seats.max() - seats.min() <= 1
    assert all(r["rank"] * workers + r["worker"] == r["position"] % (world * workers) for r in got)


def test_epochs_cover_every_file(spark):
    files = spark.range(20).select(F.concat(F.lit("f"), "id").alias("file"))
    out = pd.DataFrame([r.asDict() for r in E.expand_epochs(files, 3, 1).collect()])
    assert len(out) == 60
    orders = [tuple(g.sort_values("position")["file"]) for _, g in out.groupby("epoch")]
    assert all(sorted(o) == sorted(orders[0]) for o in orders) and len(set(orders)) == 3


def test_auc(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(12) / 10, rng.randrange(2)) for _ in range(300)]
    got = LM.auc(spark.createDataFrame(rows, "s double, l int"), "s", "l").first().auc
    pairs = [(p > n) + (p == n) / 2 for p, a in rows if a == 1 for n, b in rows if b == 0]
    assert got == pytest.approx(sum(pairs) / len(pairs))
    assert LM.auc(spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, l int"), "s", "l").first().auc == 0.5
    assert LM.auc(spark.createDataFrame([], "s double, l int"), "s", "l").first().auc == 0.0


def test_ranking_accuracy(spark, shuffled_joins):
    rng = random.Random(3)
    rows = [(i, f"g{i % 4}", float(rng.randrange(6)), rng.choice([0.0, 0.5, 1.0])) for i in range(160)] + [(500, "solo", 1.0, 1.0)]
    got = {r.uid: r.accuracy for r in G.ranking_accuracy(spark.createDataFrame(rows, "row_id bigint, uid string, score double, acc double")).collect()}
    for g in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == g]
        right = total = 0.0
        for i, a in enumerate(mine):
            for b in mine[i + 1:]:
                gap = abs(a[3] - b[3])
                right += gap * ((a[2] > b[2]) == (a[3] > b[3]))
                total += gap
        assert got[g] == pytest.approx(right / total if total else 0.5)


def _plain_accuracy(rows):
    out = {}
    for uid in {r[1] for r in rows}:
        own = [(s, i, a) for i, u, s, a in rows if u == uid]
        pairs = [(x, y) for k, x in enumerate(own) for y in own[k + 1:]]
        total = sum(abs(x[2] - y[2]) for x, y in pairs)
        right = sum(abs(x[2] - y[2]) for x, y in pairs if (x[:2] > y[:2]) == (x[2] > y[2]))
        out[uid] = 0.5 if total == 0 else right / total
    return out


@pytest.mark.parametrize("labels", [2, 3000])
def test_ranking_accuracy_over_many_buckets(spark, labels):
    """One group fills most range buckets; few labels and 3000 distinct ones; ties in score and label."""
    rng = random.Random(labels)
    rows = [(i, "hot" if i % 3 else f"g{i % 11}", float(rng.randrange(400)), rng.randrange(labels) / 7) for i in range(1500)]
    rows += [(5000, "one", 1.0, 1.0), (5001, "same", 1.0, 0.1), (5002, "same", 2.0, 0.1), (5003, "same", 0.0, 0.1), (5004, "same", 3.0, 0.1)]
    df = spark.createDataFrame(rows, "row_id bigint, uid string, score double, acc double").repartition(6)
    got = {r.uid: r.accuracy for r in G.ranking_accuracy(df).collect()}
    want = _plain_accuracy(rows)
    assert got.keys() == want.keys() and all(abs(got[u] - want[u]) < 1e-9 for u in want)


def rollout_rows(spark, rows):
    return spark.createDataFrame(rows, "row_id bigint, uid string, token_rewards array<double>, mask array<int>")


def test_single_member_groups(spark):
    lone = rollout_rows(spark, [(1, "a", [1.0, 2.0], [1, 1])])
    assert G.group_normalised(lone).first().advantage == pytest.approx(3.0, rel=1e-5)
    assert G.leave_one_out(lone).first().advantage == 3.0
    with pytest.raises(Exception, match="two rollouts"):
        G.best_versus_second(lone).collect()
    varied = spark.createDataFrame([(1, "a", 1.0), (2, "b", 1.0), (3, "b", 1.0), (4, "c", 1.0), (5, "c", 2.0)], "row_id bigint, uid string, score double")
    assert sorted(r.row_id for r in G.varied_groups(varied, 10, 2).collect()) == [1, 4, 5]
    assert sorted(r.row_id for r in G.varied_groups(varied, 1, 2).collect()) == [1, 4]  # in arrival order


def test_majority_and_ties(spark):
    df = spark.createDataFrame([("g", 1, "A", 0.9), ("g", 2, "B", 0.8), ("g", 3, "A", 0.7), ("t", 4, "X", 0.1), ("t", 5, "Y", 0.2)],
                               "uid string, row_id bigint, pred string, val double")
    got = {r.uid: r.majority for r in L.majority_value(df, ["uid"], "pred", "val", "row_id").collect()}
    assert got == {"g": 0.9, "t": 0.1}


def test_best_of_two_closed_form(spark):
    df = spark.createDataFrame([("g", float(x)) for x in range(1, 6)], "uid string, v double")
    got = {r.k: r for r in L.best_worst(df, ["uid"], "v").collect()}
    draws = [(a, b) for a in range(1, 6) for b in range(1, 6)]
    assert set(got) == {2, 4, 5}
    assert got[2].best_mean == pytest.approx(np.mean([max(d) for d in draws]))
    assert got[2].best_std == pytest.approx(np.std([max(d) for d in draws]))
    assert got[2].worst_mean == pytest.approx(np.mean([min(d) for d in draws]))


@pytest.mark.parametrize("cut_to_pad", [True, False])
def test_packing_keeps_tokens(spark, cut_to_pad):
    rng = random.Random(4)
    rows = [(i, [i] * rng.randrange(1, 30), f"s{i % 3}") for i in range(120)]
    df = spark.createDataFrame(rows, "id bigint, input_ids array<int>, source string").withColumn(
        "loss_mask", F.transform("input_ids", lambda x: F.lit(1))).withColumn("epoch", F.lit(1.0))
    packs = P.pack_rows(df, ["id"], 64, cut_to_pad, shard_rows=50).collect()
    seen = [x for p in packs for x in p.input_ids[:p.tokens]]
    if not cut_to_pad:
        assert sorted(seen) == sorted(x for r in rows for x in r[1])
    for p in packs:
        assert p.tokens <= 64 and len(p.input_ids) == 64 + 64 == len(p.loss_mask) == len(p.sample_idx)
        assert p.cu_seqlens[0] == 0 and p.cu_seqlens[-1] == 128 and p.cu_seqlens[-2] == p.tokens
        assert sum(p.loss_mask) == p.tokens and p.sample_idx.count(-1) == 128 - p.tokens


def test_span_mask_of_flat_rows():
    """Against a walk along each row: patterns that overlap, starts inside spans, spans that nothing closes, empty rows."""
    from sidweave.operators import tokens as K

    def plain(row, opening, closing):
        mask, at = [0] * len(row), 0
        while at < len(row):
            if opening and row[at:at + len(opening)] == opening:
                first = at + len(opening)
                last = next((e for e in range(first, len(row)) if closing and row[e:e + len(closing)] == closing and e + len(closing) <= len(row)), None)
                stop = len(row) if last is None else last
                mask[first:stop] = [1] * (stop - first)
                at = len(row) if last is None else last + len(closing)
            else:
                at += 1
        return mask

    rng = random.Random(4)
    for opening, closing in (([1], [2]), ([1, 1], [1]), ([1, 2], [2, 1]), ([1, 2, 1], [1, 2]), ([1], [1, 1]), ([], [1]), ([1], [])):
        rows = [[rng.choice([1, 2, 3]) for _ in range(rng.randint(0, 14))] for _ in range(300)]
        edges = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        mask = K._flat_mask(np.array(sum(rows, []), np.int64), edges, np.array(opening, np.int64), np.array(closing, np.int64))
        assert [mask[a:b].tolist() for a, b in zip(edges, edges[1:])] == [plain(r, opening, closing) for r in rows]


def test_bucketed_tables_do_not_move(spark, shuffled_joins):
    """The table side of a lookup has no exchange; the rows are those of the plain join."""
    table = spark.range(500).selectExpr("CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS domain", "id AS pid", "id * 7 AS sid")
    rows = spark.range(3000).selectExpr("id AS row_id", "CASE WHEN id % 5 = 0 THEN 'b' ELSE 'a' END AS domain", "CASE WHEN id % 3 = 0 THEN 4 ELSE id % 600 END AS pid")
    plain = keyed.lookup_join(rows, table, ["domain", "pid"])
    held = keyed.bucketed(table, ["domain", "pid"], 8)
    plan = keyed.lookup_join(rows, held, ["domain", "pid"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan, plan
    got = keyed.lookup_join(rows, held, ["domain", "pid"])
    assert sorted(got.collect()) == sorted(plain.select(*got.columns).collect())


def test_differencing():
    rng = random.Random(5)
    for _ in range(20):
        lengths = [rng.randrange(1, 100) for _ in range(24)]
        for equal in (False, True):
            part = BL.differencing(lengths, 4, equal)
            sums = [sum(n for n, p in zip(lengths, part) if p == k) for k in range(4)]
            assert len(part) == 24 and max(sums) - min(sums) <= max(lengths)
            if equal:
                assert all(part.count(k) == 6 for k in range(4))
    with pytest.raises(ValueError):
        BL.differencing([1], 2)


def test_dense_search(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(60, 8))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id bigint, vector array<double>")
    got = R.dense_search(df.withColumnRenamed("id", "query_id"), df.withColumnRenamed("id", "doc_id"), 4, 16, 16).collect()
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    for q in range(60):
        want = sorted(range(60), key=lambda d: (-s[q, d], d))[:4]
        assert [r.doc_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == want


def test_dense_search_skips_lists_that_cannot_reach(spark):
    """Clusters, one of which holds a third of all rows as copies: the same rows as a full product, most pairs skipped."""
    rng = np.random.default_rng(3)
    hubs = rng.normal(size=(12, 16)) * 4
    v = np.concatenate([np.repeat(hubs[:1], 400, 0), hubs[rng.integers(1, 12, 800)] + rng.normal(size=(800, 16)) * 0.05])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id bigint, vector array<double>")
    queries, corpus = df.where("id % 20 = 0").withColumnRenamed("id", "query_id"), df.withColumnRenamed("id", "doc_id")
    got = sorted((r.query_id, r["rank"], r.doc_id) for r in R.dense_search(queries, corpus, 5, 100, 64).collect())
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = np.round(u[::20] @ u.T, 6)
    assert got == [(20 * q, rank + 1, d) for q in range(60) for rank, d in enumerate(sorted(range(1200), key=lambda d: (-s[q, d], d))[:5])]
    assert R.skipped_share(queries, corpus, 5, 100, 64) > 0.5
    assert R.dense_search(queries, corpus.where("false"), 5).count() == 0 == R.dense_search(queries.where("false"), corpus, 5).count()


def test_lexical_search_in_small_blocks(spark):
    """Blocks, query parts and the bound on them change no row."""
    rng = random.Random(5)
    names = [f"w{k}" for k in range(80)]
    texts = [" ".join(rng.choices(names, [1 / (k + 1) for k in range(80)], k=rng.randint(0, 60))) for _ in range(300)] + [None, "  ", "W1\tw1\nw2"]
    corpus = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    asked = [(k, " ".join(rng.choices(names, k=rng.randint(1, 9)))) for k in range(25)] + [(98, ""), (99, "never seen")]
    queries = spark.createDataFrame(asked, "query_id bigint, text string")
    words = [(t or "").lower().split() for t in texts]
    df = {w: sum(w in x for x in words) for w in names}
    average, want = sum(map(len, words)) / len(words), []
    for q, text in asked:
        scored = []
        for i, x in enumerate(words):
            s = sum(math.log(1 + (len(words) - df[w] + 0.5) / (df[w] + 0.5)) * x.count(w) * 1.9 / (x.count(w) + 0.9 * (0.6 + 0.4 * len(x) / average))
                    for w in text.split() if w in x)
            scored += [(-round(s, 6), i)] * (s > 0)
        want += [(q, rank, i) for rank, (_, i) in enumerate(sorted(scored)[:4], 1)]
    for args in ({}, {"query_terms": 20, "block_bytes": 300}):
        got = sorted((r.query_id, r["rank"], r.doc_id) for r in R.lexical_search(queries, corpus, 4, **args).collect())
        assert got == want
    assert R.lexical_search(queries, corpus.where("false"), 4).count() == 0 == R.lexical_search(queries.where("false"), corpus, 4).count()


def test_quantizer_start_and_empty_centres(spark):
    """Spread-out start: one centre a cluster; a centre without rows takes half of the fullest one; layers in groups."""
    rng = np.random.default_rng(7)
    hubs = rng.normal(size=(6, 8)) * 10
    x = np.round(hubs[rng.integers(0, 6, 600)] + rng.normal(size=(600, 8)) * 0.1, 4)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "key bigint, x array<double>")
    start = Q.start_centres(df, 0, 6, 5)
    assert len({int(((hubs - c) ** 2).sum(1).argmin()) for c in start}) == 6
    assert (start == Q.start_centres(df.repartition(7), 0, 6, 5)).all()
    far = np.concatenate([start[:4], np.full((2, 8), 999.0)])
    new, n = Q.lloyd_step(df, far)
    assert (n[4:] == 0).all() and np.abs(new).max() < 100
    assert (Q.lloyd_step(df, new)[1] > 0).all()
    few = Q.start_centres(df.limit(3), 0, 6, 5)
    assert few.shape == (6, 8)
    book = Q.train(df, "key", "x", n_layers=3, k=6, max_iter=3)
    whole = df.select("x").join(Q.decode(Q.encode(df, "x", book), "codes", book).select("x", "codes", "decoded"), "x").collect()
    one = 6 * 8 * 4  # a layer at a time
    apart = Q.decode(Q.encode(df, "x", book, limit=one), "codes", book, limit=one).collect()
    assert sorted((r.x, r.codes) for r in whole) == sorted((r.x, r.codes) for r in apart)
    assert np.allclose([r.decoded for r in sorted(whole, key=lambda r: r.x)], [r.decoded for r in sorted(apart, key=lambda r: r.x)])
    with pytest.raises(ValueError, match="limit"):
        Q.encode(df, "x", book, limit=one - 1)


def test_quantizer_learns(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(4, 6)) * 5
    x = centres[rng.integers(0, 4, 200)] + rng.normal(size=(200, 6)) * 0.1
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id bigint, x array<double>")
    book = Q.train(df, "id", "x", n_layers=2, k=4, seed=1, max_iter=10)
    again = Q.train(df.repartition(5), "id", "x", n_layers=2, k=4, seed=1, max_iter=10)
    assert all((a == b).all() for a, b in zip(book, again))
    coded = Q.encode(df, "x", book)
    losses = [Q.reconstruction_loss(Q.decode(Q.encode(df, "x", book, n), "codes", book), "x", "decoded").first().loss for n in (1, 2)]
    assert losses[1] < losses[0] < 0.2
    assert coded.select(F.size("codes").alias("n")).distinct().first().n == 2


def test_importance_weight_bounds(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=10).tolist(), rng.normal(size=10).tolist(), [1] * 8 + [0] * 2) for i in range(4)]
    df = spark.createDataFrame(rows, "row_id bigint, old_lp array<double>, rollout_lp array<double>, mask array<int>")
    for level in ("token", "sequence", "geometric"):
        for r in G.importance_weights(df, level, 2.0).collect():
            assert all(0 <= w <= 2.0 for w in r.weights) and r.weights[8:] == [0.0, 0.0]
            if level != "token":
                assert len({round(w, 12) for w in r.weights[:8]}) == 1
    dead = G.importance_weights(df, "token", 2.0, mode="mask", veto=0.9).collect()
    assert all(sum(r.kept_mask) == 0 for r in dead if any(c == 1 for c in r.catastrophic))


def test_greedy_parts():
    from sidweave.operators.balance import least_loaded

    assert least_loaded([5, 1, 1, 1, 9, 2], 2) == [0, 1, 1, 1, 1, 0]
    assert least_loaded([5, 1, 1, 1, 9, 2], 2, equal=True) == [0, 1, 1, 0, 1, 0]
    with pytest.raises(ValueError, match="equal parts"):
        least_loaded([1, 2, 3], 2, equal=True)
