"""Majorities of hashed draws: many groups at once, the same as draw by draw."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from sidweave.functions import digests
from sidweave.operators import resampling
from sidweave.operators import rollups as L


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_many_groups_are_resampled_together(spark, monkeypatch):
    """By a count of single draws; groups that go to several tasks give the same. Tasks are not joined for their few bytes."""
    rng = np.random.default_rng(5)
    sizes = [1, 2, 3, 3, 8, 9, 29, 33, 33, 70, 140] + [int(n) for n in rng.integers(1, 20, 40)]
    rows = [(100 * g + i, f"é{g}" * (1 + 30 * (g % 7 == 0)), g % 2, float(v) if v else None, "abcdefgh"[p] if p < 8 else None)
            for g, n in enumerate(sizes) for i, (v, p) in enumerate(zip(rng.integers(0, 5, n), rng.integers(0, 9, n)))]
    rows = [(*r[:4], f"{r[0]}" if r[1].startswith("é9") else r[4]) for r in rows]
    votes = spark.createDataFrame(rows, "row_id bigint, source string, uid int, score double, pred string").repartition(3)

    def found():
        out = L.majority_bootstrap(votes, ["source", "uid"], "pred", "score", "row_id", 17, trials=23)
        return {(r.source, r.uid, r.k): (r.maj_mean, r.maj_std) for r in out.collect()}

    groups, expected = {}, {}
    for row_id, source, uid, score, pred in rows:
        groups.setdefault((source, uid), []).append((pred, score))
    for (source, uid), of in groups.items():
        n = len(of)
        for k in [2 ** i for i in range(1, 9) if 2 ** i < n] + [n] * (n > 1):
            won = []
            for t in range(23):
                h = int(hashlib.md5(f"17|{source}|{uid}|{k}|{t}".encode()).hexdigest()[:8], 16)
                drawn = [of[(h * (2 * j + 1) + j * j * 40503) % 2147483647 % n] for j in range(1, k + 1)]
                count = Counter(p for p, _ in drawn)
                won.append(next(v for p, v in drawn if count[p] == max(count.values())))
            known = np.array([v for v in won if v is not None])
            expected[source, uid, k] = (known.mean(), known.std()) if len(known) else (None, None)

    def same(got):
        assert got.keys() == expected.keys()
        for key, pair in expected.items():
            assert got[key] == pair if pair[0] is None else np.allclose(got[key], pair, atol=1e-9), key

    whole = optimized(L.majority_bootstrap(votes, ["source", "uid"], "pred", "score", "row_id", 17, trials=23))
    assert "FlatMapGroupsInArrow" not in whole and re.search(r"RepartitionByExpression \[source#\d+, uid#\d+\], \d+", whole)
    same(found())
    monkeypatch.setattr(L, "PART_VOTES", 8)  # a group of 140 votes has 18 parts
    assert "Generate explode(sequence(0" in optimized(L.majority_bootstrap(votes, ["source", "uid"], "pred", "score", "row_id", 17, trials=23))
    same(found())


def test_runs_of_groups_end_between_groups(monkeypatch):
    """The same for any cut of the rows into batches, runs and steps."""
    rng = np.random.default_rng(6)
    sizes = [50, 1, 3, 3, 90, 2, 7, 40, 3, 64]
    at = np.concatenate([np.arange(1, n + 1) for n in sizes]).astype(np.int32)
    table = pa.table({"g": np.repeat(np.arange(len(sizes)), sizes), "_part": np.zeros(len(at), np.int32), "_parts": np.ones(len(at), np.int32), "_at": at,
                      "_key": pa.array([f"17|{i}" for i in range(len(at))], mask=at > 1), "_p": pa.array(rng.integers(0, 6, len(at)), mask=rng.random(len(at)) < 0.2),
                      "_v": pa.array(rng.random(len(at)), mask=rng.random(len(at)) < 0.2)})

    def found(rows):
        out = pa.Table.from_batches(resampling.resampled(["g"], 30)(iter(table.to_batches(max_chunksize=rows))))
        return {(r["g"], r["k"]): (r["_count"], round(r["maj_mean"], 9), round(r["maj_std"], 9)) for r in out.to_pylist()}

    lies = found(1000)
    assert {k for g, k in lies if g == 4} == {2, 4, 8, 16, 32, 64, 90} and not any(g == 1 for g, _ in lies)
    for name, value in (("RUN_VOTES", 60), ("RUN_HASHES", 3), ("RUN_TRIALS", 50), ("STEP_CELLS", 40), ("TABLE_CELLS", 0), ("FEW", 2)):
        monkeypatch.setattr(resampling, name, value)
        assert found(1000) == found(7) == found(50) == lies, name


def test_numbers_behind_heads_are_hashed_as_one_by_one():
    heads = [b"x" * i for i in range(80)] + ["é|7|".encode(), b"17|view|3|2|"]
    for count in (1, 10, 11, 1001):
        one = [[int(hashlib.md5(h + str(i).encode()).hexdigest()[:8], 16) for i in range(count)] for h in heads]
        assert digests.numbered_hashes(heads, digests.numbered_tails(count)).tolist() == one
