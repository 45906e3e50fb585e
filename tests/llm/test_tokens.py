"""Token counts, id shards and packing against the libraries' own results on whole texts."""

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm.conftest import EDGE
from sidweave.llm import _crc, certified_packing, repair_ids, token_counts
from sidweave.llm._memo import memo
from sidweave.session import scratch

FILES = {"byte": "byte_bpe_50k.json", "word": "word_bpe_49k.json", "piece": "piece_bpe_32k.model"}
PARTS = ["a", "b", " ", " ", "\n", "\t", ".", ",", "'s", "Ä", "ñ", "　", "<|endoftext|>", "</s>", "▁", "9", "I", "İ", "Σ", "The", " the", " ",
         "\x1c", "̸", "日本"]


@pytest.mark.parametrize("kind", FILES)
def test_memo_gives_the_librarys_ids(path, kind):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(6000)] + [t or "" for _, t in EDGE]
    m = memo(kind, path(FILES[kind]))
    for _ in range(2):  # the second time from the memo
        flat, edges = m.ids(pa.array(texts))
        assert [flat[a:b].tobytes() for a, b in zip(edges, edges[1:])] == m.call(texts)


@pytest.mark.parametrize("chunk, overlap", [(16_384, 256), (700, 8)])
def test_token_counts(spark, sf, edge, path, chunk, overlap):
    sp = sentencepiece.SentencePieceProcessor(model_file=path(FILES["piece"]))
    more = ["a" * 3000, "x  y" * 800, " " * 2000, "▁a b" * 600, "\n\n z" * 800, "ñandú 　é" * 500]
    docs = edge.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(more)], "doc_id bigint, text string"))
    got = token_counts.token_counts(docs, path(FILES["piece"]), limit=50, chunk=chunk, overlap=overlap).collect()
    want = [(i, len((t or "").encode()), len(sp.encode(t or ""))) for i, t in [*EDGE, *((100 + i, t) for i, t in enumerate(more))]]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == sorted((str(i), b, n) for i, b, n in want)
    assert all(r.over_limit == (r.n_tokens > 50) for r in got)


def test_empty_tables(nothing, path, spark):
    assert token_counts.token_counts(nothing, path(FILES["piece"])).count() == 0
    assert certified_packing.best_fit_packing(nothing, path(FILES["word"])).count() == 0
    where = scratch(spark, "none")
    repair_ids.write_shards(nothing, path(FILES["byte"]), where)
    assert repair_ids.read_shards(spark, where).count() == 0


@pytest.mark.parametrize("block", [1 << 18, 1000])
def test_shards_give_back_all_ids(spark, edge, path, block):
    where = scratch(spark, "ids")
    repair_ids.write_shards(edge, path(FILES["byte"]), where, block=block)
    got = sorted((r.start, str(r.doc_id), r.n_tokens, r.ids_crc32) for r in repair_ids.read_shards(spark, where).collect())
    lib, want, at = Tokenizer.from_file(path(FILES["byte"])), [], 0
    for i, t in sorted(EDGE, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = np.append(np.array(lib.encode(t or "", add_special_tokens=False).ids, np.int64), 0).astype("<u4")
        want.append((at, str(i), len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(3)
    for ids in (np.zeros(0, np.uint32), np.zeros(1, np.uint32), np.full(5001, 7, np.uint32), rng.integers(0, 9, 20_000).astype(np.uint32),
                np.tile(rng.integers(0, 50_000, 300), 40).astype(np.uint32)):
        grammar = repair_ids.compress(ids)
        assert (repair_ids.expand(*grammar) == ids).all()
        for a, b in ((0, 1), (3, 17), (len(ids) // 2, len(ids) // 2 + 100)):
            if b <= len(ids):
                assert (repair_ids.expand(*grammar, a, b) == ids[a:b]).all()
    assert len(grammar[3]) < len(ids) / 5  # forty copies shrink


def test_grammar_leaves_no_frequent_pair():
    rng = np.random.default_rng(4)
    words = [rng.integers(0, 50_000, n) for n in rng.integers(2, 90, 3000)]
    zipf = np.concatenate([words[min(2999, int(k))] for k in rng.zipf(1.3, 9000)])[:1 << 18]
    copies = np.tile(rng.integers(0, 50_000, 512), 400)
    wide = np.repeat(rng.permutation(40_000), 2).reshape(-1, 2)[rng.integers(0, 15_000, 1 << 17)].ravel()  # more than 12 000 rules
    for ids in (zipf, copies, wide, np.full(9000, 3), rng.integers(0, 3, 9000), np.zeros(12, int), np.zeros(13, int)):
        ids = ids.astype(np.uint32)
        base, pairs, sizes, seq = repair_ids.compress(ids)
        _, counts = np.unique(seq[:-1].astype(np.int64) << 32 | seq[1:], return_counts=True)
        assert not len(counts) or counts.max() < repair_ids.LEAST
        assert (repair_ids.expand(base, pairs, sizes, seq) == ids).all()
        for a, b in ((0, 1), (5, 12), (len(ids) // 3, len(ids) // 2), (len(ids) - 3, len(ids))):
            assert (repair_ids.expand(base, pairs, sizes, seq, a, b) == ids[a:b]).all()
    assert max(repair_ids.compress(copies.astype(np.uint32))[2]) >= 512  # a whole copy is in one rule


def test_a_workers_second_task_starts_warm(spark, path):
    """Functions are shipped by value; the memo outlives the task that made it."""
    vocab = path(FILES["word"])

    def run(batches):
        m = memo("word", vocab)
        for batch in batches:
            before = len(m.sizes)
            m.ids(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()], pa.int64()), pa.array([before], pa.int64()), pa.array([len(m.sizes)], pa.int64())],
                                             ["pid", "before", "after"])

    texts = spark.createDataFrame([("warm worker words " * 3,)], "text string").coalesce(1)
    seen = [texts.mapInArrow(run, "pid bigint, before bigint, after bigint").collect()[0] for _ in range(6)]
    later = [(a, b) for k, b in enumerate(seen) for a in seen[:k] if a.pid == b.pid]
    assert later and all(b.before >= a.after >= 3 for a, b in later)


def test_check_sums_join():
    a, b, c = b"abcd" * 7, b"", b"xyz!" * 1001
    assert _crc.combine([(zlib.crc32(x), len(x)) for x in (a, b, c)]) == zlib.crc32(a + b + c)


def test_packing(edge, path):
    lib = Tokenizer.from_file(path(FILES["word"]))
    rows = certified_packing.best_fit_packing(edge, path(FILES["word"])).toPandas().sort_values(["sequence_id", "offset"])
    assert (rows.groupby("sequence_id").length.cumsum() - rows.length == rows.offset).all()
    assert rows.groupby("sequence_id").length.sum().max() <= 2048
    want = []
    for i, t in EDGE:
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(str(i), p, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes())) for p, s in enumerate(range(0, len(ids), 2048))]
    got = [(str(int(r.doc_id)) if r.doc_id == r.doc_id else "None", r.piece, r.start, r.length, r.ids_crc32) for r in rows.itertuples()]
    assert sorted(got) == sorted(want)
    assert rows.sequence_id.nunique() == certified_packing.lower_bound(rows.length.to_numpy(), 2048)


def test_bounds_never_exceed_the_best_packing():
    rng = np.random.default_rng(1)
    for _ in range(200):
        size = int(rng.integers(5, 30))
        lengths = rng.integers(1, size + 1, rng.integers(1, 9))

        def fewest(items, rooms):
            if not items:
                return len(rooms)
            tries = [fewest(items[1:], rooms[:k] + [r - items[0]] + rooms[k + 1:]) for k, r in enumerate(rooms) if r >= items[0]]
            return min([*tries, fewest(items[1:], [*rooms, size - items[0]])])

        best = fewest(sorted(lengths.tolist(), reverse=True), [])
        where, offset, bins = certified_packing.best_fit_decreasing(lengths, size)
        assert certified_packing.lower_bound(lengths, size) <= best <= bins <= -(-best * 4 // 3) + 1
        assert np.bincount(where, lengths).max() <= size


def test_gap_partitions_exchange(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), 0, 0, int(n), 0) for i, n in enumerate(rng.integers(300, 1400, 6000))]
    table = spark.createDataFrame(rows, certified_packing.PIECES)
    got = certified_packing.pack(table, most=1500).toPandas()
    assert len(got) == 6000 and got.groupby("sequence_id").length.sum().max() <= 2048
    assert got.sequence_id.nunique() <= certified_packing.lower_bound(got.length.to_numpy(), 2048) * 1.05
