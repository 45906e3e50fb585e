"""Own byte-pair encoding against the library on whole texts."""

import hashlib
import random
import time

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from llm.conftest import EDGE
from sidweave.llm import queries, rank_array_bpe
from sidweave.llm.rank_array_bpe import RankMemo, Vocabulary
from sidweave.session import read

FILE = "byte_bpe_50k.json"
PARTS = ["a", "b", " ", " ", "\n", "\t", "\r", ".", ",", "'s", "'", "'t", "Ä", "ñ", "　", "\xa0", "<|endoftext|>", "<|", "9", "²", "İ", "The", " the", "\x1c", "\x00",
         "\x85", "́", "日本", "…", "×", "é", "_", "(", "\U0001f600", "word", "ization", "\u0558", "\U00015196", "\U00010edc"]


def _lib(path):
    lib = Tokenizer.from_file(path(FILE))
    return lambda t: np.array(lib.encode(t, add_special_tokens=False).ids, "<u4"), lib


def test_ids_of_random_texts(path):
    rng, (ids, _) = random.Random(8), _lib(path)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 16))) for _ in range(8000)]
    m = RankMemo(path(FILE))
    for _ in range(2):  # the second time from the memo
        flat, edges = m.ids(pa.array(texts))
        assert [flat[a:b].tobytes() for a, b in zip(edges, edges[1:])] == [ids(t).tobytes() for t in texts]
    assert m.call(texts) == [ids(t).tobytes() for t in texts]


def test_every_character_is_classed_as_the_library_does(path):
    (ids, _), v = _lib(path), Vocabulary(path(FILE))
    chars = [chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000]
    for at in range(0, len(chars), 0x4000):  # a word ends or goes on at each character; so does a number
        text = "".join(f"in{c}ing 19{c}84 .{c}. {c}\n" for c in chars[at:at + 0x4000])
        assert v.encode([text])[0] == ids(text).tobytes()


def test_long_words(path):
    rng, (ids, _), v = random.Random(9), _lib(path), Vocabulary(path(FILE))
    for t in ("".join(rng.choice("abcdehinorst") for _ in range(5000)), "a" * 3001, "the" * 700, "日本語" * 400, "é" * 40):
        assert v.encode([t])[0] == ids(t).tobytes()
    began = time.process_time()
    v.encode(["ab" * 60_000])
    assert time.process_time() - began < 20


def test_rows(spark, sf, edge, path):
    ids, lib = _lib(path)
    docs = [*EDGE, *((r.doc_id, r.text) for r in read(spark, sf, "documents").select("doc_id", "text").collect())]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = sorted((str(i), len(x := ids(t or "")), sha(x.tobytes()), sha(lib.decode(x.tolist(), skip_special_tokens=False).encode())) for i, t in docs)
    got = [*rank_array_bpe.round_trip(edge, path(FILE)).collect(), *queries.QUERIES["op13_rank_array_bpe"](spark, sf).collect()]
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want


def test_decode_gives_texts_back(edge, nothing, path, spark):
    coded = rank_array_bpe.encode(edge, path(FILE))
    got = sorted((str(r.doc_id), r.text) for r in rank_array_bpe.decode(coded, path(FILE)).collect())
    assert got == sorted((str(i), t or "") for i, t in EDGE)
    assert rank_array_bpe.encode(nothing, path(FILE)).count() == 0 == rank_array_bpe.round_trip(nothing, path(FILE)).count()
    broken = spark.createDataFrame([(1, [162, 96, 50256]), (2, None)], "doc_id bigint, ids array<bigint>")
    want = Tokenizer.from_file(path(FILE)).decode([162, 96, 50256], skip_special_tokens=False)
    assert {r.doc_id: r.text for r in rank_array_bpe.decode(broken, path(FILE)).collect()} == {1: want, 2: ""}
