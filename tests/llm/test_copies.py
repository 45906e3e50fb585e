"""Near copies, leaks and sketches against brute force."""

import hashlib
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from llm.conftest import EDGE
from sidweave.llm import _components, edit_decontam as D, simhash_trie as S, threshold_sketch as K


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(docs):
    fps = np.array([brute_fingerprint(t) for _, t in docs], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    label = np.arange(len(docs))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(docs))])
        if (new == label).all():
            break
        label = new
    name = {}
    for (i, _), c in zip(docs, label):
        if i is not None:
            name[c] = min(i, name.get(c, i))
    return sorted((str(i), format(int(f), "016x"), str(name.get(c))) for (i, _), f, c in zip(docs, fps, label))


def test_simhash_classes(spark, sf, edge):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(edge.select(F.col("doc_id") - 1000, "text").toDF("doc_id", "text"))
    want = brute_classes([(r.doc_id, r.text) for r in docs.collect()])
    for leaf in (S.LEAF, 30):  # below two blocks; full nodes opened
        got = S.simhash_classes(docs, leaf=leaf).collect()
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def test_trie_join_loses_no_link():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 63, 60, dtype=np.uint64) * np.uint64(2)
    flips = [np.uint64(sum(1 << int(k) for k in rng.choice(64, n, False))) for n in rng.integers(0, 5, 1500)]
    fps = np.unique(np.concatenate([base, rng.choice(base, 1500) ^ np.array(flips, np.uint64)]))
    i, j = np.where(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4, 1))
    got = {(min(a, b), max(a, b)) for x, y in S.traverse(fps, 0, 4) for a, b in zip(x.tolist(), y.tolist())}
    assert got == set(zip(i.tolist(), j.tolist()))


def test_two_blocks_stay_whole():
    """Any two fingerprints within the budget share the node of some trie; turning is undone."""
    rng = random.Random(2)
    for budget in (1, 3, 4):
        orders = S.turns(budget)
        assert len(orders) == (budget + 2) * (budget + 1) // 2
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, budget)))
            same = [o for o in orders if all((a ^ b) >> 64 - f - w & (1 << w) - 1 == 0 for f, w in o[:2])]
            assert same
            for o in orders:
                assert sorted(o) == sorted(orders[0]) and sum(w for _, w in o) == 64
    x = np.array([rng.getrandbits(64) for _ in range(50)], np.uint64)
    for o in S.turns(4):
        assert sorted(np.bitwise_count(S.turned_back(x, o)).tolist()) == sorted(np.bitwise_count(x).tolist())


def test_full_nodes_are_opened(spark):
    """Fingerprints that share many leading bits in every trie, far more than a leaf holds: no link is lost."""
    rng = np.random.default_rng(8)
    base = int(rng.integers(0, 2 ** 63, dtype=np.uint64))
    near = {base ^ sum(1 << int(k) for k in rng.choice(64, n, False)) for n in rng.integers(0, 5, 500)}
    near |= {int(x) for x in rng.integers(0, 2 ** 63, 100, dtype=np.uint64)}
    fps = np.array(sorted(near), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint")
    got = {r.node: r.root for r in _components.components(S.links(df, 4, leaf=150)).collect()}
    close = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    label = np.arange(len(fps))
    while (new := np.array([label[c].min() for c in close])).tolist() != label.tolist():
        label = new
    signed = fps.view(np.int64)
    want = {}
    for k in range(len(fps)):
        members = np.flatnonzero(label == label[k])
        if int(signed[members].min()) != int(signed[k]):
            want[int(signed[k])] = int(signed[members].min())
    assert got == want


def test_keep_one(spark, edge, nothing):
    kept = S.keep_one(edge)
    assert kept.columns == edge.columns
    rows = sorted((str(r.doc_id), str(r.text)) for r in kept.collect())
    assert len([r for r in rows if r[0] == "1"]) == 1  # of two equal rows one stays
    assert len(rows) == S.simhash_classes(edge).select("root").distinct().count() == 7
    for r in kept.collect():  # every column as it came, whatever its name
        k = r["_id"].split()[1]
        assert all(r[n] == f"{n} {k}" for n in edge.columns[5:]) and (r.doc_id, r.text) == EDGE[int(k)]
    assert S.keep_one(nothing).count() == 0 and S.simhash_classes(nothing).count() == 0


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (-5, 30), (7, 7)], "u bigint, v bigint")
    got = {r.node: r.root for r in _components.components(chain).collect()}
    assert got == {**{k: -5 for k in range(61)}, 101: 100}


def levenshtein_inside(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_myers_distance():
    rng = random.Random(4)
    for _ in range(300):
        p, t = ("".join(rng.choice("abc ") for _ in range(n)) for n in (rng.randint(1, 90), rng.randint(1, 60)))
        assert D.myers(D.masks(p), len(p), t, len(p))[0] == levenshtein_inside(p, t)


def test_leaks_against_brute_force(spark, sf, edge, nothing):
    rng = random.Random(9)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").limit(12).collect()] + [(900, None), (901, ""), (902, "too short"), (None, "x" * 50)]

    def edited(text, n):
        for _ in range(n):
            k = rng.randrange(len(text))
            text = text[:k] + rng.choice(["", "q", text[k] + "z"]) + text[k + 1:]
        return text

    docs = [(k, "Some words before. " + edited(bench[k % 12][1], k // 4) + " and after\nit.") for k in range(60)] + [(99, "nothing here"), *EDGE]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = set()
    for i, t in docs:
        for item, q in bench[:12]:
            tries = [(levenshtein_inside(w, D.normal(t or "")), len(w) // D.RATE) for w in D.windows(D.normal(q))]
            if any(e <= k for e, k in tries):
                want.add((str(i), item, min(e for e, k in tries if e <= k)))
    items = spark.createDataFrame(bench, "item_id bigint, text string")
    got = {(str(r.doc_id), r.item_id, r.errors) for r in D.leaks(table, items).collect()}
    assert got == want and len(got) > 25
    assert {(str(r.doc_id), r.item_id, r.errors) for r in D.leaks(table, items, block_chars=500).collect()} == want
    clean = D.decontaminated(edge.unionByName(edge.limit(0)), items)
    assert clean.columns == edge.columns and clean.count() == len(EDGE)
    assert D.leaks(nothing, items).count() == 0 and D.leaks(table, items.limit(0)).count() == 0


def test_passages_of_every_offset_are_found(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    items = [(n, D.normal(" ".join(rng.sample(words, 60)))[:n].strip().ljust(n, "x")) for n in (121, 140, 179, 233, 300)]
    docs, want = [], set()
    for item, text in items:
        for n in (D.WINDOW, 140):  # every passage, found without windows(): it is cut from the item
            for at in range(len(text) - n + 1):
                cut = list(text[at:at + n])
                for k in rng.sample(range(n), rng.randint(0, D.WINDOW * 2 // 3 // D.RATE)) if at % 2 else ():
                    cut[k] = "#"
                docs.append((len(docs), f"Words before <{''.join(cut)}> and after"))
                want.add((len(docs) - 1, item))
    matcher = D.Matcher(items)
    assert {(i, item) for i, t in docs for item in matcher.search(t)} == want
    assert not any(matcher.search("before " + t[20:60] + " after") for _, t in items)
    some = spark.createDataFrame(docs[::40], "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert D.decontaminated(some, bench).count() == 0 and D.leaks(some, bench).select("doc_id").distinct().count() == len(docs[::40])


def test_long_windows_keep_their_edits():
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefgh") for _ in range(120))
    doc = text[:44] + "".join(c if k % 5 else "#" for k, c in enumerate(text[44:74])) + text[74:]  # six edits within thirty points
    assert D.Matcher([(1, text)]).search(doc) == {1: (6, 0)}


def test_short_items(spark):
    items = [(1, "Yes"), (2, "x"), (3, "Who wrote it?"), (4, "twenty-one points, ok"), (5, " "), (6, None), (7, "日本語")]
    docs = ["yesterday", "Oh YES, sir", "yes", "boxes 12x3", "x", "asked: who\n wrote  it? Nobody", "who wrote it", "so twenty-one paints, ok then",
            "so twenty-one points, okay", "so twenty-one pints, ok", "abctwenty-one points, ok", "twenty-two paints, ok", "私は日本語", "日本語!", ""]
    want = {(1, 1, 0, 3), (2, 1, 0, 0), (4, 2, 0, 0), (5, 3, 0, 7), (7, 4, 1, 3), (9, 4, 1, 3), (12, 7, 0, 2), (13, 7, 0, 0)}
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {tuple(r) for r in D.leaks(table, bench).collect()}
    assert got == want, got ^ want
    assert D.leaks(table, bench, least=D.LEAST).count() == 0
    assert D.decontaminated(table, bench).count() == len(docs)
    assert {r.doc_id for r in D.decontaminated(table, bench, least=1).collect()} == set(range(len(docs))) - {i for i, *_ in want}


def brute_sketch(spark, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    grams = [words[i:i + 5] for i in range(max(1, len(words) - 4))] if words else []
    hashes = {spark.sql("SELECT xxhash64(" + ",".join("'" + w.replace("'", "") + "'" for w in g) + ")").first()[0] for g in grams}
    return sorted(h for h in hashes if 0 <= h < 2 ** 61)


def test_sketch(spark):
    text = "the quick brown fox jumps over the lazy dog and runs away from the quick brown fox jumps over"
    frame = spark.createDataFrame([(1, text), (2, "one two"), (3, ""), (4, None)], "doc_id bigint, text string")
    got = {r.doc_id: r.sketch for r in K.with_sketch(frame).collect()}
    assert got[1] == brute_sketch(spark, text) and got[2] == brute_sketch(spark, "one two") and got[3] == got[4] == []
    every = {r.doc_id: r.sketch for r in K.with_sketch(frame, fraction=1.0).collect()}
    assert len(every[1]) == 13 and len(every[2]) == 1  # 15 shingles, two of them twice


def test_edited_likeness(spark, sf, edge, nothing):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(edge.select("doc_id", "text"))
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0], r[1]))
    want = []
    for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        want.append((str(i), len(t), hashlib.sha256((t[:len(t) - half] + n[:half]).encode()).hexdigest()))
    found = K.edited_likeness(docs).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in found) == sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    exact = K.edited_likeness(docs, fraction=1.0).collect()
    long = {str(r.doc_id) for r in found if r.n_chars > 3000 and (r.doc_id or 0) > 7}  # of the edge rows some have one shingle only
    truth = {str(r.doc_id): r.near_edited for r in exact}
    errors = [abs(r.near_edited - truth[str(r.doc_id)]) for r in found if str(r.doc_id) in long]
    assert np.mean(errors) < 0.06
    assert K.edited_likeness(nothing).count() == 0
    alone = K.edited_likeness(docs.limit(1)).first()
    assert alone.near_next == 1.0


def test_likeness_against_plain_sets(spark, sf):
    """Every fingerprint and likeness from sets of hashes made one by one."""
    def sketch(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = [words[i:i + 5] for i in range(max(1, len(words) - 4))] if words else []
        out = set()
        for g in grams:
            h = 42
            for w in g:  # the hash of each word seeds the next one
                h = xxhash.xxh64_intdigest(w.encode(), seed=h)
            if h < int(K.FRACTION * 2 ** 64):
                out.add(h)
        return out

    def like(a, b, same):
        return len(a & b) / min(len(a), len(b)) if a and b else float(same)

    def printed(held):
        return ".".join(format(h, "x") for h in sorted(held, key=lambda h: h - (1 << 64) if h >> 63 else h))

    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in K.edited_likeness(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    assert len(got) == len(docs)
    for k, (i, text) in enumerate(docs):
        other = docs[(k + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        a, b, c = sketch(text), sketch(edited), sketch(other)
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (printed(a), printed(b))
        assert abs(r.near_edited - like(a, b, text == edited)) < 1e-12 and abs(r.near_next - like(a, c, text == other)) < 1e-12


def test_containment_of_unequal_documents(spark):
    words = [f"w{k}" for k in range(4000)]
    frame = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:400]))], "doc_id bigint, text string")
    a, b = (K.with_sketch(frame).where(f"doc_id = {k}").select(F.col("sketch").alias(f"s{k}")) for k in (1, 2))
    r = a.join(b).select(K.containment(F.col("s2"), F.col("s1")).alias("all"), K.containment(F.col("s1"), F.col("s2")).alias("tenth"),
                         (F.size(K.merged(F.col("s1"), F.col("s2"))) == F.size("s1")).alias("same")).first()
    assert r["all"] == 1.0 and abs(r.tenth - 0.1) < 0.04 and r.same
