"""SimHash near copies by a self-join of binary tries.

Distinct fingerprints, sorted, are the leaves of a binary trie. A pair of nodes carries the number of bits in which
the two prefixes differ; its children are the pairs of their children, and a pair is pruned when that number exceeds
the error budget. The traversal goes over whole levels at a time.

To spread the work, the 64 bits are cut into budget + 2 blocks. Two fingerprints within the budget agree in two
blocks at least, so there is one trie for each two blocks, in which these come first: linked fingerprints share the
node below them, and its self-join is all that a task has to traverse. That makes 15 copies of a fingerprint for a
budget of 4, at any size. Nodes that hold more than `leaf` fingerprints are opened by STEP more levels into the node
pairs within the budget, until none is over it. A task reports a spanning forest of its links, and components join
the forests.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import _text
from ._components import components
from ._memo import release

COARSE, STEP, LEAF, DIRECT, LEVEL = 12, 8, 1 << 20, 128, 200_000
HASHED = "doc_id bigint, text_hash bigint, fp bigint"


def fingerprint(text: str, words: int = 4, seed: int = 42) -> bytes:
    """64 bits, big-endian: a bit is 1 if set in over half the hashes of all word shingles."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z only, ASCII white space only
    if not tokens:
        return bytes(8)
    digest, counts, n = partial(xxhash.xxh64_digest, seed=seed), np.zeros(64, np.int64), max(1, len(tokens) - words + 1)
    for at in range(0, n, 50_000):
        part = tokens[at:at + 50_000 + words - 1]
        grams = map(b" ".join, zip(*(part[k:] for k in range(words)))) if len(tokens) >= words else [b" ".join(tokens)]
        bits = np.unpackbits(np.frombuffer(b"".join(map(digest, grams)), np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > n).tobytes()


def _hash(words: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for at, texts in _text.slices(batch):
                got = np.frombuffer(b"".join(fingerprint(t, words, seed) for t in texts), ">i8").astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(at, len(texts)) for c in (0, 2)] + [pa.array(got)], ["doc_id", "text_hash", "fp"])
    return run


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, fp (the 64 bits as a bigint) per row."""
    rows = _text.rows(docs, id_col=id_col, text_col=text_col)
    return rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_hash(words, seed), HASHED)


def turns(budget: int) -> list[list[tuple[int, int]]]:
    """For each two of the budget + 2 blocks: all blocks as (first bit from the left, width), these two first."""
    n = budget + 2
    widths = [64 // n + (k < 64 % n) for k in range(n)]
    blocks = [(sum(widths[:k]), w) for k, w in enumerate(widths)]
    return [[blocks[i], blocks[j], *(x for k, x in enumerate(blocks) if k not in (i, j))] for i, j in combinations(range(n), 2)]


def turned(fp: Column, order: list[tuple[int, int]]) -> Column:
    """The bits of a fingerprint with its blocks in another order."""
    out, left = F.lit(0).cast("bigint"), 64
    for first, width in order:
        left -= width
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, 64 - first - width).bitwiseAND(F.lit((1 << width) - 1)), left))
    return out


def turned_back(fps: np.ndarray, order: list[tuple[int, int]]) -> np.ndarray:
    out, left = np.zeros(len(fps), np.uint64), 64
    for first, width in order:
        left -= width
        out |= (fps >> np.uint64(left) & np.uint64((1 << width) - 1)) << np.uint64(64 - first - width)
    return out


def traverse(fps: np.ndarray, depth: int, budget: int, nodes: tuple[np.ndarray, np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked index pairs of sorted distinct fingerprints: of those of one or two nodes of that depth, or within each of
    the nodes fps[begin:end]."""
    if nodes is not None:
        start = (*nodes, *nodes, np.zeros(len(nodes[0]), np.int64))
    else:
        first = fps >> np.uint64(64 - depth) if depth else np.zeros(len(fps), np.uint64)
        split = int(np.searchsorted(first, first[-1], "left"))
        one = (0, len(fps), 0, len(fps), 0) if split == 0 else (0, split, split, len(fps), int(np.bitwise_count(first[0] ^ first[-1])))
        start = [np.array([x], np.int64) for x in one]
    stack = [(depth, *start)]
    while stack:
        t, al, ah, bl, bh, diff = stack.pop()
        if len(al) > LEVEL:
            stack.append((t, *(x[LEVEL:] for x in (al, ah, bl, bh, diff))))
            al, ah, bl, bh, diff = (x[:LEVEL] for x in (al, ah, bl, bh, diff))
        work = (ah - al) * (bh - bl)
        near = (work <= DIRECT) | (t == 64)
        yield from _direct(fps, al[near], ah[near], bl[near], bh[near], budget)
        al, ah, bl, bh, diff = (x[~near] for x in (al, ah, bl, bh, diff))
        if not len(al):
            continue
        high, bit = np.uint64((1 << 64) - (1 << (64 - t)) if t else 0), np.uint64(1 << (63 - t))
        am = np.searchsorted(fps, (fps[al] & high) | bit)
        bm = np.searchsorted(fps, (fps[bl] & high) | bit)
        other = al != bl
        kids = [(al, am, bl, bm, diff), (am, ah, bm, bh, diff), (al, am, bm, bh, diff + 1),
                tuple(x[other] for x in (am, ah, bl, bm, diff + 1))]
        al, ah, bl, bh, diff = (np.concatenate(x) for x in zip(*kids))
        live = (diff <= budget) & (ah > al) & (bh > bl) & ((al != bl) | (ah - al > 1))
        if live.any():
            stack.append((t + 1, *(x[live] for x in (al, ah, bl, bh, diff))))


def _direct(fps, al, ah, bl, bh, budget):
    """Compare all fingerprints of small node pairs, some million pairs at a time."""
    nb = bh - bl
    work = (ah - al) * nb
    ends = np.cumsum(work)
    at = 0
    while at < len(work):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 2_000_000, "right")))
        w = work[at:to]
        total = int(w.sum())
        k = np.repeat(np.arange(at, to), w)
        inner = np.arange(total) - np.repeat(np.cumsum(w) - w, w)
        i, j = al[k] + inner // nb[k], bl[k] + inner % nb[k]
        hit = (np.bitwise_count(fps[i] ^ fps[j]) <= budget) & (i != j)
        if hit.any():
            yield i[hit], j[hit]
        at = to


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def forest(fps: np.ndarray, depth: int, budget: int, nodes: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """For each fingerprint the index of the smallest one that this task's links join it to."""
    parent = np.arange(len(fps))
    for i, j in traverse(fps, depth, budget, nodes):
        while True:
            u, v = parent[i], parent[j]
            apart = u != v
            if not apart.any():
                break
            i, j, u, v = i[apart], j[apart], u[apart], v[apart]
            np.minimum.at(parent, np.maximum(u, v), np.minimum(u, v))
            parent = _roots(parent)
    return parent


def _moved(fps: np.ndarray, parent: np.ndarray, order: list[tuple[int, int]]) -> pa.RecordBatch | None:
    moved = np.flatnonzero(parent != np.arange(len(fps)))
    if len(moved):
        ends = [pa.array(turned_back(x, order).view(np.int64)) for x in (fps[moved], fps[parent[moved]])]
        return pa.RecordBatch.from_arrays(ends, ["u", "v"])


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[tuple, np.ndarray]]:
    """(key, fingerprints) of the runs of rows with equal keys; rows come by key."""
    now, held = None, []
    for batch in batches:
        keys, values = [batch.column(c).to_numpy() for c in names], batch.column("p").to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([np.diff(k) != 0 for k in keys]), [True]])) if len(values) else []
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(int(k[a]) for k in keys)
            if key != now:
                if held:
                    yield now, np.concatenate(held)
                now, held = key, []
            held.append(values[a:b].copy())
    if held:
        yield now, np.concatenate(held)


def _below_two_blocks(budget: int):
    """All nodes of a partition, one trie after the other."""
    orders = turns(budget)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (turn,), fps in _groups(batches, ("turn",)):
            fps, depth = np.sort(fps.view(np.uint64)), orders[turn][0][1] + orders[turn][1][1]
            edges = np.flatnonzero(np.concatenate([[True], np.diff(fps >> np.uint64(64 - depth)) != 0, [True]]))
            full = np.flatnonzero(np.diff(edges) > 1)
            if len(full) and (out := _moved(fps, forest(fps, depth, budget, (edges[full], edges[full + 1])), orders[turn])):
                yield out
    return run


def _opened_pairs(budget: int):
    """One node pair after the other."""
    orders = turns(budget)

    def run(batches):
        for (turn, depth, _, _), fps in _groups(batches, ("turn", "depth", "a", "b")):
            fps = np.sort(fps.view(np.uint64))
            if out := _moved(fps, forest(fps, depth, budget), orders[turn]):
                yield out
    return run


def _open(rows: DataFrame, budget: int) -> DataFrame:
    """Node pairs (turn, depth, a, b) of fingerprints p, STEP levels further down: each fingerprint goes to the pairs of
    its own child node with those of the other prefix that are within the budget."""
    size = 1 << STEP
    masks = F.explode(F.array(*[F.lit(m) for m in range(size) if m.bit_count() <= budget]).cast("array<bigint>"))
    own = F.expr(f"shiftrightunsigned(p, 64 - depth - {STEP}) & {size - 1}")
    wide = rows.select("turn", "depth", "a", "b", "p", own.alias("s"), masks.alias("m")).where(
        F.bit_count(F.expr("a ^ b")) + F.bit_count("m") <= budget)
    mine, other = "s", "(s ^ m)"
    left = F.expr(f"shiftleft(a, {STEP}) | CASE WHEN a = b THEN least({mine}, {other}) WHEN shiftrightunsigned(p, 64 - depth) = a THEN {mine} ELSE {other} END")
    right = F.expr(f"shiftleft(b, {STEP}) | CASE WHEN a = b THEN greatest({mine}, {other}) WHEN shiftrightunsigned(p, 64 - depth) = a THEN {other} ELSE {mine} END")
    return wide.select("turn", (F.col("depth") + STEP).alias("depth"), left.alias("a"), right.alias("b"), "p")


def links(fps: DataFrame, budget: int = 4, leaf: int = LEAF) -> DataFrame:
    """(u, v) forests of links between the distinct values of column fp."""
    orders, parts = turns(budget), _text.partitions(fps)
    copies = [F.struct(F.lit(k).alias("turn"), F.lit(o[0][1] + o[1][1]).alias("depth"), turned(F.col("fp"), o).alias("p")) for k, o in enumerate(orders)]
    prefix = F.expr("shiftrightunsigned(p, 64 - depth)")
    dealt = fps.select(F.explode(F.array(*copies)).alias("c")).select("c.*").withColumn("a", prefix)
    # Only where the top COARSE bits hold more than a leaf can a node be too full.
    coarse = F.shiftrightunsigned("p", 64 - COARSE).alias("top")
    crowded = dealt.groupBy("turn", coarse).count().where(F.col("count") > leaf).drop("count")
    whole, out = dealt, None
    if not crowded.isEmpty():
        inside = dealt.withColumn("top", coarse).join(F.broadcast(crowded), ["turn", "top"], "left_semi")  # at most 2**COARSE rows a trie
        full = cut(inside.groupBy("turn", "a").count().where(F.col("count") > leaf).drop("count"))
        whole, pairs = dealt.join(full, ["turn", "a"], "left_anti"), dealt.join(full, ["turn", "a"], "left_semi").withColumn("b", F.col("a"))
        node = ["turn", "depth", "a", "b"]
        while True:
            pairs = cut(_open(pairs.select(*node, "p"), budget))
            left = F.expr("shiftrightunsigned(p, 64 - depth) = a")
            sizes = pairs.groupBy(*node).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(left, 1)).alias("n_left"))
            live = (F.col("n") > 1) & ((F.col("a") == F.col("b")) | (F.col("n_left").between(1, F.col("n") - 1)))  # else one side is empty
            sizes = cut(sizes.where(live).withColumn("open", (F.col("n") > leaf) & (F.col("depth") <= 64 - STEP)).drop("n", "n_left"))
            known = pairs.join(sizes, node)
            ready = known.where("NOT open").drop("open").repartition(parts, *node).sortWithinPartitions(*node)
            found = ready.mapInArrow(_opened_pairs(budget), "u bigint, v bigint")
            out = found if out is None else out.unionByName(found)
            if sizes.where("open").isEmpty():
                break
            pairs = known.where("open")
    below = whole.repartition(parts, "turn", "a").select("turn", "p").sortWithinPartitions("turn", "p").mapInArrow(_below_two_blocks(budget), "u bigint, v bigint")
    return below if out is None else below.unionByName(out)


def simhash_classes(docs: DataFrame, words: int = 4, budget: int = 4, seed: int = 42, leaf: int = LEAF,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, fp, fingerprint (16 hex digits), component_id (smallest doc_id reachable) per row.

    NULL and empty texts have the fingerprint zero and are linked like others. Rows with a NULL id are
    linked too, but do not name a component (NULL if nothing else is in it). Repeated rows give repeated
    results; other columns are ignored; an empty table gives an empty result.
    """
    rows = cut(fingerprints(docs, words, seed, id_col, text_col))
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct.select("fp"), budget, leaf))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(names, "root").select("fp", "root", "component_id")
    return rows.join(classes, "fp").withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0")))


def keep_one(docs: DataFrame, words: int = 4, budget: int = 4) -> DataFrame:
    """The rows of `docs` of which one is kept for each component: that of the smallest id (NULL last)."""
    found = simhash_classes(docs, words, budget)
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))).alias("k")
    kept = found.groupBy("root").agg(first).select("k.id", "k.hash")
    # all columns travel in one struct, so none can clash with the two names beside it
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("own_id"),
                         F.xxhash64(F.coalesce("text", F.lit(""))).alias("own_hash"))
    rows = marked.join(kept, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("hash")), "left_semi")
    return rows.dropDuplicates(["own_id", "own_hash"]).select("row.*")
