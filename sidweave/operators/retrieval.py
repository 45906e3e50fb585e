"""Batch top-k retrieval, dense and lexical, both exact.

Dense: the corpus is cut into inverted lists around pivot vectors and shuffled to them once. By the triangle
inequality on angles a list whose rows lie between two angles from its pivot can hold nothing nearer to a query than
the gap to that range, so a query goes only to the lists that can reach its k-th score; a first k-th score comes from
the pivots, which are rows of the corpus.

Lexical: the corpus becomes blocks of postings, each with the highest impact of every term in it. Queries are sent to
the blocks, in parts of bounded size; a task reads its blocks one after the other and skips each block for the
queries whose terms' impacts there cannot reach the k-th score that the task has found so far.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import hash_int
from ..functions.words import pieces, words
from ..session import DEFAULT_BROADCAST_BYTES, cut

K1, B = 0.9, 0.4
SCORED = "query_id bigint, doc_id bigint, score double"
PIVOT_BYTES, MARGIN = 16_000_000, 2e-6  # scores are compared at six digits
CELLS = 2_000_000  # entries of a matrix of rows and pivots, or rows and lists, that a worker holds
BLOCK_BYTES, QUERY_TERMS = 4_000_000, 500_000


def unit_vector(v: Column) -> Column:
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(v, lambda x: x.cast("double") / norm)


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest of each row, the first columns on a tie."""
    k = min(k, scores.shape[1])
    least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    row, col = np.nonzero(scores >= least[:, None])
    order = np.lexsort((col, -scores[row, col], row))
    row, col = row[order], col[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], col[keep]


def _ranked(best: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ y.T, -1, 1))


def _nearest_pivot(pivots):
    @F.pandas_udf("pivot int, angle double")
    def run(vectors: pd.Series) -> pd.DataFrame:
        if not len(vectors):
            return pd.DataFrame({"pivot": [], "angle": []})
        x, near, angle = np.stack(vectors.to_numpy()), [], []
        for at in _turns(len(x), len(pivots.value)):
            angles = _angles(x[at], pivots.value)
            near.append(angles.argmin(axis=1))
            angle.append(angles[np.arange(len(angles)), near[-1]])
        return pd.DataFrame({"pivot": np.concatenate(near).astype(np.int32), "angle": np.concatenate(angle)})

    return run


def _turns(rows: int, width: int) -> list[slice]:
    """Runs of rows whose matrix of `width` columns has at most about CELLS entries."""
    step = max(1, CELLS // max(1, width))
    return [slice(at, at + step) for at in range(0, rows, step)]


def _reachable(pivots, lists, k: int):
    """Numbers of the lists that can hold one of a query's k best; lists: (pivot, least angle, largest angle) of each."""
    @F.pandas_udf("array<int>")
    def run(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        (pivot, low, high), x, out = lists.value, np.stack(vectors.to_numpy()), []
        n = len(pivots.value)
        for at in _turns(len(x), max(n, len(pivot))):
            cosine = np.clip(x[at] @ pivots.value.T, -1, 1)
            least = np.partition(cosine, n - k, axis=1)[:, n - k] if n >= k else np.full(len(cosine), -2.0)
            angle = np.arccos(cosine)[:, pivot]
            gap = np.maximum(0, np.maximum(low - angle, angle - high))
            go = np.cos(np.minimum(gap, np.pi)) + MARGIN >= least[:, None]
            out += [np.flatnonzero(r).astype(np.int32) for r in go]
        return pd.Series(out)

    return run


def _scan_lists(k: int):
    """A partition holds whole lists, in each the corpus rows before the queries: a list's rows are kept while the
    queries stream by, so memory is that of a list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, rows, ready = None, [], [], None
        for batch in batches:
            number, kind, key = (batch.column(c).to_numpy() for c in ("list", "kind", "id"))
            vectors = batch.column(batch.schema.get_field_index("vector"))
            cuts = np.flatnonzero(np.concatenate([[True], (np.diff(number) != 0) | (np.diff(kind) != 0), [True]]))
            for a, b in zip(cuts, cuts[1:]):
                if number[a] != now:
                    now, ids, rows, ready = number[a], [], [], None
                part = _matrix(vectors.slice(a, b - a))
                if kind[a] == 0:
                    ids.append(key[a:b])
                    rows.append(part)
                    continue
                if not ids:
                    continue
                if ready is None:
                    ids_all, matrix = np.concatenate(ids), np.concatenate(rows)
                    order = np.argsort(ids_all, kind="stable")
                    ready = ids_all[order], matrix[order]
                for at in range(0, len(part), 256):
                    # Rounding first makes ties exact, so the lower document id wins in every layout.
                    scores = np.round(part[at:at + 256] @ ready[1].T, 6)
                    row, col = _best(scores, k)
                    yield pa.RecordBatch.from_arrays([pa.array(key[a + at:b][row]), pa.array(ready[0][col]), pa.array(scores[row, col])],
                                                     ["query_id", "doc_id", "score"])
    return run


def dense_plan(queries: DataFrame, corpus: DataFrame, k: int, list_rows: int = 65_536, pivots: int = 1024) -> tuple[DataFrame, DataFrame, int]:
    """(queries with `visits`, the lists each has to go to; corpus with its `list`; number of lists) of (id, vector) tables.

    Pivots are the rows with the smallest hash, at most PIVOT_BYTES of them; a pivot's rows are dealt over as many lists
    as hold `list_rows` each. The table of lists has a row for each `list_rows` rows of the corpus and each pivot.
    """
    spark, unit = corpus.sparkSession, unit_vector(F.col("vector")).alias("vector")
    units = corpus.select("doc_id", unit)
    dim = len((units.select("vector").first() or [[0.0]])[0])
    held = units.select("vector", hash_int("pivot", F.col("doc_id")).alias("h"), "doc_id").orderBy("h", "doc_id").limit(
        max(k, min(pivots, PIVOT_BYTES // (8 * dim)))).select("vector").toPandas()["vector"]
    if not len(held):
        return queries.select("query_id", unit).withColumn("visits", F.array().cast("array<int>")), units.withColumn("list", F.lit(0)), 0
    centres = spark.sparkContext.broadcast(np.stack(held.to_numpy()))
    placed = cut(units.withColumn("near", _nearest_pivot(centres)("vector")).select("doc_id", "vector", "near.*"))
    each = placed.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high")).toPandas()
    each["parts"] = -(-each["n"] // list_rows)
    each["first"] = each["parts"].cumsum() - each["parts"]
    lists = each.loc[each.index.repeat(each["parts"])]
    table = spark.sparkContext.broadcast((lists["pivot"].to_numpy(), lists["low"].to_numpy(), lists["high"].to_numpy()))
    starts = spark.createDataFrame(each[["pivot", "first", "parts"]])
    share = F.pmod(hash_int("list", F.col("doc_id")), F.col("parts"))
    listed = placed.join(F.broadcast(starts), "pivot").select("doc_id", "vector", (F.col("first") + share).cast("int").alias("list"))
    asked = queries.select("query_id", unit).withColumn("visits", _reachable(centres, table, k)("vector"))
    return asked, listed, len(lists)


def dense_search(queries: DataFrame, corpus: DataFrame, k: int, list_rows: int = 65_536, pivots: int = 1024) -> DataFrame:
    """query_id, doc_id, score, rank by inner product of unit vectors; inputs have (id, vector).

    The corpus moves once, to its lists; a query moves to each list that can reach its k-th score.
    """
    asked, listed, _ = dense_plan(queries, corpus, k, list_rows, pivots)
    to = asked.select(F.explode("visits").alias("list"), F.lit(1).alias("kind"), F.col("query_id").alias("id"), "vector")
    both = listed.select("list", F.lit(0).alias("kind"), F.col("doc_id").alias("id"), "vector").unionByName(to)
    found = both.repartition("list").sortWithinPartitions("list", "kind").mapInArrow(_scan_lists(k), SCORED)
    return _ranked(found, k)


def skipped_share(queries: DataFrame, corpus: DataFrame, k: int, list_rows: int = 65_536, pivots: int = 1024) -> float:
    """Share of (query, corpus row) pairs that a dense search never multiplies."""
    asked, listed, _ = dense_plan(queries, corpus, k, list_rows, pivots)
    sizes = listed.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    met = asked.select(F.explode("visits").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("q")).join(sizes, "list")
    pairs = queries.count() * corpus.count()
    return 1 - (met.agg(F.sum(F.col("q") * F.col("n"))).first()[0] or 0) / pairs if pairs else 0.0


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def title_and_text(text: Column) -> tuple[Column, Column]:
    """First line and the rest."""
    return F.substring_index(text, "\n", 1), F.when(
        F.contains(text, F.lit("\n")), F.substring(text, F.instr(text, "\n") + 1, F.length(text))).otherwise("")


BLOCKS = "ids array<bigint>, lengths array<int>, terms array<string>, firsts array<int>, docs array<int>, tfs array<int>"


def _block(ids: pa.Array, texts: pa.Array, wanted: pa.Array | None) -> pa.RecordBatch:
    """One block: its documents and lengths, and for each term the documents with it (numbers in `ids`) and counts."""
    found, doc = words(texts)
    lengths = np.bincount(doc, minlength=len(texts))
    code = found.indices.to_numpy().astype(np.int64)
    if wanted is not None:  # terms that no query asks for go before anything is counted
        good = pc.is_in(found.dictionary, value_set=wanted).to_numpy(zero_copy_only=False)
        pick = good[code]
        code, doc = code[pick], doc[pick]
    pairs, tf = np.unique(code * len(texts) + doc, return_counts=True)
    term = pairs // max(1, len(texts))
    met, firsts = np.unique(term, return_index=True)
    cells = [ids, pa.array(lengths, pa.int32()), found.dictionary.take(pa.array(met)), pa.array(np.append(firsts, len(pairs)), pa.int32()),
             pa.array(pairs % max(1, len(texts)), pa.int32()), pa.array(tf, pa.int32())]
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in cells],
                                      ["ids", "lengths", "terms", "firsts", "docs", "tfs"])


def posting_blocks(corpus: DataFrame, wanted: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of postings of (doc_id, text), each of about `block_bytes` of text, made where texts are read."""
    shared = corpus.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = None if shared.value is None else pa.array(shared.value, pa.string())
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            for a, b in pieces(sizes, block_bytes):
                yield _block(ids.slice(a, b - a), texts.slice(a, b - a), asked)

    return corpus.select("doc_id", F.lower("text").alias("text")).mapInArrow(run, BLOCKS)


class _Block:
    """A block's postings of the wanted terms, with impacts."""

    def __init__(self, row: dict, wanted: pa.Array, idf: np.ndarray, average: float) -> None:
        self.ids = row["ids"].to_numpy(zero_copy_only=False)
        at = pc.index_in(wanted, value_set=row["terms"])
        self.has = at.is_valid().to_numpy(zero_copy_only=False)
        at, firsts = at.fill_null(0).to_numpy().astype(np.int64), row["firsts"].to_numpy().astype(np.int64)
        size = np.where(self.has, firsts[np.minimum(at + 1, len(firsts) - 1)] - firsts[at], 0)
        self.first = np.concatenate([[0], np.cumsum(size)])
        every = np.repeat(firsts[at] - self.first[:-1], size) + np.arange(self.first[-1])
        self.docs, tf = row["docs"].to_numpy()[every], row["tfs"].to_numpy()[every].astype(np.float64)
        norm = K1 * (1 - B + B * row["lengths"].to_numpy()[self.docs] / average)
        self.impact = np.repeat(idf, size) * tf * (K1 + 1) / (tf + norm)
        self.most = np.zeros(len(size))
        if full := np.flatnonzero(size).tolist():
            self.most[full] = np.maximum.reduceat(self.impact, self.first[full])

    def scores(self, asked: np.ndarray, times: np.ndarray) -> np.ndarray:
        size = self.first[asked + 1] - self.first[asked]
        ends = np.cumsum(size)
        every = np.repeat(self.first[asked] - ends + size, size) + np.arange(ends[-1])
        return np.round(np.bincount(self.docs[every], np.repeat(times, size) * self.impact[every], len(self.ids)), 6)


def _scan_blocks(shared, k: int):
    """shared: (distinct terms, their idf, average length, (query_id, term numbers, repeats) of each query)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, idf, average, queries = shared.value
        wanted = pa.array(names, pa.string())
        top = [(np.zeros(0), np.zeros(0, np.int64)) for _ in queries]
        for batch in batches:
            for r in range(batch.num_rows):
                block = _Block({c: batch.column(j)[r].values for j, c in enumerate(batch.schema.names)}, wanted, idf, average)
                for q, (_, asked, times) in enumerate(queries):
                    held = block.has[asked]
                    if not held.any():
                        continue
                    own, n = asked[held], times[held]
                    best, ids = top[q]
                    least = best[-1] if len(best) == k else 0.0
                    if (block.most[own] * n).sum() + MARGIN < least:  # nothing in the block can reach it
                        continue
                    scores = block.scores(own, n)
                    hit = np.flatnonzero((scores > 0) & (scores >= least))
                    best, ids = np.concatenate([best, scores[hit]]), np.concatenate([ids, block.ids[hit]])
                    order = np.lexsort((ids, -best))[:k]
                    top[q] = best[order], ids[order]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array([q for q, _, _ in queries], np.int64), [len(s) for s, _ in top])),
             pa.array(np.concatenate([i for _, i in top] or [np.zeros(0, np.int64)]).astype(np.int64)),
             pa.array(np.concatenate([s for s, _ in top] or [np.zeros(0)]))], ["query_id", "doc_id", "score"])
    return run


def _term_frequencies(shared):
    """Documents with each wanted term, of every block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(shared.value, pa.string())
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for r in range(batch.num_rows):
                at = pc.index_in(wanted, value_set=batch.column(0)[r].values)
                has = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
                at, firsts = at.drop_null().to_numpy().astype(np.int64), batch.column(1)[r].values.to_numpy()
                total[has] += firsts[at + 1] - firsts[at]
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([wanted.take(pa.array(has)), pa.array(total[has])], ["term", "df"])
    return run


def lexical_search(queries: DataFrame, corpus: DataFrame, k: int, query_terms: int = QUERY_TERMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, doc_id, score, rank by BM25 over white-space terms; documents without a common term do not rank.

    The corpus becomes blocks once and is read, not copied, for each part of the queries; a part holds about
    `query_terms` terms. If all distinct query terms fit into the broadcast bound, blocks hold only these.
    """
    spark = queries.sparkSession
    asked = queries.select("query_id", terms(F.col("text")).alias("t")).where(F.size("t") > 0)
    size = asked.agg(F.sum(F.size("t")), F.sum(F.length(F.array_join("t", "")))).first()
    n_parts = max(1, -(-(size[0] or 0) // query_terms))
    fits = (size[1] or 0) * 4 <= DEFAULT_BROADCAST_BYTES
    wanted = [r.w for r in asked.select(F.explode("t").alias("w")).distinct().collect()] if fits else None
    blocks = cut(posting_blocks(corpus, wanted, block_bytes))
    count, average = blocks.agg(F.sum(F.size("ids")), F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda s, x: s + x)) / F.sum(F.size("ids"))).first()
    out = None
    for number in range(n_parts):
        part = [(r.query_id, Counter(r.t)) for r in asked.where(F.pmod(hash_int("part", F.col("query_id")), F.lit(n_parts)) == number).collect()]
        names = sorted({w for _, c in part for w in c})
        at = {w: j for j, w in enumerate(names)}
        found = blocks.select("terms", "firsts").mapInArrow(_term_frequencies(spark.sparkContext.broadcast(names)), "term string, df bigint")
        df = dict(found.groupBy("term").agg(F.sum("df")).collect())  # the part's terms
        idf = np.array([math.log(1 + ((count or 0) - df.get(w, 0) + 0.5) / (df.get(w, 0) + 0.5)) for w in names])
        sent = [(q, np.array([at[w] for w in sorted(c)]), np.array([c[w] for w in sorted(c)])) for q, c in part]
        state = spark.sparkContext.broadcast((names, idf, average or 1.0, sent))
        best = blocks.mapInArrow(_scan_blocks(state, k), SCORED)
        out = best if out is None else out.unionByName(best)
    return _ranked(out, k)
