"""Ranked lexical search over a length-stratified index.

A document's score for a term depends on its own length only through the normaliser m, so documents of equal m form
a stratum. The index is a table of segments, one for each run of texts that a task reads, written as Parquet:

    ids               doc_ids in the order of their strata; a document's number is its place here
    strata, begins    the values of m, ascending, and the first document number of each
    terms, firsts     distinct terms, and where each one's postings begin (one more entry ends the last)
    docs, tfs         postings of a term: by stratum, within it by tf from the highest, then by document number

A search sends the test items to the segments in blocks of bounded size. Within a segment the postings of a term in
a stratum that share a tf share an impact, which is computed once; the first posting of a term in a stratum has the
highest tf there and so bounds it. An item visits strata by falling sum of its terms' bounds and stops at the first
that cannot reach its k-th score, which a task carries on from segment to segment. Each task reports k documents an
item, and two ranks over them give the result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut, one_row_batches, scratch
from . import _text
from ._memo import LOWER, text_bytes

BLOCK_CHARS, FIRST_VISIT, PLACES, SEGMENT_GROUP = 2_000_000, 8, 64, 8 << 20
INDEX = ("ids array<bigint>, strata array<bigint>, begins array<int>, terms array<string>, firsts array<int>, docs array<int>, tfs array<int>")
FOUND = "block int, item int, doc_id bigint, score bigint"
#: The characters of terms are ASCII letters and digits and all beyond ASCII.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
IN_TERM = np.array([k > 127 or chr(k).isalnum() for k in range(256)])


def terms_of(text: str) -> list[str]:
    """The terms of one text: maximal matches, only A-Z lower-cased."""
    return TERM.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


def _spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, in a term, where terms begin, text of each term, terms of each text) of a run of texts."""
    data, bounds = text_bytes(texts)
    size = int(bounds[-1])
    inside = IN_TERM[data]
    head = inside[:size].copy()
    head[1:] &= ~inside[:max(0, size - 1)]
    edge = bounds[:-1][bounds[:-1] < size]
    head[edge] = inside[edge]
    begin = np.flatnonzero(head)
    doc = np.searchsorted(bounds, begin, "right") - 1
    return data, inside, begin, doc, np.bincount(doc, minlength=len(texts))


def normaliser(n: int, size: int, total: int) -> int:
    """m of a document of n terms; `size` documents hold `total` terms."""
    return 100 - 25 + (25 * n * size) // total


def weight(df: int, size: int) -> int:
    return math.floor(1000 * math.log((2 * size + 2) / (2 * df + 1)))


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = terms = 0
    for batch in batches:
        for _, texts in _text.runs(batch):
            n = _spans(texts)[4]
            docs, terms = docs + int((n > 0).sum()), terms + int(n.sum())
    yield pa.RecordBatch.from_arrays([pa.array([docs], pa.int64()), pa.array([terms], pa.int64())], ["docs", "terms"])


def corpus_size(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[int, int]:
    """(documents with a term, all their terms)."""
    each = _text.rows(docs, id_col=id_col, text_col=text_col).mapInArrow(_sizes, "docs bigint, terms bigint")
    row = each.agg(F.sum("docs"), F.sum("terms")).first()
    return row[0] or 0, row[1] or 0


def segment(ids: pa.Array, texts: pa.Array, size: int, total: int) -> dict | None:
    """The index of one run of texts; None if it has no term."""
    data, inside, begin, doc, n = _spans(texts)
    if not len(begin):
        return None
    letters = LOWER[data[inside]]
    ends = np.concatenate([[0], np.cumsum(inside[:len(data) - 32])])
    offsets = np.append(ends[begin], len(letters)).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
    lengths, place = np.unique(n, return_inverse=True)
    m = np.array([normaliser(x, size, total) for x in lengths.tolist()], np.int64)[place]
    full = np.flatnonzero(n > 0)
    order = full[np.argsort(m[full], kind="stable")]
    number = np.zeros(len(n), np.int64)
    number[order] = np.arange(len(order))
    strata, first = np.unique(m[order], return_index=True)
    # one sort by (term, document) counts tf; documents are numbered by stratum, so that only tf within one is left to order
    pairs, tf = np.unique(words.indices.to_numpy().astype(np.int64) * len(order) + number[doc], return_counts=True)
    term, doc_no = pairs // len(order), pairs % len(order)
    stratum = np.searchsorted(first, doc_no, "right") - 1
    by_tf = np.argsort((term * len(strata) + stratum) * (int(tf.max()) + 1) + (int(tf.max()) - tf), kind="stable")
    firsts = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(words.dictionary)))])
    return {"ids": ids.take(pa.array(order)), "strata": strata, "begins": first, "terms": words.dictionary, "firsts": firsts,
            "docs": doc_no[by_tf], "tfs": tf[by_tf]}


def _indexer(size: int, total: int):
    kinds = {"ids": pa.int64(), "strata": pa.int64(), "begins": pa.int32(), "terms": pa.string(), "firsts": pa.int32(), "docs": pa.int32(), "tfs": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _text.runs(batch):
                if made := segment(batch.column(0).slice(at, len(texts)), texts, size, total):
                    cells = [v if isinstance(v := made[k], pa.Array) else pa.array(v, kind) for k, kind in kinds.items()]
                    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in cells], list(kinds))
    return run


def build_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[int, int]:
    """Write the index of all rows and return (documents with a term, all their terms), which a search needs.

    NULL texts and texts without terms are in no segment; a NULL id is kept; repeated rows are indexed each.
    """
    size, total = corpus_size(docs, id_col, text_col)
    made = _text.rows(docs, id_col=id_col, text_col=text_col).mapInArrow(_indexer(size, total), INDEX)
    # A row is a segment of some MB: by itself Parquet looks at the size of a row group only after a hundred rows.
    sizes = {"parquet.block.size": SEGMENT_GROUP, **{f"parquet.{part}.size.row.check.{end}": 1 for part in ("block", "page") for end in ("min", "max")}}
    made.write.options(**sizes).parquet(path, compression="zstd")
    return size, total


def _frequencies(shared):
    def run(batches):
        wanted = pa.array(shared.value, pa.string())
        for batch in batches:
            for k in range(batch.num_rows):
                terms, firsts = batch.column(0)[k].values, batch.column(1)[k].values.to_numpy()
                at = pc.index_in(wanted, value_set=terms)
                has = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
                at = at.drop_null().to_numpy().astype(np.int64)
                yield pa.RecordBatch.from_arrays([wanted.take(pa.array(has)), pa.array(firsts[at + 1] - firsts[at], pa.int64())], ["term", "df"])
    return run


def _stretches(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All places of the ranges begin[k]:end[k], one after the other."""
    n = end - begin
    ends = np.cumsum(n)
    return np.repeat(begin - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)


def _summed(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of whole numbers by place, exact also beyond what doubles hold."""
    if float(values.sum(dtype=np.float64)) < 1 << 52:
        return np.bincount(at, values, size).astype(np.int64)
    out = np.zeros(size, np.int64)
    np.add.at(out, at, values)
    return out


class Segment:
    """One segment's postings of the terms that some item asks for."""

    def __init__(self, row: dict, wanted: pa.Array) -> None:
        self.ids, self.begins = row["ids"], row["begins"].to_numpy().astype(np.int64)
        strata, firsts = row["strata"].to_numpy(), row["firsts"].to_numpy().astype(np.int64)
        at = pc.index_in(wanted, value_set=row["terms"])
        self.has = at.is_valid().to_numpy(zero_copy_only=False)
        at = at.fill_null(0).to_numpy().astype(np.int64)
        begin, n = firsts[at], np.where(self.has, firsts[at + 1] - firsts[at], 0)
        every = _stretches(begin, begin + n)
        self.docs, tfs = row["docs"].to_numpy()[every].astype(np.int64), row["tfs"].to_numpy()[every].astype(np.int64)
        term = np.repeat(np.arange(len(wanted)), n)
        stratum = np.searchsorted(self.begins, self.docs, "right") - 1
        change = np.ones(len(every), bool)  # a run of one term, stratum and tf has one impact
        change[1:] = (np.diff(term) != 0) | (np.diff(stratum) != 0) | (np.diff(tfs) != 0)
        run = np.flatnonzero(change)
        one = impact(tfs[run], strata[stratum[run]])
        self.impacts = np.repeat(one, np.diff(np.append(run, len(every))))
        head = np.ones(len(run), bool)  # the first run of a term in a stratum has its highest tf
        head[1:] = (np.diff(term[run]) != 0) | (np.diff(stratum[run]) != 0)
        self.head_at, self.head_stratum, self.head_bound = run[head], stratum[run][head], one[head]
        self.head_end = np.append(self.head_at[1:], len(every))
        self.term_heads = np.searchsorted(term[self.head_at], np.arange(len(wanted) + 1))

    def visit(self, terms: np.ndarray, weights: np.ndarray, least) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(document numbers, scores) of strata by falling bound, as long as the bound is not under least()."""
        heads = _stretches(self.term_heads[terms], self.term_heads[terms + 1])
        w = np.repeat(weights, self.term_heads[terms + 1] - self.term_heads[terms])
        stratum, n = self.head_stratum[heads], len(self.begins)
        bound = _summed(stratum, w * self.head_bound[heads], n)
        order = np.argsort(-bound, kind="stable")
        at, width = 0, FIRST_VISIT
        while at < n:
            turn = order[at:at + width]
            turn = turn[bound[turn] >= max(1, least())]
            if not len(turn):
                return
            open_ = np.zeros(n, bool)
            open_[turn] = True
            pick = np.flatnonzero(open_[stratum])
            begin, end = self.head_at[heads[pick]], self.head_end[heads[pick]]
            posts = _stretches(begin, end)
            scores = _summed(self.docs[posts], np.repeat(w[pick], end - begin) * self.impacts[posts], len(self.ids))
            found = np.flatnonzero(scores >= max(1, least()))
            yield found, scores[found]
            at, width = at + width, width * 4


class Best:
    """The k best (score, doc_id) so far; equal scores by ascending id, no id last."""

    def __init__(self, k: int) -> None:
        self.k, self.scores, self.ids, self.null = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: pa.Array) -> None:
        scores = np.concatenate([self.scores, scores])
        null = np.concatenate([self.null, ids.is_null().to_numpy(zero_copy_only=False)])
        ids = np.concatenate([self.ids, ids.fill_null(0).to_numpy(zero_copy_only=False)])
        best = np.lexsort((ids, null, -scores))[:self.k]
        self.scores, self.ids, self.null = scores[best], ids[best], null[best]


def _searcher(shared, block: int, k: int):
    """shared: (distinct terms, weight of each, and each item's term numbers and repeats)."""
    def run(batches):
        terms, weights, items = shared.value
        wanted, weights = pa.array(terms, pa.string()), np.array(weights, np.int64)
        best = [Best(k) for _ in items]
        asked = [(np.array(t, np.int64), weights[t] * np.array(n, np.int64)) for t, n in items]
        for batch in batches:
            for r in range(batch.num_rows):
                part = Segment({c: batch.column(j)[r].values for j, c in enumerate(batch.schema.names)}, wanted)
                for (t, w), top in zip(asked, best):
                    held = part.has[t]
                    for found, scores in part.visit(t[held], w[held], top.least) if held.any() else ():
                        top.add(scores, part.ids.take(pa.array(found)))
        n = [len(b.scores) for b in best]
        ids = pa.array(np.concatenate([b.ids for b in best] or [np.zeros(0, np.int64)]), pa.int64(),
                       mask=np.concatenate([b.null for b in best] or [np.zeros(0, bool)]))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(sum(n), block), pa.int32()), pa.array(np.repeat(np.arange(len(n)), n), pa.int32()), ids,
                                          pa.array(np.concatenate([b.scores for b in best] or [np.zeros(0, np.int64)]), pa.int64())], FOUND_NAMES)
    return run


FOUND_NAMES = [x.split()[0] for x in FOUND.split(", ")]


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item: first within PLACES shares of the tasks' reports, then of these."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    place = F.pmod(F.monotonically_increasing_id(), F.lit(PLACES))
    within = Window.partitionBy("block", "item", "place").orderBy(*order)
    few = found.withColumn("place", place).withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= k)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("block", "item").orderBy(*order))).where(F.col("rank") <= k)


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> list[DataFrame]:
    """Items in blocks of about `block_chars`, the bound on what is sent to the tasks at once."""
    rows = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    n = -(-(rows.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars)
    return [rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


def search(spark: SparkSession, path: str, size: int, items: DataFrame, k: int = 20, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's k best documents with a score above 0, equal scores by
    ascending doc_id (no id last).

    Items that are NULL, empty or without a known term find nothing; repeated items are answered each; an empty
    index or item table gives an empty result.
    """
    index, out = spark.read.schema(INDEX).parquet(path), None
    for number, block in enumerate(item_blocks(items, block_chars)):
        rows = [(r.item_id, Counter(terms_of(r.text))) for r in block.collect()]  # at most some `block_chars`
        terms = sorted({t for _, asked in rows for t in asked})
        shared = spark.sparkContext.broadcast(terms)
        each = index.select("terms", "firsts").mapInArrow(_frequencies(shared), "term string, df bigint")
        with one_row_batches(spark):
            df = dict(each.groupBy("term").agg(F.sum("df")).collect())  # the block's terms
        at = {t: j for j, t in enumerate(terms)}
        asked = [([at[t] for t in sorted(c)], [c[t] for t in sorted(c)]) for _, c in rows]
        block_state = spark.sparkContext.broadcast((terms, [weight(df.get(t, 0), size) for t in terms], asked))
        with one_row_batches(spark):  # a task holds one segment at a time; it reports k documents an item, which are kept
            reported = cut(index.mapInArrow(_searcher(block_state, number, k), FOUND))
        found = _ranked(reported, k)
        names = spark.createDataFrame([(j, item) for j, (item, _) in enumerate(rows)], f"item int, item_id {dict(items.dtypes)['item_id']}")
        named = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = named if out is None else out.unionByName(named)
    return out if out is not None else spark.createDataFrame([], f"item_id {dict(items.dtypes)['item_id']}, rank int, doc_id bigint, score bigint")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Index all documents and search them for all items; see `build_index` and `search`."""
    path = scratch(docs.sparkSession, "strata")
    size, _ = build_index(docs, path)
    return search(docs.sparkSession, path, size, items, k, block_chars)
