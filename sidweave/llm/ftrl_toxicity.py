"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of hashed words, word pairs and pairs with one word between them. The bounded
labelled sample (about SAMPLE rows at most) is learnt by FTRL-proximal: per-coordinate rates, L1 and L2.
L1 leaves few weights, which are broadcast as (bucket, weight) pairs: at most 2**BITS of them, whatever
the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _labels, _text
from ._memo import release

BITS, SAMPLE, EPOCHS = 20, 20_000, 6
ALPHA, BETA, L1, L2 = 1.5, 1.0, 5.0, 1.0
WORD = re.compile(r"\w+")
MIX = np.uint64(0x9E3779B97F4A7C15)


def features(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every word, word pair and skip pair."""
    words = [WORD.findall(t.lower()) for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    coded = pa.array([w for ws in words for w in ws], pa.string()).dictionary_encode()
    names = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    h = names[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    shift = np.uint64(64 - bits)
    out = [(owner, ((h + np.uint64(1)) * MIX) >> shift)]
    for gap in (1, 2):
        same = owner[:-gap] == owner[gap:]
        pair = (h[:-gap] + np.uint64(gap)) * MIX + h[gap:]
        out.append((owner[:-gap][same], ((pair * MIX) >> shift)[same]))
    return np.concatenate([o for o, _ in out]), np.concatenate([b for _, b in out]).astype(np.int64)


class Ftrl:
    """Per-coordinate state z, n; the weight is zero while |z| is at most L1."""

    def __init__(self, size: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> None:
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) > self.l1, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2), 0.0)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        root = np.sqrt(self.n[at])
        self.n[at] += g * g
        self.z[at] += g - (np.sqrt(self.n[at]) - root) / self.alpha * w


def _rows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for at, texts in _text.slices(batch):
                owner, bucket = features(texts, bits)
                once = np.unique(owner << np.int64(bits) | bucket)
                ends = np.searchsorted(once >> bits, np.arange(len(texts) + 1))
                buckets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(once & ((1 << bits) - 1), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(at, len(texts)) for c in (2, 3)] + [buckets], ["label", "turn", "buckets"])
    return run


def _train(bits: int, epochs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, bias = [], 1 << bits  # the last coordinate
        for batch in batches:
            for label, at in zip(batch.column(0).to_pylist(), batch.column(2)):
                rows.append((np.append(at.values.to_numpy(), bias).astype(np.int32), label))
        model = Ftrl(bias + 1)
        for _ in range(epochs):
            for at, label in rows:
                model.learn(at, label)
        w = model.weights(np.arange(bias + 1))
        kept = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(w[kept])], ["bucket", "weight"])
    return run


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = SAMPLE, bits: int = BITS,
          epochs: int = EPOCHS) -> dict[int, float]:
    """bucket -> weight; {} if no row is labelled. Features are made where the rows are read; only the
    bounded sample's buckets go to the one task that runs the updates, in an order set by a hash."""
    chosen = F.broadcast(_labels.sample(labels, label, bound))
    rows = _text.rows(docs).join(chosen, "doc_id").select("doc_id", "text", "label", F.xxhash64("doc_id", "text").alias("turn"))
    made = rows.mapInArrow(_rows(bits), "label int, turn bigint, buckets array<int>")
    model = made.repartition(1).sortWithinPartitions("turn").mapInArrow(_train(bits, epochs), "bucket bigint, weight double")
    return dict(model.collect())  # at most 2**bits + 1 numbers


def _score(bits: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        weights = np.zeros((1 << bits) + 1)
        buckets, values = shared.value
        weights[buckets] = values
        for batch in batches:
            for at, texts in _text.slices(batch):
                owner, bucket = features(texts, bits)
                hit = np.flatnonzero(weights[bucket])
                once = np.unique(owner[hit] << np.int64(bits) | bucket[hit])  # presence, not count
                total = np.bincount(once >> bits, weights[once & ((1 << bits) - 1)], len(texts)) + weights[1 << bits]
                score = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(at, len(texts)) for c in (0, 2)] + [pa.array(score)],
                                                 ["doc_id", "held_out", "score"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5, bound: int = SAMPLE,
             bits: int = BITS, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, held_out, score, predicted per row.

    Scores depend on the text alone: NULL and empty texts get the bias. Without labelled rows every score
    is 0.5. Repeated rows get equal scores; other columns are ignored; an empty table gives an empty result.
    """
    model = train(docs, labels, label, bound, bits, epochs)
    shared = docs.sparkSession.sparkContext.broadcast((np.array(list(model), np.int64), np.array(list(model.values()), float)))
    scored = _text.rows(docs, _labels.held_out().alias("held_out")).mapInArrow(_score(bits, shared), "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` that are not rejected, scored where they are read, so no text is shuffled."""
    model = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((np.array(list(model), np.int64), np.array(list(model.values()), float)))
    bits, names = BITS, docs.columns

    def run(batches):
        for batch in batches:
            given = pa.RecordBatch.from_arrays([batch.column(names.index("text"))], ["text"])
            scores = np.concatenate([np.zeros(0)] + [x.column(2).to_numpy() for x in _score(bits, shared)(_three(given))])
            yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)


def _three(given: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    n = given.num_rows
    yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), given.column(0), pa.nulls(n, pa.bool_())], ["doc_id", "text", "held_out"])
