"""Quality by a sparse rule ensemble.

Statistics of whole texts are made where the texts are read. On a bounded labelled sample, shallow trees
are grown on bootstrap samples; every path from a root is a rule, a conjunction of bounds on statistics.
Lasso logistic regression keeps few rules, and those become one Spark column expression over the
statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _labels, _text

SAMPLE, TREES, DEPTH, BINS, PENALTY, STEPS, SEED = 20_000, 40, 3, 32, 0.001, 400, 7
#: Frequent function words of four languages.
COMMON = frozenset(("the of and to in a is that for it as was with be by on not he his but at are this have from or an they which "
                    "der die und das von zu den mit ist des ein im dem nicht auf für eine auch als es an sich "
                    "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il "
                    "el los las y que en un por con una su para como del al lo más o este sí porque").split())
STATS = ("words", "word_size", "longest", "distinct_words", "distinct_pairs", "common_words", "lines", "line_words", "distinct_lines",
         "ended_lines", "lower", "upper", "digits", "blanks", "stops", "symbols", "bars", "beyond_ascii", "capital_words", "lone_marks")


def _classes() -> np.ndarray:
    """Byte -> class: 0 lower, 1 upper, 2 digit, 3 blank, 4 full stop and the like, 5 other ASCII, 6 bar, 7 beyond ASCII."""
    table = np.full(256, 5)
    table[128:] = 7
    for k, chars in enumerate((range(97, 123), range(65, 91), range(48, 58), (9, 10, 11, 12, 13, 32), map(ord, ".,;:!?'\"()-"))):
        table[list(chars)] = k
    table[ord("|")] = 6
    return table


CLASSES = _classes()


def statistics(text: str) -> list[float]:
    """The values of STATS; all shares are of words, pairs, lines or bytes. An empty text has zeros."""
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = np.bincount(CLASSES[raw], minlength=8) / max(1, len(raw))
    n, m = max(1, len(words)), max(1, len(lines))
    return [float(len(words)), len(text) / n, float(max(map(len, words), default=0)), len(set(words)) / n,
            len(set(zip(words, words[1:]))) / max(1, n - 1), sum(map(COMMON.__contains__, map(str.lower, words))) / n,
            float(len(lines)), n / m, len(set(lines)) / m, sum(x.rstrip()[-1] in ".!?" for x in lines) / m,
            *kinds[:4].tolist(), *kinds[4:8].tolist(), sum(w[0].isupper() for w in words) / n, sum(len(w) == 1 and not w.isalnum() for w in words) / n]


def _measure(keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_text = keep
        for batch in batches:
            kept = [batch.column(c) for c in range(batch.num_columns) if c != at_text]
            names = [n for n in batch.schema.names if n != "text"]
            for at, texts in _text.slices(batch):
                values = np.array([statistics(t) for t in texts]).reshape(len(texts), len(STATS))
                yield pa.RecordBatch.from_arrays([c.slice(at, len(texts)) for c in kept] + [pa.array(values[:, k]) for k in range(len(STATS))],
                                                 [*names, *STATS])
    return run


def measured(rows: DataFrame) -> DataFrame:
    """`rows` with STATS in place of text."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]
    return rows.mapInArrow(_measure(rows.columns.index("text")), ", ".join([*fields, *(f"`{s}` double" for s in STATS)]))


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, bound), all of which must hold


def tree_rules(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int = DEPTH) -> set[Rule]:
    """Rules of all nodes but the root of a tree grown on a bootstrap sample with random statistics."""
    rows = rng.integers(0, len(y), len(y))
    x, y, rules = x[rows], y[rows], set()

    def grow(at: np.ndarray, path: Rule, left: int) -> None:
        best = (1e-9, None, None)
        for s in rng.permutation(x.shape[1])[: max(1, x.shape[1] // 2)]:
            v = x[at, s]
            bounds = np.unique(np.quantile(v, np.linspace(0, 1, BINS + 1)[1:-1]))
            slot = np.searchsorted(bounds, v, "left")  # slot k: bounds[k-1] < v <= bounds[k]
            n = np.bincount(slot, minlength=len(bounds) + 1)
            p = np.bincount(slot, y[at], len(bounds) + 1)
            nl, pl = np.cumsum(n)[:-1], np.cumsum(p)[:-1]
            nr, pr = len(at) - nl, p.sum() - pl
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where((nl >= 5) & (nr >= 5), pl * pl / nl + pr * pr / nr - p.sum() ** 2 / len(at), -1)
            k = int(np.argmax(gain)) if len(gain) else 0
            if len(gain) and gain[k] > best[0]:
                best = (gain[k], int(s), float(bounds[k]))
        _, s, bound = best
        if s is None:
            return
        for above in (False, True):
            rule = (*path, (s, above, bound))
            rules.add(rule)
            inside = at[(x[at, s] > bound) == above]
            if left > 1 and len(inside) >= 20:
                grow(inside, rule, left - 1)

    if len(y) >= 10:
        grow(np.arange(len(y)), (), depth)
    return rules


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([(x[:, s] > bound) == above for s, above, bound in rule])


def lasso(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient steps; the intercept is not penalised."""
    n, scale = len(y), 4.0 / max(1e-9, float((z * z).sum(1).mean()) + 1)
    w, b, v, c, t = np.zeros(z.shape[1]), 0.0, np.zeros(z.shape[1]), 0.0, 1.0
    for _ in range(steps):
        g = 1 / (1 + np.exp(-(z @ v + c))) - y
        w1, b1 = v - scale * (z.T @ g) / n, c - scale * g.mean()
        w1 = np.sign(w1) * np.maximum(np.abs(w1) - scale * penalty, 0)
        t1 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = w1 + (t - 1) / t1 * (w1 - w), b1 + (t - 1) / t1 * (b1 - b)
        w, b, t = w1, b1, t1
    return b, w


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, seed: int = SEED) -> tuple[float, list[tuple[Rule, float]]]:
    """Intercept and weighted rules; with one class or no rows only a smoothed intercept."""
    share = (y.sum() + 1) / (len(y) + 2)
    if len(np.unique(y)) < 2:
        return float(np.log(share / (1 - share))), []
    rng = np.random.default_rng(seed)
    rules = sorted(set().union(*(tree_rules(x, y, rng) for _ in range(trees))))
    if not rules:  # too few rows for a tree
        return float(np.log(share / (1 - share))), []
    z = np.stack([holds(r, x) for r in rules], 1).astype(float)
    spread = z.std(0)
    z, rules = z[:, spread > 0], [r for r, s in zip(rules, spread) if s > 0]
    mean = z.mean(0)
    b, w = lasso(z - mean, y)
    return float(b - mean @ w), [(r, float(v)) for r, v in zip(rules, w) if v]


def compiled(intercept: float, rules: list[tuple[Rule, float]]) -> Column:
    """The ensemble as one column over the statistics."""
    def holds_here(rule: Rule) -> Column:
        return reduce(lambda a, b: a & b, [F.col(STATS[s]) > bound if above else F.col(STATS[s]) <= bound for s, above, bound in rule])

    total = reduce(lambda a, b: a + b, [F.when(holds_here(r), F.lit(w)).otherwise(F.lit(0.0)) for r, w in rules], F.lit(intercept))
    return 1 / (1 + F.exp(-total))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = SAMPLE):
    """Fit on the statistics (numbers only) of about `bound` labelled rows at most."""
    chosen = F.broadcast(_labels.sample(labels, label, bound))
    rows = _text.rows(docs).join(chosen, "doc_id").select("doc_id", F.xxhash64("doc_id", "text").alias("turn"), "label", "text")
    table = measured(rows).toPandas().sort_values(["turn", "doc_id"])
    return fit(table[list(STATS)].to_numpy(float), table["label"].to_numpy(float))


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3, bound: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted per row.

    Scores depend on the text alone; NULL and empty texts have all statistics zero. Without labelled rows
    every score is 0.5. Repeated rows get equal scores; other columns are ignored; an empty table gives
    an empty result.
    """
    intercept, rules = train(docs, labels, label, bound)
    scored = measured(_text.rows(docs, _labels.held_out().alias("held_out"))).withColumn("score", compiled(intercept, rules))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
