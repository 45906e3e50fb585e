"""Length balancing. Rows are cut into batches of a fixed number of rows first, so the per-batch
Python step always sees a bounded group; batches run in parallel."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSIGNED = "batch bigint, row_id bigint, length bigint, part int"


def differencing(lengths: list[int], k: int, equal: bool = False) -> list[int]:
    """Part per item by repeatedly merging the two most uneven groupings, heaviest side on lightest.

    A grouping is k (total, items) sides in falling order; with `equal` the groupings start from k
    neighbours in length, so every part ends with the same number of items.
    """
    n = len(lengths)
    if n < k:
        raise ValueError(f"{n} items cannot fill {k} parts")
    if equal and n % k:
        raise ValueError(f"{n} items do not divide into {k} equal parts")
    ranked = sorted(range(n), key=lambda i: (lengths[i], i))
    step = k if equal else 1
    heap = []
    for at in range(0, n, step):
        sides = [(lengths[i], [i]) for i in ranked[at:at + step]]
        sides += [(0, [])] * (k - len(sides))
        sides.sort(key=lambda s: (s[0], s[1]), reverse=True)
        heap.append((sides[-1][0] - sides[0][0], -sides[0][0], at, sides))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, tag, left = heapq.heappop(heap)
        _, _, _, right = heapq.heappop(heap)
        sides = [(a[0] + b[0], a[1] + b[1]) for a, b in zip(left, reversed(right))]
        sides.sort(key=lambda s: (s[0], s[1]), reverse=True)
        heapq.heappush(heap, (sides[-1][0] - sides[0][0], -sides[0][0], tag, sides))
    part = [0] * n
    for number, (_, items) in enumerate(heap[0][3]):
        for i in items:
            part[i] = number
    return part


def least_loaded(lengths: list[int], k: int, equal: bool = False) -> list[int]:
    """Part per item in input order: the lightest part; with `equal` the one with the fewest items first.
    Equal parts need a number of items that k divides."""
    if equal and len(lengths) % k:
        raise ValueError(f"{len(lengths)} items do not divide into {k} equal parts")
    waiting = [(0, 0, j) for j in range(k)]  # (items if equal, load, part)
    part = []
    for n in lengths:
        items, load, j = heapq.heappop(waiting)
        part.append(j)
        heapq.heappush(waiting, (items + equal, load + n, j))
    return part


def _per_batch(df: DataFrame, batch_rows: int, assign) -> DataFrame:
    """`assign(lengths) -> parts` on batches of consecutive rows (row_id, length)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_id")
        return pdf.assign(part=assign([int(x) for x in pdf["length"]]))[["batch", "row_id", "length", "part"]]

    cut = df.select(F.floor(F.col("row_id") / batch_rows).alias("batch"), "row_id", F.col("length").cast("bigint").alias("length"))
    return cut.groupBy("batch").applyInPandas(run, ASSIGNED)


def balanced_parts(df: DataFrame, batch_rows: int, k: int, equal: bool = False) -> DataFrame:
    return _per_batch(df, batch_rows, lambda lengths: differencing(lengths, min(k, len(lengths)), equal))


def greedy_parts(df: DataFrame, batch_rows: int, k: int, equal: bool = False) -> DataFrame:
    return _per_batch(df, batch_rows, lambda lengths: least_loaded(lengths, k, equal))


def micro_batches(df: DataFrame, batch_rows: int, max_tokens: int, divisible_by: int | None = None,
                  at_least: int | None = None) -> DataFrame:
    """Parts of at most about max_tokens tokens, numbered by falling sum of squared lengths."""
    def assign(lengths: list[int]) -> list[int]:
        if max(lengths) > max_tokens:
            raise ValueError("a row is longer than the token budget")
        k = min(len(lengths), -(-sum(lengths) // max_tokens))
        k = max(k, at_least or 1)
        if divisible_by:
            k = -(-k // divisible_by) * divisible_by
        part = differencing(lengths, k)
        work = [0] * k
        first = [len(lengths)] * k
        for i, p in enumerate(part):
            work[p] += lengths[i] ** 2
            first[p] = min(first[p], i)
        order = sorted(range(k), key=lambda p: (-work[p], -first[p]))
        place = {p: at for at, p in enumerate(order)}
        return [place[p] for p in part]

    return _per_batch(df, batch_rows, assign)


def imbalance(parts: DataFrame, batch_rows: int, k: int) -> DataFrame:
    """Per batch: token sums of k contiguous pieces against those of the assigned parts."""
    size = max(1, batch_rows // k)
    piece = F.floor(F.pmod(F.col("row_id"), F.lit(batch_rows)) / size)

    def spread(col, prefix):
        sums = parts.groupBy("batch", col.alias("_p")).agg(F.sum("length").alias("_s"))
        return sums.groupBy("batch").agg(F.min("_s").alias(f"{prefix}min"), F.max("_s").alias(f"{prefix}max"),
                                         F.sum("_s").alias(f"{prefix}total"), F.count(F.lit(1)).alias(f"{prefix}parts"))

    both = spread(piece, "").join(spread(F.col("part"), "balanced_"), "batch")
    return both.select("batch", "min", "max", (F.col("max") - F.col("min")).alias("minmax_diff"), "balanced_min",
                       "balanced_max", (F.col("total") / F.col("balanced_parts")).alias("mean"))
