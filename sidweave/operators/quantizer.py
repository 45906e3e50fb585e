"""Residual k-means item tokenizer: training, encoding, decoding, loss."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import hash_unit
from ..session import cut

REL_EPS = 1e-4
GRAIN = 1 << 20  # centres are means of values taken to this part of one, so that sums are exact in any order
GROUP_BYTES, SUM_BYTES, STEP_ROWS = 140_000_000, 64_000_000, 1024
START_ROUNDS, SPLIT = 4, 1 / 1024


def load_embeddings(df: DataFrame, key: str, column: str, dim: int) -> DataFrame:
    """Key and the first `dim` values as floats; empty vectors are skipped."""
    return df.where(F.size(column) > 0).select(key, F.slice(column, 1, dim).cast("array<float>").alias("embedding"))


def _nearest(x: np.ndarray, centres: np.ndarray, distance: bool = False):
    """Index of the nearest centre (the first one on a tie at twelve digits), or the squared distance to it.

    `centres` are floats. One float product narrows each row down to the centres within its rounding error;
    these are measured in doubles, so the choice is that of doubles at half the memory.
    """
    sizes = (centres.astype(np.float64) ** 2).sum(axis=1)
    code, gap = np.empty(len(x), np.int64), np.empty(len(x))
    for lo in range(0, len(x), STEP_ROWS):
        own = x[lo:lo + STEP_ROWS]
        rough = sizes.astype(np.float32) - 2 * (own.astype(np.float32) @ centres.T)
        reach = 4 * 6e-8 * x.shape[1] * (np.linalg.norm(own, axis=1) * np.sqrt(sizes.max()) + sizes.max())
        row, col = np.nonzero(rough <= (rough.min(axis=1) + reach)[:, None])
        exact = np.concatenate([((own[row[i:i + 4096]] - centres[col[i:i + 4096]]) ** 2).sum(axis=1) for i in range(0, len(row), 4096)])
        order = np.lexsort((col, np.round(exact, 12), row))
        first = order[np.searchsorted(row[order], np.arange(len(own)))]
        code[lo:lo + STEP_ROWS], gap[lo:lo + STEP_ROWS] = col[first], exact[first]
    return gap if distance else code


def _stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def _groups(codebook: list[np.ndarray], limit: int = GROUP_BYTES) -> Iterator[list[np.ndarray]]:
    """Layers as floats, in runs whose size is under `limit`: what a worker holds at a time. A layer over it is refused."""
    group, held = [], 0
    for layer in codebook:
        size = layer.size * 4
        if size > limit:
            raise ValueError(f"a layer of {size} bytes is over the limit of {limit} for what is sent to the workers at once")
        if group and held + size > limit:
            yield group
            group, held = [], 0
        group.append(layer.astype(np.float32))
        held += size
    if group:
        yield group


def _encoder(shared, last: bool):
    """Codes of the shared layers and what they leave over; nothing asks for that behind the last layer."""
    @F.pandas_udf("codes array<int>, rest array<double>")
    def run(vectors: pd.Series) -> pd.DataFrame:
        if not len(vectors):
            return pd.DataFrame({"codes": [], "rest": []})
        rest, codes = _stacked(vectors), []
        for centres in shared.value:
            codes.append(_nearest(rest, centres))
            rest -= centres[codes[-1]]
        return pd.DataFrame({"codes": list(np.stack(codes, 1).astype(np.int32)), "rest": [None] * len(rest) if last else list(rest)})

    return run


def _decoder(shared, at: int):
    @F.pandas_udf("array<double>")
    def run(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype=object)
        picked = np.stack(rows.to_numpy())[:, at:]
        total = np.zeros((len(rows), shared.value[0].shape[1]))
        for k, layer in enumerate(shared.value[:picked.shape[1]]):
            total += layer[picked[:, k]]
        return pd.Series(list(total))  # rows of the matrix: lists would hold an object for each value

    return run


def encode(df: DataFrame, column: str, codebook: list[np.ndarray], n_layers: int | None = None, limit: int = GROUP_BYTES) -> DataFrame:
    """Adds `codes`. The codebook (layers x codes x dim) is sent in groups of layers of at most `limit` bytes; each
    group passes its codes and what is left of the vector on to the next."""
    out = df.withColumns({"codes": F.array().cast("array<int>"), "_rest": F.col(column).cast("array<double>")})
    groups = list(_groups(codebook if n_layers is None else codebook[:n_layers], limit))
    for number, layers in enumerate(groups):
        step = _encoder(df.sparkSession.sparkContext.broadcast(layers), number + 1 == len(groups))
        out = out.withColumn("_step", step("_rest")).withColumns({"codes": F.concat("codes", "_step.codes"), "_rest": F.col("_step.rest")}).drop("_step")
    return out.drop("_rest")


def decode(df: DataFrame, codes: str, codebook: list[np.ndarray], limit: int = GROUP_BYTES) -> DataFrame:
    """Adds `decoded`: the sum of the chosen centres, group after group of layers as in `encode`."""
    total, at = None, 0
    for layers in _groups(codebook, limit):
        own, at = _decoder(df.sparkSession.sparkContext.broadcast(layers), at)(F.col(codes)), at + len(layers)
        total = own if total is None else F.zip_with(total, own, lambda a, b: a + b)
    return df.withColumn("decoded", total)


def _with_nearest(df: DataFrame, centres: np.ndarray, to: str) -> DataFrame:
    """key, x -> the nearest centre (to="code"), the squared distance to it ("gap"), or x minus it ("rest")."""
    shared = df.sparkSession.sparkContext.broadcast(next(_groups([centres]))[0])

    @F.pandas_udf({"code": "int", "gap": "double", "rest": "array<double>"}[to])
    def run(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        x = _stacked(vectors)
        found = _nearest(x, shared.value, to == "gap")
        return pd.Series((x - shared.value[found]).tolist() if to == "rest" else found)

    return df.withColumn(to, run("x"))


PARTIAL = "code int, n bigint, sums array<bigint>"


def _partial_sums(shared):
    """Rows and sums of each code, in units of 1 / GRAIN; a task holds at most about SUM_BYTES of sums at a time."""
    def rows(held: dict[int, list]) -> pa.RecordBatch:
        codes = sorted(held)
        flat = np.concatenate([held[c][1] for c in codes]).astype(np.int64)
        edges = np.arange(len(codes) + 1) * (len(flat) // len(codes))
        return pa.RecordBatch.from_arrays([pa.array(codes, pa.int32()), pa.array([held[c][0] for c in codes], pa.int64()),
                                           pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat))], ["code", "n", "sums"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            lists = batch.column(0)
            if not len(lists):
                continue
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
            code = _nearest(x, shared.value)
            order = np.argsort(code, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], np.diff(code[order]) > 0]))
            for c, rows_of in zip(code[order][first].tolist(), np.split(order, first[1:])):
                whole = np.floor(x[rows_of] * GRAIN + 0.5).sum(axis=0)  # whole numbers, exact in doubles
                entry = held.setdefault(c, [0, np.zeros(x.shape[1])])
                entry[0] += len(rows_of)
                entry[1] += whole
            if len(held) * x.shape[1] * 8 > SUM_BYTES:
                yield rows(held)
                held = {}
        if held:
            yield rows(held)
    return run


def _merge_sums(group: pd.DataFrame) -> pd.DataFrame:
    """One code's partial sums, one or a few for each task."""
    n = int(group["n"].sum())
    mean = np.stack(group["sums"].to_numpy()).sum(axis=0) / GRAIN / n
    return pd.DataFrame({"code": group["code"].iloc[:1], "n": [n], "centre": [(np.floor(mean * 1e6 + 0.5) / 1e6).tolist()]})


def lloyd_step(rows: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(new centres, rows of each): a row with its vector per centre comes to the driver, which is the model itself.

    An empty centre takes over half of the one with the most rows: both stand at its mean, moved a little apart.
    """
    shared = rows.sparkSession.sparkContext.broadcast(next(_groups([centres]))[0])
    partial = rows.select("x").mapInArrow(_partial_sums(shared), PARTIAL)
    merged = partial.groupBy("code").applyInPandas(_merge_sums, "code int, n bigint, centre array<double>").toPandas()
    new, n = centres.copy(), np.zeros(len(centres), np.int64)
    n[merged["code"]] = merged["n"]
    if len(merged):
        new[merged["code"]] = np.stack(merged["centre"].to_numpy())
    sizes, sign = n.copy(), np.where(np.arange(centres.shape[1]) % 2 == 0, 1 + SPLIT, 1 - SPLIT)
    for empty in np.flatnonzero(n == 0):
        fullest = int(sizes.argmax())
        if sizes[fullest] < 2:
            break  # fewer rows than centres
        new[empty], new[fullest] = np.round(new[fullest] * sign, 6), np.round(new[fullest] * (2 - sign), 6)
        sizes[empty] = sizes[fullest] // 2
        sizes[fullest] -= sizes[empty]
    return new, n


def start_centres(rows: DataFrame, layer: int, k: int, seed: int) -> np.ndarray:
    """k spread-out rows of (key, x) as a start.

    From the row with the smallest hash on, each of START_ROUNDS rounds takes rows by chance in proportion to their
    squared distance from those taken before, about 2k in all; each of them is weighted by the rows nearest to it, and
    k are chosen one by one, always the one with the largest weight times squared distance. Chance is a hash of the
    key and sums are exact decimals, so the choice does not depend on the partitioning.
    """
    order = F.struct(F.md5(F.concat_ws("|", F.lit(seed), F.lit(layer), F.col("key").cast("string"))), "x")
    first = rows.agg(F.min(order).alias("m"), F.count(F.lit(1)).alias("n")).select("m.x", "n").first()
    if first.n <= 2 * k:  # few enough to take them all
        taken = np.array([r.x for r in rows.orderBy("x").select("x").collect()], np.float64).reshape(first.n, -1)
    else:
        taken = np.array([first.x], np.float64)
        for turn in range(START_ROUNDS):
            measured = _with_nearest(rows, taken, "gap")
            total = float(measured.agg(F.sum(F.round("gap", 9).cast("decimal(38,9)"))).first()[0])
            if total == 0:
                break
            chance = F.col("gap") * (2 * k / START_ROUNDS / total)
            more = measured.where(hash_unit(seed, layer, turn, F.col("key")) < chance).select("x").toPandas()["x"].tolist()
            taken = np.unique(np.concatenate([taken, np.array(more, np.float64).reshape(-1, taken.shape[1])]), axis=0)
    weight = np.zeros(len(taken))
    for r in _with_nearest(rows, taken, "code").groupBy("code").count().collect():  # about 2k rows
        weight[r.code] = r["count"]
    chosen = [int(weight.argmax())]
    gap = ((taken - taken[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(k, len(taken)):
        best = int((weight * gap).argmax()) if (weight * gap).max() > 0 else int(np.setdiff1d(np.arange(len(taken)), chosen)[0])
        chosen.append(best)
        gap = np.minimum(gap, ((taken - taken[best]) ** 2).sum(axis=1))
    out = np.round(taken[chosen], 6)
    return out if len(out) == k else np.concatenate([out, np.repeat(out[-1:], k - len(out), axis=0)])


def train(df: DataFrame, key: str, column: str, n_layers: int = 3, k: int = 8192, seed: int = 42,
          max_iter: int = 20, start: list[np.ndarray] | None = None) -> list[np.ndarray]:
    """One k-means per layer on what the layers before left over. Returns the codebook.

    A layer starts from `start` if given, else from `start_centres`, and takes at most `max_iter` Lloyd steps, fewer
    if one changes nothing. The codebook does not depend on the partitioning.
    """
    rest = cut(df.select(F.col(key).alias("key"), F.col(column).cast("array<double>").alias("x")))
    codebook = []
    for layer in range(n_layers):
        centres = start_centres(rest, layer, k, seed) if start is None else np.asarray(start[layer], np.float64)
        for _ in range(max_iter):
            centres, before = lloyd_step(rest, centres)[0], centres
            if (centres == before).all():
                break
        codebook.append(centres)
        if layer + 1 < n_layers:
            rest = cut(_with_nearest(rest, centres, "rest").select("key", F.col("rest").alias("x")))
    return codebook


def codebook_from_rows(rows: DataFrame, n_layers: int) -> list[np.ndarray]:
    """Codebook table (layer, code, centre) to arrays; its size is that of the model."""
    pdf = rows.orderBy("layer", "code").toPandas()
    return [np.stack(pdf[pdf["layer"] == i]["centre"].to_numpy()).astype(np.float64) for i in range(n_layers)]


def reconstruction_loss(df: DataFrame, x: str, out: str) -> DataFrame:
    """Mean squared error and mean relative error over all elements."""
    sq = F.zip_with(x, out, lambda a, b: (b - a) * (b - a))
    rel = F.zip_with(x, out, lambda a, b: F.abs(a - b) / (F.greatest(F.abs(a), F.abs(b)) + REL_EPS))

    def total(arr: Column) -> Column:
        return F.aggregate(arr, F.lit(0.0), lambda s, v: s + v)

    per_row = df.select(total(sq).alias("sq"), total(rel).alias("rel"), F.size(x).alias("n"))
    return per_row.agg((F.sum("sq") / F.sum("n")).alias("loss"), (F.sum("rel") / F.sum("n")).alias("rel_loss"))
