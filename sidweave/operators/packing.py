"""Sequence packing.

Rows are tokenised once. Keys alone are numbered globally; the key of each shard's first row tells where whole rows
belong, so token arrays move once, to the task that packs their shards one after the other. There the greedy fold goes
along the rows in order and puts each pack together as it closes; a task holds one open pack.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .numbering import first_keys, shard_of
from .tokens import itemic_mask

FLUSH_TOKENS = 1 << 20


class Packer:
    """The greedy fold of one shard after the other.

    A row that would reach max_length closes the pack: with cut_to_pad it is shortened to fit and goes in,
    otherwise it opens the next pack. The last pack of a shard is kept.
    """

    def __init__(self, max_length: int, cut_to_pad: bool) -> None:
        self.max_length, self.cut_to_pad, self.shard, self.pack, self.used = max_length, cut_to_pad, None, 0, 0
        self.open: list[tuple] = []  # (ids, mask, source, epoch) of the rows in the open pack
        self.done: list[tuple] = []

    def close(self) -> None:
        if self.open:
            self.done.append((self.shard, self.pack, self.open))
            self.pack += 1
        self.open, self.used = [], 0

    def add(self, shard: int, ids: np.ndarray, mask: np.ndarray, source, epoch) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.pack = shard, 0
        full = self.used + len(ids) >= self.max_length
        if full and not self.cut_to_pad:
            self.close()
        take = min(len(ids), self.max_length - self.used) if full and self.cut_to_pad else len(ids)
        self.open.append((ids[:take], mask[:take], source, epoch))
        self.used += take
        if full and self.cut_to_pad:
            self.close()

    def packs(self, schema: dict[str, pa.DataType]) -> pa.RecordBatch:
        """The closed packs as rows; they are forgotten here."""
        rows = [r for _, _, rows in self.done for r in rows]
        sizes = [len(rows) for _, _, rows in self.done]
        takes = np.array([len(r[0]) for r in rows], np.int32)
        edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        run = np.concatenate([[0], np.cumsum(takes)])
        ends = (run[1:] - np.repeat(run[edges[:-1]], sizes)).astype(np.int32)
        epochs = [[r[3] for r in rows if r[3] is not None] for _, _, rows in self.done]
        flat = [pa.array(np.concatenate([r[k] for r in rows] or [np.zeros(0, np.int32)]), schema[c]) for k, c in enumerate(("ids", "mask"))]
        by_token, by_row = pa.array(run[edges], pa.int32()), pa.array(edges, pa.int32())
        cells = [pa.array([s for s, _, _ in self.done], pa.int64()), pa.array([p for _, p, _ in self.done], pa.int32()),
                 *(pa.ListArray.from_arrays(by_token, f) for f in flat), pa.ListArray.from_arrays(by_row, pa.array(takes)),
                 pa.ListArray.from_arrays(by_row, pa.array(ends)), pa.ListArray.from_arrays(by_row, pa.array([r[2] for r in rows], pa.string())),
                 pa.array([float(np.mean(e)) if e else None for e in epochs], pa.float64())]
        self.done = []
        return pa.RecordBatch.from_arrays(cells, ["shard", "pack", "ids", "mask", "takes", "ends", "sources", "epoch"])


def _assemble(max_length: int, cut_to_pad: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, held, schema = Packer(max_length, cut_to_pad), 0, None
        for batch in batches:
            lists = [batch.column(c) for c in ("input_ids", "loss_mask")]
            schema = {k: x.type.value_type for k, x in zip(("ids", "mask"), lists)}
            flat = [x.values.to_numpy(zero_copy_only=False) for x in lists]
            edges = [x.offsets.to_numpy() for x in lists]
            rest = zip(*(batch.column(c).to_pylist() for c in ("shard", "source", "epoch")))
            for k, (shard, source, epoch) in enumerate(rest):
                ids, mask = (f[e[k]:e[k + 1]].copy() for f, e in zip(flat, edges))
                packer.add(shard, ids, mask, source, epoch)
                held += len(ids)
                if held > FLUSH_TOKENS and packer.done:
                    yield packer.packs(schema)
                    held = 0
        packer.close()
        if packer.done:
            yield packer.packs(schema)
    return run


def padded_length(tokens: Column, max_length: int) -> Column:
    """Next multiple of eight of the longer of pack and limit, plus 64."""
    return (F.floor((F.greatest(tokens, F.lit(max_length)) + 7) / 8) * 8 + 64).cast("int")


def pack_rows(rows: DataFrame, order: list[str], max_length: int, cut_to_pad: bool = True,
              shard_rows: int = 10_000, pad_id: int = 0) -> DataFrame:
    """Packs of (input_ids, loss_mask, source, epoch) rows: padded ids, positions inside each sample, loss
    and item masks, sample index per token, cumulative lengths (of the samples, and of the pack for full
    attention), sources and mean epoch. `order` is a unique key without NULL. Packs without a loss token are dropped."""
    spark, keys = rows.sparkSession, [F.col(c) for c in order]
    tokens = cut(rows.select("input_ids", "loss_mask", "source", "epoch", *order))  # tokenised once
    bounds = first_keys(tokens, shard_rows, keys)
    parts = max(1, min(len(bounds), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    laid = tokens.withColumn("shard", shard_of(bounds, spark, keys)).repartition(parts, "shard").sortWithinPartitions("shard", *order)
    types = dict(tokens.dtypes)
    schema = (f"shard bigint, pack int, ids {types['input_ids']}, mask {types['loss_mask']}, takes array<int>, ends array<int>, "
              "sources array<string>, epoch double")
    packs = laid.select("shard", "input_ids", "loss_mask", F.col("source").cast("string").alias("source"), F.col("epoch").cast("double").alias("epoch")).mapInArrow(
        _assemble(max_length, cut_to_pad), schema)
    joined = packs.select(
        "shard", "pack", "epoch", "ids", "mask", "ends", "sources",
        F.flatten(F.transform("takes", lambda n, i: F.array_repeat(i, n))).alias("sample_idx"),
        F.flatten(F.transform("takes", lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")))).alias("position_ids"))
    joined = joined.where(F.exists("mask", lambda m: m != 0)).withColumn("tokens", F.size("ids"))
    pad = padded_length(F.col("tokens"), max_length) - F.col("tokens")
    whole = padded_length(F.col("tokens"), max_length)
    return joined.select(
        "shard", "pack", "tokens", "epoch", "sources",
        F.concat("ids", F.array_repeat(F.lit(pad_id), pad)).alias("input_ids"),
        F.concat("mask", F.array_repeat(F.lit(0), pad)).alias("loss_mask"),
        F.concat("position_ids", F.array_repeat(F.lit(0), pad)).alias("position_ids"),
        F.concat(itemic_mask(F.col("ids")), F.array_repeat(F.lit(0), pad)).alias("item_mask"),
        F.concat("sample_idx", F.array_repeat(F.lit(-1), pad)).alias("sample_idx"),
        F.concat(F.array(F.lit(0)), "ends", F.array(whole)).alias("cu_seqlens"), F.array(F.lit(0), whole).alias("full_seqlens"))

