"""Best-fit packing of token sequences, certified by dual-feasible lower bounds.

Texts are encoded in the tasks that read them; only lengths travel. Pieces are dealt over pack
partitions by a hash, each partition runs best-fit decreasing and compares its bin count with the
largest of two families of dual-feasible bounds. A partition whose count equals its bound is
certified and final. The others have a gap: they exchange documents (all their pieces are dealt anew,
with another salt, over fewer and larger partitions) and run best-fit decreasing again, until no gap is
left, one partition is left, or `rounds` exchanges are done; no partition exceeds `most` pieces much.
Rounding leaves each certified partition up to one bin over its share of the whole bound, so at the end
all partitions give up their `LOOSE` emptiest bins, which are packed together and kept if fewer.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import _text
from ._memo import memo

SIZE, MOST, ROUNDS, SHRINK, LOOSE = 2048, 400_000, 4, 8, 48
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = PIECES + ", part int, bin bigint, offset bigint, bins bigint, bound bigint, loose boolean"


def _pieces(vocab: str, kind: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _text.runs(batch):
                flat, edges = memo(kind, vocab).ids(texts)
                docs, cols = batch.column(0).slice(at, len(texts)), ([], [], [], [], [])
                for k in range(len(texts)):
                    ids = np.append(flat[edges[k]:edges[k + 1]], end_id).astype("<u4")
                    raw = memoryview(ids.tobytes())
                    for p, s in enumerate(range(0, len(ids), size)):
                        n = min(size, len(ids) - s)
                        for c, v in zip(cols, (k, p, s, n, zlib.crc32(raw[4 * s:4 * (s + n)]))):
                            c.append(v)
                row, piece, start, length, crc = cols
                yield pa.RecordBatch.from_arrays(
                    [docs.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, vocab: str, kind: str = "word", size: int = SIZE, end_id: int = 0,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of each whole text and `end_id`, cut into pieces of `size` where longer."""
    return _text.rows(docs, id_col=id_col, text_col=text_col).mapInArrow(_pieces(vocab, kind, size, end_id), PIECES)


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """Bins that any packing needs: the largest bound over two families of dual-feasible functions.

    For a threshold t up to size/2, items over size - t count as a whole bin, items under t as nothing
    and the rest by their length. For k, an item x counts floor((k+1)x/size)/k bins, or x/size where
    (k+1)x/size is whole.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=size + 1).astype(np.int64)[:size + 1]
    x = np.arange(size + 1, dtype=np.int64)
    below_n, below_sum = np.cumsum(count), np.cumsum(count * x)
    t = np.arange(0, size // 2 + 1)
    whole = below_n[size] - below_n[size - t]
    middle = below_sum[size - t] - np.where(t > 0, below_sum[np.maximum(t - 1, 0)], 0)
    best = int((whole + -(-middle // size)).max())
    big = below_n[size] - below_n[size // 2]  # items over half a bin: never two together
    over = below_sum[size - t] - below_sum[size // 2]
    n_over = below_n[size - t] - below_n[size // 2]
    small = np.where(t > 0, below_sum[size // 2] - below_sum[np.maximum(t - 1, 0)], below_sum[size // 2])
    best = max(best, int((big + np.maximum(0, -(-(small - (n_over * size - over)) // size))).max()))
    for k in range(1, 33):
        q, r = np.divmod((k + 1) * x, size)
        scaled = np.where(r == 0, x * k, q * size)  # in units of 1 / (k * size)
        best = max(best, int(-(-int((scaled * count).sum()) // (k * size))))
    return best


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset, bins) of each item. Items of a full bin are placed at once; the other bins' free
    space is one bit set, so the tightest bin is a shift and a lowest bit."""
    order = np.argsort(-lengths, kind="stable")
    where, offset = np.empty(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    full = int((lengths >= size).sum())
    where[order[:full]] = np.arange(full)
    bins, free, by_room = full, 0, {}
    for i, n in zip(order[full:].tolist(), lengths[order[full:]].tolist()):
        fits = free >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            stack = by_room[room]
            b = stack.pop()
            if not stack:
                free ^= 1 << room
        else:
            b, room, bins = bins, size, bins + 1
        where[i], offset[i] = b, size - room
        if room > n:
            left = room - n
            if left not in by_room or not by_room[left]:
                by_room[left] = []
                free |= 1 << left
            by_room[left].append(b)
    return where, offset, bins


def _pack(size: int, parts: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        lengths = group.length.to_numpy()
        where, offset, bins = best_fit_decreasing(lengths, size)
        filled = np.bincount(where, lengths, bins)
        emptiest = np.zeros(bins, bool)
        emptiest[np.argsort(filled, kind="stable")[:LOOSE]] = True
        return group.assign(bin=where, offset=offset, bins=bins, bound=lower_bound(lengths, size), loose=emptiest[where])
    return run


def _dealt(table: DataFrame, parts: int, salt: int, size: int) -> DataFrame:
    """One round: pieces dealt over pack partitions and packed, kept in a checkpoint."""
    place = F.pmod(F.xxhash64(F.lit(salt), "doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(parts)).cast("int")
    dealt = table.select("doc_id", "piece", "start", "length", "ids_crc32", place.alias("part"))
    return cut(dealt.groupBy("part").applyInPandas(_pack(size, parts), PACKED))


def _placed(packed: DataFrame, turn: int) -> DataFrame:
    sequence = (F.lit(turn).cast("bigint") * F.lit(1 << 20) + F.col("part")) * F.lit(1 << 36) + F.col("bin")
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset", "loose")


def pack(table: DataFrame, size: int = SIZE, most: int = MOST, rounds: int = ROUNDS) -> DataFrame:
    """Pieces with sequence_id and offset.

    An empty table gives an empty result. Lengths are 1 to `size`.
    """
    table = cut(table)
    spark, total = table.sparkSession, table.count()
    parts = max(1, min(_text.partitions(table), total // 2000 + 1), -(-total // most))
    done = None
    for turn in range(rounds + 1):
        packed = _dealt(table, parts, turn, size)
        state = packed.groupBy("part").agg(F.max("bins").alias("bins"), F.max("bound").alias("bound"), F.count(F.lit(1)).alias("n")).collect()
        gaps = [r.part for r in state if r.bins > r.bound]
        last = not gaps or turn == rounds or len(state) == 1
        certified = F.col("bins") == F.col("bound")
        kept = _placed(packed if last else packed.where(certified), turn)
        done = kept if done is None else done.unionByName(kept)
        if last:
            break
        table = packed.where(~certified)
        rows = sum(r.n for r in state if r.bins > r.bound)
        parts = max(1, -(-len(gaps) // SHRINK), -(-rows // most))
    loose = done.where("loose")
    before, n = loose.agg(F.countDistinct("sequence_id"), F.count(F.lit(1))).first()
    again = _dealt(loose, max(1, -(-n // most)), rounds + 1, size)
    after = again.select("part", "bin").distinct().count()
    out = done.where("NOT loose").unionByName(_placed(again, rounds + 1)) if after < before else done
    return out.drop("loose")


def best_fit_packing(docs: DataFrame, vocab: str, kind: str = "word", size: int = SIZE, end_id: int = 0,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every whole text's pieces in as few sequences of `size` ids as certified packing finds.

    NULL and empty texts are one piece of the end id; repeated rows are packed each; a NULL id is kept;
    other columns are ignored; an empty table gives an empty result.
    """
    return pack(pieces(docs, vocab, kind, size, end_id, id_col, text_col), size)
