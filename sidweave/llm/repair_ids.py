"""Token ids in grammar-compressed shards, and random access to them.

Documents are range-partitioned by id and encoded in order; every `block` ids make a shard. Re-Pair
replaces frequent neighbouring id pairs by nonterminals: each pass counts the pairs of the shard, makes a
rule for each that is found LEAST times and replaces its occurrences from left to right (of two that
overlap, the first); it stops when no pair is found LEAST times, after as many passes and rules as that
takes. A shard row holds

    part, shard           range partition and place in it
    first, n_ids          ids of the partition before the shard, ids in it
    docs, starts, lengths the documents' parts in it (a text longer than a shard continues in the next)
    rules                 little-endian u32 pairs; rule k stands for nonterminal base + k
    sizes                 u32 expansion length of each rule
    base, symbols         first nonterminal, and the shard as u32 symbols

in Parquet files, so that commits, retries and any file system are Spark's. Expansion lengths let a
reader seek: `expand` decodes a range and skips every symbol outside it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch
from . import _text
from ._crc import joined
from ._memo import memo

BLOCK, LEAST = 1 << 18, 12
SLOT_BITS, NO_RULE = 18, np.uint32((1 << 32) - 1)
SLOTS = 1 << SLOT_BITS
SHARD = pa.schema([("part", pa.int32()), ("shard", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()),
                   ("docs", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("ends", pa.list_(pa.bool_())),
                   ("base", pa.int64()), ("rules", pa.binary()), ("sizes", pa.binary()), ("symbols", pa.binary())])
SHARD_DDL = ("part int, shard bigint, first bigint, n_ids bigint, docs array<bigint>, starts array<bigint>, lengths array<bigint>, "
             "ends array<boolean>, base bigint, rules binary, sizes binary, symbols binary")


def compress(ids: np.ndarray, least: int = LEAST):
    """(base, rules as pairs, expansion lengths, symbols) of one shard's ids, in which no pair is found `least` times.

    Of two chosen pairs with one slot in the lookup table only one becomes a rule in that pass. A pair of
    symbols that a pass has counted too rarely can only become rarer, so later passes count the others.
    """
    base = int(ids.max()) + 1 if len(ids) else 0
    seq, pairs, sizes = ids.astype(np.uint32), [np.zeros((0, 2), np.uint32)], np.ones(base, np.int64)
    slot_rule = np.empty(SLOTS, np.uint32)
    live = np.ones(max(0, len(seq) - 1), bool)  # the pair that begins here may be frequent
    while True:
        wide, bits = (np.uint32, 16) if len(sizes) <= 1 << 16 else (np.uint64, 32)
        at = np.flatnonzero(live)
        keys = seq[at].astype(wide) << wide(bits) | seq[at + 1].astype(wide)
        ordered = np.sort(keys)
        cuts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[:len(ordered)])
        counts = np.diff(np.append(cuts, len(ordered)))
        often = np.flatnonzero(counts >= least)
        if not len(often):
            break
        often = often[np.argsort(-counts[often], kind="stable")]
        chosen = ordered[cuts[often]][::-1]  # the most frequent is written last and stays
        slot_key = np.zeros(SLOTS, wide)  # key 0 is no pair that a slot stands for unless its rule says so
        slot_rule[:] = NO_RULE
        slots = _slots(chosen)
        slot_key[slots] = chosen
        slot_rule[slots] = np.arange(len(chosen), dtype=np.uint32)
        slots = _slots(keys)
        rule = slot_rule[slots]
        live[at] = rule != NO_RULE  # chosen, or in a chosen pair's slot
        found = (slot_key[slots] == keys) & (rule != NO_RULE)
        hits, picked = at[found], rule[found]
        run = np.concatenate([[True], np.diff(hits) > 1])  # in a run of overlapping hits, every other one
        heads = np.maximum.accumulate(np.where(run, np.arange(len(hits)), 0))
        taken = (np.arange(len(hits)) - heads) % 2 == 0
        hits, picked = hits[taken], picked[taken]
        used = np.bincount(picked, minlength=len(chosen)) > 0
        number = np.cumsum(used) - 1
        both, fresh = chosen[used], np.uint32(len(sizes))
        seq[hits] = fresh + number[picked].astype(np.uint32)
        keep = np.ones(len(seq), bool)
        keep[hits + 1] = False
        live = np.append(live, False)[keep][:-1]
        seq = seq[keep]
        new = seq >= fresh
        live |= new[:-1] | new[1:]
        pairs.append(np.stack([both >> wide(bits), both & wide((1 << bits) - 1)], 1).astype(np.uint32))
        sizes = np.concatenate([sizes, sizes[pairs[-1]].sum(1)])
    return base, np.concatenate(pairs), sizes[base:].astype(np.uint32), seq


def _slots(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def expand(base: int, pairs: np.ndarray, sizes: np.ndarray, symbols: np.ndarray, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids [start, stop) of a shard; symbols outside the range are skipped by their expansion lengths."""
    table = np.concatenate([np.ones(base, np.int64), sizes.astype(np.int64)])
    ends = np.cumsum(table[symbols]) if len(symbols) else np.zeros(0, np.int64)
    stop = int(ends[-1]) if stop is None and len(ends) else stop or 0
    lo, hi = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
    seq, skipped = symbols[lo:hi], int(ends[lo - 1]) if lo else 0
    at = ends[lo:hi] - table[seq] - skipped
    out = np.empty(int(ends[lo:hi][-1]) - skipped if len(seq) else 0, np.uint32)
    while len(seq):
        rule = seq >= base
        out[at[~rule]] = seq[~rule]
        left, right = pairs[seq[rule] - base].T
        seq, at = np.concatenate([left, right]), np.concatenate([at[rule], at[rule] + table[left]])
    return out[start - skipped:stop - skipped]


def _writer(vocab: str, kind: str, block: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, shard, first = TaskContext.get().partitionId(), 0, 0
        held, docs, lengths, ends, room = [], [], [], [], block

        def flush():
            nonlocal shard, first, held, docs, lengths, ends, room
            ids = np.concatenate(held)
            base, pairs, sizes, seq = compress(ids)
            starts = np.cumsum([0, *lengths[:-1]]).tolist()
            row = dict(part=part, shard=shard, first=first, n_ids=len(ids), docs=docs, starts=starts, lengths=lengths, ends=ends, base=base,
                       rules=pairs.astype("<u4").tobytes(), sizes=sizes.astype("<u4").tobytes(), symbols=seq.astype("<u4").tobytes())
            shard, first, held, docs, lengths, ends, room = shard + 1, first + len(ids), [], [], [], [], block
            return pa.RecordBatch.from_pylist([row], schema=SHARD)

        for batch in batches:
            ids_of = batch.column(0)
            for at, texts in _text.runs(batch):
                flat, edges = memo(kind, vocab).ids(texts)
                for k in range(len(texts)):
                    own = np.append(flat[edges[k]:edges[k + 1]], np.uint32(end_id)).astype(np.uint32)
                    while len(own):
                        take = own[:room]
                        held.append(take)
                        docs.append(ids_of[at + k].as_py())
                        lengths.append(len(take))
                        own, room = own[len(take):], room - len(take)
                        ends.append(len(own) == 0)
                        if room == 0:
                            yield flush()
        if held:
            yield flush()
    return run


def write_shards(docs: DataFrame, vocab: str, path: str, kind: str = "byte", block: int = BLOCK, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append `end_id` and write shards in ascending (id, text) order. Ranges are cut
    by the id alone, so the sample of range bounds holds no texts."""
    ordered = _text.rows(docs, id_col=id_col, text_col=text_col).repartitionByRange(
        _text.partitions(docs), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_writer(vocab, kind, block, end_id), SHARD_DDL).write.parquet(path, compression="zstd")


def _reader(offsets: dict[int, int]):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                pairs = np.frombuffer(r["rules"], "<u4").reshape(-1, 2)
                ids = expand(r["base"], pairs, np.frombuffer(r["sizes"], "<u4"), np.frombuffer(r["symbols"], "<u4")).astype("<u4")
                raw = memoryview(ids.tobytes())
                crcs = [zlib.crc32(raw[4 * s:4 * (s + n)]) for s, n in zip(r["starts"], r["lengths"])]
                begin = offsets[r["part"]] + r["first"]
                yield pa.RecordBatch.from_arrays([
                    pa.array(r["docs"], pa.int64()), pa.array([begin + s for s in r["starts"]], pa.int64()), pa.array(r["lengths"], pa.int64()),
                    pa.array(crcs, pa.int64()), pa.array(r["ends"], pa.bool_()),
                    pa.array([k == 0 and r["shard"] > 0 for k in range(len(crcs))], pa.bool_())],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "ends", "opens"])
    return run


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 decoded from the shards' grammars, one row per document.

    Partition totals (one number per range partition) become start offsets; ids stay in the tasks.
    A document that runs over shards is joined from its parts' check sums. The parts, a few numbers each, are
    written before they are told apart, so that every shard is expanded once.
    """
    shards = spark.read.parquet(path)
    totals = dict(shards.groupBy("part").agg(F.sum("n_ids")).collect())
    offsets, before = {}, 0
    for part in sorted(totals):
        offsets[part], before = before, before + totals[part]
    parts = shards.mapInArrow(_reader(offsets), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ends boolean, opens boolean")
    found = scratch(spark, "repair_parts")
    parts.write.parquet(found)
    parts = spark.read.parquet(found)
    whole = parts.where("ends AND NOT opens")
    # of the first entry of a shard only the previous shard knows whether it begins a document
    rest = parts.where("NOT (ends AND NOT opens)")
    return whole.drop("ends", "opens").unionByName(joined(rest))
