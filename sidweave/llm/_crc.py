"""Check sums of a whole from the check sums of its parts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

POLY = 0xEDB88320  # fixed value: the reflected CRC-32 polynomial


def _times(matrix: list[int], v: int) -> int:
    out = 0
    for row in matrix:
        if v & 1:
            out ^= row
        v >>= 1
        if not v:
            break
    return out


def shift(crc: int, n_bytes: int) -> int:
    """The check sum after n_bytes zero bytes, by repeated squaring of the one-bit step."""
    step, bits = [POLY, *(1 << k for k in range(31))], n_bytes * 8
    while bits:
        if bits & 1:
            crc = _times(step, crc)
        step, bits = [_times(step, x) for x in step], bits >> 1
    return crc


def combine(parts: list[tuple[int, int]]) -> int:
    """crc32 of a concatenation from (crc32, byte length) of its parts, in order."""
    total = 0
    for crc, size in parts:
        total = shift(total, size) ^ crc
    return total


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    g = group.sort_values("start")
    crc = combine([(int(c), 4 * int(n)) for c, n in zip(g.ids_crc32, g.n_tokens)])
    return pd.DataFrame({"doc_id": g.doc_id.astype("Int64").iloc[:1], "start": [int(g.start.iloc[0])], "n_tokens": [int(g.n_tokens.sum())], "ids_crc32": [crc]})


def joined(parts: DataFrame) -> DataFrame:
    """Documents from their parts (doc_id, start, n_tokens, ids_crc32, ends).

    At most a few parts per shard get here. Parts of one document share doc_id; a running count of the
    ends before a part tells repeated rows with one doc_id apart.
    """
    w = Window.partitionBy("doc_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    numbered = parts.withColumn("nth", F.coalesce(F.sum(F.col("ends").cast("int")).over(w), F.lit(0)))
    return numbered.groupBy("doc_id", "nth").applyInPandas(_merge, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
