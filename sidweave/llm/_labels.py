"""Labelled training rows: the fold that may be learnt from, and a bounded sample of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(id_col: str = "doc_id") -> Column:
    """Rows of the fold that is never learnt from (crc32 of the id as text, mod 5, is 0); NULL id: false."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(False))


def sample(labels: DataFrame, label: str, bound: int, id_col: str = "doc_id") -> DataFrame:
    """doc_id, label of about `bound` rows at most, chosen by a hash of the id.

    Held-out ids, NULL ids and NULL labels are left out; of repeated ids the largest label counts.
    """
    rows = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
    rows = rows.where("doc_id IS NOT NULL AND label IS NOT NULL").where(~held_out())
    n = rows.count()
    if n > bound:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) < int((1 << 20) * bound / n))
    return rows.groupBy("doc_id").agg(F.max("label").alias("label"))
