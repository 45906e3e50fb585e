"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_CHARS, RUN_BYTES = 2_000_000, 8_000_000


def rows(docs: DataFrame, *extra: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (NULL text: empty), so extra columns can never clash."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), text, *extra)


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of rows holding about SLICE_CHARS, so Python strings stay bounded."""
    at = batch.schema.get_field_index(column)
    texts, first, held, begun = batch.column(at), 0, [], 0
    for i in range(batch.num_rows):
        t = texts[i].as_py() or ""
        held.append(t)
        begun += len(t)
        if begun >= SLICE_CHARS:
            yield first, held
            first, held, begun = i + 1, [], 0
    if held:
        yield first, held


def runs(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, pa.Array]]:
    """As slices, but Arrow texts; runs are cut by bytes."""
    texts = batch.column(batch.schema.get_field_index(column))
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + RUN_BYTES)) + 1
        yield at, texts.slice(at, to - at)
        at = to


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
