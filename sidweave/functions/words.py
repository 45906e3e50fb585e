"""Words of whole Arrow batches, by table lookups on their bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The characters that separate words, as the pattern \s of Spark's split has them.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(every word of the texts in order, the row it stands in). NULL counts as empty."""
    texts = pc.fill_null(texts, "")
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    bounds = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    bounds -= bounds[0]
    inside = ~SPACE[raw]
    head = inside.copy()
    head[1:] &= ~inside[:-1]
    edge = bounds[:-1][bounds[:-1] < len(raw)]
    head[edge] = inside[edge]
    begin = np.flatnonzero(head)
    letters = raw[inside]
    ends = np.append(np.concatenate([[0], np.cumsum(inside)])[begin], len(letters)).astype(np.int32)
    found = pa.Array.from_buffers(pa.string(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
    return found.dictionary_encode(), np.searchsorted(bounds, begin, "right") - 1


def pieces(lengths: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """(from, to) runs of rows of about `limit` in all, one row at least."""
    ends, at, out = np.cumsum(lengths), 0, []
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        out.append((at, to))
        at = to
    return out
