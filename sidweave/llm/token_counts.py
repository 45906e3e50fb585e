"""Token counts of whole texts by overlap resynchronisation.

A text of at most `chunk` code points is encoded in one go. A longer one is cut into chunks that
reach `overlap` code points over both ends; the chunks are spread over tasks and encoded with
offsets. A splice point is a place in an overlap at which both chunks end a token and whose two
characters stand next to each other in no piece of the vocabulary, which proves that no token can
cross it whatever surrounds it. A text with a seam that has no such place is encoded again with
overlaps `widen` times as long, and in the end whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import _text
from ._memo import PieceMemo, memo

CHUNK, OVERLAP, WIDEN = 16_384, 256, 8
COUNTED = "doc_id bigint, n_bytes bigint, n_tokens bigint"
PIECES = "row bigint, mark bigint, doc_id bigint, n_bytes bigint, chunk_no bigint, begin bigint, cut_left bigint, cut_right bigint, text string"
CHUNK_ROW = pa.schema([(c, pa.int64()) for c in ("row", "mark", "doc_id", "n_bytes", "chunk_no", "begin", "cut_left", "cut_right")]
                      + [("text", pa.string())])
SEAMS = ("row bigint, mark bigint, doc_id bigint, n_bytes bigint, seam bigint, right_side boolean, "
         "places array<bigint>, before array<bigint>")


def _whole(vocab: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _text.runs(batch):
                _, edges = memo("piece", vocab).ids(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pc.binary_length(texts).cast(pa.int64()),
                     pa.array(np.diff(edges), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
    return run


def _chunks(chunk: int, overlap: int):
    """Chunk texts with their overlaps. cut_left/cut_right: places of the seams (-1: the text's own end)."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row, mark, doc, text = (batch.column(c)[k].as_py() for c in ("row", "mark", "doc_id", "text"))
                size, n = len(text.encode()), len(text)
                step = chunk if 2 * overlap < n else n
                starts = range(0, n, step)
                out = []
                for no, a in enumerate(starts):
                    b, last = a + step, a + step >= n
                    lo, hi = max(0, a - overlap), n if last else min(n, b + overlap)
                    out.append((row, mark, doc, size, no, lo, a if no else -1, -1 if last else b, text[lo:hi]))
                    if len(out) == 64 or last:
                        yield pa.RecordBatch.from_pylist(
                            [dict(zip(CHUNK_ROW.names, x)) for x in out], schema=CHUNK_ROW)
                        out = []
    return run


def token_ends(m: PieceMemo, text: str) -> np.ndarray:
    """Byte offsets at which the tokens of a text end (a literal word mark needs the library's own offsets)."""
    ids = np.frombuffer(m.call([text])[0], np.uint32) if "▁" in text else m.ids(pa.array([text], pa.string()))[0]
    ends = np.cumsum(m.sizes_of[ids]) - 1  # the library's own word mark before the text
    size = len(text.encode())
    if len(ends) and ends[-1] == size:
        return ends
    return np.array([p.end for p in m.library.encode(text, return_type="proto").pieces], np.int64)


def _places(m: PieceMemo, text: str, begin: int, seam: int, overlap: int, ends: np.ndarray):
    """Proven splice points around a seam (document code points) and the tokens before each."""
    lo, hi = max(1, seam - overlap - begin), min(len(text) - 1, seam + overlap - begin)
    good = [p for p in range(lo, hi + 1) if text[p - 1:p + 1] not in m.pairs and _apart(text[p - 1], text[p])]
    offsets, at, sum_ = [], 0, 0
    for p in good:
        sum_ += len(text[at:p].encode())
        at = p
        offsets.append(sum_)
    tokens = np.searchsorted(ends, offsets, "left")
    hit = [(p + begin, int(k) + 1) for p, o, k in zip(good, offsets, tokens) if k < len(ends) and ends[k] == o]
    return [p for p, _ in hit], [k for _, k in hit]


def _apart(left: str, right: str) -> bool:
    """Blanks are word marks inside the pieces; of a run of blanks only its front is a border."""
    return right == " " and left not in " ▁" if " " in (left, right) else True


def _seams(vocab: str, overlap: int):
    def run(batches):
        m = memo("piece", vocab)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ends = token_ends(m, r["text"])
                base = {k: r[k] for k in ("row", "mark", "doc_id", "n_bytes")}
                if r["cut_left"] >= 0:
                    p, k = _places(m, r["text"], r["begin"], r["cut_left"], overlap, ends)
                    out.append(base | {"seam": r["chunk_no"], "right_side": True, "places": p, "before": k})
                if r["cut_right"] >= 0:
                    p, k = _places(m, r["text"], r["begin"], r["cut_right"], overlap, ends)
                    out.append(base | {"seam": r["chunk_no"] + 1, "right_side": False, "places": p, "before": k})
                else:  # the last chunk's tokens, as a seam of its own
                    out.append(base | {"seam": -1, "right_side": False, "places": [0], "before": [len(ends)]})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("row", pa.int64()), ("mark", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("seam", pa.int64()), ("right_side", pa.bool_()),
                 ("places", pa.list_(pa.int64())), ("before", pa.list_(pa.int64()))]))
    return run


def _spliced(long: DataFrame, vocab: str, chunk: int, overlap: int) -> DataFrame:
    """mark, doc_id, n_bytes, n_tokens (NULL: a seam had no common place) of long texts."""
    pieces = long.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_chunks(chunk, overlap), PIECES).repartition(_text.partitions(long), "row", "chunk_no")
    sides = pieces.mapInArrow(_seams(vocab, overlap), SEAMS)
    left, right = (F.max(F.when(F.col("right_side") == side, F.struct("places", "before"))) for side in (False, True))
    seams = sides.groupBy("row", "mark", "doc_id", "n_bytes", "seam").agg(left.alias("l"), right.alias("r"))
    meet = F.array_min(F.array_intersect("l.places", "r.places"))

    def at(side: str):
        return F.element_at(f"{side}.before", F.array_position(f"{side}.places", F.col("meet")).cast("int"))

    one = F.when(F.col("seam") == -1, F.element_at("l.before", 1)).when(F.col("meet").isNotNull(), at("l") - at("r"))
    return seams.withColumn("meet", meet).withColumn("n", one).groupBy("row", "mark", "doc_id", "n_bytes").agg(
        F.when(F.count("n") == F.count(F.lit(1)), F.sum("n")).alias("n_tokens"))


def token_counts(docs: DataFrame, vocab: str, limit: int = 4096, chunk: int = CHUNK, overlap: int = OVERLAP,
                 widen: int = WIDEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text, one row per input row.

    NULL and empty texts have 0 tokens; a NULL id is kept; repeated rows give repeated results; other
    columns are ignored; an empty table gives an empty result. `vocab` is the path of a piece model.
    """
    rows = _text.rows(docs, id_col=id_col, text_col=text_col)
    short = rows.where(F.length("text") <= chunk).mapInArrow(_whole(vocab), COUNTED)
    long = rows.where(F.length("text") > chunk).withColumn("mark", F.xxhash64("doc_id", "text"))
    done, todo = short, long
    while True:
        tried = cut(_spliced(todo, vocab, chunk, overlap))
        done = done.unionByName(tried.where("n_tokens IS NOT NULL").select("doc_id", "n_bytes", "n_tokens"))
        failed = tried.where("n_tokens IS NULL").select("mark")
        if failed.isEmpty():
            return done.withColumn("over_limit", F.col("n_tokens") > limit)
        todo, overlap = long.join(failed, "mark", "left_semi"), overlap * widen
