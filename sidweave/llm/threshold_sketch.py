"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every distinct shingle hash (64 bits, unsigned) below a fixed fraction of the hash space,
sorted. Its size follows the document's, so sketches of very unequal documents stay comparable, and the
sketch of a union is the union of sketches. Everything is built of SQL functions.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import once
from . import _text

WORDS, FRACTION = 5, 0.125
SPACE = "[\\x20\\x09-\\x0D]+"


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def sketch_of(words: Column, size: int = WORDS, fraction: float = FRACTION) -> Column:
    """Sorted kept hashes of a word array. Fewer words than `size`: one shingle of them all; none: empty."""
    places = F.sequence(F.lit(0), F.greatest(F.size(words) - size, F.lit(0)))
    hashes = F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    limit = int(fraction * 2 ** 64)  # unsigned: hashes from 2**63 on are negative
    below = (lambda h: (h >= 0) & (h < F.lit(limit))) if limit < 2 ** 63 else (lambda h: (h >= 0) | (h < F.lit(limit - 2 ** 64)))
    kept = F.array_sort(F.array_distinct(F.filter(hashes, below if limit < 2 ** 64 else lambda h: F.lit(True))))
    return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(kept)


def merged(a: Column, b: Column) -> Column:
    """Sketch of both documents together."""
    return F.array_sort(F.array_union(a, b))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; NULL if a's sketch is empty."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a))


def likeness(a: Column, b: Column, equal: Column) -> Column:
    """Containment of the smaller in the larger sketch; where a sketch is empty, whether the texts are equal."""
    known = (F.size(a) > 0) & (F.size(b) > 0)
    shared = F.size(F.array_intersect(a, b)) / F.least(F.size(a), F.size(b))
    return F.when(known, shared).otherwise(F.when(equal, F.lit(1.0)).otherwise(F.lit(0.0)))


def printed(sketch: Column) -> Column:
    """The sketch as text: its hashes as hexadecimal numbers."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.hex(h))), ".")


def with_sketch(docs: DataFrame, size: int = WORDS, fraction: float = FRACTION, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, sketch per row (NULL text: empty text, empty sketch)."""
    rows = once(_text.rows(docs, id_col=id_col, text_col=text_col), words=word_list(F.col("text")))
    return once(rows, sketch=sketch_of(F.col("words"), size, fraction)).drop("words")


def _bucket(bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most doc_id, by two short searches; NULL ids: 0."""
    if not bounds:
        return F.lit(0)
    wide = isqrt(len(bounds)) + 1
    parts = [bounds[i:i + wide] for i in range(0, len(bounds), wide)]
    longs = lambda xs: F.array(*[F.lit(x).cast("bigint") for x in xs])
    part = F.size(F.filter(longs([p[0] for p in parts[1:]]), lambda b: b <= F.col("doc_id"))) if len(parts) > 1 else F.lit(0)
    inside = F.size(F.filter(F.element_at(F.array(*[longs(p) for p in parts]), part + 1), lambda b: b <= F.col("doc_id")))
    return F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(part * wide + inside)


def with_next(rows: DataFrame, cols: list[str], per_task: int = 4) -> DataFrame:
    """Add next_<col> of the row that follows in ascending (doc_id, text) order, NULL ids first; the last is followed by the first.

    Rows are dealt into ranges of ids, so one exchange moves each row once. The rows that open a range are
    also sent to the range before it (and those that open the table to the last), as ghosts that only
    serve as successors.
    """
    n = _text.partitions(rows) * per_task
    shares = F.array(*[F.lit(k / n) for k in range(1, n)])
    stats = rows.agg(F.min("doc_id").alias("least"), F.percentile_approx("doc_id", shares, max(10_000, 20 * n)).alias("cuts"),
                     F.max(F.col("doc_id").isNull()).alias("nulls")).first()
    bounds = sorted({c for c in (stats.cuts or []) if c != stats.least or stats.nulls})
    last = len(bounds)
    opens = F.col("doc_id").isNull() if stats.nulls else F.col("doc_id") == F.lit(stats.least)
    is_bound = F.col("doc_id").isin(bounds) if len(bounds) <= 10 else F.array_contains(F.array(*[F.lit(b).cast("bigint") for b in bounds]), F.col("doc_id"))
    spot = lambda b, ghost: F.struct(b.cast("int").alias("_range"), F.lit(ghost).alias("_ghost"))
    own = _bucket(bounds)
    places = F.filter(F.array(spot(own, 0), F.when(F.coalesce(is_bound, F.lit(False)), spot(own - 1, 1)), F.when(F.coalesce(opens, F.lit(False)), spot(F.lit(last), 2))),
                      lambda x: x.isNotNull())
    dealt = rows.select("*", F.explode(places).alias("_spot")).select(*rows.columns, "_spot.*")
    order = Window.partitionBy("_range").orderBy("_ghost", F.col("doc_id").asc_nulls_first(), "text")
    followed = dealt.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in cols])
    return followed.where("_ghost = 0").drop("_range", "_ghost")


def edited_likeness(docs: DataFrame, size: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """Sketches of every text and of its edited text (its last half replaced by the next document's
    beginning), and the likeness of the text's sketch to the edited text's and to the next document's.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. NULL texts are
    empty; ties of doc_id are ordered by text; a single row is its own successor; an empty table gives an
    empty result; other columns are ignored.
    """
    rows = with_next(with_sketch(docs, size, fraction), ["text", "sketch"])
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.length("text") - half), F.left("next_text", half))
    rows = once(rows, edited=edited)
    rows = once(rows, n_chars=F.length("text").cast("bigint"), edited_sha256=F.sha2("edited", 256), words=word_list(F.col("edited")),
                same_edited=F.col("text") == F.col("edited"), same_next=F.col("text") == F.col("next_text"))
    rows = once(rows.drop("text", "next_text", "edited"), edited_sketch=sketch_of(F.col("words"), size, fraction))
    return rows.select("doc_id", "n_chars", "edited_sha256", printed(F.col("sketch")).alias("fingerprint"),
                       printed(F.col("edited_sketch")).alias("edited_fingerprint"),
                       likeness(F.col("sketch"), F.col("edited_sketch"), F.col("same_edited")).alias("near_edited"),
                       likeness(F.col("sketch"), F.col("next_sketch"), F.col("same_next")).alias("near_next"))
