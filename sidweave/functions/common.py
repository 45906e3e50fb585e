"""Portable scalar expressions: md5 picks, ids, rounding, array slicing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOT = re.compile(r"(\{\w+\})")


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def key_text(*parts) -> Column:
    return F.concat_ws("|", *[_c(p).cast("string") for p in parts])


def hash_int(*parts) -> Column:
    """First 32 bits of the md5 of the joined parts, as a BIGINT."""
    return F.conv(F.substring(F.md5(key_text(*parts)), 1, 8), 16, 10).cast("bigint")


def hash_unit(*parts) -> Column:
    """Uniform double in [0, 1) from the same bits."""
    return hash_int(*parts) / F.lit(4294967296.0)


def pick_index(n, *parts) -> Column:
    """Seeded choice 0..n-1 (n: int or column) that does not depend on row order or partitioning."""
    return F.pmod(hash_int(*parts), _c(n).cast("bigint")).cast("int")


def pick(options: list[str], *parts) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), pick_index(len(options), *parts) + 1)


def fill(options: list[str], values: dict[str, Column], *parts) -> Column:
    """The picked wording with its `{name}` slots filled.

    Wordings are cut at their slots before any value is known, so braces inside a value stay as they are.
    """
    def filled(option: str) -> Column:
        pieces = [p for p in SLOT.split(option) if p]
        return F.concat(*[values[p[1:-1]] if SLOT.fullmatch(p) and p[1:-1] in values else F.lit(p) for p in pieces])

    at = pick_index(len(options), *parts)
    out = filled(options[-1])
    for i in range(len(options) - 2, -1, -1):
        out = F.when(at == i, filled(options[i])).otherwise(out)
    return out


def stable_uuid(*parts) -> Column:
    """UUID-shaped id that a retried task reproduces exactly."""
    h = F.md5(key_text(*parts))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts])


def once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    The optimizer copies a projected expression into later filters and lambdas; a one-element
    generator keeps an expensive one (parsing, tokenising) in its place.
    """
    fields = F.struct(*[c.alias(k) for k, c in cols.items()])
    kept = [F.col(f"`{c}`") for c in df.columns if c not in cols]
    return df.select("*", F.explode(F.array(fields)).alias("_once")).select(*kept, "_once.*")


def bound(value: Column, use) -> Column:
    """use(value) with the value computed once, however often `use` names it, also inside its lambdas."""
    return F.get(F.transform(F.array(value), use), 0)


def r6(col) -> Column:
    """Six decimals; adding zero folds -0.0 into 0.0."""
    return F.round(_c(col).cast("double"), 6) + F.lit(0.0)


def head(arr: Column, n: int) -> Column:
    return F.slice(arr, 1, n)


def tail(arr: Column, n: int) -> Column:
    """Most recent n; a negative start in slice() would empty short arrays."""
    return F.slice(arr, F.greatest(F.size(arr) - n, F.lit(0)) + 1, F.lit(n))


def non_empty(col: Column) -> Column:
    return col.isNotNull() & (col != "")


def strip(col: Column) -> Column:
    """Trim every white space kind, not only blanks."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def non_blank(col: Column) -> Column:
    return col.isNotNull() & (strip(col) != "")


def mask_select(values: Column, mask: Column) -> Column:
    """values[mask == 1]; NULL unless both arrays have the same length."""
    chosen = F.transform(
        F.filter(F.arrays_zip(values.alias("v"), mask.alias("m")), lambda x: x["m"] == 1),
        lambda x: x["v"],
    )
    return F.when(F.size(values) == F.size(mask), chosen)


def array_sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda s, x: s + x.cast("double"))
