"""Corpus contract checks and repair of escaped text."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGES = "array<struct<role:string,content:array<struct<type:string,text:string>>>>"
SEGMENTS = "array<struct<type:string,text:string>>"
UUID = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
ROLES = ["user", "assistant", "system"]


@F.pandas_udf(T.StringType())
def _reencode(cells: pd.Series) -> pd.Series:
    def one(cell):
        if cell is None:
            return None
        try:
            return json.dumps(json.loads(cell), ensure_ascii=False, separators=(",", ":"))
        except ValueError:
            return cell
    return cells.map(one)


@F.pandas_udf(T.StringType())
def _readable(cells: pd.Series) -> pd.Series:
    return cells.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))


def repair_escapes(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Re-encode JSON cells that hold unicode escapes; of binary cells, bytes that are no UTF-8 are dropped.
    All other cells never reach Python."""
    present = [f for f in (fields or ["messages", "segments"]) if f in df.columns]
    types = dict(df.dtypes)
    for f in present:
        cell = F.col(f)
        if types[f] == "binary":
            whole = F.try_validate_utf8(cell.cast("string"))
            cell = F.coalesce(whole, _readable(F.when(whole.isNull(), cell)))
        escaped = F.contains(cell, F.lit("\\u"))
        df = df.withColumn(f, F.when(escaped, _reencode(F.when(escaped, cell))).otherwise(cell))
    return df


def _valid(col: Column) -> Column:
    return F.coalesce(col, F.lit(False))


def contract_rules() -> dict[str, Column]:
    """One boolean per documented rule, true when the row keeps it."""
    messages = F.from_json("messages", MESSAGES)
    segments = F.from_json("segments", SEGMENTS)
    has_messages, has_segments = F.col("messages").isNotNull(), F.col("segments").isNotNull()

    def every(arr: Column, test) -> Column:
        return _valid((F.size(arr) > 0) & F.forall(arr, lambda x: _valid(test(x))))

    return {
        "uuid_form": _valid(F.col("uuid").rlike(UUID)),
        "source_set": _valid(F.col("source") != ""),
        "metadata_object": _valid(F.from_json("metadata", "map<string,string>").isNotNull()),
        "message_fields": ~has_messages | every(messages, lambda m: m["role"].isNotNull() & m["content"].isNotNull()),
        "roles": ~has_messages | every(messages, lambda m: m["role"].isin(ROLES)),
        "content_type": ~has_messages | every(messages, lambda m: F.forall(m["content"], lambda c: c["type"] == "text")),
        "segment_type": ~has_segments | every(segments, lambda s: s["type"] == "text"),
        "has_payload": has_messages | has_segments,
    }


def check_rows(rows: DataFrame) -> DataFrame:
    return rows.select("*", *[c.alias(n) for n, c in contract_rules().items()])


def contract_report(rows: DataFrame) -> DataFrame:
    """Violations per source and rule, plus uuids used more than once in the source."""
    rules = contract_rules()
    broken = check_rows(rows).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum((~F.col(r)).cast("int")).alias(r) for r in rules])
    twice = rows.groupBy("source", "uuid").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dup = twice.groupBy("source").agg(F.count(F.lit(1)).alias("uuid_repeated"))
    return broken.join(dup, broken["source"].eqNullSafe(dup["source"]), "left").select(
        broken["source"], "n", *rules, F.coalesce("uuid_repeated", F.lit(0)).alias("uuid_repeated"))
