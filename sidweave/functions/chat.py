"""Chat, segment and metadata JSON of training rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text_part(text: Column) -> Column:
    return F.struct(F.lit("text").alias("type"), text.alias("text"))


def message(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), F.array(_text_part(text)).alias("content"))


def chat_json(query: Column, answer: Column, system: Column | None = None) -> Column:
    """System (if given), user and assistant turn."""
    turns = [message("user", query), message("assistant", answer)]
    return F.to_json(F.array(*([] if system is None else [message("system", system)]), *turns))


def segments_json(text: Column) -> Column:
    return F.to_json(F.array(_text_part(text)))


def meta_json(**cols: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(k) for k, c in cols.items()]))
