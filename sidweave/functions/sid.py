"""Semantic-id text: three codes written between begin and end marks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import strip

# The id markup, code range and vocabulary base of the published corpus.
SID_BEGIN = "<|sid_begin|>"
SID_END = "<|sid_end|>"
SID_FORMAT = "<|sid_begin|><s_a_%d><s_b_%d><s_c_%d><|sid_end|>"
CODE_RANGE = 8192
LAYER_LETTERS = ["a", "b", "c"]
VOCAB_BASE = 151669

TRIPLE = r"<s_a_(\d+)><s_b_(\d+)><s_c_(\d+)>"
THINK_END = "</think>"
THINK_BEGIN = "<think>"


def sid_text(codes: Column) -> Column:
    return F.format_string(SID_FORMAT, codes[0], codes[1], codes[2])


def pack(a: Column, b: Column, c: Column) -> Column:
    wide = [x.cast("bigint") for x in (a, b, c)]
    return wide[0] * (CODE_RANGE * CODE_RANGE) + wide[1] * CODE_RANGE + wide[2]


def unpack(code: Column) -> Column:
    a = F.floor(code / (CODE_RANGE * CODE_RANGE)).cast("int")
    b = (F.floor(code / CODE_RANGE) % CODE_RANGE).cast("int")
    return F.array(a, b, (code % CODE_RANGE).cast("int"))


def sid_text_of(code: Column) -> Column:
    """Text of a packed id; NULL stays NULL."""
    parts = [F.shiftright(code, 26), F.shiftright(code, 13).bitwiseAND(CODE_RANGE - 1), code.bitwiseAND(CODE_RANGE - 1)]
    a, b, c = (p.cast("string") for p in parts)
    return F.concat(F.lit("<|sid_begin|><s_a_"), a, F.lit("><s_b_"), b, F.lit("><s_c_"), c, F.lit("><|sid_end|>"))


def parse_codes(text: Column) -> Column:
    """First code triple of a text as three ints, NULL when there is none."""
    found = [F.regexp_extract(text, TRIPLE, i) for i in (1, 2, 3)]
    return F.when(found[0] != "", F.array(*[g.cast("int") for g in found]))


def packed_from_text(text: Column) -> Column:
    codes = parse_codes(text)
    return pack(codes[0], codes[1], codes[2])


def code_triples(text: Column) -> Column:
    """All code triples of a text as 'a,b,c' strings, in order, duplicates kept."""
    whole = F.regexp_extract_all(text, F.lit(TRIPLE), F.lit(0))

    def codes(t: Column) -> Column:
        inner = F.substring(t, F.lit(6), F.length(t) - 6)  # behind '<s_a_', before the last '>'
        return F.replace(F.replace(inner, F.lit("><s_b_"), F.lit(",")), F.lit("><s_c_"), F.lit(","))

    return F.transform(whole, codes)


def token_id(layer: Column, code: Column) -> Column:
    return F.lit(VOCAB_BASE) + layer * CODE_RANGE + code


def after_last_think(text: Column) -> Column:
    return F.substring_index(text, THINK_END, -1)


def answer_sids(answer: Column) -> Column:
    """Distinct trimmed contents between begin and end marks, first occurrence order."""
    parts = F.split(answer, r"<\|sid_begin\|>", -1)
    closed = F.filter(parts, lambda p: F.contains(p, F.lit(SID_END)))
    inner = F.transform(closed, lambda p: strip(F.substring_index(p, SID_END, 1)))
    return F.array_distinct(F.filter(inner, lambda x: x != ""))


def answer_part(generation: Column) -> Column:
    """Trimmed text after the last think end."""
    return strip(after_last_think(strip(generation)))


def generation_sids(generations: Column) -> Column:
    """Predicted id of every generation; the answer part is computed once per element."""
    return F.transform(F.transform(generations, answer_part), _sid_of_part)


def generation_sid(generation: Column) -> Column:
    return F.get(generation_sids(F.array(generation)), 0)


def _sid_of_part(tail_text: Column) -> Column:
    """Predicted id of one answer part.

    The text after the last think end is cut at begin marks; the first part that is
    not blank wins, so prose in front of the first begin mark is returned as it is.
    A part with an end mark counts up to that mark.
    """
    has_mark = F.contains(tail_text, F.lit(SID_BEGIN))
    parts = F.split(tail_text, r"<\|sid_begin\|>", -1)
    ids = F.transform(parts, lambda p: strip(F.substring_index(p, SID_END, 1)))
    first = F.get(F.filter(ids, lambda x: x != ""), 0)
    return F.when(has_mark, F.coalesce(first, tail_text)).otherwise(tail_text)
