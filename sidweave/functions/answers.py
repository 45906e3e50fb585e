"""Answer extraction and normalisation for rule rewards, as built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import strip

CLIP = 300  # only the last characters of a solution are searched

# Final-answer substitutions and removals, applied in this order.
SUBSTITUTIONS = [
    ("an ", ""), ("a ", ""), (".$", "$"), ("\\$", ""), ("\\ ", ""), (" ", ""), ("mbox", "text"),
    (",\\text{and}", ","), ("\\text{and}", ","), ("\\text{m}", "\\text{}"),
]
REMOVED = [
    "square", "ways", "integers", "dollars", "mph", "inches", "hours", "km", "units", "\\ldots", "sue",
    "points", "feet", "minutes", "digits", "cents", "degrees", "cm", "gm", "pounds", "meters", "meals",
    "edges", "students", "childrentickets", "multiples", "\\text{s}", "\\text{.}", "\\text{\ns}",
    "\\text{}^2", "\\text{}^3", "\\text{\n}", "\\text{}", "\\mathrm{th}", "^\\circ", "^{\\circ}", "\\;",
    ",\\!", "{,}", "\"", "\\dots",
]
# Literal clean-ups of boxed answers, applied in this order.
BOXED_CLEANUPS = [
    ("\n", ""), ("\\!", ""), ("\\\\", "\\"), ("tfrac", "frac"), ("dfrac", "frac"), ("\\left", ""),
    ("\\right", ""), ("^{\\circ}", ""), ("^\\circ", ""), ("\\$", ""),
]


def _replace_all(text: Column, pairs) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def last_chars(text: Column, n: int) -> Column:
    return F.right(text, F.lit(n))


def final_number(text: Column, flexible: bool = False) -> Column:
    """Last `#### n` without commas, or (flexible) the last number that is not a bare dot."""
    # The patterns below.
    clip = last_chars(text, CLIP)
    if not flexible:
        found = F.regexp_extract_all(clip, F.lit(r"#### (\-?[0-9\.\,]+)"), F.lit(1))
        return F.replace(F.try_element_at(found, F.lit(-1)), F.lit(","), F.lit(""))
    found = F.regexp_extract_all(clip, F.lit(r"(\-?[0-9\.\,]+)"), F.lit(1))
    real = F.filter(found, lambda x: x != ".")
    return F.coalesce(F.try_element_at(real, F.lit(-1)), F.get(found, 0))


def _last_after(text: Column, marker: str) -> Column:
    """Text from the last marker on (marker included), NULL without one."""
    tail = F.element_at(F.split(text, r"\Q" + marker + r"\E", -1), -1)
    return F.when(F.contains(text, F.lit(marker)), F.concat(F.lit(marker), tail))


def _balanced(text: Column) -> Column:
    """Prefix of the text up to the brace that closes the first opened one, NULL when it never closes.

    The text is cut behind every brace, so the fold takes one step per brace, not per character.
    """
    pieces = F.regexp_extract_all(text, F.lit(r"[^{}]*[{}]"), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("seen"), F.lit(0).alias("end"))

    def step(acc: Column, piece: Column) -> Column:
        closing = F.endswith(piece, F.lit("}"))
        depth = acc["depth"] + F.when(closing, -1).otherwise(1)
        seen = acc["seen"] + F.length(piece)
        done = (acc["end"] == 0) & closing & (depth == 0)
        return F.struct(depth.alias("depth"), seen.alias("seen"),
                        F.when(done, seen).otherwise(acc["end"]).alias("end"))

    end = F.aggregate(pieces, start, step)["end"]
    return F.when(end > 0, F.substring(text, F.lit(1), end))


def boxed_span(text: Column) -> Column:
    """Inside of the last balanced boxed expression written with braces, NULL without one."""
    span = _balanced(_last_after(text, "\\boxed{"))
    return F.substring(span, F.lit(len("\\boxed{") + 1), F.length(span) - len("\\boxed{") - 1)


def boxed_answer(text: Column) -> Column:
    """As boxed_span, but a spaced form `\\boxed x$` wins when present."""
    spaced = F.element_at(F.split(text, r"\\boxed ", -1), -1)
    return F.when(F.contains(text, F.lit("\\boxed ")), F.split(spaced, r"\$", -1)[0]).otherwise(
        boxed_span(F.when(F.contains(text, F.lit("\\boxed{")), text)))


def _expand_fractions(text: Column) -> Column:
    """\\frac12 and \\frac1{2} to braces; untouched when a fraction lacks its second part."""
    short = F.rlike(text, F.lit(r"\\frac[^{](\\frac|$)"))
    full = F.regexp_replace(text, r"\\frac([^{])([^{])", r"\\frac{$1}{$2}")
    full = F.regexp_replace(full, r"\\frac([^{])\{", r"\\frac{$1}{")
    return F.when(short, text).otherwise(full)


def tidy_math(text: Column) -> Column:
    """Canonical form of a boxed answer, for comparing two answers as text."""
    t = _replace_all(text, BOXED_CLEANUPS)
    t = F.split(t, r"\\text\{ ", -1)[0]
    t = _replace_all(t, [("\\%", ""), (" .", " 0."), ("{.", "{0.")])
    t = F.regexp_replace(t, r"^\.", "0.")
    sides = F.split(t, "=", -1)
    t = F.when((F.size(sides) == 2) & (F.length(sides[0]) <= 2), F.get(sides, 1)).otherwise(t)
    t = F.regexp_replace(t, r"\\sqrt([^{])", r"\\sqrt{$1}")
    t = _expand_fractions(F.replace(t, F.lit(" "), F.lit("")))
    t = F.when(t == "0.5", F.lit("\\frac{1}{2}")).otherwise(t)
    ratio = r"^(-?(?:0|[1-9]\d*))/(-?(?:0|[1-9]\d*))$"
    return F.regexp_replace(t, ratio, r"\\frac{$1}{$2}")


def same_math(a: Column, b: Column) -> Column:
    """Equal after tidying; texts the clean-up cannot handle are compared as they are."""
    def odd(x: Column) -> Column:
        broken = F.rlike(x, F.lit(r"\\[dt]?frac(\\|$)|\\sqrt$|\\sqrt\\sqrt"))
        return broken | (F.size(F.split(x, r"\\text\{ ", -1)) > 2)

    return F.coalesce(F.when(odd(a) | odd(b), a == b).otherwise(tidy_math(a) == tidy_math(b)), F.lit(False))


def tidy_final(text: Column) -> Column:
    """Canonical form of a final answer line."""
    # The patterns below and their order.
    t = F.element_at(F.split(text, "=", -1), -1)
    t = _replace_all(t, [*SUBSTITUTIONS, *[(r, "") for r in REMOVED]])
    t = F.regexp_replace(t, r"(?d)(.*?)(\$)(.*?)(\$)(.*)", r"\$$3\$")
    for name in ("text", "textbf", "overline"):
        t = F.regexp_replace(t, r"(?d)\\" + name + r"\{(.*?)\}", "$1")
    t = F.regexp_replace(t, r"(?d)\\boxed\{(.*)\}", "$1")
    t = F.regexp_replace(t, r"(?d)frac([^{])(.)", r"frac{$1}{$2}")
    t = F.regexp_replace(t, r"sqrt([^{])", r"sqrt{$1}")
    t = F.replace(t, F.lit("$"), F.lit(""))
    plain = F.replace(t, F.lit(","), F.lit(""))
    return strip(F.when(F.rlike(plain, F.lit(r"^\d+$")), plain).otherwise(t))


def final_line(text: Column) -> Column:
    """Content of the last `Answer:` line."""
    found = F.regexp_extract_all(text, F.lit(r"(?i)Answer\s*:\s*([^\n]+)"), F.lit(1))
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit("[INVALID]"))


def choice_letter(text: Column) -> Column:
    letter = F.regexp_extract(text, r"(?i)Answer[ \t]*:[ \t]*\$?([A-D])\$?", 1)
    return F.when(letter != "", letter)


PUNCTUATION = r"[!-/:-@\[-`{-~]"  # the 32 ASCII punctuation characters


def tidy_qa(text: Column) -> Column:
    """Lower case, without punctuation and articles, single spaces."""
    t = F.regexp_replace(F.lower(text), PUNCTUATION, "")
    t = F.regexp_replace(t, r"(?U)\b(a|an|the)\b", " ")
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def tagged_answer(text: Column) -> Column:
    """Trimmed content of the last <answer> block, NULL without one."""
    found = F.regexp_extract_all(text, F.lit(r"(?s)<answer>(.*?)</answer>"), F.lit(1))
    return strip(F.try_element_at(found, F.lit(-1)))


def occurrences(text: Column, part: str) -> Column:
    return F.size(F.split(text, r"\Q" + part + r"\E", -1)) - 1
