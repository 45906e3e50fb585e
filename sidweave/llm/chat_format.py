"""Chat formatting: field paths choose a declarative mapping to canonical turns.

A layout is recognised by the hash of its nested field paths, of a table's schema or of each record of a
semi-structured (variant) column. Paths that no mapping knows are ignored, so extra columns change nothing.
A mapping is a set of SQL expressions that yield canonical turns (role, text). Turns become one text with
marked turns; control strings inside texts are escaped reversibly, so a text can neither open nor close a
turn, and the loss mask is a list of spans over the formatted text. All steps are SQL functions.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.common import once

#: Strings that chat templates use as controls.
CONTROLS = ("<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
            "<|endoftext|>", "<|startoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|eot_id|>", "<|begin_of_text|>",
            "<|start_header_id|>", "<|end_header_id|>", "<start_of_turn>", "<end_of_turn>")
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns. `paths`: the layout's fields; `turns`: SQL for an array of (role, text)
    in one row; or `by_turn`: the row is one turn, grouped by conversation and ordered by `order`."""

    name: str
    paths: tuple[str, ...]
    turns: str = ""
    by_turn: tuple[str, str] = ("", "")
    order: str = ""


def _pair(role: str, text: str) -> str:
    return f"named_struct('role', '{role}', 'text', coalesce(cast({text} AS string), ''))"


def _each(column: str, role: str, text: str, rename: bool = False) -> str:
    name = f"CASE m.{role} WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE m.{role} END" if rename else f"m.{role}"
    return f"transform({column}, m -> named_struct('role', coalesce({name}, ''), 'text', coalesce(m.{text}, '')))"


MAPPINGS = (
    Mapping("turn_rows", ("conv_id", "turn", "role", "text"), by_turn=("role", "text"), order="turn"),
    Mapping("messages", ("messages[].role", "messages[].content"), _each("messages", "role", "content")),
    Mapping("speakers", ("conversations[].from", "conversations[].value"), _each("conversations", "from", "value", rename=True)),
    Mapping("system_messages", ("system", "messages[].role", "messages[].content"),
            f"concat(array({_pair('system', 'system')}), {_each('messages', 'role', 'content')})"),
    Mapping("instruction", ("instruction", "output"), f"array({_pair('user', 'instruction')}, {_pair('assistant', 'output')})"),
    Mapping("instruction_input", ("instruction", "input", "output"),
            "array(" + _pair("user", "concat_ws('\\n', instruction, nullif(input, ''))") + f", {_pair('assistant', 'output')})"),
    Mapping("prompt_response", ("prompt", "response"), f"array({_pair('user', 'prompt')}, {_pair('assistant', 'response')})"),
    Mapping("prompt_completion", ("prompt", "completion"), f"array({_pair('user', 'prompt')}, {_pair('assistant', 'completion')})"),
    Mapping("question_answer", ("question", "answer"), f"array({_pair('user', 'question')}, {_pair('assistant', 'answer')})"),
    Mapping("prompt_turns_completion", ("prompt[].role", "prompt[].content", "completion"),
            f"concat({_each('prompt', 'role', 'content')}, array({_pair('assistant', 'completion')}))"),
)
KNOWN = frozenset(p for m in MAPPINGS for p in m.paths)


def fingerprint(paths) -> str:
    """Hash of the known paths of a layout, whatever their order."""
    return hashlib.sha256("\n".join(sorted(set(paths) & KNOWN)).encode()).hexdigest()


BY_FINGERPRINT = {fingerprint(m.paths): m for m in MAPPINGS}


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Leaf paths of a type; [] marks array elements."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, at + "[]")
    return [at]


def choose(schema: T.StructType) -> Mapping:
    """The mapping of a table's layout: by fingerprint, else the one with the most fields that are all there
    (a table may hold fields of two layouts; the first listed of equals)."""
    paths = set(field_paths(schema))
    if found := BY_FINGERPRINT.get(fingerprint(paths)):
        return found
    fitting = [m for m in MAPPINGS if paths.issuperset(m.paths)]
    if not fitting:
        raise ValueError(f"no mapping fits {schema.simpleString()}")
    return max(fitting, key=lambda m: len(m.paths))


def canonical(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """conv_id, turns of a table in any known layout. NULL turns arrays become empty; NULL texts and roles
    become empty strings; turns of equal order are sorted by role and text; NULL ids form one conversation
    in the layout of turn rows."""
    m = choose(df.schema)
    if not m.turns:
        role, text = (F.coalesce(F.col(c), F.lit("")) for c in m.by_turn)
        one = F.struct(F.col(m.order).alias("o"), role.alias("role"), text.alias("text"))
        grouped = df.groupBy(F.col(id_col).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
        return grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    return df.select(F.col(id_col).alias("conv_id"), F.coalesce(F.expr(m.turns).cast(TURNS), F.array().cast(TURNS)).alias("turns"))


def _elements(record: Column, top: str) -> Column:
    """An array field's elements as variants; NULL if the field is no array."""
    return F.try_variant_get(record, f"$.{top}", "array<variant>")


def _has(record: Column, path: str, valued: bool = False, empty: bool = False) -> Column:
    """Whether a variant record has a known path: a flat field, or a field of any element of an array.
    `valued`: with a value beside JSON's null; `empty`: an empty array has every field."""
    def there(v: Column, at: str) -> Column:
        field = F.try_variant_get(v, at, "variant")
        return field.isNotNull() & ~F.is_variant_null(field) if valued else field.isNotNull()

    if "[]." in path:
        top, leaf = path.split("[].")
        found = F.exists(_elements(record, top), lambda e: there(e, f"$.{leaf}"))
        return found | (F.size(_elements(record, top)) == 0) if empty else found
    return there(record, f"$.{path}") & _elements(record, path).isNull()


#: A record is a whole conversation, so the fields of turn rows say nothing about its layout.
RECORD_MAPPINGS = tuple(m for m in MAPPINGS if m.turns)
RECORD_KNOWN = tuple(sorted({p for m in RECORD_MAPPINGS for p in m.paths}))


def record_paths(record: Column, valued: bool = False, empty: bool = False) -> Column:
    """Known field paths of a variant record, whichever elements of its arrays they are in."""
    return F.array_compact(F.array(*[F.when(_has(record, p, valued, empty), F.lit(p)) for p in RECORD_KNOWN]))


def canonical_records(df: DataFrame, record_col: str, id_col: str = "conv_id") -> DataFrame:
    """conv_id, layout, turns of JSON text records, each by the fingerprint of its own fields, else by the mapping
    with the most fields that are all there (the first listed of equals): first of those whose fields all have
    a value, then of all, then with an empty array standing for its elements' fields.

    Records that are not JSON or have no known layout give layout NULL and no turns.
    """
    rows = df.select(F.col(id_col).alias("conv_id"), F.try_parse_json(F.col(record_col)).alias("r"))
    r = F.col("r")
    rows = once(rows, has=F.struct(record_paths(r).alias("any"), record_paths(r, valued=True).alias("valued"), record_paths(r, empty=True).alias("empty")))
    rows = rows.withColumn("fp", F.sha2(F.array_join("has.any", "\n"), 256))
    layout = F.lit(None).cast("string")
    for kind in ("empty", "any", "valued"):  # what is tried first is put on last
        for m in sorted(reversed(RECORD_MAPPINGS), key=lambda m: len(m.paths)):
            fits = F.size(F.array_except(F.array(*map(F.lit, m.paths)), f"has.{kind}")) == 0
            layout = F.when(fits, F.lit(m.name)).otherwise(layout)
    for fp, m in BY_FINGERPRINT.items():
        if m.turns:
            layout = F.when(F.col("fp") == fp, F.lit(m.name)).otherwise(layout)
    rows = once(rows, layout=layout)
    turns = F.array().cast(TURNS)
    for m in RECORD_MAPPINGS:
        fields = sorted({p.split("[]")[0] for p in m.paths})
        lists = {p.split("[].")[0]: [q.split("[].")[1] for q in m.paths if q.startswith(p.split("[].")[0] + "[].")] for p in m.paths if "[]." in p}
        row = "named_struct(" + ", ".join(f"'{f}', {_typed(f, lists.get(f))}" for f in fields) + ")"
        sql = f"transform(array({row}), x -> {_qualified(m.turns, fields)})[0]"
        turns = F.when(F.col("layout") == m.name, F.expr(sql).cast(TURNS)).otherwise(turns)
    return rows.select("conv_id", "layout", F.coalesce(turns, F.array().cast(TURNS)).alias("turns"))


def _typed(field: str, leaves: list[str] | None) -> str:
    """SQL for a field of the variant r: a string, or an array of structs read element by element, so that one odd element costs no other."""
    if not leaves:
        return f"try_variant_get(r, '$.{field}', 'string')"
    one = ", ".join(f"'{n}', try_variant_get(e, '$.{n}', 'string')" for n in leaves)
    return f"transform(try_variant_get(r, '$.{field}', 'array<variant>'), e -> named_struct({one}))"


def _qualified(sql: str, fields: list[str]) -> str:
    """The mapping's expression with its fields read from x."""
    return re.sub(r"'[^']*'|(?<![\w.])(" + "|".join(fields) + r")(?!\w)", lambda m: f"x.{m[1]}" if m[1] else m[0], sql)


def _control_pattern() -> str:
    """Each control string as its first character and the rest, so that a mark can go between them."""
    def quoted(s: str) -> str:
        return "".join("\\" + c if c in "[]|<>/\\" else c for c in s)

    by_first: dict[str, list[str]] = {}
    for c in CONTROLS:
        by_first.setdefault(c[0], []).append(quoted(c[1:]))
    return "|".join(f"(?<={quoted(a)})(?=(?:{'|'.join(rest)}))" for a, rest in by_first.items())


def escape(text: Column) -> Column:
    """Backslashes doubled, and one backslash behind the first character of every control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _control_pattern(), "\\\\")


def unescape(text: Column) -> Column:
    """A pair of backslashes is one; a single one goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_turns(canon: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_spans (start, length in code points of the escaped texts to learn).

    A turn is OPEN, the escaped role, a line feed, the escaped text, CLOSE, a line feed. A line feed in a
    role is written as a backslash and n, which no escaped string holds otherwise.
    """
    def shown(t: Column) -> Column:
        head = F.concat(F.lit(OPEN), F.replace(escape(t["role"]), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
        body = escape(t["text"])
        return F.struct(F.concat(head, body, F.lit(CLOSE + "\n")).alias("s"), F.length(head).alias("head"), F.length(body).alias("body"),
                        (t["role"] == loss_role).alias("learn"))

    rows = once(canon, shown=F.transform("turns", shown))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        span = F.struct((acc["at"] + t["head"]).alias("start"), t["body"].alias("length"))
        spans = F.when(t["learn"], F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((acc["at"] + F.length(t["s"])).alias("at"), spans.alias("spans"))

    return rows.select("conv_id", F.array_join(F.transform("shown", lambda t: t["s"]), "").alias("formatted"),
                       F.aggregate("shown", start, step)["spans"].alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns, loss_text from formatted rows alone: marks split the text, spans cut it."""
    parts = F.filter(F.split("formatted", "\\Q" + CLOSE + "\n\\E"), lambda p: p != "")

    def turn(p: Column) -> Column:
        body = F.substring(p, len(OPEN) + 1, F.length(p))
        cut = F.locate("\n", body)
        role = F.regexp_replace(F.left(body, cut - 1), r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
        return F.struct(unescape(role).alias("role"), unescape(F.substring(body, cut + 1, F.length(body))).alias("text"))

    learnt = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return once(formatted, turns=F.transform(parts, turn), loss_text=F.array_join(learnt, ""))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from the formatted rows."""
    r = read_back(formatted)
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return r.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                    F.length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                    F.length("formatted").cast("bigint").alias("formatted_chars"))
