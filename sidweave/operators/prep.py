"""Raw public-dataset tables to RL, preference and chat rows.

Every builder maps columns of any table with the raw fields; downloading is left to the caller.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.answers import boxed_answer
from ..functions.common import fill, key_text, non_empty, pick_index, strip
from ..session import cut
from .numbering import hash_rank, row_numbers
from .sampling import split_ratio

NUMBER_HINT = "Reason step by step and close with `#### answer`."
BOX_HINT = "Reason step by step and put the answer in \\boxed{}."
SYSTEM = "Work with the user towards the goal."
SEARCH_SYSTEM = "Search when knowledge is missing."
CHOICE_PROMPT = "{question}\n\nA) {A}\nB) {B}\nC) {C}\nD) {D}\n\nEnd with 'Answer: LETTER'."


def turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def rl_row(rows: DataFrame, source: Column, prompt: Column, ability: str, truth: Column, split: str, index: str,
           style: str = "rule", **extra: Column) -> DataFrame:
    """data_source, prompt, ability, reward_model, extra_info."""
    info = F.struct(F.lit(split).alias("split"), F.col(index).alias("index"), *[c.alias(k) for k, c in extra.items()])
    return rows.select(
        source.alias("data_source"), prompt.alias("prompt"), F.lit(ability).alias("ability"),
        F.struct(F.lit(style).alias("style"), truth.alias("ground_truth")).alias("reward_model"), info.alias("extra_info"))


def _required(value: Column, message: str) -> Column:
    return F.coalesce(value, F.raise_error(F.lit(message)).cast("string"))


def grade_school(rows: DataFrame, split: str, index: str) -> DataFrame:
    """Question with a hint; truth = number behind `####`; a missing number is an error."""
    found = F.regexp_extract(F.col("answer"), r"#### (\-?[0-9\.\,]+)", 1)
    truth = F.replace(_required(F.when(found != "", found), "answer without a final number"), F.lit(","), F.lit(""))
    prompt = F.array(turn("user", F.concat_ws(" ", F.col("question"), F.lit(NUMBER_HINT))))
    return rl_row(rows, F.lit("grade_school"), prompt, "math", truth, split, index,
                  answer=F.col("answer"), question=F.col("question"))


def grade_school_chat(rows: DataFrame) -> DataFrame:
    """Two-turn chat variant."""
    return rows.select("*", F.array(turn("user", F.concat_ws(" ", F.col("question"), F.lit(NUMBER_HINT))),
                                    turn("assistant", F.col("answer"))).alias("messages"))


def competition_math(rows: DataFrame, split: str, index: str) -> DataFrame:
    truth = _required(boxed_answer(F.col("solution")), "solution without a boxed answer")
    prompt = F.array(turn("user", F.concat_ws(" ", F.col("problem"), F.lit(BOX_HINT))))
    return rl_row(rows, F.lit("competition_math"), prompt, "math", truth, split, index)


def tidy_sentence(text: Column) -> Column:
    t = F.replace(strip(text), F.lit(" [title]"), F.lit(". "))
    return F.replace(F.regexp_replace(t, r"(?d)\[.*?\]", ""), F.lit("  "), F.lit(" "))


def capitalised(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, F.lit(2), F.length(text))))


def sentence_completion(rows: DataFrame, split: str, index: str) -> DataFrame:
    """Context plus choices; unlabelled rows are dropped."""
    s = rows.where(non_empty(F.col("label")))
    query = tidy_sentence(F.concat(F.col("activity_label"), F.lit(": "), F.col("ctx_a"), F.lit(" "), capitalised(F.col("ctx_b"))))
    return rl_row(s, F.lit("sentence_completion"), F.array(turn("user", query)), "nlp", F.col("label"), split, index, "model",
                  choices=F.transform("endings", tidy_sentence))


def preference_long(rows: DataFrame) -> DataFrame:
    """Both answers as responses."""
    return rows.select("*", F.posexplode(F.array("chosen", "rejected")).alias("side", "response")).drop("chosen", "rejected")


def preference_pairs(rows: DataFrame, order: list[str]) -> DataFrame:
    """prompt, chosen, rejected with the first 75 % as train and the last 25 % as test."""
    numbered = row_numbers(rows, [F.col(c) for c in order], "_rn")
    total = rows.agg(F.count(F.lit(1)).alias("_n"))
    s = numbered.crossJoin(F.broadcast(total))  # one row
    return s.withColumn("part", F.when(F.col("_rn") <= F.round(F.col("_n") * 0.75), "train").otherwise("test")).drop("_rn", "_n")


def preference_prompts(rows: DataFrame, split: str, index: str) -> DataFrame:
    return rl_row(rows, F.lit("preference"), F.array(turn("user", F.col("prompt"))), "alignment", F.col("response"), split, index, "model")


def search_questions(rows: DataFrame, split: str, index: str) -> DataFrame:
    """System and user turn; truth from reward_model, else golden_answers; tool arguments nested in extra_info."""
    truth = F.coalesce(F.col("reward_model.ground_truth"), F.col("golden_answers"))
    tagged = F.concat(F.lit("search_"), F.coalesce(F.col("data_source"), F.lit("")))
    question = F.coalesce(F.col("question"), F.lit(""))
    args = F.struct(truth.alias("ground_truth"), question.alias("question"), tagged.alias("data_source"))
    prompt = F.array(turn("system", F.lit(SEARCH_SYSTEM)), turn("user", question))
    return rl_row(rows, tagged, prompt, "qa", truth, split, index, question=question, need_tools_kwargs=F.lit(True),
                  tools_kwargs=F.struct(F.struct(args.alias("create_kwargs")).alias("search")))


def with_tool(rows: DataFrame, tool: str) -> DataFrame:
    """Tool arguments with the truth, nested in extra_info."""
    args = F.struct(F.struct(F.col("reward_model.ground_truth").alias("ground_truth")).alias("create_kwargs"))
    return rows.withColumn("extra_info", F.col("extra_info").withField("need_tools_kwargs", F.lit(True)).withField(
        "tools_kwargs", F.struct(args.alias(tool))))


def with_interaction(rows: DataFrame, name: str) -> DataFrame:
    """Interaction arguments with question and truth, nested in extra_info."""
    args = F.struct(F.lit(name).alias("name"), F.col("extra_info.question").alias("query"),
                    F.col("reward_model.ground_truth").alias("ground_truth"))
    return rows.withColumn("extra_info", F.col("extra_info").withField("interaction_kwargs", args))


def multiple_choice(rows: DataFrame, index: str, seed: int = 42) -> DataFrame:
    """Wrong answers in seeded hash order, the right one at a hashed place; adds `query` and `gold`."""
    key = F.col(index)
    wrong = F.transform(F.array_sort(F.transform("incorrect", lambda c, i: F.struct(
        F.md5(key_text(seed, key, i)).alias("h"), c.alias("c")))), lambda x: x["c"])
    at = pick_index(4, seed, key, "gold")
    choices = F.array_insert(wrong, at + 1, F.col("correct"))
    query = fill([CHOICE_PROMPT], {"question": F.col("question"), **{c: F.get(choices, i) for i, c in enumerate("ABCD")}}, key)
    return rows.select("*", query.alias("query"), F.substring(F.lit("ABCD"), at + 1, F.lit(1)).alias("gold"))


CASES = "array<struct<input:string,output:string>>"


def contest_code(rows: DataFrame, since: str, until: str) -> DataFrame:
    """Problems of an ISO date range (text comparison); public and private cases merged into one JSON text."""
    s = rows.where((F.col("contest_date") >= since) & (F.col("contest_date") < until))
    cases = F.concat(F.from_json("public_test_cases", CASES), F.from_json("private_test_cases", CASES))
    packed = F.to_json(F.struct(F.transform(cases, lambda c: c["input"]).alias("inputs"),
                                F.transform(cases, lambda c: c["output"]).alias("outputs"),
                                F.get_json_object("metadata", "$.func_name").alias("fn_name")), {"ignoreNullFields": "false"})
    starter = F.when(non_empty(F.col("starter_code")), F.concat(F.lit("Start from:\n"), F.col("starter_code"))).otherwise(
        F.lit("Read stdin, write stdout."))
    return s.withColumn("query", F.concat(F.col("question_content"), F.lit("\n\n"), starter)).withColumn("cases", packed)


def question_rows(rows: DataFrame, source: str, ability: str, split: str, index: str, query: Column, truth: Column) -> DataFrame:
    return rl_row(rows, F.lit(source), F.array(turn("user", query)), ability, truth, split, index)


def task_union(builders: dict[str, Callable[[], DataFrame]], tasks: list[str] | None = None) -> DataFrame:
    """Union of the selected tasks; an unknown task is an error."""
    chosen = list(builders) if tasks is None else tasks
    unknown = set(chosen) - set(builders)
    if unknown:
        raise ValueError(f"unknown tasks: {sorted(unknown)}")
    return reduce(DataFrame.unionByName, [builders[t]() for t in chosen])


def solved_math(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Chat rows with a loss mask per message; only problems with an extracted answer."""
    s = rows.where(F.col("problem_type") == "has_answer_extracted")

    def msg(role, col, mask):
        return F.struct(F.lit(role).alias("role"), F.col(col).alias("content"), F.lit(mask).alias("loss_mask"))

    return s.select(F.array(msg("user", "problem", 0), msg("assistant", "generated_solution", 1)).alias("messages"),
                    F.struct(*keep).alias("extra_info"))


def solved_math_evaluation(rows: DataFrame, source: str, index: str) -> DataFrame:
    """Truth = content of an answer that is nothing but a box (braced, or a blank and the content), else the
    answer as it is. Without a `solution` column, or where it is NULL, the answer is the `answer` column."""
    given = [F.col(c) for c in ("solution", "answer") if c in rows.columns]
    raw = F.coalesce(*given)
    braced = F.when(F.startswith(raw, F.lit("\\boxed{")) & F.endswith(raw, F.lit("}")), F.substring(raw, F.lit(8), F.length(raw) - 8))
    spaced = F.when(F.startswith(raw, F.lit("\\boxed ")), F.substring(raw, F.lit(8), F.length(raw)))
    truth = F.coalesce(spaced, braced, raw)
    prompt = F.array(turn("user", F.concat_ws(" ", F.col("problem"), F.lit(BOX_HINT))))
    return rl_row(rows, F.lit(source), prompt, "math", truth, "test", index, answer=raw, question=F.col("problem"))


def collapse_rl(rows: DataFrame, row_id: str, extra: list[str]) -> DataFrame:
    """Truth from the first non-empty of three columns, a system turn in front, first row per prompt.

    The first row per prompt comes from a partially aggregated min_by, not from a window.
    """
    def filled(c):
        return F.when(F.col(c) != "", F.col(c))

    truth = F.coalesce(*[filled(c) for c in ("ground_truth", "single_turn_completion", "completion") if c in rows.columns], F.lit(""))
    prompt = F.concat(F.array(turn("system", F.lit(SYSTEM))), F.col("prompt"))
    s = rows.select(row_id, prompt.alias("prompt"), truth.alias("ground_truth"), F.struct(*extra).alias("extra_info"))
    first = F.min_by(F.struct("prompt", "ground_truth", "extra_info"), F.col(row_id)).alias("x")
    return s.groupBy(F.md5(F.to_json("prompt")).alias("prompt_key")).agg(F.min(row_id).alias(row_id), first).select(
        row_id, "x.*")


def collapse_chat(rows: DataFrame) -> DataFrame:
    """Latest turn, then best score, one row per conversation; the completion becomes the last turn."""
    best = F.max_by(F.struct("prompt", "completion"), F.struct("turn_id", "score")).alias("x")
    one = rows.groupBy("conv_id").agg(best).select("conv_id", "x.*")
    whole = F.concat(F.array(turn("system", F.lit(SYSTEM))), F.col("prompt"), F.array(turn("assistant", F.col("completion"))))
    return one.select("conv_id", whole.alias("prompt"))


def tool_trace(question: Column, trace: Column) -> Column:
    """One text of code, interpreter and answer spans to alternating messages (role, content, code).

    A text that neither ends with an answer nor with an interpreter output is an error.
    """
    step = r"(?s)^(.*?)<code>(.*?)</code>.*?<interpreter>(.*)$"
    fenced = r"(?s)```python(.*?)```"

    def msg(role, content, code=None):
        c = F.lit(None).cast("string") if code is None else code
        return F.struct(F.lit(role).alias("role"), content.alias("content"), c.alias("code"))

    def pair(s: Column) -> Column:
        raw = F.regexp_extract(s, step, 2)
        code = F.when(F.rlike(raw, F.lit(fenced)), strip(F.regexp_extract(raw, fenced, 1))).otherwise(raw)
        both = F.array(msg("assistant", strip(F.regexp_extract(s, step, 1)), code),
                       msg("tool", strip(F.regexp_extract(s, step, 3))))
        return F.when(F.rlike(s, F.lit(step)), both).otherwise(
            F.raise_error(F.lit("interpreter output without code")).cast("array<struct<role:string,content:string,code:string>>"))

    # Cut at the closing marks first: every piece is then matched once from its start.
    pieces = F.split(trace, "</interpreter>", -1)
    steps = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    tail = F.element_at(pieces, -1)
    closing = r"(?s)^(.*?)<answer>(.*?)</answer>$"
    answer = strip(F.concat(F.regexp_extract(tail, closing, 1), F.regexp_extract(tail, closing, 2)))
    end = F.when(tail == "", F.array().cast("array<struct<role:string,content:string,code:string>>")).when(
        F.rlike(tail, F.lit(closing)), F.array(msg("assistant", answer))).otherwise(
        F.raise_error(F.lit("trace without a closing answer")).cast("array<struct<role:string,content:string,code:string>>"))
    marker = "*user question:*"
    asked = F.when(F.contains(question, F.lit(marker)), F.substring(
        question, F.instr(question, marker) + len(marker), F.length(question))).otherwise(
        F.raise_error(F.lit("no question")).cast("string"))
    prompt = strip(F.replace(F.replace(asked, F.lit("<answer>"), F.lit("")), F.lit("</answer>"), F.lit("")))
    return F.concat(F.array(msg("user", prompt)), F.flatten(F.transform(steps, pair)), end)


def multi_turn_tools(rows: DataFrame, source: str, ids: list[str], ratio: float, seed: int) -> DataFrame:
    """Seeded ratio split with flags; `index` numbers the rows of each part in shuffled order."""
    parts = cut(split_ratio(rows, ratio, seed, ids))
    s = hash_rank(parts, seed, ids, "_at", within=["part"])
    info = F.struct(F.when(F.col("part") == "train", "train").otherwise("test").alias("split"), (F.col("_at") - 1).alias("index"))
    return s.select(F.lit(source).alias("data_source"), *[c for c in rows.columns], F.lit(False).alias("enable_thinking"),
                    info.alias("extra_info"))
