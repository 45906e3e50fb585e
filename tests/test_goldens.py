"""Small hand-written cases of text parsing, metrics and answers."""

import pytest
from pyspark.sql import functions as F

from sidweave.functions import answers as A
from sidweave.functions import sid as S
from sidweave.operators import labelmetrics as LM
from sidweave.operators import recmetrics as R
from sidweave.operators import rewards as W
from sidweave.operators import tokens as K
from sidweave.operators import judge as J

B, E = S.SID_BEGIN, S.SID_END


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("x")).first().x


def test_truth_ids(spark):
    text = f"{B}123{E}{B} 456 {E}{B}123{E}{B}{E}{B}open"
    assert one(spark, text, S.answer_sids) == ["123", "456"]
    assert one(spark, f"lead{E}{B}9{E}", S.answer_sids) == ["lead", "9"]


@pytest.mark.parametrize("text,want", [
    (f"{B}123{E}", "123"), ("123", "123"), (f"<think>r</think>\n{B}123", "123"), (f"prose {B}123{E}", "prose"),
    (f"a</think>b</think> {B}{E}{B}7{E}", "7"), (f"{B}{E}", f"{B}{E}"), ("  x ", "x"), ("", "")])
def test_generation_id(spark, text, want):
    assert one(spark, text, S.generation_sid) == want


GENS = [f"{B}123{E}", "456", "<think>...</think>\n123", "789", "456", "999"]
LPS = [-0.5, -1.2, -0.8, -0.3, -1.5, -2.0]


@pytest.mark.parametrize("kw,ids", [
    ({}, ["123", "456", "789"]), ({"logprobs": LPS}, ["789", "123", "456"]), ({"exclude": ["456", "789"]}, ["123", "999"])])
def test_unique_ids(spark, kw, ids):
    df = spark.createDataFrame([(GENS, LPS, ["456", "789"], ["a", "b", "a", "c", "b", "d"])],
                               "g array<string>, logprobs array<double>, exclude array<string>, s array<string>")
    args = {k: F.col(k) for k in kw}
    row = df.select(R.unique_ids(F.col("g"), 3, sources=F.col("s"), **args).alias("u")).first().u
    assert [x.id for x in row] == ids
    if not kw:
        assert [x.source for x in row] == ["a", "b", "c"]


def test_recall(spark):
    df = spark.createDataFrame([(["123", "456", "999", "888"], ["123", "456", "789"])], "p array<string>, t array<string>")
    m = R.hits(F.col("p"), F.col("t"), [2, 4])
    row = df.select(*[c.alias(n) for n, c in m.items()]).first().asDict()
    assert round(row["recall@2"], 4) == round(row["recall@4"], 4) == 0.6667
    assert row["pass@2"] and row["position1_pass@2"]


def test_missing_logprobs_fail(spark):
    df = spark.createDataFrame([(["a"], None)], "generations array<string>, logprobs array<double>")
    with pytest.raises(Exception, match="logprobs"):
        df.select(R.select_candidates(F.col("generations"), F.col("logprobs"), "top_k_by_logprobs")).collect()


@pytest.mark.parametrize("text,want", [
    ('</think>{"是": 0.7, "否": 0.3}', 0.7), ('{"是": 2, "否": 2}', 0.5), ('{"是": 0, "否": 0}', None), ('{"是": 1}', None), ("[1]", None)])
def test_probability(spark, text, want):
    assert one(spark, text, LM.positive_probability) == pytest.approx(want) if want else one(spark, text, LM.positive_probability) is None


@pytest.mark.parametrize("text,want", [("是<end>", 1), ("否", 0), ("不是", 1), ("?", -1)])
def test_label(spark, text, want):
    assert one(spark, text, LM.label_from_answer) == want


@pytest.mark.parametrize("text,want", [
    ("x \\boxed{a{b}c} y", "a{b}c"), ("\\boxed{1} \\boxed{2", None), ("\\boxed 5$ z", "5"), ("none", None),
    ("\\boxed{\\frac{1}{2}} and \\boxed{7}", "7")])
def test_boxed(spark, text, want):
    assert one(spark, text, A.boxed_answer) == want


@pytest.mark.parametrize("a,b,same", [
    ("\\dfrac{1}{2}", "\\frac12", True), ("0.5", "\\frac{1}{2}", True), ("3/4", "\\frac{3}{4}", True), ("x=5", "5", True),
    ("5\\text{ cm}", "5", True), ("\\sqrt3", "\\sqrt{3}", True), (".5", "0.5", True), ("50\\%", "50", True),
    ("1,000", "1000", False), ("\\frac1", "\\frac{1}{}", False), ("\\left(1\\right)", "(1)", True), ("9^\\circ", "9", True)])
def test_same_math(spark, a, b, same):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(A.same_math(F.col("a"), F.col("b")).alias("x")).first().x is same


@pytest.mark.parametrize("text,want", [
    ("the total is 1,234 dollars", "thetotalis1,234"), ("x = 12,000", "12000"), ("$\\frac12$ km", "\\frac{1}{2}"),
    ("\\text{yes}", "yes"), ("\\boxed{7}", "7")])
def test_final_answer(spark, text, want):
    assert one(spark, text, A.tidy_final) == want


@pytest.mark.parametrize("text,strict,flexible", [
    ("a #### 1,234", "1234", "1,234"), ("#### 5 #### -6", "-6", "-6"), ("is 42.", None, "42."), ("...", None, "..."), ("none", None, None)])
def test_final_number(spark, text, strict, flexible):
    assert one(spark, text, A.final_number) == strict
    assert one(spark, text, lambda t: A.final_number(t, True)) == flexible


@pytest.mark.parametrize("text,want", [("The cat, a DOG!", "cat dog"), ("an  é a", "é"), ("theory", "theory")])
def test_tidy_qa(spark, text, want):
    assert one(spark, text, A.tidy_qa) == want


def sid(*c):
    return S.SID_FORMAT % c


@pytest.mark.parametrize("pred,truth,want", [
    (sid(1, 2, 3) + sid(1, 2, 9) + sid(1, 7, 7) + sid(8, 8, 8), sid(1, 2, 3), (100 + 10 + 1) / 4), ("", sid(1, 2, 3), 0.0)])
def test_partial_hit(spark, pred, truth, want):
    df = spark.createDataFrame([(pred, truth)], "p string, t string")
    assert df.select(W.partial_hit(F.col("p"), F.col("t")).alias("x")).first().x == want


@pytest.mark.parametrize("text,want", [
    ("<think>0123456789a</think>", 1.0), ("<think>0123456789</think>", 0.0), ("</think><think>long enough text</think>", 0.0),
    ("<think>0 1 2 3 4 5 6 7 8 9\n</think>", 0.0), ("none", 0.0)])
def test_think_format(spark, text, want):
    assert one(spark, text, W.think_format) == want


def test_unknown_source_fails(spark):
    df = spark.createDataFrame([("x",)], "s string")
    with pytest.raises(Exception, match="no reward for x"):
        df.select(W.dispatch(F.col("s"), {("y",): F.lit(1.0)})).collect()


def test_think_tags(spark):
    rows = spark.createDataFrame([([("user", "q"), ("assistant", "a"), ("user", "r"), ("assistant", "<think>x</think>b"),
                                    ("user", "s"), ("assistant", "<think> </think>c"), ("system", "z"), ("assistant", "d")],)],
                                 "m array<struct<role:string,content:string>>")
    got = [x.content for x in rows.select(K.tag_thinking(F.col("m")).alias("x")).first().x]
    assert got == ["q/no_think", "<think>\n</think>\na", "r/think", "<think>x</think>b", "s/no_think", "<think> </think>c", "z", "d"]


@pytest.mark.parametrize("ids,want", [
    ([9, 1, 2, 5, 6, 3, 7, 1, 2, 8], [0, 0, 0, 1, 1, 0, 0, 0, 0, 1]), ([1, 2, 1, 2, 4, 3], [0, 0, 1, 1, 1, 0]), ([3, 4], [0, 0]), ([1, 2, 3, 3], [0, 0, 0, 0])])
def test_span_mask(spark, ids, want):
    df = spark.createDataFrame([(ids,)], "i array<int>")
    start, end = F.array(F.lit(1), F.lit(2)), F.array(F.lit(3))
    assert df.select(K.span_mask(F.col("i"), start, end).alias("x")).first().x == want


def test_match_f1(spark):
    point = "struct<info_point:string,importance_score:int>"
    df = spark.createDataFrame(
        [("s", ([(("a", 5), ("a", 3), 0.5)], [("b", 2)], [("c", None)]))],
        f"sample_id string, match struct<matches:array<struct<gt_wip:{point},model_wip:{point},match_quality:double>>,"
        f"unmatched_model_wips:array<{point}>,unmatched_gt_wips:array<{point}>>")
    r = J.score_matches(df).first()
    assert r.wip_unweighted_f1 == pytest.approx(2 / 4) and r.wip_unweighted_core_f1 == pytest.approx(1.0)
    assert r.wip_importance_weighted_f1 == pytest.approx(10 / 13)
    tp, fp, fn = 2.5, 1.5 + 2, 2.5 + 1
    assert r.wip_double_weighted_f1 == pytest.approx(2 * tp / (2 * tp + fp + fn))
    assert r.wip_double_weighted_core_f1 == pytest.approx(5 / (5 + 2.5))


@pytest.mark.parametrize("reply,score", [
    ('{"llm_score": 4}', 4.0), ('```json\n{"llm_score": 9}\n```', 3.0), ('so {"llm_score": 2} ok', 2.0), ('{"x": 1}', None), ("bad", None)])
def test_judge_score(spark, reply, score):
    assert one(spark, reply, J.judge_score) == score


def test_refined_reasoning(spark):
    assert one(spark, "a精炼推理b精炼推理**：\n core ", J.refined_reasoning) == "core"
    assert one(spark, " a精炼推理 ", J.refined_reasoning) == "a精炼推理"


def test_pack_and_unpack(spark):
    got = spark.range(1).select(S.unpack(S.pack(F.lit(8191), F.lit(0), F.lit(77))).alias("x")).first().x
    assert got == [8191, 0, 77]


def test_choice_and_box_forms(spark):
    from sidweave.operators import prep

    rows = spark.createDataFrame([(1, "Which of \\vec{A} and \\vec{B}?", "r {C}", ["w1", "w2 {question}", "w3"])], "id bigint, question string, correct string, incorrect array<string>")
    said = prep.multiple_choice(rows, "id").first().query
    assert said.startswith("Which of \\vec{A} and \\vec{B}?") and "r {C}" in said and "w2 {question}" in said
    maths = spark.createDataFrame([(1, "p", None, "\\boxed 3"), (2, "p", "\\boxed{4}", "x"), (3, "p", "plain", "x")], "id bigint, problem string, solution string, answer string")
    truths = [r.reward_model.ground_truth for r in prep.solved_math_evaluation(maths, "s", "id").collect()]
    assert truths == ["3", "4", "plain"]
    only = maths.drop("solution")
    assert prep.solved_math_evaluation(only, "s", "id").first().reward_model.ground_truth == "3"
