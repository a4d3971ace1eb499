"""Prompts and response parsing, malformed cases included."""

import json

import pytest

from inkfold.operators import responses as G

GOOD = {
    "category": "c", "related_stocks": ["A", "B"], "core_points": ["p"],
    "value_investment": {"alignment": "是", "margin_of_safety": "高", "analysis": "x"},
    "insights": ["i"], "summary": "s",
}
TEXT = json.dumps(GOOD, ensure_ascii=False)


def parse(spark, function, *responses):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(responses)], "i int, response string")
    return [r for r in function(df).orderBy("i").collect()]


@pytest.mark.parametrize(
    "response",
    [
        TEXT,
        f"text {TEXT} more",
        f"```json\n{TEXT}\n```",
        f"{{not this}} ```json {TEXT} ``` nor {{that}}",
        json.dumps(GOOD, indent=2),
    ],
)
def test_readable(spark, response):
    (row,) = parse(spark, G.parse_response_v1, response)
    assert row.readable
    assert row.analysis.asDict(recursive=True) == GOOD


@pytest.mark.parametrize(
    "response,summary",
    [
        (None, "解析失败"),
        ("", "解析失败"),
        ("no braces at all", "no braces at all"),
        ("x" * 60, "x" * 50),
        ('{"category": "cut', '{"category": "cut'),
        ('{"category": "a"} and {"summary": "b"}', '{"category": "a"} and {"summary": "b"}'),
        # A broken fence is final: the readable text around it is not tried.
        ('```json {"a": } ``` ', '```json {"a": } ``` '),
        ("{} , {}", "{} , {}"),
    ],
)
def test_unreadable(spark, response, summary):
    (row,) = parse(spark, G.parse_response_v1, response)
    assert not row.readable
    a = row.analysis
    assert (a.category, a.related_stocks, a.core_points) == ("其他", [], ["解析失败，请查看原文"])
    assert (a.value_investment.alignment, a.insights, a.summary) == ("不确定", ["解析失败"], summary)


def test_partial_object_keeps_missing_fields_null(spark):
    (row,) = parse(spark, G.parse_response_v1, '{"category": "c"}')
    assert row.readable and row.analysis.category == "c" and row.analysis.related_stocks is None


def test_second_form(spark):
    good = '{"importance": "high", "key_data": {"a": "1", "b": ""}, "action_required": "看"}'
    a, b, c = parse(spark, G.parse_response_v2, f"so: {good}.", f"```json {good} ``` {{x}}", "q" * 51)
    assert a.readable and a.analysis.importance == "high" and a.analysis.key_data == {"a": "1", "b": ""}
    assert not b.readable and b.analysis.importance == "medium"
    assert c.analysis.core_thesis == "q" * 50 and c.analysis.action_required == "需要关注"


def test_prompts_cut_the_text_but_count_it_whole(spark):
    rows = spark.createDataFrame(
        [("t", None, "c" * 4001)], "title string, author string, content string"
    )
    template = "{title}|{author}|{word_count}|{content}|{x}"
    first = G.prompt_build_v1(rows, template).first().prompt
    assert first == "t|未知|4001|" + "c" * 4000 + "|{x}"
    second = G.prompt_build_v2(rows, "{title}|{content}").first().prompt
    assert second == "t|" + "c" * 3000
    assert "{" not in G.prompt_build_v1(rows).first().prompt.replace("c", "")


ARTICLES = "article_id string, title string, content string"


def test_results_with_and_without_responses(spark):
    articles = spark.createDataFrame(
        [(i, "title", "c" * (3001 if i != "bad" else 5)) for i in ("ok", "none", "err", "bad", "null")], ARTICLES
    )
    responses = spark.createDataFrame(
        [("ok", TEXT, None), ("err", None, "timeout"), ("bad", TEXT, None), ("null", None, None)],
        "article_id string, response string, error string",
    )
    rows = {r.article_id: r for r in G.attach_responses_v1(articles, responses).collect()}
    assert len(rows) == 5
    assert (rows["ok"].issues, rows["ok"].priority, rows["ok"].analysis.category) == ([], "must_read", "c")
    assert (rows["none"].issues, rows["none"].priority, rows["none"].analysis) == (["分析失败: "], "reference", None)
    assert rows["err"].issues == ["分析失败: timeout"] and rows["err"].quality_passed
    assert (rows["bad"].quality_passed, rows["bad"].priority, rows["bad"].analysis) == (False, "reference", None)
    assert rows["null"].analysis.summary == "解析失败" and rows["null"].priority == "must_read"


def test_second_form_falls_back_to_rules(spark):
    articles = spark.createDataFrame([("a", "t", "$AB"), ("b", "t", "$CD"), ("c", "t", "$EF")], ARTICLES)
    responses = spark.createDataFrame(
        [("a", '{"importance": "low"}', None), ("b", None, None)],
        "article_id string, response string, error string",
    )
    rows = {r.article_id: r.analysis for r in G.attach_responses_v2(articles, responses).collect()}
    assert rows["a"].importance == "low" and rows["a"].related_stocks is None
    assert rows["b"].related_stocks == ["CD"] and rows["c"].related_stocks == ["EF"]


def test_other_than_json_is_not_readable_and_a_mistyped_field_costs_itself_only(spark):
    from inkfold.operators.responses import parse_response_v1

    rows = ["{'category': 'x'}", "{category: \"x\"}", '{"category": "c", "related_stocks": "A", "summary": "s"}']
    found = parse_response_v1(spark.createDataFrame([(r,) for r in rows], "response string")).collect()
    assert [r.readable for r in found] == [False, False, True]
    assert (found[2].analysis.category, found[2].analysis.summary, found[2].analysis.related_stocks) == ("c", "s", None)
