"""Boundaries of the gates and classification rules."""

import random

import pytest
from pyspark.sql import functions as F

from inkfold.functions.text import WHITESPACE, contains_any, fill, first_int, strip
from inkfold.operators import classification as K
from inkfold.operators import quality as Q
from inkfold.params import CategoryParams, EntityParams, PriorityParams
from inkfold.sources import sinks, tables


def column(spark, values, expr, schema="v string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)
    return [r[1] for r in sorted(rows.select("i", expr.alias("x")).collect())]


def articles(spark, rows):
    return spark.createDataFrame(
        rows,
        "article_id string, title string, content string, author string, publish_time string",
    )


def test_strip_removes_all_unicode_white_space(spark):
    values = ["\n a\t", "　价值 ", "\x1c\x85x ", "", "   ", "a b"]
    assert column(spark, values, strip(F.col("v"))) == [v.strip() for v in values]
    assert all(c.isspace() for c in WHITESPACE)


def test_first_int_defaults_to_zero(spark):
    values = ["赞 12 34", "none", "", "99999999999999"]
    assert column(spark, values, first_int(F.col("v"), r"(\d+)")) == [12, 0, 0, 0]


def test_fill_leaves_other_braces(spark):
    expr = fill('{"a": {x}} {y}', x=F.col("v"), y=F.lit(1))
    assert column(spark, ["q"], expr) == ['{"a": q} 1']


def test_contains_any_of_nothing_is_false(spark):
    assert column(spark, ["a"], contains_any(F.col("v"), ())) == [False]


@pytest.mark.parametrize(
    "title,content,issues",
    [
        ("ab", "c" * 200, ["标题过短"]),
        ("abc", "c" * 200, []),
        ("abc", "c" * 199, ["内容过短(199字)"]),
        ("", "", ["标题过短", "内容过短(0字)"]),
        (None, None, ["标题过短", "内容过短(0字)"]),
        ("   ", " " * 200, []),
        ("📊a价", "价" * 200, []),
    ],
)
def test_report_gate(spark, title, content, issues):
    row = Q.quality_gate_report(articles(spark, [("1", title, content, None, None)])).first()
    assert row.issues == issues
    assert row.quality_passed == (not issues)


@pytest.mark.parametrize(
    "title,content,author,time,issues,passed",
    [
        ("abc", "c" * 200, "x", "t", [], True),
        ("  a ", "c" * 200, "x", "t", ["标题为空或过短"], False),
        ("abc", " " + "c" * 199, "x", "t", ["正文为空或过短(200字符)"], False),
        ("abc", "c" * 200, "", None, ["作者为空", "发布时间为空"], True),
        (None, None, None, None, ["标题为空或过短", "正文为空或过短(0字符)", "作者为空", "发布时间为空"], False),
    ],
)
def test_full_gate(spark, title, content, author, time, issues, passed):
    row = Q.quality_gate_full(articles(spark, [("1", title, content, author, time)])).first()
    assert (row.issues, row.quality_passed) == (issues, passed)


@pytest.mark.parametrize(
    "length,keyword,expected",
    [
        (3001, False, "must_read"),
        (3000, False, "worth_reading"),
        (1001, False, "worth_reading"),
        (1000, False, "reference"),
        (1000, True, "worth_reading"),
        (501, True, "worth_reading"),
        (500, True, "reference"),
    ],
)
def test_priority(spark, length, keyword, expected):
    title = "估值" if keyword else "t"
    rows = articles(spark, [("1", title, "c" * length, None, None)])
    assert K.priority_rule(rows).first().priority == expected


def test_priority_keyword_may_span_title_and_text(spark):
    rows = articles(spark, [("1", "xa", "b" + "c" * 600, None, None)])
    assert K.priority_rule(rows, PriorityParams(keywords=("ab",))).first().priority == "worth_reading"


def test_category_takes_the_first_list_and_respects_case(spark):
    texts = ["行业 估值", "赛道", "护城河", "pe pb", "PE", ""]
    rows = articles(spark, [(str(i), "t", t, None, None) for i, t in enumerate(texts)])
    got = [r.category for r in K.category_rule(rows).orderBy("article_id").collect()]
    assert got == ["公司研究", "行业分析", "投资理念", "其他", "公司研究", "其他"]
    assert K.category_rule(rows, CategoryParams(rules=())).first().category == "其他"


def test_entities_in_order_of_first_appearance(spark):
    rows = articles(spark, [("1", "$ZZ", "$B $A $B $C $D $E $F", None, None), ("2", None, None, None, None)])
    got = {r.article_id: r.related_stocks for r in K.cashtag_extract(rows).collect()}
    assert got == {"1": ["B", "A", "C", "D", "E"], "2": []}
    every = K.cashtag_extract(rows, EntityParams(at_most=None)).first().related_stocks
    assert every == ["B", "A", "C", "D", "E", "F", "ZZ"]


def test_importance_route(spark):
    rows = spark.createDataFrame([("high",), ("medium",), ("low",), ("?",), ("",), (None,)], "importance string")
    assert [r.route for r in K.importance_route(rows).collect()] == [
        "high", "medium", "low", "low", "low", "medium",
    ]


def test_rule_results(spark):
    rows = articles(
        spark, [("1", "标题" * 20, "PE" + "c" * 600, None, None), ("2", "x", "short", None, None)]
    )
    good, bad = K.analyze_rules(rows).orderBy("article_id").collect()
    assert (good.quality_passed, good.issues, good.priority) == (True, ["未配置 API Key"], "reference")
    assert good.analysis.category == "公司研究" and good.analysis.summary == "标题" * 15
    assert good.analysis.related_stocks == [] and good.analysis.value_investment.alignment == "待分析"
    assert (bad.quality_passed, bad.priority, bad.analysis) == (False, "reference", None)
    assert bad.issues == ["标题过短", "内容过短(5字)"]
    second = K.analyze_rules_v2(articles(spark, [("1", "", "$AB", None, None)])).first().analysis
    assert (second.core_thesis, second.related_stocks, second.key_data) == ("待分析", ["AB"], {})


def test_quality_summary_shows_ten_and_keeps_clean_days(spark):
    rows = spark.createDataFrame(
        [("d1", f"{i:02d}", f"2024-01-01 00:00:{i:02d}", i == 0, [] if i == 0 else ["a", "b"]) for i in range(13)]
        + [("d2", "x", "2024-01-02 00:00:00", True, [])],
        "date string, article_id string, crawl_time string, quality_passed boolean, issues array<string>",
    )
    summary = Q.quality_summary(rows)
    first = sorted((r.row_no, r.article_id, r.issue_text) for r in summary.filter("date = 'd1'").collect())
    assert first == [(i, f"{i:02d}", "a, b") for i in range(1, 11)]
    text = {r.date: r.summary for r in Q.render_quality_summary(summary).collect()}
    assert text["d2"].split("\n") == [
        "## 📋 质量检测报告 - d2", "", "- 总文章数: 1", "- 通过: 1", "- 失败: 0",
    ]
    assert text["d1"].split("\n")[5:9] == ["", "### ⚠️ 异常文章", "", "- **01**: a, b"]
    assert len(text["d1"].split("\n")) == 18


def test_merged_logs_add_up(spark):
    log = spark.createDataFrame([("d", 3, 2, 1), ("e", 1, 1, 0)], "date string, total_articles bigint, passed bigint, failed bigint")
    merged = {r.date: (r.total_articles, r.passed, r.failed) for r in Q.merge_quality_logs(log, log.limit(1)).collect()}
    assert merged == {"d": (6, 4, 2), "e": (1, 1, 0)}


def gated_rows(spark, rows):
    """(date, id, second, passed)."""
    return spark.createDataFrame(
        [(d, f"{i:04d}", f"u{i % 3}", f"title {i}", f"{s:06d}", ok, [] if ok else [f"issue {i}"], "text" * i)
         for d, i, s, ok in rows],
        "date string, article_id string, user_id string, title string, crawl_time string, "
        "quality_passed boolean, issues array<string>, content string",
    )


def test_logs_keep_the_first_failures_and_merge_in_any_grouping(spark, tmp_path):
    rnd = random.Random(6)
    rows = [(f"d{i % 4}", i, rnd.randrange(1000), i % 4 == 3 or rnd.random() < 0.3) for i in range(160)]
    parts = [gated_rows(spark, [r for r in rows if r[1] % 3 == k]) for k in range(3)]
    logs = [Q.quality_log(p) for p in parts]
    want = {}
    for k in range(3):
        for d in {r[0] for r in rows}:
            own = sorted((s, i) for x, i, s, ok in rows if x == d and i % 3 == k and not ok)
            want.setdefault(d, []).extend(f"{i:04d}" for _, i in own[:10])
    flat = Q.merge_quality_logs(*logs)
    nested = Q.merge_quality_logs(Q.merge_quality_logs(logs[0], logs[1]), logs[2])
    for merged in (flat, nested):
        found = {r.date: r for r in merged.collect()}
        assert {d: [x.article_id for x in r.issues] for d, r in found.items()} == {d: w[:10] for d, w in want.items()}
        assert all(r.total_articles == 40 and r.passed + r.failed == 40 for r in found.values())
    # Stored and read back, the log gives the summary that the articles give.
    whole = gated_rows(spark, rows)
    path = str(tmp_path / "log")
    sinks.write_quality_log(Q.quality_log(whole), path)
    stored = tables.scan_quality_log(spark, path, multiline=False)
    columns = ["date", "total_articles", "passed", "failed", "row_no", "article_id", "issue_text"]
    assert sorted(map(str, Q.summary_of_log(stored).select(columns).collect())) == sorted(
        map(str, Q.quality_summary(whole).select(columns).collect())
    )
    assert sorted(Q.render_quality_summary(Q.summary_of_log(stored)).collect()) == sorted(
        Q.render_quality_summary(Q.quality_summary(whole)).collect()
    )
