"""Report tables and texts against plain-Python expectations."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from inkfold.operators import daily_report as H
from inkfold.operators import investment_report as I
from inkfold.params import SiteParams
from inkfold.schemas import ANALYSIS_V1, ANALYSIS_V2

SITE = SiteParams()


def batch(spark, rows):
    """rows: (date, id, second, passed, priority, analysis dict or None)."""
    schema = (
        "date string, article_id string, user_id string, title string, author string, crawl_time string, "
        "word_count bigint, quality_passed boolean, issues array<string>, priority string, a string"
    )
    data = [
        (d, i, "u", f"title of article {i}", None if i == "2" else "au", f"2024-01-01 00:00:{s:02d}", 10 + s, ok,
         [] if ok else ["x", "y"], p, None if a is None else __import__("json").dumps(a, ensure_ascii=False))
        for d, i, s, ok, p, a in rows
    ]
    return (
        spark.createDataFrame(data, schema)
        .withColumn("date", F.to_date("date"))
        .withColumn("crawl_time", F.col("crawl_time").cast("timestamp"))
        .withColumn("analysis", F.from_json("a", ANALYSIS_V1))
        .drop("a")
    )


ROWS = [
    ("2024-01-01", "1", 5, True, "must_read", {"category": "b", "related_stocks": ["X", "Y", "X"], "core_points": [str(i) for i in range(7)],
     "value_investment": {"alignment": "是"}, "insights": ["i1"], "summary": "s"}),
    ("2024-01-01", "2", 1, True, "worth_reading", {"category": "a", "related_stocks": ["Z"]}),
    ("2024-01-01", "3", 9, False, "reference", None),
    ("2024-01-01", "4", 7, True, "reference", {"category": None, "related_stocks": ["Y", "X"]}),
    ("2024-01-02", "5", 1, False, "reference", None),
]


def test_overview_and_counts_add_up(spark):
    rows = batch(spark, ROWS)
    over = {str(r.date): (r.total, r.passed, r.failed) for r in H.report_overview(rows).collect()}
    assert over == {"2024-01-01": (4, 3, 1), "2024-01-02": (1, 0, 1)}
    counts = {str(r.date): (r.must_read, r.worth_reading, r.reference) for r in H.priority_counts(rows).collect()}
    assert counts == {"2024-01-01": (1, 1, 2), "2024-01-02": (0, 0, 1)}
    assert all(sum(counts[d]) == over[d][0] for d in over)


def test_entities_count_repeats_and_tie_by_first_mention(spark):
    rows = batch(spark, ROWS)
    got = {r.entity: (r.mentions, r.links.count("](")) for r in H.stock_mentions(rows).collect()}
    assert got == {"X": (3, 3), "Y": (2, 2), "Z": (1, 1)}
    links = {r.entity: r.links for r in H.stock_mentions(rows, SITE).collect()}
    assert links["Y"] == "[title of articl](https://site.example/u/1), [title of articl](https://site.example/u/4)"
    hot = sorted((r.place, r.entity) for r in H.hot_stocks(rows).collect())
    assert hot == [(1, "Z"), (2, "X"), (3, "Y")]


def test_hot_entity_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [
        ("2024-01-01", str(i), i % 60, True, "must_read",
         {"related_stocks": [rnd.choice("HHHABC") for _ in range(rnd.randrange(5))]})
        for i in range(300)
    ]
    count, first = Counter(), defaultdict(list)
    for _, i, s, *_, a in sorted(rows, key=lambda r: (r[2], r[1])):
        for e in a["related_stocks"]:
            count[e] += 1
            first[e].append(i)
    got = {r.entity: r for r in H.stock_mentions(batch(spark, rows), SITE).collect()}
    assert {e: r.mentions for e, r in got.items()} == count
    for e, r in got.items():
        assert r.links.split(", ") == [f"[title of articl](https://site.example/u/{i})" for i in first[e][:3]]


def test_topics_skip_missing(spark):
    assert sorted(r.category for r in H.topics_distinct(batch(spark, ROWS)).collect()) == ["a", "b"]


def texts_of(pages):
    """The whole text of each date from its pages."""
    found = defaultdict(list)
    for r in sorted(pages.collect(), key=lambda r: (r.date, r.page)):
        assert r.page == len(found[str(r.date)])
        found[str(r.date)].append(r.report)
    return {date: "".join(parts) for date, parts in found.items()}


def test_report_text(spark):
    rows = batch(spark, ROWS)
    for chars in (10**6, 37):
        texts = texts_of(H.render_report(H.report_blocks(rows, "2024-01-03 01:02:03", SITE), chars))
        lines = texts["2024-01-01"].split("\n")
        at = lines.index("### 🔴 必读文章")
        assert lines[at : at + 34] == [
            "### 🔴 必读文章", "", "#### 1. title of article 1", "", "- **作者**：au",
            "- **链接**：https://site.example/u/1", "- **字数**：15 字", "- **相关股票**：X, Y, X", "",
            "**GLM-5 分析：**", "", "- **主题归类**：b", "", "**核心观点：**",
            *[f"  {i + 1}. {i}" for i in range(5)], "", "**价值投资评估：**", "  - 符合价值投资原则：是",
            "  - 安全边际：不确定", "", "**投资启示：**", "  - i1", "", "**总结**：s", "", "---", "",
            "### 🟡 值得关注", "", "#### 1. title of article 2",
        ]
        assert "- **作者**：未知" in lines
        at = lines.index("### 🔵 参考文章")
        assert lines[at:] == [
            "### 🔵 参考文章", "", "1. [title of article 4](https://site.example/u/4)（au）",
            "2. [title of article 3](https://site.example/u/3)（au）", "   - ⚠️ x, y",
            "---", "", "## 四、相关股票汇总", "", "| 股票 | 出现次数 | 相关文章 |", "|------|----------|----------|",
            "| X | 3 | [title of articl](https://site.example/u/1), [title of articl](https://site.example/u/1), "
            "[title of articl](https://site.example/u/4) |",
            "| Y | 2 | [title of articl](https://site.example/u/1), [title of articl](https://site.example/u/4) |",
            "| Z | 1 | [title of articl](https://site.example/u/2) |",
            "", "---", "", "## 五、今日总结", "", "- **主要话题**：a, b", "- **热门股票**：Z, X, Y", "", "---", "",
            "*报告生成时间：2024-01-03 01:02:03*", "*分析模型：智谱 GLM-5*",
        ]
        # A day with one failed article has one section, no entities and no topics.
        other = texts["2024-01-02"]
        assert "必读文章" not in other and "## 四" not in other
        assert "- **主要话题**：\n- **热门股票**：无" in other


def batch2(spark, analyses, date="2024-01-01"):
    import json

    data = [
        (date, f"{i:02d}", f"T{i} " + "t" * 60, None if i % 2 else f"url{i}", f"link{i}", json.dumps(a, ensure_ascii=False))
        for i, a in enumerate(analyses)
    ]
    return (
        spark.createDataFrame(data, "date string, article_id string, title string, url string, link string, a string")
        .withColumn("date", F.to_date("date"))
        .withColumn("crawl_time", F.lit("2024-01-01").cast("timestamp"))
        .withColumn("analysis", F.from_json("a", ANALYSIS_V2))
        .drop("a")
    )


def test_actions_show_five_and_count_the_rest(spark):
    rows = batch2(
        spark,
        [{"action_required": "看"}] * 6 + [{"action_required": ""}, {"action_required": "无需行动"}, {}] + [{"action_required": "买"}] * 5,
    )
    got = {r.action: (r.titles, len(r.shown), r.more) for r in I.action_list(rows).collect()}
    assert got == {"看": (6, 5, 1), "关注": (1, 1, 0), "买": (5, 5, 0)}
    assert I.action_list(rows).filter("action = '看'").first().shown[0] == ("T0 " + "t" * 60)[:30]


def test_key_data_drops_empty_values(spark):
    rows = batch2(spark, [{"key_data": {"a": "1", "b": "", "c": None}}, {}])
    got = I.key_data_rows(rows, F.col("analysis.key_data"), "article_id").collect()
    assert [(r.article_id, r.key, r.value) for r in got] == [("00", "a", "1")]


def test_investment_text(spark):
    rows = batch2(
        spark,
        [
            {"importance": "high", "related_stocks": ["B", "A"], "core_thesis": "th", "key_data": {"k": "v", "e": ""}},
            {"related_stocks": [], "core_thesis": "m" * 70, "investment_implications": "i" * 90, "action_required": ""},
            {"importance": "odd", "action_required": "无需行动"},
        ],
    )
    (row,) = I.render_investment_report(I.investment_blocks(rows, "now")).collect()
    t = [f"T{i} " + "t" * 60 for i in range(3)]
    assert row.report.split("\n") == [
        "# 📊 价值投资日报 - 2024-01-01", "", "## 📰 今日新增文章", "", "共爬取 **3** 篇新文章。", "", "### 文章列表", "",
        f"1. [{t[0][:50]}](url0) [$B, $A]", f"2. [{t[1][:50]}](link1)", f"3. [{t[2][:50]}](url2)", "",
        "### 关联股票", "", "$**A, $B**", "",
        "## 🔴 高优先级（值得深入研究）", "", f"### [{t[0]}](url0)", "", "**关联标的：** $B, $A", "",
        "**核心论点：** th", "", "**投资启示：** 无", "", "**关键数据：**", "- k: v", "", "**建议行动：** 关注", "", "---", "",
        "## 🟡 中优先级（值得关注）", "", f"### [{t[1][:40]}](link1)", "- **核心论点：** " + "m" * 60,
        "- **关联标的：** 无", "- **启示：** " + "i" * 80, "",
        "## ⚪ 低优先级（信息性内容）", "", f"- [{t[2][:30]}](url2)", "",
        "## ✅ 行动清单", "", "### 关注", f"- {t[0][:30]}", "",
        "---", "", "*报告生成时间：now*", "*分析模型：GLM-5 (qwen-plus)*",
    ]


def test_investment_text_without_entities_or_actions(spark):
    rows = batch2(spark, [{"importance": "low", "action_required": "", "related_stocks": []}])
    (row,) = I.render_investment_report(I.investment_blocks(rows, "now")).collect()
    assert "关联股票" not in row.report and "🔴" not in row.report and "🟡" not in row.report
    assert row.report.endswith("## ✅ 行动清单\n\n---\n\n*报告生成时间：now*\n*分析模型：GLM-5 (qwen-plus)*")


def test_long_lists_are_rows_and_pages_are_even(spark):
    """A day with thousands of topics: their line is as many rows, and no page is too long."""
    rows = [
        ("2024-01-01", f"{i:05d}", i % 60, True, "reference", {"category": f"topic {i:05d}", "related_stocks": []})
        for i in range(3000)
    ]
    blocks = H.report_blocks(batch(spark, rows), "now", SITE)
    lines = H.report_lines(blocks).filter("block = 61")
    assert lines.count() == 3000 and lines.agg(F.max(F.length("line"))).first()[0] < 20
    pages = H.render_report(blocks, 1000)
    sizes = [r.n for r in pages.orderBy("page").select(F.length("report").alias("n")).collect()]
    assert set(sizes[:-1]) == {1000} and len(sizes) > 200
    line = next(x for x in texts_of(pages)["2024-01-01"].split("\n") if "主要话题" in x)
    assert line == "- **主要话题**：" + ", ".join(f"topic {i:05d}" for i in range(3000))


def test_report_without_rows(spark):
    none = batch(spark, ROWS).filter("false")
    assert H.render_report(H.report_blocks(none, "now", SITE)).collect() == []
    assert I.render_investment_report(I.investment_blocks(batch2(spark, [{}]).filter("false"), "now")).collect() == []
