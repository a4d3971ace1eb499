"""Quality gates and their daily log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.functions import rules as R
from inkfold.functions.ranking import first_k
from inkfold.functions.text import cut, text
from inkfold.params import GateParams


def quality_gate_report(
    articles: DataFrame, p: GateParams = GateParams(), content: str = "content"
) -> DataFrame:
    """Adds ``issues`` and ``quality_passed`` by the report's gate."""
    return articles.withColumn(
        "issues", R.report_gate_issues(text("title"), text(content), p)
    ).withColumn("quality_passed", F.size("issues") == 0)


def quality_gate_full(
    articles: DataFrame, p: GateParams = GateParams(), content: str = "content"
) -> DataFrame:
    """Adds ``issues`` and ``quality_passed`` by the full gate."""
    issues, passed = R.full_gate(
        text("title"), text(content), text("author"), text("publish_time"), p
    )
    return articles.withColumns({"issues": issues, "quality_passed": passed})


def quality_log_daily(gated: DataFrame, day: str | Column = "date") -> DataFrame:
    """Totals per day; partial sums leave every map task, so a hot day costs one row each."""
    by = F.col(day) if isinstance(day, str) else day
    return gated.groupBy(by.alias("date")).agg(
        F.count(F.lit(1)).alias("total_articles"),
        F.count_if("quality_passed").alias("passed"),
        F.count_if(~F.col("quality_passed")).alias("failed"),
    )


def quality_failures(
    gated: DataFrame, p: GateParams = GateParams(), content: str = "content"
) -> DataFrame:
    """One row per article that failed. A narrow projection, no shuffle."""
    return gated.filter(~F.col("quality_passed")).select(
        "date",
        text("article_id", "unknown").alias("article_id"),
        text("user_id").alias("user_id"),
        cut(text("title"), p.log_title_chars).alias("title"),
        "issues",
        F.length(text(content)).cast("bigint").alias("content_length"),
        "crawl_time",
    )


def quality_log(gated: DataFrame, p: GateParams = GateParams(), content: str = "content") -> DataFrame:
    """Totals per day with the day's first failures as ``issues``, as the log stores them.

    The failures are cut to ``summary_rows`` in the map tasks, so a day's list is short
    however many articles fail; ``quality_failures`` has them all.
    """
    details = ["article_id", "user_id", "title", "issues", "content_length"]
    failures = quality_failures(gated, p, content)
    first = (
        first_k(failures, ["date"], ["crawl_time", "article_id"], p.summary_rows, "row_no")
        .groupBy("date")
        .agg(F.array_sort(F.collect_list(F.struct("row_no", F.struct(*details).alias("f")))).alias("_f"))
        .select("date", F.col("_f.f").alias("issues"))
    )
    none = F.array().cast(first.schema["issues"].dataType)
    return (
        quality_log_daily(gated)
        .join(first, "date", "left")
        .withColumn("issues", F.coalesce("issues", none))
    )


def merge_quality_logs(*logs: DataFrame, p: GateParams = GateParams()) -> DataFrame:
    """Several logs as one: counters added up per day, failures in order of the logs.

    Of each day the first ``summary_rows`` failures stay, which is associative: merging
    merged logs gives the same. A log without ``issues`` has none.
    """
    counters = ["total_articles", "passed", "failed"]
    kind = next((log.schema["issues"].dataType for log in logs if "issues" in log.columns), None)
    parts = []
    for number, log in enumerate(logs):
        issues = []
        if kind is not None:
            own = F.col("issues") if "issues" in log.columns else F.lit(None)
            issues = [F.coalesce(own.cast(kind), F.array().cast(kind)).alias("issues")]
        parts.append(log.select("date", *counters, F.lit(number).alias("_log"), *issues))
    merged = reduce(lambda a, b: a.unionByName(b), parts).groupBy("date")
    sums = [F.sum(c).alias(c) for c in counters]
    if kind is None:
        return merged.agg(*sums)
    lists = F.array_sort(F.collect_list(F.struct("_log", F.slice("issues", 1, p.summary_rows).alias("i"))))
    return merged.agg(*sums, lists.alias("_lists")).select(
        "date", *counters, F.slice(F.flatten(F.col("_lists.i")), 1, p.summary_rows).alias("issues")
    )


def summary_of_log(log: DataFrame) -> DataFrame:
    """The summary of ``quality_summary`` from stored logs, without the articles."""
    return log.select(
        "date", "total_articles", "passed", "failed",
        F.posexplode_outer("issues").alias("_pos", "_issue"),
    ).select(
        "date", "total_articles", "passed", "failed",
        F.col("_issue.article_id").alias("article_id"),
        F.array_join("_issue.issues", ", ").alias("issue_text"),
        (F.col("_pos") + 1).cast("bigint").alias("row_no"),
    )


def quality_summary(gated: DataFrame, p: GateParams = GateParams()) -> DataFrame:
    """Per day: the totals, and the first failures with their issues joined.

    A day without failures keeps one row with NULL details.
    """
    failures = gated.filter(~F.col("quality_passed")).select(
        "date", "article_id", "crawl_time", F.array_join("issues", ", ").alias("issue_text")
    )
    first = first_k(
        failures, ["date"], ["crawl_time", "article_id"], p.summary_rows, "row_no"
    ).drop("crawl_time")
    return quality_log_daily(gated).join(first, "date", "left")


def render_quality_summary(summary: DataFrame) -> DataFrame:
    """One text per day; a day has at most ``summary_rows`` detail lines."""
    line = F.concat(
        F.lit("- **"), F.col("article_id"), F.lit("**: "), F.col("issue_text")
    )
    by_day = summary.groupBy("date", "total_articles", "passed", "failed").agg(
        F.array_sort(
            F.collect_list(
                F.when(F.col("row_no").isNotNull(), F.struct("row_no", line.alias("line")))
            )
        ).alias("rows")
    )
    head = [
        F.concat(F.lit("## 📋 质量检测报告 - "), F.col("date").cast("string")),
        F.lit(""),
        F.concat(F.lit("- 总文章数: "), F.col("total_articles").cast("string")),
        F.concat(F.lit("- 通过: "), F.col("passed").cast("string")),
        F.concat(F.lit("- 失败: "), F.col("failed").cast("string")),
    ]
    details = F.when(
        F.size("rows") > 0,
        F.concat(
            F.array(F.lit(""), F.lit("### ⚠️ 异常文章"), F.lit("")),
            F.transform("rows", lambda r: r["line"]),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return by_day.select(
        "date", F.array_join(F.concat(F.array(*head), details), "\n").alias("summary")
    )
