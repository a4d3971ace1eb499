"""Quality gate, priority, topic and entity rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkfold.functions.text import contains_any, cut, nonempty, strip
from inkfold.params import (
    CategoryParams,
    EntityParams,
    GateParams,
    PriorityParams,
    ResponseParams,
    RuleTextsV1,
    RuleTextsV2,
)


def _counted(parts: tuple[str, str], n: Column) -> Column:
    return F.concat(F.lit(parts[0]), n.cast("string"), F.lit(parts[1]))


def report_gate_issues(title: Column, content: Column, p: GateParams) -> Column:
    """Issues of the report gate: lengths as they are, nothing stripped."""
    return F.array_compact(
        F.array(
            F.when(F.length(title) < p.min_title, F.lit(p.short_title)),
            F.when(
                F.length(content) < p.min_content, _counted(p.short_content, F.length(content))
            ),
        )
    )


def full_gate(
    title: Column, content: Column, author: Column, publish_time: Column, p: GateParams
) -> tuple[Column, Column]:
    """(issues, passed): stripped lengths decide, a missing author or time is only noted."""
    bad_title = F.length(strip(title)) < p.min_title
    bad_content = F.length(strip(content)) < p.min_content
    issues = F.array_compact(
        F.array(
            F.when(bad_title, F.lit(p.empty_title)),
            F.when(bad_content, _counted(p.empty_content, F.length(content))),
            F.when(author == "", F.lit(p.empty_author)),
            F.when(publish_time == "", F.lit(p.empty_publish_time)),
        )
    )
    return issues, ~(bad_title | bad_content)


def priority(title: Column, content: Column, p: PriorityParams) -> Column:
    """Length first; keywords are looked up only in texts of middle length."""
    n = F.length(content)
    return (
        F.when(n > p.must_read_over, "must_read")
        .when(n > p.worth_reading_over, "worth_reading")
        .when(
            (n > p.keyword_over) & contains_any(F.concat(title, content), p.keywords),
            "worth_reading",
        )
        .otherwise("reference")
    )


def category(content: Column, p: CategoryParams) -> Column:
    hits = [F.when(contains_any(content, words), F.lit(name)) for name, words in p.rules]
    return F.coalesce(*hits, F.lit(p.other))


def entity_mentions(text: Column, p: EntityParams) -> Column:
    """Every entity match, in order, repeats kept."""
    return F.regexp_extract_all(text, F.lit(p.pattern), 1)


def entities(text: Column, p: EntityParams) -> Column:
    """Distinct entities in order of first appearance, at most ``p.at_most``."""
    distinct = F.array_distinct(entity_mentions(text, p))
    return distinct if p.at_most is None else F.slice(distinct, 1, p.at_most)


def importance(value: Column) -> Column:
    """high and medium stay; a missing value is medium; anything else is low."""
    known = F.coalesce(value, F.lit("medium"))
    return F.when(known.isin("high", "medium"), known).otherwise("low")


def _texts(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def rule_analysis_v1(title: Column, content: Column, c: CategoryParams, t: RuleTextsV1) -> Column:
    return F.struct(
        category(content, c).alias("category"),
        _texts().alias("related_stocks"),
        _texts(t.core_point).alias("core_points"),
        F.struct(
            F.lit(t.pending).alias("alignment"),
            F.lit(t.pending).alias("margin_of_safety"),
            F.lit(t.assessment).alias("analysis"),
        ).alias("value_investment"),
        _texts(t.insight).alias("insights"),
        cut(title, t.summary_chars).alias("summary"),
    )


def rule_analysis_v2(title: Column, content: Column, e: EntityParams, t: RuleTextsV2) -> Column:
    return F.struct(
        F.lit(t.importance).alias("importance"),
        F.lit(t.content_type).alias("content_type"),
        entities(F.concat(content, title), e).alias("related_stocks"),
        _texts().alias("related_industries"),
        F.coalesce(nonempty(cut(title, t.thesis_chars)), F.lit(t.no_thesis)).alias("core_thesis"),
        F.create_map().cast("map<string,string>").alias("key_data"),
        F.lit(t.implications).alias("investment_implications"),
        F.lit(t.action).alias("action_required"),
        F.lit(t.confidence).alias("confidence"),
    )


def unreadable_v1(response: Column, p: ResponseParams) -> Column:
    """What stands in for a response that cannot be read (first form)."""
    return F.struct(
        F.lit(p.other).alias("category"),
        _texts().alias("related_stocks"),
        _texts(p.failed_point).alias("core_points"),
        F.struct(
            F.lit(p.unsure).alias("alignment"),
            F.lit(p.unsure).alias("margin_of_safety"),
            F.lit(p.failed).alias("analysis"),
        ).alias("value_investment"),
        _texts(p.failed).alias("insights"),
        F.coalesce(nonempty(cut(response, p.fallback_chars)), F.lit(p.failed)).alias("summary"),
    )


def unreadable_v2(response: Column, p: ResponseParams, t: RuleTextsV2) -> Column:
    """What stands in for a response that cannot be read (second form)."""
    return F.struct(
        F.lit(t.importance).alias("importance"),
        F.lit(t.content_type).alias("content_type"),
        _texts().alias("related_stocks"),
        _texts().alias("related_industries"),
        F.coalesce(cut(response, p.fallback_chars), F.lit("")).alias("core_thesis"),
        F.create_map().cast("map<string,string>").alias("key_data"),
        F.lit("").alias("investment_implications"),
        F.lit(t.action).alias("action_required"),
        F.lit(t.confidence).alias("confidence"),
    )
