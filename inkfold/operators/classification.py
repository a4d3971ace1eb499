"""Rule-based classification of gated articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.functions import rules as R
from inkfold.functions.text import text
from inkfold.operators.quality import quality_gate_report
from inkfold.params import (
    CategoryParams,
    EntityParams,
    GateParams,
    PriorityParams,
    RuleTextsV1,
    RuleTextsV2,
)


def priority_rule(
    articles: DataFrame, p: PriorityParams = PriorityParams(), content: str = "content"
) -> DataFrame:
    return articles.withColumn("priority", R.priority(text("title"), text(content), p))


def category_rule(
    articles: DataFrame, p: CategoryParams = CategoryParams(), content: str = "content"
) -> DataFrame:
    return articles.withColumn("category", R.category(text(content), p))


def cashtag_extract(
    articles: DataFrame, p: EntityParams = EntityParams(), content: str = "content"
) -> DataFrame:
    return articles.withColumn(
        "related_stocks", R.entities(F.concat(text(content), text("title")), p)
    )


def importance_route(analyses: DataFrame, importance: str = "importance") -> DataFrame:
    return analyses.withColumn("route", R.importance(F.col(importance)))


def analyze_rules(
    articles: DataFrame,
    gate: GateParams = GateParams(),
    priority: PriorityParams = PriorityParams(),
    category: CategoryParams = CategoryParams(),
    texts: RuleTextsV1 = RuleTextsV1(),
    content: str = "content",
) -> DataFrame:
    """The whole result without any model: gate, priority, topic and fixed texts.

    An article that fails the gate is ``reference`` and has no analysis.
    """
    gated = quality_gate_report(articles, gate, content)
    passed = F.col("quality_passed")
    return gated.select(
        *articles.columns,
        "quality_passed",
        F.when(passed, F.array(F.lit(texts.issue))).otherwise(F.col("issues")).alias("issues"),
        F.when(passed, R.priority(text("title"), text(content), priority))
        .otherwise("reference")
        .alias("priority"),
        F.when(
            passed, R.rule_analysis_v1(text("title"), text(content), category, texts)
        ).alias("analysis"),
    )


def analyze_rules_v2(
    articles: DataFrame,
    entity: EntityParams = EntityParams(),
    texts: RuleTextsV2 = RuleTextsV2(),
    content: str = "content",
) -> DataFrame:
    return articles.withColumn(
        "analysis", R.rule_analysis_v2(text("title"), text(content), entity, texts)
    )
