"""Prompts for a model and the reading of its stored responses.

The model call is outside: prompts go out as a table, responses come in as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.functions import rules as R
from inkfold.functions.responses import json_text_v1, json_text_v2, with_object
from inkfold.functions.text import cut, fill, text
from inkfold.operators.quality import quality_gate_report
from inkfold.params import (
    PROMPT_V1,
    PROMPT_V2,
    EntityParams,
    GateParams,
    PriorityParams,
    ResponseParams,
    RuleTextsV2,
)
from inkfold.schemas import ANALYSIS_V1, ANALYSIS_V2


def prompt_build_v1(
    articles: DataFrame,
    template: str = PROMPT_V1,
    p: ResponseParams = ResponseParams(),
    content: str = "content",
) -> DataFrame:
    """Adds ``prompt``: the word count is of the whole text, the text itself is cut."""
    body = text(content)
    return articles.withColumn(
        "prompt",
        fill(
            template,
            title=text("title", p.no_title),
            author=text("author", p.no_author),
            word_count=F.length(body),
            content=cut(body, p.prompt_chars_v1),
        ),
    )


def prompt_build_v2(
    articles: DataFrame,
    template: str = PROMPT_V2,
    p: ResponseParams = ResponseParams(),
    content: str = "content",
) -> DataFrame:
    return articles.withColumn(
        "prompt",
        fill(
            template,
            title=text("title", p.no_title),
            content=cut(text(content), p.prompt_chars_v2),
        ),
    )


def parse_response_v1(
    responses: DataFrame, p: ResponseParams = ResponseParams(), response: str = "response"
) -> DataFrame:
    """Adds ``analysis`` and whether it was readable. A fenced block that does not parse
    is a failure; the text around it is not tried."""
    raw = F.col(response)
    return (
        with_object(responses, json_text_v1(raw, p), ANALYSIS_V1, "_parsed")
        .withColumn("readable", F.col("_parsed").isNotNull())
        .withColumn("analysis", F.coalesce("_parsed", R.unreadable_v1(raw, p)))
        .drop("_parsed")
    )


def parse_response_v2(
    responses: DataFrame,
    p: ResponseParams = ResponseParams(),
    texts: RuleTextsV2 = RuleTextsV2(),
    response: str = "response",
) -> DataFrame:
    raw = F.col(response)
    return (
        with_object(responses, json_text_v2(raw, p), ANALYSIS_V2, "_parsed")
        .withColumn("readable", F.col("_parsed").isNotNull())
        .withColumn("analysis", F.coalesce("_parsed", R.unreadable_v2(raw, p, texts)))
        .drop("_parsed")
    )


def attach_responses_v1(
    articles: DataFrame,
    responses: DataFrame,
    gate: GateParams = GateParams(),
    priority: PriorityParams = PriorityParams(),
    p: ResponseParams = ResponseParams(),
    content: str = "content",
) -> DataFrame:
    """Results of articles whose responses are stored by ``article_id``.

    ``responses`` has ``article_id``, ``response`` and ``error`` (why a call failed). An
    article past the gate without a response keeps an error issue and no analysis. Wide
    text is reduced to the gate's outcome before the join.
    """
    narrow = [c for c in articles.columns if c != content]
    judged = (
        quality_gate_report(articles, gate, content)
        .withColumn("_rule", R.priority(text("title"), text(content), priority))
        .withColumn("word_count", F.length(text(content)).cast("bigint"))
        .drop(content)
    )
    answered = parse_response_v1(responses, p).select(
        "article_id", "analysis", "error", F.lit(True).alias("_there")
    )
    joined = judged.join(answered, "article_id", "left")
    passed = F.col("quality_passed")
    answer = F.coalesce(F.col("_there") & F.col("error").isNull(), F.lit(False))
    problem = F.array(F.concat(F.lit(p.call_failed), text("error")))
    return joined.select(
        *narrow,
        "word_count",
        "quality_passed",
        F.when(passed & ~answer, problem).otherwise(F.col("issues")).alias("issues"),
        F.when(passed & answer, F.col("_rule")).otherwise("reference").alias("priority"),
        F.when(passed & answer, F.col("analysis")).alias("analysis"),
    )


def attach_responses_v2(
    articles: DataFrame,
    responses: DataFrame,
    entity: EntityParams = EntityParams(),
    texts: RuleTextsV2 = RuleTextsV2(),
    p: ResponseParams = ResponseParams(),
    content: str = "content",
) -> DataFrame:
    """As above for the second form: without a response the rules speak."""
    narrow = [c for c in articles.columns if c != content]
    ruled = articles.withColumn(
        "_rule", R.rule_analysis_v2(text("title"), text(content), entity, texts)
    ).drop(content)
    answered = (
        parse_response_v2(responses.filter(F.col("response").isNotNull()), p, texts)
        .filter(F.col("error").isNull())
        .select("article_id", "analysis")
    )
    return ruled.join(answered, "article_id", "left").select(
        *narrow, F.coalesce("analysis", "_rule").alias("analysis")
    )
