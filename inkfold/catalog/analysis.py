"""Queries over quality gates, classification and model responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkfold.catalog.registry import query
from inkfold.catalog.views import (
    SQL_ISSUES,
    TEST,
    Views,
    sql_category,
    sql_entities,
    sql_first_seen,
    sql_priority,
    sql_strip,
)
from inkfold.operators import classification as K
from inkfold.operators import quality as Q
from inkfold.operators import responses as G
from inkfold.session import run_folder
from inkfold.sources import sinks, tables

_PASSED = "length(title) >= 3 and length(content) >= 200"


@query(
    "quality_gate_report",
    f"select article_id, {_PASSED} as quality_passed, {SQL_ISSUES} as issues from articles",
    "articles",
)
def quality_gate_report(v: Views):
    return Q.quality_gate_report(v.articles, TEST.gate).select(
        "article_id", "quality_passed", F.array_join("issues", ", ").alias("issues")
    )


_BAD_TITLE = f"length({sql_strip('title')}) < 3"
_BAD_CONTENT = f"length({sql_strip('content')}) < 200"
_SQL_FULL = f"""
select *, not ({_BAD_TITLE} or {_BAD_CONTENT}) as quality_passed,
  array_to_string(list_filter([case when {_BAD_TITLE} then '标题为空或过短' end,
    case when {_BAD_CONTENT} then '正文为空或过短(' || length(content) || '字符)' end,
    case when coalesce(author, '') = '' then '作者为空' end,
    case when coalesce(publish_time, '') = '' then '发布时间为空' end], lambda x: x is not null), ', ')
    as issue_text from articles"""


@query(
    "quality_gate_full",
    f"with g as ({_SQL_FULL}) select article_id, quality_passed, issue_text from g",
    "articles",
)
def quality_gate_full(v: Views):
    return Q.quality_gate_full(v.articles, TEST.gate).select(
        "article_id", "quality_passed", F.array_join("issues", ", ").alias("issue_text")
    )


_SQL_DAILY = """daily as (select date, count(*) as total_articles, count(*) filter (where quality_passed) as passed,
  count(*) filter (where not quality_passed) as failed from g group by 1)"""


@query(
    "quality_log_daily",
    f"with g as ({_SQL_FULL}), {_SQL_DAILY} select * from daily",
    "articles",
)
def quality_log_daily(v: Views):
    return Q.quality_log_daily(Q.quality_gate_full(v.articles, TEST.gate))


@query(
    "quality_log_failures",
    f"""
with g as ({_SQL_FULL})
select date, article_id, user_id, left(title, 50) as title, issue_text as issues,
  length(content) as content_length from g where not quality_passed""",
    "articles",
)
def quality_log_failures(v: Views):
    return Q.quality_failures(Q.quality_gate_full(v.articles, TEST.gate), TEST.gate).select(
        "date", "article_id", "user_id", "title", F.array_join("issues", ", ").alias("issues"),
        "content_length",
    )


_SQL_SUMMARY = f"""g as ({_SQL_FULL}), {_SQL_DAILY},
f as (select * from (select date, article_id, issue_text,
  row_number() over (partition by date order by crawl_time, article_id) as row_no
  from g where not quality_passed) where row_no <= 10)"""


@query(
    "quality_summary",
    f"""
with {_SQL_SUMMARY}
select d.date, total_articles, passed, failed, f.row_no, f.article_id, f.issue_text
from daily d left join f on f.date = d.date""",
    "articles",
)
def quality_summary(v: Views):
    return Q.quality_summary(Q.quality_gate_full(v.articles, TEST.gate), TEST.gate)


@query(
    "quality_summary_text",
    f"""
with {_SQL_SUMMARY},
t as (select date, string_agg('- **' || article_id || '**: ' || issue_text, chr(10) order by row_no) as t
  from f group by 1)
select d.date, '## 📋 质量检测报告 - ' || d.date || chr(10) || chr(10) || '- 总文章数: ' || total_articles
  || chr(10) || '- 通过: ' || passed || chr(10) || '- 失败: ' || failed
  || coalesce(chr(10) || chr(10) || '### ⚠️ 异常文章' || chr(10) || chr(10) || t, '') as summary
from daily d left join t on t.date = d.date""",
    "articles",
)
def quality_summary_text(v: Views):
    """Made from the stored log: the articles are not read again."""
    path = run_folder(v.spark, "quality_log")
    gated = Q.quality_gate_full(v.articles, TEST.gate)
    sinks.write_quality_log(Q.quality_log(gated, TEST.gate), path)
    log = tables.scan_quality_log(v.spark, path, multiline=False)
    return Q.render_quality_summary(Q.summary_of_log(log.withColumn("date", F.to_date("date"))))


# --- classification ---


@query(
    "priority_rule",
    f"select article_id, {sql_priority('title', 'content')} as priority from articles",
    "articles",
)
def priority_rule(v: Views):
    return K.priority_rule(v.articles, TEST.priority).select("article_id", "priority")


@query(
    "category_rule",
    f"select article_id, {sql_category('content')} as category from articles",
    "articles",
)
def category_rule(v: Views):
    return K.category_rule(v.articles, TEST.category).select("article_id", "category")


@query(
    "cashtag_extract",
    f"""
select article_id, array_to_string({sql_first_seen(sql_entities('content || title'))}, ',') as stocks
from articles""",
    "articles",
)
def cashtag_extract(v: Views):
    return K.cashtag_extract(v.articles, TEST.entity).select(
        "article_id", F.array_join("related_stocks", ",").alias("stocks")
    )


@query(
    "importance_route",
    """
select event_id, case coalesce(nullif(event_type, 'signup'), 'view') when 'view' then 'medium'
  when 'purchase' then 'high' else 'low' end as route from events""",
)
def importance_route(v: Views):
    """Event types stand for ratings, one of them missing."""
    kind = F.col("event_type")
    rated = v.table("events").select(
        "event_id",
        F.when(kind == "purchase", "high").when(kind == "view", "medium").when(kind != "signup", kind)
        .alias("importance"),
    )
    return K.importance_route(rated).select("event_id", "route")


@query(
    "analyze_rules",
    f"""
select article_id, {_PASSED} as quality_passed,
  case when {_PASSED} then '未配置 API Key' else {SQL_ISSUES} end as issues,
  case when {_PASSED} then {sql_priority('title', 'content')} else 'reference' end as priority,
  case when {_PASSED} then {sql_category('content')} end as category,
  case when {_PASSED} then 0 end as stocks,
  case when {_PASSED} then '需配置 API Key 进行完整分析' end as points,
  case when {_PASSED} then '待分析' end as alignment,
  case when {_PASSED} then left(title, 30) end as summary
from articles""",
    "articles",
)
def analyze_rules(v: Views):
    result = K.analyze_rules(v.articles, TEST.gate, TEST.priority, TEST.category)
    a = F.col("analysis")
    return result.select(
        "article_id",
        "quality_passed",
        F.array_join("issues", ", ").alias("issues"),
        "priority",
        a["category"].alias("category"),
        F.when(a.isNotNull(), F.size(a["related_stocks"])).alias("stocks"),
        F.array_join(a["core_points"], "|").alias("points"),
        a["value_investment"]["alignment"].alias("alignment"),
        a["summary"].alias("summary"),
    )


@query(
    "analyze_rules_v2",
    f"""
select article_id, 'medium' as importance,
  array_to_string({sql_first_seen(sql_entities('content || title'))}, ',') as stocks,
  case when title <> '' then left(title, 30) else '待分析' end as core_thesis, 0 as key_data,
  '需要关注' as action_required, 'low' as confidence from articles""",
    "articles",
)
def analyze_rules_v2(v: Views):
    a = F.col("analysis")
    return K.analyze_rules_v2(v.articles, TEST.entity).select(
        "article_id",
        a["importance"].alias("importance"),
        F.array_join(a["related_stocks"], ",").alias("stocks"),
        a["core_thesis"].alias("core_thesis"),
        F.size(a["key_data"]).alias("key_data"),
        a["action_required"].alias("action_required"),
        a["confidence"].alias("confidence"),
    )


# --- responses ---

_TEMPLATE_V1 = "T:{title} A:{author} N:{word_count}\n{content}"
_TEMPLATE_V2 = "T:{title}\n{content}"


@query(
    "prompt_build_v1",
    """
select article_id, 'T:' || title || ' A:' || coalesce(author, '未知') || ' N:' || length(content)
  || chr(10) || left(content, 4000) as prompt from articles""",
    "articles",
)
def prompt_build_v1(v: Views):
    return G.prompt_build_v1(v.articles, _TEMPLATE_V1).select("article_id", "prompt")


@query(
    "prompt_build_v2",
    "select article_id, 'T:' || title || chr(10) || left(content, 3000) as prompt from articles",
    "articles",
)
def prompt_build_v2(v: Views):
    return G.prompt_build_v2(v.articles, _TEMPLATE_V2).select("article_id", "prompt")


@query(
    "parse_response_v1",
    """
select article_id, way in (0, 1) as readable,
  case when way in (0, 1) then event_type else '其他' end as category,
  case when way in (0, 1) then event_type else '' end as stocks,
  case when way in (0, 1) then null else '解析失败，请查看原文' end as points,
  case when way in (0, 1) then null else '不确定' end as alignment,
  case when way in (0, 1) then 's' || k when way = 2 then left(response, 50) else '解析失败' end as summary
from responses""",
    "responses",
)
def parse_response_v1(v: Views):
    a = F.col("analysis")
    return G.parse_response_v1(v.responses).select(
        "article_id",
        "readable",
        a["category"].alias("category"),
        F.array_join(a["related_stocks"], ",").alias("stocks"),
        F.array_join(a["core_points"], "|").alias("points"),
        a["value_investment"]["alignment"].alias("alignment"),
        a["summary"].alias("summary"),
    )


@query(
    "parse_response_v2",
    """
select article_id, way = 1 as readable, case when way = 1 then 'high' else 'medium' end as importance,
  case when way = 1 then 't' else coalesce(left(response, 50), '') end as core_thesis,
  case when way = 1 then k end as k, case when way = 1 then null else '需要关注' end as action_required
from responses""",
    "responses",
)
def parse_response_v2(v: Views):
    """Here a fence is no help: text after the object makes the response unreadable."""
    a = F.col("analysis")
    return G.parse_response_v2(v.responses).select(
        "article_id",
        "readable",
        a["importance"].alias("importance"),
        a["core_thesis"].alias("core_thesis"),
        F.try_element_at(a["key_data"], F.lit("k")).alias("k"),
        a["action_required"].alias("action_required"),
    )


@query(
    "analysis_fallback_join",
    f"""
select a.article_id, {_PASSED} as quality_passed,
  case when not ({_PASSED}) then {SQL_ISSUES}
    when r.article_id is null then '分析失败: ' when r.error is not null then '分析失败: ' || r.error
    else '' end as issues,
  case when {_PASSED} and r.article_id is not null and r.error is null
    then {sql_priority('title', 'content')} else 'reference' end as priority,
  case when {_PASSED} and r.article_id is not null and r.error is null then
    case when way in (0, 1) then r.event_type else '其他' end end as category,
  length(content) as word_count
from articles a left join (select * from responses where k <> '7') r on r.article_id = a.article_id""",
    "articles responses",
)
def analysis_fallback_join(v: Views):
    """Some articles have no stored response, some an error in its place."""
    k = F.get_json_object("props", "$.k")
    answered = v.table("events").filter(k != "7").select(F.col("event_id").cast("string").alias("article_id"))
    responses = v.responses.join(answered, "article_id", "left_semi")
    return G.attach_responses_v1(v.articles, responses, TEST.gate, TEST.priority).select(
        "article_id", "quality_passed", F.array_join("issues", ", ").alias("issues"), "priority",
        F.col("analysis.category").alias("category"), "word_count",
    )


@query(
    "analysis_fallback_join_v2",
    f"""
select a.article_id,
  case when r.response is not null and r.error is null and way = 1 then 'high' else 'medium' end as importance,
  case when r.response is not null and r.error is null
    then case when way = 1 then r.event_type else '' end
    else array_to_string({sql_first_seen(sql_entities('content || title'))}, ',') end as stocks,
  case when r.response is not null and r.error is null
    then case when way = 1 then 't' else left(r.response, 50) end
    when title <> '' then left(title, 30) else '待分析' end as core_thesis
from articles a left join responses r on r.article_id = a.article_id""",
    "articles responses",
)
def analysis_fallback_join_v2(v: Views):
    a = F.col("analysis")
    return G.attach_responses_v2(v.articles, v.responses, TEST.entity).select(
        "article_id",
        a["importance"].alias("importance"),
        F.array_join(a["related_stocks"], ",").alias("stocks"),
        a["core_thesis"].alias("core_thesis"),
    )


@query(
    "priority_by_day",
    f"""
select date, priority, count(*) as articles from (
  select date, {sql_priority('title', 'content')} as priority from articles where {_PASSED})
group by 1, 2""",
    "articles",
)
def priority_by_day(v: Views):
    """Gate, then priority, then counts per day and priority."""
    passed = Q.quality_gate_report(v.articles, TEST.gate).filter("quality_passed")
    return (
        K.priority_rule(passed, TEST.priority)
        .groupBy("date", "priority")
        .agg(F.count(F.lit(1)).alias("articles"))
    )
