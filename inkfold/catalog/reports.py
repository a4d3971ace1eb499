"""Queries over the tables and texts of both reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkfold.catalog.registry import SQL_STAMP, query, stamp
from inkfold.catalog.views import BASE, TEST, Views
from inkfold.functions import lines
from inkfold.operators import daily_report as H
from inkfold.operators import investment_report as I
from inkfold.session import run_folder
from inkfold.sources import sinks
from inkfold.sources.ordered_text import scan_ordered_text

STAMP = "2024-01-05 08:00:00"
_URL = f"'{BASE}/' || user_id || '/' || article_id"

# --- daily report ---


@query(
    "report_overview",
    """
select date, count(*) as total, count(*) filter (where quality_passed) as passed,
  count(*) filter (where not quality_passed) as failed from batch group by 1""",
    "batch",
)
def report_overview(v: Views):
    return H.report_overview(v.batch)


_SQL_COUNTS = """
select date, count(*) filter (where priority = 'must_read') as must_read,
  count(*) filter (where priority = 'worth_reading') as worth_reading,
  count(*) filter (where priority = 'reference') as reference from {} group by 1"""


@query("priority_counts", _SQL_COUNTS.format("batch"), "batch")
def priority_counts(v: Views):
    return H.priority_counts(v.batch)


_SQL_SECTIONS = """select *, row_number() over (partition by date, priority
  order by crawl_time, article_id) as number from {}"""


@query(
    "article_sections",
    f"with s as ({_SQL_SECTIONS.format('batch')}) select date, priority, article_id, number from s",
    "batch",
)
def article_sections(v: Views):
    return H.article_sections(v.batch).select("date", "priority", "article_id", "number")


_SQL_MENTIONS = """mentions as (select date, crawl_time, article_id, user_id, title,
  unnest(related_stocks) as entity, generate_subscripts(related_stocks, 1) as place
  from {} where quality_passed)"""
_SQL_FIRST3 = f"""ranked as (select *, row_number() over (partition by date, entity
    order by crawl_time, article_id, place) as nth from mentions),
entities as (select date, entity, count(*) as mentions,
  string_agg('[' || left(title, 15) || '](' || {_URL} || ')', ', ' order by nth)
    filter (where nth <= 3) as links,
  min(crawl_time) as first_time, arg_min(article_id, nth) as first_article, arg_min(place, nth) as first_place
  from ranked group by 1, 2)"""


@query(
    "stock_mentions",
    f"""
with {_SQL_MENTIONS.format('batch')}, {_SQL_FIRST3}
select date, entity, mentions, links, first_article from entities""",
    "batch",
)
def stock_mentions(v: Views):
    return H.stock_mentions(v.batch, TEST.site).select(
        "date", "entity", "mentions", "links", F.col("first.ord.article_id").alias("first_article")
    )


_SQL_HOT = """hot as (select * from (select date, entity, row_number() over (partition by date
  order by first_time, first_article, first_place) as place from entities) where place <= 5)"""


@query(
    "hot_stocks",
    f"""
with {_SQL_MENTIONS.format('batch')}, {_SQL_FIRST3}, {_SQL_HOT}
select date, entity, place from hot""",
    "batch",
)
def hot_stocks(v: Views):
    return H.hot_stocks(v.batch)


@query(
    "topics_distinct",
    "select distinct date, category from batch where quality_passed",
    "batch",
)
def topics_distinct(v: Views):
    return H.topics_distinct(v.batch)


_NONE = "cast([] as varchar[])"
_SQL_DETAIL = f"""['#### ' || number || '. ' || title, '', '- **作者**：' || coalesce(author, '未知'),
  '- **链接**：' || {_URL}, '- **字数**：' || word_count || ' 字']
|| case when quality_passed and len(related_stocks) > 0
  then ['- **相关股票**：' || array_to_string(related_stocks, ', ')] else {_NONE} end
|| case when quality_passed then ['', '**GLM-5 分析：**', '', '- **主题归类**：' || category,
  '', '**核心观点：**'] || list_transform(core_points[1:5], lambda x, i: '  ' || i || '. ' || x)
  || ['', '**价值投资评估：**', '  - 符合价值投资原则：' || coalesce(alignment, '不确定'),
  '  - 安全边际：' || coalesce(margin_of_safety, '不确定')] else {_NONE} end
|| case when quality_passed and coalesce(analysis_text, '') <> ''
  then ['  - 分析：' || analysis_text] else {_NONE} end
|| case when quality_passed and len(insights) > 0
  then ['', '**投资启示：**'] || list_transform(insights, lambda x: '  - ' || x) else {_NONE} end
|| case when quality_passed and summary <> '' then ['', '**总结**：' || summary] else {_NONE} end
|| ['', '---', '']"""
_SQL_BRIEF = f"""[number || '. [' || title || '](' || {_URL} || ')（' || coalesce(author, '未知') || '）']
|| case when not quality_passed then ['   - ⚠️ ' || issues] else {_NONE} end"""


def _sql_lines(lines: str, where: str) -> str:
    return f"""
with s as ({_SQL_SECTIONS.format('batch')}), x as (select *, {lines} as lines from s where {where})
select date, priority, number, article_id, unnest(lines) as line,
  cast(generate_subscripts(lines, 1) - 1 as integer) as line_no from x"""


@query(
    "article_detail_rows", _sql_lines(_SQL_DETAIL, "priority in ('must_read', 'worth_reading')"), "batch"
)
def article_detail_rows(v: Views):
    return H.article_detail_rows(v.batch, TEST.site)


@query("article_brief_rows", _sql_lines(_SQL_BRIEF, "priority = 'reference'"), "batch")
def article_brief_rows(v: Views):
    return H.article_brief_rows(v.batch, TEST.site)


def _sql_section(name: str, title: str, lines: str) -> str:
    return f"""(select date, '{title}' || chr(10) || chr(10)
  || string_agg(array_to_string({lines}, chr(10)), chr(10) order by number) as t
  from s where priority = '{name}' group by 1)"""


_SQL_HEAD = """['# 📊 价值投资日报', '', '**日期**：' || o.date, '', '---', '', '## 一、概览', '',
  '- **今日新增**：' || total || ' 篇', '- **有效分析**：' || passed || ' 篇（内容 > 200 字）',
  '- **无效文章**：' || (total - passed) || ' 篇（短状态/评论）', '', '---', '', '## 二、优先级分类', '',
  '| 优先级 | 数量 | 说明 |', '|--------|------|------|',
  '| 🔴 必读 | ' || must_read || ' | 高质量长文，深度分析 |',
  '| 🟡 值得关注 | ' || worth_reading || ' | 有价值的观点和分析 |',
  '| 🔵 参考 | ' || reference || ' | 短状态、预告类 |', '', '---', '', '## 三、文章集合', '']"""
_SQL_ENTITY_HEAD = """['---', '', '## 四、相关股票汇总', '', '| 股票 | 出现次数 | 相关文章 |',
  '|------|----------|----------|']"""
_SQL_TAIL = f"""['', '---', '', '## 五、今日总结', '', '- **主要话题**：' || coalesce(topics, ''),
  '- **热门股票**：' || coalesce(hot, '无'), '', '---', '', '*报告生成时间：{STAMP}*', '*分析模型：智谱 GLM-5*']"""
# The same lines as they are stored: the topics are rows between the two.
_SQL_TAIL_1 = "['', '---', '', '## 五、今日总结', '', '- **主要话题**：']"
_SQL_TAIL_2 = f"""['', '- **热门股票**：' || coalesce(hot, '无'), '', '---', '', '*报告生成时间：{STAMP}*',
  '*分析模型：智谱 GLM-5*']"""
_SQL_ENTITY_LINE = "'| ' || entity || ' | ' || mentions || ' | ' || links || ' |'"


def _sql_day(source: str) -> str:
    """Per-day values of the fixed lines."""
    return f"""
o as (select date, count(*) as total, count(*) filter (where quality_passed) as passed
  from {source} group by 1),
p as ({_SQL_COUNTS.format(source)}),
t as (select date, string_agg(category, ', ' order by category) as topics
  from (select distinct date, category from {source} where quality_passed) group by 1),
h as (select date, string_agg(entity, ', ' order by place) as hot from hot group by 1)"""


_SQL_REPORT = f"""
with chosen as (select * from batch),
s as ({_SQL_SECTIONS.format('chosen')}), {_SQL_MENTIONS.format('chosen')}, {_SQL_FIRST3}, {_SQL_HOT},
{_sql_day('chosen')},
m as {_sql_section('must_read', '### 🔴 必读文章', _SQL_DETAIL)},
w as {_sql_section('worth_reading', '### 🟡 值得关注', _SQL_DETAIL)},
r as {_sql_section('reference', '### 🔵 参考文章', _SQL_BRIEF)},
e as (select date, array_to_string({_SQL_ENTITY_HEAD}, chr(10)) || chr(10)
  || string_agg({_SQL_ENTITY_LINE}, chr(10)
    order by mentions desc, first_time, first_article, first_place) as t from entities group by 1)
select o.date, array_to_string({_SQL_HEAD}, chr(10))
  || coalesce(chr(10) || m.t, '') || coalesce(chr(10) || w.t, '') || coalesce(chr(10) || r.t, '')
  || coalesce(chr(10) || e.t, '') || chr(10) || array_to_string({_SQL_TAIL}, chr(10)) as report
from o join p on p.date = o.date left join m on m.date = o.date left join w on w.date = o.date
left join r on r.date = o.date left join e on e.date = o.date left join t on t.date = o.date
left join h on h.date = o.date"""


# Reports are compared in pages far smaller than those of a real run, so that most of a
# day's pages come from several tasks and cut pieces of text.
PAGE = 20_000


def _sql_pages(reports: str) -> str:
    return f"""
with whole as ({reports}),
cut as (select date, report, unnest(range(0, (length(report) + {PAGE - 1}) // {PAGE})) as page from whole)
select date, page, substring(report, page * {PAGE} + 1, {PAGE}) as report from cut"""


def _daily_blocks(v: Views):
    return H.report_blocks(v.batch, STAMP, TEST.site)


@query("render_report", _sql_pages(_SQL_REPORT), "batch")
def render_report(v: Views):
    """The text of each day over all of its articles; ``report_limit`` is an operator of its own."""
    return H.render_report(_daily_blocks(v), PAGE)


@query("sink_report_text", _sql_pages(_SQL_REPORT), "batch")
def sink_report_text(v: Views):
    """The texts written per date in parts by offset, and read back in slices."""
    path = run_folder(v.spark, "reports")
    sinks.write_report_text(H.report_text(_daily_blocks(v)), path)
    stored = scan_ordered_text(v.spark, path)
    return lines.pages(lines.ordered(stored, "date", "offset"), PAGE)


_SQL_UNNEST = "unnest(lines) as line, cast(generate_subscripts(lines, 1) - 1 as integer) as line_no"


@query(
    "report_lines",
    f"""
with s as ({_SQL_SECTIONS.format('batch')}), {_SQL_MENTIONS.format('batch')}, {_SQL_FIRST3}, {_SQL_HOT},
{_sql_day('batch')},
x as (select date, case priority when 'must_read' then 11 when 'worth_reading' then 21 else 31 end as block,
    number, case when priority = 'reference' then {_SQL_BRIEF} else {_SQL_DETAIL} end as lines from s
  union all select o.date, 0, 0, {_SQL_HEAD} from o join p on p.date = o.date
  union all select date, 10, 0, ['### 🔴 必读文章', ''] from p where must_read > 0
  union all select date, 20, 0, ['### 🟡 值得关注', ''] from p where worth_reading > 0
  union all select date, 30, 0, ['### 🔵 参考文章', ''] from p where reference > 0
  union all select distinct date, 50, 0, {_SQL_ENTITY_HEAD} from entities
  union all select date, 51, -mentions, [{_SQL_ENTITY_LINE}] from entities
  union all select o.date, 60, 0, {_SQL_TAIL_1} from o
  union all select date, 61, 0, [case when category = min(category) over (partition by date) then '' else ', ' end
    || category] from (select distinct date, category from batch where quality_passed)
  union all select o.date, 62, 0, {_SQL_TAIL_2} from o left join h on h.date = o.date)
select date, block, number, {_SQL_UNNEST} from x""",
    "batch",
)
def report_lines(v: Views):
    """Every line of the whole table's reports, without a report limit."""
    return H.report_lines(_daily_blocks(v)).select("date", "block", "number", "line", "line_no")


# --- investment report ---

_SQL_NUMBERED = """select *, row_number() over (partition by date order by crawl_time, article_id) as number
  from {}"""
_SQL_LIST_LINE = """number || '. [' || left(title, 50) || '](' || coalesce(url, link) || ')'
  || case when len(related_stocks) > 0
    then ' [$' || array_to_string(related_stocks, ', $') || ']' else '' end"""


@query(
    "article_list",
    f"""
with n as ({_SQL_NUMBERED.format('batch2')})
select date, number, article_id, {_SQL_LIST_LINE} as line from n""",
    "batch2",
)
def article_list(v: Views):
    return I.article_list(v.batch2)


@query(
    "stocks_union",
    "select distinct date, unnest(related_stocks) as entity from batch2",
    "batch2",
)
def stocks_union(v: Views):
    return I.stocks_union(v.batch2)


_SQL_ROUTED = """select *, case coalesce(importance, 'medium') when 'high' then 'high'
    when 'medium' then 'medium' else 'low' end as route,
  case when len(related_stocks) > 0 then '$' || array_to_string(related_stocks, ', $') else '无' end as names,
  coalesce(url, link) as u from {}"""


@query(
    "importance_sections",
    f"""
with r as ({_SQL_ROUTED.format('batch2')})
select date, article_id, route,
  case route when 'high' then title when 'medium' then left(title, 40) else left(title, 30) end as title,
  u as url, case when route <> 'low' then names end as entities,
  case route when 'high' then coalesce(core_thesis, '无') when 'medium' then left(coalesce(core_thesis, ''), 60) end as thesis,
  case route when 'high' then coalesce(investment_implications, '无')
    when 'medium' then left(coalesce(investment_implications, ''), 80) end as implications,
  case when route = 'high' then coalesce(action_required, '关注') end as action, {SQL_STAMP}
from r""",
    "batch2",
)
def importance_sections(v: Views):
    return I.importance_sections(v.batch2).select(
        "date", "article_id", "route", "title", "url", "entities", "thesis", "implications",
        "action", stamp(),
    )


@query(
    "key_data_rows",
    """
select event_id, e.key as key, e.value as value from (
  select event_id, unnest(map_entries(cast(cast(props as json) as map(varchar, varchar)))) as e from events)
where coalesce(e.value, '') <> ''""",
)
def key_data_rows(v: Views):
    events = v.table("events")
    return I.key_data_rows(events, F.from_json("props", "map<string,string>"), "event_id")


_SQL_ACTIONS = """acts as (select *, row_number() over (partition by date, action order by crawl_time, article_id) as nth
  from (select date, coalesce(action_required, '关注') as action, left(title, 30) as title, crawl_time, article_id
    from {}) where action not in ('', '无需行动')),
actions as (select date, action, count(*) as titles,
  string_agg(title, '|' order by nth) filter (where nth <= 5) as shown,
  greatest(count(*) - 5, 0) as more from acts group by 1, 2)"""


@query(
    "action_list",
    f"with {_SQL_ACTIONS.format('batch2')} select date, action, titles, shown, more from actions",
    "batch2",
)
def action_list(v: Views):
    return I.action_list(v.batch2).withColumn("shown", F.array_join("shown", "|"))


_SQL_INVESTMENT = f"""
with n as ({_SQL_NUMBERED.format('batch2')}), r as ({_SQL_ROUTED.format('batch2')}),
{_SQL_ACTIONS.format('batch2')},
l as (select date, count(*) as total, string_agg({_SQL_LIST_LINE}, chr(10) order by number) as t
  from n group by 1),
e as (select date, string_agg(entity, ', $' order by entity) as t from (
  select distinct date, unnest(related_stocks) as entity from batch2) group by 1),
kd as (select *, coalesce(json_extract_string(props, '$.k'), '') as kv from r),
hi as (select date, string_agg('### [' || title || '](' || u || ')' || chr(10) || chr(10) || '**关联标的：** ' || names
  || chr(10) || chr(10) || '**核心论点：** ' || coalesce(core_thesis, '无') || chr(10) || chr(10)
  || '**投资启示：** ' || coalesce(investment_implications, '无') || chr(10) || chr(10)
  || '**关键数据：**' || chr(10) || '- k: ' || kv || chr(10) || chr(10)
  || '**建议行动：** ' || coalesce(action_required, '关注') || chr(10) || chr(10) || '---' || chr(10),
  chr(10) order by crawl_time, article_id) as t from kd where route = 'high' group by 1),
me as (select date, string_agg('### [' || left(title, 40) || '](' || u || ')' || chr(10)
  || '- **核心论点：** ' || left(coalesce(core_thesis, ''), 60) || chr(10) || '- **关联标的：** ' || names
  || chr(10) || '- **启示：** ' || left(coalesce(investment_implications, ''), 80) || chr(10),
  chr(10) order by crawl_time, article_id) as t from r where route = 'medium' group by 1),
lo as (select date, string_agg('- [' || left(title, 30) || '](' || u || ')', chr(10)
  order by crawl_time, article_id) as t from r where route = 'low' group by 1),
shown as (select date, action, string_agg('- ' || title, chr(10) order by nth) as t
  from acts where nth <= 5 group by 1, 2),
ac as (select a.date, string_agg('### ' || a.action || chr(10) || x.t
  || case when more > 0 then chr(10) || '- ... 还有 ' || more || ' 条' else '' end || chr(10), chr(10)
  order by a.action) as t
  from actions a join shown x on x.date = a.date and x.action = a.action group by 1)
select l.date, '# 📊 价值投资日报 - ' || l.date || chr(10) || chr(10) || '## 📰 今日新增文章' || chr(10) || chr(10)
  || '共爬取 **' || total || '** 篇新文章。' || chr(10) || chr(10) || '### 文章列表' || chr(10) || chr(10)
  || l.t || chr(10)
  || coalesce(chr(10) || '### 关联股票' || chr(10) || chr(10) || '$**' || e.t || '**' || chr(10), '')
  || coalesce(chr(10) || '## 🔴 高优先级（值得深入研究）' || chr(10) || chr(10) || hi.t, '')
  || coalesce(chr(10) || '## 🟡 中优先级（值得关注）' || chr(10) || chr(10) || me.t, '')
  || coalesce(chr(10) || '## ⚪ 低优先级（信息性内容）' || chr(10) || chr(10) || lo.t || chr(10), '')
  || chr(10) || '## ✅ 行动清单' || chr(10) || coalesce(chr(10) || ac.t, '') || chr(10)
  || '---' || chr(10) || chr(10) || '*报告生成时间：{STAMP}*' || chr(10) || '*分析模型：GLM-5 (qwen-plus)*' as report
from l left join e on e.date = l.date left join hi on hi.date = l.date left join me on me.date = l.date
left join lo on lo.date = l.date left join ac on ac.date = l.date"""


@query("render_investment_report", _sql_pages(_SQL_INVESTMENT), "batch2")
def render_investment_report(v: Views):
    """The text of each day over all of its articles."""
    return I.render_investment_report(I.investment_blocks(v.batch2, STAMP), PAGE)
