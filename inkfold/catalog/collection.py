"""Queries over sources, sinks, extraction, filters and incremental state."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from inkfold.catalog.registry import SQL_STAMP, query, stamp
from inkfold.catalog.views import SQL_ISSUES, TEST, Views, sql_strip
from inkfold.operators import extraction as X
from inkfold.operators import filters as C
from inkfold.operators import incremental as D
from inkfold.operators.quality import merge_quality_logs, quality_gate_report, quality_log
from inkfold.session import run_folder
from inkfold.sources import corpus, sinks, tables

SITE = TEST.site
DAY = dt.date(2024, 1, 2)


def _stored(v: Views):
    """The article view with the columns of the article table."""
    return v.articles.select(
        "user_id", "article_id", "title", "author", "publish_time",
        F.lit(0).alias("likes"), F.lit(0).alias("comments"), F.col("link").alias("url"),
        F.col("content").alias("body"), "crawl_time", "is_column",
    )


# --- sources and sinks ---


@query(
    "scan_article_corpus",
    """
select user_id, article_id, title, coalesce(author, '未知') as author,
  coalesce(publish_time, '未知') as publish_time, 0 as likes, 0 as comments, link as url,
  md5(content) as body_md5, strftime(crawl_time, '%Y-%m-%d %H:%M:%S') as crawl_time,
  true as well_formed from articles""",
    "articles",
)
def scan_article_corpus(v: Views):
    """All articles written as documents, packed, and read back; a second batch repeats some."""
    path = run_folder(v.spark, "documents")
    rows = _stored(v)
    again = F.col("is_column")
    sinks.write_markdown(rows.withColumn("title", F.when(again, "old").otherwise(F.col("title"))), path, 1)
    sinks.write_markdown(rows.filter(again), path, 2)
    return corpus.scan_packed_corpus(v.spark, path).select(
        "user_id", "article_id", "title", "author", "publish_time", "likes", "comments", "url",
        F.md5("body").alias("body_md5"),
        F.date_format("crawl_time", "yyyy-MM-dd HH:mm:ss").alias("crawl_time"), "well_formed",
    )


def _nested_snapshots(v: Views):
    rows = v.snapshots.withColumn("ord", F.struct("crawl_time", "article_id"))
    return D.snapshot_rollup(v.runs, rows, TEST.crawl)


@query(
    "scan_snapshots_explode",
    f"""
select h.user_id, h.date, h.article_count, s.article_id, s.title,
  strftime(s.crawl_time, '%Y-%m-%dT%H:%M:%S') as crawl_time
from snapshot_headers h left join snapshots s on s.user_id = h.user_id and s.date = h.date""",
    "snapshot_headers snapshots",
)
def scan_snapshots_explode(v: Views):
    path = run_folder(v.spark, "snapshots")
    _nested_snapshots(v).write.json(path)
    rows = tables.scan_snapshots_explode(v.spark, path, "*.json", multiline=False)
    return rows.withColumn("crawl_time", F.left("crawl_time", F.lit(19)))


@query(
    "scan_index_map",
    f"""
select article_id, title, author, publish_time, user_id,
  strftime(crawl_time, '%Y-%m-%dT%H:%M:%S') as crawl_time,
  'data/' || user_id || '/' || article_id || '.md' as filepath from article_index""",
    "article_index",
)
def scan_index_map(v: Views):
    """Index documents of some hundred entries each, read back as split at closing braces."""
    index = v.article_index
    entry = F.struct(
        "title", "author", "publish_time", "user_id",
        F.date_format("crawl_time", "yyyy-MM-dd'T'HH:mm:ss").alias("crawl_time"),
        F.concat_ws("/", F.lit("data"), "user_id", F.concat("article_id", F.lit(".md"))).alias("filepath"),
    )
    parts = index.agg(F.ceil(F.count(F.lit(1)) / 500)).scalar()
    path = run_folder(v.spark, "index")
    (
        index.select(F.pmod(F.xxhash64("article_id"), parts).alias("part"), "article_id", entry.alias("e"))
        .groupBy("part")
        .agg(F.map_from_entries(F.collect_list(F.struct("article_id", "e"))).alias("articles"))
        .select("articles", F.lit("2024-01-04").alias("last_update"))
        .write.json(path)
    )
    return tables.scan_index_map(v.spark, path)


SQL_ENABLED = "coalesce(enabled, true) and coalesce(id, '') <> '' and coalesce(url, '') <> ''"


@query(
    "scan_accounts_enabled",
    f"select id, name, url, enabled from accounts where {SQL_ENABLED}",
    "accounts",
)
def scan_accounts_enabled(v: Views):
    path = run_folder(v.spark, "accounts")
    v.accounts.write.json(path)
    return tables.scan_accounts_enabled(v.spark, path).select("id", "name", "url", "enabled")


@query(
    "sink_articles",
    f"""
select user_id, article_id, case when is_column then title else 'v2 ' || title end as title,
  author, publish_time, link as url, md5(content) as body_md5, {SQL_STAMP}
from articles""",
    "articles",
)
def sink_articles(v: Views):
    """Two batches; the second replaces the articles that are not column articles."""
    path = run_folder(v.spark, "articles")
    rows = _stored(v)
    sinks.write_articles(rows, path, 1)
    again = rows.filter(~F.col("is_column")).withColumn("title", F.concat(F.lit("v2 "), "title"))
    sinks.write_articles(again, path, 2)
    corpus.compact_articles(v.spark, path)
    return corpus.scan_articles(v.spark, path).select(
        "user_id", "article_id", "title", "author", "publish_time", "url",
        F.md5("body").alias("body_md5"), stamp(),
    )


@query(
    "upsert_index",
    f"""
select article_id, user_id, title, {SQL_STAMP} from article_index
union all
select article_id, user_id, 'new ' || title, {SQL_STAMP} from articles
where article_id not in (select article_id from article_index)""",
    "articles article_index",
)
def upsert_index(v: Views):
    """Every article arrives twice; those the index has stay as they are."""
    index = v.article_index.select("article_id", "user_id", "title", "crawl_time")
    new = v.articles.select(
        "article_id", "user_id", F.concat(F.lit("new "), "title").alias("title"), "crawl_time"
    )
    return D.upsert_index(index, new.unionByName(new), ["crawl_time"]).select(
        "article_id", "user_id", "title", stamp()
    )


@query(
    "sink_snapshot_overwrite",
    f"""
with replaced as (select * from snapshots where date < (select max(date) from snapshots)
  or article_id in (select article_id from articles where is_column)),
counts as (select user_id, date, count(*) as n from replaced group by 1, 2)
select r.user_id, r.date, coalesce(c.n, 0) as article_count, s.article_id, s.title
from runs r left join counts c on c.user_id = r.user_id and c.date = r.date
left join replaced s on s.user_id = r.user_id and s.date = r.date""",
    "snapshots runs articles",
)
def sink_snapshot_overwrite(v: Views):
    """A second run of the last stored day replaces that day and nothing else."""
    path = run_folder(v.spark, "snapshots")
    sinks.write_snapshots(_nested_snapshots(v), path, 1)
    last = v.runs.agg(F.max("date")).scalar()
    rows = (
        v.state_articles.filter(F.col("is_column") & (F.col("date") == last))
        .withColumn("ord", F.struct("crawl_time", "article_id"))
    )
    rerun = D.snapshot_rollup(v.runs.filter(F.col("date") == last), rows, TEST.crawl)
    sinks.write_snapshots(rerun, path, 2)
    return D.explode_snapshots(tables.scan_snapshots(v.spark, path)).drop("crawl_time")


@query(
    "scan_quality_log",
    f"""
with g as (select *, {SQL_ISSUES} as issue_text, length(title) < 3 or length(content) < 200 as bad from articles),
ranked as (select *, row_number() over (partition by date, labelled order by crawl_time, article_id) as rn
  from g where bad),
firsts as (select *, row_number() over (partition by date order by labelled, rn) as n from ranked where rn <= 10),
texts as (select date, string_agg(article_id || '/' || user_id || '/' || left(title, 50) || '/' || issue_text
  || '/' || length(content), '; ' order by n) as failures from firsts where n <= 10 group by 1),
daily as (select date, count(*) as total_articles, count(*) filter (where not bad) as passed,
  count(*) filter (where bad) as failed from g group by 1)
select d.date, total_articles, passed, failed, coalesce(failures, '') as failures
from daily d left join texts t on t.date = d.date""",
    "articles",
)
def scan_quality_log(v: Views):
    """A log of the articles without a label is reloaded and the labelled ones added to it."""
    gated = quality_gate_report(v.articles, TEST.gate)
    path = run_folder(v.spark, "quality_log")
    sinks.write_quality_log(quality_log(gated.filter(~F.col("labelled")), TEST.gate), path)
    stored = tables.scan_quality_log(v.spark, path, multiline=False).withColumn(
        "date", F.to_date("date")
    )
    merged = merge_quality_logs(stored, quality_log(gated.filter("labelled"), TEST.gate), p=TEST.gate)
    line = F.transform(
        "issues",
        lambda x: F.concat_ws(
            "/", x["article_id"], x["user_id"], x["title"], F.array_join(x["issues"], ", "), x["content_length"]
        ),
    )
    return merged.withColumn("failures", F.array_join(line, "; ")).drop("issues")


# --- page extraction ---

# Attribute by attribute, unlike the expression it checks.
_SQL_VALUE = r"""(?:"[^"]*"|''[^'']*''|[^\s"''>]+)"""
_SQL_HREFS = (
    rf"""list_transform(regexp_extract_all(html, '(?i)<a(?:\s+[a-z_:-]+(?:\s*=\s*{_SQL_VALUE})?)*?"""
    rf"""\s+href\s*=\s*({_SQL_VALUE})', 1), lambda h: replace(trim(h, '"'''), '&amp;', '&'))"""
)
_SQL_LINK = f"""list_filter(list_transform(list_filter({_SQL_HREFS}, lambda h: h <> ''),
  lambda h: case when h like 'http%' then h else '{SITE.base_url}' || h end),
  lambda h: regexp_matches(h, '{SITE.url_pattern}') and not contains(h, '#comment'))[1]"""


@query(
    "extract_article_links",
    f"select * from (select page_id, {_SQL_LINK} as link from pages) where link is not null",
)
def extract_article_links(v: Views):
    return X.extract_article_links(v.pages, SITE).select("page_id", "link")


@query(
    "extract_article_id",
    f"""
select page_id, case when regexp_extract(url, '{SITE.article_id_pattern}', 1) <> ''
  then regexp_extract(url, '{SITE.article_id_pattern}', 1) else left(md5(url), 12) end as article_id
from pages""",
)
def extract_article_id(v: Views):
    return X.extract_article_id(v.pages, SITE).select("page_id", "article_id")


_SQL_TITLE = sql_strip("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")


@query(
    "clean_page_title",
    f"""
with t as (select page_id, {_SQL_TITLE} as t from pages),
c as (select page_id, case when contains(t, ' the ')
  then {sql_strip("rtrim(rtrim(rtrim(" + sql_strip("split_part(t, ' the ', 1)") + ", '-'), '—'), '–')")}
  else t end as c from t)
select page_id, case when length(c) > 100 then left(c, 100) || '...' else c end as title from c""",
)
def clean_page_title(v: Views):
    titled = v.pages.withColumn("title", X.page_title_of())
    return X.clean_page_title(titled, SITE).select("page_id", "title")


@query(
    "title_fallback_first_line",
    f"""
with s as (select article_id, coalesce(author, '') as a,
  split_part({sql_strip('content')}, chr(10), 1) as line from articles)
select article_id, case when a <> '' then a when length(line) > 5 then left(line, 100) else '' end
  as title from s""",
    "articles",
)
def title_fallback_first_line(v: Views):
    """The author stands for a title here: present on some articles, missing on others."""
    rows = v.articles.select("article_id", F.col("author").alias("title"), "content")
    return X.title_fallback_first_line(rows).select("article_id", "title")


@query(
    "extract_page_counters",
    r"""
select page_id, coalesce(try_cast(regexp_extract(html, 'track\((\d+)\)', 1) as integer), 0) as likes,
  coalesce(try_cast(regexp_extract(html, '[?&;]page=(\d+)', 1) as integer), 0) as comments,
  coalesce(try_cast(regexp_extract(url, '(\d+)', 1) as integer), 0) as label_count from pages""",
)
def extract_page_counters(v: Views):
    counted = X.extract_page_counters(
        v.pages, {"likes": SITE.likes_pattern, "comments": SITE.comments_pattern}
    )
    return X.extract_label_count(counted, "url", "label_count").select(
        "page_id", "likes", "comments", "label_count"
    )


def _sql_element(tag: str) -> str:
    inner = f"regexp_extract(html, '(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>', 1)"
    text = sql_strip(f"regexp_replace({inner}, '<[^>]*>', '', 'g')")
    return f"case when regexp_matches(html, '(?i)<{tag}\\b') then {text} end"


def _sql_body(main: str, fallbacks: tuple[str, ...]) -> str:
    whens = " ".join(f"when length({_sql_element(t)}) > 20 then {_sql_element(t)}" for t in fallbacks)
    return f"""
with e as (select page_id, html, {_SQL_TITLE} as title, {_sql_element(main)} as main from pages)
select page_id, case when main is not null then main {whens} else title end as content,
  main is not null as is_column from e"""


@query("extract_page_body", _sql_body("article", ("main", "p")))
def extract_page_body(v: Views):
    titled = v.pages.withColumn("title", X.page_title_of())
    return X.extract_page_body(titled, "article", ["main", "p"], "title").select(
        "page_id", "content", "is_column"
    )


@query("extract_page_body_fallback", _sql_body("main", ("footer", "h1", "p")))
def extract_page_body_fallback(v: Views):
    """No page has the main element, so short footers, headings and paragraphs compete."""
    titled = v.pages.withColumn("title", X.page_title_of())
    return X.extract_page_body(titled, "main", ["footer", "h1", "p"], "title").select(
        "page_id", "content", "is_column"
    )


# The parser's rules for the tags and character references these pages hold: breaks at
# block tags, none elsewhere, runs of breaks joined.
_SQL_NESTED = """
with a as (select page_id, url, html, regexp_extract(html, '(?is)<article\\b[^>]*>(.*?)</article\\s*>', 1) as t
  from pages),
b as (select *, regexp_replace(regexp_replace(t, '(?i)</?(p|h1|br)\\b[^>]*>', chr(10), 'g'),
  '<[^>]*>', '', 'g') as u from a),
c as (select *, {strip} as body from (select *, regexp_replace(regexp_replace(replace(u, '&quot;', '"'),
  '&amp;?', '&', 'g'), '\\n{{2,}}', chr(10), 'g') as w from b))""".format(strip=sql_strip("w"))


@query(
    "extract_page_body_nested",
    f"""{_SQL_NESTED}
select page_id, case when length(body) > 20 then body else {_SQL_TITLE} end as content,
  false as is_column from c""",
)
def extract_page_body_nested(v: Views):
    """The parser path with the site's class selectors; pages have only the last one."""
    titled = v.pages.withColumn("title", X.page_title_of())
    return X.extract_page_body_nested(titled, SITE, "title").select(
        "page_id", "content", "is_column"
    )


@query(
    "page_details",
    f"""{_SQL_NESTED},
d as (select *, {_SQL_TITLE} as t0 from c),
e as (select *, case when contains(t0, ' the ')
  then {sql_strip("rtrim(rtrim(rtrim(" + sql_strip("split_part(t0, ' the ', 1)") + ", '-'), '—'), '–')")}
  else t0 end as c0 from d where not contains(t0, '***') and not contains(html, 'spam-'))
select url, case when length(c0) > 100 then left(c0, 100) || '...' else c0 end as title, '' as author,
  '' as publish_time,
  md5(case when length(body) > 20 then body when length(c0) > 100 then left(c0, 100) || '...' else c0 end)
    as content_md5,
  coalesce(try_cast(regexp_extract(html, 'track\\((\\d+)\\)', 1) as integer), 0) as likes,
  coalesce(try_cast(regexp_extract(html, '[?&;]page=(\\d+)', 1) as integer), 0) as comments,
  false as is_column from e""",
)
def page_details(v: Views):
    """The whole detail row of every stored page."""
    return X.page_details(v.pages, SITE).select(
        "url", "title", "author", "publish_time", F.md5("content").alias("content_md5"),
        "likes", "comments", "is_column",
    )


LIST_SITE = replace(
    SITE, item_selector="nav li", item_title_selector="a", item_content_selector="li a",
    item_time_selector=".none", item_likes_selector="li",
)


@query(
    "parse_list_items",
    """
with n as (select page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1) as items from pages),
i as (select page_id, unnest(items) as item, generate_subscripts(items, 1) - 1 as pos from n),
t as (select *, 'https://site.example' || regexp_extract(item, 'href="([^"]*)"', 1) as link,
  replace(replace(regexp_extract(item, '>(.*?)</a>', 1), '&amp;', '&'), '&quot;', '"') as title from i)
select cast(page_id as varchar) as user_id, left(md5(link), 12) as article_id, title, title as content,
  '' as publish_time, link, coalesce(try_cast(regexp_extract(title, '(\\d+)', 1) as integer), 0) as likes,
  0 as comments, pos from t where regexp_matches(link, '^https://site\\.example/[a-z]+$')""",
)
def parse_list_items(v: Views):
    """The menu entries of a page stand for a timeline."""
    pages = v.pages.select(F.col("page_id").cast("string").alias("user_id"), "html")
    return X.parse_list_items(pages, LIST_SITE)


@query(
    "derive_user_name",
    f"""
with p as (select page_id, {sql_strip("regexp_extract(url, 'ref=([a-z]+)', 1)")} as name,
  {_SQL_TITLE} as t from pages)
select page_id, case when name <> '' then name
  when contains(t, ' and ') and {sql_strip("split_part(t, ' and ', 1)")} <> ''
    then {sql_strip("split_part(t, ' and ', 1)")}
  else cast(page_id as varchar) end as user_name from p""",
)
def derive_user_name(v: Views):
    rows = v.pages.select(
        "page_id",
        F.regexp_extract("url", "ref=([a-z]+)", 1).alias("name"),
        X.page_title_of().alias("title"),
        F.col("page_id").cast("string").alias("id"),
    )
    return X.derive_user_name(rows, SITE, "name", "title", "id").select("page_id", "user_name")


@query(
    "flag_blocked_pages",
    f"""
select page_id, contains({_SQL_TITLE}, '***') or contains(html, 'spam-') as blocked from pages""",
)
def flag_blocked_pages(v: Views):
    titled = v.pages.withColumn("title", X.page_title_of())
    return X.flag_blocked_pages(titled, SITE).select("page_id", "blocked")


@query(
    "merge_list_detail",
    """
select i.user_id, i.article_id, i.link, case when d.url is not null then d.title else i.title end as title,
  case when d.url is not null then d.publish_time else i.publish_time end as publish_time,
  md5(case when d.url is not null then d.content else i.content end) as content_md5,
  case when d.url is not null then d.likes else i.likes end as likes,
  case when d.url is not null then d.comments else i.comments end as comments,
  d.author, d.is_column
from list_items i left join details d on d.url = i.link""",
    "list_items details",
)
def merge_list_detail(v: Views):
    return X.merge_list_detail(v.list_items, v.details).select(
        "user_id", "article_id", "link", "title", "publish_time",
        F.md5("content").alias("content_md5"), "likes", "comments", "author", "is_column",
    )


@query(
    "list_item_heuristic",
    f"""
select article_id from articles where case when length(coalesce(author, '')) > 5 then
  length({sql_strip("coalesce(author, '')")}) > 5 when contains(lang, 'de') then false
  else length(content) > 200 end""",
    "articles",
)
def list_item_heuristic(v: Views):
    rows = v.articles.select(
        "article_id", F.col("author").alias("title"), F.col("lang").alias("source"), "content"
    )
    return X.list_item_heuristic(rows, SITE).select("article_id")


# --- filters ---


@query(
    "filter_column_articles",
    "select article_id, title from articles where coalesce(is_column, false) and title not like 'The%'",
    "articles",
)
def filter_column_articles(v: Views):
    return C.filter_column_articles(v.articles, SITE).select("article_id", "title")


@query("filter_user", "select id, name, url from accounts where id = 'src3'", "accounts")
def filter_user(v: Views):
    return C.filter_user(v.accounts, "src3").select("id", "name", "url")


@query(
    "filter_crawl_date",
    f"select article_id, {SQL_STAMP} from articles where cast(crawl_time as date) = date '{DAY}'",
    "articles",
)
def filter_crawl_date(v: Views):
    return C.filter_crawl_date(v.articles, DAY).select("article_id", stamp())


# --- incremental state ---

_SQL_RECENT = f"""
select distinct s.user_id, s.article_id from snapshots s join (
  select user_id, date, dense_rank() over (partition by user_id order by date desc) as r
  from snapshot_headers) h on h.user_id = s.user_id and h.date = s.date
where h.r <= {TEST.crawl.snapshot_files}"""

_SQL_NEW = f"""recent as ({_SQL_RECENT}),
fresh as (select i.* from list_items i where article_id <> '' and not exists (
  select 1 from recent r where r.user_id = i.user_id and r.article_id = i.article_id))"""


@query("recent_snapshot_ids", _SQL_RECENT, "snapshots snapshot_headers")
def recent_snapshot_ids(v: Views):
    return D.recent_snapshot_ids(v.nested_snapshots, TEST.crawl.snapshot_files)


@query(
    "new_articles_antijoin",
    f"with {_SQL_NEW} select user_id, article_id, pos from fresh",
    "list_items snapshots snapshot_headers",
)
def new_articles_antijoin(v: Views):
    known = D.recent_snapshot_ids(v.nested_snapshots, TEST.crawl.snapshot_files)
    return D.new_articles_antijoin(v.list_items, known).select("user_id", "article_id", "pos")


_SQL_CAP = f"""capped as (select * from (select *, row_number() over (partition by user_id order by pos) as rn
  from fresh) where rn <= {TEST.crawl.articles_per_user})"""


@query(
    "crawl_cap_per_user",
    f"with {_SQL_NEW}, {_SQL_CAP} select user_id, article_id, pos from capped",
    "list_items snapshots snapshot_headers",
)
def crawl_cap_per_user(v: Views):
    known = D.recent_snapshot_ids(v.nested_snapshots, TEST.crawl.snapshot_files)
    new = D.new_articles_antijoin(v.list_items, known)
    return D.crawl_cap_per_user(new, TEST.crawl.articles_per_user).select(
        "user_id", "article_id", "pos"
    )


@query(
    "index_dedup",
    """
select article_id, min(pos) as pos from list_items
where article_id not in (select article_id from article_index) group by 1""",
    "list_items article_index",
)
def index_dedup(v: Views):
    """Every item is listed three times in one batch."""
    items = v.list_items.select("article_id", "pos")
    twice = items.withColumn("pos", F.col("pos") + 100)
    batch = D.concat_user_batches(twice, items, twice)
    return D.index_dedup(batch, v.article_index, ["pos"])


_SQL_KEPT = f"""{_SQL_NEW}, {_SQL_CAP},
merged as (select c.user_id, c.article_id, c.pos, c.account_order, d.title, d.author, d.publish_time,
    d.content, d.url, d.crawl_time from capped c join details d on d.url = c.link
  where d.is_column and coalesce(d.title, '') not like 'The%'
    and c.article_id not in (select article_id from article_index)),
kept as (select * from (select *, row_number() over (partition by article_id
  order by account_order, pos) as copy from merged) where copy = 1)"""
_COLLECT_VIEWS = "list_items snapshots snapshot_headers details article_index"


def _run(v: Views) -> D.Collected:
    return D.incremental_run(
        v.list_items, v.details, v.nested_snapshots, v.article_index, SITE, TEST.crawl
    )


@query(
    "incremental_batch",
    f"""
with {_SQL_KEPT}
select user_id, article_id, pos, title, author, publish_time, md5(content) as content_md5, url, {SQL_STAMP},
  'data/' || user_id || '/' || article_id || '.md' as filepath from kept""",
    _COLLECT_VIEWS,
)
def incremental_batch(v: Views):
    return _run(v).batch.select(
        "user_id", "article_id", "pos", "title", "author", "publish_time",
        F.md5("content").alias("content_md5"), "url", stamp(), "filepath",
    )


@query(
    "incremental_counts",
    f"""
with {_SQL_KEPT},
l as (select user_id, count(*) as listed from list_items group by 1),
n as (select user_id, count(*) as new from fresh group by 1),
c as (select user_id, count(*) as capped from capped group by 1),
k as (select user_id, count(*) as kept from kept group by 1)
select l.user_id, listed, coalesce(new, 0) as new, coalesce(capped, 0) as capped, coalesce(kept, 0) as kept
from l left join n on n.user_id = l.user_id left join c on c.user_id = l.user_id
left join k on k.user_id = l.user_id""",
    _COLLECT_VIEWS,
)
def incremental_counts(v: Views):
    return _run(v).counts


@query(
    "snapshot_rollup",
    f"""
select r.user_id, r.date, h.article_count, s.article_id, s.title, strftime(s.crawl_time, '%Y-%m-%d %H:%M:%S.%f') as crawl_time
from runs r join snapshot_headers h on h.user_id = r.user_id and h.date = r.date
left join snapshots s on s.user_id = r.user_id and s.date = r.date""",
    "runs snapshot_headers snapshots",
)
def snapshot_rollup(v: Views):
    return D.explode_snapshots(_nested_snapshots(v)).select(
        "user_id", "date", "article_count", "article_id", "title", stamp()
    )


@query(
    "account_name_merge",
    """
with n as (select user_id, min(title) as user_name from articles where title <> '' group by 1)
select a.id, case when (a.name = 'Supplier#000000004' or a.name = a.id or a.name is null) is true
    and (n.user_name is not null and n.user_name <> a.id and a.name is not null)
  then n.user_name else a.name end as name, a.url, a.enabled
from (select id, case when enabled then id else name end as name, url, enabled from accounts) a
left join n on n.user_id = a.id""",
    "accounts articles",
)
def account_name_merge(v: Views):
    """Accounts flagged as enabled are named by their id; a title stands for the found name."""
    accounts = v.accounts.withColumn("name", F.when(F.col("enabled"), F.col("id")).otherwise(F.col("name")))
    names = (
        v.articles.filter(F.col("title") != "").groupBy("user_id").agg(F.min("title").alias("user_name"))
    )
    return D.account_name_merge(accounts, names, SITE).select("id", "name", "url", "enabled")


@query(
    "today_articles_join",
    f"""
select i.article_id, i.user_id, i.title, length(a.content) as content_length
from article_index i join articles a on a.article_id = i.article_id
where cast(i.crawl_time as date) = date '{DAY}'""",
    "article_index articles",
)
def today_articles_join(v: Views):
    """The documents are stored by day, those of other days are pruned."""
    path = run_folder(v.spark, "articles")
    sinks.write_articles(_stored(v), path, 1)
    documents = corpus.scan_articles(v.spark, path).withColumnRenamed("body", "content")
    today = C.filter_crawl_date(v.article_index, DAY)
    return D.today_articles_join(today, documents).select(
        "article_id", "user_id", "title", F.length("content").cast("bigint").alias("content_length")
    )


@query(
    "report_limit",
    f"""
select date, article_id, batch_no, {SQL_STAMP} from (select *, row_number() over (partition by date
  order by crawl_time, article_id) as batch_no from articles) where batch_no <= 20""",
    "articles",
)
def report_limit(v: Views):
    return D.report_limit(v.articles, 20).select("date", "article_id", "batch_no", stamp())


@query(
    "analysis_join",
    """
select a.article_id, a.title, b.priority, b.category, b.quality_passed
from articles a join (select article_id, priority, quality_passed,
  case when quality_passed then category end as category from batch) b on b.article_id = a.article_id""",
    "articles batch",
)
def analysis_join(v: Views):
    results = v.batch.select("article_id", "priority", "quality_passed", "analysis")
    return D.analysis_join(v.articles.select("article_id", "title"), results).select(
        "article_id", "title", "priority", F.col("analysis.category").alias("category"), "quality_passed"
    )


@query(
    "concat_user_batches",
    """
select user_id, article_id, link from list_items
union all select user_id, article_id, link from articles where is_column""",
    "list_items articles",
)
def concat_user_batches(v: Views):
    keys = ["user_id", "article_id", "link"]
    return D.concat_user_batches(
        v.list_items.select(*keys), v.articles.filter("is_column").select(*keys)
    )
