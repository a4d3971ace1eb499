"""Input views over the test tables, in Spark and as DuckDB text.

Both sides derive the same articles, state tables and results from the given Parquet
files, so that a registered query and its SQL read the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.functions import rules as R
from inkfold.functions.text import strip
from inkfold.params import (
    CategoryParams,
    CrawlParams,
    EntityParams,
    Params,
    PriorityParams,
    SiteParams,
)
from inkfold.session import configure
from inkfold.sources.tables import spread

BASE = "https://site.example"
# Starts at a boundary both regular expression dialects see alike.
ENTITY = r"(?:^|[^A-Za-z])([A-Z][a-z]{4,})"

TEST = Params(
    site=SiteParams(
        base_url=BASE,
        article_url_pattern=r"^https://site\.example/[a-z]+$",
        article_id_pattern=r"/[a-z]{2}/([0-9]+)$",
        title_marker=" the ",
        name_suffix=" and ",
        reply_prefix="The",
        repost_marker="de",
        blocked_title_marker="***",
        blocked_page_marker="spam-",
        likes_pattern=r"track\((\d+)\)",
        comments_pattern=r"[?&;]page=(\d+)",
        placeholder_name="Supplier#000000004",
    ),
    crawl=CrawlParams(snapshot_files=1),
    priority=PriorityParams(keywords=("ention", "für")),
    category=CategoryParams(
        rules=(
            ("company", ("whe",)),
            ("industry", ("eaux", "sch")),
            ("philosophy", ("por",)),
        ),
        other="other",
    ),
    entity=EntityParams(pattern=ENTITY),
)

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "supplier": "s_suppkey bigint, s_name string",
}

# Tables with long texts, and the key that spreads them.
SPREAD_BY = {"documents": "doc_id", "pages": "page_id"}


class Views:
    """The views over one test folder; each is built when first asked for."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark = configure(spark)
        self.sf = sf

    def table(self, name: str) -> DataFrame:
        rows = self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf}/{name}.parquet")
        return spread(rows, SPREAD_BY[name]) if name in SPREAD_BY else rows

    @cached_property
    def pages(self) -> DataFrame:
        return self.table("pages")

    @cached_property
    def articles(self) -> DataFrame:
        d, e, lab = self.table("documents"), self.table("events"), self.table("labels")
        stripped = strip(F.col("text"))
        line = F.substring_index(stripped, "\n", 1)
        good = F.coalesce(F.col("quality"), F.lit(1)) == 1
        event = e.select(F.col("event_id").alias("doc_id"), "ts", "event_type", "props")
        label = lab.select("doc_id", "quality", "toxic", F.lit(True).alias("labelled"))
        return (
            d.join(event, "doc_id")
            .join(label, "doc_id", "left")
            .select(
                F.col("doc_id").cast("string").alias("article_id"),
                "doc_id",
                F.col("source").alias("user_id"),
                F.when(F.length(line) > 5, F.left(line, F.lit(100))).otherwise("").alias("title"),
                F.when(
                    F.col("labelled"), F.concat(F.lit("author"), (F.col("doc_id") % 17).cast("string"))
                ).alias("author"),
                F.when(good, F.date_format("ts", "yyyy-MM-dd HH:mm")).alias("publish_time"),
                F.col("text").alias("content"),
                "lang",
                good.alias("is_column"),
                "toxic",
                F.col("ts").cast("timestamp").alias("crawl_time"),
                F.to_date("ts").alias("date"),
                F.concat(F.lit(BASE + "/"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias(
                    "link"
                ),
                "event_type",
                "props",
                F.coalesce("labelled", F.lit(False)).alias("labelled"),
            )
        )

    @cached_property
    def state_articles(self) -> DataFrame:
        """Articles stored before the last day."""
        a = self.articles
        last = a.agg(F.max("date")).scalar()
        return a.filter((F.col("doc_id") % 3 != 0) & (F.col("date") < last))

    @cached_property
    def snapshots(self) -> DataFrame:
        return self.state_articles.select(
            "user_id", "date", "article_id", F.left("title", F.lit(50)).alias("title"), "crawl_time"
        )

    @cached_property
    def runs(self) -> DataFrame:
        """One row per user and stored day. The days of a corpus are few; one value holds them."""
        a = self.articles
        days = a.agg(F.array_sort(F.collect_set("date")).alias("days")).scalar()
        stored = F.slice(days, 1, F.size(days) - 1)
        return (
            a.select("user_id").distinct().select("user_id", F.explode(stored).alias("date"))
        )

    @cached_property
    def snapshot_headers(self) -> DataFrame:
        counts = self.snapshots.groupBy("user_id", "date").agg(
            F.count(F.lit(1)).alias("article_count")
        )
        return self.runs.join(counts, ["user_id", "date"], "left").select(
            "user_id", "date", F.coalesce("article_count", F.lit(0).cast("bigint")).alias("article_count")
        )

    @cached_property
    def nested_snapshots(self) -> DataFrame:
        """Stored snapshots as nested records: one per entry, and an empty one per run."""
        entry = F.struct("article_id", "title", "crawl_time")
        records = self.snapshots.select("user_id", "date", F.array(entry).alias("articles"))
        none = F.array().cast(records.schema["articles"].dataType)
        return records.unionByName(self.runs.select("user_id", "date", none.alias("articles")))

    @cached_property
    def list_items(self) -> DataFrame:
        """Newest first: a position in the whole listing orders each user's part too."""
        a = self.articles
        newest = a.agg(F.max("doc_id")).scalar()
        return a.select(
            "user_id",
            "article_id",
            "title",
            "content",
            F.lit("").alias("publish_time"),
            "link",
            F.lit(7).alias("likes"),
            F.lit(3).alias("comments"),
            (newest - F.col("doc_id") + 1).alias("pos"),
            F.substring("user_id", 4, 10).cast("bigint").alias("account_order"),
            "crawl_time",
        )

    @cached_property
    def details(self) -> DataFrame:
        """Detail pages of the labelled articles; some have an empty title."""
        a = self.articles.filter("labelled")
        return a.select(
            F.col("link").alias("url"),
            F.when(F.col("toxic") == 1, "").otherwise(F.col("title")).alias("title"),
            "author",
            "publish_time",
            "content",
            F.lit(0).alias("likes"),
            F.lit(0).alias("comments"),
            "is_column",
            "crawl_time",
        )

    @cached_property
    def article_index(self) -> DataFrame:
        return self.articles.filter(F.col("doc_id") % 5 == 0).select(
            "article_id", "user_id", "title", "author", "publish_time", "crawl_time"
        )

    @cached_property
    def accounts(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            F.concat(F.lit("src"), key.cast("string")).alias("id"),
            F.col("s_name").alias("name"),
            F.when(key % 11 != 0, F.concat(F.lit(BASE + "/u/"), key.cast("string"))).alias("url"),
            F.when(key % 7 == 0, False).when(key % 3 != 0, True).alias("enabled"),
        )

    @cached_property
    def batch(self) -> DataFrame:
        return self.batch_of(self.articles)

    @cached_property
    def batch2(self) -> DataFrame:
        return self.batch2_of(self.articles)

    @staticmethod
    def batch_of(a: DataFrame) -> DataFrame:
        """Report rows: gate and priority by rule, the analysis built from the text."""
        title, content = F.col("title"), F.col("content")
        issues = R.report_gate_issues(title, content, TEST.gate)
        points = F.split(content, "\n")
        analysis = F.struct(
            R.category(content, TEST.category).alias("category"),
            R.entity_mentions(content, TEST.entity).alias("related_stocks"),
            points.alias("core_points"),
            F.struct(
                F.col("lang").alias("alignment"),
                F.col("author").alias("margin_of_safety"),
                F.col("publish_time").alias("analysis"),
            ).alias("value_investment"),
            F.slice(points, 2, 2).alias("insights"),
            F.left(title, F.lit(30)).alias("summary"),
        )
        passed = F.size("issues") == 0
        return (
            a.withColumn("issues", issues)
            .select(
                "date",
                "article_id",
                "user_id",
                "title",
                "author",
                "crawl_time",
                F.length(content).cast("bigint").alias("word_count"),
                passed.alias("quality_passed"),
                "issues",
                F.when(passed, R.priority(title, content, TEST.priority))
                .otherwise("reference")
                .alias("priority"),
                F.when(passed, analysis).alias("analysis"),
            )
        )

    @staticmethod
    def batch2_of(a: DataFrame) -> DataFrame:
        """Investment report rows; importance and action follow the event type."""
        kind = F.col("event_type")
        content = F.col("content")
        analysis = F.struct(
            F.when(kind == "view", "high").when(kind == "click", "medium").when(kind == "error", "none")
            .when(kind == "purchase", "low").alias("importance"),
            F.col("lang").alias("content_type"),
            R.entities(content, TEST.entity).alias("related_stocks"),
            F.array("lang").alias("related_industries"),
            F.when(F.col("labelled"), F.substring_index(content, "\n", 1)).alias("core_thesis"),
            F.from_json("props", "map<string,string>").alias("key_data"),
            F.when(F.col("is_column"), F.substring_index(content, "\n", -1)).alias(
                "investment_implications"
            ),
            F.when(kind == "signup", "").when(kind == "error", "无需行动").when(kind != "purchase", kind)
            .alias("action_required"),
            F.lit("low").alias("confidence"),
        )
        return a.select(
            "date",
            "article_id",
            "title",
            F.when(F.col("labelled"), F.col("link")).alias("url"),
            F.concat(F.col("link"), F.lit("#list")).alias("link"),
            "crawl_time",
            "props",
            analysis.alias("analysis"),
        )

    @cached_property
    def responses(self) -> DataFrame:
        """Stored model responses: fenced, bare, broken and missing texts by event."""
        body = F.concat(
            F.lit('{"category":"'), "event_type", F.lit('","summary":"s'),
            F.get_json_object("props", "$.k"), F.lit('","related_stocks":["'), "event_type",
            F.lit('"],"importance":"high","core_thesis":"t","key_data":'), "props", F.lit("}"),
        )
        way = F.col("event_id") % 4
        return self.table("events").select(
            F.col("event_id").cast("string").alias("article_id"),
            F.when(way == 0, F.concat(F.lit("Here:\n```json\n"), body, F.lit("\n```\nDone {x}")))
            .when(way == 1, F.concat(F.lit("Answer: "), body, F.lit(" end")))
            .when(way == 2, F.concat(F.lit('{"category": '), "event_type", F.lit(" unfinished")))
            .alias("response"),
            F.when(F.col("event_type") == "error", "timeout").alias("error"),
        )


WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196) || chr(8197) || chr(8198) || chr(8199) || chr(8200) || chr(8201) || chr(8202) || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288)"


def sql_strip(x: str) -> str:
    return f"trim({x}, {WS})"


def sql_hit(text: str, words: tuple[str, ...]) -> str:
    return "(" + " or ".join(f"contains({text}, '{w}')" for w in words) + ")"


def sql_priority(title: str, content: str) -> str:
    hit = sql_hit(f"{title} || {content}", TEST.priority.keywords)
    return (
        f"case when length({content}) > 3000 then 'must_read' "
        f"when length({content}) > 1000 then 'worth_reading' "
        f"when length({content}) > 500 and {hit} then 'worth_reading' else 'reference' end"
    )


def sql_category(content: str) -> str:
    whens = " ".join(f"when {sql_hit(content, words)} then '{name}'" for name, words in TEST.category.rules)
    return f"case {whens} else '{TEST.category.other}' end"


def sql_entities(text: str) -> str:
    return f"regexp_extract_all({text}, '{ENTITY}', 1)"


def sql_first_seen(xs: str, at_most: int | None = 5) -> str:
    """Distinct list elements in order of first appearance."""
    kept = f"list_filter({xs}, lambda x, i: list_position({xs}, x) = i)"
    return kept if at_most is None else f"{kept}[1:{at_most}]"


SQL_ISSUES = (
    "case when length(title) < 3 then '标题过短' else '' end"
    " || case when length(title) < 3 and length(content) < 200 then ', ' else '' end"
    " || case when length(content) < 200 then '内容过短(' || length(content) || '字)' else '' end"
)

VIEW_SQL = {
    "articles": f"""
select cast(d.doc_id as varchar) as article_id, d.doc_id, d.source as user_id,
  case when length(split_part({sql_strip('d.text')}, chr(10), 1)) > 5
       then left(split_part({sql_strip('d.text')}, chr(10), 1), 100) else '' end as title,
  case when l.doc_id is not null then 'author' || cast(d.doc_id % 17 as varchar) end as author,
  case when coalesce(l.quality, 1) = 1 then strftime(e.ts, '%Y-%m-%d %H:%M') end as publish_time,
  d.text as content, d.lang, coalesce(l.quality, 1) = 1 as is_column, l.toxic,
  e.ts as crawl_time, cast(e.ts as date) as date,
  '{BASE}/' || d.source || '/' || cast(d.doc_id as varchar) as link, e.event_type, e.props,
  l.doc_id is not null as labelled
from documents d join events e on e.event_id = d.doc_id left join labels l on l.doc_id = d.doc_id""",
    "state_articles": """
select * from articles where doc_id % 3 <> 0 and date < (select max(date) from articles)""",
    "snapshots": """
select user_id, date, article_id, left(title, 50) as title, crawl_time from state_articles""",
    "runs": """
select u.user_id, x.date from (select distinct user_id from articles) u,
  (select distinct date from articles where date < (select max(date) from articles)) x""",
    "snapshot_headers": """
select r.user_id, r.date, count(s.article_id) as article_count
from runs r left join snapshots s on s.user_id = r.user_id and s.date = r.date group by 1, 2""",
    "list_items": """
select user_id, article_id, title, content, '' as publish_time, link, 7 as likes, 3 as comments,
  (select max(doc_id) from articles) - doc_id + 1 as pos,
  cast(substring(user_id, 4, 10) as bigint) as account_order, crawl_time from articles""",
    "details": """
select link as url, case when toxic = 1 then '' else title end as title, author, publish_time,
  content, 0 as likes, 0 as comments, is_column, crawl_time from articles where labelled""",
    "article_index": """
select article_id, user_id, title, author, publish_time, crawl_time from articles
where doc_id % 5 = 0""",
    "accounts": f"""
select 'src' || cast(s_suppkey as varchar) as id, s_name as name,
  case when s_suppkey % 11 = 0 then null else '{BASE}/u/' || cast(s_suppkey as varchar) end as url,
  case when s_suppkey % 7 = 0 then false when s_suppkey % 3 = 0 then null else true end as enabled
from supplier""",
    "batch": f"""
select date, article_id, user_id, title, author, crawl_time, length(content) as word_count,
  length(title) >= 3 and length(content) >= 200 as quality_passed, {SQL_ISSUES} as issues,
  case when length(title) >= 3 and length(content) >= 200 then {sql_priority('title', 'content')}
       else 'reference' end as priority,
  {sql_category('content')} as category, {sql_entities('content')} as related_stocks,
  string_split(content, chr(10)) as core_points, lang as alignment, author as margin_of_safety,
  publish_time as analysis_text, string_split(content, chr(10))[2:3] as insights,
  left(title, 30) as summary from articles""",
    "batch2": f"""
select date, article_id, title, case when labelled then link end as url, link || '#list' as link,
  crawl_time, props,
  case event_type when 'view' then 'high' when 'click' then 'medium' when 'error' then 'none'
    when 'purchase' then 'low' end as importance,
  {sql_first_seen(sql_entities('content'))} as related_stocks,
  case when labelled then split_part(content, chr(10), 1) end as core_thesis,
  case when is_column then split_part(content, chr(10), -1) end as investment_implications,
  case when event_type = 'signup' then '' when event_type = 'error' then '无需行动'
    when event_type <> 'purchase' then event_type end as action_required from articles""",
    "responses": """
select cast(event_id as varchar) as article_id, event_id % 4 as way, event_type, props,
  json_extract_string(props, '$.k') as k,
  case when event_type = 'error' then 'timeout' end as error,
  case event_id % 4
    when 0 then 'Here:' || chr(10) || '```json' || chr(10) || body || chr(10) || '```' || chr(10) || 'Done {x}'
    when 1 then 'Answer: ' || body || ' end'
    when 2 then '{"category": ' || event_type || ' unfinished' end as response
from (select *, '{"category":"' || event_type || '","summary":"s' || json_extract_string(props, '$.k')
  || '","related_stocks":["' || event_type
  || '"],"importance":"high","core_thesis":"t","key_data":' || props || '}' as body from events)""",
}

_NEEDS = {
    "state_articles": ["articles"],
    "snapshots": ["state_articles"],
    "runs": ["articles"],
    "snapshot_headers": ["runs", "snapshots"],
    "list_items": ["articles"],
    "details": ["articles"],
    "article_index": ["articles"],
    "batch": ["articles"],
    "batch2": ["articles"],
}


def with_views(names: str, body: str) -> str:
    """``body`` behind the common table expressions it needs (names space-separated)."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    ctes = ",\n".join(f"{n} as ({VIEW_SQL[n]})" for n in ordered)
    body = body.strip()
    if body.startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
