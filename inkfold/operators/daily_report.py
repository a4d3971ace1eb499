"""Tables and text of the daily report, for any number of days at once.

A *batch* has one row per analysed article: ``date, article_id, user_id, title, author,
crawl_time, word_count, quality_passed, issues, priority, analysis``. Articles are in
(crawl_time, article_id) order. Nothing here assumes that a day is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.functions.lines import (
    PAGE_CHARS,
    article_place,
    block_rows,
    in_order,
    keyed,
    line_rows,
    lines_if,
    lines_of,
    pages,
    pieces,
    place,
)
from inkfold.functions.ranking import first_k, number_rows
from inkfold.functions.text import cut, fill, text
from inkfold.params import DailyReportParams, SiteParams
from inkfold.session import materialize

ORDER = ["crawl_time", "article_id"]
PRIORITIES = ("must_read", "worth_reading", "reference")


def report_overview(batch: DataFrame) -> DataFrame:
    total, passed = F.count(F.lit(1)), F.count_if("quality_passed")
    return batch.groupBy("date").agg(
        total.alias("total"), passed.alias("passed"), (total - passed).alias("failed")
    )


def priority_counts(batch: DataFrame) -> DataFrame:
    """One column per priority, zero where a day has none."""
    return batch.groupBy("date").agg(
        *[F.count_if(F.col("priority") == p).alias(p) for p in PRIORITIES]
    )


def article_sections(batch: DataFrame) -> DataFrame:
    """Articles numbered from 1 inside each (date, priority) section, as ``number``."""
    keys = batch.select("date", "priority", *ORDER)
    numbers = number_rows(keys, ["date", "priority"], ORDER, "number")
    return batch.join(numbers.select("article_id", "number"), "article_id")


def entity_rows(batch: DataFrame) -> DataFrame:
    """One narrow row per mention of an entity, in article and list order.

    The outer form with a filter behind it: the inner one makes the optimizer test the
    list for emptiness further down, which evaluates an extracted list several times.
    """
    return batch.select(
        "date",
        F.struct(*ORDER).alias("ord"),
        "user_id",
        "article_id",
        text("title").alias("title"),
        F.posexplode_outer("analysis.related_stocks").alias("place", "entity"),
    ).filter(F.col("entity").isNotNull())


def article_url(site: SiteParams, p: DailyReportParams) -> Column:
    return fill(
        p.article_url,
        base=F.lit(site.base_url),
        user_id=text("user_id"),
        article_id=text("article_id"),
    )


def stock_mentions(
    batch: DataFrame,
    site: SiteParams = SiteParams(),
    p: DailyReportParams = DailyReportParams(),
) -> DataFrame:
    """Per day and entity: mentions, the first mention, and links to the first articles.

    Counting combines map-side and the links come from a per-entity limit that applies
    before the shuffle, so an entity most articles mention costs no more than others.
    Both are partitioned by day and entity already when they meet.
    """
    mentions = entity_rows(batch)
    counts = mentions.groupBy("date", "entity").agg(F.count(F.lit(1)).alias("mentions"))
    link = F.concat(
        F.lit("["), cut(F.col("title"), p.link_title_chars), F.lit("]("), article_url(site, p), F.lit(")")
    )
    shown = first_k(mentions, ["date", "entity"], ["ord", "place"], p.links_per_entity, "nth")
    links = (
        shown.groupBy("date", "entity")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("nth", F.struct("ord", "place").alias("at"), link.alias("link")))
            ).alias("_shown")
        )
        .select(
            "date",
            "entity",
            F.array_join(F.transform("_shown", lambda x: x["link"]), ", ").alias("links"),
            F.col("_shown")[0]["at"].alias("first"),
        )
    )
    return counts.join(links, ["date", "entity"])


def hot_stocks(batch: DataFrame, p: DailyReportParams = DailyReportParams()) -> DataFrame:
    """The first entities of each day by first mention, not by count."""
    firsts = (
        entity_rows(batch)
        .groupBy("date", "entity")
        .agg(F.min(F.struct("ord", "place")).alias("first"))
    )
    return first_k(firsts, ["date"], ["first"], p.hot_entities, "place").drop("first")


def topics_distinct(batch: DataFrame) -> DataFrame:
    """Distinct topics of the analysed articles of a day; a missing topic is skipped."""
    return (
        batch.filter(F.col("analysis.category").isNotNull())
        .select("date", F.col("analysis.category").alias("category"))
        .distinct()
    )


FULL_LEAD, BRIEF_LEAD = "#### ", ""  # in front of an article's number


def _detail_lines(p: DailyReportParams, site: SiteParams) -> Column:
    """The lines of one full article entry, from behind its number; absent parts leave no line."""
    a = F.col("analysis")
    vi = a["value_investment"]
    stocks = a["related_stocks"]
    points = F.slice(a["core_points"], 1, p.points_shown)
    head = lines_of(
        F.concat(F.lit(". "), text("title", p.no_title)),
        "",
        F.concat(F.lit("- **作者**："), text("author", p.no_author)),
        F.concat(F.lit("- **链接**："), article_url(site, p)),
        F.concat(F.lit("- **字数**："), F.col("word_count").cast("string"), F.lit(" 字")),
    )
    return F.concat(
        head,
        lines_if(
            F.size(stocks) > 0,
            lines_of(F.concat(F.lit("- **相关股票**："), F.array_join(stocks, ", "))),
        ),
        lines_if(
            a.isNotNull(),
            lines_of(
                "",
                p.analysis_title,
                "",
                F.concat(F.lit("- **主题归类**："), F.coalesce(a["category"], F.lit(p.other))),
            ),
        ),
        lines_if(
            F.size(points) > 0,
            F.concat(
                lines_of("", "**核心观点：**"),
                F.transform(
                    points,
                    lambda x, i: F.concat(F.lit("  "), (i + 1).cast("string"), F.lit(". "), x),
                ),
            ),
        ),
        lines_if(
            vi.isNotNull(),
            F.concat(
                lines_of(
                    "",
                    "**价值投资评估：**",
                    F.concat(
                        F.lit("  - 符合价值投资原则："), F.coalesce(vi["alignment"], F.lit(p.unsure))
                    ),
                    F.concat(
                        F.lit("  - 安全边际："), F.coalesce(vi["margin_of_safety"], F.lit(p.unsure))
                    ),
                ),
                lines_if(
                    vi["analysis"] != "", lines_of(F.concat(F.lit("  - 分析："), vi["analysis"]))
                ),
            ),
        ),
        lines_if(
            F.size(a["insights"]) > 0,
            F.concat(
                lines_of("", "**投资启示：**"),
                F.transform(a["insights"], lambda x: F.concat(F.lit("  - "), x)),
            ),
        ),
        lines_if(a["summary"] != "", lines_of("", F.concat(F.lit("**总结**："), a["summary"]))),
        lines_of("", "---", ""),
    )


def _brief_lines(p: DailyReportParams, site: SiteParams) -> Column:
    """One linked line from behind its number, and the gate's issues where it failed."""
    first = F.concat(
        F.lit(". ["), text("title", p.no_title), F.lit("]("),
        article_url(site, p), F.lit(")（"), text("author", p.no_author), F.lit("）"),
    )
    second = F.when(
        ~F.col("quality_passed"), F.concat(F.lit("   - ⚠️ "), F.array_join("issues", ", "))
    )
    return F.array_compact(F.array(first, second))


def _numbered_lines(articles: DataFrame, lead: str, lines: Column) -> DataFrame:
    """``date, priority, number, article_id, line_no, line`` of the articles' entries.

    The entries are put together where the articles are read, so what they do not show is
    gone before anything moves; only entries that go into the result are numbered.
    """
    shown = articles.select("date", "priority", *ORDER, lines.alias("_lines"))
    numbers = number_rows(
        shown.select("date", "priority", *ORDER), ["date", "priority"], ORDER, "number"
    ).select("article_id", "number")
    line = F.when(
        F.col("line_no") == 0, F.concat(F.lit(lead), F.col("number").cast("string"), F.col("line"))
    ).otherwise(F.col("line"))
    return (
        shown.join(numbers, "article_id")
        .select("date", "priority", "number", "article_id", F.posexplode("_lines").alias("line_no", "line"))
        .withColumn("line", line)
    )


def article_detail_rows(
    batch: DataFrame,
    site: SiteParams = SiteParams(),
    p: DailyReportParams = DailyReportParams(),
) -> DataFrame:
    """Lines of the full entries, for the priorities shown in full."""
    full = batch.filter(F.col("priority").isin("must_read", "worth_reading"))
    return _numbered_lines(full, FULL_LEAD, _detail_lines(p, site))


def article_brief_rows(
    batch: DataFrame,
    site: SiteParams = SiteParams(),
    p: DailyReportParams = DailyReportParams(),
) -> DataFrame:
    """Lines of the short entries."""
    brief = batch.filter(F.col("priority") == "reference")
    return _numbered_lines(brief, BRIEF_LEAD, _brief_lines(p, site))


def shown_articles(
    batch: DataFrame,
    site: SiteParams = SiteParams(),
    p: DailyReportParams = DailyReportParams(),
) -> DataFrame:
    """What a report needs of each article: keys, figures, and its entry ready but for the number."""
    lines = F.when(F.col("priority") == "reference", _brief_lines(p, site)).otherwise(
        _detail_lines(p, site)
    )
    analysis = F.struct(F.col("analysis.related_stocks"), F.col("analysis.category"))
    return batch.select(
        "date", *ORDER, "user_id", "title", "quality_passed", "priority",
        analysis.alias("analysis"), lines.alias("lines"),
    )


def _day_totals(batch: DataFrame) -> DataFrame:
    """Everything the fixed lines of a day need, in one aggregation."""
    total, passed = F.count(F.lit(1)), F.count_if("quality_passed")
    return batch.groupBy("date").agg(
        total.alias("total"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        *[F.count_if(F.col("priority") == p).alias(p) for p in PRIORITIES],
        F.coalesce(
            F.bool_or(F.size("analysis.related_stocks") > 0), F.lit(False)
        ).alias("has_entities"),
        F.min("analysis.category").alias("first_topic"),
    )


def _split_tail(tail: tuple[str, ...]) -> tuple[list[str], list[str]]:
    """The tail's lines up to the slot of the topics, and from behind it."""
    at = next(i for i, line in enumerate(tail) if "{topics}" in line)
    before, behind = tail[at].split("{topics}", 1)
    return [*tail[:at], before], [behind, *tail[at + 1 :]]


def _fixed_blocks(
    articles: DataFrame, mentions: DataFrame, generated_at: Column, p: DailyReportParams
) -> DataFrame:
    firsts = mentions.select("date", "entity", "first")
    hot = (
        first_k(firsts, ["date"], ["first"], p.hot_entities, "place")
        .groupBy("date")
        .agg(F.array_sort(F.collect_list(F.struct("place", "entity"))).alias("_hot"))
        .select("date", F.array_join(F.transform("_hot", lambda x: x["entity"]), ", ").alias("hot"))
    )
    head = {c: F.col(c) for c in ("total", "passed", "failed", *PRIORITIES)}
    head["date"] = F.date_format("date", "yyyy-MM-dd")
    tail = {
        "hot": F.coalesce("hot", F.lit(p.none)),
        "generated_at": generated_at,
        "model": F.lit(p.model),
    }
    titles = [
        keyed(10 * rank, lines_if(F.col(name) > 0, lines_of(title, "")))
        for rank, (name, title) in enumerate(p.section_titles, 1)
    ]
    before, behind = _split_tail(p.tail)
    days = _day_totals(articles)
    topics = topics_distinct(articles).join(days.select("date", "first_topic"), "date")
    comma = F.when(F.col("category") == F.col("first_topic"), "").otherwise(", ")
    return block_rows(
        days.join(hot, "date", "left"),
        keyed(0, lines_of(*[fill(x, **head) for x in p.head])),
        *titles,
        keyed(50, lines_if(F.col("has_entities"), lines_of(*p.entity_head))),
        keyed(60, lines_of(*[fill(x, **tail) for x in before]), open=True),
        # The report ends without a line break.
        keyed(62, lines_of(*[fill(x, **tail) for x in behind]), open=True),
    ).unionByName(
        block_rows(
            topics,
            keyed(61, lines_of(F.concat(comma, F.col("category"))), place(b=F.col("category")), open=True),
        )
    )


def _article_blocks(articles: DataFrame, p: DailyReportParams) -> DataFrame:
    order = [name for name, _ in p.section_titles]
    block = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("priority")) * 10 + 1
    lead = F.when(F.col("priority") == "reference", BRIEF_LEAD).otherwise(FULL_LEAD)
    return block_rows(articles, keyed(block.cast("int"), F.col("lines"), article_place(), lead))


def _entity_blocks(mentions: DataFrame) -> DataFrame:
    first = F.col("first")
    line = F.concat(
        F.lit("| "), F.col("entity"), F.lit(" | "), F.col("mentions").cast("string"),
        F.lit(" | "), F.col("links"), F.lit(" |"),
    )
    # Count descending, then first mention.
    mention = F.concat_ws(
        "/",
        F.date_format(first["ord"]["crawl_time"], "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        first["ord"]["article_id"],
    )
    order = place(-F.col("mentions"), mention, first["place"])
    return block_rows(mentions, keyed(51, lines_of(line), order))


def report_blocks(
    batch: DataFrame,
    generated_at: Column | str,
    site: SiteParams = SiteParams(),
    p: DailyReportParams = DailyReportParams(),
) -> DataFrame:
    """Every day's report as ordered block rows (``functions.lines``), days of any size.

    The batch is read once, into entries that hold only what is shown.
    """
    stamp = F.lit(generated_at) if isinstance(generated_at, str) else generated_at
    articles = materialize(shown_articles(batch, site, p))
    mentions = materialize(stock_mentions(articles, site, p))
    return in_order(
        _fixed_blocks(articles, mentions, stamp, p)
        .unionByName(_article_blocks(articles, p))
        .unionByName(_entity_blocks(mentions))
    )


def report_lines(blocks: DataFrame) -> DataFrame:
    """Every line of every day's report: ``date, block, number, place, open, line_no, line``.

    Sorting by (block, place, line_no) gives the report; sections without rows have no
    lines. The line that lists the topics has a row for each of its pieces.
    """
    return line_rows(blocks)


def report_text(blocks: DataFrame) -> DataFrame:
    """The reports as ordered pieces of text, to be written by ``write_report_text``."""
    return pieces(blocks)


def render_report(blocks: DataFrame, chars: int = PAGE_CHARS) -> DataFrame:
    """The text of each day in pages of ``chars`` characters, most days in one."""
    return pages(pieces(blocks), chars)
