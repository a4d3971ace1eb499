"""Tables and text of the investment report, for any number of days at once.

A *batch* has one row per article: ``date, article_id, title, url, link, crawl_time,
analysis`` with the second form of analysis, in (crawl_time, article_id) order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.functions import rules as R
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
from inkfold.params import InvestmentReportParams
from inkfold.session import materialize

ORDER = ["crawl_time", "article_id"]


def _link() -> Column:
    """A missing url falls back to the list link; an empty one does not."""
    return F.coalesce(F.col("url"), F.col("link"), F.lit(""))


def _tagged(stocks: Column) -> Column:
    return F.array_join(F.transform(stocks, lambda s: F.concat(F.lit("$"), s)), ", ")


def _list_line(p: InvestmentReportParams) -> Column:
    """A linked title with its entities, from behind the number."""
    stocks = F.col("analysis.related_stocks")
    suffix = F.when(
        F.size(stocks) > 0, F.concat(F.lit(" ["), _tagged(stocks), F.lit("]"))
    ).otherwise("")
    title = cut(text("title", p.no_title), p.list_title_chars)
    return F.concat(F.lit(". ["), title, F.lit("]("), _link(), F.lit(")"), suffix)


def article_list(
    batch: DataFrame, p: InvestmentReportParams = InvestmentReportParams()
) -> DataFrame:
    """One numbered, linked line per article with its entities."""
    listed = batch.select("date", *ORDER, _list_line(p).alias("line"))
    numbers = number_rows(listed.select("date", *ORDER), ["date"], ORDER, "number")
    return listed.join(numbers.select("article_id", "number"), "article_id").select(
        "date", "number", "article_id",
        F.concat(F.col("number").cast("string"), F.col("line")).alias("line"),
    )


def stocks_union(batch: DataFrame) -> DataFrame:
    """Distinct entities of each day."""
    named = batch.select("date", F.explode_outer("analysis.related_stocks").alias("entity"))
    return named.filter(F.col("entity").isNotNull()).distinct()


def importance_sections(
    batch: DataFrame,
    p: InvestmentReportParams = InvestmentReportParams(),
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Each article's route with its fields cut as that route's section shows them.

    Columns named in ``keep`` come along.
    """
    a = F.col("analysis")
    route = R.importance(a["importance"])
    title = text("title", p.no_title)

    def by_route(high: Column, medium: Column, low: Column) -> Column:
        return F.when(route == "high", high).when(route == "medium", medium).otherwise(low)

    none = F.lit(None).cast("string")
    names = F.coalesce(
        F.when(F.size(a["related_stocks"]) > 0, _tagged(a["related_stocks"])), F.lit(p.none)
    )
    return batch.select(
        "date",
        "article_id",
        "crawl_time",
        route.alias("route"),
        by_route(
            title, cut(title, p.medium_title_chars), cut(title, p.low_title_chars)
        ).alias("title"),
        _link().alias("url"),
        by_route(names, names, none).alias("entities"),
        by_route(
            F.coalesce(a["core_thesis"], F.lit(p.none)),
            cut(F.coalesce(a["core_thesis"], F.lit("")), p.medium_thesis_chars),
            none,
        ).alias("thesis"),
        by_route(
            F.coalesce(a["investment_implications"], F.lit(p.none)),
            cut(F.coalesce(a["investment_implications"], F.lit("")), p.medium_implication_chars),
            none,
        ).alias("implications"),
        by_route(
            F.coalesce(a["action_required"], F.lit(p.default_action)), none, none
        ).alias("action"),
        F.when(route == "high", a["key_data"]).alias("key_data"),
        *keep,
    )


def key_data_rows(rows: DataFrame, key_data: Column, *keep: str) -> DataFrame:
    """Entries of a map column whose value is not empty, as ``key`` and ``value``."""
    filled = F.map_filter(key_data, lambda k, v: F.coalesce(v, F.lit("")) != "")
    return rows.select(*keep, F.explode(F.map_entries(filled)).alias("_e")).select(
        *keep, F.col("_e.key").alias("key"), F.col("_e.value").alias("value")
    )


def _actions(batch: DataFrame, p: InvestmentReportParams) -> DataFrame:
    action = F.coalesce(F.col("analysis.action_required"), F.lit(p.default_action))
    return batch.select(
        "date",
        action.alias("action"),
        cut(text("title"), p.action_title_chars).alias("title"),
        *ORDER,
    ).filter(~F.col("action").isin("", p.no_action))


def action_list(
    batch: DataFrame, p: InvestmentReportParams = InvestmentReportParams()
) -> DataFrame:
    """Per day and action: how many titles, the first few of them, and how many more.

    The count combines map-side and the titles are limited before the shuffle, so an
    action most articles share stays cheap.
    """
    rows = _actions(batch, p)
    totals = rows.groupBy("date", "action").agg(F.count(F.lit(1)).alias("titles"))
    shown = (
        first_k(rows, ["date", "action"], ORDER, p.titles_per_action, "nth")
        .groupBy("date", "action")
        .agg(F.array_sort(F.collect_list(F.struct("nth", "title"))).alias("_shown"))
        .select("date", "action", F.transform("_shown", lambda x: x["title"]).alias("shown"))
    )
    more = F.greatest(F.col("titles") - p.titles_per_action, F.lit(0).cast("bigint"))
    return totals.join(shown, ["date", "action"]).withColumn("more", more)


def _high_lines(p: InvestmentReportParams) -> Column:
    entry = F.transform(
        F.filter(
            F.map_entries("key_data"), lambda e: F.coalesce(e["value"], F.lit("")) != ""
        ),
        lambda e: F.concat(F.lit("- "), e["key"], F.lit(": "), e["value"]),
    )
    return F.concat(
        lines_of(
            F.concat(F.lit("### ["), F.col("title"), F.lit("]("), F.col("url"), F.lit(")")),
            "",
            F.concat(F.lit("**关联标的：** "), F.col("entities")),
            "",
            F.concat(F.lit("**核心论点：** "), F.col("thesis")),
            "",
            F.concat(F.lit("**投资启示：** "), F.col("implications")),
            "",
        ),
        lines_if(
            F.size("key_data") > 0, F.concat(lines_of("**关键数据：**"), entry, lines_of(""))
        ),
        lines_of(F.concat(F.lit("**建议行动：** "), F.col("action")), "", "---", ""),
    )


def _medium_lines() -> Column:
    return lines_of(
        F.concat(F.lit("### ["), F.col("title"), F.lit("]("), F.col("url"), F.lit(")")),
        F.concat(F.lit("- **核心论点：** "), F.col("thesis")),
        F.concat(F.lit("- **关联标的：** "), F.col("entities")),
        F.concat(F.lit("- **启示：** "), F.col("implications")),
        "",
    )


def _low_lines() -> Column:
    return lines_of(F.concat(F.lit("- ["), F.col("title"), F.lit("]("), F.col("url"), F.lit(")")))


def _fixed_blocks(batch: DataFrame, generated_at: Column, p: InvestmentReportParams) -> DataFrame:
    days = batch.groupBy("date").agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("route") == r).alias(r) for r in ("high", "medium", "low")],
        F.min(F.array_min("stocks")).alias("first"),
    )
    named = batch.select("date", F.explode_outer("stocks").alias("entity"))
    names = named.filter(F.col("entity").isNotNull()).distinct().join(
        days.select("date", "first"), "date"
    )
    comma = F.when(F.col("entity") == F.col("first"), "").otherwise(", $")
    head = {"date": F.date_format("date", "yyyy-MM-dd"), "total": F.col("total")}
    tail = {"generated_at": generated_at, "model": F.lit(p.model)}
    titles = ((10, "high", p.high_title), (20, "medium", p.medium_title), (30, "low", p.low_title))
    any_names = F.col("first").isNotNull()
    return block_rows(
        days,
        keyed(0, lines_of(*[fill(x, **head) for x in p.head])),
        keyed(2, lines_of("")),
        keyed(3, lines_if(any_names, lines_of(p.entities_title, "", "$**")), open=True),
        keyed(5, lines_if(any_names, lines_of("**", ""))),
        *[keyed(n, lines_if(F.col(name) > 0, lines_of(title, ""))) for n, name, title in titles],
        keyed(32, lines_if(F.col("low") > 0, lines_of(""))),
        keyed(40, lines_of(p.actions_title, "")),
        # The report ends without a line break.
        keyed(50, lines_of(*[fill(x, **tail) for x in p.tail]), open=True),
    ).unionByName(
        block_rows(
            names,
            keyed(4, lines_of(F.concat(comma, F.col("entity"))), place(b=F.col("entity")), open=True),
        )
    )


def _section_lines(p: InvestmentReportParams) -> Column:
    route = F.col("route")
    return (
        F.when(route == "high", _high_lines(p))
        .when(route == "medium", _medium_lines())
        .otherwise(_low_lines())
    )


def _action_blocks(actions: DataFrame) -> DataFrame:
    lines = F.concat(
        lines_of(F.concat(F.lit("### "), F.col("action"))),
        F.transform("shown", lambda t: F.concat(F.lit("- "), t)),
        lines_if(
            F.col("more") > 0,
            lines_of(F.concat(F.lit("- ... 还有 "), F.col("more").cast("string"), F.lit(" 条"))),
        ),
        lines_of(""),
    )
    return block_rows(actions, keyed(41, lines, place(b=F.col("action"))))


def shown_articles(
    batch: DataFrame, p: InvestmentReportParams = InvestmentReportParams()
) -> DataFrame:
    """What a report needs of each article, its entries ready but for the number."""
    sections = importance_sections(
        batch.withColumns(
            {
                "_stocks": F.col("analysis.related_stocks"),
                "_list": _list_line(p),
                "_action": F.struct(F.col("analysis.action_required").alias("action_required")),
                "_title": F.col("title"),
            }
        ),
        p,
        ("_stocks", "_list", "_action", "_title"),
    )
    return sections.select(
        "date", *ORDER, "route",
        F.col("_stocks").alias("stocks"),
        F.col("_list").alias("listed"),
        F.col("_title").alias("title"),
        F.col("_action").alias("analysis"),
        _section_lines(p).alias("lines"),
    )


def investment_blocks(
    batch: DataFrame,
    generated_at: Column | str,
    p: InvestmentReportParams = InvestmentReportParams(),
) -> DataFrame:
    """Every day's report as ordered block rows (``functions.lines``), days of any size."""
    stamp = F.lit(generated_at) if isinstance(generated_at, str) else generated_at
    articles = materialize(shown_articles(batch, p))
    route = F.col("route")
    section = F.when(route == "high", 11).when(route == "medium", 21).otherwise(31)
    return in_order(
        _fixed_blocks(articles, stamp, p)
        .unionByName(
            block_rows(
                articles,
                keyed(1, lines_of(F.col("listed")), article_place(), F.lit("")),
                keyed(section, F.col("lines"), article_place()),
            )
        )
        .unionByName(_action_blocks(action_list(articles, p)))
    )


def investment_lines(blocks: DataFrame) -> DataFrame:
    """Every line of every day's report, as in the daily report."""
    return line_rows(blocks)


def investment_text(blocks: DataFrame) -> DataFrame:
    """The reports as ordered pieces of text, to be written by ``write_report_text``."""
    return pieces(blocks)


def render_investment_report(blocks: DataFrame, chars: int = PAGE_CHARS) -> DataFrame:
    """The text of each day in pages of ``chars`` characters, most days in one."""
    return pages(pieces(blocks), chars)
