"""Explicit schemas of every stored table. Nothing in the package infers a schema."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_S, _L, _I, _B, _T = StringType(), LongType(), IntegerType(), BooleanType(), TimestampType()


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


ACCOUNTS = _struct(id=_S, name=_S, url=_S, description=_S, enabled=_B)

LIST_ITEMS = _struct(
    user_id=_S, article_id=_S, title=_S, content=_S, publish_time=_S, link=_S,
    likes=_I, comments=_I, pos=_L,
)

PAGE_DETAILS = _struct(
    url=_S, title=_S, author=_S, publish_time=_S, content=_S, likes=_I, comments=_I,
    is_column=_B,
)

ARTICLES = _struct(
    user_id=_S, article_id=_S, title=_S, author=_S, publish_time=_S, likes=_I,
    comments=_I, url=_S, body=_S, crawl_time=_T, raw=_S,
)

INDEX_ENTRY = _struct(
    title=_S, author=_S, publish_time=_S, user_id=_S, crawl_time=_S, filepath=_S
)
INDEX_FILE = _struct(articles=MapType(_S, INDEX_ENTRY), last_update=_S)
INDEX_ROWS = _struct(
    article_id=_S, title=_S, author=_S, publish_time=_S, user_id=_S, crawl_time=_S, filepath=_S
)

# The index as a table: one partition per batch, times as timestamps.
INDEX_TABLE = StructType(
    [StructField(f.name, _T if f.name == "crawl_time" else f.dataType, True) for f in INDEX_ROWS]
    + [StructField("batch_id", _L, True)]
)

SNAPSHOT_ENTRY = _struct(article_id=_S, title=_S, crawl_time=_S)
SNAPSHOT_FILE = _struct(
    date=_S, user_id=_S, article_count=_L, articles=ArrayType(SNAPSHOT_ENTRY)
)

SNAPSHOT_TABLE = _struct(
    user_id=_S,
    date=DateType(),
    chunk=_I,
    article_count=_L,
    articles=ArrayType(_struct(article_id=_S, title=_S, crawl_time=_T)),
    run_id=_L,
)

ANALYSIS_V1 = _struct(
    category=_S,
    related_stocks=ArrayType(_S),
    core_points=ArrayType(_S),
    value_investment=_struct(alignment=_S, margin_of_safety=_S, analysis=_S),
    insights=ArrayType(_S),
    summary=_S,
)

ANALYSIS_V2 = _struct(
    importance=_S,
    content_type=_S,
    related_stocks=ArrayType(_S),
    related_industries=ArrayType(_S),
    core_thesis=_S,
    key_data=MapType(_S, _S),
    investment_implications=_S,
    action_required=_S,
    confidence=_S,
)

QUALITY_ISSUE = _struct(
    article_id=_S, user_id=_S, title=_S, issues=ArrayType(_S), content_length=_L
)
QUALITY_LOG = _struct(
    date=_S, total_articles=_L, passed=_L, failed=_L, issues=ArrayType(QUALITY_ISSUE)
)
