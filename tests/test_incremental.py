"""Incremental state: order of steps, hot groups, reruns."""

import datetime as dt
import random
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkfold.operators import incremental as D
from inkfold.params import CrawlParams, SiteParams

SITE = SiteParams()
ITEM = "user_id string, article_id string, link string, account_order bigint, pos bigint"
DETAIL = (
    "url string, title string, author string, publish_time string, content string, "
    "likes int, comments int, is_column boolean"
)


def snapshots(spark, heads, entries=()):
    """Nested records of (user, date) with the ids of (user, date, id); repeated ids stay."""
    held = defaultdict(list, {tuple(h): [] for h in heads})
    for user, date, article in entries:
        held[user, date].append((article,))
    rows = [(u, d, ids) for (u, d), ids in held.items()]
    return spark.createDataFrame(rows, "user_id string, date string, articles array<struct<article_id:string>>")


def index(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "article_id string")


def items(spark, rows):
    return spark.createDataFrame([(u, a, f"l{a}", o, p) for u, a, o, p in rows], ITEM)


def details(spark, rows):
    return spark.createDataFrame([(f"l{a}", t, "au", "now", f"text {a}", 1, 2, c) for a, t, c in rows], DETAIL)


def reference_batch(listed, detail, stored, heads, known, k, cap):
    """The rules again, one user after the other, on plain dictionaries."""
    seen, kept = set(known), []
    by_user = defaultdict(list)
    for u, a, o, p in sorted(listed, key=lambda r: (r[2], r[3])):
        by_user[(o, u)].append(a)
    for (_, user), ids in sorted(by_user.items()):
        days = sorted((d for u, d in heads if u == user), reverse=True)[:k]
        recent = {a for u, d, a in stored if u == user and d in days}
        fresh = [a for a in ids if a and a not in recent][:cap]
        for a in fresh:
            if a not in detail:
                continue
            title, column = detail[a]
            if title.startswith(SITE.reply_prefix) or not column or a in seen:
                continue
            seen.add(a)
            kept.append((user, a))
    return sorted(kept)


def run(spark, *args, **options):
    return both(spark, *args, **options).batch


def both(spark, listed, detail, stored, heads, known, k=2, cap=3):
    return D.incremental_run(
        items(spark, listed),
        details(spark, [(a, t, c) for a, (t, c) in detail.items()]),
        snapshots(spark, heads, stored),
        index(spark, known),
        SITE,
        CrawlParams(snapshot_files=k, articles_per_user=cap),
    )


def test_recent_ids_count_snapshots_not_days_and_empty_ones_too(spark):
    heads = [("u", f"2024-01-{d:02d}") for d in (1, 5, 9)] + [("v", "2024-01-01")]
    rows = [("u", "2024-01-01", "a"), ("u", "2024-01-05", "b"), ("u", "2024-01-05", "b"), ("v", "2024-01-01", "c")]
    got = {(r.user_id, r.article_id) for r in D.recent_snapshot_ids(snapshots(spark, heads, rows), 2).collect()}
    assert got == {("u", "b"), ("v", "c")}
    assert D.recent_snapshot_ids(snapshots(spark, heads, rows), 2).count() == 2


def test_records_of_one_snapshot_count_once_and_a_bound_leaves_older_days_out(spark):
    """A snapshot in three chunks, and a user whose newest snapshots are older than the bound."""
    rows = spark.createDataFrame(
        [("u", "2024-01-05", [("a",)]), ("u", "2024-01-05", [("b",)]), ("u", "2024-01-05", []),
         ("u", "2024-01-03", [("c",)]), ("u", "2024-01-01", [("d",)]), ("v", "2024-01-01", [("e",)])],
        "user_id string, date string, articles array<struct<article_id:string>>",
    ).withColumn("date", F.to_date("date"))
    assert {r.article_id for r in D.recent_snapshot_ids(rows, 2).collect()} == {"a", "b", "c", "e"}
    assert {r.article_id for r in D.recent_snapshot_ids(rows, 2, dt.date(2024, 1, 2)).collect()} == {"a", "b", "c"}


def test_new_items_have_an_id_and_are_new_to_their_user(spark):
    listed = items(spark, [("u", "a", 1, 0), ("u", "", 1, 1), ("u", None, 1, 2), ("v", "a", 2, 0)])
    known = spark.createDataFrame([("u", "a")], "user_id string, article_id string")
    assert [(r.user_id, r.article_id) for r in D.new_articles_antijoin(listed, known).collect()] == [("v", "a")]


def test_cap_is_20_in_list_order(spark):
    rows = [("u", str(p), 1, p) for p in range(21)] + [("v", "x", 1, 5)]
    random.Random(2).shuffle(rows)
    got = D.crawl_cap_per_user(items(spark, rows))
    assert {r.pos for r in got.filter("user_id = 'u'").collect()} == set(range(20))
    assert got.filter("user_id = 'v'").count() == 1


def test_capped_items_that_are_filtered_are_not_replaced(spark):
    listed = [("u", a, 1, p) for p, a in enumerate("abcd")]
    detail = {"a": ("回复@x", True), "b": ("t", False), "c": ("t", True), "d": ("t", True)}
    assert [r.article_id for r in run(spark, listed, detail, [], [], [], cap=3).collect()] == ["c"]


def test_repeats_use_slots_and_the_first_account_keeps_the_article(spark):
    listed = [("u", "a", 2, 0), ("u", "a", 2, 1), ("u", "b", 2, 2), ("v", "a", 1, 0)]
    detail = {"a": ("t", True), "b": ("t", True)}
    rows = run(spark, listed, detail, [], [], [], cap=2).collect()
    assert [(r.user_id, r.article_id, r.content) for r in rows] == [("v", "a", "text a")]


ids = st.sampled_from(["", "a", "b", "c", "d", "e", "f"])
users = st.sampled_from(["u", "v", "w"])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(users, ids), max_size=14),
    st.dictionaries(ids, st.tuples(st.sampled_from(["t", "回复@y", ""]), st.booleans()), max_size=6),
    st.lists(st.tuples(users, st.sampled_from(["1", "2", "3"]), ids), max_size=6),
    st.lists(ids, max_size=2),
)
def test_batch_equals_the_sequential_rules(spark, listed, detail, stored, known):
    order = {"u": 3, "v": 1, "w": 2}
    rows = [(u, a, order[u], p) for p, (u, a) in enumerate(listed)]
    heads = sorted({(u, d) for u, d, _ in stored} | {("u", "4"), ("v", "0")})
    got = run(spark, rows, detail, stored, heads, known)
    want = reference_batch(rows, detail, stored, heads, known, 2, 3)
    assert sorted((r.user_id, r.article_id) for r in got.collect()) == want


def test_counts_equal_the_sequential_rules(spark):
    """Copies, empty and missing ids, known ids, users without items."""
    rng = random.Random(4)
    listed = [(rng.choice("uvw"), rng.choice(["", "a", "b", "c", "d", None]), 1, p) for p in range(60)]
    stored = [("u", "2", "a"), ("u", "2", "a"), ("x", "2", "a"), ("v", "1", "b"), ("v", "2", "c"), ("v", "3", "d")]
    heads = sorted({(u, d) for u, d, _ in stored})
    detail = {a: ("t", True) for a in "abd"}
    batch, counts = both(spark, listed, detail, stored, heads, ["d"], k=2, cap=7)
    kept = reference_batch(listed, detail, stored, heads, ["d"], 2, 7)
    recent = {("u", "a"), ("v", "c"), ("v", "d")}
    want = {}
    for user in "uvw":
        own = [a for u, a, *_ in listed if u == user]
        new = [a for a in own if a and (user, a) not in recent]
        want[user] = (len(own), len(new), min(7, len(new)), sum(u == user for u, _ in kept))
    assert {r.user_id: (r.listed, r.new, r.capped, r.kept) for r in counts.collect()} == want
    assert sorted((r.user_id, r.article_id) for r in batch.collect()) == kept


def test_batch_has_its_crawl_time_and_path(spark):
    listed = items(spark, [("u", "a", 1, 0)])
    fetched = details(spark, [("a", "t", True), ("a", "t", True)]).withColumn(
        "crawl_time", F.lit("2024-01-02 03:04:05").cast("timestamp")
    )
    args = listed, fetched, snapshots(spark, []), index(spark, [])
    (row,) = D.incremental_batch(*args).collect()
    assert (str(row.crawl_time), row.filepath, row.url) == ("2024-01-02 03:04:05", "data/u/a.md", "la")
    given = D.incremental_batch(*args, crawl_time=F.lit("2025-01-01").cast("timestamp"), root="store")
    (row,) = given.collect()
    assert (str(row.crawl_time), row.filepath) == ("2025-01-01 00:00:00", "store/u/a.md")


def test_one_url_with_two_details_and_an_item_listed_under_two_urls(spark):
    """The detail fetched last counts; where it fails the type filter, another url may pass."""
    listed = spark.createDataFrame([("u", "a", "l1", 1, 0), ("u", "a", "l2", 1, 1)], ITEM)
    rows = [("l1", "old", True, 1), ("l1", "new", False, 2), ("l2", "x", True, 1), ("l2", "y", True, 3)]
    fetched = spark.createDataFrame(rows, "url string, title string, is_column boolean, at int")
    kept = D.incremental_batch(
        listed, fetched, snapshots(spark, []), index(spark, []), detail_order="at"
    )
    assert [(r.link, r.title) for r in kept.collect()] == [("l2", "y")]


def test_counts_and_rerun(spark):
    listed = [("u", a, 1, p) for p, a in enumerate("abcde")] + [("v", "z", 2, 0)]
    detail = {a: ("t", a != "b") for a in "abcde"}
    first, counts = both(spark, listed, detail, [], [], [])
    kept = [(r.user_id, r.article_id) for r in first.collect()]
    assert {r.user_id: (r.listed, r.new, r.capped, r.kept) for r in counts.collect()} == {
        "u": (5, 5, 3, 2), "v": (1, 1, 1, 0),
    }
    stored = [(u, "2024-01-01", a) for u, a in kept]
    again = run(
        spark, [r for r in listed if r[1] in "ac"], detail, stored, [("u", "2024-01-01")], [a for _, a in kept]
    )
    assert again.count() == 0


def test_index_rows_never_change(spark):
    schema = "article_id string, title string, pos int"
    old = spark.createDataFrame([("a", "old", 0)], schema)
    new = spark.createDataFrame([("a", "new", 1), ("b", "second", 3), ("b", "first", 2)], schema)
    rows = {r.article_id: r.title for r in D.upsert_index(old, new, ["pos"]).collect()}
    assert rows == {"a": "old", "b": "first"}


def test_snapshot_rollup_keeps_empty_runs_and_splits_large_ones(spark):
    runs = spark.createDataFrame([("u", "d"), ("v", "d")], "user_id string, date string")
    kept = spark.createDataFrame(
        [("u", "d", f"{i:03d}", "t" * 60, i) for i in range(95)],
        "user_id string, date string, article_id string, title string, ord int",
    ).withColumn("crawl_time", F.lit("2024-01-01").cast("timestamp"))
    whole = D.snapshot_rollup(runs, kept).collect()
    assert sorted((r.user_id, r.article_count, len(r.articles)) for r in whole) == [("u", 95, 95), ("v", 0, 0)]
    entry = next(r for r in whole if r.user_id == "u").articles
    assert [e.article_id for e in entry] == [f"{i:03d}" for i in range(95)] and len(entry[0].title) == 50
    parts = D.snapshot_rollup(runs, kept, chunk=10).filter("user_id = 'u'").collect()
    assert len(parts) > 5 and {r.article_count for r in parts} == {95}
    assert sorted(e.article_id for r in parts for e in r.articles) == [f"{i:03d}" for i in range(95)]


def test_account_names(spark):
    accounts = spark.createDataFrame(
        [("1", "待确认"), ("2", "2"), ("3", "Named"), ("4", "4"), ("5", "待确认")], "id string, name string"
    )
    names = spark.createDataFrame(
        [("1", "Ann"), ("2", "Bob"), ("3", "Other"), ("4", "4"), ("5", "")], "user_id string, user_name string"
    )
    got = {r.id: r.name for r in D.account_name_merge(accounts, names).collect()}
    assert got == {"1": "Ann", "2": "Bob", "3": "Named", "4": "4", "5": "待确认"}


def test_enabled_accounts(spark):
    rows = spark.createDataFrame(
        [("1", "u", True), ("2", "u", None), ("3", "u", False), ("", "u", True), ("4", "", None), ("5", None, True)],
        "id string, url string, enabled boolean",
    )
    assert [r.id for r in D.enabled_accounts(rows).collect()] == ["1", "2"]


def test_report_batch_skips_missing_documents_before_the_limit(spark):
    index_rows = spark.createDataFrame(
        [(str(i), f"2024-01-0{1 + i % 2} 00:00:{i:02d}") for i in range(12)], "article_id string, crawl_time string"
    ).withColumn("crawl_time", F.col("crawl_time").cast("timestamp"))
    documents = spark.createDataFrame([(str(i), "c") for i in range(2, 12)], "article_id string, content string")
    for limit in (2, 1000):
        rows = D.report_batch(index_rows, documents, limit)
        picked = {(str(r.date), r.batch_no, r.article_id) for r in rows.collect()}
        want = {
            (f"2024-01-0{1 + day}", n, str(i))
            for day in (0, 1)
            for n, i in enumerate([i for i in range(2, 12) if i % 2 == day][:limit], 1)
        }
        assert picked == want


def test_one_detail_of_each_url(spark):
    rows = [("u1", "a", True, 1), ("u1", "b", False, 2), ("u2", "c", True, 1), ("u2", "c", True, 1)]
    found = D.one_detail(spark.createDataFrame(rows, "url string, title string, is_column boolean, at int"), "at")
    assert sorted((r.url, r.title, r.is_column) for r in found.collect()) == [("u1", "b", False), ("u2", "c", True)]


def test_two_authors_with_one_id_do_not_multiply_rows(spark):
    at = F.lit("2024-01-01 05:00:00").cast("timestamp")
    both = spark.createDataFrame([("u", "1"), ("v", "1"), ("v", "2")], "user_id string, article_id string")
    index_rows = both.withColumn("crawl_time", at)
    documents = both.withColumn("content", F.concat_ws("/", "user_id", "article_id"))
    want = ["u/1", "v/1", "v/2"]
    assert sorted(r.content for r in D.today_articles_join(index_rows, documents).collect()) == want
    assert sorted(r.content for r in D.report_batch(index_rows, documents, 20).collect()) == want
    rows = index_rows.withColumn("date", F.to_date("crawl_time"))
    limited = D.report_limit(rows, 20).collect()
    assert sorted((r.user_id, r.article_id) for r in limited) == [("u", "1"), ("v", "1"), ("v", "2")]
    nobody = rows.withColumn("user_id", F.lit(None).cast("string")).filter("article_id = '2'")
    assert D.report_limit(nobody, 20).count() == 1
