"""Stored state: written, read back, rerun."""

import datetime as dt
import json
import random
import subprocess
import sys
import tarfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from inkfold.functions import lines
from inkfold.operators.incremental import explode_snapshots, snapshot_rollup
from inkfold.operators.quality import merge_quality_logs
from inkfold.session import materialize
from inkfold.sources import corpus, ordered_text, packed, sinks, tables
from inkfold.sources.ordered_text import scan_ordered_text

ARTICLE = (
    "user_id string, article_id string, title string, author string, publish_time string, likes int, "
    "comments int, url string, body string, crawl_time string"
)


def articles(spark, rows):
    return spark.createDataFrame(rows, ARTICLE).withColumn("crawl_time", F.col("crawl_time").cast("timestamp"))


ROWS = [
    ("1", "11", "A title | 发布时间：x", "", "发布于2026-02-16 12:30", 3, 4, "https://site.example/1/11",
     "line\n\n---\n\n*爬取时间：2020-01-01 00:00:00*\nend ", "2024-01-01 10:20:30"),
    ("1", "12", "", "an | author", "", 0, 0, "", "", "2024-01-02 00:00:00"),
    ("2", "21", "t", "a", "p", 0, 0, "u", "\n\n价值\n", "2024-01-02 00:00:01"),
]


def test_documents_parse_back(spark, tmp_path):
    rows = articles(spark, ROWS)
    for user, article, text in rows.select("user_id", "article_id", corpus.markdown_document()).collect():
        folder = tmp_path / user
        folder.mkdir(exist_ok=True)
        # With and without a final line break.
        (folder / f"{article}.md").write_text(text + ("\n" if article == "21" else ""), encoding="utf-8")
    (tmp_path / "1" / "13.md").write_text("# broken\n\ntext", encoding="utf-8")
    (tmp_path / "reports").mkdir()
    (tmp_path / "reports" / "2024-01-01.md").write_text("# not an article", encoding="utf-8")
    got = {r.article_id: r for r in corpus.scan_article_corpus(spark, str(tmp_path)).collect()}
    assert set(got) == {"11", "12", "13", "21"}
    for row in rows.collect():
        mine = got[row.article_id]
        assert mine.well_formed
        for c in rows.columns:
            assert mine[c] == row[c], c
    assert not got["13"].well_formed and got["13"].title is None and got["13"].raw == "# broken\n\ntext"


def test_article_table_keeps_the_last_version(spark, tmp_path):
    path = str(tmp_path / "articles")
    rows = articles(spark, ROWS)
    sinks.write_articles(rows, path, 1)
    again = rows.filter("article_id = '12'").withColumn("title", F.lit("second"))
    sinks.write_articles(again, path, 2)
    sinks.write_articles(again.withColumn("title", F.lit("rerun")), path, 2)
    got = {r.article_id: r.title for r in corpus.scan_articles(spark, path).collect()}
    assert got == {"11": ROWS[0][2], "12": "rerun", "21": "t"}
    pruned = corpus.scan_articles(spark, path).filter("crawl_date = date '2024-01-01'")
    assert [r.article_id for r in pruned.collect()] == ["11"]


def test_packed_documents(spark, tmp_path):
    """Few archives with the paths; a later batch replaces documents, a rerun its own batch."""
    path = str(tmp_path / "md")
    rows = articles(spark, ROWS)
    sinks.write_markdown(rows, path, 1)
    for title in ("first try", "second"):
        sinks.write_markdown(rows.filter("article_id = '12'").withColumn("title", F.lit(title)), path, 2)
    got = {r.article_id: r for r in corpus.scan_packed_corpus(spark, path).collect()}
    assert len(got) == 3 and all(r.well_formed for r in got.values())
    for row in rows.collect():
        for c in rows.columns:
            assert got[row.article_id][c] == ("second" if (c, row.article_id) == ("title", "12") else row[c]), c
    archives = sorted((tmp_path / "md" / "batch=1").glob("*.tar"))
    names = [n for a in archives for n in tarfile.open(a).getnames()]
    assert sorted(names) == ["1/11.md", "1/12.md", "2/21.md"]
    assert not list((tmp_path / "md").glob("_temporary*"))


def test_archives_roll_over_at_their_size(spark, tmp_path):
    path = str(tmp_path / "packed")
    name = F.concat(F.repeat(F.lit("é"), 150), F.col("id").cast("string"))
    documents = spark.range(100).select(name.alias("path"), F.repeat(F.lit("ü€"), 200).alias("raw"))
    packed.write_packed(documents.coalesce(2), path, 1, archive_bytes=10_000)
    assert len(list((tmp_path / "packed").glob("*/*.tar"))) == 10
    stored = packed.scan_packed(spark, path)
    assert stored.rdd.getNumPartitions() == 10
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, documents.collect()))


def snapshots(spark, rows, runs):
    kept = spark.createDataFrame(rows, "user_id string, date string, article_id string, title string, ord int")
    kept = kept.withColumn("crawl_time", F.lit("2024-01-01").cast("timestamp"))
    return snapshot_rollup(spark.createDataFrame(runs, "user_id string, date string"), kept)


def test_same_day_snapshot_is_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "snaps")
    sinks.write_snapshots(
        snapshots(spark, [("u", "2024-01-01", "a", "t", 1), ("u", "2024-01-02", "b", "t", 1)],
                  [("u", "2024-01-01"), ("u", "2024-01-02"), ("v", "2024-01-02")]),
        path,
        1,
    )
    for again in (["x"], ["c", "d"]):
        # Run 2 itself runs twice.
        rows = [("u", "2024-01-02", a, "t", i) for i, a in enumerate(again)]
        sinks.write_snapshots(snapshots(spark, rows, [("u", "2024-01-02")]), path, 2)
    table = tables.scan_snapshots(spark, path)
    assert tables.snapshot_headers(table).count() == 3
    rows = explode_snapshots(table).collect()
    got = sorted((r.user_id, str(r.date), r.article_count, r.article_id or "") for r in rows)
    assert got == [
        ("u", "2024-01-01", 1, "a"), ("u", "2024-01-02", 2, "c"), ("u", "2024-01-02", 2, "d"), ("v", "2024-01-02", 0, ""),
    ]


def test_snapshot_files(spark, tmp_path):
    for user, date, ids in (("u", "2024-01-01", ["a", "b"]), ("u", "2024-01-02", []), ("v", "2024-01-01", ["c"])):
        (tmp_path / user).mkdir(exist_ok=True)
        record = {
            "date": date, "user_id": user, "article_count": len(ids),
            "articles": [{"article_id": i, "title": "t", "crawl_time": f"{date}T00:00:00.1"} for i in ids],
        }
        (tmp_path / user / f"{date}.json").write_text(json.dumps(record, indent=2))
    rows = tables.scan_snapshots_explode(spark, str(tmp_path)).collect()
    got = sorted((r.user_id, str(r.date), r.article_count, r.article_id or "") for r in rows)
    assert got == [
        ("u", "2024-01-01", 2, "a"), ("u", "2024-01-01", 2, "b"), ("u", "2024-01-02", 0, ""), ("v", "2024-01-01", 1, "c"),
    ]


def test_index_file_and_missing_index(spark, tmp_path):
    file = tmp_path / "index.json"
    file.write_text(
        json.dumps({"articles": {"1": {"title": "t", "user_id": "u"}, "2": {"title": "s"}}, "last_update": None, "history": {}}, indent=2)
    )
    rows = {r.article_id: (r.title, r.user_id, r.filepath) for r in tables.scan_index_map(spark, str(file)).collect()}
    assert rows == {"1": ("t", "u", None), "2": ("s", None, None)}
    missing = tables.scan_index_map(spark, str(tmp_path / "none.json"))
    assert missing.columns == ["article_id", "title", "author", "publish_time", "user_id", "crawl_time", "filepath"]
    assert missing.count() == 0


def test_index_rows_by_batch(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = spark.createDataFrame([("a", "t")], "article_id string, title string")
    for batch_id in (1, 2, 2):
        sinks.write_index_rows(rows, path, batch_id)
    assert spark.read.parquet(path).count() == 2


@pytest.mark.parametrize("file_format", ["json", "csv"])
def test_accounts(spark, tmp_path, file_format):
    file = tmp_path / "accounts"
    if file_format == "json":
        file.write_text('{"id":"01","name":"n","url":"u"}\n{"id":"2","url":"u","enabled":false}\n')
    else:
        file.write_text("id,name,url,description,enabled\n01,n,u,,\n2,,u,,false\n")
    rows = tables.scan_accounts_enabled(spark, str(file), file_format).collect()
    assert [(r.id, r.name) for r in rows] == [("01", "n")]


def test_quality_log_reload(spark, tmp_path):
    path = str(tmp_path / "log")
    assert tables.scan_quality_log(spark, path).count() == 0
    daily = spark.createDataFrame([("2024-01-01", 3, 2, 1)], "date string, total_articles bigint, passed bigint, failed bigint")
    sinks.write_quality_log(daily, path)
    for _ in range(2):
        # Reload, add, replace the day.
        merged = merge_quality_logs(tables.scan_quality_log(spark, path, multiline=False), daily)
        sinks.write_quality_log(materialize(merged), path)
    (row,) = tables.scan_quality_log(spark, path, multiline=False).collect()
    assert (row.total_articles, row.passed, row.failed) == (9, 6, 3)


def report_pieces(spark, rows, partitions=7):
    """Ordered pieces from (date, text) in the order given."""
    df = spark.createDataFrame([(d, i, t) for i, (d, t) in enumerate(rows)], "date date, i bigint, text string")
    return lines.ordered(df.repartition(partitions), "date", "i")


def test_report_text_keeps_its_order_over_many_parts(spark, tmp_path):
    path = str(tmp_path / "reports")
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None]
    rows = [(d, f"é{i}😀 line\n" * (1 + i % 3)) for d in days for i in range(400)]
    rows.append((dt.date(2024, 1, 3), None))
    want = {d: "".join(t or "" for x, t in rows if x == d) for d, _ in rows}
    sinks.write_report_text(report_pieces(spark, rows), path)
    for day, text in want.items():
        folder = tmp_path / "reports" / f"date={day or '__HIVE_DEFAULT_PARTITION__'}"
        parts = sorted(folder.glob("part-*"))
        assert "".join(p.read_text() for p in parts) == text
        listed = json.loads((folder / "_parts.json").read_text())
        sizes = [p.stat().st_size for p in parts]
        assert [x["bytes"] for x in listed] == sizes
        assert [x["offset"] for x in listed] == [sum(sizes[:i]) for i in range(len(sizes))]
    assert not list((tmp_path / "reports").glob("_temporary*"))
    found = {}
    for r in sorted(scan_ordered_text(spark, path).collect(), key=lambda r: r.offset):
        assert r.offset == len(found.get(r.date, "").encode())
        found[r.date] = found.get(r.date, "") + r.text
    assert found == {d: t for d, t in want.items() if t}
    # Spark's own reader sees the dates and nothing but the parts.
    assert spark.read.text(path).filter("date = '2024-01-02'").count() == want[days[1]].count("\n")


def test_report_text_replaces_its_date_alone(spark, tmp_path):
    path = str(tmp_path / "reports")
    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    sinks.write_report_text(report_pieces(spark, [(one, "a\n")] * 50 + [(two, "b\n")] * 50), path)
    sinks.write_report_text(report_pieces(spark, [(one, "new")]), path)
    files = {str(p.relative_to(path)): p.read_text() for p in sorted((tmp_path / "reports").rglob("part-*"))}
    assert files["date=2024-01-01/part-00000.txt"] == "new" and len([f for f in files if "01-01" in f]) == 1
    assert "".join(t for f, t in sorted(files.items()) if "01-02" in f) == "b\n" * 50


def test_report_text_refuses_pieces_out_of_order(spark, tmp_path):
    path = str(tmp_path / "reports")
    rows = [("2024-01-01", "a"), ("2024-01-02", "b"), ("2024-01-01", "c")]
    mixed = spark.createDataFrame(rows, "date string, text string").coalesce(1)
    with pytest.raises(Exception, match="not in order"):
        sinks.write_report_text(mixed, path)
    assert not list((tmp_path / "reports").glob("*/*"))


def test_slices_end_at_characters(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "reports")
    text = "aé😀ü\n€" * 500
    sinks.write_report_text(report_pieces(spark, [(dt.date(2024, 1, 1), text)]), path)
    monkeypatch.setattr(ordered_text, "SLICE", 101)
    monkeypatch.setattr(ordered_text, "BLOCK", 17)
    reader = ordered_text.OrderedTextReader(path)
    slices = reader.partitions()
    assert len(slices) > 50
    found = sorted(row for s in slices for row in reader.read(s))
    assert "".join(t for _, _, t in found) == text
    assert [o for _, o, _ in found] == [len("".join(t for _, _, t in found[:i]).encode()) for i in range(len(found))]


SESSION_WITH_FOLDER = """
import sys
from inkfold.session import build_session, materialize, run_folder
spark = build_session("folder", "local[1]", **{"spark.checkpoint.dir": sys.argv[1]})
assert run_folder(spark, "x").startswith(sys.argv[1] + "/x-")
assert materialize(spark.range(5)).count() == 5
assert sys.argv[1] in spark.sparkContext.getCheckpointDir()
"""


def test_shared_folder_is_the_one_the_cluster_names(tmp_path):
    folder = str(tmp_path / "shared")
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run(
        [sys.executable, "-c", SESSION_WITH_FOLDER, folder], cwd=root, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-2000:]


def test_a_file_system_that_fails_is_not_a_missing_file(spark, tmp_path):
    from inkfold.sources import tables

    assert not tables.path_exists(spark, str(tmp_path / "none"))
    with pytest.raises(Exception):
        tables.scan_index_map(spark, "nosuchscheme://host/index.json")


def test_current_versions_after_compaction(spark, tmp_path):
    """Versions before, between and after compactions; the order of batches alone counts."""
    path = str(tmp_path / "articles")
    rows = articles(spark, [(u, str(i), "v1", "", "", 0, 0, "", "b", "2024-01-01 00:00:00") for u in "uv" for i in range(6)])
    want = {(u, str(i)): "v1" for u in "uv" for i in range(6)}

    def write(batch, keys):
        wanted = F.struct("user_id", "article_id").isin(*[F.struct(F.lit(u), F.lit(i)) for u, i in keys])
        sinks.write_articles(rows.filter(wanted).withColumn("title", F.lit(f"v{batch}")), path, batch)
        want.update({k: f"v{batch}" for k in keys})

    def check():
        found = {(r.user_id, r.article_id): r.title for r in corpus.scan_articles(spark, path).collect()}
        assert found == want and corpus.scan_articles(spark, path).count() == len(want)

    sinks.write_articles(rows, path, 1)
    corpus.compact_articles(spark, path)
    check()
    write(2, [("u", "0"), ("u", "1")])
    check()
    corpus.compact_articles(spark, path)
    check()
    write(3, [("u", "1"), ("v", "2")])
    write(4, [("v", "2"), ("v", "3")])
    check()
    for _ in range(2):
        corpus.compact_articles(spark, path)
        check()
    listed = spark.read.schema(corpus.POINTERS).parquet(f"{path}/_replaced").filter("base = 4")
    assert sorted((r.user_id, r.article_id, r.latest) for r in listed.collect()) == [
        ("u", "0", 2), ("u", "1", 3), ("v", "2", 4), ("v", "3", 4),
    ]
    write(5, [("u", "5")])
    check()
    # Of the keys only those of the batch since are read; a day filter reaches the article scan.
    plan = corpus.scan_articles(spark, path).filter("crawl_date = date '2024-01-01'")
    scans = [x for x in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    keys = [x for x in scans if "body" not in x and "latest" not in x]
    assert keys and all("batch_id" in x and "> 4)" in x for x in keys)
    assert all("crawl_date" in x.split("PartitionFilters")[1] for x in scans if "body" in x)


def index_document(n, indent=None, newest_first=False):
    """An index with braces, quotes and backslashes in its strings, and other maps around."""
    rng = random.Random(n)
    odd = ['{', '}', '"', '\\', '\\"', '}}', '{"articles": {', ', "a": {', "é", "\n", "plain", '\\\\"}', "]["]
    articles = {
        f"id{i}" + rng.choice(["", "}", '"', "\\"]): {
            "title": "".join(rng.choices(odd, k=rng.randint(0, 6))), "user_id": f"u{i % 3}",
            "extra": {"nested": {"deep": "}"}} if i % 5 == 0 else None, "filepath": f"data/{i}.md",
        }
        for i in range(n)
    }
    parts = {"last_update": 'x "}{', "articles": articles, "history": {"2024": {"title": "not an article"}}}
    keys = reversed(parts) if newest_first else parts
    return articles, json.dumps({k: parts[k] for k in keys}, indent=indent, ensure_ascii=False)


@pytest.mark.parametrize("n, indent, newest_first", [(400, None, False), (400, 2, True), (1, None, True), (0, None, False)])
def test_one_index_document_over_many_splits(spark, tmp_path, n, indent, newest_first):
    want, text = index_document(n, indent, newest_first)
    file = tmp_path / "index.json"
    file.write_text(text + ("\n" if indent else ""), encoding="utf-8")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500b")
        spark.conf.set("spark.sql.files.openCostInBytes", "0b")
        if n == 400:
            splits = spark.read.option("lineSep", "}").text(str(file)).select("_metadata.file_block_start")
            assert splits.distinct().count() > 20
        rows = tables.scan_index_map(spark, str(file)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert {r.article_id: (r.title, r.user_id, r.filepath) for r in rows} == {
        k: (a["title"], a["user_id"], a["filepath"]) for k, a in want.items()
    }
    assert len(rows) == n


def test_many_index_documents(spark, tmp_path):
    want = set()
    for i, n in enumerate((3, 40, 7)):
        articles, text = index_document(n)
        (tmp_path / f"{i}.json").write_text(text.replace('"id', f'"d{i}id'), encoding="utf-8")
        want |= {f"d{i}{k}" for k in articles}
    rows = tables.scan_index_map(spark, str(tmp_path)).collect()
    assert {r.article_id for r in rows} == want and len(rows) == 50
