"""Readers of stored state. Every reader has a declared schema and no driver-side work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkfold import schemas
from inkfold.operators.incremental import enabled_accounts, explode_snapshots
from inkfold.session import stored


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (no wildcard) exists on whatever file system it names.

    A file system that fails is an error, not a missing file.
    """
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hadoop_path))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    if not path_exists(spark, path):
        return []
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Deal a coarsely split input out to all cores by key.

    Text rules cost far more than moving a small table once. An input with at least one
    split per core, as any large one has, is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *key)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def scan_snapshots(spark: SparkSession, path: str, before_run: int | None = None) -> DataFrame:
    """The snapshot table, each (user, date) as its latest run left it.

    Only keys are aggregated; records of replaced runs drop out in an anti join. A run that
    may be a repeated one reads the state ``before_run``. No table yet reads as an empty one.
    """
    if not path_exists(spark, path):
        return empty(spark, schemas.SNAPSHOT_TABLE).drop("run_id")
    records = spark.read.schema(schemas.SNAPSHOT_TABLE).parquet(path)
    if before_run is not None:
        records = records.filter(F.col("run_id") < before_run)
    replaced = (
        records.groupBy("user_id", "date")
        .agg(F.max("run_id").alias("_latest"), F.min("run_id").alias("_oldest"))
        .filter(F.col("_latest") > F.col("_oldest"))
        .select(F.col("user_id").alias("_u"), F.col("date").alias("_d"), "_latest")
    )
    stale = (
        (F.col("user_id") == F.col("_u"))
        & (F.col("date") == F.col("_d"))
        & (F.col("run_id") < F.col("_latest"))
    )
    return records.join(replaced, stale, "left_anti").drop("run_id")


def snapshot_headers(snapshots: DataFrame) -> DataFrame:
    """One row per (user, date), empty snapshots included."""
    return snapshots.select("user_id", "date", "article_count").distinct()


def scan_snapshot_files(
    spark: SparkSession, root: str, glob: str = "*/*.json", multiline: bool = True
) -> DataFrame:
    """Snapshot documents: one per ``<root>/<user>/<date>.json``, or JSON lines."""
    return (
        spark.read.schema(schemas.SNAPSHOT_FILE)
        .option("multiLine", multiline)
        .json(f"{root}/{glob}")
        .withColumn("date", F.to_date("date"))
    )


def scan_snapshots_explode(
    spark: SparkSession, root: str, glob: str = "*/*.json", multiline: bool = True
) -> DataFrame:
    return explode_snapshots(scan_snapshot_files(spark, root, glob, multiline))


def index_rows(documents: DataFrame) -> DataFrame:
    """Rows of index documents, each a map from article id to its entry."""
    return documents.select(F.explode("articles").alias("article_id", "e")).select(
        "article_id", "e.*"
    )


# Quotes and braces as the text between two closing braces shows them. A backslash escapes
# the character behind it; none stands right before a brace in valid JSON.
_ESCAPED = r"\\."
_OUTSIDE, _INSIDE = r'"[^"]*("|\z)', r'\A[^"]*("|\z)'
_BLOCK = ["_file", "_start"]


def json_entries(spark: SparkSession, path: str, key: str = "articles") -> DataFrame:
    """The entries of the map under ``key`` in JSON documents, each as ``{"id": {...}}``.

    A document may be one line of any length. It is read in many splits as the texts between
    closing braces. Which braces count follows from the quotes before them: per split their
    parity and, for either parity, the change of depth are summed up, the few sums give each
    split its beginning, and inside a split running sums give each text its own. An entry ends
    where the depth comes back to that of the map; its texts (one, unless it has nested maps or
    braces in strings) meet by its number. Every document has to be valid JSON.
    """
    texts = (
        spark.read.option("lineSep", "}")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_slot"),
            F.col("value").alias("_text"),
        )
    )
    plain = F.regexp_replace("_text", _ESCAPED, "")

    def opened(inside: bool) -> Column:
        rest = F.regexp_replace(plain, _INSIDE, "") if inside else plain
        return F.length(F.regexp_replace(F.regexp_replace(rest, _OUTSIDE, ""), r"[^{]", "")).cast("bigint")

    marked = texts.withColumns(
        {
            "_quotes": (F.length(F.regexp_replace(plain, '[^"]', "")) % 2).cast("bigint"),
            "_open_0": opened(False),
            "_open_1": opened(True),
        }
    )
    within = Window.partitionBy(*_BLOCK).orderBy("_slot")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    # Quotes before a text, in its split; with the split's own beginning they tell its state.
    running = marked.withColumn("_before", F.coalesce(F.sum("_quotes").over(before), zero))

    def depth(parity: int) -> Column:
        """Change of depth over a text, its closing brace included, if the split begins so."""
        inside = (F.col("_before") + parity) % 2 == 1
        ends_inside = (F.col("_before") + F.col("_quotes") + parity) % 2 == 1
        opened_here = F.when(inside, F.col("_open_1")).otherwise(F.col("_open_0"))
        return opened_here - F.when(ends_inside, zero).otherwise(F.lit(1))

    stepped = running.withColumns({"_step_0": depth(0), "_step_1": depth(1)})
    parts = stored(stepped, "json-texts")
    sums = parts.groupBy(*_BLOCK).agg(
        F.sum("_quotes").alias("_q"), F.sum("_step_0").alias("_d0"), F.sum("_step_1").alias("_d1")
    )
    # A row per split of a document.
    splits = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        sums.withColumn("_parity", F.coalesce(F.sum("_q").over(splits), zero) % 2)
        .withColumn("_d", F.when(F.col("_parity") == 1, F.col("_d1")).otherwise(F.col("_d0")))
        .withColumn("_base", F.coalesce(F.sum("_d").over(splits), zero))
        .select(*_BLOCK, "_parity", "_base")
    )
    known = parts.join(F.broadcast(begins), _BLOCK)
    step = F.when(F.col("_parity") == 1, F.col("_step_1")).otherwise(F.col("_step_0"))
    ends_inside = (F.col("_before") + F.col("_quotes") + F.col("_parity")) % 2 == 1
    placed = (
        known.withColumn("_step", step)
        .withColumn("_depth", F.col("_base") + F.sum("_step").over(within))
        .select(*_BLOCK, "_slot", "_text", "_depth", (~ends_inside).alias("_closes"))
        # An entry ends at depth 2, a map of entries at depth 1.
        .withColumns(
            {
                "_entry": F.count_if(F.col("_closes") & (F.col("_depth") == 2)).over(before),
                "_map": F.count_if(F.col("_closes") & (F.col("_depth") == 1)).over(before),
            }
        )
    )
    placed = stored(placed, "json-places")
    counts = placed.groupBy(*_BLOCK).agg(
        F.count_if(F.col("_closes") & (F.col("_depth") == 2)).alias("_e"),
        F.count_if(F.col("_closes") & (F.col("_depth") == 1)).alias("_m"),
    )
    earlier = counts.select(
        *_BLOCK,
        F.coalesce(F.sum("_e").over(splits), zero).alias("_e0"),
        F.coalesce(F.sum("_m").over(splits), zero).alias("_m0"),
    )
    numbered = placed.join(F.broadcast(earlier), _BLOCK).select(
        "_file",
        (F.col("_m0") + F.col("_map")).alias("_map"),
        (F.col("_e0") + F.col("_entry")).alias("_entry"),
        F.struct("_start", "_slot", F.concat("_text", F.lit("}")).alias("text")).alias("_part"),
        (F.col("_closes") & (F.col("_depth") == 2)).alias("_ends"),
    )
    entries = numbered.groupBy("_file", "_map", "_entry").agg(
        F.array_sort(F.collect_list("_part")).alias("_parts"), F.bool_or("_ends").alias("_ends")
    )
    opener = rf'"{key}"\s*:\s*\{{'
    whole = F.array_join(F.transform("_parts", lambda x: x["text"]), "")
    named = entries.filter("_ends").select("_file", "_map", "_entry", whole.alias("_whole"))
    # The map under the key has the key in front of its first entry. Quotes in strings are
    # escaped, so the pattern is not found in one.
    maps = (
        named.groupBy("_file", "_map")
        .agg(F.min(F.struct("_entry", "_whole")).alias("_first"))
        .filter(F.regexp_like("_first._whole", F.lit(opener)))
        .select("_file", "_map", F.col("_first._entry").alias("_begin"))
    )
    body = F.when(
        F.col("_entry") == F.col("_begin"), F.regexp_replace("_whole", rf"(?s)\A.*?{opener}", "")
    ).otherwise(F.regexp_replace("_whole", r"\A\s*,", ""))
    return named.join(F.broadcast(maps), ["_file", "_map"]).select(
        F.concat(F.lit("{"), body, F.lit("}")).alias("entry")
    )


def scan_index_map(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Rows of an index kept as JSON; a missing file reads as an empty index.

    A document is read by as many tasks as it has splits, whether it is one line or many.
    ``multiline=False`` says that there is a document on every line.
    """
    if not path_exists(spark, path):
        return empty(spark, schemas.INDEX_ROWS)
    if not multiline:
        return index_rows(spark.read.schema(schemas.INDEX_FILE).json(path))
    kind = schemas.INDEX_FILE["articles"].dataType.simpleString()
    parsed = json_entries(spark, path).select(F.from_json("entry", kind).alias("articles"))
    return index_rows(parsed)


def scan_index_table(spark: SparkSession, path: str, before_batch: int | None = None) -> DataFrame:
    """The index rows as ``write_index_rows`` stored them, those before a batch if one is given.

    No table yet reads as an empty one.
    """
    if not path_exists(spark, path):
        return empty(spark, schemas.INDEX_TABLE).drop("batch_id")
    rows = spark.read.schema(schemas.INDEX_TABLE).parquet(path)
    if before_batch is not None:
        rows = rows.filter(F.col("batch_id") < before_batch)
    return rows.drop("batch_id")


def scan_accounts_enabled(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    """Enabled, complete accounts from JSON lines or CSV."""
    reader = spark.read.schema(schemas.ACCOUNTS)
    if file_format == "csv":
        reader = reader.option("header", True)
    return enabled_accounts(reader.format(file_format).load(path))


def scan_quality_log(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Daily quality counters and their failure details as stored."""
    if not path_exists(spark, path):
        return empty(spark, schemas.QUALITY_LOG)
    return (
        spark.read.schema(schemas.QUALITY_LOG).option("multiLine", multiline).json(path)
    )
