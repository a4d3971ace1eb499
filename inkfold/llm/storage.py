"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from inkfold.session import run_folder


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    The written table cuts the lineage: a lost executor costs the tasks that read it,
    not the work that made it. Joins on it see its true size, and both of their sides
    come from exchanges of their own, so a hot key's partition can be split.
    """
    path = run_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, column: str, purpose: str) -> tuple[DataFrame, str]:
    """``df`` as a table of the warehouse in buckets of ``column``, and its name.

    Joins on the column then move the other side only. ``drop table`` it when it is done with.
    """
    spark = df.sparkSession
    name = f"{purpose}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, column).sortBy(column).saveAsTable(name)
    return spark.table(name), name


def discard(*tables: DataFrame) -> None:
    """Remove stored tables that nothing will read again."""
    for table in tables:
        for file in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
            _remove(table.sparkSession, file)


def _remove(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def neutral(docs: DataFrame, *names: str) -> tuple[DataFrame, ...]:
    """``docs`` with columns c0, c1, .. and what ``names`` are called there.

    Operators that carry all columns along work on this, so no column of ``docs``, whatever
    its name, meets one of theirs. ``docs.columns`` names the result again by ``toDF``.
    """
    own = [f"c{i}" for i in range(len(docs.columns))]
    return (docs.toDF(*own), *(own[docs.columns.index(n)] for n in names))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
