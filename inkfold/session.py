"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package relies on. The time zone is fixed because
# crawl days are derived from timestamps.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Whole pages go through the Arrow stages; a batch of them should stay small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    # A week of article ids is too much state for executor heaps.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Settings that have to be given before the context starts.
STARTUP_CONF = {
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "inkfold", master: str | None = None, **conf: str
) -> SparkSession:
    """A session with the package's settings; ``master`` is left to spark-submit by default."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED_CONF, **STARTUP_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else created."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, as named by ``spark.checkpoint.dir``.

    Where the cluster names none (tests, a laptop) a temporary local folder is
    taken once per session and remembered in the session configuration.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    remembered = spark.conf.get("inkfold.local.folder", None)
    if not remembered:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        remembered = tempfile.mkdtemp(prefix="inkfold-")
        spark.conf.set("inkfold.local.folder", remembered)
    return remembered


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder for one run."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """``DataFrame.checkpoint`` needs a directory; keep the one the cluster has set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the checkpoint folder, where a plan reads it several times."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Plans over it see its true size, so the optimizer itself finds whether it is small
    enough to go to every executor.
    """
    path = run_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
