"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "lamina", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings the jobs assume; `conf` adds to them or overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        # Recording the Python line of every column expression takes longer than building the plans.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**defaults, **(conf or {})}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Settings that can be made on a running session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # What a task of a rebalanced write gets. A delivery of some million rows compresses to less than the 64 MB Spark
    # would give one task, which then writes it alone, and alone reads it in every later step.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
    # Folders of partitions are listed in parallel, a few per core.
    listers = 2 * spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(listers))
    return spark


def now() -> datetime:
    """The present in UTC, as Spark takes it with the session time zone set above."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local one only where the cluster names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="lamina-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder in the shared folder, deleted when the application ends."""
    path = f"{shared_folder(spark)}/lamina/{label}-{uuid.uuid4().hex}"
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = handle.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(handle)
    fs.deleteOnExit(handle)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` as a table in the shared folder, for results that several parts of a query read."""
    path = f"{fresh_folder(df.sparkSession, label)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
