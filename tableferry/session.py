"""Session defaults and the shared folder used for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tableferry")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="tableferry-")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing exists there yet."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, and gives the optimizer the real
    size of the result, so whether a later join broadcasts it is decided from that size.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
