"""Session construction and the scratch folder used by jobs that write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "wattlake", master: str | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on.

    Times are UTC.  Join strategy and partition counts are left to AQE: it sees
    measured sizes, so a dimension is broadcast only while it is small and a
    skewed join partition is split.  ``conf`` entries override the defaults
    (use ``__`` for dots: ``spark__sql__shuffle__partitions="8"``).
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for staged tables and stream checkpoints.

    The cluster names a shared folder in ``spark.checkpoint.dir``.  Only a local
    session without that setting falls back to a temporary folder, because on a
    cluster the executors would not see each other's files there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="wattlake-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists in the file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a derived table to the scratch folder and reads it back.

    For tables that several branches of a plan read, or that another table is
    joined with: the lineage is cut, and the size of the files tells Spark whether
    the table may be broadcast.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
