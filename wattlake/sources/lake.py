"""The Parquet lake: partitioned by event day, appended to, compacted, described, queried."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from wattlake.functions.calendar import add_partitions
from wattlake.operators.profiles import campus_distincts
from wattlake.schema import PARTITION_COLUMNS, TELEMETRY_COLUMNS
from wattlake.session import path_exists, scratch_dir
from wattlake.sources import files as store
from wattlake.sources import swaps
from wattlake.sources.telemetry import read_telemetry_csv

LAKE_VIEW = "telemetry_lake"


def read_lake(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A-01: all files below ``path``, columns united by name, directories as partition columns.

    Without a schema the footers of all files are merged.  On a large lake pass
    the schema: columns a file lacks are null and no footer is read up front.
    A compaction or a stream's batch is seen whole or not at all.
    """
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    return swaps.read_settled(spark, path, lambda: reader.parquet(path))


def _sized_for_files(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of a partition directory together, in tasks of AQE's advisory size.

    A small day becomes one file.  A large day is split over many tasks rather
    than passing through one, which a ``repartition`` on the day would do.
    """
    return df.hint("rebalance", *[F.col(name) for name in columns])


def write_lake(df: DataFrame, path: str, mode: str = "append") -> int:
    """A-06: appends rows below year=/month=/day= as Snappy Parquet; returns the number of rows written."""
    if isinstance(df.schema["timestamp"].dataType, StringType):
        df = df.withColumn("timestamp", F.to_timestamp_ntz("timestamp"))
    written = Observation()
    rows = add_partitions(df).observe(written, F.count(F.lit(1)).alias("rows"))
    (_sized_for_files(rows, PARTITION_COLUMNS)
     .write.partitionBy(*PARTITION_COLUMNS).option("compression", "snappy").mode(mode).parquet(path))
    return int(written.get["rows"])


def hydrate_lake_from_csv(spark: SparkSession, csv_path: str, path: str) -> int:
    """A-07: loads CSV readings into the lake."""
    return write_lake(read_telemetry_csv(spark, csv_path, calendar=False).select(*TELEMETRY_COLUMNS), path)


def lake_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and partition directory of each Parquet file, from the listing alone."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("bytes")))
    return files.withColumn("partition", F.regexp_extract("path", r"((?:[^/=]+=[^/]+/)*[^/=]+=[^/]+)/[^/]+$", 1))


METADATA = ("exists boolean, total_files bigint, total_size_mb double, partitions array<string>, "
            "total_records bigint, min_timestamp timestamp_ntz, max_timestamp timestamp_ntz, "
            "meters_count bigint, buildings_count bigint")


def _no_rows(spark: SparkSession, exists: bool) -> DataFrame:
    return spark.createDataFrame([(exists, 0, 0.0, [], 0, None, None, 0, 0)], METADATA)


def lake_metadata(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A-14: one row with files, size, partitions, rows, time range, meters and buildings.

    A missing and an empty lake give a row of zeros.
    """
    if not path_exists(spark, path):
        return _no_rows(spark, exists=False)
    files = lake_files(spark, path)
    if files.isEmpty():
        return _no_rows(spark, exists=True)
    stats = campus_distincts(read_lake(spark, path, schema)).withColumns({
        name: F.col(name).cast("timestamp_ntz") for name in ("min_timestamp", "max_timestamp")})
    listing = files.agg(
        F.count("*").alias("total_files"),
        F.round(F.sum("bytes") / (1024 * 1024), 2).alias("total_size_mb"),
        F.sort_array(F.collect_set(F.when(F.col("partition") != "", F.col("partition")))).alias("partitions"))
    return listing.select(F.lit(True).alias("exists"), "*", stats.select(F.struct("*")).scalar().alias("s")) \
        .select("exists", "total_files", "total_size_mb", "partitions", "s.*")


REPORT_COLUMNS = ("partition", "status", "files_before", "files_after", "bytes_before", "bytes_after")


def _per_partition(files: DataFrame) -> DataFrame:
    return files.groupBy("partition").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def _written_by_file_sink(spark: SparkSession, path: str) -> bool:
    """Whether a streaming file sink keeps its log of valid files in this folder."""
    return path_exists(spark, f"{path}/_spark_metadata")


def _day(name: str) -> Column:
    return F.regexp_extract("partition", rf"(?:^|/){name}=([^/]+)", 1).try_cast("int")


SMALL_FILE = 96 << 20        # files from this size on are left as they are
STALE_HOURS = 24             # age from which a staged copy belongs to a job that died
ROUNDS = 3                   # times that days are listed again for files that came meanwhile
SWAP_FILES = 20_000          # files that one swap replaces


def _crowded_days(spark: SparkSession, path: str, min_files: int) -> DataFrame:
    """(partition, files): the small files of each day that has at least ``min_files`` of them."""
    is_day = _day("year").isNotNull() & _day("month").isNotNull() & _day("day").isNotNull()
    return lake_files(spark, path).where(is_day & (F.col("bytes") < SMALL_FILE)).groupBy("partition") \
        .agg(F.sort_array(F.collect_list("path")).alias("files")).where(F.size("files") >= max(2, min_files))


def _compact_once(spark: SparkSession, path: str, min_files: int) -> bool:
    """Merges the small files of the crowded days, some days at a time; whether there were any."""
    listing = scratch_dir(spark, "compact-listing")
    base = swaps.settle(spark, path)
    _crowded_days(spark, path, min_files).write.parquet(listing)

    def swap(days: list) -> None:
        named = [name for day in days for name in day["files"]]
        rows = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*named)
        staged, moves = swaps.staged_files(spark, path, _sized_for_files(rows, PARTITION_COLUMNS), PARTITION_COLUMNS)
        try:
            swaps.publish(spark, path, staged, moves, [store.relative(spark, path, name) for name in named], base)
        except swaps.Refused:
            pass                                  # another compaction merged them; the next round lists again

    waiting, held, found = [], 0, False
    for day in spark.read.parquet(listing).toLocalIterator():
        if waiting and held + len(day["files"]) > SWAP_FILES:
            swap(waiting)
            waiting, held = [], 0
        waiting.append(day)
        held, found = held + len(day["files"]), True
    if waiting:
        swap(waiting)
    return found


def compact_lake(spark: SparkSession, path: str, min_files: int = 2, into: str | None = None) -> DataFrame:
    """A-13: merges the small files of every day that has at least ``min_files``; returns a row per day.

    Writers may go on.  The files that are merged are listed once, their rows are staged, and then exactly these files
    are replaced (see ``swaps``): what others add meanwhile stays, and a day that grew is listed again, ``ROUNDS``
    times at most.  Of two compactions of the same files one is refused and changes nothing.  A compaction that dies
    leaves the old files, or a decided swap that the next reader or writer finishes; what it staged goes after a day.  Other days are not touched, and
    files of a good size stay as they are, so that a large day is not written again each time.

    With ``into`` the compacted lake is written to that new folder and ``path`` stays as it is: for a folder that
    Spark's streaming file sink writes, whose own log names its files.
    """
    if into is None and _written_by_file_sink(spark, path):
        raise ValueError(f"{path} belongs to a streaming file sink; name a new folder with into=")
    if into is None:
        swaps.settle(spark, path)
    listed = scratch_dir(spark, "compact-before")
    per_day = _per_partition(lake_files(spark, path)).select(
        "partition", F.col("files").alias("files_before"), F.col("bytes").alias("bytes_before"))
    crowded = _crowded_days(spark, path, min_files).select("partition", F.lit(True).alias("crowded"))
    per_day.join(crowded, "partition", "left") \
        .withColumn("status", F.when(F.col("crowded"), "COMPACTED").otherwise("SKIPPED")).drop("crowded").write.parquet(listed)
    if into is not None:
        _sized_for_files(read_lake(spark, path), PARTITION_COLUMNS) \
            .write.partitionBy(*PARTITION_COLUMNS).parquet(into)
    else:
        for _ in range(ROUNDS):
            if not _compact_once(spark, path, min_files):
                break
        store.drop_older(spark, f"{path}/{swaps.STAGED}", STALE_HOURS)
        spark.catalog.refreshByPath(path)
    after = _per_partition(lake_files(spark, into or path)) \
        .select("partition", F.col("files").alias("files_after"), F.col("bytes").alias("bytes_after"))
    return spark.read.parquet(listed).join(after, "partition", "left").select(*REPORT_COLUMNS)


def compaction_totals(report: DataFrame) -> DataFrame:
    """A-13: the totals of a compaction report."""
    done = F.col("status") == "COMPACTED"
    return report.agg(
        F.count("*").alias("partitions_checked"), F.count_if(done).alias("partitions_compacted"),
        F.coalesce(F.sum(F.when(done, F.col("files_before"))), F.lit(0)).alias("total_files_before"),
        F.coalesce(F.sum(F.when(done, F.col("files_after"))), F.lit(0)).alias("total_files_after"),
        F.coalesce(F.sum(F.when(done, F.col("bytes_before") - F.col("bytes_after"))), F.lit(0))
        .alias("total_bytes_saved"))


def query_lake(rows: DataFrame, sql: str, args: Mapping[str, Any] | None = None,
               view: str = LAKE_VIEW) -> DataFrame:
    """A-15: any SQL over the rows of the lake, or of a snapshot, under the name ``view``.

    Values go in as named arguments (``:name``), not into the text.
    """
    rows.createOrReplaceTempView(view)
    return rows.sparkSession.sql(sql, args=dict(args or {}))
