"""Sinks and the streaming queries.

Every query has a checkpoint.  ``foreachBatch`` sinks write the micro-batch into
its own partition, by day, stream and batch, by dynamic overwrite: a batch that is
retried after a failure replaces its earlier attempt instead of adding to it.  The
stream is the query's id, kept in its checkpoint, so a query with a new checkpoint
does not overwrite an old one's batches.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattlake.functions.calendar import add_partitions
from wattlake.operators.alerts import alerts, evaluate
from wattlake.operators.incidents import fault_cards
from wattlake.operators.isolation_forest import IsolationForest, isolation_forest_score, with_features
from wattlake.operators.keyed import day_folders
from wattlake.schema import PARTITION_COLUMNS, SERVING_DECIMALS, AlertLimits, StreamTiming
from wattlake.session import path_exists
from wattlake.sources import files, swaps
from wattlake.sources.lake import lake_files
from wattlake.streaming.windows import flatten_window, sliding_building_averages

JDBC_OPTIONS = {"batchsize": "5000"}


def _trigger(writer, interval: str | None):
    """A processing-time trigger, or, without an interval, all available data and stop (I-03)."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


BATCH_COLUMNS = ("event_day", "stream", "batch_id")


def _stream_of(spark: SparkSession) -> str:
    """The id that the running query keeps in its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def _write_batch(df: DataFrame, batch_id: int, target: str, ts: str = "timestamp") -> None:
    stream = _stream_of(df.sparkSession)
    day = F.to_date(ts) if ts in df.columns else F.lit(None).cast("date")
    (df.withColumns({"written_at": F.unix_micros(F.current_timestamp()), "event_day": day,
                     "stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("bigint")})
     .hint("rebalance", F.col("event_day"))                        # a file per day and batch, unless a day is large
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*BATCH_COLUMNS).parquet(target))


def _as_served(df: DataFrame) -> DataFrame:
    """Measures with the decimal types of the serving tables; what does not fit is null and cannot stop a stream."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in SERVING_DECIMALS.items()
                           if name in df.columns})


def stream_to_lake(readings: DataFrame, path: str, checkpoint: str,
                   interval: str | None = StreamTiming().lake_trigger) -> StreamingQuery:
    """A-08: appends a stream of readings to the lake, exactly once.

    A micro-batch is staged and then moved into its days by one entry of the lake's log, which names the batch: a
    retried batch finds its entry and is not written again.  The lake stays a plain folder of Parquet files, so batch
    writers may append to it and ``compact_lake`` works in place.
    """
    spark = readings.sparkSession
    if path_exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} belongs to a streaming file sink, whose readers see only the files it wrote")

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        name = f"{_stream_of(session)}/{batch_id}"
        if swaps.find_batch(session, path, name) is not None:
            swaps.settle(session, path)
            return
        rows = add_partitions(batch).hint("rebalance", *[F.col(column) for column in PARTITION_COLUMNS])
        staged, moves = swaps.staged_files(session, path, rows, PARTITION_COLUMNS)
        swaps.publish(session, path, staged, moves, batch=name)

    writer = readings.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()


def sink_window_aggregates(averages: DataFrame, target: str, checkpoint: str,
                           interval: str | None = StreamTiming().aggregate_trigger,
                           jdbc: Mapping[str, str] | None = None) -> StreamingQuery:
    """A-09: writes each refinement of a window to the serving table, update mode.

    With ``jdbc`` options the batch goes to a database instead; its driver has to
    be on the class path and a retried batch is then appended again.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = _as_served(flatten_window(batch))
        if jdbc:
            rows.write.format("jdbc").options(**{**JDBC_OPTIONS, **jdbc}).mode("append").save()
        else:
            _write_batch(rows, batch_id, target, "window_end")

    writer = averages.writeStream.outputMode("update").foreachBatch(write) \
        .option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()


def read_window_aggregates(spark: SparkSession, target: str, span: str | None = None) -> DataFrame:
    """The serving table; the time a batch was written is the id by which a newer version wins.

    With a ``span`` (e.g. "40 minutes") only the days are read that can hold windows within that span of the newest
    one: the day folders are named by the windows' end, so the others are pruned.
    """
    rows = swaps.read_settled(spark, target, lambda: spark.read.parquet(target))
    if span is not None:
        days = day_folders(rows)
        if days:
            first = (F.lit(days[0]).cast("timestamp") - F.expr(f"INTERVAL {span}")).cast("date")
            rows = rows.where(F.col("event_day") >= first)
    return rows.withColumnRenamed("written_at", "id").drop("stream", "batch_id")


COMMITS = "_commits"                  # below the readings: one empty file for each batch that is complete
KEPT_COMMITS = 20


def _commit_batch(spark: SparkSession, target: str, batch_id: int) -> None:
    """Makes a batch visible in all tables it was written to."""
    folder = f"{target}/{COMMITS}/{_stream_of(spark)}"
    files.create_once(spark, f"{folder}/{batch_id:012d}", "")
    for name in files.names(spark, folder)[:-KEPT_COMMITS]:
        files.delete(spark, f"{folder}/{name}")


def committed_batches(spark: SparkSession, target: str) -> dict[str, int]:
    """The newest complete batch of each stream; a stream's batches are complete in order."""
    found = {}
    for stream in files.names(spark, f"{target}/{COMMITS}"):
        names = files.names(spark, f"{target}/{COMMITS}/{stream}")
        if names:
            found[stream] = int(names[-1])
    return found


MERGED = "merged"                     # the stream name of folders that hold several streams' or batches' rows


def read_batches(spark: SparkSession, target: str, commits: str | None = None) -> DataFrame:
    """Rows of complete batches; ``commits`` is the readings table of the same sink, if ``target`` is another one.

    Conditions are on partition columns: folders of a batch under way are not read.
    """
    complete = committed_batches(spark, commits or target)
    seen = F.col("stream") == MERGED
    for stream, newest in complete.items():
        seen = seen | ((F.col("stream") == stream) & (F.col("batch_id") <= newest))
    rows = swaps.read_settled(spark, target, lambda: spark.read.parquet(target))
    return rows.where(seen).drop(*BATCH_COLUMNS, "written_at")


def merge_batches(spark: SparkSession, target: str, commits: str | None = None, keep_days: int | None = None) -> int:
    """Merges the folders of complete batches into one per day, and drops days beyond ``keep_days``; days rewritten.

    The folder count is then bounded by the days kept and the batches since the last call.  A day that lies in one
    folder is not written again, however many files its size gave it.  The newest batch of a stream stays as it is, as
    it may still be retried.  Files are swapped by name (see ``swaps``), so a stream may
    go on writing.  Without ``commits`` every stream's batches but its newest count as complete.
    """
    base = swaps.settle(spark, target)
    if keep_days is not None:
        days = sorted((name for name in files.names(spark, target) if name.startswith("event_day=2")), reverse=True)
        for name in days[:1] and [day for day in days if day < _days_before(days[0], keep_days)]:
            files.delete(spark, f"{target}/{name}")
        spark.catalog.refreshByPath(target)
    listed = [(row["path"], *BATCH_FOLDER.search(row["path"]).groups())
              for row in lake_files(spark, target).collect() if BATCH_FOLDER.search(row["path"])]
    newest = {}
    for _, _, stream, batch in listed:
        newest[stream] = max(newest.get(stream, -1), int(batch))
    complete = committed_batches(spark, commits) if commits else newest
    per_day: dict[str, dict[tuple[str, str], list[str]]] = {}
    for path, day, stream, batch in listed:
        if stream == MERGED or int(batch) < min(newest[stream], complete.get(stream, -1)):
            per_day.setdefault(day, {}).setdefault((stream, batch), []).append(path)
    crowded = [path for folders in per_day.values() if len(folders) > 1 for paths in folders.values() for path in paths]
    if crowded:
        rows = spark.read.option("basePath", target).option("mergeSchema", True).parquet(*crowded) \
            .withColumns({"stream": F.lit(MERGED), "batch_id": F.lit(0).cast("bigint")})
        staged, moves = swaps.staged_files(spark, target, rows.hint("rebalance", F.col("event_day")), BATCH_COLUMNS)
        swaps.publish(spark, target, staged, moves, [files.relative(spark, target, path) for path in crowded], base)
    return sum(len(folders) > 1 for folders in per_day.values())


BATCH_FOLDER = re.compile(r"/event_day=([^/]+)/stream=([^/]+)/batch_id=(\d+)/")


def _days_before(folder: str, days: int) -> str:
    newest = dt.date.fromisoformat(folder.partition("=")[2])
    return f"event_day={newest - dt.timedelta(days=days - 1)}"


def sink_readings_and_alerts(readings: DataFrame, readings_target: str, alerts_target: str, checkpoint: str,
                             interval: str | None = StreamTiming().score_trigger,
                             limits: AlertLimits = AlertLimits(), cards_target: str | None = None) -> StreamingQuery:
    """A-10: writes each micro-batch of readings, the alerts it raises and, if asked for, their incident cards.

    A marker written last makes the batch visible in all three tables at once to ``read_batches``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read by all writes
        try:
            raised = alerts(batch, limits)
            _write_batch(_as_served(batch), batch_id, readings_target)
            _write_batch(_as_served(raised), batch_id, alerts_target)
            if cards_target is not None:
                _write_batch(fault_cards(raised), batch_id, cards_target)
            _commit_batch(batch.sparkSession, readings_target, batch_id)
        finally:
            batch.unpersist()

    writer = readings.writeStream.outputMode("append").foreachBatch(write) \
        .option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()


def start_telemetry_queries(readings: DataFrame, serving_target: str, lake_path: str, checkpoints: str,
                            timing: StreamTiming = StreamTiming(),
                            available_now: bool = False) -> tuple[StreamingQuery, StreamingQuery]:
    """I-04: both sinks of one parsed stream, each with its own checkpoint."""
    averages = sliding_building_averages(readings, timing)
    return (
        sink_window_aggregates(averages, serving_target, f"{checkpoints}/aggregates",
                               None if available_now else timing.aggregate_trigger),
        stream_to_lake(readings, lake_path, f"{checkpoints}/lake",
                       None if available_now else timing.lake_trigger))


def score_readings(readings: DataFrame, baselines: DataFrame, model: IsolationForest | None = None) -> DataFrame:
    """I-05, transformation: the verdict on each reading, for a batch or a stream."""
    rows = readings
    if model is not None:
        rows = isolation_forest_score(with_features(rows), model).drop("hour", "day_of_week")
    return evaluate(rows, baselines)


def score_stream(readings: DataFrame, baselines: DataFrame, readings_target: str, alerts_target: str,
                 checkpoint: str, model: IsolationForest | None = None,
                 interval: str | None = StreamTiming().score_trigger, cards_target: str | None = None) -> StreamingQuery:
    """I-05: scores each event and writes readings with their verdict, the alerts, and incident cards of the alerts."""
    scored = score_readings(readings, baselines, model)
    return sink_readings_and_alerts(scored, readings_target, alerts_target, checkpoint, interval, cards_target=cards_target)
