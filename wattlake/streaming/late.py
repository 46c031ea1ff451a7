"""Late readings (I-02): a side output of what the watermark leaves behind.

Spark drops rows behind a watermark without a trace.  Here a micro-batch is split by the newest event time of the
batches before it: rows older than that by more than the delay go to a table of their own, all others to the target.
The bound of a batch is a small file beside the checkpoint, written once by the batch before, so a retried batch is
split as it was the first time, and both tables are written by day, stream and batch, so nothing is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattlake.schema import StreamTiming
from wattlake.sources import files
from wattlake.streaming.jobs import _trigger, _write_batch


def split_late(batch: DataFrame, newest_before: int | None, delay: str, ts: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """(rows in time, late rows); ``newest_before`` is the newest time of earlier batches in microseconds.

    A row exactly at the bound is in time, as is one without a time and every row of the first batch.
    """
    if newest_before is None:
        return batch, batch.limit(0)
    bound = F.timestamp_micros(F.lit(newest_before)) - F.expr(f"INTERVAL {delay}")
    late = F.coalesce(F.col(ts).cast("timestamp") < bound, F.lit(False))
    return batch.where(~late), batch.where(late)


def sink_with_late_rows(readings: DataFrame, target: str, late_target: str, checkpoint: str,
                        interval: str | None = StreamTiming().aggregate_trigger,
                        delay: str = StreamTiming().watermark, ts: str = "timestamp") -> StreamingQuery:
    """I-02: writes readings that are in time to ``target`` and late ones to ``late_target``, exactly once each.

    Both tables have columns ``event_day``, ``stream`` and ``batch_id``, so late rows are counted per batch by a
    grouped count.
    """
    bounds = f"{checkpoint.rstrip('/')}-newest"

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        known = files.read_text(session, f"{bounds}/{batch_id}")
        before = int(known) if known else None
        seen = Observation()
        rows = batch.observe(seen, F.max(F.unix_micros(F.col(ts).cast("timestamp"))).alias("newest")).persist()
        try:
            in_time, late = split_late(rows, before, delay, ts)
            _write_batch(in_time, batch_id, target, ts)
            _write_batch(late, batch_id, late_target, ts)
        finally:
            rows.unpersist()
        newest = max((time for time in (before, seen.get["newest"]) if time is not None), default=None)
        files.create_once(session, f"{bounds}/{batch_id + 1}", "" if newest is None else str(newest))
        files.delete(session, f"{bounds}/{batch_id - 1}")          # no longer asked for: batches are retried in order

    writer = readings.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()
