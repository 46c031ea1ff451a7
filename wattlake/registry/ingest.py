"""Readings as they come in: JSON messages on a stream, CSV files, catalogs."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from wattlake import fixtures as fx
from wattlake.operators import live, profiles
from wattlake.registry.base import register
from wattlake.registry.profiles import NINE
from wattlake.schema import TELEMETRY_COLUMNS
from wattlake.session import scratch_dir, stored
from wattlake.sources import dimensions, files, lake, serving
from wattlake.sources.telemetry import parse_telemetry, read_telemetry_csv, telemetry_stream
from wattlake.streaming import jobs
from wattlake.streaming.windows import sliding_building_averages

RAW = NINE.replace("timestamp", "raw_ts AS timestamp")
WHOLE = " AND ".join(f"{name} IS NOT NULL" for name in TELEMETRY_COLUMNS)
STAMP = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def messages(spark, sf_dir) -> str:
    """A folder of JSON lines, written in two parts; one in fifty readings is followed by a line that is cut off."""
    folder = scratch_dir(spark, "messages")
    rows = fx.telemetry(spark, sf_dir).withColumn("timestamp", F.col("raw_ts").cast("timestamp"))
    text = F.to_json(F.struct(*TELEMETRY_COLUMNS), STAMP)
    broken = F.when(F.col("event_id").endswith("50"), F.substring(text, 1, 12))
    lines = rows.select("event_id", F.explode(F.array_compact(F.array(text, broken))).alias("value"))
    early = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    for part in (early, ~early):
        lines.where(part).select("value").write.mode("append").text(folder)
    return folder


BATCHES = 8                            # micro-batches that a folder of messages makes at most


def message_stream(spark, sf_dir, batches: int | None = None):
    """The messages as a stream; with ``batches`` in so many micro-batches at most, of one file each if there are few.

    The number of files follows the tasks that wrote them.  With a batch for each, the work that a batch has besides its
    rows, such as reading all baselines, would grow with the square of the table.
    """
    folder = messages(spark, sf_dir)
    if batches is None:
        return parse_telemetry(telemetry_stream(spark, "text", path=folder))
    written = sum(name.startswith("part-") for name in files.names(spark, folder))
    options = {"maxFilesPerTrigger": str(max(1, math.ceil(written / batches)))}
    return parse_telemetry(telemetry_stream(spark, "text", options, folder))


@register("json_stream_averages", "SELECT * FROM sliding")
def _(spark, sf_dir):
    folder = scratch_dir(spark, "json-averages")
    averages = sliding_building_averages(message_stream(spark, sf_dir))
    jobs.sink_window_aggregates(averages, f"{folder}/serving", f"{folder}/checkpoint", None).awaitTermination()
    rows = live.latest_version(jobs.read_window_aggregates(spark, f"{folder}/serving")).drop("id")
    return rows.select(
        *[F.col(name).cast("timestamp_ntz").alias(name) for name in ("window_start", "window_end")], "building_id",
        *[F.col(f"avg_{name}").cast("double").alias(f"avg_{name}") for name in ("power_kw", "voltage_v", "power_factor")])


@register("json_stream_lake", f"SELECT {RAW} FROM telemetry")
def _(spark, sf_dir):
    folder = scratch_dir(spark, "json-lake")
    jobs.stream_to_lake(message_stream(spark, sf_dir, BATCHES), f"{folder}/lake", f"{folder}/checkpoint",
                        None).awaitTermination()
    return lake.read_lake(spark, f"{folder}/lake").select(*TELEMETRY_COLUMNS) \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@register("json_stream_alerts", "SELECT event_id, meter_id, alert_type, severity, description FROM alert_rows")
def _(spark, sf_dir):
    folder = scratch_dir(spark, "json-alerts")
    baselines = stored(profiles.meter_baselines(fx.readings(spark, sf_dir)), "baselines")
    jobs.score_stream(message_stream(spark, sf_dir, BATCHES), baselines, f"{folder}/readings",
                      f"{folder}/alerts", f"{folder}/checkpoint", interval=None).awaitTermination()
    return spark.read.parquet(f"{folder}/alerts").select("event_id", "meter_id", "alert_type", "severity", "description")


@register("csv_round_trip", f"SELECT {NINE} FROM telemetry WHERE {WHOLE}")
def _(spark, sf_dir):
    folder = scratch_dir(spark, "csv")
    serving.write_processed_csv(fx.readings(spark, sf_dir).select(*TELEMETRY_COLUMNS), folder)
    return read_telemetry_csv(spark, folder, calendar=False).select(*TELEMETRY_COLUMNS)


@register("hydrated_lake", f"SELECT {NINE} FROM telemetry WHERE {WHOLE}")
def _(spark, sf_dir):
    folder = scratch_dir(spark, "hydrate")
    serving.write_processed_csv(fx.readings(spark, sf_dir).select(*TELEMETRY_COLUMNS), f"{folder}/csv", derive=False)
    lake.hydrate_lake_from_csv(spark, f"{folder}/csv", f"{folder}/lake")
    return lake.read_lake(spark, f"{folder}/lake").select(*TELEMETRY_COLUMNS)


@register("dimensions", "SELECT m.*, b.building_name, b.category, b.zone, b.peak_capacity_kw "
                        "FROM meters m JOIN buildings b ON m.building_id = b.building_id")
def _(spark, sf_dir):
    folder = scratch_dir(spark, "catalogs")
    for name, rows in (("buildings", fx.buildings(spark, sf_dir)), ("meters", fx.meters(spark, sf_dir))):
        rows.write.option("header", True).csv(f"{folder}/{name}")
    buildings, meters = dimensions.read_dimensions(spark, f"{folder}/buildings", f"{folder}/meters")
    return meters.join(buildings, "building_id")
