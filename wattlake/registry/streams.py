"""Streaming jobs run to completion over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake import fixtures as fx
from wattlake.functions.numeric import exact_sum, half_up
from wattlake.operators import live, profiles
from wattlake.operators.isolation_forest import isolation_forest_fit, with_features
from wattlake.registry.base import register, rnd, total
from wattlake.registry.detection import EVALUATE, FAULT_CARDS, GIVEN_SCORES, given_forest
from wattlake.registry.profiles import NINE
from wattlake.schema import TELEMETRY_COLUMNS
from wattlake.session import scratch_dir, stored
from wattlake.sources import lake
from wattlake.streaming import jobs
from wattlake.streaming.late import sink_with_late_rows
from wattlake.streaming.windows import sliding_building_averages


def event_stream(spark, sf_dir):
    """The events table as a stream of readings; the event time is the exact one."""
    # a pattern, because the table may be one file or a folder of files
    events = spark.readStream.schema(fx.table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parque[t]")
    rows = fx.telemetry_from(events, spark, sf_dir)
    return rows.withColumn("timestamp", F.col("raw_ts").cast("timestamp")).drop("raw_ts")


@register("streamed_building_averages", "SELECT * FROM sliding")
def _(spark, sf_dir):
    folder = scratch_dir(spark, "stream-averages")
    averages = sliding_building_averages(event_stream(spark, sf_dir))
    jobs.sink_window_aggregates(averages, f"{folder}/serving", f"{folder}/checkpoint", None).awaitTermination()
    rows = live.latest_version(jobs.read_window_aggregates(spark, f"{folder}/serving")).drop("id")
    return rows.select(
        *[F.col(name).cast("timestamp_ntz").alias(name) for name in ("window_start", "window_end")], "building_id",
        *[F.col(f"avg_{name}").cast("double").alias(f"avg_{name}") for name in ("power_kw", "voltage_v", "power_factor")])


@register("streamed_lake", f"SELECT {NINE.replace('timestamp', 'raw_ts AS timestamp')} FROM telemetry")
def _(spark, sf_dir):
    folder = scratch_dir(spark, "stream-lake")
    jobs.stream_to_lake(event_stream(spark, sf_dir), f"{folder}/lake", f"{folder}/checkpoint", None).awaitTermination()
    rows = lake.read_lake(spark, f"{folder}/lake").select(*TELEMETRY_COLUMNS)
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@register("streamed_alerts", "SELECT event_id, meter_id, alert_type, severity, description FROM alert_rows")
def _(spark, sf_dir):
    folder = scratch_dir(spark, "stream-alerts")
    baselines = stored(profiles.meter_baselines(fx.readings(spark, sf_dir)), "baselines")
    model = isolation_forest_fit(with_features(fx.readings(spark, sf_dir)))
    jobs.score_stream(event_stream(spark, sf_dir), baselines, f"{folder}/readings", f"{folder}/alerts",
                      f"{folder}/checkpoint", model, interval=None).awaitTermination()
    rows = spark.read.parquet(f"{folder}/alerts")
    return rows.select("event_id", "meter_id", "alert_type", "severity", "description")


def part_of_stream():
    """Three parts of the readings that come one after another; the last brings some of the days of the first two."""
    day, event = F.dayofmonth("timestamp"), F.col("event_id")
    return F.when((day <= 10) & ~event.endswith("7"), 1).when((day > 10) & (day <= 20) & ~event.endswith("3"), 2).otherwise(3)


PARTS = """
    SELECT *, CASE WHEN day(raw_ts) <= 10 AND event_id NOT LIKE '%7' THEN 1
                   WHEN day(raw_ts) BETWEEN 11 AND 20 AND event_id NOT LIKE '%3' THEN 2 ELSE 3 END AS part FROM telemetry"""


def in_three_batches(spark, sf_dir, folder: str, start):
    """Starts a query three times over a file stream that each time has got another part of the readings; the stream.

    A start takes all files that are new, as one micro-batch, so that a part may be written by many tasks and read by
    many: one file for each part would be the work of one task, however large the table is.  Rows are dealt by event,
    because those of a part may lie in few splits of the table.
    """
    rows = fx.telemetry(spark, sf_dir).withColumn("timestamp", F.col("raw_ts").cast("timestamp")).select(*TELEMETRY_COLUMNS)
    for part in (1, 2, 3):
        rows.where(part_of_stream() == part).repartition("event_id").write.mode("append").parquet(f"{folder}/in")
        readings = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        start(readings).awaitTermination()
    return readings


@register("late_readings", f"""
    SELECT event_id, part - 1 AS batch_id, COALESCE(raw_ts < bound, FALSE) AS late
    FROM (WITH parts AS ({PARTS} ), ends AS (SELECT part, MAX(raw_ts) AS newest FROM parts GROUP BY part)
          SELECT p.event_id, p.part::BIGINT AS part, p.raw_ts, b.bound FROM parts p JOIN
                (SELECT o.part, MAX(e.newest) - INTERVAL '5' DAY AS bound FROM ends o LEFT JOIN ends e ON e.part < o.part
                 GROUP BY o.part) b ON p.part = b.part)""")
def _(spark, sf_dir):
    """Which readings of a stream are behind its watermark, and in which batch they came."""
    folder = scratch_dir(spark, "stream-late")
    in_three_batches(spark, sf_dir, folder, lambda readings: sink_with_late_rows(
        readings, f"{folder}/kept", f"{folder}/late", f"{folder}/checkpoint", None, "5 DAYS"))
    return spark.read.parquet(f"{folder}/kept").withColumn("late", F.lit(False)) \
        .unionByName(spark.read.parquet(f"{folder}/late").withColumn("late", F.lit(True))) \
        .select("event_id", F.col("batch_id").cast("bigint").alias("batch_id"), "late")


@register("streamed_lake_compacted", f"SELECT {NINE.replace('timestamp', 'raw_ts AS timestamp')} FROM telemetry")
def _(spark, sf_dir):
    """A lake that a stream writes in three batches, compacted in place, and the stream restarted."""
    folder = scratch_dir(spark, "stream-compact")

    def start(readings):
        return jobs.stream_to_lake(readings, f"{folder}/lake", f"{folder}/checkpoint", None)

    readings = in_three_batches(spark, sf_dir, folder, start)
    lake.compact_lake(spark, f"{folder}/lake")
    start(readings).awaitTermination()
    return lake.read_lake(spark, f"{folder}/lake").select(*TELEMETRY_COLUMNS) \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def scored(spark, sf_dir) -> str:
    """The folder of a scored stream of three batches, with the given trees as model."""
    folder = scratch_dir(spark, "stream-verdicts")
    baselines = stored(profiles.meter_baselines(fx.readings(spark, sf_dir)), "baselines")
    forest = given_forest(spark)
    in_three_batches(spark, sf_dir, folder, lambda readings: jobs.score_stream(
        readings, baselines, f"{folder}/readings", f"{folder}/alerts", f"{folder}/checkpoint", forest, None, f"{folder}/cards"))
    return folder


@register("streamed_verdicts", f"""
    SELECT event_id, g.ml_anomaly, ROUND(COALESCE(g.anomaly_score, 0.0::DOUBLE), 4) + 0.0::DOUBLE AS anomaly_score, e.z_score,
           e.is_anomaly OR g.ml_anomaly AS is_anomaly
    FROM ({EVALUATE}) e JOIN ({GIVEN_SCORES.replace('score, 6', 'score, 8')}) g USING (event_id)""")
def _(spark, sf_dir):
    folder = scored(spark, sf_dir)
    return jobs.read_batches(spark, f"{folder}/readings") \
        .select("event_id", "ml_anomaly", "anomaly_score", "z_score", "is_anomaly")


@register("streamed_fault_cards", FAULT_CARDS)
def _(spark, sf_dir):
    """The cards of a scored stream, after its batch folders have been merged."""
    folder = scored(spark, sf_dir)
    jobs.merge_batches(spark, f"{folder}/cards", f"{folder}/readings")
    return jobs.read_batches(spark, f"{folder}/cards", f"{folder}/readings") \
        .select("event_id", "event_type", "title", "color", "summary")


@register("two_sinks", f"""
    SELECT 'lake' AS sink, COUNT(*) AS records, {rnd(total('power_kw'), 2)} AS total_kw FROM telemetry
    UNION ALL SELECT 'averages', COUNT(*), {rnd(total('avg_power_kw'), 2)} FROM sliding""")
def _(spark, sf_dir):
    """One parsed stream into the serving table and into the lake."""
    folder = scratch_dir(spark, "two-sinks")
    for query in jobs.start_telemetry_queries(event_stream(spark, sf_dir), f"{folder}/serving", f"{folder}/lake",
                                              f"{folder}/checkpoints", available_now=True):
        query.awaitTermination()
    current = live.latest_version(jobs.read_window_aggregates(spark, f"{folder}/serving"))
    return lake.read_lake(spark, f"{folder}/lake").select(F.lit("lake").alias("sink"), F.col("power_kw").alias("kw")) \
        .unionByName(current.select(F.lit("averages").alias("sink"), F.col("avg_power_kw").alias("kw"))) \
        .groupBy("sink").agg(F.count("*").alias("records"), half_up(exact_sum("kw"), 2).alias("total_kw"))
