"""Readers of the serving table of window aggregates.

The streaming sink appends a new row each time a window is refined, so every
reader first keeps the newest version (largest ``id``) of a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions.numeric import exact_avg, exact_sum, half_up
from wattlake.operators.filters import recent
from wattlake.operators.keyed import first_per_key, top_k

NO_ROWS_VOLTAGE = 231.8  # shown while there are no rows (fixed value)


def latest_version(aggregates: DataFrame) -> DataFrame:
    """E-05: the newest row per window end and building."""
    return first_per_key(aggregates, ["window_end", "building_id"], [F.desc("id")])


def latest_per_building(aggregates: DataFrame, buildings: DataFrame) -> DataFrame:
    """E-04: the newest window of each building with its name and category, by load."""
    newest = first_per_key(aggregates, ["building_id"], [F.desc("window_end"), F.desc("id")])
    names = buildings.select("building_id", "building_name", F.col("category").alias("building_type"))
    return newest.join(names, "building_id", "left").select(
        "id", "window_start", "window_end", "building_id", "building_name", "building_type",
        *[F.col(name).cast("double").alias(name)
          for name in ("avg_power_kw", "avg_voltage_v", "avg_power_factor")]) \
        .orderBy(F.desc_nulls_last("avg_power_kw"), "building_id")


def stream_timeline(aggregates: DataFrame, span: str = "40 minutes", limit: int = 40) -> DataFrame:
    """D-20: campus load, voltage and buildings of the newest ``limit`` windows of the span, oldest first.

    An inclusive span of 40 minutes with a slide of one minute holds 41 windows; the oldest is left out.
    """
    rows = latest_version(recent(aggregates, "window_end", span))
    return rows.groupBy("window_end").agg(
        half_up(exact_sum("avg_power_kw"), 1).alias("total_power_kw"),
        half_up(exact_avg("avg_voltage_v"), 1).alias("avg_voltage_v"),
        F.count("*").alias("active_buildings")).orderBy(F.desc("window_end")).limit(limit).orderBy("window_end")


def live_timeline(aggregates: DataFrame, span: str = "60 minutes") -> DataFrame:
    """D-21: campus load per window over the last hour."""
    rows = latest_version(recent(aggregates, "window_end", span))
    return rows.groupBy("window_end").agg(exact_sum("avg_power_kw").alias("avg_power_kw")) \
        .orderBy("window_end")


def live_window(aggregates: DataFrame) -> DataFrame:
    """D-21: campus load and mean voltage in the newest window."""
    rows = latest_version(recent(aggregates, "window_end", "0 minutes"))
    return rows.agg(
        F.max("window_end").alias("window_end"),
        exact_sum("avg_power_kw").alias("current_load_kw"),
        exact_avg("avg_voltage_v").alias("current_voltage_v"))


def latest_totals(rows: DataFrame) -> DataFrame:
    """D-22: total load and mean voltage over the latest row of each building; a null counts as 0."""
    return rows.agg(
        F.max("window_end").alias("window_end"),
        F.coalesce(half_up(exact_sum("avg_power_kw"), 1), F.lit(0.0)).alias("load_kw"),
        F.coalesce(half_up(exact_avg(F.coalesce("avg_voltage_v", F.lit(0.0))), 1),
                   F.lit(NO_ROWS_VOLTAGE)).alias("voltage_v"),
        F.count("*").alias("active_buildings"))


def top_buildings(rows: DataFrame, k: int = 8) -> DataFrame:
    """D-23: the ``k`` building names with the largest load."""
    peaks = rows.groupBy(F.col("building_name").alias("name")) \
        .agg(half_up(F.max("avg_power_kw"), 1).alias("power"))
    return top_k(peaks, k, "power", ["name"])
