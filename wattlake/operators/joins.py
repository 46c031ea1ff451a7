"""Joins with the building and meter catalogs.

No side carries a broadcast hint.  The catalogs grow with the fleet, so the
choice is Spark's: it broadcasts a catalog whose measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, where AQE
splits the partition of a building that holds a large share of the readings.  The
catalogs are joined one after the other, because the planner knows the size of a
stored table but overestimates that of a join between two of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.operators.keyed import EVENT_DAY, newest_first
from wattlake.schema import MEASURES, PARTITION_COLUMNS, ScoreDefaults, SilverRules


def _star(facts: DataFrame, meters: DataFrame, buildings: DataFrame) -> DataFrame:
    """Facts with the building of their meter; rows without a match are dropped."""
    names = buildings.select("building_id", "building_name", F.col("category").alias("building_type"))
    return facts.drop("building_id", "building_type", "building_name") \
        .join(meters.select("meter_id", "building_id"), "meter_id", "inner").join(names, "building_id", "inner")


DAY_COLUMNS = (*PARTITION_COLUMNS, EVENT_DAY)


def _days_of(df: DataFrame) -> list[str]:
    """Columns of the folders a fact table lies in: with them its newest rows are found without reading older days."""
    return [name for name in DAY_COLUMNS if name in df.columns]


def star_rows(readings: DataFrame, meters: DataFrame, buildings: DataFrame) -> DataFrame:
    """Readings joined with meter and building, metrics as doubles, in no order."""
    metrics = [F.col(name).cast("double").alias(name) for name in MEASURES]
    return _star(readings, meters, buildings).select(
        "event_id", "timestamp", "meter_id", "building_id", "building_type", "building_name", *metrics,
        *_days_of(readings))


def readings_star(readings: DataFrame, meters: DataFrame, buildings: DataFrame,
                  limit: int = 25_000) -> DataFrame:
    """C-01: readings with meter and building, newest first."""
    return newest_first(star_rows(readings, meters, buildings), limit).drop(*DAY_COLUMNS)


def alerts_star(alerts: DataFrame, meters: DataFrame, buildings: DataFrame,
                limit: int = 500) -> DataFrame:
    """C-02: alerts with meter and building, newest first."""
    rows = _star(alerts, meters, buildings).select(
        "event_id", "timestamp", "meter_id", "building_id", "building_type", "alert_type", "severity",
        F.col("metric_value").cast("double").alias("metric_value"),
        F.col("threshold_value").cast("double").alias("threshold_value"), "description", *_days_of(alerts))
    return newest_first(rows, limit, tiebreak=("event_id", "alert_type")).drop(*DAY_COLUMNS)


def aggregates_star(aggregates: DataFrame, buildings: DataFrame, limit: int = 1_000) -> DataFrame:
    """C-03: window aggregates with building name and category, newest windows first."""
    names = buildings.select("building_id", "building_name", F.col("category").alias("building_type"))
    rows = aggregates.join(names, "building_id", "inner").select(
        "id", "window_start", "window_end", "building_id", "building_name", "building_type",
        *[F.col(name).cast("double").alias(name)
          for name in ("avg_power_kw", "avg_voltage_v", "avg_power_factor")], *_days_of(aggregates))
    return newest_first(rows, limit, ts="window_end", tiebreak=("building_id", "id")).drop(*DAY_COLUMNS)


def enrich_left(df: DataFrame, buildings: DataFrame, meters: DataFrame,
                rules: SilverRules = SilverRules()) -> DataFrame:
    """C-04: left join with both catalogs; misses get the default names."""
    building = buildings.select(
        "building_id", F.col("building_name").alias("_name"), F.col("category").alias("_category"),
        F.col("zone").alias("_zone"), F.col("peak_capacity_kw").alias("_capacity"))
    meter = meters.select("meter_id", F.col("meter_type").alias("_meter_type"))
    joined = df.join(building, "building_id", "left").join(meter, "meter_id", "left")
    return joined.withColumns({
        "building_name": F.coalesce("_name", "building_id"),
        "category": F.coalesce(F.col("_category"), F.col("building_type"), F.lit(rules.default_category)),
        "zone": F.coalesce(F.col("_zone"), F.lit(rules.default_zone)),
        "building_capacity_kw": F.coalesce(F.col("_capacity"), F.lit(rules.default_capacity_kw)),
        "meter_type": F.coalesce(F.col("_meter_type"), F.lit(rules.default_meter_type)),
    }).drop("_name", "_category", "_zone", "_capacity", "_meter_type")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """C-05: child rows whose non-null key has no parent."""
    known = parent.select(F.col(parent_key or key).alias(key)).where(F.col(key).isNotNull()).distinct()
    return child.where(F.col(key).isNotNull()).join(known, key, "left_anti")


def baseline_lookup(readings: DataFrame, baselines: DataFrame,
                    defaults: ScoreDefaults = ScoreDefaults()) -> DataFrame:
    """C-07: mean and deviation of the reading's meter; an unknown meter gets the default pair.

    Works on a batch or, as a stream-static join, on a stream.  Pass stored
    baselines: their size is then known, so a small table is broadcast, and with a
    large one AQE can split the partition of a meter with very many readings.
    """
    known = baselines.select("meter_id", F.lit(True).alias("_known"), "mean_kw", "std_kw")
    joined = readings.join(known, "meter_id", "left")
    return joined.withColumns({
        "mean_kw": F.when(F.col("_known"), F.col("mean_kw")).otherwise(F.lit(defaults.unknown_mean_kw)),
        "std_kw": F.when(F.col("_known"), F.col("std_kw")).otherwise(F.lit(defaults.unknown_std_kw)),
    }).drop("_known")
