"""Descriptive aggregates over readings.

Where a result counts distinct meters and buildings together, the rows are first
aggregated per meter.  That pass combines before its shuffle, so no hot group
reaches one task, and the distinct counts then run over meters instead of over
readings (Spark would otherwise expand every reading once per distinct column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.calendar import add_calendar, hour_start
from wattlake.functions.electrical import above, below
from wattlake.functions.numeric import (count_numbers, exact_avg, exact_sum, from_units, half_up, mean_from, sum_units,
                                         total_units)
from wattlake.operators.filters import at_latest
from wattlake.operators.keyed import latest_per_meter
from wattlake.schema import MEASURES, AlertLimits

READING_MINUTES = 15.0


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose grouping keys are all present; the others belong to no group."""
    return df.dropna("any", subset=list(keys))


def _cells(df: DataFrame, keys: Sequence[str], measures: Sequence[str] = MEASURES) -> DataFrame:
    """Sums, counts and extremes per combination of ``keys``, from which coarser groups follow."""
    parts = [F.count("*").alias("n_rows"), F.count("event_id").alias("n_events"),
             F.max("power_kw").alias("power_max"), F.min("power_kw").alias("power_min")]
    for name in measures:
        parts += [sum_units(name).alias(f"{name}_units"), count_numbers(name).alias(f"{name}_count")]
    return df.groupBy(*keys).agg(*parts)


def _mean(name: str) -> Column:
    return mean_from(total_units(f"{name}_units"), F.sum(f"{name}_count"))


def _total(name: str) -> Column:
    return from_units(total_units(f"{name}_units"))


def _summary(cells: DataFrame, keys: Sequence[str], *extra: Column, total: bool = True) -> DataFrame:
    columns = [half_up(_total("power_kw"), 2).alias("total_energy_kw_sum")] if total else []
    columns += [
        half_up(_mean("power_kw"), 2).alias("avg_power_kw"),
        half_up(F.max("power_max"), 2).alias("peak_power_kw"),
        half_up(_mean("voltage_v"), 2).alias("avg_voltage_v"),
        half_up(_mean("current_a"), 2).alias("avg_current_a"),
        half_up(_mean("power_factor"), 3).alias("avg_power_factor"),
        *extra,
        F.sum("n_events").alias("reading_count"),
    ]
    return cells.groupBy(*keys).agg(*columns)


def building_summary(df: DataFrame) -> DataFrame:
    """D-07: load, voltage, current and power factor per building, by mean load."""
    keys = ["building_id", "building_type"]
    cells = _cells(_keyed(df, keys), [*keys, "meter_id"])
    return _summary(cells, keys, F.count("meter_id").alias("meter_count")) \
        .orderBy(F.desc("avg_power_kw"), *keys)


def meter_summary(df: DataFrame) -> DataFrame:
    """D-08: the same per meter."""
    keys = ["meter_id", "building_id", "building_type"]
    return _summary(_cells(_keyed(df, keys), keys), keys, total=False) \
        .orderBy(F.desc("avg_power_kw"), *keys)


def category_summary(df: DataFrame) -> DataFrame:
    """D-09: the same per category, with distinct buildings and meters, by total load."""
    cells = _cells(_keyed(df, ["building_type"]), ["building_type", "building_id", "meter_id"])
    return _summary(cells, ["building_type"],
                    F.count_distinct("building_id").alias("building_count"),
                    F.count_distinct("meter_id").alias("meter_count")) \
        .orderBy(F.desc("total_energy_kw_sum"), "building_type")


def building_energy(df: DataFrame, reading_minutes: float = READING_MINUTES) -> DataFrame:
    """D-05: meters, mean, peak and estimated kWh per building, by mean load."""
    cells = _cells(df, ["building_id", "building_type", "meter_id"], ["power_kw"])
    return cells.groupBy("building_id", "building_type").agg(
        F.count("meter_id").alias("meter_count"),
        half_up(_mean("power_kw"), 2).alias("avg_power_kw"),
        half_up(F.max("power_max"), 2).alias("max_power_kw"),
        half_up(_total("power_kw") * (reading_minutes / 60.0), 2).alias("est_total_kwh"),
        F.sum("n_rows").alias("total_readings")) \
        .orderBy(F.desc_nulls_last("avg_power_kw"), "building_id", "building_type")


def hourly_profile_lake(df: DataFrame, building_id: str | None = None,
                        building_type: str | None = None) -> DataFrame:
    """D-04: mean, min and max per hour of day, for one building or category or all."""
    if building_id and building_id != "All":
        df = df.where(F.col("building_id") == building_id)
    if building_type and building_type != "All":
        df = df.where(F.col("building_type") == building_type)
    return df.groupBy(F.hour("timestamp").cast("bigint").alias("hour")).agg(
        half_up(exact_avg("power_kw"), 2).alias("avg_power_kw"),
        half_up(F.min("power_kw"), 2).alias("min_power_kw"),
        half_up(F.max("power_kw"), 2).alias("max_power_kw"),
        half_up(exact_avg("voltage_v"), 2).alias("avg_voltage_v"),
        half_up(exact_avg("power_factor"), 3).alias("avg_power_factor"),
        F.count("*").alias("reading_count")).orderBy("hour")


def hourly_profile(df: DataFrame, by_category: bool = True) -> DataFrame:
    """D-11: mean and total load and mean voltage per hour of day, optionally per category."""
    keys = ["hour", "building_type"] if by_category else ["hour"]
    return _keyed(add_calendar(df), keys).groupBy(*keys).agg(
        half_up(exact_avg("power_kw"), 2).alias("avg_power_kw"),
        exact_sum("power_kw").alias("total_power_kw"),
        exact_avg("voltage_v").alias("avg_voltage_v")).orderBy(*keys)


def day_of_week_profile(df: DataFrame) -> DataFrame:
    """D-12: mean and total load per day of week and category, Monday first."""
    keys = ["day_name", "day_of_week", "building_type"]
    return _keyed(add_calendar(df), keys).groupBy(*keys).agg(
        exact_avg("power_kw").alias("avg_power_kw"),
        exact_sum("power_kw").alias("total_power_kw")).orderBy("day_of_week", "building_type")


def weekday_weekend(df: DataFrame) -> DataFrame:
    """D-13: mean, peak and count per day type and category."""
    keys = ["day_type", "building_type"]
    return _keyed(add_calendar(df), keys).groupBy(*keys).agg(
        half_up(exact_avg("power_kw"), 2).alias("avg_power_kw"),
        half_up(F.max("power_kw"), 2).alias("peak_power_kw"),
        F.count("event_id").alias("reading_count")).orderBy(*keys)


def building_week(df: DataFrame, building: str) -> DataFrame:
    """D-18: mean and peak per day of week of one building."""
    keys = ["day_name", "day_of_week"]
    rows = add_calendar(df.where(F.col("building_id") == building))
    return rows.groupBy(*keys).agg(
        exact_avg("power_kw").alias("avg_power_kw"),
        F.max("power_kw").alias("peak_power_kw")).orderBy("day_of_week")


# Resampling frequencies offered to users (fixed values).
FREQUENCIES = {"15min": "15 minutes", "30min": "30 minutes", "1h": "1 hour", "3h": "3 hours", "1D": "1 day"}


def resample(df: DataFrame, freq: str = "1h", category: str | None = None) -> DataFrame:
    """D-10: load, voltage and power factor per time bucket; a bucket that lacks a mean is dropped."""
    if category is not None:
        df = df.where(F.col("building_type") == category)
    bucket = F.window("timestamp", FREQUENCIES.get(freq, freq))["start"].alias("timestamp")
    return df.groupBy(bucket).agg(
        exact_sum("power_kw").alias("total_power_kw"),
        exact_avg("power_kw").alias("avg_power_kw"),
        exact_avg("voltage_v").alias("avg_voltage_v"),
        exact_avg("power_factor").alias("avg_power_factor")).dropna("any").orderBy("timestamp")


def anomaly_counts(df: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """D-14: rows outside any limit (each counted once), and rows per limit."""
    sag, surge, low_pf = _breaches(limits)
    return df.agg(
        F.count_if(sag | surge | low_pf).alias("total_anomalies"),
        F.count_if(sag).alias("voltage_sags"),
        F.count_if(surge).alias("voltage_surges"),
        F.count_if(low_pf).alias("low_power_factor"))


def anomaly_rows(df: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """D-14: the rows outside any limit."""
    sag, surge, low_pf = _breaches(limits)
    return df.where(sag | surge | low_pf)


def _breaches(limits: AlertLimits) -> tuple[Column, Column, Column]:
    return (below(F.col("voltage_v"), limits.sag_below_v),
            above(F.col("voltage_v"), limits.surge_above_v),
            below(F.col("power_factor"), limits.low_pf_below))


def category_scan(df: DataFrame) -> DataFrame:
    """D-15: count, mean and peak per category over the flat lake."""
    return df.groupBy("building_type").agg(
        F.count("*").alias("readings"), exact_avg("power_kw").alias("avg_power_kw"),
        F.max("power_kw").alias("max_power_kw"))


def category_scan_star(readings: DataFrame, meters: DataFrame, buildings: DataFrame) -> DataFrame:
    """D-15 through the catalogs: readings are aggregated per meter before they meet them.

    The joins then handle one row per meter, so neither the size of the catalogs
    nor a hot building matters.
    """
    per_meter = _cells(readings, ["meter_id"], ["power_kw"])
    place = meters.select("meter_id", "building_id").join(
        buildings.select("building_id", "category"), "building_id", "inner")
    return per_meter.join(place, "meter_id", "inner").groupBy("category").agg(
        F.sum("n_rows").alias("readings"), _mean("power_kw").alias("avg_power_kw"),
        F.max("power_max").alias("max_power_kw"))


def campus_distincts(df: DataFrame) -> DataFrame:
    """D-16: rows, first and last time, distinct meters and buildings."""
    cells = df.groupBy("meter_id", "building_id").agg(
        F.count("*").alias("n_rows"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    return cells.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_records"),
        F.min("first").alias("min_timestamp"), F.max("last").alias("max_timestamp"),
        F.count_distinct("meter_id").alias("meters_count"),
        F.count_distinct("building_id").alias("buildings_count"))


def hourly_load(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """D-17: load per snapshot time, averaged over the hour; per series if ``keys`` are given."""
    snapshots = df.groupBy(*keys, "timestamp").agg(
        exact_sum("power_kw").alias("load"), exact_avg("voltage_v").alias("volts"),
        exact_avg("power_factor").alias("pf"))
    return snapshots.groupBy(*keys, hour_start("timestamp").alias("ds")).agg(
        half_up(exact_avg("load"), 2).alias("total_power_kw"),
        half_up(exact_avg("volts", 8), 2).alias("avg_voltage_v"),
        half_up(exact_avg("pf", 8), 3).alias("avg_power_factor"))


def instant_load(df: DataFrame) -> DataFrame:
    """D-19: total load and mean voltage and power factor at the newest time."""
    return at_latest(df).agg(
        half_up(exact_sum("power_kw"), 1).alias("total_kw"),
        half_up(exact_avg("voltage_v"), 1).alias("avg_v"),
        half_up(exact_avg("power_factor"), 3).alias("avg_pf"))


def meter_baselines(df: DataFrame) -> DataFrame:
    """D-24: mean and sample deviation of power per meter; a zero deviation becomes 1.

    One reading has no deviation (null), so such a meter is never an outlier.
    """
    spread = F.stddev_samp("power_kw")
    return df.where(F.col("meter_id").isNotNull()).groupBy("meter_id").agg(
        exact_avg("power_kw").alias("mean_kw"),
        F.when(spread == 0.0, F.lit(1.0)).otherwise(spread).alias("std_kw"))


def kpis(df: DataFrame) -> DataFrame:
    """D-06: the KPI row - counts, time range, load of the latest readings, overall load.

    Readings are reduced to cells of (meter, building, category) for the counts and the overall load; the latest
    values per meter are those of E-08, with ties at a meter's last time settled by event.
    """
    cells = df.groupBy("meter_id", "building_id", "building_type").agg(
        F.count("*").alias("n_rows"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
        sum_units("power_kw").alias("units"), count_numbers("power_kw").alias("n_power"),
        F.max("power_kw").alias("power_max"), F.min("power_kw").alias("power_min"))
    overall = cells.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_records"),
        F.count_distinct("building_type").alias("total_categories"),
        F.count_distinct("building_id").alias("total_buildings"),
        F.count_distinct("meter_id").alias("total_meters"),
        F.min("first").alias("earliest_time"), F.max("last").alias("latest_time"),
        half_up(mean_from(total_units("units"), F.sum("n_power")), 2).alias("avg_power_kw"),
        half_up(F.max("power_max"), 2).alias("peak_power_kw"),
        half_up(F.min("power_min"), 2).alias("min_power_kw"))
    now = latest_per_meter(df).agg(
        half_up(exact_sum("power_kw"), 2).alias("current_total_load_kw"),
        half_up(exact_avg("voltage_v"), 2).alias("avg_voltage"),
        half_up(exact_avg("power_factor"), 3).alias("avg_power_factor"))
    return overall.select("*", now.select(F.struct("*")).scalar().alias("now")).select(
        "total_records", "total_categories", "total_buildings", "total_meters", "earliest_time", "latest_time",
        "now.*", "avg_power_kw", "peak_power_kw", "min_power_kw")


def live_comparison(current: DataFrame, history: DataFrame) -> DataFrame:
    """D-21: the newest window next to the historic mean reading, and the differences."""
    mean_load = history.agg(half_up(exact_avg("power_kw"), 2)).scalar()
    mean_volts = history.agg(half_up(exact_avg("voltage_v"), 2)).scalar()
    return current.withColumns({
        "load_vs_history_kw": half_up(F.col("current_load_kw") - mean_load, 1),
        "voltage_vs_history_v": half_up(F.col("current_voltage_v") - mean_volts, 1),
    })


