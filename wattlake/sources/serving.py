"""Serving-side readers and file exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions.electrical import derive_power


def write_processed_csv(df: DataFrame, path: str, derive: bool = True) -> None:
    """A-12: readings as CSV with a header, by default with apparent and reactive power."""
    rows = derive_power(df).drop("derived_current_a") if derive else df
    rows.write.mode("overwrite").option("header", True).csv(path)


def table_stats(buildings: DataFrame, meters: DataFrame, readings: DataFrame, alerts: DataFrame,
                aggregates: DataFrame) -> DataFrame:
    """A-16: row counts of the five tables and the first and last reading, in one row."""
    def rows(table: DataFrame):
        return table.agg(F.count("*")).scalar()

    return readings.agg(
        F.count("*").alias("readings_count"),
        F.min("timestamp").alias("earliest_reading"), F.max("timestamp").alias("latest_reading"),
    ).select(rows(buildings).alias("building_count"), rows(meters).alias("meter_count"), "readings_count",
             rows(alerts).alias("alerts_count"), rows(aggregates).alias("aggregates_count"),
             "earliest_reading", "latest_reading")


def present_marts(hourly: DataFrame, daily: DataFrame, efficiency: DataFrame,
                  hourly_limit: int = 500) -> dict[str, DataFrame]:
    """A-17: the marts in presentation order."""
    return {
        "efficiency": efficiency.orderBy("category", F.desc_nulls_last("load_factor")),
        "daily": daily.orderBy(F.desc("dispatch_date")),
        "hourly": hourly.orderBy(F.desc("hour_timestamp"), "building_id", "category").limit(hourly_limit),
    }


def read_marts(spark: SparkSession, gold_path: str, hourly_limit: int = 500) -> dict[str, DataFrame]:
    """A-17: the marts a pipeline run has written."""
    tables = [spark.read.parquet(f"{gold_path}/{name}") for name in ("hourly", "daily", "efficiency")]
    return present_marts(*tables, hourly_limit=hourly_limit)
