"""Building and meter catalogs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattlake.schema import BUILDINGS, METERS
from wattlake.session import stored


def _catalog(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A CSV with a header, its columns taken by name."""
    text = spark.read.option("header", True).csv(path)
    return text.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema])


def read_dimensions(spark: SparkSession, buildings_path: str, meters_path: str) -> tuple[DataFrame, DataFrame]:
    """A-05: the building and the meter catalog."""
    return _catalog(spark, buildings_path, BUILDINGS), _catalog(spark, meters_path, METERS)


def expand_meters(counts: DataFrame, order: Sequence[str], meter_type: str = "Smart Sub-Meter",
                  status: str = "ACTIVE", width: int = 3) -> DataFrame:
    """A-05: one row per meter from (building_id, building_type, meter_count), ids running in ``order``.

    A distributed prefix sum: the catalog is dealt into ranges of the order and written, each range is summed up for
    itself, and the ranges' totals (a number per shuffle partition) give every range its start.
    """
    spark = counts.sparkSession
    ranges = stored(counts.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "meter-ranges")
    total = F.coalesce(F.sum("meter_count"), F.lit(0)).cast("bigint")
    starts, below = [], 0
    for row in ranges.groupBy("_range").agg(total.alias("n")).orderBy("_range").collect():
        starts.append((row["_range"], below))
        below += row["n"]
    before = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.join(spark.createDataFrame(starts, "_range int, _base bigint"), "_range") \
        .withColumn("_start", F.col("_base") + F.coalesce(F.sum("meter_count").over(before), F.lit(0)))
    rows = placed.where(F.col("meter_count") > 0).select(
        "building_id", "building_type", "_start",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("meter_count").cast("bigint"))).alias("_n"))
    number = (F.col("_start") + F.col("_n")).cast("string")
    padded = F.when(F.length(number) >= width, number).otherwise(F.lpad(number, width, "0"))
    return rows.select(F.concat(F.lit("M"), padded).alias("meter_id"), "building_id", "building_type",
                       F.lit(meter_type).alias("meter_type"), F.lit(status).alias("status"))


def upsert(target: DataFrame, updates: DataFrame, key: str, update_cols: Sequence[str]) -> DataFrame:
    """A-11: rows of ``updates`` are added; for a known key only ``update_cols`` change.

    ``updates`` holds each key once.
    """
    old = target.withColumn("_old", F.lit(True)).alias("t")
    new = updates.withColumn("_new", F.lit(True)).alias("u")
    joined = old.join(new, F.col(f"t.{key}") == F.col(f"u.{key}"), "full_outer")
    columns = []
    for name in target.columns:
        ours = F.col(f"t.{name}")
        if name not in updates.columns:
            columns.append(ours.alias(name))
            continue
        theirs = F.col(f"u.{name}")
        take_new = F.col("u._new").isNotNull() if name in update_cols else F.col("t._old").isNull()
        columns.append(F.when(take_new, theirs).otherwise(ours).alias(name))
    return joined.select(*columns)
