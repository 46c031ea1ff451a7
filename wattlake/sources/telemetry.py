"""Readings from CSV files and from a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattlake.functions.calendar import add_calendar
from wattlake.schema import MEASURES, TELEMETRY_CSV, TELEMETRY_JSON


def finite(value: Column) -> Column:
    """The number, or null if it is NaN or infinite."""
    return F.when(F.abs(value) < float("inf"), value)


def read_telemetry_csv(spark: SparkSession, path: str, calendar: bool = True) -> DataFrame:
    """A-02: typed readings with calendar columns; a row with any gap or bad number is dropped."""
    text = spark.read.schema(TELEMETRY_CSV).option("header", True).csv(path)
    typed = text.withColumns({
        "timestamp": F.col("timestamp").try_cast("timestamp_ntz"),
        **{name: finite(F.col(name).try_cast("double")) for name in MEASURES}})
    whole = typed.dropna("any")
    return add_calendar(whole) if calendar else whole


# Options of the broker source (fixed values).
KAFKA_OPTIONS = {"subscribe": "telemetry.raw", "startingOffsets": "earliest", "failOnDataLoss": "false"}


def telemetry_stream(spark: SparkSession, source: str = "kafka", options: Mapping[str, str] | None = None,
                     path: str | None = None) -> DataFrame:
    """A-03: the raw stream with a ``value`` column.

    ``source="kafka"`` needs the connector package on the cluster; any source
    with a ``value`` column works, e.g. ``text`` with a folder of JSON lines.
    """
    settings = {**(KAFKA_OPTIONS if source == "kafka" else {}), **(options or {})}
    reader = spark.readStream.format(source).options(**settings)
    return reader.load(path) if path else reader.load()


def parse_telemetry(raw: DataFrame, schema: StructType = TELEMETRY_JSON) -> DataFrame:
    """A-04: JSON bytes to typed columns.

    A badly typed field is null, and so is NaN or an infinite number; a message without an event id, which includes
    unparsable text, is dropped.
    """
    parsed = raw.select(F.from_json(F.col("value").cast("string"), schema).alias("data")).select("data.*")
    numbers = {field.name: finite(F.col(field.name)) for field in schema if field.dataType.typeName() in ("double", "float")}
    return parsed.withColumns(numbers).where(F.col("event_id").isNotNull())
