"""Calendar columns (B-06, B-08) and time text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOUR_TEXT = "yyyy-MM-dd HH:00:00"
DAY_TEXT = "yyyy-MM-dd"


def day_of_week(ts: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(ts)


def add_calendar(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """B-06: hour, day name, day of week (Mon=0), weekend flag, Weekday/Weekend."""
    weekend = day_of_week(F.col(ts)).isin(5, 6)
    return df.withColumns({
        "hour": F.hour(ts),
        "day_name": F.date_format(ts, "EEEE"),
        "day_of_week": day_of_week(F.col(ts)),
        "is_weekend": weekend,
        "day_type": F.when(weekend, "Weekend").when(~weekend, "Weekday"),
    })


def add_partitions(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """B-08: year, month and day of the event time."""
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})


def hour_start(ts: Column | str) -> Column:
    """The start of the hour, without a zone."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")
