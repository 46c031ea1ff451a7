"""Filters and projections over readings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.operators.keyed import newest_first
from wattlake.schema import PARTITION_COLUMNS, TELEMETRY_COLUMNS

ANY = ("All", "All Categories", "All Buildings", "All Meters")


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions, F.lit(True))


def _chosen(value: str | None) -> bool:
    return bool(value) and value not in ANY


def _timestamp(value) -> Column:
    """A literal without a zone, compared with a zone-less column as written."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = f"{value.isoformat()} 00:00:00"
    return F.to_timestamp_ntz(F.lit(value))


def filter_telemetry(df: DataFrame, category: str | None = None, building: str | None = None,
                     meter: str | None = None, date_from=None, date_to=None) -> DataFrame:
    """B-01: optional conjuncts; an "All ..." choice means no condition.  Both dates are inclusive."""
    conditions = [F.col(name) == value for name, value in
                  (("building_type", category), ("building_id", building), ("meter_id", meter))
                  if _chosen(value)]
    if date_from:
        conditions.append(F.col("timestamp") >= _timestamp(date_from))
    if date_to:
        conditions.append(F.col("timestamp") <= _timestamp(date_to))
    return df.where(_all(conditions))


def day_partitions_between(start: dt.date | None, end: dt.date | None) -> Column:
    """A condition on year/month/day equal to a range of days, so that directories are pruned."""
    day_number = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    conditions = []
    if start:
        conditions += [F.col("year") >= start.year,
                       day_number >= start.year * 10000 + start.month * 100 + start.day]
    if end:
        conditions += [F.col("year") <= end.year,
                       day_number <= end.year * 10000 + end.month * 100 + end.day]
    return _all(conditions)


def query_telemetry(df: DataFrame, start_date: dt.date | None = None, end_date: dt.date | None = None,
                    building_ids: Sequence[str] | None = None, building_type: str | None = None,
                    limit: int = 2000) -> DataFrame:
    """B-02: nine-column projection of a date range, newest first.

    ``end_date`` counts to its end.  On a lake partitioned by day the same range
    is stated on the partition columns, too.
    """
    conditions = []
    if start_date:
        conditions.append(F.col("timestamp") >= _timestamp(start_date))
    if end_date:
        conditions.append(F.col("timestamp") < _timestamp(end_date + dt.timedelta(days=1)))
    if building_ids:
        conditions.append(F.col("building_id").isin(list(building_ids)))
    if _chosen(building_type):
        conditions.append(F.col("building_type") == building_type)
    if set(PARTITION_COLUMNS) <= set(df.columns):
        conditions.append(day_partitions_between(start_date, end_date))
    return newest_first(df.where(_all(conditions)).select(*TELEMETRY_COLUMNS), limit)


def search(df: DataFrame, text: str, mode: str = "literal",
           columns: Sequence[str] = ("building_id", "meter_id")) -> DataFrame:
    """B-07: case-insensitive match on any of the columns; ``mode`` is "literal" or "regex"."""
    wanted = text.strip().lower()
    if not wanted:
        return df
    if mode == "regex":
        matches = [F.lower(name).rlike(wanted) for name in columns]
    elif mode == "literal":
        matches = [F.lower(name).contains(wanted) for name in columns]
    else:
        raise ValueError(f"unknown search mode: {mode}")
    return df.where(reduce(lambda left, right: left | right, matches))


def recent(df: DataFrame, ts: str, span: str) -> DataFrame:
    """B-09: rows within ``span`` (e.g. "40 minutes") of the newest one.

    The newest time is a scalar subquery, which the Parquet scan gets as a
    pushed filter.
    """
    cutoff = df.agg(F.max(ts).alias("newest")).select(F.expr(f"newest - INTERVAL {span}"))
    return df.where(F.col(ts) >= cutoff.scalar())


def at_latest(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """C-06: rows at the newest time of the table."""
    return df.where(F.col(ts) == df.agg(F.max(ts)).scalar())


def valid_rows(df: DataFrame) -> DataFrame:
    """B-10: rows with a time and a power."""
    return df.where(F.col("timestamp").isNotNull() & F.col("power_kw").isNotNull())


def category_filter(rows: DataFrame, category: str = "All") -> DataFrame:
    """B-12: rows of one category; "All" keeps every row."""
    return rows.where(F.col("building_type") == category) if _chosen(category) else rows
