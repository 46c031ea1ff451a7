"""Selection of rows per key and of the newest rows of a table."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.schema import PARTITION_COLUMNS

EVENT_DAY = "event_day"               # partition column of the serving tables
DAY_FOLDER = re.compile(r"/year=(\d+)/month=(\d+)/day=(\d+)/|/event_day=(\d{4})-(\d{2})-(\d{2})/")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                  n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in the given order.

    A ``row_number`` filter is planned with a partial group limit before the
    shuffle, so a key that holds a third of all rows sends at most ``n`` rows
    per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def _day_column(df: DataFrame) -> Column | None:
    """The day a row's folder stands for, from partition columns alone."""
    if set(PARTITION_COLUMNS) <= set(df.columns):
        return F.make_date(*[F.col(name) for name in PARTITION_COLUMNS])
    return F.col(EVENT_DAY).cast("date") if EVENT_DAY in df.columns else None


def day_folders(df: DataFrame) -> list[dt.date]:
    """The days of the folders a table is read from, newest first; from its listing, without reading a file."""
    found = (DAY_FOLDER.search(name) for name in df.inputFiles())
    return sorted({dt.date(*[int(part) for part in match.groups() if part]) for match in found if match}, reverse=True)


def newest_days(df: DataFrame, limit: int) -> Column | None:
    """A condition on the day folders that hold the ``limit`` newest rows; None if rows of all folders are needed.

    Folders are taken from the newest on, twice as many each time, until they hold enough rows.  The condition is on
    partition columns, so other folders are not read, neither for counting nor later.
    """
    day, days, taken = _day_column(df), day_folders(df), 1
    if day is None:
        return None
    while taken < len(days):
        condition = day >= F.lit(days[taken - 1])
        if df.where(condition).count() >= limit:
            return condition
        taken *= 2
    return None


def newest_first(df: DataFrame, limit: int, ts: str = "timestamp",
                 tiebreak: Sequence[str] = ("event_id",)) -> DataFrame:
    """F-01: the ``limit`` newest rows, newest first, ties by ``tiebreak`` descending.

    A plain top-k keeps ``limit`` candidates per scan task and merges all of them
    in one task, which is too much for a lake of many files.  A table in day
    folders (``year``/``month``/``day`` of the time, or ``event_day``) is read
    from the newest folder backwards, so what is read depends on the limit, not on
    the history.  Of any other table the hours are counted first (one narrow
    column) and the hour in which the limit is reached becomes a lower bound on
    the time, which the scan receives as a pushed filter.  Rows without a time
    sort last.
    """
    order = [F.desc_nulls_last(ts), *[F.desc_nulls_last(name) for name in tiebreak]]
    if _day_column(df) is not None and day_folders(df):
        newest = newest_days(df, limit)
        return (df if newest is None else df.where(newest)).orderBy(*order).limit(limit)
    per_hour = df.where(F.col(ts).isNotNull()) \
        .groupBy(F.date_trunc("hour", ts).alias("_hour")).agg(F.count("*").alias("_rows"))
    # one row per hour of history, not per reading
    newer = F.sum("_rows").over(
        Window.orderBy(F.desc("_hour")).rowsBetween(Window.unboundedPreceding, -1))
    needed = per_hour.withColumn("_newer", F.coalesce(newer, F.lit(0))).where(F.col("_newer") < limit)
    # in the type of the column, else the comparison casts the column and is not pushed
    cutoff = needed.agg(F.min("_hour").cast(df.schema[ts].dataType)).scalar()
    return df.where((F.col(ts) >= cutoff) | F.col(ts).isNull()).orderBy(*order).limit(limit)


def last_n(df: DataFrame, n: int, keys: Sequence[str], ts: str = "ds") -> DataFrame:
    """F-03: the last ``n`` rows of each series."""
    return first_per_key(df, keys, [F.desc_nulls_last(ts)], n)


def top_k(df: DataFrame, k: int, by: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """F-02: the ``k`` rows with the largest ``by``."""
    return df.orderBy(F.desc_nulls_last(by), *[F.asc(name) for name in tiebreak]).limit(k)


def latest_per_meter(df: DataFrame, metrics: Sequence[str] = ("power_kw", "voltage_v", "power_factor"),
                     key: str = "meter_id", ts: str = "timestamp", tiebreak: str = "event_id") -> DataFrame:
    """E-08: the last non-null value of each metric per meter, in time order; at one time the highest ``tiebreak``.

    Two levels.  The first finds each metric's last time per meter; its buffers are times, so it is a hash aggregate
    over all readings.  The second settles ties by event among the readings at those times only, with a group limit
    before its exchange: a meter that repeats one time in a third of all rows sends a row per task.
    """
    rows = df.where(F.col(key).isNotNull())
    last = rows.groupBy(key).agg(F.max(ts).alias("_newest"), *[
        F.max(F.when(F.col(name).isNotNull(), F.col(ts))).alias(f"_{name}_at") for name in metrics])
    event = F.col(tiebreak).cast("string") if tiebreak in df.columns else F.lit(None).cast("string")
    # a meter without any known value keeps its newest time, so that it has a row
    unknown = F.coalesce(*[f"_{name}_at" for name in metrics]).isNull() & F.col(ts).eqNullSafe(F.col("_newest"))
    found = [F.when(unknown, F.struct(F.lit("").alias("metric"), F.lit(None).cast("double").alias("value")))]
    for name in metrics:
        at = F.col(name).isNotNull() & (F.col(ts) == F.col(f"_{name}_at"))
        found.append(F.when(at, F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value"))))
    values = rows.join(last, key).select(key, event.alias("_event"), F.explode(F.array_compact(F.array(*found))).alias("_found")) \
        .select(key, "_event", "_found.*")
    latest = first_per_key(values, [key, "metric"], [F.desc_nulls_last("_event"), F.desc("value")])
    return latest.groupBy(key).agg(*[F.max(F.when(F.col("metric") == name, F.col("value"))).alias(name) for name in metrics])
