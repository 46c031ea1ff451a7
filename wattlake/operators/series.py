"""Hourly series: lags, calendar features and the chronological split.

A series is a key with one row per hour, so its windows are bounded by hours of
history, never by the number of readings.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.calendar import day_of_week
from wattlake.functions.numeric import decimal_units, half_up, mean_from

SERIES = "series"
LOAD = "total_power_kw"

# Model inputs in order (fixed values).
FEATURES = ("hour", "day_of_week", "is_weekend", "sin_hour", "cos_hour", "sin_day", "cos_day",
            "lag_1", "lag_24")


def campus_series(hourly: DataFrame, name: str = "campus") -> DataFrame:
    """Gives the one series of the whole campus its key."""
    return hourly.withColumn(SERIES, F.lit(name))


def time_parts(ds) -> dict:
    """Calendar features of a time column as named expressions."""
    hour, dow = F.hour(ds), day_of_week(ds)
    return {
        "hour": hour, "day_of_week": dow, "is_weekend": dow.isin(5, 6).cast("int"),
        "sin_hour": F.sin(hour * (2 * pi) / 24.0), "cos_hour": F.cos(hour * (2 * pi) / 24.0),
        "sin_day": F.sin(dow * (2 * pi) / 7.0), "cos_day": F.cos(dow * (2 * pi) / 7.0),
    }


def add_lags(series: DataFrame, keys: Sequence[str] = (SERIES,), value: str = LOAD) -> DataFrame:
    """E-06: the value one and 24 rows earlier in its series (by position)."""
    by_time = Window.partitionBy(*keys).orderBy("ds")
    return series.withColumns({"lag_1": F.lag(value, 1).over(by_time), "lag_24": F.lag(value, 24).over(by_time)})


def backfill_lags(series: DataFrame, keys: Sequence[str] = (SERIES,), value: str = LOAD,
                  means_from: str = "all", train_ratio: float = 0.8) -> DataFrame:
    """E-07: a missing lag becomes the mean of its hour of day in the series.

    ``means_from="all"`` takes the mean over the whole series, which lets test
    rows leak into training rows; ``"train"`` takes the training part only.
    """
    if means_from not in ("all", "train"):
        raise ValueError(f"unknown means_from: {means_from}")
    rows, known = series, F.col(value)
    if means_from == "train":
        rows = chronological_split(series, train_ratio, keys)
        known = F.when(F.col("is_train"), F.col(value))
    same_hour = _mean_over(known, [*keys, F.hour("ds")])
    filled = rows.withColumns({name: F.coalesce(F.col(name), same_hour) for name in ("lag_1", "lag_24")})
    return filled if "is_train" in series.columns else filled.drop("is_train")


def _mean_over(value, keys):
    """The exact mean of a column over a window partition."""
    group = Window.partitionBy(*keys)
    units = decimal_units(value)
    return mean_from(F.sum(units).over(group), F.count(units).over(group))


def time_features(series: DataFrame, keys: Sequence[str] = (SERIES,), value: str = LOAD,
                  means_from: str = "all") -> DataFrame:
    """J-06: calendar features, their sines and cosines, and filled lags."""
    rows = backfill_lags(add_lags(series, keys, value), keys, value, means_from)
    return rows.withColumns(time_parts(F.col("ds")))


def chronological_split(series: DataFrame, ratio: float = 0.8, keys: Sequence[str] = (SERIES,)) -> DataFrame:
    """F-04: marks the first ``int(n * ratio)`` rows of each series as training rows."""
    group = Window.partitionBy(*keys)
    position = F.row_number().over(group.orderBy("ds"))
    size = F.count("*").over(group)
    return series.withColumn("is_train", position <= F.floor(size * float(ratio)))


def regression_metrics(predictions: DataFrame, actual: str = LOAD, predicted: str = "prediction",
                       keys: Sequence[str] = ()) -> DataFrame:
    """J-09: MAE, RMSE and MAPE in percent, two decimals; a zero actual is replaced by a tiny number."""
    def average(expression):
        total = F.sum(expression.cast("decimal(38,8)")).cast("double")
        return F.try_divide(total, F.count(expression).cast("double"))

    error = F.col(actual) - F.col(predicted)
    tiny = F.lit(2.220446049250313e-16)
    return predictions.groupBy(*keys).agg(
        half_up(average(F.abs(error)), 2).alias("MAE"),
        half_up(F.sqrt(average(error * error)), 2).alias("RMSE"),
        half_up(average(F.abs(error) / F.greatest(F.abs(F.col(actual)), tiny)) * 100.0, 2).alias("MAPE"),
        F.count("*").alias("test_samples"))
