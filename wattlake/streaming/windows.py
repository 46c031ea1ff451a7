"""Sliding averages per building, in batch and as a stream."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions.numeric import count_numbers, exact_avg, half_up, mean_from, sum_units, total_units
from wattlake.schema import StreamTiming

DIGITS = {"power_kw": 2, "voltage_v": 2, "power_factor": 3}


def sliding_building_averages(readings: DataFrame, timing: StreamTiming = StreamTiming(),
                              ts: str = "timestamp") -> DataFrame:
    """I-01: mean power, voltage and power factor per sliding window and building.

    A stream aggregates its windows directly under a watermark (I-02).  A batch
    first sums each slide-long pane, so that the copies a row gets for the
    overlapping windows are made of panes and not of readings.  Sums are exact,
    hence both ways give the same averages.
    """
    if readings.isStreaming:
        return (readings.withWatermark(ts, timing.watermark)
                .groupBy(F.window(ts, timing.window, timing.slide).alias("window"), "building_id")
                .agg(*[half_up(exact_avg(name), digits).alias(f"avg_{name}")
                       for name, digits in DIGITS.items()]))
    if pd.Timedelta(timing.window) % pd.Timedelta(timing.slide):
        raise ValueError("the window must be a multiple of the slide")
    parts = []
    for name in DIGITS:
        parts += [sum_units(name).alias(f"{name}_units"), count_numbers(name).alias(f"{name}_count")]
    panes = readings.where(F.col(ts).isNotNull()) \
        .groupBy(F.window(ts, timing.slide)["start"].alias("pane"), "building_id").agg(*parts)
    return panes.groupBy(F.window("pane", timing.window, timing.slide).alias("window"), "building_id").agg(
        *[half_up(mean_from(total_units(f"{name}_units"), F.sum(f"{name}_count")), digits).alias(f"avg_{name}")
          for name, digits in DIGITS.items()])


def flatten_window(averages: DataFrame) -> DataFrame:
    """Window start and end as columns, in the layout of the serving table."""
    return averages.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "building_id", *[f"avg_{name}" for name in DIGITS])
