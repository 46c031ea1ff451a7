"""Sums without overflow, numbers that are none, newest windows, forecasts with gaps, sinks and commits that last."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

import wattlake.sources.snapshots as snapshots
from wattlake.functions.numeric import exact_avg, exact_sum
from wattlake.operators import forecast, live
from wattlake.operators.isolation_forest import training_sample
from wattlake.session import path_exists
from wattlake.sources.telemetry import parse_telemetry
from wattlake.streaming import jobs


def test_sums_skip_what_is_no_number_and_do_not_overflow(spark):
    rows = spark.createDataFrame([(3e12,)] * 4 + [(float("nan"),), (float("inf"),), (None,)], "x double")
    found = rows.select(exact_sum("x").alias("s"), exact_avg("x").alias("m")).first()
    assert found["s"] == 1.2e13 and found["m"] == 3e12
    many = spark.range(4000).select((F.lit(4e12) + F.col("id")).alias("x"))       # 1.6e16 in all, 1.6e22 units
    assert many.agg(exact_sum("x")).first()[0] == pytest.approx(4000 * 4e12 + 3999 * 2000, rel=1e-15)


def test_no_finite_value_is_lost_from_a_sum(spark):
    rows = spark.createDataFrame([(3e14,)] * 4 + [(5.0,)], "x double")
    found = rows.select(exact_sum("x").alias("s"), exact_avg("x").alias("m")).first()
    assert found["s"] == 1.2e15 + 5 and found["m"] == (1.2e15 + 5) / 5
    only = spark.createDataFrame([(-7e20,), (float("nan"),)], "x double").select(exact_sum("x").alias("s")).first()
    assert only["s"] == -7e20
    beyond = spark.createDataFrame([(1e300,), (5.0,)], "x double")         # no total rather than a wrong one
    assert beyond.select(exact_sum("x")).first()[0] is None


def test_small_values_are_not_rounded_away(spark):
    rows = spark.createDataFrame([(0.00004,), (0.00004,)], "x double")
    assert rows.agg(exact_avg("x")).first()[0] == 0.00004


def test_negative_values_sum_exactly(spark):
    rows = spark.createDataFrame([(-0.25,), (0.75,), (-3.5,)], "x double")
    assert rows.agg(exact_sum("x")).first()[0] == -3.0


def test_parsed_messages_hold_no_nan(spark):
    raw = spark.createDataFrame([('{"event_id":"E1","power_kw":"NaN"}',), ('{"event_id":"E2","power_kw":NaN}',),
                                 ('{"event_id":"E3","power_kw":1.5}',)], "value string")
    found = {row["event_id"]: row["power_kw"] for row in parse_telemetry(raw).collect()}
    assert found["E3"] == 1.5 and not any(isinstance(x, float) and math.isnan(x) for x in found.values())


def test_timeline_keeps_the_newest_windows(spark):
    start = dt.datetime(2026, 1, 1)
    rows = spark.createDataFrame([(i, start, start + dt.timedelta(minutes=i), "B1", 1.0, 230.0, 0.9) for i in range(60)],
                                 "id long, window_start timestamp_ntz, window_end timestamp_ntz, building_id string, "
                                 "avg_power_kw double, avg_voltage_v double, avg_power_factor double")
    ends = [row["window_end"] for row in live.stream_timeline(rows).collect()]
    assert len(ends) == 40 and ends == sorted(ends) and ends[-1] == start + dt.timedelta(minutes=59)


def test_each_tree_draws_from_a_pool_of_its_own_size(spark):
    rows = spark.range(60_000).select(F.format_string("E%06d", "id").alias("event_id"), F.rand(1).alias("x"))
    drawn = training_sample(rows, ("x",), trees=100, sample=64, key="event_id")
    assert drawn.count() == 6400
    assert drawn.select("event_id").distinct().count() > 5000          # 4096 at most from a pool of 64 samples


@pytest.fixture(scope="module")
def history(spark):
    start = dt.datetime(2026, 1, 1)
    rows = [("a", start + dt.timedelta(hours=i), None if i == 71 else 212.0 + i % 3) for i in range(72)]
    rows += [("b", start + dt.timedelta(hours=i), 40.0 + i % 5) for i in range(72)]
    return spark.createDataFrame(rows, "series string, ds timestamp_ntz, total_power_kw double")


def test_a_null_hour_is_no_history(history):
    found = {row["series"]: row for row in forecast.recent_history(history).collect()}
    assert len(found["a"]["history"]) == 24 and None not in found["a"]["history"]
    assert found["a"]["last_ds"] == found["b"]["last_ds"]


def test_forecasts_have_a_start_a_floor_and_an_error_of_their_own(spark, history):
    from wattlake.operators import series
    train = series.time_features(history.dropna()).dropna("any", subset=list(series.FEATURES))
    errors = spark.createDataFrame([("a", 10.0)], "series string, RMSE double")
    found = forecast.forecast_24h(forecast.fit_ridge(train), history, floor_kw=0.0, start_time="2026-02-01 00:00:00",
                                  rmse_of=errors).toPandas()
    assert found["forecast_time"].min() == dt.datetime(2026, 2, 1) and len(found) == 48
    first = found[found["forecast_time"] == dt.datetime(2026, 2, 1)].set_index("series")
    assert 200 < first.loc["a", "predicted_load_kw"] < 225 and first.loc["b", "predicted_load_kw"] < 60
    assert first.loc["a", "upper_ci_95"] - first.loc["a", "predicted_load_kw"] < 30 < \
        first.loc["b", "upper_ci_95"] - first.loc["b", "predicted_load_kw"]


def test_values_too_large_for_the_serving_table_are_null(spark):
    rows = spark.createDataFrame([(1e9,), (12.345,)], "power_kw double")
    found = [row[0] for row in jobs._as_served(rows).collect()]
    assert found[0] is None and float(found[1]) == pytest.approx(12.35, abs=0.01)


def test_data_left_by_a_dead_job_is_not_read(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2026, 1, 1)], "x int, year int, month int, day int")
    path = str(tmp_path / "table")
    snapshots.snapshot_init(rows, path)
    snapshots._write_data(rows, path, ["year", "month", "day"])
    assert snapshots.snapshot_append(rows, path)["version"] == 1
    assert snapshots.read_snapshot(spark, path).count() == 2
