import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattlake.operators import forecast, series
from wattlake.operators.isolation_forest import (FEATURES, IsolationForest, isolation_forest_fit,
                                                 isolation_forest_score, training_sample, with_features)

START = dt.datetime(2026, 8, 3)


def daily_cycle(hours=24 * 21, noise=8.0):
    rng = np.random.default_rng(7)
    at = pd.date_range(START, periods=hours, freq="h")
    load = 600 + 250 * np.sin(2 * np.pi * (at.hour - 8) / 24) - 60 * (at.dayofweek >= 5) + rng.normal(0, noise, hours)
    return pd.DataFrame({"series": "campus", "ds": at, "total_power_kw": np.round(load, 2)})


@pytest.fixture(scope="module")
def cycle(spark):
    return spark.createDataFrame(daily_cycle(), "series string, ds timestamp_ntz, total_power_kw double").cache()


@pytest.fixture(scope="module")
def chosen(cycle):
    return forecast.select_model(cycle, trees=20)


def test_lags_and_backfill(spark):
    rows = spark.createDataFrame(daily_cycle(48, 0.0), "series string, ds timestamp_ntz, total_power_kw double")
    pdf = daily_cycle(48, 0.0)
    found = series.backfill_lags(series.add_lags(rows)).orderBy("ds").toPandas()
    mean = pdf.groupby(pdf["ds"].dt.hour)["total_power_kw"].transform("mean")
    assert np.allclose(found["lag_1"], pdf["total_power_kw"].shift(1).fillna(mean))
    assert np.allclose(found["lag_24"], pdf["total_power_kw"].shift(24).fillna(mean))


def test_means_from_train_ignore_the_test_part(spark):
    rows = spark.createDataFrame([("s", START + dt.timedelta(days=i), float(v)) for i, v in enumerate([1, 2, 3, 4, 95])],
                                 "series string, ds timestamp_ntz, total_power_kw double")
    lags = series.add_lags(rows)
    assert series.backfill_lags(lags).orderBy("ds").first()["lag_1"] == 21.0
    leak_free = series.backfill_lags(lags, means_from="train").orderBy("ds")
    assert leak_free.first()["lag_1"] == 2.5 and "is_train" not in leak_free.columns


def test_split_takes_the_first_part_of_each_series(spark):
    rows = spark.createDataFrame([(name, START + dt.timedelta(hours=i), 1.0) for name, n in (("a", 9), ("b", 4))
                                  for i in range(n)], "series string, ds timestamp_ntz, total_power_kw double")
    found = series.chronological_split(rows).where("is_train").groupBy("series").agg(F.count("*"), F.max("ds"))
    assert {row[0]: (row[1], row[2].hour) for row in found.collect()} == {"a": (7, 6), "b": (3, 2)}


def test_ridge_equals_the_closed_form(cycle):
    train = series.time_features(cycle)
    model = forecast.fit_ridge(train, alpha=1.0)
    pdf = train.toPandas()
    x, y = pdf[list(series.FEATURES)].to_numpy(float), pdf["total_power_kw"].to_numpy(float)
    centred = x - x.mean(axis=0)
    weights = np.linalg.solve(centred.T @ centred + np.eye(x.shape[1]), centred.T @ (y - y.mean()))
    assert np.allclose(model.stages[-1].coefficients.toArray(), weights, rtol=1e-6, atol=1e-6)


def test_metrics(spark):
    rows = spark.createDataFrame([(100.0, 110.0), (200.0, 180.0), (None, 5.0)], "total_power_kw double, prediction double")
    found = series.regression_metrics(rows).first()
    assert (found["MAE"], found["RMSE"], found["MAPE"]) == (15.0, 15.81, 10.0)


def test_selection_and_error_bound(chosen):
    assert chosen.name in (forecast.RIDGE, forecast.FOREST)
    assert chosen.metrics["MAPE"] < 30.0 and chosen.test_samples == 101
    assert chosen.metrics["RMSE"] == min(found["RMSE"] for found in chosen.compared.values())


def test_saved_forecaster_predicts_the_same(chosen, cycle, tmp_path):
    chosen.save(str(tmp_path))
    loaded = forecast.load_forecaster(str(tmp_path))
    assert (loaded.name, loaded.metrics) == (chosen.name, chosen.metrics)
    train = series.time_features(cycle)
    assert chosen.model.transform(train).select("prediction").exceptAll(
        loaded.model.transform(train).select("prediction")).isEmpty()


def test_forecast_equals_a_hand_rolled_recursion(cycle):
    model = forecast.fit_ridge(series.time_features(cycle))
    linear = model.stages[-1]
    weights, bias = linear.coefficients.toArray(), linear.intercept
    pdf = daily_cycle()
    loads, at = list(pdf["total_power_kw"].tail(24)), pdf["ds"].max()
    expected = []
    for _ in range(24):
        at += pd.Timedelta(hours=1)
        hour, dow = at.hour, at.dayofweek
        row = [hour, dow, float(dow >= 5), np.sin(2 * np.pi * hour / 24), np.cos(2 * np.pi * hour / 24),
               np.sin(2 * np.pi * dow / 7), np.cos(2 * np.pi * dow / 7), loads[-1], loads[-24]]
        loads.append(max(100.0, round(float(np.dot(weights, row) + bias), 2)))
        expected.append(loads[-1])
    found = forecast.forecast_24h(model, cycle, rmse=20.0).orderBy("forecast_time").toPandas()
    assert len(found) == 24 and found["forecast_time"].iloc[0] == pdf["ds"].max() + pd.Timedelta(hours=1)
    assert np.allclose(found["predicted_load_kw"], expected, atol=0.011)
    assert (found["lower_ci_95"] <= found["predicted_load_kw"]).all()
    assert (found["upper_ci_95"] >= found["predicted_load_kw"]).all()
    width = (found["upper_ci_95"] - found["predicted_load_kw"]).round(2).tolist()
    assert width[0] == 39.2 and width[10] == 47.04


def test_forecast_of_short_and_low_series(spark, cycle):
    model = forecast.fit_ridge(series.time_features(cycle))
    short = spark.createDataFrame([("x", START, 1.0), ("y", START, 650.0), ("y", START + dt.timedelta(hours=1), 660.0)],
                                  "series string, ds timestamp_ntz, total_power_kw double")
    found = forecast.forecast_24h(model, short)
    assert found.groupBy("series").count().where("count = 24").count() == 2
    assert found.agg(F.min("predicted_load_kw")).first()[0] >= 100.0


def sensor_rows(spark, n=4000, planted=20):
    rng = np.random.default_rng(3)
    good = rng.normal([25, 230, 11, 0.93], [4, 2, 2, 0.02], size=(n, 4))
    odd = np.tile([180.0, 150.0, 90.0, 0.3], (planted, 1)) + rng.normal(0, 2, (planted, 4))
    pdf = pd.DataFrame(np.vstack([good, odd]), columns=["power_kw", "voltage_v", "current_a", "power_factor"])
    pdf.insert(0, "event_id", [f"E{i:06d}" for i in range(len(pdf))])
    pdf.insert(1, "timestamp", START + pd.to_timedelta(np.arange(len(pdf)) % 720, unit="h"))
    return with_features(spark.createDataFrame(pdf))


def test_isolation_forest_finds_planted_outliers(spark):
    rows = sensor_rows(spark).cache()
    model = isolation_forest_fit(rows)
    found = isolation_forest_score(rows, model).select("event_id", "anomaly_score", "ml_anomaly").toPandas()
    lowest = found.nsmallest(20, "anomaly_score")["event_id"]
    assert set(lowest) == {f"E{i:06d}" for i in range(4000, 4020)}
    assert abs(found["ml_anomaly"].mean() - 0.02) < 0.003
    assert model.sample_size == 256 and model.feature.shape[0] == 100


def test_isolation_forest_does_not_depend_on_partitioning(spark):
    rows = sensor_rows(spark, 1500, 5)
    models = [isolation_forest_fit(rows.repartition(n), trees=10) for n in (1, 7)]
    assert np.array_equal(models[0].threshold, models[1].threshold) and np.array_equal(models[0].left, models[1].left)


def test_copies_of_an_event_count_once_in_the_sample(spark):
    rows = sensor_rows(spark, 900, 0)
    copies = rows.where("event_id = 'E000000'").crossJoin(spark.range(2000)).drop("id")
    drawn = training_sample(rows.union(copies), trees=5)
    assert drawn.groupBy("tree", "event_id").count().where("count > 1").isEmpty()
    assert {row["count"] for row in drawn.groupBy("tree").count().collect()} == {256}


def test_readings_with_gaps_get_no_score(spark):
    rows = sensor_rows(spark, 500, 0)
    model = isolation_forest_fit(rows, trees=10)
    gap = rows.limit(1).withColumn("voltage_v", F.lit(None).cast("double"))
    found = isolation_forest_score(gap, model).first()
    assert found["anomaly_score"] is None and found["ml_anomaly"] is False


def test_forest_survives_a_table(spark):
    rows = sensor_rows(spark, 500, 0)
    model = isolation_forest_fit(rows, trees=10)
    again = IsolationForest.from_frame(model.to_frame(spark))
    points = rows.select(*FEATURES).limit(50).toPandas().to_numpy(float)
    assert np.allclose(model.normality(points), again.normality(points)) and model.offset == again.offset
