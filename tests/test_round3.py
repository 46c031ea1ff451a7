"""Newest rows by folder, stable ties, models per series, late readings, batches that show together, merged folders."""

import datetime as dt
import glob
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_streaming import event, put, stream
from wattlake.operators import forecast, incidents, keyed, profiles, series
from wattlake.operators.joins import readings_star
from wattlake.plans.demand_response import demand_response
from wattlake.sources import dimensions, lake
from wattlake.streaming import jobs, late
from wattlake.streaming.windows import sliding_building_averages

T0 = dt.datetime(2026, 8, 1)


def at(readings, rows):
    """Readings (event, hours after T0, meter, kW, volts)."""
    return readings(*[(name, (T0 + dt.timedelta(hours=hours)).isoformat(), meter, "BH1", "Hostels", kw, volts, 1.0, 0.9)
                      for name, hours, meter, kw, volts in rows])


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_newest_rows_read_as_many_days_as_the_limit_needs(spark, readings, tmp_path, campus):
    path = str(tmp_path / "lake")
    lake.write_lake(at(readings, [(f"E{n:04d}", 6 * n, "M001", 1.0 + n, 230.0) for n in range(160)]), path)      # 4 a day, 40 days
    rows = lake.read_lake(spark, path)
    assert len(keyed.day_folders(rows)) == 40 and keyed.day_folders(rows)[0] == dt.date(2026, 9, 9)
    days = [rows.where(keyed.newest_days(rows, limit)).select("year", "month", "day").distinct().count() for limit in (1, 4, 5, 9, 30)]
    assert days == [1, 1, 2, 4, 8] and keyed.newest_days(rows, 1000) is None
    for limit in (3, 5, 200):
        assert [row["event_id"] for row in keyed.newest_first(rows, limit).collect()] == [f"E{n:04d}" for n in range(159, -1, -1)][:limit]
    found = keyed.newest_first(rows, 5)
    assert "PartitionFilters: [isnotnull" in plan_of(found) or "make_date" in plan_of(found).split("PartitionFilters")[1][:200]
    star = readings_star(rows, *reversed(campus), limit=5)
    assert [row["event_id"] for row in star.collect()] == [f"E{n:04d}" for n in range(159, 154, -1)] and "year" not in star.columns


def test_latest_values_are_the_same_in_any_order(readings):
    rows = [("E1", 0, "M1", 1.0, 200.0), ("E2", 5, "M1", 2.0, None), ("E4", 5, "M1", 4.0, None), ("E3", 5, "M1", 3.0, 230.0),
            ("E5", 6, "M1", None, None), ("E6", 1, "M2", None, None), (None, 9, "M3", 7.0, 1.0), ("E7", 9, "M3", 8.0, None)]
    for order in itertools.islice(itertools.permutations(rows), 0, 40000, 5003):
        df = at(readings, order).repartition(3)
        found = {row["meter_id"]: (row["power_kw"], row["voltage_v"]) for row in keyed.latest_per_meter(df).collect()}
        assert found == {"M1": (4.0, 230.0), "M2": (None, None), "M3": (8.0, 1.0)}
    found = profiles.kpis(at(readings, rows)).first()
    assert found["total_records"] == 8 and found["current_total_load_kw"] == 12.0       # raw rows, none taken away


def hourly(spark, names, n=200):
    draw = np.random.default_rng(5)
    rows = [(name, T0 + dt.timedelta(hours=i), float(300 + 50 * place + 80 * np.sin(i / 24 * 2 * np.pi) + draw.normal(0, 9)))
            for place, name in enumerate(names) for i in range(n)]
    return spark.createDataFrame(rows, "series string, ds timestamp_ntz, total_power_kw double")


def test_ridge_of_many_series_equals_the_closed_form(spark):
    rows = series.time_features(hourly(spark, ["a", "b", "c"])).dropna("any").persist()
    models = {row["series"]: row for row in forecast.fit_ridge_per_series(rows).collect()}
    for name in "abc":
        frame = rows.where(F.col("series") == name).orderBy("ds").toPandas()
        x, y = frame[list(series.FEATURES)].to_numpy(float), frame["total_power_kw"].to_numpy()
        centred = x - x.mean(0)
        expected = np.linalg.solve(centred.T @ centred + np.eye(x.shape[1]), centred.T @ (y - y.mean()))
        assert np.allclose(models[name]["coefficients"], expected, atol=1e-6) and models[name]["n"] == len(y)
        assert models[name]["intercept"] == pytest.approx(y.mean() - x.mean(0) @ expected, abs=1e-6)
    one = forecast.fit_ridge(rows.where("series = 'a'")).stages[-1]
    assert np.allclose(one.coefficients.toArray(), models["a"]["coefficients"], atol=1e-6)
    predicted = forecast.predict_ridge(rows, forecast.fit_ridge_per_series(rows))
    assert predicted.where("prediction IS NULL").count() == 0
    compared = forecast.compare_per_series({"ridge": predicted, "naive": rows.withColumn("prediction", F.col("lag_24"))})
    best = {row["series"]: row["model"] for row in compared.where("chosen").collect()}
    assert best == {"a": "ridge", "b": "ridge", "c": "ridge"} and compared.count() == 6


def test_ridge_of_series_without_rows_or_variance(spark):
    rows = spark.createDataFrame([("a", 1.0, 5.0), ("a", 1.0, 7.0), ("b", None, 3.0)], "series string, x double, total_power_kw double")
    models = forecast.fit_ridge_per_series(rows, features=["x"]).collect()
    assert [(row["series"], row["n"], row["intercept"], row["coefficients"]) for row in models] == [("a", 2, 6.0, [0.0])]
    assert forecast.fit_ridge_per_series(rows, alpha=0.0, features=["x"]).first()["coefficients"] == [0.0]
    assert forecast.predict_ridge(rows, forecast.fit_ridge_per_series(rows, features=["x"]), features=["x"]) \
        .where("prediction IS NULL").count() == 1


def test_meter_numbers_need_no_single_task(spark):
    counts = spark.range(500).select(F.format_string("B%03d", "id").alias("building_id"), F.lit("x").alias("building_type"),
                                     (F.col("id") % 7).alias("meter_count"))
    found = dimensions.expand_meters(counts, ["building_id"], width=5)
    assert "SinglePartition" not in plan_of(found)
    rows = sorted((row["meter_id"], row["building_id"]) for row in found.collect())
    assert [name for name, _ in rows] == [f"M{n + 1:05d}" for n in range(len(rows))] and len(rows) == sum(n % 7 for n in range(500))
    assert [building for _, building in rows] == sorted(building for _, building in rows)


def test_late_readings_go_to_their_own_table_once(spark, tmp_path):
    path = put(tmp_path / "in", [event(1, 0), event(2, 60)], [event(3, 50), event(4, 56), event(5, 55)], [event(6, 10), event(7, 90)])
    folders = [str(tmp_path / name) for name in ("kept", "late", "cp")]
    late.sink_with_late_rows(stream(spark, path), *folders, interval=None).awaitTermination()
    put(tmp_path / "in", [event(8, 84), event(9, 85)])
    late.sink_with_late_rows(stream(spark, path), *folders, interval=None).awaitTermination()       # the bound survives a restart
    events = [sorted(row["event_id"] for row in spark.read.parquet(folder).collect()) for folder in folders[:2]]
    assert events == [["E00001", "E00002", "E00004", "E00005", "E00007", "E00009"], ["E00003", "E00006", "E00008"]]


def test_a_batch_shows_in_all_tables_or_in_none(spark, tmp_path, monkeypatch):
    path = put(tmp_path / "in", [event(1, 0, voltage_v=210.0)])
    folders = [str(tmp_path / name) for name in ("r", "a", "cp")]
    run = lambda: jobs.sink_readings_and_alerts(stream(spark, path), *folders, interval=None,          # noqa: E731
                                                cards_target=str(tmp_path / "c")).awaitTermination()
    run()
    put(tmp_path / "in", [event(2, 60, voltage_v=210.0)])
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "fault_cards", lambda rows: rows.select(F.raise_error(F.lit("store is gone"))))
        with pytest.raises(Exception):
            run()
    tables = lambda: [sorted(row["event_id"] for row in jobs.read_batches(spark, str(tmp_path / name), folders[0]).collect())
                      for name in "rac"]
    assert spark.read.parquet(folders[0]).count() == 2                # written, but not complete
    assert tables() == [["E00001"]] * 3
    run()
    assert tables() == [["E00001", "E00002"]] * 3
    assert "SCADA_VOLTAGE_SAG" in {row["event_type"] for row in jobs.read_batches(spark, str(tmp_path / "c"), folders[0]).collect()}


def test_batch_folders_are_merged_and_old_days_dropped(spark, tmp_path):
    day = 24 * 60
    path = put(tmp_path / "in", *[[event(n, n * 200)] for n in range(24)])             # four days
    folders = [str(tmp_path / name) for name in ("r", "a", "cp")]
    jobs.sink_readings_and_alerts(stream(spark, path), *folders, interval=None).awaitTermination()
    before = sorted(row["event_id"] for row in jobs.read_batches(spark, folders[0]).collect())
    assert len(before) == 24 and jobs.merge_batches(spark, folders[0], folders[0]) == 4
    assert sorted(row["event_id"] for row in jobs.read_batches(spark, folders[0]).collect()) == before
    assert len(glob.glob(f"{folders[0]}/event_day=*/stream=*/batch_id=*/*.parquet")) == 5     # a file per day, and the newest batch
    put(tmp_path / "in", [event(30, 4 * day)], [event(31, 4 * day + 5)])
    jobs.sink_readings_and_alerts(stream(spark, path), *folders, interval=None).awaitTermination()
    jobs.merge_batches(spark, folders[0], folders[0], keep_days=2)
    left = sorted(row["event_id"] for row in jobs.read_batches(spark, folders[0]).collect())
    assert left == [f"E{n:05d}" for n in range(24) if n * 200 + 600 >= 3 * day] + ["E00030", "E00031"]
    assert len(glob.glob(f"{folders[0]}/event_day=*")) == 2


def test_recent_windows_come_from_their_days_alone(spark, tmp_path):
    path = put(tmp_path / "in", [event(n, n * 240) for n in range(30)])
    jobs.sink_window_aggregates(sliding_building_averages(stream(spark, path)), str(tmp_path / "out"), str(tmp_path / "cp"),
                                None).awaitTermination()
    rows = jobs.read_window_aggregates(spark, str(tmp_path / "out"), "40 minutes")
    assert "event_day" in plan_of(rows).split("PartitionFilters")[1][:200]
    assert 1 <= rows.select("event_day").distinct().count() <= 2
    assert jobs.read_window_aggregates(spark, str(tmp_path / "out")).select("event_day").distinct().count() >= 5


def test_demand_response_from_one_stored_forecast(spark, tmp_path):
    hours = [("a", T0 + dt.timedelta(hours=h), 950.0 if 12 <= h < 16 else 600.0) for h in range(24)] \
        + [("b", T0 + dt.timedelta(hours=h), 500.0) for h in range(24)]
    made = demand_response(spark.createDataFrame(hours, "series string, forecast_time timestamp_ntz, predicted_load_kw double"),
                           str(tmp_path / "out"), ["series"], limit_kw=800.0)
    plans = {row["series"]: row for row in made["plans"].collect()}
    assert (plans["a"]["violation_hours_count"], plans["a"]["max_overload_kw"], plans["b"]["has_violations"]) == (4, 150.0, False)
    assert sorted(row["active_shed_kw"] for row in made["actions"].collect()) == [15.0, 45.0, 90.0]
    assert made["curve"].agg(F.max("dispatched_load_kw")).first()[0] == 800.0
    assert [row["series"] for row in made["cards"].collect()] == ["a"]
    assert incidents.dispatch_history(made["audit"]).first()["title"] == "Peak Demand Breach (+150.0 kW)"
