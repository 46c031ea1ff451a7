import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattlake.functions.calendar import add_calendar
from wattlake.functions.electrical import derive_power, limit_rules
from wattlake.functions.numeric import exact_avg, exact_sum, half_up
from wattlake.operators import filters, keyed, live, profiles

T0 = dt.datetime(2026, 8, 22, 0, 0)


def hours(readings, n, meter="M001", start=T0):
    return readings(*[(f"E{i:04d}", (start + dt.timedelta(hours=i)).isoformat(), meter, "BH1", "Hostels",
                       float(i), 230.0, 1.0, 0.9) for i in range(n)])


def test_half_up_is_symmetric(spark):
    row = spark.sql("SELECT 0.125D AS a, -0.125D AS b, 2.5D AS c, CAST(NULL AS DOUBLE) AS d, -0.001D AS e")
    found = row.select(*[half_up(name, 2).alias(name) for name in "abde"], half_up("c", 0).alias("c")).first()
    assert (found["a"], found["b"], found["c"], found["d"]) == (0.13, -0.13, 3.0, None)
    assert str(found["e"]) == "0.0"


def test_sums_do_not_depend_on_partitioning(spark):
    rows = spark.range(10_000).select((F.pmod(F.xxhash64("id"), F.lit(100_000)) / 100).alias("x"))
    results = {tuple(rows.repartition(n).agg(exact_sum("x"), exact_avg("x")).first()) for n in (1, 7, 31)}
    assert len(results) == 1


def test_calendar(readings):
    found = add_calendar(hours(readings, 1)).first()  # a Saturday
    assert (found["hour"], found["day_name"], found["day_of_week"], found["is_weekend"], found["day_type"]) == \
        (0, "Saturday", 5, True, "Weekend")


def test_derive_power_survives_zero(readings):
    rows = readings(("E1", T0.isoformat(), "M", "B", None, 10.0, 0.0, 1.0, 0.0),
                    ("E2", T0.isoformat(), "M", "B", None, 8.0, 230.0, 1.0, 0.8))
    found = {row["event_id"]: row for row in derive_power(rows).collect()}
    assert found["E1"]["apparent_power_kva"] is None and found["E1"]["derived_current_a"] is None
    assert (found["E2"]["apparent_power_kva"], found["E2"]["reactive_power_kvar"],
            found["E2"]["derived_current_a"]) == (10.0, 6.0, 34.78)


def test_newest_first_equals_a_plain_top_k(readings):
    rows = hours(readings, 300)
    for limit in (1, 24, 299, 1000):
        found = [row["event_id"] for row in keyed.newest_first(rows.repartition(5), limit).collect()]
        assert found == [f"E{i:04d}" for i in range(299, max(-1, 299 - limit), -1)]


def test_newest_first_keeps_rows_without_time_last(readings):
    rows = hours(readings, 2).union(readings(("E9", None, "M", "B", None, 1.0, 1.0, 1.0, 1.0)))
    assert [row["event_id"] for row in keyed.newest_first(rows, 5).collect()] == ["E0001", "E0000", "E9"]
    assert [row["event_id"] for row in keyed.newest_first(rows, 1).collect()] == ["E0001"]


def test_filters(readings):
    rows = hours(readings, 48)
    assert filters.filter_telemetry(rows, category="All Categories", building="BH1", meter="All Meters",
                                    date_from=T0, date_to=T0 + dt.timedelta(hours=3)).count() == 4
    assert filters.query_telemetry(rows, dt.date(2026, 8, 22), dt.date(2026, 8, 22)).count() == 24
    assert filters.query_telemetry(rows, building_ids=["XX"]).count() == 0
    assert filters.search(rows, "m0").count() == 48 and filters.search(rows, "m.0").count() == 0
    assert filters.search(rows, "m.0", "regex").count() == 48 and filters.search(rows, " ").count() == 48
    with pytest.raises(ValueError):
        filters.search(rows, "x", "fuzzy")
    assert filters.recent(rows, "timestamp", "120 minutes").count() == 3
    assert filters.at_latest(rows).count() == 1
    assert filters.category_filter(rows, "Hostels").count() == 48 == filters.category_filter(rows).count()


def test_end_date_counts_to_its_last_fraction(readings):
    rows = readings(("E1", "2026-08-22T23:59:59.500000", "M", "B", None, 1.0, 1.0, 1.0, 1.0))
    assert filters.query_telemetry(rows, end_date=dt.date(2026, 8, 22)).count() == 1


def test_kpis_take_the_last_known_value(readings):
    rows = readings(("E1", "2026-08-22T00:00:00", "M001", "BH1", "Hostels", 10.0, 228.0, 1.0, 0.9),
                    ("E2", "2026-08-22T01:00:00", "M001", "BH1", "Hostels", None, 232.0, 1.0, 0.8),
                    ("E3", "2026-08-22T00:00:00", "M002", "CS", None, 5.0, 230.0, 1.0, 1.0))
    found = profiles.kpis(rows).first().asDict()
    assert (found["total_records"], found["total_meters"], found["total_buildings"], found["total_categories"]) == (3, 2, 2, 1)
    assert (found["current_total_load_kw"], found["avg_voltage"], found["avg_power_factor"]) == (15.0, 231.0, 0.9)
    assert (found["avg_power_kw"], found["peak_power_kw"], found["min_power_kw"]) == (7.5, 10.0, 5.0)
    assert found["latest_time"] == dt.datetime(2026, 8, 22, 1, 0)


def test_kpis_of_an_empty_table(readings, spark):
    found = profiles.kpis(hours(readings, 1).limit(0)).first()
    assert found["total_records"] == 0 and found["avg_power_kw"] is None


def test_kpis_count_a_meter_with_two_categories_once(readings):
    rows = readings(("E1", "2026-08-22T00:00:00", "M001", "BH1", "Hostels", 10.0, 230.0, 1.0, 0.9),
                    ("E2", "2026-08-22T01:00:00", "M001", "BH1", None, 20.0, 230.0, 1.0, 0.9))
    assert profiles.kpis(rows).first()["current_total_load_kw"] == 20.0


def test_baseline_of_a_constant_and_of_a_single_reading(readings):
    rows = readings(("E1", T0.isoformat(), "A", "B", None, 5.0, 1.0, 1.0, 1.0),
                    ("E2", T0.isoformat(), "A", "B", None, 5.0, 1.0, 1.0, 1.0),
                    ("E3", T0.isoformat(), "S", "B", None, 5.0, 1.0, 1.0, 1.0))
    found = {row["meter_id"]: row["std_kw"] for row in profiles.meter_baselines(rows).collect()}
    assert found == {"A": 1.0, "S": None}


def test_limits_and_severity(readings):
    rows = readings(("sag", T0.isoformat(), "M", "B", None, 1.0, 219.9, 1.0, 0.5),
                    ("edge", T0.isoformat(), "M", "B", None, 1.0, 220.0, 1.0, 0.88),
                    ("surge", T0.isoformat(), "M", "B", None, 1.0, 240.1, 1.0, 0.9),
                    ("gap", T0.isoformat(), "M", "B", None, 1.0, None, 1.0, None))
    found = {row["event_id"]: row["severity"] for row in limit_rules(rows).collect()}
    assert found == {"sag": "CRITICAL", "edge": None, "surge": "WARNING", "gap": None}
    counts = profiles.anomaly_counts(rows).first()
    assert tuple(counts) == (2, 1, 1, 1)
    assert profiles.anomaly_rows(rows).count() == 2


def test_resample_drops_buckets_without_a_mean(readings):
    rows = readings(("E1", "2026-08-22T00:10:00", "M", "B", "X", 1.0, 230.0, 1.0, 0.9),
                    ("E2", "2026-08-22T00:20:00", "M", "B", "X", 2.0, None, 1.0, 0.9),
                    ("E3", "2026-08-22T05:20:00", "M", "B", "Y", 2.0, None, 1.0, 0.9))
    found = profiles.resample(rows, "3h").collect()
    assert len(found) == 1 and (found[0]["total_power_kw"], found[0]["avg_voltage_v"]) == (3.0, 230.0)
    assert profiles.resample(rows, "15min").count() == 1
    assert profiles.resample(rows, "1h", category="Y").count() == 0


def test_latest_totals_without_rows(spark):
    empty = spark.createDataFrame([], "window_end timestamp_ntz, avg_power_kw double, avg_voltage_v double")
    found = live.latest_totals(empty).first()
    assert (found["load_kw"], found["voltage_v"], found["active_buildings"]) == (0.0, 231.8, 0)
