from pyspark.sql import functions as F

from wattlake.operators.joins import enrich_left, orphans
from wattlake.plans import medallion
from wattlake.plans.contracts import CATEGORIES, Contract, campus_contracts, range_contracts, run_contracts
from wattlake.plans.pipeline import run_pipeline
from wattlake.schema import MartContract
from wattlake.sources.serving import read_marts

T = "2026-08-23T10:00:00"


def silver_of(rows, campus):
    return medallion.silver(medallion.bronze(rows), *campus)


def test_silver_rules_row_by_row(readings, campus):
    rows = readings(
        ("E1", T, "M001", "BH1", None, 10.0, 230.0, 5.0, 0.95),
        ("E2", T, "M001", "BH1", None, 12.0, 179.9, -5.0, 1.20),  # replaces E1
        ("E3", T, "M002", "CS", "Departments", -3.0, None, None, None),
        ("E4", T, "M003", "XX", None, 1.0, 251.0, 1.0, 0.69),  # unknown meter and building
        ("E5", T, "M004", "YY", "Labs", 1.0, 200.0, 1.0, 0.70),
        ("E6", T, "M005", "BH1", None, None, 230.0, 1.0, 0.9),  # no power
        ("E7", None, "M006", "BH1", None, 1.0, 230.0, 1.0, 0.9))  # no time
    found = {row["event_id"]: row.asDict() for row in silver_of(rows, campus).collect()}
    assert sorted(found) == ["E2", "E3", "E4", "E5"]
    second = found["E2"]
    assert (second["power_kw"], second["voltage_v"], second["current_a"], second["power_factor"]) == (12.0, 230.0, 0.0, 1.0)
    assert second["is_voltage_sag_swell"] and not second["is_low_power_factor"]
    third = found["E3"]
    assert (third["power_kw"], third["voltage_v"], third["current_a"], third["power_factor"]) == (0.0, 230.0, 0.0, 0.85)
    assert not third["is_voltage_sag_swell"] and not third["is_low_power_factor"]
    fourth = found["E4"]
    assert (fourth["building_name"], fourth["category"], fourth["zone"], fourth["building_capacity_kw"],
            fourth["meter_type"]) == ("XX", "Unknown", "General Zone", 100.0, "Smart Sub-Meter")
    assert fourth["is_voltage_sag_swell"] and fourth["is_low_power_factor"] and fourth["power_factor"] == 0.85
    assert found["E5"]["category"] == "Labs" and found["E5"]["power_factor"] == 0.70


def test_category_falls_back_to_facilities(readings, campus):
    rows = readings(("E1", T, "M009", "ZZ", None, 1.0, 230.0, 1.0, 0.9))
    assert enrich_left(rows, *campus).first()["category"] == "Facilities"


def test_dedup_takes_the_same_row_in_any_partitioning(readings):
    rows = readings(*[(f"E{n % 3}", T, "M001", "BH1", None, float(n), 230.0, 1.0, 0.9) for n in range(50)])
    picks = {medallion.dedup_latest(rows.repartition(parts)).first()["power_kw"] for parts in (1, 3, 7)}
    assert picks == {47.0}  # the copy of E2 with the largest power


def test_default_contract_tiers(readings, campus):
    loads = {"2026-08-01T05:00:00": 851.0, "2026-08-02T05:00:00": 850.0, "2026-08-03T05:00:00": 800.0,
             "2026-08-04T05:00:00": 720.5, "2026-08-05T05:00:00": 720.0}
    rows = readings(*[(f"E{n}", at, "M001", "BH1", None, kw, 230.0, 1.0, 0.9)
                      for n, (at, kw) in enumerate(loads.items())])
    days = {row["dispatch_date"]: row for row in medallion.daily_dispatch(silver_of(rows, campus)).collect()}
    tiers = [days[at[:10]]["recommended_dispatch_tier"].split(" (")[0] for at in loads]
    assert tiers == ["Tier 3", "Tier 2", "Tier 1", "Tier 1", "Nominal Grid Operation"]
    first = days["2026-08-01"]
    assert (first["overload_kw"], first["demand_penalty_exposure_inr"], first["is_contract_breached"]) == (51.0, 38250.0, True)
    assert days["2026-08-03"]["overload_kw"] == 0.0 and not days["2026-08-03"]["is_contract_breached"]


def test_daily_sums_all_samples_of_an_hour(readings, campus):
    rows = readings(("E1", "2026-08-01T05:00:00", "M001", "BH1", None, 10.0, 230.0, 1.0, 0.9),
                    ("E2", "2026-08-01T05:30:00", "M001", "BH1", None, 30.0, 230.0, 1.0, 0.9),
                    ("E3", "2026-08-01T06:00:00", "M001", "BH1", None, 5.0, 230.0, 1.0, 0.9))
    day = medallion.daily_dispatch(silver_of(rows, campus), MartContract(limit_kw=30.0)).first()
    assert (day["active_hours"], day["peak_campus_demand_kw"], day["min_campus_demand_kw"],
            day["total_daily_kwh"], day["avg_campus_demand_kw"]) == (2, 40.0, 5.0, 45.0, 22.5)


def test_efficiency_ranks_and_shares(spark):
    totals = spark.createDataFrame(
        [("A", "X", 0.5, 30.0), ("B", "X", 0.9, 10.0), ("C", "X", 0.5, 20.0), ("D", "Y", None, 0.0)],
        "building_id string, category string, load_factor double, peak_demand_kw double")
    found = {row["building_id"]: row for row in
             medallion.rank_in_category(medallion.peak_share(totals)).collect()}
    assert [found[name]["category_efficiency_rank"] for name in "ABCD"] == [2, 1, 2, 1]
    assert [found[name]["peak_campus_contribution_pct"] for name in "ABCD"] == [50.0, 16.67, 33.33, 0.0]


def test_orphans_skip_null_keys(spark, campus):
    child = spark.createDataFrame([("BH1",), ("ZZ",), (None,)], "building_id string")
    assert [row[0] for row in orphans(child, campus[0], "building_id").collect()] == ["ZZ"]


def pipeline_rows(readings, bad=False):
    rows = [("E1", "2026-08-01T05:00:00", "M001", "BH1", None, 10.0, 230.0, 1.0, 0.9),
            ("E2", "2026-08-01T05:30:00", "M002", "CS", None, 30.0, 230.0, 1.0, 0.9),
            ("E3", "2026-08-02T05:30:00", "M002", "CS", None, 25.0, 230.0, 1.0, 0.9)]
    if bad:
        rows.append(("E4", "2026-08-02T05:30:00", "M099", "CS", None, 1.0, 230.0, 1.0, 0.9))
    return readings(*rows)


def test_pipeline_passes_all_34_contracts(readings, campus, spark, tmp_path):
    report = run_pipeline(pipeline_rows(readings), *campus, str(tmp_path))
    assert report.success, (report.error, report.failed_contracts)
    assert list(report.stages) == ["seed", "run", "test"]
    found = spark.read.parquet(f"{tmp_path}/contracts")
    assert found.count() == 34 == len(campus_contracts())
    assert found.groupBy().agg(F.sum("failures")).first()[0] == 0
    marts = read_marts(spark, f"{tmp_path}/gold")
    assert [row["dispatch_date"] for row in marts["daily"].collect()] == ["2026-08-02", "2026-08-01"]
    assert marts["hourly"].count() == 3 and marts["efficiency"].count() == 2


def test_pipeline_reports_the_broken_contract(readings, campus, tmp_path):
    report = run_pipeline(pipeline_rows(readings, bad=True), *campus, str(tmp_path))
    assert not report.success and report.stages == {"seed": True, "run": True, "test": False}
    assert report.failed_contracts == ["silver.meter_id relationships"]


def test_pipeline_stops_at_a_failing_stage(readings, campus, tmp_path):
    report = run_pipeline(pipeline_rows(readings).drop("power_kw"), *campus, str(tmp_path))
    assert report.stages == {"seed": True, "run": False} and "power_kw" in report.error


def test_contract_kinds_count_their_failures(spark):
    table = spark.createDataFrame([("a", 1.0), ("a", -1.0), (None, 0.0), ("z", None)], "k string, v double")
    parent = spark.createDataFrame([("a",)], "k string")
    spec = [Contract("t", "k", "not_null"), Contract("t", "k", "unique"),
            Contract("t", "k", "accepted_values", values=("a",)),
            Contract("t", "k", "relationships", parent="p", parent_key="k"),
            Contract("t", "v", "range", low=0.0, high=0.5), Contract("t", "v", "range", low=0.0, low_open=True)]
    found = run_contracts({"t": table, "p": parent}, spec).collect()
    assert sorted((row["column"], row["test"], row["failures"]) for row in found) == sorted([
        ("k", "not_null", 1), ("k", "unique", 1), ("k", "accepted_values", 1), ("k", "relationships", 1),
        ("v", "range", 2), ("v", "range", 2)])
    assert not any(row["passed"] for row in found)


def test_range_contracts_cover_silver_and_gold():
    assert {contract.model for contract in range_contracts()} == {"silver", "hourly", "daily", "efficiency"}
    assert len(CATEGORIES) == 4
