"""The plans the engine relies on at scale."""

import datetime as dt
import re

import pytest

import __spark_entry__ as entry_point
from wattlake import fixtures as fx
from wattlake.operators import filters, joins, keyed, profiles
from wattlake.plans import medallion
from wattlake.session import stored
from wattlake.sources import lake

QUERIES = entry_point.queries()
WRITES = ("lake", "compact", "snapshot", "commit", "contracts", "pipeline", "streamed", "forecast", "isolation")
LAZY = [name for name in sorted(QUERIES) if not any(word in name for word in WRITES)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake_path(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "lake")
    lake.write_lake(fx.readings(spark, sf_dir), path)
    return path


def test_no_query_crosses_or_loops(spark, sf_dir):
    for name in LAZY:
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "SortAggregate" not in plan and "BatchEvalPython" not in plan, name


def test_dates_prune_partition_directories(spark, lake_path):
    rows = lake.read_lake(spark, lake_path)
    asked = filters.query_telemetry(rows, dt.date(2024, 1, 5), dt.date(2024, 1, 6))
    text = spark._jvm.PythonSQLUtils.explainString(asked._jdf.queryExecution(), "formatted")
    found = re.findall(r"PartitionFilters: \[(.*)\]", text)
    assert found and all("20240105" in line and "20240106" in line for line in found)
    pruned = rows.where(filters.day_partitions_between(dt.date(2024, 1, 5), dt.date(2024, 1, 6)))
    assert {row[0] for row in pruned.select("day").distinct().collect()} == {5, 6}


def test_scans_read_only_the_needed_columns(spark, lake_path):
    plan = plan_of(profiles.category_scan(lake.read_lake(spark, lake_path)))
    assert "ReadSchema: struct<building_type:string,power_kw:double>" in plan


def test_recent_pushes_its_cutoff_to_the_scan(spark, lake_path):
    plan = plan_of(filters.recent(lake.read_lake(spark, lake_path), "timestamp", "40 minutes"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(timestamp,ScalarSubquery", plan)


def test_newest_first_pushes_its_cutoff_to_the_scan(spark, lake_path, tmp_path):
    flat = str(tmp_path / "flat")
    lake.read_lake(spark, lake_path).drop("year", "month", "day").write.parquet(flat)
    rows = keyed.newest_first(spark.read.parquet(flat), 100)
    text = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
    assert re.search(r"PushedFilters: \[Or\(GreaterThanOrEqual\(timestamp,ScalarSubquery", text)


def test_newest_first_of_a_lake_reads_its_newest_folders(spark, lake_path):
    rows = keyed.newest_first(lake.read_lake(spark, lake_path), 100)
    text = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
    assert re.search(r"PartitionFilters: \[[^\n]*make_date\(year", text)


def test_dedup_limits_each_key_before_the_shuffle(spark, lake_path):
    plan = plan_of(medallion.dedup_latest(lake.read_lake(spark, lake_path)))
    final, shuffle, partial = plan.index("Final"), plan.index("Exchange hashpartitioning"), plan.index("Partial")
    assert final < shuffle < partial  # printed from the last step to the first


def test_stored_catalogs_are_broadcast_and_readings_not_moved(spark, sf_dir, lake_path):
    buildings = stored(fx.buildings(spark, sf_dir), "buildings")
    meters = stored(fx.meters(spark, sf_dir), "meters")
    plan = plan_of(joins.enrich_left(lake.read_lake(spark, lake_path), buildings, meters))
    assert plan.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in plan


def test_large_catalogs_are_not_broadcast(spark, sf_dir, lake_path):
    meters = stored(fx.meters(spark, sf_dir), "meters")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1b")
    try:
        plan = plan_of(lake.read_lake(spark, lake_path).join(meters, "meter_id"))
        rows = joins.star_rows(lake.read_lake(spark, lake_path), meters, stored(fx.buildings(spark, sf_dir), "b"))
        assert "SortMergeJoin" in plan and "SortMergeJoin" in plan_of(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_marts_have_no_single_partition_exchange_on_readings(spark, lake_path, sf_dir):
    rows = medallion.silver(medallion.bronze(lake.read_lake(spark, lake_path)),
                            stored(fx.buildings(spark, sf_dir), "b"), stored(fx.meters(spark, sf_dir), "m"))
    for mart in (medallion.hourly_facility_demand(rows), medallion.daily_dispatch(rows),
                 medallion.rank_in_category(medallion.facility_totals(rows))):
        assert "SinglePartition" not in plan_of(mart)


def test_results_survive_a_hot_meter(spark, sf_dir):
    """A third of all rows on one meter, another third copies of one event."""
    rows = fx.readings(spark, sf_dir).limit(900).cache()
    one = rows.limit(1)
    for _ in range(10):
        one = one.union(one)
    hot = rows.union(one)
    kept = medallion.dedup_latest(hot)
    assert kept.exceptAll(medallion.dedup_latest(rows)).isEmpty()
    assert profiles.kpis(kept).collect() == profiles.kpis(medallion.dedup_latest(rows.repartition(3))).collect()
