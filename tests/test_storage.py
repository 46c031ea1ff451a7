import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from wattlake.schema import TELEMETRY_COLUMNS
from wattlake.sources import dimensions, lake, serving, snapshots, telemetry

T0 = dt.datetime(2026, 8, 22)


def some(readings, n=6, start=0, day=0):
    return readings(*[(f"E{start + i:04d}", (T0 + dt.timedelta(days=day, hours=i)).isoformat(), f"M00{i % 2}", "BH1",
                       "Hostels", 1.0 + i, 230.0, 1.0, 0.9) for i in range(n)])


CSV = """event_id,timestamp,meter_id,building_id,building_type,power_kw,voltage_v,current_a,power_factor
E1,2026-08-22T10:00:00,M001,BH1,Hostels,10.5,230.1,5.0,0.95
E2,2026-08-22T10:00:00,M002,BH1,Hostels,oops,230.1,5.0,0.95
E3,2026-08-23T10:00:00,M003,BH1,,10.5,230.1,5.0,0.95
E4,never,M004,BH1,Hostels,10.5,230.1,5.0,0.95
E5,2026-08-23T11:00:00,M005,BH1,Hostels,11.5,231.1,6.0,0.96
"""


def test_csv_drops_rows_with_gaps_and_bad_numbers(spark, tmp_path):
    (tmp_path / "r.csv").write_text(CSV)
    found = telemetry.read_telemetry_csv(spark, str(tmp_path / "r.csv")).orderBy("event_id").collect()
    assert [row["event_id"] for row in found] == ["E1", "E5"]
    assert found[0]["day_name"] == "Saturday" and found[0]["power_kw"] == 10.5


def test_hydrate_and_read_back(spark, tmp_path):
    (tmp_path / "r.csv").write_text(CSV)
    path = str(tmp_path / "lake")
    assert lake.hydrate_lake_from_csv(spark, str(tmp_path / "r.csv"), path) == 2
    found = lake.read_lake(spark, path)
    assert set(found.columns) == {*TELEMETRY_COLUMNS, "year", "month", "day"}
    assert glob.glob(f"{path}/year=2026/month=8/day=22/*.snappy.parquet")


def test_lake_unites_columns_by_name(spark, readings, tmp_path):
    path = str(tmp_path / "lake")
    lake.write_lake(some(readings), path)
    lake.write_lake(some(readings, start=10, day=1).withColumn("ambient_temp_c", F.lit(21.0)), path)
    found = lake.read_lake(spark, path)
    assert "ambient_temp_c" in found.columns and found.where("ambient_temp_c IS NULL").count() == 6
    narrow = lake.read_lake(spark, path, found.select("event_id", "ambient_temp_c", "year", "month", "day").schema)
    assert narrow.where("ambient_temp_c = 21").count() == 6


def test_write_lake_parses_text_times_and_ignores_empty_input(spark, readings, tmp_path):
    path = str(tmp_path / "lake")
    rows = some(readings).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
    assert lake.write_lake(rows, path) == 6
    assert lake.write_lake(rows.limit(0), path) == 0
    assert lake.read_lake(spark, path).count() == 6


def test_large_days_are_split_over_files(spark, tmp_path):
    rows = spark.range(200_000).select(
        F.concat(F.lit("E"), F.col("id").cast("string")).alias("event_id"), F.lit(T0).cast("timestamp_ntz").alias("timestamp"),
        F.md5(F.col("id").cast("string")).alias("meter_id"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        lake.write_lake(rows, str(tmp_path / "lake"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert lake.lake_files(spark, str(tmp_path / "lake")).count() > 2


def fragmented(spark, readings, path):
    for i in range(3):
        lake.write_lake(some(readings, start=10 * i), path)
    lake.write_lake(some(readings, start=90, day=1), path)


def test_compaction_keeps_rows_and_touches_only_crowded_days(spark, readings, tmp_path):
    path = str(tmp_path / "lake")
    fragmented(spark, readings, path)
    quiet = glob.glob(f"{path}/year=2026/month=8/day=23/*.parquet")
    rows = lake.read_lake(spark, path).collect()
    report = {row["partition"]: row for row in lake.compact_lake(spark, path).collect()}
    crowded = report["year=2026/month=8/day=22"]
    assert (crowded["status"], crowded["files_before"], crowded["files_after"]) == ("COMPACTED", 3, 1)
    assert report["year=2026/month=8/day=23"]["status"] == "SKIPPED"
    assert glob.glob(f"{path}/year=2026/month=8/day=23/*.parquet") == quiet
    assert sorted(map(str, lake.read_lake(spark, path).collect())) == sorted(map(str, rows))
    again = lake.compaction_totals(lake.compact_lake(spark, path)).first()
    assert (again["partitions_checked"], again["partitions_compacted"], again["total_bytes_saved"]) == (2, 0, 0)


def test_compaction_into_another_folder(spark, readings, tmp_path):
    path, target = str(tmp_path / "lake"), str(tmp_path / "compacted")
    fragmented(spark, readings, path)
    lake.compact_lake(spark, path, into=target)
    assert lake.lake_files(spark, path).count() == 4 and lake.lake_files(spark, target).count() == 2
    assert lake.read_lake(spark, target).exceptAll(lake.read_lake(spark, path)).isEmpty()


def test_metadata_of_a_full_an_empty_and_a_missing_lake(spark, readings, tmp_path):
    path = str(tmp_path / "lake")
    fragmented(spark, readings, path)
    found = lake.lake_metadata(spark, path).first()
    assert (found["exists"], found["total_files"], found["total_records"], found["meters_count"],
            found["buildings_count"]) == (True, 4, 24, 2, 1)
    assert found["partitions"] == ["year=2026/month=8/day=22", "year=2026/month=8/day=23"]
    assert found["min_timestamp"] == T0
    (tmp_path / "empty").mkdir()
    assert lake.lake_metadata(spark, str(tmp_path / "empty")).first()["exists"] is True
    missing = lake.lake_metadata(spark, str(tmp_path / "none")).first()
    assert (missing["exists"], missing["total_records"], missing["partitions"]) == (False, 0, [])


def test_query_lake_takes_named_arguments(readings):
    found = lake.query_lake(some(readings), "SELECT COUNT(*) AS n FROM telemetry_lake WHERE power_kw > :least", {"least": 3.0})
    assert found.first()["n"] == 3


def test_processed_csv(spark, readings, tmp_path):
    serving.write_processed_csv(some(readings, 1), str(tmp_path / "out"))
    found = spark.read.option("header", True).csv(str(tmp_path / "out")).first()
    assert found["apparent_power_kva"] == "1.11" and found["reactive_power_kvar"] == "0.48"


def test_dimensions_from_csv_by_name(spark, tmp_path):
    (tmp_path / "b.csv").write_text("zone,building_id,building_name,category,peak_capacity_kw\nNorth,BH1,One,Hostels,120.0\n")
    (tmp_path / "m.csv").write_text("meter_id,building_id,meter_type,status\nM001,BH1,Smart Sub-Meter,ACTIVE\n")
    buildings, meters = dimensions.read_dimensions(spark, str(tmp_path / "b.csv"), str(tmp_path / "m.csv"))
    assert buildings.first()["peak_capacity_kw"] == 120.0 and buildings.first()["zone"] == "North"
    assert meters.first()["meter_id"] == "M001"


def test_meters_run_through_the_buildings(spark):
    counts = spark.createDataFrame([(1, "BH1", "Hostels", 2), (2, "CS", "Departments", 0), (3, "LT", "Lecture Theatres", 998)],
                                   "o int, building_id string, building_type string, meter_count int")
    found = dimensions.expand_meters(counts, ["o"])
    ids = {row["meter_id"]: row["building_id"] for row in found.collect()}
    assert len(ids) == 1000 and ids["M001"] == "BH1" and ids["M003"] == "LT" and ids["M1000"] == "LT"


def test_upsert_changes_listed_columns_only(spark, campus):
    updates = spark.createDataFrame([("CS", "Renamed", "Labs"), ("NEW", "New", "Facilities")],
                                    "building_id string, building_name string, category string")
    found = {row["building_id"]: row for row in
             dimensions.upsert(campus[0], updates, "building_id", ["category"]).collect()}
    assert (found["CS"]["building_name"], found["CS"]["category"], found["CS"]["zone"]) == ("Computing", "Labs", "East")
    assert (found["NEW"]["building_name"], found["NEW"]["zone"], found["BH1"]["category"]) == ("New", None, "Hostels")


def test_versioned_table_lifecycle(spark, readings, tmp_path):
    path = str(tmp_path / "table")
    assert snapshots.latest_version(spark, path) is None
    base = some(readings).withColumns({"year": F.year("timestamp"), "month": F.month("timestamp"), "day": F.dayofmonth("timestamp")})
    assert snapshots.snapshot_init(base, path) == {"operation": "INIT", "version": 0, "rows": 6}
    evolved = base.limit(4).withColumns({"ambient_temp_c": F.lit(28.6), "humidity_pct": F.lit(59.0)})
    assert snapshots.snapshot_append(evolved, path)["version"] == 1
    snapshots.snapshot_append(base.limit(5), path)
    snapshots.snapshot_append(base.limit(5), path)
    first = snapshots.read_snapshot(spark, path, 0)
    assert "ambient_temp_c" not in first.columns and first.exceptAll(base).isEmpty() and first.count() == 6
    latest = snapshots.read_snapshot(spark, path)
    assert latest.count() == 20 and latest.where("ambient_temp_c IS NULL").count() == 16
    found = snapshots.compare_snapshots(spark, path, 0, 3).first()
    assert found["schema_evolved"] and found["row_delta"] == 14 and found["removed_columns"] == []
    assert found["added_columns"] == ["ambient_temp_c", "humidity_pct"]

    rows = sorted(map(str, latest.collect()))
    assert snapshots.snapshot_compact(spark, path) == {"operation": "OPTIMIZE", "version": 4, "rows": 20}
    assert sorted(map(str, snapshots.read_snapshot(spark, path).collect())) == rows
    assert len(snapshots.read_snapshot(spark, path).inputFiles()) == 1
    assert snapshots.read_snapshot(spark, path, 1).count() == 10
    snapshots.snapshot_append(base, path)
    assert snapshots.read_snapshot(spark, path).count() == 26
    history = snapshots.commit_history(spark, path).collect()
    assert [row["version"] for row in history] == [5, 4, 3, 2, 1, 0]
    assert history[1]["operation"] == "OPTIMIZE" and history[-1]["timestamp"].endswith(" UTC")


def test_versioned_table_rejects_unknown_versions_and_changed_types(spark, readings, tmp_path):
    path = str(tmp_path / "table")
    snapshots.snapshot_init(some(readings), path, partition_by=[], max_records=3)
    assert snapshots.read_snapshot(spark, path, limit=2).count() == 2
    with pytest.raises(ValueError):
        snapshots.read_snapshot(spark, path, 7)
    with pytest.raises(ValueError):
        snapshots.snapshot_append(some(readings).withColumn("power_kw", F.lit("x")), path)


def test_files_without_a_commit_are_not_read(spark, readings, tmp_path):
    path = str(tmp_path / "table")
    snapshots.snapshot_init(some(readings), path, partition_by=[])
    some(readings).write.parquet(f"{path}/data/write_id=v1-lost")
    assert snapshots.read_snapshot(spark, path).count() == 6
