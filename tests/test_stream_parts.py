"""Streams of several micro-batches: how many files a batch has, how many batches a folder of many files
makes, and which days are merged."""

import datetime as dt
import glob

import pytest

from wattlake.registry import ingest, streams
from wattlake.registry.base import QUERIES
from wattlake.streaming import jobs

EVENTS, FILES = 600, 20
DATES = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=n * 6 // 5) for n in range(EVENTS)]      # thirty days, in order


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Events in a folder of many files, so that Spark reads them in many tasks; k is what makes alerts."""
    folder = tmp_path_factory.mktemp("tables")
    rows = [(n, DATES[n], n % 7, "error" if n % 11 == 0 else "click", float(n % 90), f'{{"k": {n % 60}}}') for n in range(EVENTS)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .repartition(FILES).write.parquet(f"{folder}/events.parquet")
    for name, schema, values in (
            ("customer", "c_custkey long, c_nationkey int, c_mktsegment string", [(n, n % 3, "HOUSEHOLD") for n in range(7)]),
            ("nation", "n_nationkey int, n_name string, n_regionkey int", [(n, f"N{n}", n % 2) for n in range(3)]),
            ("region", "r_regionkey int, r_name string", [(0, "ASIA"), (1, "EUROPE")])):
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture
def scratch(spark, tmp_path, monkeypatch):
    """Scratch folders of the query at hand, by purpose, and shuffle partitions that stay apart."""
    for module in (ingest, streams):
        monkeypatch.setattr(module, "scratch_dir", lambda spark, purpose: f"{tmp_path}/{purpose}")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield tmp_path
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def batches(checkpoint):
    return len(glob.glob(f"{checkpoint}/commits/[0-9]*"))


@pytest.mark.parametrize("name", ["streamed_verdicts", "streamed_fault_cards", "late_readings", "streamed_lake_compacted"])
def test_a_part_of_a_stream_is_one_batch_of_many_files(spark, tables, scratch, name):
    rows = QUERIES[name](spark, tables).collect()
    assert rows if name == "streamed_fault_cards" else len({row["event_id"] for row in rows}) == len(rows) == EVENTS
    folder, = glob.glob(f"{scratch}/stream-*")
    assert len(glob.glob(f"{folder}/in/*.parquet")) >= 6 and batches(f"{folder}/checkpoint") == 3


@pytest.mark.parametrize("name, purpose", [("json_stream_alerts", "json-alerts"), ("json_stream_lake", "json-lake")])
def test_batches_of_a_folder_do_not_follow_its_files(spark, tables, scratch, name, purpose):
    found = {row["event_id"] for row in QUERIES[name](spark, tables).collect()}
    assert len(glob.glob(f"{scratch}/messages/part-*")) > ingest.BATCHES
    assert 1 < batches(f"{scratch}/{purpose}/checkpoint") <= ingest.BATCHES
    assert len(found) == EVENTS or purpose == "json-alerts" and found


def test_a_large_day_in_one_folder_is_not_written_again(spark, tmp_path):
    target = str(tmp_path / "cards")
    for batch, days in ((0, (1, 2)), (1, (2, 3)), (2, (3,))):
        for _ in range(2):                                        # two files for each day of a batch
            spark.createDataFrame([(f"2026-08-0{day}", "s", batch, 1, f"E{batch}{day}") for day in days],
                                  "event_day string, stream string, batch_id long, written_at long, event_id string") \
                .coalesce(1).write.mode("append").partitionBy(*jobs.BATCH_COLUMNS).parquet(target)
    first = set(glob.glob(f"{target}/event_day=2026-08-01/**/*.parquet", recursive=True))
    assert jobs.merge_batches(spark, target) == 1 and jobs.merge_batches(spark, target) == 0
    assert len(first) == 2 and set(glob.glob(f"{target}/event_day=2026-08-01/**/*.parquet", recursive=True)) == first
    assert {path.split("/")[-2] for path in glob.glob(f"{target}/event_day=2026-08-02/stream=merged/*/*.parquet")} == {"batch_id=0"}
    assert sorted(row[0] for row in spark.read.parquet(target).select("event_id").collect()) == \
        sorted(2 * ["E01", "E02", "E12", "E13", "E23"])
