import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from wattlake.operators import live, profiles
from wattlake.operators.isolation_forest import isolation_forest_fit, with_features
from wattlake.functions.calendar import add_partitions
from wattlake.sources.lake import compact_lake, read_lake
from wattlake.sources.telemetry import parse_telemetry, telemetry_stream
from wattlake.streaming import jobs
from wattlake.streaming.windows import flatten_window, sliding_building_averages

T0 = dt.datetime(2026, 8, 22, 10, 0)


def event(n, minutes, building="BH1", **over):
    row = {"event_id": f"E{n:05d}", "timestamp": (T0 + dt.timedelta(minutes=minutes)).isoformat(), "meter_id": f"M{n % 3:03d}",
           "building_id": building, "building_type": "Hostels", "power_kw": 10.0 + n % 7, "voltage_v": 230.0,
           "current_a": 5.0, "power_factor": 0.95}
    return json.dumps({**row, **over})


def put(folder, *batches):
    """One file per batch; the file source takes them in this order."""
    import os
    folder.mkdir(exist_ok=True)
    start = len(list(folder.iterdir()))
    for i, lines in enumerate(batches, start):
        file = folder / f"{i:03d}.json"
        file.write_text("\n".join(lines) + "\n")
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def stream(spark, path, **options):
    return parse_telemetry(telemetry_stream(spark, "text", {"maxFilesPerTrigger": "1", **options}, path))


def as_rows(df):
    columns = ("window_start", "window_end", "building_id", "avg_power_kw", "avg_voltage_v", "avg_power_factor")
    return sorted(str(tuple(row)) for row in df.select(*[F.col(c).cast("string") if c[:6] == "window" else
                  (F.col(c).cast("double") if c != "building_id" else F.col(c)) for c in columns]).collect())


def test_unparsable_messages_are_dropped_and_bad_fields_are_null(spark, tmp_path):
    path = put(tmp_path / "in", [event(1, 0), "not json", "{}", event(2, 0, power_kw="much")])
    rows = parse_telemetry(spark.read.text(path)).orderBy("event_id").collect()
    assert [(row["event_id"], row["power_kw"]) for row in rows] == [("E00001", 11.0), ("E00002", None)]
    assert rows[0]["building_type"] == "Hostels"


def test_stream_equals_batch(spark, tmp_path):
    batches = [[event(n, n / 4 + b, building=f"B{n % 2}") for n in range(b * 20, b * 20 + 20)] for b in range(3)]
    path = put(tmp_path / "in", *batches)
    query = jobs.sink_window_aggregates(sliding_building_averages(stream(spark, path)), str(tmp_path / "out"),
                                        str(tmp_path / "cp"), None)
    query.awaitTermination()
    served = jobs.read_window_aggregates(spark, str(tmp_path / "out"))
    assert served.count() > live.latest_version(served).count()  # windows were refined
    batch = flatten_window(sliding_building_averages(parse_telemetry(spark.read.text(path))))
    assert as_rows(live.latest_version(served)) == as_rows(batch)


def test_window_must_be_a_multiple_of_the_slide(readings):
    from wattlake.schema import StreamTiming
    with pytest.raises(ValueError):
        sliding_building_averages(readings(), StreamTiming(window="5 minutes", slide="2 minutes"))


def test_late_rows_are_dropped(spark, tmp_path):
    # the watermark moves with the second file; its effect starts one batch later
    path = put(tmp_path / "in", [event(1, 0)], [event(2, 60)], [event(3, 61)], [event(4, 0, building="LATE")],
               [event(5, 62)])
    query = jobs.sink_window_aggregates(sliding_building_averages(stream(spark, path)), str(tmp_path / "out"),
                                        str(tmp_path / "cp"), None)
    query.awaitTermination()
    found = {row[0] for row in jobs.read_window_aggregates(spark, str(tmp_path / "out")).select("building_id").collect()}
    assert found == {"BH1"}


def test_two_sinks_of_one_stream_and_restart(spark, tmp_path):
    path = put(tmp_path / "in", [event(n, n) for n in range(10)])
    folders = [str(tmp_path / name) for name in ("serving", "lake", "cp")]
    for query in jobs.start_telemetry_queries(stream(spark, path), *folders, available_now=True):
        query.awaitTermination()
    assert read_lake(spark, folders[1]).count() == 10
    put(tmp_path / "in", [event(n, n) for n in range(10, 15)])
    for query in jobs.start_telemetry_queries(stream(spark, path), *folders, available_now=True):
        query.awaitTermination()
    lake = read_lake(spark, folders[1])
    assert lake.count() == 15 and lake.select("event_id").distinct().count() == 15  # nothing twice
    assert {"year", "month", "day"} <= set(lake.columns)
    report = compact_lake(spark, folders[1]).first()                     # in place, and the stream goes on
    assert (report["status"], report["files_before"], report["files_after"]) == ("COMPACTED", 2, 1)
    put(tmp_path / "in", [event(n, n) for n in range(15, 18)])
    for query in jobs.start_telemetry_queries(stream(spark, path), *folders, available_now=True):
        query.awaitTermination()
    assert sorted(row[0] for row in read_lake(spark, folders[1]).select("event_id").collect()) == [f"E{n:05d}" for n in range(18)]
    assert not (tmp_path / "lake" / "_staged").exists() or not list((tmp_path / "lake" / "_staged").iterdir())


def test_a_lake_of_the_file_sink_is_compacted_into_another_folder(spark, tmp_path):
    path, lake = put(tmp_path / "in", [event(n, n) for n in range(10)]), str(tmp_path / "lake")
    add_partitions(stream(spark, path)).writeStream.format("parquet").option("path", lake).partitionBy("year", "month", "day") \
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    with pytest.raises(ValueError):
        compact_lake(spark, lake)
    with pytest.raises(ValueError):
        jobs.stream_to_lake(stream(spark, path), lake, str(tmp_path / "cp2"), None)
    compact_lake(spark, lake, into=str(tmp_path / "compacted"))
    assert read_lake(spark, str(tmp_path / "compacted")).count() == 10


def test_a_retried_batch_replaces_its_first_attempt(spark, tmp_path):
    rows = spark.createDataFrame([(1.0,), (2.0,)], "power_kw double")
    for _ in range(2):
        jobs._write_batch(rows, 7, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_scoring_writes_readings_with_verdicts_and_alerts(spark, tmp_path):
    history = parse_telemetry(spark.read.text(put(tmp_path / "history", [event(n, n) for n in range(300)])))
    model = isolation_forest_fit(with_features(history), trees=10)
    baselines = profiles.meter_baselines(history)
    path = put(tmp_path / "in", [event(1, 0), event(2, 1, power_kw=500.0), event(3, 2, voltage_v=214.2, power_factor=0.5)])
    jobs.score_stream(stream(spark, path), baselines, str(tmp_path / "r"), str(tmp_path / "a"), str(tmp_path / "cp"),
                      model, None).awaitTermination()
    found = {row["event_id"]: row for row in spark.read.parquet(str(tmp_path / "r")).collect()}
    assert found["E00001"]["primary_reason"] == "NOMINAL" or found["E00001"]["ml_anomaly"]
    assert any("Load Spike" in reason for reason in found["E00002"]["reasons"])
    assert found["E00003"]["is_anomaly"]
    raised = spark.read.parquet(str(tmp_path / "a")).orderBy("alert_type").collect()
    assert [(row["event_id"], row["alert_type"], float(row["metric_value"])) for row in raised] == [
        ("E00003", "LOW_POWER_FACTOR", 0.5), ("E00003", "VOLTAGE_SAG", 214.2)]


def test_processing_time_trigger(spark, tmp_path):
    path = put(tmp_path / "in", [event(n, n) for n in range(4)])
    query = jobs.sink_readings_and_alerts(stream(spark, path), str(tmp_path / "r"), str(tmp_path / "a"),
                                          str(tmp_path / "cp"), interval="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(str(tmp_path / "r")).count() == 4
