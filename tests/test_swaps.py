"""Compaction beside other writers, put-if-absent, swaps that died half way."""

import threading
import datetime as dt

import pytest

from wattlake.sources import files, lake, swaps

T0 = dt.datetime(2026, 8, 22)


def add(readings, path, start, n=3, day=0):
    lake.write_lake(readings(*[(f"E{start + i:04d}", (T0 + dt.timedelta(days=day, hours=i)).isoformat(), "M1", "B1", "Hostels",
                                1.0, 230.0, 1.0, 0.9) for i in range(n)]), path)


def ids(spark, path):
    return sorted(row[0] for row in lake.read_lake(spark, path).select("event_id").collect())


def test_of_many_writers_one_creates_the_file(spark, tmp_path):
    path, won = str(tmp_path / "log" / "1.json"), []
    def write(text):
        if files.create_once(spark, path, text):
            won.append(text)
    writers = [threading.Thread(target=write, args=(f"writer {n}",)) for n in range(12)]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    assert len(won) == 1 and files.read_text(spark, path) == won[0]
    assert files.names(spark, str(tmp_path / "log")) == ["1.json"]
    assert files.read_text(spark, str(tmp_path / "none")) is None and files.names(spark, str(tmp_path / "none")) == []


def test_compaction_keeps_rows_that_come_meanwhile(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "lake")
    for start in (0, 10, 20):
        add(readings, path, start)
    publish, late = swaps.publish, []

    def publish_late(*args, **more):
        if not late:                              # a second writer, after the staging and before the swap
            late.append(add(readings, path, 100))
        return publish(*args, **more)

    monkeypatch.setattr(swaps, "publish", publish_late)
    report = lake.compact_lake(spark, path).first()
    assert ids(spark, path) == sorted(f"E{s + i:04d}" for s in (0, 10, 20, 100) for i in range(3))
    assert (report["files_before"], report["files_after"]) == (3, 1)          # the day that grew was listed again
    assert files.names(spark, f"{path}/_staged") == []


def test_two_compactions_of_the_same_files(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "lake")
    for start in (0, 10, 20):
        add(readings, path, start)
    publish, first = swaps.publish, []

    def publish_after_another(*args, **more):
        if not first:
            first.append(True)
            lake.compact_lake(spark, path)        # the other one is done between this one's staging and its swap
        return publish(*args, **more)

    monkeypatch.setattr(swaps, "publish", publish_after_another)
    lake.compact_lake(spark, path)
    assert ids(spark, path) == sorted(f"E{s + i:04d}" for s in (0, 10, 20) for i in range(3))
    assert lake.lake_files(spark, path).count() == 1


@pytest.mark.parametrize("left_undone", ["all", "removals"])
def test_a_reader_finishes_what_a_dead_compaction_decided(spark, readings, tmp_path, monkeypatch, left_undone):
    path = str(tmp_path / "lake")
    for start in (0, 10):
        add(readings, path, start)
    expected = ids(spark, path)
    with monkeypatch.context() as patch:
        if left_undone == "all":
            patch.setattr(swaps, "settle", lambda spark, root: 0)
        else:
            patch.setattr(files, "delete", lambda spark, target: (_ for _ in ()).throw(OSError("gone")) if target.endswith(".parquet") else None)
        try:
            lake._compact_once(spark, path, 2)
        except OSError:
            pass
    assert swaps.last(spark, path) == 1
    assert ids(spark, path) == expected and lake.lake_files(spark, path).count() == 1
    swaps.settle(spark, path)
    assert ids(spark, path) == expected


def test_a_batch_is_published_once_and_the_log_stays_short(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "lake")
    monkeypatch.setattr(swaps, "KEPT", 3)
    for n in range(9):
        add(readings, path, 10 * n, day=n)
        staged, moves = swaps.staged_files(spark, path, lake.read_lake(spark, path).limit(0), ["year", "month", "day"])
        swaps.publish(spark, path, staged, moves, batch=f"s/{n}")
    assert swaps.find_batch(spark, path, "s/8") == 9 and swaps.last(spark, path) == 9
    assert len([name for name in files.names(spark, f"{path}/_log") if name.endswith(".json")]) <= 5
    with pytest.raises(swaps.Refused):            # made from a listing older than the log: not decidable any more
        swaps.publish(spark, path, "x", [], ["a.parquet"], base=1)


def test_large_files_stay_as_they_are(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "lake")
    for start in (0, 10, 20):
        add(readings, path, start)
    monkeypatch.setattr(lake, "SMALL_FILE", 10)
    assert lake.compact_lake(spark, path).first()["status"] == "SKIPPED" and lake.lake_files(spark, path).count() == 3
