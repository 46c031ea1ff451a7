import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wattlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def readings(spark):
    """Builds readings from (event_id, time, meter, building, type, kW, V, A, pf) tuples."""
    schema = ("event_id string, timestamp timestamp_ntz, meter_id string, building_id string, "
              "building_type string, power_kw double, voltage_v double, current_a double, power_factor double")

    def build(*rows):
        import datetime as dt
        typed = [(r[0], dt.datetime.fromisoformat(r[1]) if r[1] else None, *r[2:]) for r in rows]
        return spark.createDataFrame(typed, schema)
    return build


@pytest.fixture(scope="session")
def campus(spark):
    """A small catalog: (buildings, meters)."""
    buildings = spark.createDataFrame(
        [("BH1", "Hostel 1", "Hostels", 120.0, "North"), ("CS", "Computing", "Departments", 90.0, "East")],
        "building_id string, building_name string, category string, peak_capacity_kw double, zone string")
    meters = spark.createDataFrame(
        [("M001", "BH1", "Smart Sub-Meter", "ACTIVE"), ("M002", "CS", "Main Meter", "MAINTENANCE")],
        "meter_id string, building_id string, meter_type string, status string")
    return buildings, meters
