"""Schemas of the data model and the rule constants used as defaults."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


MEASURES = ("power_kw", "voltage_v", "current_a", "power_factor")

# One reading as it travels on the topic.  TIMESTAMP, not TIMESTAMP_NTZ, because
# watermarks need it.
TELEMETRY_JSON = _struct(
    ("event_id", T.StringType()),
    ("timestamp", T.TimestampType()),
    ("meter_id", T.StringType()),
    ("building_id", T.StringType()),
    ("building_type", T.StringType()),
    *[(name, T.DoubleType()) for name in MEASURES],
)

TELEMETRY_COLUMNS = TELEMETRY_JSON.fieldNames()

# CSV files are scanned as text and cast afterwards: a bad number becomes null
# for that field alone.
TELEMETRY_CSV = _struct(*[(name, T.StringType()) for name in TELEMETRY_COLUMNS])

BUILDINGS = _struct(
    ("building_id", T.StringType()),
    ("building_name", T.StringType()),
    ("category", T.StringType()),
    ("peak_capacity_kw", T.DoubleType()),
    ("zone", T.StringType()),
)

METERS = _struct(
    ("meter_id", T.StringType()),
    ("building_id", T.StringType()),
    ("meter_type", T.StringType()),
    ("status", T.StringType()),
)

PARTITION_COLUMNS = ("year", "month", "day")

# Types of the serving tables.
SERVING_DECIMALS = {
    "power_kw": "decimal(8,2)", "voltage_v": "decimal(8,2)",
    "current_a": "decimal(8,2)", "power_factor": "decimal(5,3)",
    "avg_power_kw": "decimal(8,2)", "avg_voltage_v": "decimal(8,2)",
    "avg_power_factor": "decimal(5,3)",
    "metric_value": "decimal(8,2)", "threshold_value": "decimal(8,2)",
}


@dataclass(frozen=True)
class AlertLimits:
    """Limits for power-quality alerts (fixed values)."""

    sag_below_v: float = 220.0
    surge_above_v: float = 240.0
    low_pf_below: float = 0.88


@dataclass(frozen=True)
class SilverRules:
    """Plausibility bounds, replacement values and flag bounds (fixed values)."""

    voltage_low: float = 180.0
    voltage_high: float = 270.0
    voltage_default: float = 230.0
    pf_low: float = 0.70
    pf_high: float = 1.00
    pf_default: float = 0.85
    flag_voltage_low: float = 200.0
    flag_voltage_high: float = 250.0
    flag_pf_below: float = 0.85
    default_category: str = "Facilities"
    default_zone: str = "General Zone"
    default_capacity_kw: float = 100.0
    default_meter_type: str = "Smart Sub-Meter"


@dataclass(frozen=True)
class MartContract:
    """Contract demand used by the daily mart (fixed values)."""

    limit_kw: float = 800.0
    penalty_per_kw: float = 750.0


@dataclass(frozen=True)
class ScoreDefaults:
    """Scoring of single readings (fixed values)."""

    z_threshold: float = 3.0
    unknown_mean_kw: float = 20.0
    unknown_std_kw: float = 5.0
    missing_power_kw: float = 0.0
    missing_voltage_v: float = 230.0
    missing_pf: float = 0.95


@dataclass(frozen=True)
class StreamTiming:
    """Window, slide, watermark and triggers of the streaming jobs (fixed values)."""

    window: str = "5 minutes"
    slide: str = "1 minute"
    watermark: str = "5 minutes"
    aggregate_trigger: str = "15 seconds"
    lake_trigger: str = "30 seconds"
    score_trigger: str = "2 seconds"
