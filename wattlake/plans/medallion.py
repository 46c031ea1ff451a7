"""Bronze, silver and the three gold marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.calendar import DAY_TEXT, HOUR_TEXT, hour_start
from wattlake.functions.electrical import clamp_electrical, quality_flags
from wattlake.functions.numeric import (exact_avg, exact_sum, half_up, mean_from, sum_units,
                                         total_units)
from wattlake.operators.filters import valid_rows
from wattlake.operators.joins import enrich_left
from wattlake.operators.keyed import first_per_key
from wattlake.schema import MEASURES, MartContract, SilverRules

FACILITY = ("building_id", "building_name", "category", "zone")

# Dispatch tiers of the daily mart (fixed values).
TIER_3 = "Tier 3 (BESS + Chiller Cycling + Lighting)"
TIER_2 = "Tier 2 (Chiller Duty Cycling + Lighting)"
TIER_1 = "Tier 1 (Architectural Lighting & EV Setback)"
TIER_NONE = "Nominal Grid Operation"
TIER_3_MARGIN_KW = 50.0
TIER_1_SHARE = 0.90


def bronze(raw: DataFrame) -> DataFrame:
    """B-03: typed copy of the raw readings with an ingestion time."""
    text = [F.col(name).cast("string").alias(name) for name in ("event_id", "meter_id", "building_id")]
    return raw.select(
        *text,
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.coalesce(F.col("building_type").cast("string"), F.lit("Unknown")).alias("building_type"),
        *[F.col(name).cast("double").alias(name) for name in MEASURES],
        F.current_timestamp().alias("_ingested_at"))


def dedup_latest(df: DataFrame) -> DataFrame:
    """E-01: one row per meter and time, the one with the highest event id.

    The measures break ties between copies of one event, so a retried task
    picks the same row.
    """
    order = [F.desc_nulls_last(name) for name in ("event_id", *MEASURES)]
    return first_per_key(df, ["meter_id", "timestamp"], order)


def silver(bronze_rows: DataFrame, buildings: DataFrame, meters: DataFrame,
           rules: SilverRules = SilverRules()) -> DataFrame:
    """Deduplicated, valid, enriched, flagged and clamped readings.

    One shuffle, on (meter, time); the flags come before the clamp because they
    judge the raw values.
    """
    rows = valid_rows(dedup_latest(bronze_rows))
    rows = enrich_left(rows, buildings, meters, rules)
    rows = clamp_electrical(quality_flags(rows, rules), rules)
    return rows.select(
        "event_id", "timestamp", "meter_id", "building_id", "building_name", "category", "zone",
        "building_capacity_kw", "meter_type", *MEASURES,
        "is_voltage_sag_swell", "is_low_power_factor",
        *[name for name in ("_ingested_at",) if name in bronze_rows.columns])


def hourly_facility_demand(silver_rows: DataFrame) -> DataFrame:
    """D-01: demand and quality per hour and facility.

    ``total_kwh`` is the mean power of the hour (power times one hour), not the
    energy of all its meters.
    """
    hourly = silver_rows.groupBy(hour_start("timestamp").alias("hour_window"), *FACILITY).agg(
        F.count_distinct("meter_id").alias("active_meter_count"),
        F.count("*").alias("sample_count"),
        half_up(exact_avg("power_kw"), 2).alias("avg_power_kw"),
        half_up(F.max("power_kw"), 2).alias("peak_power_kw"),
        half_up(F.min("power_kw"), 2).alias("min_power_kw"),
        half_up(exact_sum("power_kw") / F.count("*"), 2).alias("total_kwh"),
        half_up(exact_avg("voltage_v"), 1).alias("avg_voltage_v"),
        half_up(exact_avg("power_factor"), 3).alias("avg_power_factor"),
        F.count_if("is_voltage_sag_swell").alias("voltage_anomalies_count"),
        F.count_if("is_low_power_factor").alias("low_pf_anomalies_count"))
    hour_text = F.date_format("hour_window", HOUR_TEXT)
    return hourly.select(
        F.md5(F.concat(hour_text, F.lit("_"), F.coalesce("building_id", F.lit("")))).alias("hourly_facility_id"),
        hour_text.alias("hour_timestamp"), *hourly.columns)


def daily_dispatch(silver_rows: DataFrame, contract: MartContract = MartContract()) -> DataFrame:
    """D-02: campus demand per day against the contract limit.

    Two levels: every sample of an hour is summed, then the hours of a day are
    compared.  The first level combines before its shuffle, the second one sees
    24 rows a day.
    """
    hourly = silver_rows.groupBy(hour_start("timestamp").alias("hour_window")) \
        .agg(sum_units("power_kw").alias("units"))
    load = mean_from("units", F.lit(1))
    daily = hourly.groupBy(F.date_format("hour_window", DAY_TEXT).alias("dispatch_date")).agg(
        F.count("*").alias("active_hours"),
        half_up(mean_from(total_units("units"), F.count("units")), 2).alias("avg_campus_demand_kw"),
        half_up(F.max(load), 2).alias("peak_campus_demand_kw"),
        half_up(F.min(load), 2).alias("min_campus_demand_kw"),
        half_up(mean_from(total_units("units"), F.lit(1)), 2).alias("total_daily_kwh"))
    peak, limit = F.col("peak_campus_demand_kw"), float(contract.limit_kw)
    over = F.greatest(F.lit(0.0), peak - limit)
    tier = (F.when(peak > limit + TIER_3_MARGIN_KW, TIER_3)
             .when(peak > limit, TIER_2)
             .when(peak > limit * TIER_1_SHARE, TIER_1)
             .otherwise(TIER_NONE))
    return daily.withColumns({
        "contract_demand_limit_kw": F.lit(limit),
        "overload_kw": half_up(over, 2),
        "is_contract_breached": peak > limit,
        "demand_penalty_exposure_inr": half_up(over * float(contract.penalty_per_kw), 2),
        "recommended_dispatch_tier": tier,
    })


def facility_totals(silver_rows: DataFrame) -> DataFrame:
    """D-03: totals per facility with the load factor (mean over peak)."""
    return silver_rows.groupBy(*FACILITY).agg(
        F.count_distinct("meter_id").alias("total_meters"),
        half_up(exact_avg("power_kw"), 2).alias("avg_demand_kw"),
        half_up(F.max("power_kw"), 2).alias("peak_demand_kw"),
        half_up(F.min("power_kw"), 2).alias("baseload_demand_kw"),
        half_up(F.try_divide(exact_avg("power_kw"), F.max("power_kw")), 3).alias("load_factor"),
        half_up(exact_avg("power_factor"), 3).alias("avg_power_factor"),
        F.count("*").alias("total_telemetry_samples"))


def rank_in_category(totals: DataFrame) -> DataFrame:
    """E-02: dense rank of the load factor within its category, best first."""
    order = Window.partitionBy("category").orderBy(F.desc_nulls_last("load_factor"))
    return totals.withColumn("category_efficiency_rank", F.dense_rank().over(order).cast("bigint"))


def peak_share(totals: DataFrame) -> DataFrame:
    """E-03: a facility's share of the sum of all peaks, in percent.

    The sum is a scalar subquery; a window over the whole table would move every
    row to one task.  Store ``totals`` first if they are costly: they are read twice.
    """
    campus = totals.agg(exact_sum("peak_demand_kw")).scalar()
    share = F.try_divide(F.col("peak_demand_kw"), campus) * 100.0
    return totals.withColumn("peak_campus_contribution_pct", half_up(share, 2))


def facility_efficiency(silver_rows: DataFrame) -> DataFrame:
    """D-03 with E-02 and E-03: the efficiency mart."""
    return rank_in_category(peak_share(facility_totals(silver_rows)))
