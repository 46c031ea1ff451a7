"""Bronze, silver and gold."""

from __future__ import annotations

from wattlake import fixtures as fx
from wattlake.functions.electrical import clamp_electrical, quality_flags
from wattlake.operators.joins import enrich_left
from wattlake.plans import medallion as m
from wattlake.registry.base import mean, register, rnd, total
from wattlake.schema import MartContract
from wattlake.session import stored


def silver(spark, sf_dir):
    rows = m.silver(m.bronze(fx.readings(spark, sf_dir)), fx.buildings(spark, sf_dir), fx.meters(spark, sf_dir))
    return rows.drop("_ingested_at")


@register("bronze", "SELECT * FROM bronze_rows")
def _(spark, sf_dir):
    return m.bronze(fx.readings(spark, sf_dir)).drop("_ingested_at")


@register("dedup_latest", "SELECT * FROM dedup_rows WHERE timestamp IS NOT NULL AND power_kw IS NOT NULL")
def _(spark, sf_dir):
    return m.valid_rows(m.dedup_latest(m.bronze(fx.readings(spark, sf_dir)).drop("_ingested_at")))


@register("enrich_left", """
    SELECT t.*, COALESCE(b.building_name, t.building_id) AS building_name,
           COALESCE(b.category, t.building_type, 'Facilities') AS category,
           COALESCE(b.zone, 'General Zone') AS zone,
           COALESCE(b.peak_capacity_kw, 100.0::DOUBLE) AS building_capacity_kw,
           COALESCE(m.meter_type, 'Smart Sub-Meter') AS meter_type
    FROM (SELECT * EXCLUDE (raw_ts) FROM telemetry) t
    LEFT JOIN buildings b ON t.building_id = b.building_id LEFT JOIN meters m ON t.meter_id = m.meter_id""")
def _(spark, sf_dir):
    return enrich_left(fx.readings(spark, sf_dir), fx.buildings(spark, sf_dir), fx.meters(spark, sf_dir))


@register("clamp_electrical", """
    SELECT event_id, CASE WHEN power_kw > 0 THEN power_kw ELSE 0.0::DOUBLE END AS power_kw,
           CASE WHEN current_a > 0 THEN current_a ELSE 0.0::DOUBLE END AS current_a,
           CASE WHEN voltage_v BETWEEN 180 AND 270 THEN voltage_v ELSE 230.0::DOUBLE END AS voltage_v,
           CASE WHEN power_factor BETWEEN 0.7::DOUBLE AND 1.0::DOUBLE THEN power_factor
                WHEN power_factor > 1 THEN 1.0::DOUBLE ELSE 0.85::DOUBLE END AS power_factor
    FROM telemetry""")
def _(spark, sf_dir):
    return clamp_electrical(fx.readings(spark, sf_dir)) \
        .select("event_id", "power_kw", "current_a", "voltage_v", "power_factor")


@register("quality_flags", """
    SELECT event_id, COALESCE(voltage_v NOT BETWEEN 200 AND 250, FALSE) AS is_voltage_sag_swell,
           COALESCE(power_factor < 0.85::DOUBLE, FALSE) AS is_low_power_factor FROM telemetry""")
def _(spark, sf_dir):
    return quality_flags(fx.readings(spark, sf_dir)) \
        .select("event_id", "is_voltage_sag_swell", "is_low_power_factor")


register("silver", "SELECT * FROM silver_rows")(silver)


@register("hourly_facility_demand", f"""
    SELECT md5(concat(strftime(hour_window, '%Y-%m-%d %H:00:00'), '_', building_id)) AS hourly_facility_id,
           strftime(hour_window, '%Y-%m-%d %H:00:00') AS hour_timestamp, *
    FROM (SELECT date_trunc('hour', timestamp) AS hour_window, building_id, building_name, category, zone,
                 COUNT(DISTINCT meter_id) AS active_meter_count, COUNT(*) AS sample_count,
                 {rnd(mean('power_kw'), 2)} AS avg_power_kw, {rnd('MAX(power_kw)', 2)} AS peak_power_kw,
                 {rnd('MIN(power_kw)', 2)} AS min_power_kw,
                 {rnd(total('power_kw') + ' / COUNT(*)', 2)} AS total_kwh,
                 {rnd(mean('voltage_v'), 1)} AS avg_voltage_v, {rnd(mean('power_factor'), 3)} AS avg_power_factor,
                 COUNT(*) FILTER (WHERE is_voltage_sag_swell) AS voltage_anomalies_count,
                 COUNT(*) FILTER (WHERE is_low_power_factor) AS low_pf_anomalies_count
          FROM silver_rows GROUP BY ALL)""")
def hourly_facility_demand(spark, sf_dir):
    return m.hourly_facility_demand(silver(spark, sf_dir))


def _daily_sql(limit: float, penalty: float) -> str:
    return f"""
    SELECT *, {limit}::DOUBLE AS contract_demand_limit_kw,
           {rnd(f'GREATEST(0.0::DOUBLE, peak_campus_demand_kw - {limit})', 2)} AS overload_kw,
           peak_campus_demand_kw > {limit} AS is_contract_breached,
           {rnd(f'GREATEST(0.0::DOUBLE, peak_campus_demand_kw - {limit}) * {penalty}', 2)}
               AS demand_penalty_exposure_inr,
           CASE WHEN peak_campus_demand_kw > {limit} + 50 THEN '{m.TIER_3}'
                WHEN peak_campus_demand_kw > {limit} THEN '{m.TIER_2}'
                WHEN peak_campus_demand_kw > {limit} * 0.9::DOUBLE
                    THEN '{m.TIER_1}'
                ELSE '{m.TIER_NONE}' END AS recommended_dispatch_tier
    FROM (SELECT strftime(hour_window, '%Y-%m-%d') AS dispatch_date, COUNT(*) AS active_hours,
                 {rnd(mean('kw'), 2)} AS avg_campus_demand_kw, {rnd('MAX(kw)', 2)} AS peak_campus_demand_kw,
                 {rnd('MIN(kw)', 2)} AS min_campus_demand_kw, {rnd(total('kw'), 2)} AS total_daily_kwh
          FROM campus_hours GROUP BY 1)"""


@register("daily_dispatch", _daily_sql(800.0, 750.0))
def _(spark, sf_dir):
    return m.daily_dispatch(silver(spark, sf_dir))


@register("daily_dispatch_all_tiers", _daily_sql(1300.0, 750.0))
def _(spark, sf_dir):
    return m.daily_dispatch(silver(spark, sf_dir), MartContract(limit_kw=1300.0))


EFFICIENCY_SQL = f"""
    SELECT *, dense_rank() OVER (PARTITION BY category ORDER BY load_factor DESC NULLS LAST)
               AS category_efficiency_rank,
           {rnd('peak_demand_kw / NULLIF((SELECT ' + total('peak_demand_kw') + ' FROM efficiency_totals ), 0) * 100', 2)}
               AS peak_campus_contribution_pct
    FROM efficiency_totals"""


@register("facility_totals", "SELECT * FROM efficiency_totals")
def _(spark, sf_dir):
    return m.facility_totals(silver(spark, sf_dir))


@register("facility_efficiency", EFFICIENCY_SQL)
def _(spark, sf_dir):
    totals = stored(m.facility_totals(silver(spark, sf_dir)), "facility-totals")
    return m.rank_in_category(m.peak_share(totals))
