"""Limits, alerts, evaluation, isolation forest, dispatch and incident cards."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake import fixtures as fx
from wattlake.functions.electrical import limit_rules
from wattlake.operators import dispatch, incidents, profiles
from wattlake.operators.alerts import alerts
from wattlake.operators.isolation_forest import (CONTAMINATION, FEATURES, TREE_SCHEMA, IsolationForest,
                                                 isolation_forest_fit, isolation_forest_score, with_features)
from wattlake.registry.base import mean, register, rnd
from wattlake.session import stored
from wattlake.streaming.jobs import score_readings


@register("limit_rules", """
    SELECT event_id, COALESCE(voltage_v < 220, FALSE) AS is_voltage_sag, COALESCE(voltage_v > 240, FALSE) AS is_voltage_surge,
           COALESCE(power_factor < 0.88::DOUBLE, FALSE) AS is_low_pf,
           CASE WHEN voltage_v < 220 THEN 'CRITICAL'
                WHEN voltage_v > 240 OR power_factor < 0.88::DOUBLE THEN 'WARNING' END AS severity
    FROM telemetry""")
def _(spark, sf_dir):
    return limit_rules(fx.readings(spark, sf_dir)) \
        .select("event_id", "is_voltage_sag", "is_voltage_surge", "is_low_pf", "severity")


@register("alerts", "SELECT * FROM alert_rows")
def alert_rows(spark, sf_dir):
    return alerts(fx.readings(spark, sf_dir))


EVALUATE = f"""
    SELECT event_id, ml_anomaly, anomaly_score, z_score, is_anomaly,
           CASE WHEN length(reasons) = 0 THEN 'NOMINAL' ELSE split_part(reasons, '; ', 1) END AS primary_reason, reasons
    FROM (SELECT event_id, FALSE AS ml_anomaly, 0.0::DOUBLE AS anomaly_score, {rnd('z', 2)} AS z_score,
                 COALESCE(abs(z) > 3, FALSE) OR v < 220 OR v > 240 OR pf < 0.88::DOUBLE AS is_anomaly,
                 concat_ws('; ',
                     CASE WHEN abs(z) > 3 THEN printf('Statistical Load Spike (Z=%+.2f)', z) END,
                     CASE WHEN v < 220 THEN printf('SCADA Voltage Sag (%.1fV < 220V)', v) END,
                     CASE WHEN v > 240 THEN printf('SCADA Voltage Surge (%.1fV > 240V)', v) END,
                     CASE WHEN pf < 0.88::DOUBLE THEN printf('SCADA Low Power Factor (%.3f < 0.88)', pf) END) AS reasons
          FROM (SELECT t.event_id, COALESCE(t.voltage_v, 230.0::DOUBLE) AS v,
                       COALESCE(t.power_factor, 0.95::DOUBLE) AS pf,
                       (COALESCE(t.power_kw, 0.0::DOUBLE) - s.mean_kw) / s.std_kw AS z
                FROM telemetry t JOIN meter_stats s ON t.meter_id = s.meter_id))"""


@register("evaluate", EVALUATE)
def _(spark, sf_dir):
    rows = fx.readings(spark, sf_dir)
    return score_readings(rows, stored(profiles.meter_baselines(rows), "baselines")).select(
        "event_id", "ml_anomaly", "anomaly_score", "z_score", "is_anomaly", "primary_reason",
        F.concat_ws("; ", "reasons").alias("reasons"))


@register("isolation_forest")
def _(spark, sf_dir):
    rows = with_features(fx.readings(spark, sf_dir))
    model = isolation_forest_fit(rows)
    return isolation_forest_score(rows, model).select(
        "event_id", "meter_id", "timestamp", F.round("anomaly_score", 6).alias("anomaly_score"), "ml_anomaly")


# Two trees grown on 8 readings: node arrays, a leaf points to itself and holds its path length.
GIVEN_TREES = [
    (0, [0, 0, 1, 0, 0], [50.0, 0.0, 210.0, 0.0, 0.0], [1, 1, 3, 3, 4], [2, 1, 4, 3, 4], [0.0, 4.5, 0.0, 2.0, 3.25], 8),
    (1, [1, 0, 0], [190.0, 0.0, 0.0], [1, 1, 2], [2, 1, 2], [0.0, 1.0, 3.5], 8),
]


GIVEN_SCORES = """
    SELECT event_id, ROUND(score, 6) + 0.0::DOUBLE AS anomaly_score, COALESCE(score < 0, FALSE) AS ml_anomaly
    FROM (SELECT event_id, 0.5::DOUBLE - pow(2.0::DOUBLE, -(one + two) / 2 / (2 * (ln(7) + 0.5772156649015329) - 1.75)) AS score
          FROM (SELECT event_id,
                       CASE WHEN power_kw IS NULL OR voltage_v IS NULL THEN NULL WHEN power_kw <= 50 THEN 4.5::DOUBLE
                            WHEN voltage_v <= 210 THEN 2.0::DOUBLE ELSE 3.25::DOUBLE END AS one,
                       CASE WHEN voltage_v <= 190 THEN 1.0::DOUBLE ELSE 3.5::DOUBLE END AS two FROM telemetry))"""


def given_forest(spark) -> IsolationForest:
    trees = spark.createDataFrame(GIVEN_TREES, TREE_SCHEMA).select(
        "*", F.lit(-0.5).alias("offset"), F.array(F.lit("power_kw"), F.lit("voltage_v")).alias("cols"))
    return IsolationForest.from_frame(trees)


@register("isolation_forest_given_trees", GIVEN_SCORES)
def _(spark, sf_dir):
    found = isolation_forest_score(fx.readings(spark, sf_dir), given_forest(spark))
    return found.select("event_id", (F.round("anomaly_score", 6) + F.lit(0.0)).alias("anomaly_score"), "ml_anomaly")


@register("isolation_forest_share", """
    SELECT COUNT(*) AS scored, TRUE AS as_contaminated FROM telemetry
    WHERE power_kw IS NOT NULL AND voltage_v IS NOT NULL AND current_a IS NOT NULL AND power_factor IS NOT NULL""")
def _(spark, sf_dir):
    """The fitted forest flags the share of readings it was told to, within half a percent of all."""
    rows = with_features(fx.readings(spark, sf_dir)).dropna("any", subset=list(FEATURES))
    found = isolation_forest_score(rows, isolation_forest_fit(rows))
    share = F.count_if("ml_anomaly") / F.count("anomaly_score")
    return found.agg(F.count("anomaly_score").alias("scored"), (F.abs(share - CONTAMINATION) <= 0.005).alias("as_contaminated"))


# --- dispatch --------------------------------------------------------------
# The campus load of each hour stands for its forecast; a day is a series.

LIMIT = 400.0
DAY_FORECAST = f"""
    SELECT strftime(ds, '%Y-%m-%d') AS day, ds AS forecast_time, {rnd(mean('load'), 2)} AS predicted_load_kw
    FROM (SELECT date_trunc('hour', timestamp) AS ds, CAST(SUM(CAST(power_kw AS DECIMAL(18,4))) AS DOUBLE) AS load
          FROM telemetry GROUP BY timestamp) GROUP BY ds"""
PLAN = f"""
    SELECT day, COUNT(*) FILTER (WHERE predicted_load_kw > {LIMIT}) AS violation_hours_count,
           MAX(predicted_load_kw) AS peak_forecast_kw,
           COALESCE(string_agg(strftime(forecast_time, '%H:%M'), ',' ORDER BY forecast_time)
                    FILTER (WHERE predicted_load_kw > {LIMIT}), '') AS peak_times,
           MAX(predicted_load_kw) > {LIMIT} AS has_violations, {LIMIT}::DOUBLE AS threshold_kw,
           {rnd(f'GREATEST(0.0::DOUBLE, MAX(predicted_load_kw) - {LIMIT})', 2)} AS max_overload_kw,
           CASE WHEN MAX(predicted_load_kw) > {LIMIT} THEN 295.0::DOUBLE ELSE 0.0::DOUBLE END AS total_shed_kw,
           {rnd(rnd(f'GREATEST(0.0::DOUBLE, MAX(predicted_load_kw) - {LIMIT})', 2) + ' * 350', 2)} AS est_monthly_savings
    FROM ({DAY_FORECAST}) GROUP BY day"""


def day_forecast(spark, sf_dir):
    hours = profiles.hourly_load(fx.readings(spark, sf_dir))
    return hours.select(F.date_format("ds", "yyyy-MM-dd").alias("day"), F.col("ds").alias("forecast_time"),
                        F.col("total_power_kw").alias("predicted_load_kw"))


def day_plan(spark, sf_dir):
    return dispatch.dispatch_plan(day_forecast(spark, sf_dir), ["day"], limit_kw=LIMIT)


@register("dispatch_summary", PLAN)
def _(spark, sf_dir):
    rows = dispatch.dispatch_summary(day_plan(spark, sf_dir))
    return rows.withColumn("peak_times", F.concat_ws(",", "peak_times"))


ACTIVE = """CASE tier WHEN 1 THEN LEAST(45.0::DOUBLE, o) WHEN 2 THEN LEAST(90.0::DOUBLE, GREATEST(0.0::DOUBLE, o - 45))
            ELSE LEAST(160.0::DOUBLE, GREATEST(0.0::DOUBLE, o - 135)) END"""
ARMED = "(tier = 1 OR (tier = 2 AND o > 45) OR (tier = 3 AND o > 135))"
TIER_TABLE = "(VALUES " + ", ".join(
    f"({tier.number}, '{tier.name}', '{tier.category}', {tier.capacity_kw}::DOUBLE, '{tier.urgency}', '{','.join(tier.meters)}', "
    f"'{'|'.join(tier.zones)}')" for tier in dispatch.TIERS) + ") tiers(tier, name, category, shed_capacity_kw, urgent, meters, zones)"


@register("dispatch_actions", f"""
    SELECT day, tier::BIGINT AS tier, name, category, zones AS target_zones, meters AS target_meters, shed_capacity_kw,
           {ACTIVE} AS active_shed_kw, CASE WHEN {ARMED} THEN urgent ELSE 'STANDBY' END AS urgency,
           CASE WHEN {ARMED} THEN 'ARMED' ELSE 'STANDBY' END AS status
    FROM (SELECT day, max_overload_kw AS o FROM ({PLAN}) WHERE has_violations) CROSS JOIN {TIER_TABLE}""")
def _(spark, sf_dir):
    rows = dispatch.dispatch_actions(day_plan(spark, sf_dir), ["day"]).drop("action_desc")
    return rows.withColumns({
        "tier": F.col("tier").cast("bigint"), "target_zones": F.concat_ws("|", "target_zones"),
        "target_meters": F.concat_ws(",", "target_meters")})


@register("dispatched_curve", f"""
    SELECT f.day, f.forecast_time, f.predicted_load_kw,
           CASE WHEN f.predicted_load_kw > {LIMIT} THEN
           {rnd(f'GREATEST({LIMIT}::DOUBLE, f.predicted_load_kw - LEAST(p.max_overload_kw, 295.0::DOUBLE))', 2)}
                ELSE f.predicted_load_kw END AS dispatched_load_kw
    FROM ({DAY_FORECAST}) f JOIN ({PLAN}) p ON f.day = p.day""")
def _(spark, sf_dir):
    return dispatch.dispatched_curve(day_forecast(spark, sf_dir), day_plan(spark, sf_dir), ["day"])


PEAKS = "(SELECT building_id, MAX(total_power_kw) AS peak_kw FROM building_hours GROUP BY building_id)"
PEAK_LIMIT = 300.0


def building_peaks(spark, sf_dir):
    hours = profiles.hourly_load(fx.readings(spark, sf_dir), ["building_id"])
    return hours.groupBy("building_id").agg(F.max("total_power_kw").alias("peak_kw"))


@register("dispatch_for_peak", f"""
    SELECT building_id, peak_kw, (peak_kw > {PEAK_LIMIT})::BIGINT AS violation_hours_count, peak_kw AS peak_forecast_kw,
           peak_kw > {PEAK_LIMIT} AS has_violations, {PEAK_LIMIT}::DOUBLE AS threshold_kw,
           {rnd(f'GREATEST(0.0::DOUBLE, peak_kw - {PEAK_LIMIT})', 2)} AS max_overload_kw,
           CASE WHEN peak_kw > {PEAK_LIMIT} THEN 295.0::DOUBLE ELSE 0.0::DOUBLE END AS total_shed_kw,
           {rnd(rnd(f'GREATEST(0.0::DOUBLE, peak_kw - {PEAK_LIMIT})', 2) + ' * 350', 2)} AS est_monthly_savings,
           CASE WHEN peak_kw <= {PEAK_LIMIT} THEN 0 WHEN peak_kw - {PEAK_LIMIT} > 135 THEN 3
                WHEN peak_kw - {PEAK_LIMIT} > 45 THEN 2 ELSE 1 END::BIGINT AS armed_tiers
    FROM {PEAKS}""")
def _(spark, sf_dir):
    rows = dispatch.dispatch_for_peak(building_peaks(spark, sf_dir), limit_kw=PEAK_LIMIT)
    armed = F.size(F.filter("actions", lambda action: action["status"] == "ARMED"))
    return rows.withColumn("armed_tiers", armed.cast("bigint")).drop("actions")


@register("live_projection", f"""
    SELECT building_id, peak_kw, GREATEST(peak_kw * 1.18::DOUBLE, 885.5::DOUBLE) AS projected_peak_kw,
           GREATEST(0.0::DOUBLE, GREATEST(peak_kw * 1.18::DOUBLE, 885.5::DOUBLE) - 850) AS projected_overload_kw,
           ROUND(GREATEST(0.0::DOUBLE, GREATEST(peak_kw * 1.18::DOUBLE, 885.5::DOUBLE) - 850) * 350)::BIGINT
               AS potential_savings, 85.5::DOUBLE AS active_shed_kw
    FROM {PEAKS}""")
def _(spark, sf_dir):
    return dispatch.live_projection(building_peaks(spark, sf_dir), "peak_kw")


# --- incident cards --------------------------------------------------------

@register("peak_cards", f"""
    SELECT day, 'PEAK_SHAVING_DISPATCH' AS event_type, printf('Peak Demand Breach (+%.1f kW)', o) AS title,
           CASE WHEN o < 100 THEN '#f59e0b' ELSE '#ef4444' END AS color,
           concat(format('{{:,.1f}}', peak), ' kW') AS peak_text, printf('INR %s', format('{{:,.0f}}', savings)) AS savings_text,
           COALESCE(action_text, 'No automated action required.') AS action_text
    FROM (SELECT day, max_overload_kw AS o, peak_forecast_kw AS peak, est_monthly_savings AS savings FROM ({PLAN}))
    LEFT JOIN (SELECT day, string_agg(concat('• *Tier ', tier, ' (', category, '):* ', name, ' -> ', {ACTIVE},
                                             ' kW active shed'), chr(10) ORDER BY tier) AS action_text
               FROM (SELECT day, max_overload_kw AS o FROM ({PLAN}) WHERE has_violations) CROSS JOIN {TIER_TABLE}
               WHERE {ARMED} GROUP BY day) USING (day)""")
def _(spark, sf_dir):
    cards = incidents.peak_cards(day_plan(spark, sf_dir))
    return cards.select("day", "event_type", "title", "color", F.col("fields")[0]["value"].alias("peak_text"),
                        F.col("fields")[3]["value"].alias("savings_text"), "action_text")


FAULT_CARDS = """
    SELECT event_id, concat('SCADA_', alert_type) AS event_type,
           concat(alert_type, ' at ', meter_id, ' (', building_id, ')') AS title,
           CASE severity WHEN 'CRITICAL' THEN '#ef4444' ELSE '#f59e0b' END AS color,
           concat('Sub-meter ', meter_id, ' in ', building_id, ' observed a ', alert_type, ' breach (',
                  printf('%.2f', metric_value), ' vs limit ', printf('%.2f', threshold_value), ').') AS summary
    FROM alert_rows"""


@register("fault_cards", FAULT_CARDS)
def _(spark, sf_dir):
    return incidents.fault_cards(alert_rows(spark, sf_dir)) \
        .select("event_id", "event_type", "title", "color", "summary")


@register("dispatch_history", """
    SELECT timestamp, concat('SCADA_', alert_type) AS event_type,
           concat(alert_type, ' at ', meter_id, ' (', building_id, ')') AS title, 'SIMULATED_SUCCESS' AS status,
           200::BIGINT AS status_code
    FROM alert_rows ORDER BY timestamp DESC, event_type DESC, title DESC LIMIT 50""")
def _(spark, sf_dir):
    cards = incidents.fault_cards(alert_rows(spark, sf_dir))
    audit = incidents.audit_rows(cards, at=F.col("timestamp"))
    return incidents.dispatch_history(audit).select(
        "timestamp", "event_type", "title", "status", F.col("status_code").cast("bigint").alias("status_code"))
