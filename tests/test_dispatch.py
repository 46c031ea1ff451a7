import datetime as dt
import json

from pyspark.sql import functions as F

from wattlake.operators import dispatch, incidents
from wattlake.operators.alerts import alerts, evaluate
from wattlake.operators.isolation_forest import with_features

T0 = dt.datetime(2026, 8, 23)


def forecast(spark, loads, series="campus"):
    rows = [(series, T0 + dt.timedelta(hours=i), float(load)) for i, load in enumerate(loads)]
    return spark.createDataFrame(rows, "series string, forecast_time timestamp_ntz, predicted_load_kw double")


OVERLOAD = [600.0] * 12 + [950.0] * 4 + [600.0] * 8


def test_nominal_day_has_no_actions(spark):
    plan = dispatch.dispatch_plan(forecast(spark, [500 + i for i in range(24)]), (), limit_kw=800.0).first()
    assert not plan["has_violations"] and plan["violation_hours_count"] == 0
    assert (plan["max_overload_kw"], plan["est_monthly_savings"], plan["total_shed_kw"]) == (0.0, 0.0, 0.0)
    assert plan["peak_times"] == [] and plan["actions"] == [] and plan["peak_forecast_kw"] == 523.0


def test_overload_of_150_kw(spark):
    plan = dispatch.dispatch_plan(forecast(spark, OVERLOAD), (), limit_kw=800.0, tariff=350.0).first()
    assert plan["has_violations"] and plan["violation_hours_count"] == 4 and plan["max_overload_kw"] == 150.0
    assert plan["peak_times"] == ["12:00", "13:00", "14:00", "15:00"]
    assert plan["est_monthly_savings"] == 52_500.0 and plan["total_shed_kw"] == 295.0
    assert [(a["tier"], a["status"], a["urgency"], a["active_shed_kw"]) for a in plan["actions"]] == [
        (1, "ARMED", "MEDIUM", 45.0), (2, "ARMED", "HIGH", 90.0), (3, "ARMED", "CRITICAL", 15.0)]
    assert plan["actions"][1]["target_meters"] == ["M026", "M027", "M028", "M029", "M032", "M033"]


def test_small_overload_leaves_later_tiers_on_standby(spark):
    plan = dispatch.dispatch_plan(forecast(spark, [840.0]), (), limit_kw=800.0)
    actions = dispatch.dispatch_actions(plan).collect()
    assert [(a["status"], a["urgency"], a["active_shed_kw"]) for a in actions] == [
        ("ARMED", "MEDIUM", 40.0), ("STANDBY", "STANDBY", 0.0), ("STANDBY", "STANDBY", 0.0)]


def test_empty_forecast_gives_a_plan_of_zeros(spark):
    plan = dispatch.dispatch_plan(forecast(spark, []), ()).first()
    assert (plan["has_violations"], plan["peak_forecast_kw"], plan["threshold_kw"], plan["peak_times"],
            plan["actions"]) == (False, 0.0, 850.0, [], [])


def test_curve_falls_to_the_limit_but_not_below(spark):
    rows = forecast(spark, [700.0, 860.0, 1200.0])
    curve = dispatch.dispatched_curve(rows, dispatch.dispatch_plan(rows, (), limit_kw=800.0))
    assert [row["dispatched_load_kw"] for row in curve.orderBy("forecast_time").collect()] == [700.0, 800.0, 905.0]


def test_series_are_planned_separately(spark):
    rows = forecast(spark, OVERLOAD, "a").union(forecast(spark, [100.0] * 24, "b"))
    plan = dispatch.dispatch_plan(rows, ["series"], limit_kw=800.0)
    assert {row["series"]: row["has_violations"] for row in plan.collect()} == {"a": True, "b": False}
    assert dispatch.dispatch_actions(plan, ["series"]).where("series = 'b'").count() == 0
    curve = dispatch.dispatched_curve(rows, plan, ["series"])
    assert curve.count() == 48 and curve.agg(F.max("dispatched_load_kw")).first()[0] == 800.0


def test_single_peak_values(spark):
    peaks = spark.createDataFrame([(800.0,), (900.0,), (None,)], "peak_kw double")
    found = {row["peak_kw"]: row for row in dispatch.dispatch_for_peak(peaks).collect()}
    assert found[900.0]["max_overload_kw"] == 50.0 and len(found[900.0]["actions"]) == 3
    assert not found[800.0]["has_violations"] and not found[None]["has_violations"]


def test_live_projection(spark):
    loads = spark.createDataFrame([(618.6,), (900.0,)], "load_kw double")
    found = [row.asDict() for row in dispatch.live_projection(loads).orderBy("load_kw").collect()]
    assert (found[0]["projected_peak_kw"], found[0]["projected_overload_kw"], found[0]["potential_savings"],
            found[0]["active_shed_kw"]) == (885.5, 35.5, 12_425, 85.5)
    assert round(found[1]["projected_peak_kw"], 6) == 1062.0


def test_peak_card(spark):
    plan = dispatch.dispatch_plan(forecast(spark, OVERLOAD), (), limit_kw=800.0)
    card = incidents.peak_cards(plan).first()
    assert card["title"] == "Peak Demand Breach (+150.0 kW)" and card["color"] == "#ef4444"
    assert card["action_text"].split("\n")[2] == (
        "• *Tier 3 (Battery Storage):* Powerhouse BESS 500kWh Peak-Shaving Discharge -> 15.0 kW active shed")
    payload = json.loads(card["payload"])
    assert [f["value"] for f in payload["attachments"][0]["fields"]][:4] == [
        "950.0 kW", "800.0 kW", "+150.0 kW", "INR 52,500"]
    nominal = incidents.peak_cards(dispatch.dispatch_plan(forecast(spark, [1.0]), ())).first()
    assert nominal["action_text"] == "No automated action required." and nominal["color"] == "#f59e0b"


def test_fault_card_and_history(spark):
    rows = spark.createDataFrame([("M015", "Library", "VOLTAGE_SAG", "CRITICAL", 214.2, 220.0)] * 60,
                                 "meter_id string, building_id string, alert_type string, severity string, "
                                 "metric_value double, threshold_value double")
    cards = incidents.fault_cards(rows)
    card = cards.first()
    assert card["event_type"] == "SCADA_VOLTAGE_SAG" and card["title"] == "VOLTAGE_SAG at M015 (Library)"
    assert card["summary"].endswith("observed a VOLTAGE_SAG breach (214.20 vs limit 220.00).")
    assert json.loads(card["payload"])["attachments"][0]["color"] == "#ef4444"
    history = incidents.dispatch_history(incidents.audit_rows(cards))
    assert history.count() == 50 and history.first()["status"] == "SIMULATED_SUCCESS"


def test_alert_texts_and_order(readings):
    at = T0.isoformat()
    rows = readings(("E1", at, "M1", "B", None, 1.0, 211.25, 1.0, 0.8),
                    ("E2", at, "M1", "B", None, 1.0, 245.0, 1.0, 0.95),
                    ("E3", at, "M1", "B", None, 1.0, 230.0, 1.0, 0.88),
                    ("E4", at, "M1", "B", None, 1.0, None, 1.0, None))
    found = [(r["event_id"], r["alert_type"], r["severity"], r["description"]) for r in
             alerts(rows).orderBy("event_id", "alert_type").collect()]
    assert found == [
        ("E1", "LOW_POWER_FACTOR", "WARNING", "Power factor degraded to 0.800 (below target 0.88)"),
        ("E1", "VOLTAGE_SAG", "CRITICAL", "Voltage dropped to 211.2V (under standard 220.0V threshold)"),
        ("E2", "VOLTAGE_SURGE", "WARNING", "Voltage spiked to 245.0V (over standard 240.0V threshold)")]


def test_evaluation_combines_model_statistics_and_limits(spark, readings):
    at = T0.isoformat()
    rows = readings(("E1", at, "known", "B", None, 50.0, 210.0, 1.0, 0.5),
                    ("E2", at, "other", "B", None, 20.0, None, 1.0, None),
                    ("E3", at, "single", "B", None, 99.0, 230.0, 1.0, 0.95),
                    ("E4", at, "other", "B", None, None, 230.0, 1.0, 0.95))
    base = spark.createDataFrame([("known", 10.0, 4.0), ("single", 1.0, None)],
                                 "meter_id string, mean_kw double, std_kw double")
    flagged = rows.withColumns({"anomaly_score": F.when(F.col("event_id") == "E1", -0.12345).otherwise(0.1),
                                "ml_anomaly": F.col("event_id") == "E1"})
    found = {row["event_id"]: row for row in evaluate(flagged, base).collect()}
    first = found["E1"]
    assert first["reasons"] == [
        "ML Isolation Anomaly (Score: -0.123)", "Statistical Load Spike (Z=+10.00)",
        "SCADA Voltage Sag (210.0V < 220V)", "SCADA Low Power Factor (0.500 < 0.88)"]
    assert first["is_anomaly"] and first["primary_reason"] == first["reasons"][0] and first["anomaly_score"] == -0.1235
    assert found["E2"]["z_score"] == 0.0 and found["E2"]["primary_reason"] == "NOMINAL"
    assert found["E3"]["z_score"] is None and not found["E3"]["is_anomaly"]
    assert found["E4"]["reasons"] == ["Statistical Load Spike (Z=-4.00)"]
    assert "hour" in with_features(rows).columns
