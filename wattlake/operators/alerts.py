"""Power-quality alerts and the evaluation of single readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.numeric import half_up
from wattlake.operators.joins import baseline_lookup
from wattlake.schema import AlertLimits, ScoreDefaults


def fixed(value: Column | str, digits: int) -> Column:
    """Text with a fixed number of decimals, without grouping (ties to even)."""
    return F.call_function("format_number", F.col(value) if isinstance(value, str) else value,
                           F.lit("0." + "0" * digits))


def alerts(df: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """J-04: zero to two alert rows per reading - sag or else surge, and low power factor.

    One pass, no shuffle: the alerts of a reading are an array that is exploded.
    The texts are fixed values.
    """
    def alert(kind: str, severity: str, metric: str, limit: float, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("alert_type"), F.lit(severity).alias("severity"),
                        F.col(metric).alias("metric_value"), F.lit(limit).alias("threshold_value"),
                        text.alias("description"))

    sag = alert("VOLTAGE_SAG", "CRITICAL", "voltage_v", limits.sag_below_v, F.concat(
        F.lit("Voltage dropped to "), fixed("voltage_v", 1),
        F.lit(f"V (under standard {limits.sag_below_v}V threshold)")))
    surge = alert("VOLTAGE_SURGE", "WARNING", "voltage_v", limits.surge_above_v, F.concat(
        F.lit("Voltage spiked to "), fixed("voltage_v", 1),
        F.lit(f"V (over standard {limits.surge_above_v}V threshold)")))
    low_pf = alert("LOW_POWER_FACTOR", "WARNING", "power_factor", limits.low_pf_below, F.concat(
        F.lit("Power factor degraded to "), fixed("power_factor", 3),
        F.lit(f" (below target {limits.low_pf_below})")))
    volts = F.col("voltage_v")
    raised = F.array_compact(F.array(
        F.when(volts < limits.sag_below_v, sag).when(volts > limits.surge_above_v, surge),
        F.when(F.col("power_factor") < limits.low_pf_below, low_pf)))
    place = [name for name in ("event_id", "timestamp", "meter_id", "building_id") if name in df.columns]
    return df.select(*place, F.explode(raised).alias("alert")).select(*place, "alert.*")


def evaluate(df: DataFrame, baselines: DataFrame, limits: AlertLimits = AlertLimits(),
             defaults: ScoreDefaults = ScoreDefaults()) -> DataFrame:
    """J-05: z-score, limits and, if the rows carry them, model columns, as one verdict.

    ``df`` may carry ``anomaly_score`` and ``ml_anomaly`` from the isolation
    forest.  Missing power, voltage and power factor count as the defaults.  The
    reasons keep their order: model, statistics, sag, surge, power factor.
    """
    filled = baseline_lookup(df, baselines, defaults).withColumns({
        "_kw": F.coalesce(F.col("power_kw"), F.lit(defaults.missing_power_kw)),
        "_v": F.coalesce(F.col("voltage_v"), F.lit(defaults.missing_voltage_v)),
        "_pf": F.coalesce(F.col("power_factor"), F.lit(defaults.missing_pf)),
    })
    z = F.try_divide(F.col("_kw") - F.col("mean_kw"), F.col("std_kw"))
    scored = filled.withColumn("_z", z)
    has_model = "ml_anomaly" in df.columns
    model = F.coalesce(F.col("ml_anomaly"), F.lit(False)) if has_model else F.lit(False)
    score = F.coalesce(F.col("anomaly_score"), F.lit(0.0)) if has_model else F.lit(0.0)
    spike = F.coalesce(F.abs("_z") > defaults.z_threshold, F.lit(False))
    sag, surge = F.col("_v") < limits.sag_below_v, F.col("_v") > limits.surge_above_v
    low_pf = F.col("_pf") < limits.low_pf_below
    signed = F.call_function("format_number", F.col("_z"), F.lit("+0.00;-0.00"))
    reasons = F.array_compact(F.array(
        F.when(model, F.concat(F.lit("ML Isolation Anomaly (Score: "), fixed(score, 3), F.lit(")"))),
        F.when(spike, F.concat(F.lit("Statistical Load Spike (Z="), signed, F.lit(")"))),
        F.when(sag, F.concat(F.lit("SCADA Voltage Sag ("), fixed("_v", 1),
                             F.lit(f"V < {limits.sag_below_v:.0f}V)"))),
        F.when(surge, F.concat(F.lit("SCADA Voltage Surge ("), fixed("_v", 1),
                               F.lit(f"V > {limits.surge_above_v:.0f}V)"))),
        F.when(low_pf, F.concat(F.lit("SCADA Low Power Factor ("), fixed("_pf", 3),
                                F.lit(f" < {limits.low_pf_below})")))))
    verdict = scored.withColumns({
        "ml_anomaly": model,
        "anomaly_score": half_up(score, 4),
        "z_score": half_up("_z", 2),
        "reasons": reasons,
    })
    return verdict.withColumns({
        "is_anomaly": F.size("reasons") > 0,
        "primary_reason": F.coalesce(F.try_element_at("reasons", F.lit(1)), F.lit("NOMINAL")),
    }).drop("_kw", "_v", "_pf", "_z", "mean_kw", "std_kw")


