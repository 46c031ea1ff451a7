"""Demand-response planning on forecasts.

A plan is one row per series with its actions as an array of structs; the
actions of a violating series are made by ``explode``, so there is no join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.numeric import half_up

# Contract of the dispatch planner (fixed values).
LIMIT_KW = 850.0
TARIFF_PER_KW = 350.0


@dataclass(frozen=True)
class Tier:
    """One shedding tier; it starts once the tiers before it are used up."""

    number: int
    name: str
    category: str
    zones: tuple[str, ...]
    meters: tuple[str, ...]
    capacity_kw: float
    description: str
    urgency: str


# Shedding tiers in order of use (fixed values).
TIERS = (
    Tier(1, "Non-Critical Facilities & EV Setback", "Soft Shedding",
         ("Convention Center", "Open Air Theatre (OAT)", "Main Gate EV Pods"),
         ("M030", "M031", "M037"), 45.0,
         "Dim decorative/outdoor architectural lighting and throttle Level-2 EV charging to standby.",
         "MEDIUM"),
    Tier(2, "Lecture Theatre & Academic HVAC Duty-Cycling", "Chiller Cycling",
         ("LT1 (Lecture Theatre 1)", "LT2 (Lecture Theatre 2)", "Academic Block"),
         ("M026", "M027", "M028", "M029", "M032", "M033"), 90.0,
         "Cycle central chilled-water air handling units in 15-minute intervals between lecture periods.",
         "HIGH"),
    Tier(3, "Powerhouse BESS 500kWh Peak-Shaving Discharge", "Battery Storage",
         ("Main Powerhouse Substation",), ("M036",), 160.0,
         "Discharge 500 kWh stationary lithium iron phosphate battery storage inverter into 415V bus.",
         "CRITICAL"),
)

# Live planner: growth to the projected peak, its least value, and the shed of
# each armed tier (fixed values).
PROJECTION_FACTOR = 1.18
PROJECTION_FLOOR_KW = 885.5
LIVE_SHED_KW = (45.0, 40.5, 50.0)


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(value) for value in values])


def _actions(overload: Column, tiers: Sequence[Tier]) -> Column:
    """The actions for an overload, as an array; the first tier is always armed."""
    actions, used = [], 0.0
    for tier in tiers:
        beyond = F.greatest(F.lit(0.0), overload - used)
        armed = overload > used
        actions.append(F.struct(
            F.lit(tier.number).alias("tier"), F.lit(tier.name).alias("name"),
            F.lit(tier.category).alias("category"),
            _texts(tier.zones).alias("target_zones"), _texts(tier.meters).alias("target_meters"),
            F.lit(tier.capacity_kw).alias("shed_capacity_kw"),
            F.least(F.lit(tier.capacity_kw), beyond).alias("active_shed_kw"),
            F.lit(tier.description).alias("action_desc"),
            F.when(armed | F.lit(used == 0.0), tier.urgency).otherwise("STANDBY").alias("urgency"),
            F.when(armed | F.lit(used == 0.0), "ARMED").otherwise("STANDBY").alias("status")))
        used += tier.capacity_kw
    return F.array(*actions)


def _with_plan(summary: DataFrame, limit_kw: float, tariff: float, tiers: Sequence[Tier]) -> DataFrame:
    """Adds overload, savings, shed capacity and actions to rows with a peak and a violation count."""
    violated = F.col("violation_hours_count") > 0
    overload = F.when(violated, half_up(F.col("peak_forecast_kw") - float(limit_kw), 2)).otherwise(F.lit(0.0))
    rows = summary.withColumns({
        "has_violations": violated, "threshold_kw": F.lit(float(limit_kw)), "max_overload_kw": overload})
    actions = _actions(F.col("max_overload_kw"), tiers)
    return rows.withColumns({
        "total_shed_kw": F.when(violated, F.lit(sum(tier.capacity_kw for tier in tiers))).otherwise(F.lit(0.0)),
        "est_monthly_savings": half_up(F.col("max_overload_kw") * float(tariff), 2),
        "actions": F.filter(actions, lambda _: violated),
    })


def dispatch_plan(forecast: DataFrame, keys: Sequence[str], limit_kw: float = LIMIT_KW,
                  tariff: float = TARIFF_PER_KW, tiers: Sequence[Tier] = TIERS) -> DataFrame:
    """J-13: one plan per series; ``keys`` name the series, and are empty only for a forecast of one.

    The hours above the limit are listed as ``HH:mm`` in time order; a series has
    at most one row per forecast hour.  An empty forecast gives a plan of zeros.
    """
    over = F.col("predicted_load_kw") > float(limit_kw)
    hours = F.array_sort(F.collect_list(F.when(over, F.col("forecast_time"))))
    summary = forecast.groupBy(*keys).agg(
        F.count_if(over).alias("violation_hours_count"),
        F.coalesce(F.max("predicted_load_kw"), F.lit(0.0)).alias("peak_forecast_kw"),
        F.transform(hours, lambda at: F.date_format(at, "HH:mm")).alias("peak_times"))
    return _with_plan(summary, limit_kw, tariff, tiers)


def dispatch_summary(plan: DataFrame) -> DataFrame:
    """J-13: the plan without its actions."""
    return plan.drop("actions")


def dispatch_actions(plan: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """J-14: one row per tier of each violating series."""
    return plan.select(*keys, F.explode("actions").alias("action")).select(*keys, "action.*")


def dispatched_curve(forecast: DataFrame, plan: DataFrame, keys: Sequence[str] = (),
                     tiers: Sequence[Tier] = TIERS) -> DataFrame:
    """J-15: the load after dispatch - above the limit it falls by the shed, not below the limit."""
    capacity = F.lit(sum(tier.capacity_kw for tier in tiers))
    if keys:
        rows = forecast.join(plan.select(*keys, "threshold_kw", "max_overload_kw"), list(keys), "left")
    else:
        rows = forecast.withColumns({name: plan.select(name).scalar()
                                     for name in ("threshold_kw", "max_overload_kw")})
    load, limit = F.col("predicted_load_kw"), F.col("threshold_kw")
    lowered = half_up(F.greatest(limit, load - F.least(F.col("max_overload_kw"), capacity)), 2)
    return rows.withColumn("dispatched_load_kw", F.when(load > limit, lowered).otherwise(load)) \
        .drop("threshold_kw", "max_overload_kw")


def dispatch_for_peak(peaks: DataFrame, peak: str = "peak_kw", limit_kw: float = LIMIT_KW,
                      tariff: float = TARIFF_PER_KW, tiers: Sequence[Tier] = TIERS) -> DataFrame:
    """J-16: the plan for a single peak value per row."""
    over = F.coalesce(F.col(peak) > float(limit_kw), F.lit(False))
    rows = peaks.withColumns({
        "violation_hours_count": over.cast("bigint"),
        "peak_forecast_kw": F.coalesce(F.col(peak), F.lit(0.0))})
    return _with_plan(rows, limit_kw, tariff, tiers)


def live_projection(loads: DataFrame, load: str = "load_kw", limit_kw: float = LIMIT_KW,
                    tariff: float = TARIFF_PER_KW, armed: Sequence[bool] = (True, True, False)) -> DataFrame:
    """J-16, live variant: projected peak, overload, savings and the shed of the armed tiers."""
    shed = sum(kw for kw, on in zip(LIVE_SHED_KW, armed) if on)
    projected = F.greatest(F.col(load) * PROJECTION_FACTOR, F.lit(PROJECTION_FLOOR_KW))
    return loads.withColumn("projected_peak_kw", projected).withColumn(
        "projected_overload_kw", F.greatest(F.lit(0.0), F.col("projected_peak_kw") - float(limit_kw))
    ).withColumns({
        "potential_savings": half_up(F.col("projected_overload_kw") * float(tariff), 0).cast("bigint"),
        "active_shed_kw": F.lit(float(shed)),
    })
