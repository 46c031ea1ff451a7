"""Electrical rules on one reading: bounds, flags, limits and derived power."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.numeric import half_up
from wattlake.schema import AlertLimits, SilverRules


def clamp_electrical(df: DataFrame, rules: SilverRules = SilverRules()) -> DataFrame:
    """B-04: floor power and current at zero, replace implausible voltage and power factor.

    A null current becomes 0 because ``greatest`` skips nulls; a null voltage or
    power factor gets its default.
    """
    pf = F.col("power_factor")
    volts = F.col("voltage_v")
    return df.withColumns({
        "power_kw": F.greatest(F.lit(0.0), F.col("power_kw")),
        "current_a": F.greatest(F.lit(0.0), F.col("current_a")),
        "voltage_v": F.when(volts.between(rules.voltage_low, rules.voltage_high), volts)
                      .otherwise(F.lit(rules.voltage_default)),
        "power_factor": F.when(pf > rules.pf_high, F.lit(rules.pf_high))
                         .when(pf >= rules.pf_low, pf)
                         .otherwise(F.lit(rules.pf_default)),
    })


def is_sag_swell(volts: Column, rules: SilverRules = SilverRules()) -> Column:
    outside = ~volts.between(rules.flag_voltage_low, rules.flag_voltage_high)
    return F.coalesce(outside, F.lit(False))


def is_low_pf(pf: Column, rules: SilverRules = SilverRules()) -> Column:
    return F.coalesce(pf < rules.flag_pf_below, F.lit(False))


def quality_flags(df: DataFrame, rules: SilverRules = SilverRules()) -> DataFrame:
    """B-05: sag/swell and low power factor, taken from the raw values; null is false."""
    return df.withColumns({
        "is_voltage_sag_swell": is_sag_swell(F.col("voltage_v"), rules),
        "is_low_power_factor": is_low_pf(F.col("power_factor"), rules),
    })


def below(value: Column, limit: float) -> Column:
    return F.coalesce(value < limit, F.lit(False))


def above(value: Column, limit: float) -> Column:
    return F.coalesce(value > limit, F.lit(False))


def limit_rules(df: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """J-03: sag, surge and low power factor booleans, and the worst severity.

    A sag is CRITICAL, the other two are WARNING, none gives null.
    """
    sag = below(F.col("voltage_v"), limits.sag_below_v)
    surge = above(F.col("voltage_v"), limits.surge_above_v)
    low_pf = below(F.col("power_factor"), limits.low_pf_below)
    return df.withColumns({
        "is_voltage_sag": sag,
        "is_voltage_surge": surge,
        "is_low_pf": low_pf,
        "severity": F.when(sag, "CRITICAL").when(surge | low_pf, "WARNING"),
    })


def derive_power(df: DataFrame) -> DataFrame:
    """B-11: apparent kVA, reactive kVAR and current A from power, voltage and power factor."""
    apparent = half_up(F.try_divide(F.col("power_kw"), F.col("power_factor")), 2)
    squared_gap = F.col("apparent_power_kva") * F.col("apparent_power_kva") \
        - F.col("power_kw") * F.col("power_kw")
    reactive = F.when(F.col("apparent_power_kva").isNotNull() & F.col("power_kw").isNotNull(),
                      half_up(F.sqrt(F.greatest(F.lit(0.0), squared_gap)), 2))
    amps = half_up(F.try_divide(F.col("power_kw") * 1000.0, F.col("voltage_v")), 2)
    return (df.withColumn("apparent_power_kva", apparent)
              .withColumns({"reactive_power_kvar": reactive, "derived_current_a": amps}))
