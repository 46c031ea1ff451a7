"""From a forecast to the audit trail: plan, lowered curve, incident cards, each written once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.operators.dispatch import (LIMIT_KW, TARIFF_PER_KW, dispatch_actions, dispatch_plan, dispatch_summary,
                                         dispatched_curve)
from wattlake.operators.incidents import audit_rows, peak_cards

TABLES = ("forecast", "plans", "actions", "curve", "cards", "audit")


def demand_response(forecast: DataFrame, out: str, keys: Sequence[str], limit_kw: float = LIMIT_KW,
                    tariff: float = TARIFF_PER_KW, at: Column | None = None) -> dict[str, DataFrame]:
    """Writes the forecast, its plans, actions, lowered curve, and cards with audit rows below ``out``.

    The forecast is stored first and read back: plan and curve come from the same rows, and the model is applied once.
    Series with hours above the limit get a card; all get a plan and a curve.
    """
    spark = forecast.sparkSession

    def keep(name: str, rows: DataFrame) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}")

    made = {"forecast": keep("forecast", forecast)}
    plans = keep("plans", dispatch_plan(made["forecast"], keys, limit_kw, tariff))
    made["plans"] = dispatch_summary(plans)
    made["actions"] = keep("actions", dispatch_actions(plans, keys))
    made["curve"] = keep("curve", dispatched_curve(made["forecast"], plans, keys))
    made["cards"] = keep("cards", peak_cards(plans.where(F.col("has_violations"))))
    made["audit"] = keep("audit", audit_rows(made["cards"], at))
    return made
