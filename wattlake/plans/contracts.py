"""Data contracts: declarative checks with one report row each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT = "model string, column string, test string, failures bigint, passed boolean"

# Values the campus catalog may use (fixed values).
CATEGORIES = ("Hostels", "Departments", "Lecture Theatres", "Facilities")
METER_STATES = ("ACTIVE", "INACTIVE", "MAINTENANCE")


@dataclass(frozen=True)
class Contract:
    """One assertion on a column of a model."""

    model: str
    column: str
    test: str  # not_null, unique, accepted_values, relationships or range
    values: tuple = ()
    parent: str = ""
    parent_key: str = ""
    low: float | None = None
    high: float | None = None
    low_open: bool = False


def _row_failure(contract: Contract) -> Column:
    """The condition under which a row breaks a row-local contract; a null only breaks not_null."""
    column = F.col(contract.column)
    if contract.test == "not_null":
        return column.isNull()
    if contract.test == "accepted_values":
        return ~column.isin(list(contract.values))
    bounds = []
    if contract.low is not None:
        bounds.append(column <= contract.low if contract.low_open else column < contract.low)
    if contract.high is not None:
        bounds.append(column > contract.high)
    return reduce(lambda left, right: left | right, bounds)


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """K-01: number of nulls."""
    return df.agg(F.count_if(F.col(column).isNull()).alias("failures"))


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """K-02: number of values that occur more than once."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")) \
        .agg(F.count_if(F.col("n") > 1).alias("failures"))


def check_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """K-03: number of rows with a value outside the list."""
    return df.agg(F.count_if(~F.col(column).isin(list(values))).alias("failures"))


def check_relationship(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """K-04: number of child rows whose key has no parent.

    The child is counted per key first, so the anti-join sees each key once.
    """
    per_key = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")) \
        .agg(F.count("*").alias("n"))
    known = parent.select(F.col(key).alias("_key")).distinct()
    return per_key.join(known, "_key", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))


def check_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None,
                low_open: bool = False) -> DataFrame:
    """K-07: number of rows outside the range; ``low_open`` excludes the lower bound."""
    contract = Contract("", column, "range", low=low, high=high, low_open=low_open)
    return df.agg(F.count_if(_row_failure(contract)).alias("failures"))


def run_contracts(tables: Mapping[str, DataFrame], contracts: Sequence[Contract]) -> DataFrame:
    """K-05: a report row per contract.

    All row-local checks of a table share one aggregate pass; each key check is
    its own small aggregate.
    """
    parts: list[DataFrame] = []
    for model in dict.fromkeys(contract.model for contract in contracts):
        table = tables[model]
        mine = [contract for contract in contracts if contract.model == model]
        local = [contract for contract in mine if contract.test not in ("unique", "relationships")]
        if local:
            counts = table.agg(*[F.count_if(_row_failure(contract)).alias(f"c{index}")
                                 for index, contract in enumerate(local)])
            rows = F.array(*[F.struct(F.lit(contract.column).alias("column"), F.lit(contract.test).alias("test"),
                                      F.col(f"c{index}").alias("failures"))
                             for index, contract in enumerate(local)])
            parts.append(counts.select(F.explode(rows).alias("r")).select(F.lit(model).alias("model"), "r.*"))
        for contract in mine:
            if contract.test == "unique":
                found = check_unique(table, contract.column)
            elif contract.test == "relationships":
                found = check_relationship(table, contract.column, tables[contract.parent], contract.parent_key)
            else:
                continue
            parts.append(found.select(F.lit(model).alias("model"), F.lit(contract.column).alias("column"),
                                      F.lit(contract.test).alias("test"), "failures"))
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("failures") == 0)


def campus_contracts(categories: Sequence[str] = CATEGORIES,
                     states: Sequence[str] = METER_STATES) -> list[Contract]:
    """The 34 contracts over seeds, bronze, silver and gold."""
    def not_null(model: str, *columns: str) -> list[Contract]:
        return [Contract(model, column, "not_null") for column in columns]

    def unique(model: str, column: str) -> list[Contract]:
        return [Contract(model, column, "unique")]

    def known(model: str, column: str, parent: str) -> list[Contract]:
        return [Contract(model, column, "relationships", parent=parent, parent_key=column)]

    return [
        *unique("buildings", "building_id"), *not_null("buildings", "building_id", "category", "peak_capacity_kw"),
        Contract("buildings", "category", "accepted_values", values=tuple(categories)),
        *unique("meters", "meter_id"), *not_null("meters", "meter_id", "building_id", "status"),
        *known("meters", "building_id", "buildings"),
        Contract("meters", "status", "accepted_values", values=tuple(states)),
        *not_null("bronze", "event_id", "timestamp"),
        *not_null("silver", "event_id", "timestamp", "meter_id", "building_id", "power_kw", "voltage_v",
                  "power_factor"),
        *known("silver", "meter_id", "meters"), *known("silver", "building_id", "buildings"),
        *unique("hourly", "hourly_facility_id"),
        *not_null("hourly", "hourly_facility_id", "building_id", "hour_timestamp", "avg_power_kw"),
        *unique("daily", "dispatch_date"), *not_null("daily", "dispatch_date", "peak_campus_demand_kw"),
        *unique("efficiency", "building_id"), *not_null("efficiency", "building_id", "category", "load_factor"),
    ]


def range_contracts() -> list[Contract]:
    """K-07: bounds on silver and gold values."""
    return [
        Contract("silver", "power_kw", "range", low=0.0),
        Contract("silver", "voltage_v", "range", low=180.0, high=270.0),
        Contract("efficiency", "load_factor", "range", low=0.0, high=1.0, low_open=True),
        Contract("daily", "peak_campus_demand_kw", "range", low=0.0, low_open=True),
        Contract("hourly", "avg_power_kw", "range", low=0.0),
        Contract("hourly", "sample_count", "range", low=0.0, low_open=True),
    ]
