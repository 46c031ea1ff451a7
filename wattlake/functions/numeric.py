"""Rounding and order-independent sums.

A sum of doubles depends on the order in which partitions arrive, so a retried
task can change the last digit and, at a rounding boundary, the result.  Meter
measures are decimals with few digits; summing them as integers in units of
10**-scale is exact and stays in generated code (a DECIMAL sum per row is about
ten times slower).  A sum over rows is kept in two parts of a unit count, which
hold any sum over 8e12 rows; sums of sums are DECIMAL(38).

Values of more than 2**62 units (4.6e12 at the default scale) have no such count.
They are added as doubles beside the units; a total too large for DECIMAL(38) is
null rather than wrong.  What is not a number or infinite is null.  Digits beyond ``scale`` (default 6, a
parameter of each function) are rounded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 6
LOW_BITS = 20                       # of a unit count, summed apart from the rest


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def half_up(value: Column | str, digits: int) -> Column:
    """Round half away from zero on the scaled double."""
    column = _column(value)
    factor = float(10 ** digits)
    magnitude = F.floor(F.abs(column) * factor + 0.5) / factor
    return F.when(column < 0, F.lit(0.0) - magnitude).otherwise(magnitude) + F.lit(0.0)


MOST_UNITS = 1e30                   # of one value in a sum over a window; 1e8 of them still fit a total


def _scaled(value: Column | str, scale: int) -> Column:
    return _column(value).cast("double") * float(10 ** scale)


def is_number(value: Column | str) -> Column:
    """Neither null nor NaN nor infinite."""
    return F.coalesce(F.abs(_column(value).cast("double")) < float("inf"), F.lit(False))     # NaN is larger than any number


def count_numbers(value: Column | str) -> Column:
    """Aggregate: how many values there are to a sum of the same column."""
    return F.count_if(is_number(value))


def decimal_units(value: Column | str, scale: int = SCALE) -> Column:
    """The value in units of 10**-scale as a decimal; null if it is no number or beyond ``MOST_UNITS``."""
    scaled = _scaled(value, scale)
    return F.when(F.abs(scaled) <= MOST_UNITS, F.rint(scaled).try_cast("decimal(31,0)"))


def sum_units(value: Column | str, scale: int = SCALE) -> Column:
    """Aggregate: the exact sum in units of 10**-scale as DECIMAL(38), without overflow and in generated code."""
    scaled = _scaled(value, scale)
    size = F.abs(scaled)
    units = F.when(size <= float(2 ** 62), F.rint(scaled).cast("bigint"))
    low = F.sum(units.bitwiseAND(F.lit((1 << LOW_BITS) - 1).cast("bigint"))).cast("decimal(38,0)")
    small = low + F.sum(F.shiftright(units, LOW_BITS)).cast("decimal(38,0)") * F.lit(1 << LOW_BITS).cast("decimal(8,0)")
    large = F.sum(F.when((size > float(2 ** 62)) & (size < float("inf")), scaled))
    return F.when(large.isNull(), small).otherwise(F.coalesce(small, F.lit(0).cast("decimal(38,0)")) + large.try_cast("decimal(38,0)")) \
        .cast("decimal(38,0)")


def total_units(units: Column | str) -> Column:
    """Aggregate: the sum of sums of units."""
    return F.sum(_column(units).cast("decimal(38,0)"))


def from_units(units: Column | str, scale: int = SCALE) -> Column:
    return _column(units).cast("double") / F.lit(float(10 ** scale))


def exact_sum(value: Column | str, scale: int = SCALE) -> Column:
    """Aggregate: sum that does not depend on row order."""
    return from_units(sum_units(value, scale), scale)


def exact_avg(value: Column | str, scale: int = SCALE) -> Column:
    """Aggregate: mean over the numbers among the values, independent of row order."""
    return F.try_divide(exact_sum(value, scale), count_numbers(value).cast("double"))


def mean_from(units: Column | str, count: Column | str, scale: int = SCALE) -> Column:
    """Mean from a sum in units and a count, e.g. after a pre-aggregation."""
    return F.try_divide(from_units(units, scale), _column(count).cast("double"))
