"""Exact, order-independent averages.

A float ``avg`` depends on the summation order, i.e. on how the data is
partitioned: the same report can differ in its last bits between runs or
engines. ``exact_avg`` quantises each value to ``10**-digits`` units, sums
those as exact integers (DECIMAL(38,0)), and rounds the mean half-up with
integer division, so the result is the same on every run and partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _number(c) -> Column:
    """Values that are no numbers (NaN) count as missing."""
    col = _c(c)
    return F.when(~F.isnan(col.cast("double")), col)


def exact_units(c, digits: int = 6) -> Column:
    """The value in whole units of ``10**-digits`` (half-up), as DECIMAL(38,0); null for null and NaN.

    ``digits`` is the resolution of the result: values are cut to it before
    they are summed, so one below half a unit counts as 0.
    """
    return F.round(_number(c) * F.lit(float(10 ** digits))).cast("decimal(38,0)")


def mean_of_units(total: Column, n: Column, digits: int = 6) -> Column:
    """``total / n`` half-up, from a sum of :func:`exact_units` and the count of its values; null if there are none."""
    n = n.cast("decimal(38,0)")
    a = total * 2 + n
    b = F.nullif(n * 2, F.lit(0).cast("decimal(38,0)"))
    q = (a - F.pmod(a, b)) / b          # floor(a / b), exact: the numerator is a multiple of b
    return q.cast("double") / 10 ** digits


def exact_avg(c, digits: int = 6) -> Column:
    """Mean of the values that are neither null nor NaN, rounded half-up to ``digits`` decimals (null if none)."""
    units = exact_units(c, digits)
    return mean_of_units(F.sum(units), F.count(units), digits)


def exact_avg_sql(x: str, digits: int = 6) -> str:
    """The same rule as DuckDB SQL."""
    scale = 10 ** digits
    a = f"(2 * sum(CAST(round(({x}) * {scale}.0) AS HUGEINT)) + count({x}))"
    b = f"(2 * count({x}))"
    floor_div = f"(({a} - ((({a}) % {b}) + {b}) % {b}) // {b})"
    return f"(CASE WHEN count({x}) > 0 THEN CAST({floor_div} AS DOUBLE) / {scale} END)"


def distinct_count(c, approx: bool = False, rsd: float = 0.01) -> Column:
    """``count(DISTINCT c)`` (exact, as a long) or a HyperLogLog++ estimate.

    Exact distinct counts expand each row once per distinct column before the
    shuffle; at large scale ``approx=True`` keeps one fixed-size sketch per
    group instead (relative standard deviation ``rsd``).
    """
    col = _c(c)
    return F.approx_count_distinct(col, rsd) if approx else F.countDistinct(col).cast("long")
