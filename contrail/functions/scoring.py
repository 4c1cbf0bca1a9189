"""Quality score, bands, tiers and exact percentage rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: quality score weights.
QUALITY_WEIGHTS = {
    "position": 40,
    "speed": 20,
    "altitude": 20,
    "callsign": 10,
    "country": 10,
}

# Altitude band upper bounds (exclusive) and labels.
ALTITUDE_BANDS = (
    (10000, "Low (< 10k ft)"),
    (20000, "Medium (10k-20k ft)"),
    (30000, "High (20k-30k ft)"),
    (40000, "Very High (30k-40k ft)"),
)
ALTITUDE_TOP_BAND = "Extreme (> 40k ft)"

# Tier thresholds.
QUALITY_TIERS = ((80, "high"), (60, "medium"))  # score >= t
QUALITY_TIER_ELSE = "low"
ON_TIME_TIERS = ((80, "good"), (60, "warning"))  # pct > t
ON_TIME_TIER_ELSE = "error"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _nonempty(c: Column) -> Column:
    return F.coalesce(F.length(c), F.lit(0)) > 0


def quality_score(has_position="has_position", has_speed="has_speed",
                  has_altitude="has_altitude", callsign="callsign",
                  country="origin_country", weights: dict | None = None) -> Column:
    """Weighted completeness score 0..100 (int)."""
    w = {**QUALITY_WEIGHTS, **(weights or {})}
    parts = [
        (F.coalesce(_c(has_position), F.lit(False)), w["position"]),
        (F.coalesce(_c(has_speed), F.lit(False)), w["speed"]),
        (F.coalesce(_c(has_altitude), F.lit(False)), w["altitude"]),
        (_nonempty(_c(callsign)), w["callsign"]),
        (_nonempty(_c(country)), w["country"]),
    ]
    total = F.lit(0)
    for cond, weight in parts:
        total = total + F.when(cond, F.lit(weight)).otherwise(F.lit(0))
    return total.cast("int")


def altitude_band(c="altitude") -> Column:
    """Altitude range label; null altitude falls to the top band as in the reference SQL."""
    col = _c(c)
    (b0, l0), *rest = ALTITUDE_BANDS
    expr = F.when(col < b0, F.lit(l0))
    for bound, label in rest:
        expr = expr.when(col < bound, F.lit(label))
    return expr.otherwise(F.lit(ALTITUDE_TOP_BAND))


def quality_tier(c="data_quality_score") -> Column:
    col = _c(c)
    (t0, l0), (t1, l1) = QUALITY_TIERS
    return F.when(col >= t0, F.lit(l0)).when(col >= t1, F.lit(l1)).otherwise(F.lit(QUALITY_TIER_ELSE))


def on_time_tier(c="on_time_percentage") -> Column:
    col = _c(c)
    (t0, l0), (t1, l1) = ON_TIME_TIERS
    return F.when(col > t0, F.lit(l0)).when(col > t1, F.lit(l1)).otherwise(F.lit(ON_TIME_TIER_ELSE))


def pct_half_up(hits: str, total: str, digits: int = 2) -> Column:
    """round(hits * 100 / total, digits) with exact decimal half-up, from integers.

    ``hits`` and ``total`` are SQL expressions (column names or aggregates).
    Equals PostgreSQL's ``ROUND(COUNT(..) * 100.0 / COUNT(*), 2)``; null when
    total is 0 instead of a division error.
    """
    scale = 10 ** digits
    h, n = f"CAST(({hits}) AS BIGINT)", f"CAST(({total}) AS BIGINT)"
    return F.expr(
        f"CASE WHEN {n} > 0 THEN CAST(({h} * {200 * scale} + {n}) div (2 * {n}) AS DOUBLE) / {scale} END"
    )


def pct_half_up_sql(hits: str, total: str, digits: int = 2) -> str:
    """The same rule as DuckDB SQL (``//`` is integer division there)."""
    scale = 10 ** digits
    h, n = f"CAST(({hits}) AS BIGINT)", f"CAST(({total}) AS BIGINT)"
    return (f"CASE WHEN {n} > 0 THEN CAST(({h} * {200 * scale} + {n}) // (2 * {n}) AS DOUBLE) / {scale} END")
