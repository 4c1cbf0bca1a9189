"""Geographic rules as column expressions (no row-wise Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: region boxes, tested in this
# order, first match wins, bounds inclusive. (name, lat_min, lat_max,
# lon_min, lon_max); None = unbounded.
REGION_BOXES = (
    ("Europe", 35, None, -25, 60),
    ("Asia", 15, 55, 60, 150),
    ("Africa", -35, 37, -20, 55),
    ("North America", 15, 72, -170, -50),
    ("South America", -60, 15, -85, -30),
    ("Oceania", -50, -10, 110, 180),
    ("Antarctica", None, -60, None, None),
    ("Arctic", 66.5, None, None, None),
)
REGION_UNKNOWN = "Unknown"
REGION_OTHER = "Other"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _box(lat: Column, lon: Column, lat_lo, lat_hi, lon_lo, lon_hi) -> Column:
    cond = F.lit(True)
    for col, lo, hi in ((lat, lat_lo, lat_hi), (lon, lon_lo, lon_hi)):
        if lo is not None:
            cond = cond & (col >= F.lit(lo))
        if hi is not None:
            cond = cond & (col <= F.lit(hi))
    return cond


def classify_region(lat="latitude", lon="longitude") -> Column:
    """Region name for a position: a CASE WHEN chain, evaluated in codegen."""
    lat, lon = _c(lat), _c(lon)
    expr = F.when(lat.isNull() | lon.isNull(), F.lit(REGION_UNKNOWN))
    for name, *bounds in REGION_BOXES:
        expr = expr.when(_box(lat, lon, *bounds), F.lit(name))
    return expr.otherwise(F.lit(REGION_OTHER))


def region_sql(lat: str = "latitude", lon: str = "longitude") -> str:
    """The same rule as ANSI SQL text (used by oracle queries)."""
    parts = [f"CASE WHEN {lat} IS NULL OR {lon} IS NULL THEN '{REGION_UNKNOWN}'"]
    for name, la_lo, la_hi, lo_lo, lo_hi in REGION_BOXES:
        conds = []
        for col, lo, hi in ((lat, la_lo, la_hi), (lon, lo_lo, lo_hi)):
            if lo is not None:
                conds.append(f"{col} >= {lo}")
            if hi is not None:
                conds.append(f"{col} <= {hi}")
        parts.append(f"WHEN {' AND '.join(conds)} THEN '{name}'")
    parts.append(f"ELSE '{REGION_OTHER}' END")
    return " ".join(parts)


def coordinates_valid(lat="latitude", lon="longitude") -> Column:
    """lat in [-90, 90] and lon in [-180, 180], inclusive; null -> null (dropped by filter)."""
    lat, lon = _c(lat), _c(lon)
    return lat.between(-90, 90) & lon.between(-180, 180)
