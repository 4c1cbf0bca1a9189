"""Column rules: pure ``Column -> Column`` expressions, all JVM-side."""

from contrail.functions.geo import classify_region, coordinates_valid
from contrail.functions.scoring import (
    altitude_band,
    on_time_tier,
    pct_half_up,
    quality_score,
    quality_tier,
)
from contrail.functions.text import (
    clean_text,
    coerce_double,
    nan_to_null,
    or_unknown,
    strip_ws,
)
from contrail.functions.timefns import (
    day_of_week_sun0,
    departure_hour,
    duration_category,
    is_peak_hour,
    is_weekend,
    minutes_between,
)

__all__ = [
    "altitude_band", "classify_region", "clean_text", "coerce_double", "coordinates_valid",
    "day_of_week_sun0", "departure_hour", "duration_category", "is_peak_hour", "is_weekend",
    "minutes_between", "nan_to_null", "on_time_tier", "or_unknown", "pct_half_up",
    "quality_score", "quality_tier", "strip_ws",
]
