"""Text and numeric coercion rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes any whitespace, Spark's trim() only spaces:
# strip the same set as the regex class \s (space, tab, LF, VT, FF, CR).
WHITESPACE = " \t\n\x0b\x0c\r"

# Whole values that the reference's text round trip turns into ''.
MISSING_TEXT = ("None", "nan")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Strip leading/trailing whitespace of every kind (tabs, newlines too)."""
    return F.btrim(_c(c), F.lit(WHITESPACE))


def clean_text(c, missing: tuple[str, ...] = MISSING_TEXT) -> Column:
    """null -> '', strip, then whole values in ``missing`` -> ''.

    ``'Nonesuch'`` is left alone: only the whole value is replaced.
    """
    s = strip_ws(F.coalesce(_c(c).cast("string"), F.lit("")))
    return F.when(s.isin(*missing), F.lit("")).otherwise(s)


#: A plain decimal number; ``try_cast`` alone also takes 'NaN', '1d', '2F' and '0x1p3'.
DECIMAL_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def coerce_double(c) -> Column:
    """Text/number -> double; anything that is no plain decimal number becomes null (never raises).

    White space around the number is allowed. NaN and infinities, spelled out
    or by overflow, are no measurements: they become null too, so none
    reaches a flag, a comparison or an average.
    """
    s = strip_ws(_c(c).cast("string"))
    value = s.try_cast("double")
    return F.when(s.rlike(DECIMAL_TEXT) & (F.abs(value) < F.lit(float("inf"))), value)


def nan_to_null(c) -> Column:
    """NaN -> null, so no NaN ever reaches a comparison (Spark orders NaN high)."""
    col = _c(c)
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


def or_unknown(c, default: str = "Unknown") -> Column:
    """Map-feed default for text: null or '' -> default."""
    col = _c(c)
    return F.when(col.isNull() | (col == ""), F.lit(default)).otherwise(col)
