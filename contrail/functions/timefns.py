"""Calendar features and duration rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: duration bins, right-closed
# (lo, hi]; the last bin is open-ended.
DURATION_BINS = ((0, 120, "short"), (120, 240, "medium"), (240, 480, "long"), (480, None, "very_long"))
# Peak hours (inclusive ranges) and weekend days (Sunday = 0).
PEAK_HOURS = ((7, 9), (17, 19))
WEEKEND_DAYS = (0, 6)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def departure_hour(ts="scheduled_departure") -> Column:
    return F.hour(_c(ts)).cast("int")


def day_of_week_sun0(ts="scheduled_departure") -> Column:
    """Sunday = 0 .. Saturday = 6 (PostgreSQL EXTRACT(DOW)); Spark's dayofweek is 1-based."""
    return (F.dayofweek(_c(ts)) - 1).cast("int")


def is_weekend(dow="day_of_week") -> Column:
    return _c(dow).isin(*WEEKEND_DAYS).cast("int")


def is_peak_hour(hour="departure_hour") -> Column:
    h = _c(hour)
    cond = F.lit(False)
    for lo, hi in PEAK_HOURS:
        cond = cond | h.between(lo, hi)
    return F.coalesce(cond, F.lit(False)).cast("int")


def duration_category(minutes="flight_duration_minutes") -> Column:
    """Right-closed bins like ``pd.cut``; <= 0 or null -> null. (Bucketizer is left-closed.)"""
    m = _c(minutes)
    expr = None
    for lo, hi, label in DURATION_BINS:
        cond = (m > lo) if hi is None else ((m > lo) & (m <= hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def micros_between(start="scheduled_departure", end="scheduled_arrival") -> Column:
    """Exact microseconds from start to end as a decimal, with no time zone.

    ``end - start`` of two ``timestamp_ntz`` is a day-time interval; its
    fields are summed. (``timestampdiff`` on ``timestamp_ntz`` goes through
    the session zone and counts a daylight-saving hour.)
    """
    iv = _c(end) - _c(start)
    secs = (F.extract(F.lit("DAY"), iv).cast("decimal(20,0)") * 86400
            + F.extract(F.lit("HOUR"), iv).cast("decimal(20,0)") * 3600
            + F.extract(F.lit("MINUTE"), iv).cast("decimal(20,0)") * 60
            + F.extract(F.lit("SECOND"), iv))
    return (secs * 1000000).cast("decimal(24,0)")


def minutes_between(start="scheduled_departure", end="scheduled_arrival") -> Column:
    """(end - start) in fractional minutes, exact to the microsecond."""
    return micros_between(_c(start) if not isinstance(start, str) else start,
                          end).cast("double") / 60000000.0


def ts_literal(value) -> Column:
    """A ``timestamp_ntz`` literal from a datetime / date / ISO text.

    Goes through text, so no time zone (of the Python process or of the
    session) can shift it; ``F.lit(datetime)`` would make a local-time
    ``timestamp`` first.
    """
    import datetime as _dt
    if isinstance(value, _dt.datetime):
        text = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def epoch_seconds(c) -> Column:
    """Whole seconds since 1970-01-01 of a ``timestamp_ntz`` (zone-independent, floored)."""
    us = micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(c))
    return F.floor(us / 1000000).cast("long")


def seconds_between(start, end) -> Column:
    """Fractional seconds from ``start`` to ``end`` (both ``timestamp_ntz``)."""
    return micros_between(_c(start), _c(end)).cast("double") / 1e6


def ntz_text(c) -> Column:
    """``yyyy-MM-dd HH:mm:ss.ffffff`` of a ``timestamp_ntz`` from its fields
    (``date_format`` would pass through the session zone)."""
    col = _c(c)
    two = lambda e: F.lpad(e.cast("string"), 2, "0")
    frac = (F.extract(F.lit("SECOND"), col) * 1000000).cast("long") % 1000000
    return F.concat(col.cast("date").cast("string"), F.lit(" "), two(F.hour(col)), F.lit(":"),
                    two(F.minute(col)), F.lit(":"), two(F.second(col)), F.lit("."),
                    F.lpad(frac.cast("string"), 6, "0"))


_EPOCH_NTZ = "1970-01-01 00:00:00"


def instant_of(c) -> Column:
    """``timestamp`` instant that reads the ``timestamp_ntz`` value as UTC,
    whatever the session zone (for watermarks and event-time windows)."""
    us = micros_between(F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), _c(c)).cast("long")
    return F.timestamp_micros(us)


def ntz_of_instant(c) -> Column:
    """Inverse of ``instant_of``: the UTC wall-clock of an instant as ``timestamp_ntz``."""
    us = F.unix_micros(_c(c))
    secs = (us.cast("decimal(24,0)") / 1000000).cast("decimal(18,6)")
    return F.lit(_EPOCH_NTZ).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)
