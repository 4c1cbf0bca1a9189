"""Cleaning and enrichment transforms, each usable with ``df.transform``.

All are single ``select``/``withColumns``/``filter`` steps: narrow, no
shuffle, fused into one whole-stage-codegen span with the scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions import geo, scoring, text, timefns

# Fixed values that must equal the reference: cleaned text and number fields, harmonised position schema.
TEXT_FIELDS = ("callsign", "origin_country", "airline", "aircraft_type",
               "departure_airport", "arrival_airport", "registration")
NUMERIC_FIELDS = ("latitude", "longitude", "altitude", "speed", "heading")

# Target types of the harmonised realtime table.
POSITION_TYPES = {
    "icao24": T.StringType(), "callsign": T.StringType(), "origin_country": T.StringType(),
    "latitude": T.DoubleType(), "longitude": T.DoubleType(), "altitude": T.DoubleType(),
    "speed": T.DoubleType(), "heading": T.DoubleType(), "vertical_speed": T.DoubleType(),
    "departure_airport": T.StringType(), "arrival_airport": T.StringType(),
    "airline": T.StringType(), "aircraft_type": T.StringType(), "registration": T.StringType(),
    "squawk": T.StringType(), "flight_status": T.StringType(), "data_source": T.StringType(),
    "extraction_time": T.TimestampNTZType(), "on_ground": T.BooleanType(),
}


def stamp_extraction(df: DataFrame, run_ts: _dt.datetime, time_col: str = "extraction_time",
                     date_col: str | None = "extraction_date") -> DataFrame:
    """Add the run's extraction time (and date). One value per run, passed in."""
    ts = timefns.ts_literal(run_ts)
    cols = {time_col: ts}
    if date_col:
        cols[date_col] = ts.cast("date")
    return df.withColumns(cols)


def tag_provenance(df: DataFrame, data_source: str, flight_type: str | None = None) -> DataFrame:
    cols = {"data_source": F.lit(data_source)}
    if flight_type is not None:
        cols["flight_type"] = F.lit(flight_type)
    return df.withColumns(cols)


def clean_callsign(df: DataFrame, col: str = "callsign") -> DataFrame:
    """To text, strip all whitespace, the whole value 'None' (or null) -> ''."""
    return df.withColumn(col, text.clean_text(col, missing=("None",)))


def coerce_numeric(df: DataFrame, cols=NUMERIC_FIELDS) -> DataFrame:
    """Text -> double for each present column; bad values -> null, never an error."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: text.coerce_double(c) for c in present})


def derive_kinematics(df: DataFrame) -> DataFrame:
    """altitude <- baro_altitude, speed <- velocity, heading <- true_track (as doubles)."""
    return df.withColumns({
        "altitude": text.coerce_double("baro_altitude"),
        "speed": text.coerce_double("velocity"),
        "heading": text.coerce_double("true_track"),
    })


def require_keys(df: DataFrame, keys=("icao24", "latitude", "longitude")) -> DataFrame:
    return df.dropna(subset=list(keys))


def valid_coordinates(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.filter(geo.coordinates_valid(lat, lon))


def parse_timestamps(df: DataFrame, cols=("scheduled_departure", "scheduled_arrival"),
                     fmt: str | None = None, flag: str | None = "timestamps_valid") -> DataFrame:
    """Text -> timestamp with ``try_to_timestamp``; a bad value becomes null.

    The reference fails the job on a bad value; here the row is kept, the
    value is null and ``flag`` marks it, so rejects can be counted.
    """
    parsed = {}
    for c in cols:
        src = F.col(c).cast("string")
        # without a pattern: a zone-free cast to timestamp_ntz (ISO / SQL text)
        parsed[c] = (F.try_to_timestamp(src, F.lit(fmt)).cast("timestamp_ntz") if fmt
                     else src.try_cast("timestamp_ntz"))
    out = dict(parsed)
    if flag:
        ok = F.lit(True)
        for c in cols:
            ok = ok & (parsed[c].isNotNull() | F.col(c).isNull())
        out[flag] = F.coalesce(ok, F.lit(False))
    # one select: every expression reads the text columns, then replaces them
    return df.select(*[c for c in df.columns if c not in out], *[v.alias(k) for k, v in out.items()])


def flight_duration(df: DataFrame, start: str = "scheduled_departure", end: str = "scheduled_arrival",
                    out: str = "flight_duration_minutes") -> DataFrame:
    return df.withColumn(out, timefns.minutes_between(start, end))


def carrier_prefix(df: DataFrame, col: str = "flight_number", out: str = "airline") -> DataFrame:
    return df.withColumn(out, F.substring(F.col(col), 1, 2))


def harmonize_schema(df: DataFrame, target: dict = None) -> DataFrame:
    """Select exactly the target schema: missing columns come in as typed nulls."""
    target = target or POSITION_TYPES
    cols = []
    for name, dtype in target.items():
        if name in df.columns:
            cols.append(F.col(name).cast(dtype).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    extra = [c for c in df.columns if c not in target]
    return df.select(*extra, *cols)


def normalize_text(df: DataFrame, cols=TEXT_FIELDS) -> DataFrame:
    """Strip, and whole values None/nan/null -> '' for each text field."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: text.clean_text(c) for c in present})


def presence_flags(df: DataFrame) -> DataFrame:
    on_ground = F.col("on_ground") if "on_ground" in df.columns else F.lit(None).cast("boolean")
    return df.withColumns({
        "is_airborne": ~F.coalesce(on_ground, F.lit(False)),
        "has_position": F.col("latitude").isNotNull() & F.col("longitude").isNotNull(),
        "has_speed": F.col("speed").isNotNull(),
        "has_altitude": F.col("altitude").isNotNull(),
    })


def add_region(df: DataFrame, out: str = "region") -> DataFrame:
    return df.withColumn(out, geo.classify_region("latitude", "longitude"))


def add_quality_score(df: DataFrame, out: str = "data_quality_score") -> DataFrame:
    return df.withColumn(out, scoring.quality_score())


def map_feed_defaults(df: DataFrame) -> DataFrame:
    """Map-feed shape: text null/'' -> 'Unknown', altitude/speed null -> 0."""
    return df.select(
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        text.or_unknown("callsign").alias("callsign"),
        F.coalesce(F.col("altitude"), F.lit(0.0)).alias("altitude"),
        F.coalesce(F.col("speed"), F.lit(0.0)).alias("speed"),
        text.or_unknown("airline").alias("airline"),
        text.or_unknown("origin_country").alias("country"),
        text.or_unknown("region").alias("region"),
        text.or_unknown("data_source").alias("source"),
    )


def nan_to_null(df: DataFrame, cols=None) -> DataFrame:
    cols = cols or [f.name for f in df.schema.fields
                    if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: text.nan_to_null(c) for c in cols})


def route_key(df: DataFrame, origin: str = "origin_airport", dest: str = "destination_airport",
              out: str = "route", display: str | None = "route_display") -> DataFrame:
    """``origin_destination`` key (null if either side is null) and ``origin -> destination``."""
    cols = {out: F.concat(F.col(origin), F.lit("_"), F.col(dest))}
    if display:
        cols[display] = F.concat(F.col(origin), F.lit(" -> "), F.col(dest))
    return df.withColumns(cols)


def standardize_positions(df: DataFrame) -> DataFrame:
    """harmonize -> numeric coercion -> text normalisation -> presence flags."""
    return (df.transform(harmonize_schema)
              .transform(coerce_numeric)
              .transform(normalize_text)
              .transform(presence_flags))
