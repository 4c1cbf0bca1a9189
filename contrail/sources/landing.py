"""Landing-zone readers: state-vector snapshots, nested and flat live-flight
JSON, lenient CSV, optional sources, the airport reference file, reports.

Fetching from the public APIs is outside the library: the contract is a
folder of files (one JSON document per snapshot, or CSV), read in parallel
with an explicit schema (no inference) and flattened with ``explode``.
"""

from __future__ import annotations

import datetime as _dt
import warnings

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions import geo, text
from contrail.functions.timefns import ts_literal
from contrail.operators import cleaning

# Fixed values that must equal the reference: state-vector slot names, in order.
STATE_SLOTS = (
    ("icao24", T.StringType()), ("callsign", T.StringType()), ("origin_country", T.StringType()),
    ("time_position", T.LongType()), ("last_contact", T.LongType()), ("longitude", T.DoubleType()),
    ("latitude", T.DoubleType()), ("baro_altitude", T.DoubleType()), ("on_ground", T.BooleanType()),
    ("velocity", T.DoubleType()), ("true_track", T.DoubleType()), ("vertical_rate", T.DoubleType()),
    ("sensors", T.StringType()), ("geo_altitude", T.DoubleType()), ("squawk", T.StringType()),
    ("spi", T.BooleanType()), ("position_source", T.IntegerType()),
)

STATE_SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("time", T.LongType()),
    T.StructField("states", T.ArrayType(T.ArrayType(T.StringType()))),
])

_S, _D = T.StringType(), T.DoubleType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


NESTED_LIVE_SCHEMA = _struct(("data", T.ArrayType(_struct(
    ("flight", _struct(("icao", _S), ("iata", _S))),
    ("departure", _struct(("country", _S), ("iata", _S))),
    ("arrival", _struct(("iata", _S),)),
    ("airline", _struct(("iata", _S),)),
    ("aircraft", _struct(("iata", _S),)),
    ("live", _struct(("latitude", _S), ("longitude", _S), ("altitude", _S),
                     ("speed_horizontal", _S), ("direction", _S))),
    ("flight_status", _S),
))))

FLAT_LIVE_FIELDS = ("hex", "flight_iata", "flag", "lat", "lng", "alt", "speed", "dir", "v_speed",
                    "dep_iata", "arr_iata", "airline_iata", "aircraft_icao", "reg_number", "squawk", "updated")
FLAT_LIVE_SCHEMA = _struct(("response", T.ArrayType(_struct(*[(f, _S) for f in FLAT_LIVE_FIELDS]))))

AIRPORT_SCHEMA = _struct(("code", _S), ("name", _S), ("city", _S), ("country", _S),
                         ("latitude", _D), ("longitude", _D))


def _now_or(run_ts) -> Column:
    return (ts_literal(run_ts) if run_ts is not None
            else F.current_timestamp().cast("timestamp_ntz"))


def _documents(raw: DataFrame) -> DataFrame:
    """`raw` with ``_doc``: the place of each document in the landing zone.

    File, byte offset of the split and row in the split order the documents
    as they stand in the files, whatever the splits are.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    return raw.select("*", F.struct(F.col("_metadata.file_path").alias("file"),
                                    F.col("_metadata.file_block_start").alias("start"), row.alias("row")).alias("_doc"))


def _arrival() -> Column:
    """Order of arrival of a record: its document's place, then its place in the document's array."""
    return F.struct("_doc.file", "_doc.start", "_doc.row", "pos").alias("arrival")


def _cast_slot(c: Column, t: T.DataType) -> Column:
    if isinstance(t, T.DoubleType):
        return text.coerce_double(c)
    if isinstance(t, (T.LongType, T.IntegerType)):
        whole = text.coerce_double(c)
        return F.when(whole == F.floor(whole), whole).try_cast(t)
    return c.try_cast(t)


def ingest_state_vectors(spark: SparkSession, path: str, run_ts: _dt.datetime | None = None,
                         multi_line: bool = False) -> DataFrame:
    """Snapshot documents ``{"time": s, "states": [[17+ slots], ...]}`` -> one row per state.

    Null states and states with fewer than 17 slots are dropped; extra slots
    are cut; each slot is cast to its type (a bad value becomes null).
    ``data_timestamp`` is the snapshot time, the load time when the document
    has none. ``arrival`` orders the rows as they stand in the files.
    """
    return state_vectors(_documents(spark.read.schema(STATE_SNAPSHOT_SCHEMA).option("multiLine", multi_line).json(path)),
                         run_ts)


def state_vectors(raw: DataFrame, run_ts: _dt.datetime | None = None) -> DataFrame:
    """The rows of snapshot documents that are already read (with ``_doc``)."""
    now_s = F.unix_timestamp(F.current_timestamp())
    st = (raw.select(F.coalesce(F.col("time"), now_s).alias("data_timestamp"),
                     "_doc", F.posexplode("states").alias("pos", "s"))
          .filter(F.col("s").isNotNull() & (F.size("s") >= len(STATE_SLOTS))))
    slots = [_cast_slot(F.col("s")[i], t).alias(n) for i, (n, t) in enumerate(STATE_SLOTS)]
    return st.select(*slots, "data_timestamp", _now_or(run_ts).alias("extraction_time"),
                     F.lit("opensky").alias("data_source"), _arrival())


def extract_state_vectors(states: DataFrame) -> DataFrame:
    """Ingested states -> common columns: clean the callsign, derive altitude, speed and heading,
    require key and coordinates, check their range, add the region."""
    return (states.transform(cleaning.clean_callsign).transform(cleaning.derive_kinematics)
            .transform(cleaning.require_keys).transform(cleaning.valid_coordinates).transform(cleaning.add_region))


def _text(c: str) -> Column:
    # the reference's ``.get(key, '')``: missing -> ''
    return F.coalesce(F.col(c), F.lit(""))


def _extract_rules(df: DataFrame) -> DataFrame:
    """Commercial-source extract rules: numeric coercion, coordinates
    present and in range, region."""
    df = df.withColumns({"latitude": text.coerce_double("latitude"), "longitude": text.coerce_double("longitude")})
    return (df.dropna(subset=["latitude", "longitude"])
              .filter(geo.coordinates_valid())
              .withColumn("region", geo.classify_region()))


def ingest_nested_live(spark: SparkSession, path: str, run_ts: _dt.datetime | None = None,
                       multi_line: bool = False) -> DataFrame:
    """Nested live-flight documents ``{"data": [...]}`` -> common columns."""
    return nested_live(_documents(spark.read.schema(NESTED_LIVE_SCHEMA).option("multiLine", multi_line).json(path)), run_ts)


def nested_live(raw: DataFrame, run_ts: _dt.datetime | None = None) -> DataFrame:
    """The rows of nested live-flight documents that are already read (with ``_doc``)."""
    f = raw.select("_doc", F.posexplode("data").alias("pos", "f")).filter("f is not null").select("_doc", "pos", "f.*")
    flat = f.select(
        _text("flight.icao").alias("icao24"), _text("flight.iata").alias("callsign"),
        _text("departure.country").alias("origin_country"),
        F.col("live.latitude").alias("latitude"), F.col("live.longitude").alias("longitude"),
        text.coerce_double("live.altitude").alias("altitude"),
        text.coerce_double("live.speed_horizontal").alias("speed"),
        text.coerce_double("live.direction").alias("heading"),
        _text("departure.iata").alias("departure_airport"), _text("arrival.iata").alias("arrival_airport"),
        _text("airline.iata").alias("airline"), _text("aircraft.iata").alias("aircraft_type"),
        _text("flight_status").alias("flight_status"),
        F.lit("aviationstack").alias("data_source"), _now_or(run_ts).alias("extraction_time"), _arrival())
    return _extract_rules(flat)


def ingest_flat_live(spark: SparkSession, path: str, run_ts: _dt.datetime | None = None,
                       multi_line: bool = False) -> DataFrame:
    """Flat live-flight documents ``{"response": [...]}`` -> common columns (renames)."""
    return flat_live(_documents(spark.read.schema(FLAT_LIVE_SCHEMA).option("multiLine", multi_line).json(path)), run_ts)


def flat_live(raw: DataFrame, run_ts: _dt.datetime | None = None) -> DataFrame:
    """The rows of flat live-flight documents that are already read (with ``_doc``)."""
    f = raw.select("_doc", F.posexplode("response").alias("pos", "f")).filter("f is not null").select("_doc", "pos", "f.*")
    flat = f.select(
        _text("hex").alias("icao24"), _text("flight_iata").alias("callsign"),
        _text("flag").alias("origin_country"),
        F.col("lat").alias("latitude"), F.col("lng").alias("longitude"),
        text.coerce_double("alt").alias("altitude"), text.coerce_double("speed").alias("speed"),
        text.coerce_double("dir").alias("heading"), text.coerce_double("v_speed").alias("vertical_speed"),
        _text("dep_iata").alias("departure_airport"), _text("arr_iata").alias("arrival_airport"),
        _text("airline_iata").alias("airline"), _text("aircraft_icao").alias("aircraft_type"),
        _text("reg_number").alias("registration"), _text("squawk").alias("squawk"),
        F.lit("airlabs").alias("data_source"), _now_or(run_ts).alias("extraction_time"),
        F.col("updated").try_cast("long").alias("updated_timestamp"), _arrival())
    return _extract_rules(flat)


#: A quoted field: from a quote at the field's start to the next single quote, or to the line's end if none closes it.
_QUOTED_FIELD = '(^|,)"(?:[^"]++|"")*+(?:"|$)'


def csv_fields(line: Column) -> Column:
    """How many fields a CSV line has; separators inside quoted fields don't count."""
    bare = F.regexp_replace(line, _QUOTED_FIELD, "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1


def csv_lines(spark: SparkSession, path: str, schema: T.StructType, header: bool = False) -> DataFrame:
    """(columns of `schema`, long_row): every line that isn't blank, short ones padded with nulls.

    ``long_row`` marks lines with more fields than columns, also when the
    surplus fields are empty; of these the first fields are given. With
    ``header`` the lines that repeat the first line of the data are headers.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "")
    if header:
        first = lines.limit(1).collect()
        lines = lines.filter(F.col("value") != first[0][0]) if first else lines
    parsed = F.from_csv("value", schema.simpleString()[len("struct<"):-1].replace(":", " "), {"mode": "PERMISSIVE"})
    return lines.select(parsed.alias("of"), (csv_fields(F.col("value")) > len(schema)).alias("long_row")).select("of.*", "long_row")


def read_csv_lenient(spark: SparkSession, path: str, schema: T.StructType, header: bool = False) -> DataFrame:
    """CSV where rows with too many fields are skipped and short rows padded.

    The fields of the raw line are counted, so a long row goes whatever its
    surplus fields hold. Quoted commas are fine; a quoted line break ends a
    row, as the files are read line by line.
    """
    return csv_lines(spark, path, schema, header).filter(~F.col("long_row")).drop("long_row")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                  **options) -> DataFrame:
    """A missing, unreadable or empty source gives an empty typed frame.

    The files are looked at here, not first in the caller's action: columnar
    ones by their footers, text ones (which may be compressed) by reading them
    once without parsing. If one cannot be read, the whole source counts as
    unreadable and a warning names the cause. No bad file is skipped silently.
    """
    empty = spark.createDataFrame([], schema)
    if not path_exists(spark, path):
        return empty
    try:
        df = spark.read.schema(schema).options(**options).format(fmt).load(path)
        (df if fmt in ("parquet", "orc") else spark.read.text(path)).count()
        return df
    except (PySparkException, Py4JJavaError) as e:
        warnings.warn(f"{path} cannot be read as {fmt}: {str(e).splitlines()[0]}", stacklevel=2)
        return empty


def airport_dimension(spark: SparkSession, path: str, extraction_date: _dt.date,
                      header: bool = True) -> DataFrame:
    """Airport reference CSV with a fixed schema, stamped with the run date."""
    df = spark.read.schema(AIRPORT_SCHEMA).option("header", header).csv(path)
    return df.withColumn("extraction_date", F.lit(extraction_date).cast("date"))


def read_report_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Load report documents back; a missing folder gives an empty frame."""
    return read_or_empty(spark, path, schema, fmt="json")
