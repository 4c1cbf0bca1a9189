"""Query registry: name -> (Spark callable ``(spark, sf_dir) -> DataFrame``,
DuckDB oracle SQL or None).

Each callable reads the driver tables (or data Spark derives from them)
through ``contrail.sources.testdata``, runs one library operator and
returns a lazy DataFrame. Float aggregates are rounded the same way on both
sides (``floor(x * 1e6 + 0.5) / 1e6``) so the engines' summation order does
not change the value hash.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions import scoring
from contrail.functions.numeric import exact_avg_sql as xavg
from contrail.functions.scoring import pct_half_up_sql
from contrail.operators import anomalies, checks, cleaning, live, merge, ml, realtime, reports, rollups
from contrail.plans import warehouse
from contrail.plans.oracle import clean_sql, r6, sql
from contrail.sources import testdata

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

# Fixed run parameters (the reference used the wall clock).
RUN_TS = _dt.datetime(2025, 7, 12, 13, 42, 58)
FRESHNESS_AS_OF = _dt.date(1998, 12, 1)


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.floor(F.col(c) * 1000000.0 + 0.5) / 1000000.0 for c in cols})


# ---------------------------------------------------------------- views

def flights(spark, d):
    """The scheduled-flights stage table (built once per session)."""
    return warehouse.scheduled_flights(spark, d)


def positions(spark, d):
    return testdata.positions(spark, d)


def airports(spark, d):
    return warehouse.airports(spark, d)


def history(spark, d):
    return warehouse.realtime_history(spark, d).drop(live.DAY)


def snapshot(spark, d):
    return warehouse.realtime_snapshot(spark, d)


FLIGHT_COLS = ("flight_number, airline, origin_airport, destination_airport, scheduled_departure, "
               "scheduled_arrival, aircraft_type, status, gate, extraction_date, data_source, flight_type, "
               "flight_duration_minutes")
POSITION_COLS = ("seq, icao24, callsign, origin_country, latitude, longitude, altitude, speed, heading, "
                 "on_ground, airline, aircraft_type, data_source, extraction_time")
HISTORY_COLS = ", ".join(realtime.HISTORY_COLUMNS)


@query("scan_table", sql(f"SELECT {FLIGHT_COLS} FROM flights", "flights"))
def q_scan_table(spark, d):
    return flights(spark, d)


@query("flight_etl", sql(f"SELECT {FLIGHT_COLS} FROM flights", "flights"))
def q_flight_etl(spark, d):
    """The extract-and-join job itself, straight from the driver tables."""
    return testdata.flights(spark, d)


@query("scan_positions", sql(f"SELECT {POSITION_COLS} FROM positions", "positions"))
def q_scan_positions(spark, d):
    return positions(spark, d)


# ------------------------------------------------- §2.3 cleaning / enrichment

@query("stamp_extraction", sql("""
SELECT flight_number, airline, TIMESTAMP '2025-07-12 13:42:58' AS extraction_time,
       DATE '2025-07-12' AS extraction_date FROM flights""", "flights"))
def q_stamp_extraction(spark, d):
    return flights(spark, d).select("flight_number", "airline").transform(
        cleaning.stamp_extraction, RUN_TS)


@query("tag_provenance", sql("""
SELECT seq, icao24, 'api' AS data_source, 'real_time' AS flight_type FROM positions""", "positions"))
def q_tag_provenance(spark, d):
    return positions(spark, d).select("seq", "icao24").transform(cleaning.tag_provenance, "api", "real_time")


@query("clean_callsign", sql(f"""
SELECT seq, {clean_sql('callsign', ('None',))} AS callsign FROM positions""", "positions"))
def q_clean_callsign(spark, d):
    return positions(spark, d).select("seq", "callsign").transform(cleaning.clean_callsign)


ODD_NUMBERS = ("nan", "NaN", "Infinity", "-inf", "1d", "2F", "0x1p3", "1_000", "1e999", "-1.5e3", " 7 ", ".5", "3.", "")
_DECIMAL_SQL = r"'[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?'"


def _number_sql(x: str) -> str:
    t = f"trim({x}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    return (f"CASE WHEN regexp_full_match({t}, {_DECIMAL_SQL}) AND NOT isinf(TRY_CAST({t} AS DOUBLE)) "
            f"THEN TRY_CAST({t} AS DOUBLE) END")


_ODD_SQL = "list_extract([" + ", ".join(f"'{x}'" for x in ODD_NUMBERS) + f"], CAST(event_id % {len(ODD_NUMBERS)} AS INTEGER) + 1)"


@query("coerce_numeric", sql(f"""
SELECT event_id AS seq, {_number_sql("CAST(value AS VARCHAR)")} AS value,
       {_number_sql("json_extract_string(props, '$.k')")} AS k,
       {_number_sql("event_type")} AS kind, {_number_sql(_ODD_SQL)} AS odd FROM events"""))
def q_coerce_numeric(spark, d):
    odd = F.get(F.array(*(F.lit(x) for x in ODD_NUMBERS)), (F.col("event_id") % len(ODD_NUMBERS)).cast("int"))
    ev = testdata.load(spark, d, "events").select(
        F.col("event_id").alias("seq"), F.col("value").cast("string").alias("value"),
        F.get_json_object("props", "$.k").alias("k"), F.col("event_type").alias("kind"), odd.alias("odd"))
    return ev.transform(cleaning.coerce_numeric, ("value", "k", "kind", "odd"))


@query("derive_kinematics", sql("SELECT seq, altitude, speed, heading FROM positions", "positions"))
def q_derive_kinematics(spark, d):
    raw = positions(spark, d).select(
        "seq", F.col("altitude").cast("string").alias("baro_altitude"),
        F.col("speed").cast("string").alias("velocity"), F.col("heading").cast("string").alias("true_track"))
    return raw.transform(cleaning.derive_kinematics).select("seq", "altitude", "speed", "heading")


@query("require_keys", sql("""
SELECT seq, icao24, latitude, longitude FROM positions
WHERE icao24 IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL""", "positions"))
def q_require_keys(spark, d):
    return (positions(spark, d).select("seq", "icao24", "latitude", "longitude")
            .transform(cleaning.require_keys))


@query("valid_coordinates", sql("""
SELECT seq, latitude, longitude FROM positions
WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180""", "positions"))
def q_valid_coordinates(spark, d):
    return positions(spark, d).select("seq", "latitude", "longitude").transform(cleaning.valid_coordinates)


@query("parse_timestamps", sql("""
SELECT flight_number,
       CASE WHEN gate LIKE '%7' THEN NULL ELSE scheduled_departure END AS scheduled_departure,
       CASE WHEN gate LIKE '%7' THEN NULL ELSE scheduled_arrival END AS scheduled_arrival,
       NOT (gate LIKE '%7') AS timestamps_valid
FROM flights""", "flights"))
def q_parse_timestamps(spark, d):
    f = flights(spark, d)
    bad = F.col("gate").endswith("7")
    from contrail.functions.timefns import ntz_text
    as_text = f.select(
        "flight_number",
        F.when(bad, F.concat(F.lit("gate "), F.col("gate")))
         .otherwise(ntz_text("scheduled_departure")).alias("scheduled_departure"),
        F.when(bad, F.lit("TBD")).otherwise(ntz_text("scheduled_arrival")).alias("scheduled_arrival"))
    return as_text.transform(cleaning.parse_timestamps)


@query("flight_duration", sql("""
SELECT flight_number, scheduled_departure,
       CAST(epoch_us(scheduled_arrival) - epoch_us(scheduled_departure) AS DOUBLE) / CAST(60000000 AS DOUBLE)
         AS flight_duration_minutes
FROM flights""", "flights"))
def q_flight_duration(spark, d):
    return (flights(spark, d).select("flight_number", "scheduled_departure", "scheduled_arrival")
            .transform(cleaning.flight_duration).drop("scheduled_arrival"))


@query("carrier_prefix", sql("SELECT flight_number, substring(flight_number, 1, 2) AS carrier_code FROM flights",
                             "flights"))
def q_carrier_prefix(spark, d):
    return flights(spark, d).select("flight_number").transform(cleaning.carrier_prefix, out="carrier_code")


@query("harmonize_schema", sql("""
SELECT seq, icao24, CAST(NULL AS VARCHAR) AS callsign, CAST(NULL AS VARCHAR) AS origin_country,
       latitude, longitude, CAST(NULL AS DOUBLE) AS altitude, speed, CAST(NULL AS DOUBLE) AS heading,
       CAST(NULL AS DOUBLE) AS vertical_speed, CAST(NULL AS VARCHAR) AS departure_airport,
       CAST(NULL AS VARCHAR) AS arrival_airport, airline, CAST(NULL AS VARCHAR) AS aircraft_type,
       CAST(NULL AS VARCHAR) AS registration, CAST(NULL AS VARCHAR) AS squawk,
       CAST(NULL AS VARCHAR) AS flight_status, data_source, extraction_time,
       CAST(NULL AS BOOLEAN) AS on_ground
FROM positions""", "positions"))
def q_harmonize_schema(spark, d):
    part = positions(spark, d).select("seq", "icao24", "latitude", "longitude", "speed", "airline",
                                      "data_source", "extraction_time")
    return part.transform(cleaning.harmonize_schema)


@query("normalize_text", sql(f"""
SELECT seq, {clean_sql('callsign')} AS callsign, {clean_sql('origin_country')} AS origin_country,
       {clean_sql('airline')} AS airline, {clean_sql('aircraft_type')} AS aircraft_type
FROM positions""", "positions"))
def q_normalize_text(spark, d):
    return (positions(spark, d).select("seq", "callsign", "origin_country", "airline", "aircraft_type")
            .transform(cleaning.normalize_text))


@query("presence_flags", sql("""
SELECT seq, NOT coalesce(on_ground, false) AS is_airborne,
       latitude IS NOT NULL AND longitude IS NOT NULL AS has_position,
       speed IS NOT NULL AS has_speed, altitude IS NOT NULL AS has_altitude
FROM positions""", "positions"))
def q_presence_flags(spark, d):
    return (positions(spark, d).transform(cleaning.presence_flags)
            .select("seq", "is_airborne", "has_position", "has_speed", "has_altitude"))


def _region_sql():
    from contrail.functions.geo import region_sql
    return region_sql()


@query("classify_region", sql(f"SELECT seq, latitude, longitude, {_region_sql()} AS region FROM positions",
                              "positions"))
def q_classify_region(spark, d):
    return positions(spark, d).select("seq", "latitude", "longitude").transform(cleaning.add_region)


@query("quality_score", sql("SELECT seq, data_quality_score FROM rt", "rt"))
def q_quality_score(spark, d):
    return history(spark, d).select("seq", "data_quality_score")


ALT_BAND_SQL = """CASE WHEN altitude < 10000 THEN 'Low (< 10k ft)'
            WHEN altitude < 20000 THEN 'Medium (10k-20k ft)'
            WHEN altitude < 30000 THEN 'High (20k-30k ft)'
            WHEN altitude < 40000 THEN 'Very High (30k-40k ft)'
            ELSE 'Extreme (> 40k ft)' END"""


@query("altitude_band", sql(f"SELECT seq, altitude, {ALT_BAND_SQL} AS altitude_range FROM positions",
                            "positions"))
def q_altitude_band(spark, d):
    return positions(spark, d).select("seq", "altitude", scoring.altitude_band("altitude").alias("altitude_range"))


@query("quality_tier", sql("""
SELECT seq, data_quality_score,
       CASE WHEN data_quality_score >= 80 THEN 'high' WHEN data_quality_score >= 60 THEN 'medium'
            ELSE 'low' END AS quality_tier
FROM rt""", "rt"))
def q_quality_tier(spark, d):
    return history(spark, d).select("seq", "data_quality_score",
                                    scoring.quality_tier("data_quality_score").alias("quality_tier"))


AIRLINE_PERF_SQL = f"""
SELECT airline, total_flights, on_time_flights, delayed_flights, cancelled_flights,
       {pct_half_up_sql('on_time_flights', 'total_flights')} AS on_time_percentage,
       avg_flight_duration, airports_served,
       CAST(delayed_flights AS DOUBLE) / CAST(total_flights AS DOUBLE) * 100 AS delay_rate,
       CAST(cancelled_flights AS DOUBLE) / CAST(total_flights AS DOUBLE) * 100 AS cancellation_rate
FROM (
  SELECT airline, count(*) AS total_flights,
         count(*) FILTER (WHERE status = 'On Time') AS on_time_flights,
         count(*) FILTER (WHERE status = 'Delayed') AS delayed_flights,
         count(*) FILTER (WHERE status = 'Cancelled') AS cancelled_flights,
         {xavg('flight_duration_minutes')} AS avg_flight_duration,
         count(DISTINCT origin_airport) AS airports_served
  FROM flights GROUP BY airline)"""


@query("on_time_tier", sql(f"""
SELECT airline, on_time_percentage,
       CASE WHEN on_time_percentage > 80 THEN 'good' WHEN on_time_percentage > 60 THEN 'warning'
            ELSE 'error' END AS on_time_tier
FROM ({AIRLINE_PERF_SQL})""", "flights"))
def q_on_time_tier(spark, d):
    return reports.airline_performance(flights(spark, d)).select(
        "airline", "on_time_percentage", scoring.on_time_tier("on_time_percentage").alias("on_time_tier"))


@query("map_feed_defaults", sql("""
SELECT latitude AS lat, longitude AS lon,
       CASE WHEN callsign IS NULL OR callsign = '' THEN 'Unknown' ELSE callsign END AS callsign,
       coalesce(altitude, 0.0) AS altitude, coalesce(speed, 0.0) AS speed,
       CASE WHEN airline IS NULL OR airline = '' THEN 'Unknown' ELSE airline END AS airline,
       CASE WHEN origin_country IS NULL OR origin_country = '' THEN 'Unknown' ELSE origin_country END AS country,
       CASE WHEN region IS NULL OR region = '' THEN 'Unknown' ELSE region END AS region,
       CASE WHEN data_source IS NULL OR data_source = '' THEN 'Unknown' ELSE data_source END AS source
FROM rt""", "rt"))
def q_map_feed_defaults(spark, d):
    return history(spark, d).transform(cleaning.map_feed_defaults)


@query("nan_to_null", sql("""
SELECT seq, CASE WHEN heading % 10 = 3 THEN NULL ELSE speed END AS speed FROM positions""", "positions"))
def q_nan_to_null(spark, d):
    p = positions(spark, d)
    with_nan = p.select("seq", F.when(F.col("heading") % 10 == 3, F.lit(float("nan")))
                        .otherwise(F.col("speed")).alias("speed"))
    return with_nan.transform(cleaning.nan_to_null, ["speed"])


@query("route_key", sql("""
SELECT flight_number, origin_airport || '_' || destination_airport AS route,
       origin_airport || ' -> ' || destination_airport AS route_display FROM flights""", "flights"))
def q_route_key(spark, d):
    return (flights(spark, d).select("flight_number", "origin_airport", "destination_airport")
            .transform(cleaning.route_key).select("flight_number", "route", "route_display"))


# ------------------------------------------------------- §2.7 batch reports

ROUTE_TRAFFIC_SQL = f"""
SELECT origin_airport, destination_airport, count(*) AS flight_count,
       count(DISTINCT airline) AS airline_count, {xavg('flight_duration_minutes')} AS avg_duration_minutes
FROM flights GROUP BY origin_airport, destination_airport
ORDER BY flight_count DESC, origin_airport, destination_airport LIMIT 20"""


@query("route_traffic", sql(ROUTE_TRAFFIC_SQL, "flights"))
def q_route_traffic(spark, d):
    return rounded(reports.route_traffic(flights(spark, d)), "avg_duration_minutes")


_REPORT_SQL = sql(f"""
SELECT r.*, count(*) OVER () AS routes_shown, TIMESTAMP '2025-07-12 13:42:58' AS analysis_timestamp,
       (SELECT count(*) FROM (SELECT DISTINCT origin_airport, destination_airport FROM flights)) AS total_routes
FROM ({ROUTE_TRAFFIC_SQL}) r""", "flights")


def _report_rows(report):
    """The nested report, a row per route."""
    flat = report.select(F.inline("top_routes"), "routes_shown", "total_routes", "analysis_timestamp")
    return rounded(flat, "avg_duration_minutes")


@query("route_traffic_report", _REPORT_SQL)
def q_route_traffic_report(spark, d):
    return _report_rows(reports.route_traffic_report(flights(spark, d), as_of=RUN_TS))


@query("airline_performance", sql(AIRLINE_PERF_SQL, "flights"))
def q_airline_performance(spark, d):
    return rounded(reports.airline_performance(flights(spark, d)), "avg_flight_duration")


@query("best_on_time_airline", sql(f"""
SELECT airline AS best_on_time_airline, on_time_percentage FROM ({AIRLINE_PERF_SQL})
ORDER BY on_time_percentage DESC, total_flights DESC, airline LIMIT 1""", "flights"))
def q_best_on_time_airline(spark, d):
    return reports.best_on_time_airline(flights(spark, d))


@query("busiest_airline", sql("""
SELECT airline AS busiest_airline, count(*) AS total_flights FROM flights GROUP BY airline
ORDER BY total_flights DESC, airline LIMIT 1""", "flights"))
def q_busiest_airline(spark, d):
    return reports.busiest_airline(flights(spark, d))


HOURLY_SQL = f"""
SELECT CAST(hour(scheduled_departure) AS INTEGER) AS departure_hour, count(*) AS flight_count,
       {xavg('flight_duration_minutes')} AS avg_duration, count(DISTINCT airline) AS airlines_operating
FROM flights WHERE scheduled_departure IS NOT NULL GROUP BY 1 ORDER BY 1"""


@query("hourly_patterns", sql(HOURLY_SQL, "flights"))
def q_hourly_patterns(spark, d):
    return rounded(reports.hourly_patterns(flights(spark, d)), "avg_duration")


@query("peak_hour", sql(f"""
SELECT departure_hour AS peak_hour, flight_count FROM ({HOURLY_SQL})
ORDER BY flight_count DESC, departure_hour LIMIT 1""", "flights"))
def q_peak_hour(spark, d):
    return reports.peak_hour(flights(spark, d))


AIRCRAFT_SQL = f"""
SELECT aircraft_type, count(*) AS flight_count, {xavg('flight_duration_minutes')} AS avg_duration,
       count(DISTINCT airline) AS airlines_using
FROM flights GROUP BY aircraft_type ORDER BY flight_count DESC, aircraft_type"""


@query("aircraft_usage", sql(AIRCRAFT_SQL, "flights"))
def q_aircraft_usage(spark, d):
    return rounded(reports.aircraft_usage(flights(spark, d)), "avg_duration")


@query("most_used_aircraft", sql(f"""
SELECT coalesce((SELECT aircraft_type FROM ({AIRCRAFT_SQL}) LIMIT 1), 'N/A') AS most_used_aircraft""",
                                 "flights"))
def q_most_used_aircraft(spark, d):
    return reports.most_used_aircraft(flights(spark, d))


OVERVIEW_SQL = f"""
SELECT count(*) AS total_flights, count(DISTINCT airline) AS total_airlines,
       count(DISTINCT origin_airport) AS origin_airports, count(DISTINCT destination_airport) AS destination_airports,
       count(DISTINCT aircraft_type) AS aircraft_types, {xavg('flight_duration_minutes')} AS avg_flight_duration,
       min(scheduled_departure) AS earliest_flight, max(scheduled_departure) AS latest_flight
FROM flights WHERE scheduled_departure IS NOT NULL"""


@query("schedule_overview", sql(f"""
SELECT total_flights, total_airlines, origin_airports, destination_airports, aircraft_types,
       avg_flight_duration, earliest_flight, latest_flight
FROM ({OVERVIEW_SQL})""", "flights"))
def q_schedule_overview(spark, d):
    return rounded(reports.schedule_overview(flights(spark, d)), "avg_flight_duration")


@query("table_counts", sql("""
SELECT 'realtime' AS table_name, count(*) AS row_count FROM rt
UNION ALL SELECT 'airports', count(*) FROM airports""", "rt", "airports"))
def q_table_counts(spark, d):
    return reports.table_counts({"realtime": history(spark, d), "airports": airports(spark, d)})


@query("executive_summary", sql(f"""
SELECT total_flights AS total_scheduled_flights,
       (SELECT count(*) FROM rt) AS total_realtime_flights,
       (SELECT count(*) FROM airports) AS total_airports_in_system,
       total_airlines AS unique_airlines, origin_airports, destination_airports, aircraft_types,
       coalesce(round_even(avg_flight_duration, 2), 0.0) AS average_flight_duration_minutes,
       coalesce(round_even(avg_flight_duration / 60, 2), 0.0) AS average_flight_duration_hours,
       coalesce(strftime(earliest_flight, '%Y-%m-%d %H:%M:%S'), 'N/A') AS data_coverage_start,
       coalesce(strftime(latest_flight, '%Y-%m-%d %H:%M:%S'), 'N/A') AS data_coverage_end,
       CASE WHEN total_flights > 0 THEN 'Good' ELSE 'No Data' END AS scheduled_flights_completeness,
       CASE WHEN (SELECT count(*) FROM rt) > 0 THEN 'Available' ELSE 'Limited' END AS realtime_data_availability,
       CASE WHEN (SELECT count(*) FROM airports) > 0 THEN 'Complete' ELSE 'Missing' END AS airport_data_coverage,
       'Operational' AS pipeline_status
FROM ({OVERVIEW_SQL})""", "flights", "rt", "airports"))
def q_executive_summary(spark, d):
    return reports.executive_summary(flights(spark, d), history(spark, d), airports(spark, d))


@query("top_n_slice", sql(f"SELECT * FROM ({ROUTE_TRAFFIC_SQL}) ORDER BY flight_count DESC, "
                          "origin_airport, destination_airport LIMIT 5", "flights"))
def q_top_n_slice(spark, d):
    top = rounded(reports.route_traffic(flights(spark, d)), "avg_duration_minutes")
    return reports.top_n_slice(top, 5, F.col("flight_count").desc(), "origin_airport", "destination_airport")


# ------------------------------------------------------- §2.8 data quality

@query("dq_freshness", sql("""
SELECT 'airports' AS table_name, count(*) AS record_count, max(extraction_date) AS latest_date,
       coalesce(max(extraction_date) <> DATE '1998-12-01', false) AS is_stale FROM airports
UNION ALL
SELECT 'scheduled_flights', count(*), max(extraction_date),
       coalesce(max(extraction_date) <> DATE '1998-12-01', false) FROM flights""", "airports", "flights"))
def q_dq_freshness(spark, d):
    return checks.dq_freshness({"airports": airports(spark, d), "scheduled_flights": flights(spark, d)},
                               FRESHNESS_AS_OF)


def _completeness_sql(table, cols):
    counts = ", ".join(f"count({c}) AS {c}" for c in cols)
    unions = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, {c} AS non_null, total_records FROM c_{table}"
        for c in cols)
    return counts, unions


_AP_COUNTS, _AP_UNION = _completeness_sql("airports", checks.AIRPORT_COLUMNS)
_FL_COUNTS, _FL_UNION = _completeness_sql("scheduled_flights", checks.FLIGHT_COLUMNS)


@query("dq_completeness", sql(f"""
SELECT table_name, column_name, non_null, total_records,
       CAST(non_null AS DOUBLE) / nullif(CAST(total_records AS DOUBLE), 0) * 100 AS completeness_pct
FROM ({_AP_UNION} UNION ALL {_FL_UNION})""", "airports", "flights", local=(
    ("c_airports", f"SELECT count(*) AS total_records, {_AP_COUNTS} FROM airports"),
    ("c_scheduled_flights", f"SELECT count(*) AS total_records, {_FL_COUNTS} FROM flights"))))
def q_dq_completeness(spark, d):
    return checks.dq_completeness({
        "airports": (airports(spark, d), checks.AIRPORT_COLUMNS),
        "scheduled_flights": (flights(spark, d), checks.FLIGHT_COLUMNS)})


@query("dq_duplicates", sql("""
SELECT flight_number, count(*) AS count FROM flights GROUP BY flight_number HAVING count(*) > 1
ORDER BY count DESC, flight_number LIMIT 10""", "flights"))
def q_dq_duplicates(spark, d):
    return checks.dq_duplicates(flights(spark, d))


@query("dq_invalid_coordinates", sql("""
SELECT code, latitude, longitude FROM airports
WHERE latitude NOT BETWEEN -90 AND 90 OR longitude NOT BETWEEN -180 AND 180""", "airports"))
def q_dq_invalid_coordinates(spark, d):
    return checks.dq_invalid_coordinates(airports(spark, d))


@query("dq_same_endpoints", sql("""
SELECT flight_number, origin_airport, destination_airport FROM flights
WHERE origin_airport = destination_airport ORDER BY flight_number LIMIT 5""", "flights"))
def q_dq_same_endpoints(spark, d):
    return checks.dq_same_endpoints(flights(spark, d))


@query("dq_airline_counts", sql("""
SELECT airline, count(*) AS flight_count FROM flights GROUP BY airline ORDER BY flight_count DESC, airline""",
                                "flights"))
def q_dq_airline_counts(spark, d):
    return checks.dq_airline_counts(flights(spark, d))


@query("dq_top_routes", sql("""
SELECT origin_airport, destination_airport, count(*) AS route_count FROM flights GROUP BY 1, 2
ORDER BY route_count DESC, origin_airport, destination_airport LIMIT 10""", "flights"))
def q_dq_top_routes(spark, d):
    return checks.dq_top_routes(flights(spark, d))


@query("dq_status_counts", sql("""
SELECT status, count(*) AS status_count FROM flights GROUP BY status ORDER BY status_count DESC, status""",
                               "flights"))
def q_dq_status_counts(spark, d):
    return checks.dq_status_counts(flights(spark, d))


# -------------------------------------------- §2.9 real-time merge and reports

def _source_parts(spark, d):
    """The position feed split by source, each missing a different column,
    as three extracts would deliver them."""
    p = positions(spark, d)
    return [p.filter(F.col("data_source") == "opensky").drop("airline"),
            p.filter(F.col("data_source") == "aviationstack").drop("on_ground"),
            p.filter(F.col("data_source") == "airlabs").drop("aircraft_type")]


@query("merge_sources", sql("""
SELECT seq, icao24, callsign, origin_country, latitude, longitude, altitude, speed, heading,
       CASE WHEN data_source = 'aviationstack' THEN NULL ELSE on_ground END AS on_ground,
       CASE WHEN data_source = 'opensky' THEN NULL ELSE airline END AS airline,
       CASE WHEN data_source = 'airlabs' THEN NULL ELSE aircraft_type END AS aircraft_type,
       data_source, extraction_time,
       CASE data_source WHEN 'opensky' THEN 0 WHEN 'aviationstack' THEN 1 WHEN 'airlabs' THEN 2 ELSE 3 END
         AS source_rank
FROM positions""", "positions"))
def q_merge_sources(spark, d):
    return merge.merge_sources(_source_parts(spark, d))


@query("dedupe_first", sql(f"SELECT {HISTORY_COLS} FROM snap", "snap"))
def q_dedupe_first(spark, d):
    return snapshot(spark, d)


@query("rank_by_quality", sql("""
SELECT icao24, data_quality_score, extraction_time FROM snap
ORDER BY data_quality_score DESC, extraction_time DESC, icao24""", "snap"))
def q_rank_by_quality(spark, d):
    return merge.rank_by_quality(snapshot(spark, d)).select("icao24", "data_quality_score", "extraction_time")


@query("realtime_summary", sql(f"""
SELECT count(*) AS total_flights,
       count(DISTINCT origin_country) + max(CAST(origin_country IS NULL AS INTEGER)) AS countries,
       count(DISTINCT airline) AS airlines, count(DISTINCT aircraft_type) AS aircraft_types,
       {r6('avg(data_quality_score)')} AS avg_quality_score,
       count(*) FILTER (WHERE data_quality_score >= 80) AS high_quality_flights,
       count(*) FILTER (WHERE has_position) AS with_position,
       count(*) FILTER (WHERE has_speed) AS with_speed,
       count(*) FILTER (WHERE has_altitude) AS with_altitude,
       (SELECT string_agg(data_source || '=' || n, ',' ORDER BY data_source)
        FROM (SELECT data_source, count(*) AS n FROM snap GROUP BY 1)) AS by_source,
       (SELECT string_agg(region || '=' || n, ',' ORDER BY region)
        FROM (SELECT region, count(*) AS n FROM snap GROUP BY 1)) AS by_region
FROM snap""", "snap"))
def q_realtime_summary(spark, d):
    out = rounded(realtime.realtime_summary(snapshot(spark, d)), "avg_quality_score")
    return out.withColumns({c: _map_text(c) for c in ("by_source", "by_region")})


def _map_text(c: str):
    """A map as sorted key=value text, which both engines write alike."""
    entries = F.array_sort(F.map_entries(c))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ",")


@query("rt_global_overview", sql("""
SELECT count(*) AS total_flights,
       count(DISTINCT origin_country) + max(CAST(origin_country IS NULL AS INTEGER)) AS countries_active,
       count(DISTINCT airline) + max(CAST(airline IS NULL AS INTEGER)) AS airlines_active,
       count(*) FILTER (WHERE data_source = 'opensky') AS flights_opensky,
       count(*) FILTER (WHERE data_source = 'aviationstack') AS flights_aviationstack,
       count(*) FILTER (WHERE data_source = 'airlabs') AS flights_airlabs
FROM snap""", "snap"))
def q_rt_global_overview(spark, d):
    return realtime.rt_global_overview(snapshot(spark, d))


@query("rt_region_distribution", sql("""
SELECT region, count(*) AS flight_count FROM snap WHERE region IS NOT NULL GROUP BY region
ORDER BY flight_count DESC, region""", "snap"))
def q_rt_region_distribution(spark, d):
    return realtime.rt_region_distribution(snapshot(spark, d))


@query("rt_altitude_stats", sql(f"""
SELECT {xavg('altitude')} AS avg_altitude, max(altitude) AS max_altitude,
       count(*) FILTER (WHERE altitude > 30000) AS flights_above_30k FROM snap""", "snap"))
def q_rt_altitude_stats(spark, d):
    return rounded(realtime.rt_altitude_stats(snapshot(spark, d)), "avg_altitude")


@query("rt_speed_stats", sql(f"""
SELECT {r6('avg(speed)')} AS avg_speed, max(speed) AS max_speed,
       count(*) FILTER (WHERE speed > 343) AS supersonic_flights FROM snap""", "snap"))
def q_rt_speed_stats(spark, d):
    return rounded(realtime.rt_speed_stats(snapshot(spark, d)), "avg_speed")


@query("rt_quality_stats", sql(f"""
SELECT {r6('avg(data_quality_score)')} AS avg_quality_score,
       {r6("CAST(count(*) FILTER (WHERE data_quality_score >= 80) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE)")}
         AS high_quality_percentage
FROM snap""", "snap"))
def q_rt_quality_stats(spark, d):
    return rounded(realtime.rt_quality_stats(snapshot(spark, d)), "avg_quality_score",
                   "high_quality_percentage")


@query("rt_top_airlines", sql("""
SELECT airline, count(*) AS flight_count FROM snap WHERE airline IS NOT NULL GROUP BY airline
ORDER BY flight_count DESC, airline LIMIT 10""", "snap"))
def q_rt_top_airlines(spark, d):
    return realtime.rt_top_airlines(snapshot(spark, d))


@query("rt_top_countries", sql("""
SELECT origin_country, count(*) AS flight_count FROM snap WHERE origin_country IS NOT NULL
GROUP BY origin_country ORDER BY flight_count DESC, origin_country LIMIT 10""", "snap"))
def q_rt_top_countries(spark, d):
    return realtime.rt_top_countries(snapshot(spark, d))


@query("source_extract_stats", sql("""
SELECT data_source, count(*) AS flights,
       count(DISTINCT origin_country) + max(CAST(origin_country IS NULL AS INTEGER)) AS countries
FROM positions
WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND (data_source <> 'opensky' OR icao24 IS NOT NULL)
  AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
GROUP BY data_source""", "positions"))
def q_source_extract_stats(spark, d):
    return realtime.source_extract_stats(positions(spark, d))


@query("source_last_update", sql(f"""
SELECT data_source, count(*) AS flights, {r6('avg(data_quality_score)')} AS avg_quality,
       max(extraction_time) AS last_update FROM live GROUP BY data_source""", "live"))
def q_source_last_update(spark, d):
    return rounded(realtime.source_last_update(warehouse.realtime_latest(spark, d)), "avg_quality")


@query("latest_flights", sql("""
SELECT callsign, origin_country, region, data_source, extraction_time FROM live
ORDER BY extraction_time DESC, seq DESC LIMIT 10""", "live"))
def q_latest_flights(spark, d):
    return realtime.latest_flights(warehouse.realtime_latest(spark, d))


@query("load_metadata", sql(f"""
SELECT 'realtime_global_flights' AS table_name, count(*) AS record_count,
       TIMESTAMP '2025-07-12 13:42:58' AS last_updated, {r6('avg(data_quality_score)')} AS data_quality_avg,
       (SELECT string_agg(data_source || '=' || n, ',' ORDER BY data_source)
        FROM (SELECT data_source, count(*) AS n FROM snap GROUP BY 1)) AS data_sources
FROM snap""", "snap"))
def q_load_metadata(spark, d):
    """The audit row of a load, appended to its lasting table and read back."""
    from contrail.sources import sinks
    meta = realtime.load_metadata(snapshot(spark, d), run_ts=RUN_TS)
    path = _scratch(spark, "table-load-metadata")
    sinks.append_metadata(meta, path)
    return rounded(spark.read.schema(meta.schema).parquet(path), "data_quality_avg").withColumn(
        "data_sources", _map_text("data_sources"))


# ------------------------------------------------------------- §2.10 live views

AS_OF_SQL = "(SELECT max(extraction_time) FROM live)"


def _live(spark, d):
    """The live table (one row per aircraft and snapshot) and its latest time."""
    return warehouse.realtime_latest(spark, d), warehouse.as_of(spark, d)


def _trail(minutes: int) -> str:
    return f"extraction_time >= {AS_OF_SQL} - INTERVAL {minutes} MINUTE"


@query("live_flights", sql(f"""
SELECT {', '.join(live.LIVE_COLUMNS)} FROM live
WHERE {_trail(60)} AND latitude IS NOT NULL AND longitude IS NOT NULL
ORDER BY extraction_time DESC, seq DESC LIMIT 1000""", "live"))
def q_live_flights(spark, d):
    hist, as_of = _live(spark, d)
    return live.live_flights(hist, as_of)


@query("regional_stats", sql(f"""
SELECT region, count(*) AS flight_count, {xavg('altitude')} AS avg_altitude,
       {r6('avg(speed)')} AS avg_speed, {r6('avg(data_quality_score)')} AS avg_quality,
       count(DISTINCT origin_country) AS countries, count(DISTINCT airline) AS airlines
FROM live WHERE {_trail(60)} GROUP BY region ORDER BY flight_count DESC, region""", "live"))
def q_regional_stats(spark, d):
    hist, as_of = _live(spark, d)
    return rounded(live.regional_stats(hist, as_of), "avg_altitude", "avg_speed", "avg_quality")


@query("flight_map", sql(f"""
SELECT latitude AS lat, longitude AS lon,
       CASE WHEN callsign IS NULL OR callsign = '' THEN 'Unknown' ELSE callsign END AS callsign,
       coalesce(altitude, 0.0) AS altitude, coalesce(speed, 0.0) AS speed,
       CASE WHEN airline IS NULL OR airline = '' THEN 'Unknown' ELSE airline END AS airline,
       CASE WHEN origin_country IS NULL OR origin_country = '' THEN 'Unknown' ELSE origin_country END AS country,
       CASE WHEN region IS NULL OR region = '' THEN 'Unknown' ELSE region END AS region,
       CASE WHEN data_source IS NULL OR data_source = '' THEN 'Unknown' ELSE data_source END AS source
FROM (SELECT * FROM live WHERE {_trail(30)} AND latitude IS NOT NULL AND longitude IS NOT NULL
        AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
      ORDER BY extraction_time DESC, seq DESC LIMIT 2000)""", "live"))
def q_flight_map(spark, d):
    hist, as_of = _live(spark, d)
    return live.flight_map(hist, as_of)


@query("source_quality", sql(f"""
SELECT data_source, count(*) AS total_flights, {r6('avg(data_quality_score)')} AS avg_quality,
       count(*) FILTER (WHERE has_position) AS with_position, count(*) FILTER (WHERE has_speed) AS with_speed,
       count(*) FILTER (WHERE has_altitude) AS with_altitude,
       count(*) FILTER (WHERE data_quality_score >= 80) AS high_quality
FROM live WHERE {_trail(60)} GROUP BY data_source ORDER BY total_flights DESC, data_source""", "live"))
def q_source_quality(spark, d):
    hist, as_of = _live(spark, d)
    return rounded(live.source_quality(hist, as_of), "avg_quality")


@query("live_metrics", sql(f"""
SELECT count(*) AS total_flights, count(DISTINCT origin_country) AS countries,
       count(DISTINCT airline) AS airlines, count(DISTINCT aircraft_type) AS aircraft_types,
       {xavg('altitude')} AS avg_altitude, {r6('avg(speed)')} AS avg_speed, max(speed) AS max_speed,
       {r6('avg(data_quality_score)')} AS avg_quality
FROM live WHERE {_trail(30)}""", "live"))
def q_live_metrics(spark, d):
    hist, as_of = _live(spark, d)
    return rounded(live.live_metrics(hist, as_of), "avg_altitude", "avg_speed", "avg_quality")


_REGIONAL_SQL, _METRICS_SQL = REGISTRY["regional_stats"][1], REGISTRY["live_metrics"][1]


@query("regional_stats_rollup", _REGIONAL_SQL)
def q_regional_stats_rollup(spark, d):
    """The same view from at most four stored 15-minute partials and the rows before the first whole one."""
    hist, as_of = _live(spark, d)
    stats = rollups.regional_stats(warehouse.realtime_rollups(spark, d), hist, as_of)
    return rounded(stats, "avg_altitude", "avg_speed", "avg_quality")


@query("live_metrics_rollup", _METRICS_SQL)
def q_live_metrics_rollup(spark, d):
    hist, as_of = _live(spark, d)
    stats = rollups.live_metrics(warehouse.realtime_rollups(spark, d), hist, as_of)
    return rounded(stats, "avg_altitude", "avg_speed", "avg_quality")


@query("altitude_distribution", sql(f"""
SELECT {ALT_BAND_SQL} AS altitude_range, count(*) AS count FROM live
WHERE {_trail(30)} AND altitude IS NOT NULL GROUP BY 1 ORDER BY count DESC, altitude_range""", "live"))
def q_altitude_distribution(spark, d):
    hist, as_of = _live(spark, d)
    return live.altitude_distribution(hist, as_of)


# ------------------------------------------------- §2.11 features and anomalies

FEATURE_COLS = ", ".join(ml.FEATURE_COLUMNS)


@query("ml_features", sql(f"SELECT {FEATURE_COLS} FROM features", "features"))
def q_ml_features(spark, d):
    return ml.ml_features(flights(spark, d))


@query("feature_summary", sql(f"""
SELECT count(*) AS total_records, {r6('avg(is_delayed)')} AS delay_rate,
       count(DISTINCT airline) AS airlines_count, count(DISTINCT route) AS routes_count,
       '{",".join(ml.FEATURE_COLUMNS)}' AS features FROM features""",
                              "features"))
def q_feature_summary(spark, d):
    summary = rounded(ml.feature_summary(ml.ml_features(flights(spark, d))), "delay_rate")
    return summary.withColumn("features", F.array_join("features", ","))


_ENC = ", ".join(
    f"CAST(dense_rank() OVER (ORDER BY coalesce(CAST({c} AS VARCHAR), 'nan')) - 1 AS INTEGER) AS {c}"
    for c in ml.CATEGORICAL)
_PLAIN = ", ".join(c for c in ml.FEATURE_COLUMNS if c not in ml.CATEGORICAL)


@query("encode_labels", sql(f"SELECT {_PLAIN}, {_ENC} FROM features", "features"))
def q_encode_labels(spark, d):
    return ml.encode_labels(ml.ml_features(flights(spark, d)))


def _recent_sql(lookback_days: int | None) -> str:
    where = ("scheduled_departure IS NOT NULL" if lookback_days is None else
             "scheduled_departure >= CAST((SELECT CAST(max(scheduled_departure) AS DATE) FROM flights) AS TIMESTAMP)"
             f" - INTERVAL {lookback_days} DAY")
    return f"""SELECT flight_number, airline, origin_airport, destination_airport, flight_duration_minutes, status,
       scheduled_departure, CAST(hour(scheduled_departure) AS INTEGER) AS departure_hour
FROM flights WHERE {where}"""


def _duration_sql(lookback):
    return sql(f"""
SELECT 'duration_anomaly' AS type, flight_number, airline, origin_airport || ' -> ' || destination_airport AS route,
       flight_duration_minutes AS actual_duration, {r6('avg_duration')} AS expected_duration,
       {r6('deviation')} AS deviation, CASE WHEN deviation > 3 THEN 'high' ELSE 'medium' END AS severity
FROM (SELECT r.*, s.avg_duration,
             abs(r.flight_duration_minutes - s.avg_duration) / nullif(coalesce(s.std_duration, 1.0), 0.0) AS deviation
      FROM recent r LEFT JOIN (
        SELECT origin_airport, destination_airport, {xavg('flight_duration_minutes')} AS avg_duration,
               stddev_samp(flight_duration_minutes) AS std_duration
        FROM recent GROUP BY 1, 2) s USING (origin_airport, destination_airport))
WHERE deviation > 2""", "flights", local=(("recent", _recent_sql(lookback)),))


def _recent(spark, d, lookback_days: int | None = 7):
    f = flights(spark, d)
    as_of = None
    if lookback_days is not None:
        as_of = f.agg(F.max("scheduled_departure").cast("date")).first()[0]
    return anomalies.recent_flights(f, as_of, lookback_days)


@query("attach_route_stats", sql(f"""
SELECT f.flight_number, f.origin_airport, f.destination_airport, f.flight_duration_minutes,
       s.avg_duration, {r6('s.std_duration')} AS std_duration
FROM flights f LEFT JOIN (
  SELECT origin_airport, destination_airport, {xavg('flight_duration_minutes')} AS avg_duration,
         stddev_samp(flight_duration_minutes) AS std_duration
  FROM flights GROUP BY 1, 2) s USING (origin_airport, destination_airport)""", "flights"))
def q_attach_route_stats(spark, d):
    f = flights(spark, d).select("flight_number", "origin_airport", "destination_airport",
                                 "flight_duration_minutes")
    return rounded(anomalies.attach_route_stats(f), "std_duration")


@query("attach_route_moments", REGISTRY["attach_route_stats"][1])
def q_attach_route_moments(spark, d):
    """Route statistics folded from the stored daily moments, joined to the flights."""
    f = flights(spark, d).select("flight_number", "origin_airport", "destination_airport",
                                 "flight_duration_minutes")
    return rounded(rollups.attach_route_stats(f, warehouse.route_moments(spark, d)), "std_duration")


@query("flag_unusual_hours", sql("""
SELECT flight_number, departure_hour FROM recent WHERE departure_hour IN (
  SELECT departure_hour FROM hc WHERE n < (SELECT quantile_cont(CAST(n AS DOUBLE), 0.1) FROM hc))""",
    "flights", local=(("recent", _recent_sql(None)),
                      ("hc", "SELECT departure_hour, count(*) AS n FROM recent "
                             "WHERE departure_hour IS NOT NULL GROUP BY 1"))))
def q_flag_unusual_hours(spark, d):
    return anomalies.flag_unusual_hours(_recent(spark, d, None)).select("flight_number", "departure_hour")


@query("duration_anomalies", _duration_sql(7))
def q_duration_anomalies(spark, d):
    return rounded(anomalies.duration_anomalies(_recent(spark, d, 7)), "expected_duration", "deviation")


@query("duration_anomalies_moments", _duration_sql(7))
def q_duration_anomalies_moments(spark, d):
    """The recent anomalies with route statistics folded from the window's stored days."""
    f = flights(spark, d)
    as_of = f.agg(F.max("scheduled_departure").cast("date")).first()[0]
    days = warehouse.route_moments(spark, d, since=as_of - _dt.timedelta(days=7))
    found = anomalies.duration_anomalies(anomalies.recent_flights(f, as_of, 7), stats=rollups.route_stats(days))
    return rounded(found, "expected_duration", "deviation")


@query("duration_anomalies_all_dates", _duration_sql(None))
def q_duration_anomalies_all(spark, d):
    return rounded(anomalies.duration_anomalies(_recent(spark, d, None)), "expected_duration", "deviation")


def _scheduling_sql(lookback):
    return sql("""
SELECT 'scheduling_anomaly' AS type, flight_number, airline,
       origin_airport || ' -> ' || destination_airport AS route, departure_hour, 'low' AS severity
FROM recent WHERE departure_hour IN (
  SELECT departure_hour FROM hc WHERE n < (SELECT quantile_cont(CAST(n AS DOUBLE), 0.1) FROM hc))""",
               "flights", local=(("recent", _recent_sql(lookback)),
                                 ("hc", "SELECT departure_hour, count(*) AS n FROM recent "
                                        "WHERE departure_hour IS NOT NULL GROUP BY 1")))


@query("scheduling_anomalies", _scheduling_sql(7))
def q_scheduling_anomalies(spark, d):
    return anomalies.scheduling_anomalies(_recent(spark, d, 7))


@query("scheduling_anomalies_all_dates", _scheduling_sql(None))
def q_scheduling_anomalies_all(spark, d):
    return anomalies.scheduling_anomalies(_recent(spark, d, None))


def _performance_sql(lookback, share):
    return sql(f"""
SELECT 'performance_anomaly' AS type, airline, {r6('delay_rate')} AS delay_rate,
       CASE WHEN delay_rate > 0.5 THEN 'high' ELSE 'medium' END AS severity
FROM (SELECT airline, avg(CAST(status IN ('Delayed', 'Cancelled') AS DOUBLE)) AS delay_rate
      FROM recent GROUP BY airline)
WHERE delay_rate > {share}""", "flights", local=(("recent", _recent_sql(lookback)),))


@query("performance_anomalies", _performance_sql(7, 0.3))
def q_performance_anomalies(spark, d):
    return rounded(anomalies.performance_anomalies(_recent(spark, d, 7)), "delay_rate")


@query("performance_anomalies_share_066", _performance_sql(None, 0.66))
def q_performance_anomalies_066(spark, d):
    return rounded(anomalies.performance_anomalies(_recent(spark, d, None), share=0.66), "delay_rate")


def _all_anomalies_sql(lookback):
    """Union of the three anomaly kinds in the common schema (self-contained WITH subqueries)."""
    return f"""
SELECT 'duration_anomaly' AS type, flight_number, airline, route, actual_duration, expected_duration, deviation,
       CAST(NULL AS INTEGER) AS departure_hour, CAST(NULL AS DOUBLE) AS delay_rate, severity
FROM ({_duration_sql(lookback)})
UNION ALL
SELECT 'scheduling_anomaly', flight_number, airline, route, NULL, NULL, NULL, departure_hour, NULL, severity
FROM ({_scheduling_sql(lookback)})
UNION ALL
SELECT 'performance_anomaly', NULL, airline, NULL, NULL, NULL, NULL, NULL, delay_rate, severity
FROM ({_performance_sql(lookback, 0.3)})"""


@query("anomaly_report", f"""
SELECT t.type, coalesce(c.anomaly_count, 0) AS anomaly_count,
       (SELECT count(*) FROM ({_all_anomalies_sql(7)})) AS total_anomalies
FROM (VALUES ('duration_anomaly', 0), ('scheduling_anomaly', 1), ('performance_anomaly', 2)) t(type, type_rank)
LEFT JOIN (SELECT type, count(*) AS anomaly_count FROM ({_all_anomalies_sql(7)}) GROUP BY type) c
  ON t.type = c.type""")
def q_anomaly_report(spark, d):
    return anomalies.anomaly_report(_recent(spark, d, 7))


@query("anomaly_list", f"""
SELECT type, flight_number, airline, route, actual_duration, expected_duration, deviation, departure_hour,
       delay_rate, severity
FROM ({_all_anomalies_sql(7)})
ORDER BY CASE type WHEN 'duration_anomaly' THEN 0 WHEN 'scheduling_anomaly' THEN 1 ELSE 2 END,
         deviation DESC NULLS LAST, flight_number, airline, route, departure_hour, actual_duration, delay_rate
LIMIT 20""")
def q_anomaly_list(spark, d):
    recent = _recent(spark, d, 7)
    out = anomalies.anomaly_list(recent)
    return rounded(out, "expected_duration", "deviation", "delay_rate")


# ------------------------------------------------------ §2.11 delay classifier

_MODELS: dict = {}


def _features(spark, d):
    return ml.ml_features(flights(spark, d))


def _flights_key(spark, d):
    return (spark.sparkContext.applicationId, d.rstrip("/"),
            warehouse.fingerprint(spark, d, warehouse.SOURCES["scheduled_flights"]))


_SPLITS: dict = {}


def _split(spark, d):
    """The split of the current source files, written once per session."""
    k = _flights_key(spark, d)
    if k not in _SPLITS:
        _SPLITS[k] = ml.stratified_split(_features(spark, d), key=ml.row_key())
    return _SPLITS[k]


def _trained(spark, d):
    """Fit once per session and source files; later keys reuse the fitted model."""
    k = _flights_key(spark, d)
    if k not in _MODELS:
        split = _split(spark, d)
        train, test = (split.filter(F.col("split") == part).drop("split") for part in ("train", "test"))
        _MODELS[k] = (ml.train_delay_model(train), train.count(), test)
    return _MODELS[k]


_ROW_KEY_SQL = ("concat_ws('|', airline, origin_airport, destination_airport, aircraft_type, departure_hour, day_of_week, "
                "CAST(round(flight_duration_minutes * 1000000) AS BIGINT), status, '42')")


@query("stratified_split", sql(f"""
SELECT {FEATURE_COLS}, CASE WHEN _rn <= floor(_n * 0.8 + 0.5) THEN 'train' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY is_delayed ORDER BY md5({_ROW_KEY_SQL})) AS _rn,
             count(*) OVER (PARTITION BY is_delayed) AS _n FROM features)""", "features"))
def q_stratified_split(spark, d):
    return _split(spark, d)


@query("stratified_split_counts", sql("""
SELECT is_delayed, 'train' AS split, CAST(floor(n * 0.8 + 0.5) AS BIGINT) AS n FROM by_label
UNION ALL
SELECT is_delayed, 'test' AS split, n - CAST(floor(n * 0.8 + 0.5) AS BIGINT) AS n FROM by_label""", "features",
    local=(("by_label", "SELECT is_delayed, count(*) AS n FROM features GROUP BY 1"),)))
def q_stratified_split_counts(spark, d):
    return _split(spark, d).groupBy(ml.LABEL, "split").agg(F.count(F.lit(1)).alias("n"))


@query("train_delay_model")
def q_train_delay_model(spark, d):
    model, _n, _test = _trained(spark, d)
    return ml.feature_importance(model)


@query("score_delays")
def q_score_delays(spark, d):
    model, _n, test = _trained(spark, d)
    return ml.score_delays(model, test).select(*ml.FEATURE_COLUMNS, "prediction", "probability")


_ML_DOCUMENTS: dict = {}


def _ml_documents(spark, d):
    """(path, schema) of the saved metrics and anomaly documents of the current source files."""
    from contrail.sources import sinks
    k = _flights_key(spark, d)
    if k not in _ML_DOCUMENTS:
        model, n_train, test = _trained(spark, d)
        frames = (ml.model_metrics(ml.score_delays(model, test), n_train, model),
                  anomalies.anomaly_report(_recent(spark, d, 7)))
        _ML_DOCUMENTS[k] = [(sinks.write_report_json(f, _scratch(spark, "ml-document")), f.schema) for f in frames]
    return _ML_DOCUMENTS[k]


@query("model_metrics")
def q_model_metrics(spark, d):
    from contrail.sources import landing
    return landing.read_report_json(spark, *_ml_documents(spark, d)[0])


@query("save_model")
def q_save_model(spark, d):
    model, _n, _test = _trained(spark, d)
    return ml.feature_importance(ml.DelayModel.load(spark, ml.save_model(model, _scratch(spark, "delay_model"))))


@query("insight_rules")
def q_insight_rules(spark, d):
    from contrail.sources import landing
    return anomalies.insights(*(landing.read_report_json(spark, *doc) for doc in _ml_documents(spark, d)))


_INSIGHT_SQL = "\nUNION ALL\n".join(
    [f"SELECT 'status' AS kind, '{anomalies.PIPELINE_STATUS}' AS message", f"SELECT 'insight', '{anomalies.NO_MODEL}'",
     "SELECT 'insight', 'Found ' || total_anomalies || ' anomalies in recent flight data' FROM "
     f"(SELECT max(total_anomalies) AS total_anomalies FROM ({REGISTRY['anomaly_report'][1]})) WHERE total_anomalies > 0"]
    + [f"SELECT '{kind}', '{message}' FROM ({REGISTRY['anomaly_report'][1]}) WHERE type = '{metric}' AND anomaly_count > {least}"
       for metric, least, kind, message in anomalies.INSIGHT_RULES if metric.endswith("_anomaly")]
    + [f"SELECT 'recommendation', '{x}'" for x in anomalies.GENERAL_RECOMMENDATIONS])


@query("insight_rules_before_training", _INSIGHT_SQL)
def q_insight_rules_before_training(spark, d):
    """The insights when the anomaly document is there and the metrics document is not yet."""
    from contrail.sources import landing, sinks
    report = anomalies.anomaly_report(_recent(spark, d, 7))
    path = sinks.write_report_json(report, _scratch(spark, "ml-document"))
    metrics = landing.read_report_json(spark, _scratch(spark, "never-written"), spark.createDataFrame(
        [], "accuracy double, features_used int, top_feature string").schema)
    return anomalies.insights(metrics, landing.read_report_json(spark, path, report.schema))


@query("model_checks", sql("""
SELECT * FROM (VALUES ('accuracy as recomputed', 1.0), ('importances add up to', 1.0), ('importances after reload differ', 0.0),
  ('predictions that are no label', 0.0), ('probabilities that contradict', 0.0), ('insight follows accuracy', 1.0),
  ('better than always the commoner label or as good', 1.0)) c(name, value)
UNION ALL SELECT 'training samples', sum(floor(n * 0.8 + 0.5)) FROM by_label
UNION ALL SELECT 'test samples', sum(n - floor(n * 0.8 + 0.5)) FROM by_label
UNION ALL SELECT 'delayed test samples', sum(n - floor(n * 0.8 + 0.5)) FROM by_label WHERE is_delayed = 1""", "features",
    local=(("by_label", "SELECT is_delayed, count(*) AS n FROM features GROUP BY 1"),)))
def q_model_checks(spark, d):
    """What must hold of the trained model, its predictions, its saved copy and the insights on it."""
    from pyspark.ml.functions import vector_to_array

    from contrail.sources import landing
    model, _n, test = _trained(spark, d)
    path = _scratch(spark, "predictions")
    ml.score_delays(model, test).select(ml.LABEL, "prediction", vector_to_array("probability").alias("p")).write.parquet(path)
    saved = spark.read.parquet(path)
    right = saved.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("prediction") == F.col(ml.LABEL)).cast("double")).alias("accuracy"),
                      F.sum(ml.LABEL).alias("delayed"),
                      F.count_if(~F.col("prediction").isin(0.0, 1.0)).alias("odd"),
                      F.count_if((F.col("prediction") == 1.0) != (F.col("p")[1] > F.col("p")[0])).alias("contrary")).first()
    metrics = landing.read_report_json(spark, *_ml_documents(spark, d)[0]).first()
    own = {r.feature: r.importance for r in ml.feature_importance(model).collect()}
    back = {r.feature: r.importance for r in q_save_model(spark, d).collect()}
    told = {r.message for r in q_insight_rules(spark, d).collect()}
    common = max(right.delayed, right.n - right.delayed) / right.n
    rows = [("accuracy as recomputed", float(abs(metrics.accuracy - right.accuracy) < 1e-9)),
            ("importances add up to", round(sum(own.values()), 6)), ("importances after reload differ", float(own != back)),
            ("predictions that are no label", float(right.odd)), ("probabilities that contradict", float(right.contrary)),
            ("insight follows accuracy", float((anomalies.INSIGHT_RULES[0][3] in told) == (metrics.accuracy > 0.8))),
            ("better than always the commoner label or as good", float(right.accuracy >= common - 0.02)),
            ("training samples", float(metrics.training_samples)), ("test samples", float(right.n)),
            ("delayed test samples", float(right.delayed))]
    return spark.createDataFrame(rows, "name string, value double")


# ------------------------------------------------------ §2.1 sources (round trips)

def _scratch(spark, name):
    from contrail.session import scratch_path
    return scratch_path(spark, name)


def _epoch_s(c):
    from contrail.functions.timefns import epoch_seconds
    return epoch_seconds(c)


@query("ingest_state_vectors", sql("""
SELECT icao24, callsign, origin_country, t AS time_position, t AS last_contact, longitude, latitude,
       altitude AS baro_altitude, on_ground, speed AS velocity, heading AS true_track,
       CAST(NULL AS DOUBLE) AS vertical_rate, CAST(NULL AS VARCHAR) AS sensors, altitude AS geo_altitude,
       CAST(NULL AS VARCHAR) AS squawk, false AS spi, 0 AS position_source, data_timestamp,
       TIMESTAMP '2025-07-12 13:42:58' AS extraction_time, 'opensky' AS data_source
FROM (SELECT *, CAST(floor(epoch(extraction_time)) AS BIGINT) AS t,
             max(CAST(floor(epoch(extraction_time)) AS BIGINT)) OVER (PARTITION BY seq // 1000) AS data_timestamp
      FROM positions WHERE data_source = 'opensky')
WHERE seq % 10 <> 4""", "positions"))
def q_ingest_state_vectors(spark, d):
    from contrail.sources import landing
    return landing.ingest_state_vectors(spark, _state_vector_feed(spark, d), run_ts=RUN_TS).drop("arrival")


def _state_vector_feed(spark, d):
    from contrail.sources import landing_writers as lw
    p = positions(spark, d).filter(F.col("data_source") == "opensky")
    st = p.select("seq", "icao24", "callsign", "origin_country",
                  _epoch_s("extraction_time").alias("time_position"),
                  _epoch_s("extraction_time").alias("last_contact"), "longitude", "latitude",
                  F.col("altitude").alias("baro_altitude"), "on_ground", F.col("speed").alias("velocity"),
                  F.col("heading").alias("true_track"), F.lit(None).cast("double").alias("vertical_rate"),
                  F.lit(None).cast("string").alias("sensors"), F.col("altitude").alias("geo_altitude"),
                  F.lit(None).cast("string").alias("squawk"), F.lit(False).alias("spi"),
                  F.lit(0).alias("position_source"))
    full = lw.state_vector_json(st)
    # vary the slot count as live feeds do: 18 slots (cut to 17) and 16 slots (dropped)
    state = (F.when(F.col("seq") % 10 == 2, F.regexp_replace("_full", r"\]$", ',"extra"]'))
             .when(F.col("seq") % 10 == 4, F.regexp_replace("_full", r",[^,]*\]$", "]"))
             .otherwise(F.col("_full")))
    docs = st.withColumn("_full", full).withColumn("state_json", state)
    return lw.write_state_vector_snapshots(docs, _scratch(spark, "landing-opensky"))




@query("ingest_nested_live", sql(f"""
SELECT icao24, coalesce(callsign, '') AS callsign, coalesce(origin_country, '') AS origin_country,
       latitude, longitude, altitude, speed, heading, '' AS departure_airport, '' AS arrival_airport,
       coalesce(airline, '') AS airline, coalesce(aircraft_type, '') AS aircraft_type, 'active' AS flight_status,
       'aviationstack' AS data_source, TIMESTAMP '2025-07-12 13:42:58' AS extraction_time,
       {_region_sql()} AS region
FROM positions
WHERE data_source = 'aviationstack' AND seq % 10 <> 5
  AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180""", "positions"))
def q_ingest_nested_live(spark, d):
    from contrail.sources import landing
    return landing.ingest_nested_live(spark, _nested_feed(spark, d), run_ts=RUN_TS).drop("arrival")


def _nested_feed(spark, d):
    from contrail.sources import landing_writers as lw
    p = positions(spark, d).filter(F.col("data_source") == "aviationstack")
    live_obj = F.when(F.col("seq") % 10 == 5, F.lit(None)).otherwise(F.struct(
        F.col("latitude").alias("latitude"), F.col("longitude").alias("longitude"),
        F.col("altitude").alias("altitude"), F.col("speed").alias("speed_horizontal"),
        F.col("heading").alias("direction")))
    rec = p.select("seq",
                   F.struct(F.col("icao24").alias("icao"), F.col("callsign").alias("iata")).alias("flight"),
                   F.struct(F.col("origin_country").alias("country")).alias("departure"),
                   F.struct(F.lit(None).cast("string").alias("iata")).alias("arrival"),
                   F.struct(F.col("airline").alias("iata")).alias("airline"),
                   F.struct(F.col("aircraft_type").alias("iata")).alias("aircraft"),
                   live_obj.alias("live"), F.lit("active").alias("flight_status"))
    return lw.write_documents(rec, _scratch(spark, "landing-aviationstack"), "data")


@query("ingest_flat_live", sql(f"""
SELECT icao24, coalesce(callsign, '') AS callsign, coalesce(origin_country, '') AS origin_country,
       latitude, longitude, altitude, speed, heading, CAST(NULL AS DOUBLE) AS vertical_speed,
       '' AS departure_airport, '' AS arrival_airport, coalesce(airline, '') AS airline,
       coalesce(aircraft_type, '') AS aircraft_type, 'R-' || icao24 AS registration, '' AS squawk,
       'airlabs' AS data_source, TIMESTAMP '2025-07-12 13:42:58' AS extraction_time,
       CAST(floor(epoch(extraction_time)) AS BIGINT) AS updated_timestamp, {_region_sql()} AS region
FROM positions
WHERE data_source = 'airlabs' AND seq % 10 <> 6
  AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180""", "positions"))
def q_ingest_flat_live(spark, d):
    from contrail.sources import landing
    return landing.ingest_flat_live(spark, _flat_feed(spark, d), run_ts=RUN_TS).drop("arrival")


def _flat_feed(spark, d):
    from contrail.sources import landing_writers as lw
    p = positions(spark, d).filter(F.col("data_source") == "airlabs")
    rec = p.select("seq", F.col("icao24").alias("hex"), F.col("callsign").alias("flight_iata"),
                   F.col("origin_country").alias("flag"),
                   F.when(F.col("seq") % 10 == 6, F.lit(None)).otherwise(F.col("latitude")).alias("lat"),
                   F.col("longitude").alias("lng"), F.col("altitude").alias("alt"), "speed",
                   F.col("heading").alias("dir"), F.col("airline").alias("airline_iata"),
                   F.col("aircraft_type").alias("aircraft_icao"),
                   F.concat(F.lit("R-"), F.col("icao24")).alias("reg_number"),
                   _epoch_s("extraction_time").alias("updated"))
    return lw.write_documents(rec, _scratch(spark, "landing-airlabs"), "response")


_FEEDS_SQL = sql("""
SELECT icao24, callsign, origin_country, latitude, longitude, altitude, speed, heading,
       CASE WHEN data_source = 'opensky' THEN '' ELSE airline END AS airline,
       CASE WHEN data_source = 'opensky' THEN '' ELSE aircraft_type END AS aircraft_type,
       data_source, TIMESTAMP '2025-07-12 13:42:58' AS extraction_time, region,
       data_source <> 'opensky' OR is_airborne AS is_airborne, has_position, has_speed, has_altitude,
       data_quality_score
FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY source_rank, seq) AS _rn FROM rt
      WHERE NOT (data_source = 'opensky' AND seq % 10 = 4) AND NOT (data_source = 'aviationstack' AND seq % 10 = 5)
        AND NOT (data_source = 'airlabs' AND seq % 10 = 6))
WHERE _rn = 1""", "rt")
_FEED_COLUMNS = ("icao24", "callsign", "origin_country", "latitude", "longitude", "altitude", "speed", "heading", "airline",
                 "aircraft_type", "data_source", "extraction_time", "region", "is_airborne", "has_position", "has_speed",
                 "has_altitude", "data_quality_score")


@query("ingest_merge_snapshot", _FEEDS_SQL)
def q_ingest_merge_snapshot(spark, d):
    """Three feeds as files -> readers -> extract rules -> merge -> one scored row per aircraft."""
    from contrail.sources import landing
    states = landing.ingest_state_vectors(spark, _state_vector_feed(spark, d), run_ts=RUN_TS)
    feeds = [landing.extract_state_vectors(states),
             landing.ingest_nested_live(spark, _nested_feed(spark, d), run_ts=RUN_TS),
             landing.ingest_flat_live(spark, _flat_feed(spark, d), run_ts=RUN_TS)]
    return realtime.snapshot_of_feeds(feeds).select(*_FEED_COLUMNS)


@query("stream_feeds", _FEEDS_SQL)
def q_stream_feeds(spark, d):
    """The same three feeds as streams of raw documents, several batches each, into the keyed snapshot table."""
    from contrail.streaming import feeds
    paths = {"opensky": _state_vector_feed(spark, d), "aviationstack": _nested_feed(spark, d),
             "airlabs": _flat_feed(spark, d)}
    base = _scratch(spark, "stream-feeds")
    feeds.stream_feeds(spark, paths, base, _scratch(spark, "ckpt-feeds"), run_ts=RUN_TS, max_files_per_trigger=2)
    return feeds.snapshot_table(spark, base).select(*_FEED_COLUMNS)


def _csv_schema():
    from pyspark.sql import types as T
    return T.StructType([T.StructField(c, T.StringType()) for c in (
        "flight_number", "airline", "origin_airport", "destination_airport", "scheduled_departure",
        "scheduled_arrival", "aircraft_type", "status", "gate", "note")])


@query("read_csv_lenient", sql("""
SELECT flight_number, airline, origin_airport, destination_airport,
       strftime(scheduled_departure, '%Y-%m-%d %H:%M:%S.%f') AS scheduled_departure,
       strftime(scheduled_arrival, '%Y-%m-%d %H:%M:%S.%f') AS scheduled_arrival, aircraft_type, status, gate,
       CASE WHEN gate LIKE '%3' THEN NULL ELSE status || ', ' || aircraft_type END AS note
FROM flights WHERE gate NOT LIKE '%7'""", "flights"))
def q_read_csv_lenient(spark, d):
    from contrail.sources import landing, landing_writers as lw
    f = flights(spark, d)
    from contrail.functions.timefns import ntz_text
    base = [F.col("flight_number"), F.col("airline"), F.col("origin_airport"), F.col("destination_airport"),
            ntz_text("scheduled_departure"), ntz_text("scheduled_arrival"),
            F.col("aircraft_type"), F.col("status"), F.col("gate")]
    note = F.concat(F.col("status"), F.lit(", "), F.col("aircraft_type"))
    # a surplus field may also be empty
    line = (F.when(F.col("gate").endswith("17"), F.concat(lw.csv_line(*base, note), F.lit(",")))
            .when(F.col("gate").endswith("7"), lw.csv_line(*base, note, F.lit("surplus")))
            .when(F.col("gate").endswith("3"), lw.csv_line(*base))
            .otherwise(lw.csv_line(*base, note)))
    path = _scratch(spark, "landing-schedule-csv")
    f.select(line.alias("value")).write.text(path)
    return landing.read_csv_lenient(spark, path, _csv_schema())


@query("read_or_empty", sql(f"SELECT {POSITION_COLS} FROM positions", "positions"))
def q_read_or_empty(spark, d):
    from contrail.sources import landing
    p = positions(spark, d)
    path = _scratch(spark, "stage-positions")
    p.write.parquet(path)
    present = landing.read_or_empty(spark, path, p.schema)
    missing = landing.read_or_empty(spark, path + "-never-written", p.schema)
    return present.unionByName(missing)


@query("airport_dimension", sql("""
SELECT code, name, city, country, latitude, longitude, DATE '2025-07-13' AS extraction_date FROM airports""",
                                "airports"))
def q_airport_dimension(spark, d):
    from contrail.sources import landing
    path = _scratch(spark, "landing-airports")
    airports(spark, d).drop("extraction_date").write.option("header", True).csv(path)
    return landing.airport_dimension(spark, path, _dt.date(2025, 7, 13))


@query("read_report_json", sql(f"""
SELECT origin_airport, destination_airport, flight_count, airline_count, avg_duration_minutes
FROM ({ROUTE_TRAFFIC_SQL})""", "flights"))
def q_read_report_json(spark, d):
    from contrail.sources import landing, sinks
    report = reports.route_traffic_report(flights(spark, d), as_of=RUN_TS)
    path = sinks.write_report_json(report, _scratch(spark, "report-airport-traffic"))
    back = landing.read_report_json(spark, path, report.schema)
    out = back.select(F.explode("top_routes").alias("r")).select("r.*")
    return rounded(out, "avg_duration_minutes")


# ------------------------------------------------------ §2.16 the batch load end to end

_LOADED: dict = {}
#: Lines of one file of an extract.
EXTRACT_LINES = 1 << 19


def _write_extracts(spark, d):
    """Three CSV extracts with faulty lines: long rows (some with empty surplus), text for numbers, bad times."""
    from contrail.functions.timefns import ntz_text
    from contrail.sources import landing_writers as lw
    p = positions(spark, d)
    latitude = F.when(F.col("seq") % 13 == 5, "n/a").when(F.col("seq") % 13 == 6, "").otherwise(F.col("latitude").cast("string"))
    base = lw.csv_line(*(F.col(c) for c in ("icao24", "callsign", "origin_country")), latitude,
                       *(F.col(c) for c in ("longitude", "altitude", "speed", "heading")))
    f = flights(spark, d)
    flight = [F.col(c) for c in ("flight_number", "airline", "origin_airport", "destination_airport")]
    rest = [ntz_text("scheduled_arrival"), F.concat("aircraft_type", F.lit(", new")), F.col("status"), F.col("gate")]
    times = F.when(F.col("gate").endswith("9"), "soon").otherwise(ntz_text("scheduled_departure"))
    flown = lw.csv_line(*flight, times, *rest)
    a = airports(spark, d)
    place = lw.csv_line(*(F.col(c) for c in ("code", "name", "city", "country", "latitude", "longitude")))
    lines = {"realtime_flights": p.select(F.when(F.col("seq") % 11 == 3, F.concat(base, F.lit(","))).otherwise(base).alias("value")),
             "scheduled_flights": f.select(F.when(F.col("gate").endswith("7"), F.concat(flown, F.lit(',"a, b"'))).otherwise(flown)
                                           .alias("value")),
             "airports": a.select(F.when(F.col("code").endswith("3"), F.concat(place, F.lit(",x,,"))).otherwise(place).alias("value"))}
    paths = {t: _scratch(spark, f"extract-{t}") for t in lines}
    for t, df in lines.items():
        # A gzip file is read by one task, so each has a bounded number of lines.
        df.write.option("compression", "gzip").option("maxRecordsPerFile", EXTRACT_LINES).text(paths[t])
    return paths


def _batch_load(spark, d):
    """(reject and row counts, table name -> catalog name) of the batch load, run once per session."""
    from contrail.sources import batch_load
    k = (spark.sparkContext.applicationId, d, warehouse.fingerprint(spark, d, ("events", "lineitem", "supplier")))
    if k not in _LOADED:
        suffix = _scratch(spark, "t").rsplit("-", 1)[1]
        names = {t: f"{t}_{suffix}" for t in batch_load.extracts()}
        counts = batch_load.load_batch(spark, _write_extracts(spark, d), _scratch(spark, "batch-load"), names).collect()
        _LOADED[k] = counts, names
    return _LOADED[k]


_API_SQL = """SELECT * REPLACE (CASE WHEN seq % 13 IN (5, 6) THEN NULL ELSE latitude END AS latitude) FROM positions"""


@query("batch_load_realtime", sql("""
SELECT icao24, callsign, origin_country, latitude, longitude, altitude, speed, heading, 'api' AS data_source,
       'real_time' AS flight_type FROM api
WHERE seq % 11 <> 3 AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180""", "positions",
                                  local=(("api", _API_SQL),)))
def q_batch_load_realtime(spark, d):
    return spark.table(_batch_load(spark, d)[1]["realtime_flights"])


@query("batch_load_scheduled", sql("""
SELECT flight_number, airline, origin_airport, destination_airport, scheduled_departure, scheduled_arrival,
       aircraft_type || ', new' AS aircraft_type, status, gate, 'schedule' AS data_source, 'scheduled' AS flight_type,
       CAST(epoch_us(scheduled_arrival) - epoch_us(scheduled_departure) AS DOUBLE) / 60000000.0 AS flight_duration_minutes
FROM flights WHERE gate NOT LIKE '%7' AND gate NOT LIKE '%9'""", "flights"))
def q_batch_load_scheduled(spark, d):
    return spark.table(_batch_load(spark, d)[1]["scheduled_flights"])


@query("batch_load_airports", sql("""
SELECT code, name, city, country, latitude, longitude FROM airports WHERE code NOT LIKE '%3'""", "airports"))
def q_batch_load_airports(spark, d):
    return spark.table(_batch_load(spark, d)[1]["airports"])


@query("batch_load_rejects", sql("""
SELECT 'airports' AS table_name, 'long_row' AS rule, count(*) FILTER (code LIKE '%3') AS n FROM airports
UNION ALL SELECT 'airports', 'loaded', count(*) FILTER (code NOT LIKE '%3') FROM airports
UNION ALL SELECT 'scheduled_flights', 'long_row', count(*) FILTER (gate LIKE '%7') FROM flights
UNION ALL SELECT 'scheduled_flights', 'bad_timestamp', count(*) FILTER (gate LIKE '%9') FROM flights
UNION ALL SELECT 'scheduled_flights', 'loaded', count(*) FILTER (gate NOT LIKE '%7' AND gate NOT LIKE '%9') FROM flights
UNION ALL SELECT 'realtime_flights', rule, n FROM (
  SELECT CASE WHEN seq % 11 = 3 THEN 'long_row' WHEN latitude IS NULL OR longitude IS NULL THEN 'no_coordinates'
              WHEN NOT (latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180) THEN 'coordinates_out_of_range'
              ELSE 'loaded' END AS rule, count(*) AS n FROM api GROUP BY 1)""", "positions", "flights", "airports",
                                 local=(("api", _API_SQL),)))
def q_batch_load_rejects(spark, d):
    return spark.createDataFrame(_batch_load(spark, d)[0], "table_name string, rule string, n long")


# ------------------------------------------------------------------ §2.2 sinks

@query("write_csv_export", sql(f"SELECT {FLIGHT_COLS} FROM flights", "flights"))
def q_write_csv_export(spark, d):
    """All 13 columns of the schedule table, exported and read back with their types."""
    from contrail.sources import sinks
    f = flights(spark, d)
    path = _scratch(spark, "export-flights")
    sinks.write_csv_export(f, path)
    return (spark.read.schema(f.schema).option("header", True).option("timestampNTZFormat", sinks.TS_FORMAT)
            .csv(path))


@query("load_replace", sql(f"SELECT {HISTORY_COLS} FROM snap", "snap"))
def q_load_replace(spark, d):
    from contrail.sources import sinks
    name = "rt_snapshot_" + _scratch(spark, "t").rsplit("-", 1)[1]
    status = sinks.load_replace(snapshot(spark, d), name, _scratch(spark, "table-rt-snapshot"))
    sinks.raise_on_failures(status)
    return _read_and_drop(spark, name)


def _read_and_drop(spark, name):
    """The rows a table holds now, read from its files; the name (made up for this run) goes."""
    folder = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]
    df = spark.read.schema(spark.table(name).schema).parquet(folder)
    spark.sql(f"DROP TABLE {name}")
    return df


@query("declare_tables", sql("""
SELECT icao24, callsign, origin_country, latitude, longitude, altitude, speed, heading, vertical_speed,
       departure_airport, arrival_airport, airline, aircraft_type, registration, squawk, flight_status,
       data_source, extraction_time, region, is_airborne, has_position, has_speed, has_altitude,
       data_quality_score FROM snap""", "snap"))
def q_declare_tables(spark, d):
    from contrail.sources import sinks
    suffix = _scratch(spark, "t").rsplit("-", 1)[1]
    rt_name, meta_name = f"realtime_global_flights_{suffix}", f"realtime_flight_metadata_{suffix}"
    sinks.declare_tables(spark, {
        rt_name: (sinks.REALTIME_DDL, _scratch(spark, "table-realtime")),
        meta_name: (sinks.METADATA_DDL, _scratch(spark, "table-metadata"))})
    snap = snapshot(spark, d)
    sinks.insert_replace(snap, rt_name)
    sinks.insert_replace(realtime.load_metadata(snap, run_ts=RUN_TS), meta_name)
    if _read_and_drop(spark, meta_name).first()["record_count"] != snap.count():
        raise RuntimeError("the metadata row does not match the table")
    return _read_and_drop(spark, rt_name).drop(live.DAY)


@query("write_report_json", _REPORT_SQL)
def q_write_report_json(spark, d):
    from contrail.sources import sinks
    report = reports.route_traffic_report(flights(spark, d), as_of=RUN_TS)
    path = sinks.write_report_json(report, _scratch(spark, "report"))
    return _report_rows(spark.read.schema(report.schema).option("timestampNTZFormat", sinks.TS_FORMAT).json(path))


def _documents_sql() -> str:
    rows = [
        ("airport_traffic", "routes", "SELECT least(20, count(*)) FROM (SELECT DISTINCT origin_airport, destination_airport FROM flights)"),
        ("airline_performance", "airlines", "SELECT count(DISTINCT airline) FROM flights"),
        ("flight_patterns", "hours", "SELECT count(DISTINCT hour(scheduled_departure)) FROM flights"),
        ("flight_patterns", "aircraft", "SELECT count(DISTINCT aircraft_type) FROM flights"),
        ("ml_preparation", "summary", "SELECT 1"),
        ("realtime_processing", "summary", "SELECT 1"),
        ("realtime_processing", "sources", "SELECT count(DISTINCT data_source) FROM snap"),
        ("realtime_report", "overview", "SELECT 1"),
        ("realtime_report", "regions", "SELECT count(DISTINCT region) FROM snap"),
        ("realtime_report", "altitude", "SELECT 1"), ("realtime_report", "speed", "SELECT 1"),
        ("realtime_report", "quality", "SELECT 1"),
        ("realtime_report", "top_airlines", "SELECT least(10, count(DISTINCT airline)) FROM snap"),
        ("realtime_report", "top_countries", "SELECT least(10, count(DISTINCT origin_country)) FROM snap"),
    ]
    return "\nUNION ALL\n".join(f"SELECT '{d}' AS document, '{s}' AS section, CAST(({q}) AS BIGINT) AS n_records"
                                for d, s, q in rows)


@query("report_documents", sql(_documents_sql(), "flights", "snap"))
def q_report_documents(spark, d):
    """Every report document written as JSON, read back and counted by section."""
    from contrail.operators import documents as docs
    base = _scratch(spark, "documents")
    back = {}
    for name, sections in {**docs.batch_documents(flights(spark, d)), **docs.realtime_documents(snapshot(spark, d))}.items():
        back[name] = docs.read_document(spark, f"{base}/{name}", docs.write_document(sections, f"{base}/{name}"))
    return docs.record_counts(back)


#: Document, section, query whose SQL gives the section, columns that name a record, numbers of a record.
_REPORT_SECTIONS = (
    ("airport_traffic", "routes", "route_traffic", "origin_airport destination_airport",
     "flight_count airline_count avg_duration_minutes"),
    ("airline_performance", "airlines", "airline_performance", "airline",
     "total_flights on_time_flights delayed_flights cancelled_flights on_time_percentage avg_flight_duration "
     "airports_served delay_rate cancellation_rate"),
    ("flight_patterns", "hours", "hourly_patterns", "departure_hour", "flight_count avg_duration airlines_operating"),
    ("flight_patterns", "aircraft", "aircraft_usage", "aircraft_type", "flight_count avg_duration airlines_using"),
    ("ml_preparation", "summary", "feature_summary", "", "total_records delay_rate airlines_count routes_count"),
    ("executive_summary", "summary", "executive_summary", "",
     "total_scheduled_flights total_realtime_flights total_airports_in_system unique_airlines origin_airports "
     "destination_airports aircraft_types average_flight_duration_minutes average_flight_duration_hours"),
    ("realtime_processing", "summary", "realtime_summary", "",
     "total_flights countries airlines aircraft_types avg_quality_score high_quality_flights with_position with_speed "
     "with_altitude"),
    ("realtime_report", "overview", "rt_global_overview", "",
     "total_flights countries_active airlines_active flights_opensky flights_aviationstack flights_airlabs"),
    ("realtime_report", "regions", "rt_region_distribution", "region", "flight_count"),
    ("realtime_report", "altitude", "rt_altitude_stats", "", "avg_altitude max_altitude flights_above_30k"),
    ("realtime_report", "speed", "rt_speed_stats", "", "avg_speed max_speed supersonic_flights"),
    ("realtime_report", "quality", "rt_quality_stats", "", "avg_quality_score high_quality_percentage"),
    ("realtime_report", "top_airlines", "rt_top_airlines", "airline", "flight_count"),
    ("realtime_report", "top_countries", "rt_top_countries", "origin_country", "flight_count"),
    ("anomalies", "counts", "anomaly_report", "type", "anomaly_count total_anomalies"),
    ("anomalies", "first", "anomaly_list", "type flight_number airline route severity",
     "actual_duration expected_duration deviation departure_hour delay_rate"),
)


def _report_values_sql() -> str:
    parts = []
    for document, section, key, names, numbers in _REPORT_SECTIONS:
        record = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in names.split()) or "''"
        values = ", ".join(f"{r6(f'CAST({c} AS DOUBLE)')} AS {c}" for c in numbers.split())
        parts.append(f"SELECT '{document}' AS document, '{section}' AS section, record, field, value FROM (UNPIVOT "
                     f"(SELECT {record} AS record, {values} FROM ({REGISTRY[key][1]})) ON {', '.join(numbers.split())} "
                     f"INTO NAME field VALUE value)")
    parts.append("SELECT 'realtime_processing', 'sources', data_source, 'flight_count', CAST(flights AS DOUBLE) FROM ("
                 + sql("SELECT data_source, count(*) AS flights FROM snap GROUP BY 1", "snap") + ")")
    return "\nUNION ALL\n".join(parts)


@query("report_values", _report_values_sql())
def q_report_values(spark, d):
    """Every number of every record of all report documents, after their way through JSON."""
    from contrail.operators import documents as docs
    base = _scratch(spark, "documents")
    made = {**docs.batch_documents(flights(spark, d)), **docs.realtime_documents(snapshot(spark, d)),
            **docs.summary_documents(flights(spark, d), history(spark, d), airports(spark, d)),
            **docs.anomaly_documents(_recent(spark, d, 7))}
    back = {name: docs.read_document(spark, f"{base}/{name}", docs.write_document(sections, f"{base}/{name}"))
            for name, sections in made.items()}
    return rounded(docs.record_values(back), "value")


@query("export_all", sql("""
SELECT 'scheduled_flights' AS table_name, count(*) AS rows_exported FROM flights
UNION ALL SELECT 'airports', count(*) FROM airports
UNION ALL SELECT 'realtime_flights', count(*) FROM rt""", "flights", "airports", "rt"))
def q_export_all(spark, d):
    from contrail.sources import sinks
    tables = {"scheduled_flights": flights(spark, d), "airports": airports(spark, d),
              "realtime_flights": history(spark, d)}
    paths = sinks.export_all(tables, _scratch(spark, "export"))
    out = None
    for name, path in paths.items():
        one = (spark.read.option("header", True).csv(path).agg(F.count(F.lit(1)).alias("rows_exported"))
               .select(F.lit(name).alias("table_name"), "rows_exported"))
        out = one if out is None else out.unionByName(one)
    return out


# -------------------------------------------------------------- §2.14 streams

_LANDING: dict = {}


def _landing(spark, d):
    """The position feed as a landing zone of JSON files, written once per session."""
    from contrail.streaming import positions as sp
    k = (spark.sparkContext.applicationId, d, warehouse.fingerprint(spark, d, ("events",)))
    if k not in _LANDING:
        _LANDING[k] = sp.write_landing(positions(spark, d), _scratch(spark, "landing-positions"))
    return _LANDING[k]


_STREAM_SPLITS: dict = {}


def _stream_split(spark, d):
    """(folder, schema) of the position stream, split once per session into accepted rows and rejects."""
    from contrail.streaming import positions as sp
    landed = _landing(spark, d)
    if landed not in _STREAM_SPLITS:
        base = _scratch(spark, "stream-split")
        _STREAM_SPLITS[landed] = base, sp.split_history(spark, landed, base, _scratch(spark, "ckpt-split"))
    return _STREAM_SPLITS[landed]


@query("stream_positions", sql(f"SELECT {HISTORY_COLS} FROM rt", "rt"))
def q_stream_positions(spark, d):
    from contrail.streaming import positions as sp
    sink = _scratch(spark, "stream-history")
    sp.stream_positions(spark, _landing(spark, d), sink, _scratch(spark, "ckpt-history"))
    return spark.read.schema(realtime.history(positions(spark, d)).schema).parquet(sink)


@query("stream_dedupe", sql(f"""
SELECT {HISTORY_COLS}, snapshot_start FROM (
  SELECT *, row_number() OVER (PARTITION BY icao24, snapshot_start ORDER BY source_rank, seq) AS _rn
  FROM (SELECT *, time_bucket(INTERVAL 15 MINUTE, extraction_time) AS snapshot_start FROM rt))
WHERE _rn = 1""", "rt"))
def q_stream_dedupe(spark, d):
    from contrail.streaming import positions as sp
    return sp.stream_dedupe_table(spark, *_stream_split(spark, d), _scratch(spark, "table-dedupe"),
                                  _scratch(spark, "ckpt-dedupe"))


@query("stream_snapshot", sql(f"""
SELECT {HISTORY_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY extraction_time DESC, seq DESC) AS _rn FROM rt)
WHERE _rn = 1""", "rt"))
def q_stream_snapshot(spark, d):
    from contrail.streaming import positions as sp
    base = _scratch(spark, "table-latest")
    from contrail.streaming.upsert import read_table
    sp.stream_snapshot(spark, _landing(spark, d), base, _scratch(spark, "ckpt-latest"))
    return read_table(spark, base, realtime.history(positions(spark, d)).schema)


@query("stream_region_windows", sql(f"""
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, region, count(*) AS flight_count,
       {xavg('altitude')} AS avg_altitude, {r6('avg(speed)')} AS avg_speed,
       {r6('avg(data_quality_score)')} AS avg_quality
FROM (SELECT rt.*, time_bucket(INTERVAL 15 MINUTE, extraction_time) - s.k * INTERVAL 15 MINUTE AS window_start
      FROM rt, (VALUES (0), (1), (2), (3)) s(k))
GROUP BY window_start, region""", "rt"))
def q_stream_region_windows(spark, d):
    from contrail.streaming import positions as sp
    stats = sp.stream_region_windows(spark, *_stream_split(spark, d), _scratch(spark, "table-region-windows"),
                                     _scratch(spark, "ckpt-region-windows"))
    return rounded(stats, "avg_altitude", "avg_speed", "avg_quality")


# The heartbeat that closes the feed comes two hours and the delay of one hour after its newest row.
@query("stream_stale_alerts", sql("""
SELECT data_source, 'stale' AS alert, t + INTERVAL 30 MINUTE AS at, t AS silent_since FROM gaps
WHERE coalesce(next_t, TIMESTAMP '9999-01-01') > t + INTERVAL 30 MINUTE AND newest + INTERVAL 2 HOUR > t + INTERVAL 30 MINUTE
UNION ALL
SELECT data_source, 'cleared', next_t, t FROM gaps WHERE next_t > t + INTERVAL 30 MINUTE""", "rt", local=(("gaps", """
SELECT data_source, extraction_time AS t, max(extraction_time) OVER () AS newest,
       lead(extraction_time) OVER (PARTITION BY data_source ORDER BY extraction_time) AS next_t FROM rt"""),)))
def q_stream_stale_alerts(spark, d):
    from contrail.streaming import alerts, bounded
    base, schema = _stream_split(spark, d)
    out = _scratch(spark, "table-alerts")
    told = alerts.stale_alerts(bounded.accepted(spark, base, schema, 1))
    bounded.run_to_table(told, out, _scratch(spark, "ckpt-alerts"))
    return spark.read.schema(told.schema).parquet(out)


@query("feed_alerts", sql(f"""
SELECT data_source, 'low_quality' AS alert, {r6('avg_quality')} AS value FROM lu WHERE avg_quality < 70
UNION ALL
SELECT data_source, 'stale', {r6(f"CAST(epoch_us({AS_OF_SQL}) - epoch_us(last_update) AS DOUBLE) / 1000000.0")} FROM lu
WHERE last_update < {AS_OF_SQL} - INTERVAL 30 MINUTE""", "live", local=(
    ("lu", "SELECT data_source, avg(data_quality_score) AS avg_quality, max(extraction_time) AS last_update "
           "FROM live GROUP BY data_source"),)))
def q_feed_alerts(spark, d):
    from contrail.streaming import positions as sp
    hist, as_of = _live(spark, d)
    return rounded(sp.feed_alerts(realtime.source_last_update(hist), as_of), "value")
