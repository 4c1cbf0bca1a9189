"""DuckDB SQL text for the oracle side of every SQL-checked query.

The CTEs restate ``contrail.sources.testdata`` and the cleaning rules in
plain SQL over the driver's raw tables; ``sql(body, *ctes)`` prefixes the
needed CTEs (with their dependencies) to a query body.
"""

from __future__ import annotations

from contrail.functions.geo import region_sql

_WS = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def clean_sql(c: str, missing=("None", "nan")) -> str:
    s = f"trim(coalesce(CAST({c} AS VARCHAR), ''), {_WS})"
    vals = ", ".join(f"'{m}'" for m in missing)
    return f"(CASE WHEN {s} IN ({vals}) THEN '' ELSE {s} END)"


def r6(expr: str) -> str:
    """Round to 6 decimals the same way on both engines: floor(x*1e6+0.5)/1e6."""
    return f"(floor(({expr}) * 1000000.0 + 0.5) / 1000000.0)"


DEP = "o.o_orderdate + to_minutes(CAST((l.l_orderkey * 7 + l.l_linenumber * 15) % 1440 AS BIGINT))"

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "flights": ((), f"""
SELECT 'S' || CAST(l.l_suppkey AS VARCHAR) || '-' || CAST(l.l_orderkey AS VARCHAR) AS flight_number,
       s.s_name AS airline,
       sn.n_name AS origin_airport,
       cn.n_name AS destination_airport,
       {DEP} AS scheduled_departure,
       {DEP} + to_microseconds(CAST(round(l.l_extendedprice * 600000) AS BIGINT)) AS scheduled_arrival,
       p.p_brand AS aircraft_type,
       CASE WHEN l.l_returnflag = 'R' THEN 'Delayed' WHEN l.l_returnflag = 'A' THEN 'Cancelled'
            WHEN l.l_linestatus = 'O' THEN 'On Time' ELSE 'Scheduled' END AS status,
       chr(CAST(65 + l.l_linenumber % 4 AS INTEGER)) || CAST(1 + l.l_partkey % 50 AS VARCHAR) AS gate,
       CAST(l.l_shipdate AS DATE) AS extraction_date,
       'schedule' AS data_source,
       'scheduled' AS flight_type,
       l.l_extendedprice / 100 AS flight_duration_minutes,
       l.l_orderkey AS _ok, l.l_linenumber AS _ln
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN nation sn ON s.s_nationkey = sn.n_nationkey
JOIN nation cn ON c.c_nationkey = cn.n_nationkey"""),
    "positions": ((), """
SELECT event_id AS seq,
       lpad(CAST(user_id AS VARCHAR), 6, '0') AS icao24,
       CASE WHEN k % 10 = 0 THEN 'None' WHEN k % 10 = 1 THEN '  '
            ELSE ' CS' || CAST(user_id AS VARCHAR) || ' ' END AS callsign,
       CASE WHEN k % 7 = 0 THEN NULL ELSE 'C' || CAST(user_id % 20 AS VARCHAR) END AS origin_country,
       (event_id * 37 % 19000) / 100 - 95 AS latitude,
       (event_id * 101 % 37000) / 100 - 185 AS longitude,
       CASE WHEN event_type = 'error' THEN NULL ELSE value * 100 END AS altitude,
       CASE WHEN k < 5 THEN NULL ELSE CAST(k * 4 AS DOUBLE) END AS speed,
       CAST(event_id % 360 AS DOUBLE) AS heading,
       CASE WHEN event_type = 'signup' THEN NULL ELSE k < 10 END AS on_ground,
       CASE WHEN event_type = 'error' THEN NULL ELSE 'AL' || CAST(user_id % 12 AS VARCHAR) END AS airline,
       'T' || CAST(k % 5 AS VARCHAR) AS aircraft_type,
       CASE WHEN event_type = 'view' THEN 'opensky'
            WHEN event_type IN ('click', 'purchase') THEN 'aviationstack' ELSE 'airlabs' END AS data_source,
       ts AS extraction_time,
       k AS _k, event_type AS _event_type
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"""),
    "airports": ((), """
SELECT 'AP' || CAST(s_suppkey AS VARCHAR) AS code,
       CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE s_name END AS name,
       n_name AS city,
       r_name AS country,
       CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE s_acctbal / 100 END AS latitude,
       CAST((s_suppkey * 37 % 400) - 200 AS DOUBLE) AS longitude,
       DATE '1998-11-01' + CAST(s_suppkey % 30 AS INTEGER) AS extraction_date
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "rt_clean": (("positions",), f"""
SELECT seq, icao24, {clean_sql('callsign')} AS callsign, {clean_sql('origin_country')} AS origin_country,
       latitude, longitude, altitude, speed, heading, CAST(NULL AS DOUBLE) AS vertical_speed,
       '' AS departure_airport, '' AS arrival_airport, {clean_sql('airline')} AS airline,
       {clean_sql('aircraft_type')} AS aircraft_type, '' AS registration,
       CAST(NULL AS VARCHAR) AS squawk, CAST(NULL AS VARCHAR) AS flight_status,
       data_source, extraction_time, on_ground,
       {region_sql()} AS region,
       NOT coalesce(on_ground, false) AS is_airborne,
       latitude IS NOT NULL AND longitude IS NOT NULL AS has_position,
       speed IS NOT NULL AS has_speed,
       altitude IS NOT NULL AS has_altitude,
       CASE data_source WHEN 'opensky' THEN 0 WHEN 'aviationstack' THEN 1 WHEN 'airlabs' THEN 2 ELSE 3 END
         AS source_rank
FROM positions
WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  AND (data_source <> 'opensky' OR icao24 IS NOT NULL)
  AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"""),
    "rt": (("rt_clean",), """
SELECT *,
       CAST((CASE WHEN has_position THEN 40 ELSE 0 END) + (CASE WHEN has_speed THEN 20 ELSE 0 END)
          + (CASE WHEN has_altitude THEN 20 ELSE 0 END)
          + (CASE WHEN coalesce(length(callsign), 0) > 0 THEN 10 ELSE 0 END)
          + (CASE WHEN coalesce(length(origin_country), 0) > 0 THEN 10 ELSE 0 END) AS INTEGER)
         AS data_quality_score
FROM rt_clean"""),
    "snap": (("rt",), """
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY source_rank, seq) AS _rn FROM rt)
WHERE _rn = 1"""),
    "live": (("rt",), """
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY icao24, time_bucket(INTERVAL 15 MINUTE, extraction_time)
                               ORDER BY source_rank, seq) AS _rn FROM rt)
WHERE _rn = 1"""),
    "features": (("flights",), """
SELECT *, origin_airport || '_' || destination_airport AS route,
       CAST(day_of_week IN (0, 6) AS INTEGER) AS is_weekend,
       CAST((departure_hour BETWEEN 7 AND 9) OR (departure_hour BETWEEN 17 AND 19) AS INTEGER) AS is_peak_hour,
       CASE WHEN flight_duration_minutes > 0 AND flight_duration_minutes <= 120 THEN 'short'
            WHEN flight_duration_minutes > 120 AND flight_duration_minutes <= 240 THEN 'medium'
            WHEN flight_duration_minutes > 240 AND flight_duration_minutes <= 480 THEN 'long'
            WHEN flight_duration_minutes > 480 THEN 'very_long' END AS duration_category
FROM (
  SELECT airline, origin_airport, destination_airport, aircraft_type,
         CAST(hour(scheduled_departure) AS INTEGER) AS departure_hour,
         CAST(dayofweek(scheduled_departure) AS INTEGER) AS day_of_week,
         flight_duration_minutes, status,
         CAST(status IN ('Delayed', 'Cancelled') AS INTEGER) AS is_delayed
  FROM flights
  WHERE scheduled_departure IS NOT NULL AND flight_duration_minutes IS NOT NULL)"""),
}


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        for d in CTES[n][0]:
            visit(d)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    return seen


def sql(body: str, *ctes: str, local: tuple[tuple[str, str], ...] = ()) -> str:
    """``WITH <ctes and deps>, <local ctes> <body>``."""
    names = _order(ctes)
    parts = [f"{n} AS ({CTES[n][1]}\n)" for n in names]
    parts += [f"{n} AS ({text}\n)" for n, text in local]
    if not parts:
        return body.strip()
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
