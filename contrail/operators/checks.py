"""Data-quality checks: freshness, completeness, validity, summaries.

Each check is one scan with a global or grouped aggregate; per-column
completeness for a table is a single ``agg`` of ``count(col)`` for all
columns, then an ``unpivot`` to long form (no scan per column).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import geo

AIRPORT_COLUMNS = ("code", "name", "latitude", "longitude")
FLIGHT_COLUMNS = ("flight_number", "origin_airport", "destination_airport", "scheduled_departure")


def dq_freshness(tables: dict[str, DataFrame], as_of_date: _dt.date, date_col: str = "extraction_date") -> DataFrame:
    """Per table: rows, latest date, stale flag (latest known and not as_of)."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("record_count"), F.max(date_col).alias("latest_date"))
        one = one.select(F.lit(name).alias("table_name"), "record_count", "latest_date",
                         F.coalesce(F.col("latest_date") != F.lit(as_of_date), F.lit(False)).alias("is_stale"))
        out = one if out is None else out.unionByName(one)
    return out


def dq_completeness(tables: dict[str, tuple[DataFrame, tuple[str, ...]]]) -> DataFrame:
    """Per table and column: non-null count, total, percent (null on an empty table)."""
    out = None
    for name, (df, cols) in tables.items():
        counts = df.agg(F.count(F.lit(1)).alias("total_records"),
                        *[F.count(c).alias(c) for c in cols])
        long = counts.unpivot("total_records", list(cols), "column_name", "non_null")
        one = long.select(F.lit(name).alias("table_name"), "column_name", "non_null", "total_records",
                          (F.try_divide(F.col("non_null").cast("double"), F.col("total_records").cast("double"))
                           * 100).alias("completeness_pct"))
        out = one if out is None else out.unionByName(one)
    return out


def dq_duplicates(flights: DataFrame, key: str = "flight_number", n: int = 10) -> DataFrame:
    return (flights.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
            .filter(F.col("count") > 1)
            .orderBy(F.col("count").desc(), key).limit(n))


def dq_invalid_coordinates(airports: DataFrame) -> DataFrame:
    """Rows outside the lat/lon ranges; null coordinates are not flagged."""
    return (airports.filter(~geo.coordinates_valid("latitude", "longitude"))
            .select("code", "latitude", "longitude"))


def dq_same_endpoints(flights: DataFrame, n: int = 5) -> DataFrame:
    return (flights.filter(F.col("origin_airport") == F.col("destination_airport"))
            .select("flight_number", "origin_airport", "destination_airport")
            .orderBy("flight_number").limit(n))


def dq_airline_counts(flights: DataFrame) -> DataFrame:
    return (flights.groupBy("airline").agg(F.count(F.lit(1)).alias("flight_count"))
            .orderBy(F.col("flight_count").desc(), "airline"))


def dq_top_routes(flights: DataFrame, n: int = 10) -> DataFrame:
    return (flights.groupBy("origin_airport", "destination_airport")
            .agg(F.count(F.lit(1)).alias("route_count"))
            .orderBy(F.col("route_count").desc(), "origin_airport", "destination_airport").limit(n))


def dq_status_counts(flights: DataFrame) -> DataFrame:
    return (flights.groupBy("status").agg(F.count(F.lit(1)).alias("status_count"))
            .orderBy(F.col("status_count").desc(), "status"))
