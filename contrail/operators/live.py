"""Live views: the queries behind the real-time dashboard endpoints.

Each takes the table of positions (one row per aircraft and snapshot:
``realtime.latest_snapshots`` of the history, or the history itself to count
every position) and an ``as_of`` instant (the reference used the wall clock). With a literal ``as_of`` the trailing-window filter is
pushed into the parquet scan; row groups wholly outside the window are
skipped by their min/max statistics.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import geo, scoring
from contrail.functions.numeric import distinct_count, exact_avg
from contrail.functions.timefns import ts_literal
from contrail.operators import cleaning
from contrail.operators.realtime import HIGH_QUALITY_SCORE

LIVE_COLUMNS = ("icao24", "callsign", "origin_country", "latitude", "longitude", "altitude", "speed",
                "heading", "airline", "aircraft_type", "region", "data_source", "data_quality_score",
                "extraction_time")


#: Partition column of the stored position tables.
DAY = "extraction_day"


def resolve_as_of(hist: DataFrame, ts: str = "extraction_time") -> _dt.datetime:
    """Latest event time in the data: one scalar to the driver."""
    return hist.agg(F.max(ts)).first()[0]


def trailing(hist: DataFrame, as_of, minutes: int, ts: str = "extraction_time") -> DataFrame:
    lo = ts_literal(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    if DAY in hist.columns:  # a table partitioned by day: older days are not even listed
        hist = hist.filter(F.col(DAY) >= lo.cast("date"))
    return hist.filter(F.col(ts) >= lo)


def live_flights(hist: DataFrame, as_of, minutes: int = 60, n: int = 1000) -> DataFrame:
    return (trailing(hist, as_of, minutes)
            .filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
            .orderBy(F.col("extraction_time").desc(), F.col("seq").desc())
            .limit(n)
            .select(*LIVE_COLUMNS))


def regional_stats(hist: DataFrame, as_of, minutes: int = 60, approx_distinct: bool = False) -> DataFrame:
    return (trailing(hist, as_of, minutes).groupBy("region")
            .agg(F.count(F.lit(1)).alias("flight_count"),
                 exact_avg("altitude").alias("avg_altitude"),
                 F.avg("speed").alias("avg_speed"),
                 F.avg("data_quality_score").alias("avg_quality"),
                 distinct_count("origin_country", approx_distinct).alias("countries"),
                 distinct_count("airline", approx_distinct).alias("airlines"))
            .orderBy(F.col("flight_count").desc(), F.col("region").asc()))


def flight_map(hist: DataFrame, as_of, minutes: int = 30, n: int = 2000) -> DataFrame:
    top = (trailing(hist, as_of, minutes)
           .filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
           .filter(geo.coordinates_valid())
           .orderBy(F.col("extraction_time").desc(), F.col("seq").desc())
           .limit(n))
    return top.transform(cleaning.map_feed_defaults)


def source_quality(hist: DataFrame, as_of, minutes: int = 60) -> DataFrame:
    return (trailing(hist, as_of, minutes).groupBy("data_source")
            .agg(F.count(F.lit(1)).alias("total_flights"),
                 F.avg("data_quality_score").alias("avg_quality"),
                 F.count_if(F.col("has_position")).alias("with_position"),
                 F.count_if(F.col("has_speed")).alias("with_speed"),
                 F.count_if(F.col("has_altitude")).alias("with_altitude"),
                 F.count_if(F.col("data_quality_score") >= HIGH_QUALITY_SCORE).alias("high_quality"))
            .orderBy(F.col("total_flights").desc(), F.col("data_source").asc()))


def live_metrics(hist: DataFrame, as_of, minutes: int = 30, approx_distinct: bool = False) -> DataFrame:
    return trailing(hist, as_of, minutes).agg(
        F.count(F.lit(1)).alias("total_flights"),
        distinct_count("origin_country", approx_distinct).alias("countries"),
        distinct_count("airline", approx_distinct).alias("airlines"),
        distinct_count("aircraft_type", approx_distinct).alias("aircraft_types"),
        exact_avg("altitude").alias("avg_altitude"),
        F.avg("speed").alias("avg_speed"),
        F.max("speed").alias("max_speed"),
        F.avg("data_quality_score").alias("avg_quality"))


def altitude_distribution(hist: DataFrame, as_of, minutes: int = 30) -> DataFrame:
    return (trailing(hist, as_of, minutes).filter(F.col("altitude").isNotNull())
            .groupBy(scoring.altitude_band("altitude").alias("altitude_range"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("altitude_range").asc()))
