"""Batch reports over scheduled flights.

Every report is one aggregate (partial aggregation before the shuffle, so a
hot airline or route costs one row per map task). Top-k outputs use
``orderBy().limit()`` which plans as TakeOrderedAndProject: no global sort.
Every ORDER BY carries key columns so ties are deterministic. Averages of
fractional quantities are ``exact_avg`` (6 decimals, independent of the
partitioning).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import scoring, timefns
from contrail.functions.numeric import distinct_count, exact_avg

ON_TIME, DELAYED, CANCELLED = "On Time", "Delayed", "Cancelled"


def route_traffic(flights: DataFrame, n: int | None = 20, approx_distinct: bool = False) -> DataFrame:
    out = (flights.groupBy("origin_airport", "destination_airport")
           .agg(F.count(F.lit(1)).alias("flight_count"),
                distinct_count("airline", approx_distinct).alias("airline_count"),
                exact_avg("flight_duration_minutes").alias("avg_duration_minutes"))
           .orderBy(F.col("flight_count").desc(), "origin_airport", "destination_airport"))
    return out.limit(n) if n else out


def route_traffic_report(flights: DataFrame, n: int = 20, as_of=None) -> DataFrame:
    """One-row nested report: top routes, how many are shown, how many exist."""
    routes = route_traffic(flights, n=None)
    top = route_traffic(flights, n=n)
    shown = top.agg(
        F.sort_array(F.collect_list(F.struct(
            (-F.col("flight_count")).alias("_o"), "origin_airport", "destination_airport",
            "flight_count", "airline_count", "avg_duration_minutes"))).alias("_routes"),
        F.count(F.lit(1)).alias("routes_shown"))
    total = routes.agg(F.count(F.lit(1)).alias("total_routes"))
    ts = timefns.ts_literal(as_of) if as_of is not None else F.current_timestamp().cast("timestamp_ntz")
    return (shown.unionByName(total, allowMissingColumns=True)
            .agg(F.first("_routes", ignorenulls=True).alias("_routes"),
                 F.max("routes_shown").alias("routes_shown"),
                 F.max("total_routes").alias("total_routes"))
            .select(F.transform("_routes", lambda r: r.dropFields("_o")).alias("top_routes"),
                    "routes_shown", "total_routes", ts.alias("analysis_timestamp")))


def airline_performance(flights: DataFrame, approx_distinct: bool = False) -> DataFrame:
    agg = (flights.groupBy("airline")
           .agg(F.count(F.lit(1)).alias("total_flights"),
                F.count_if(F.col("status") == ON_TIME).alias("on_time_flights"),
                F.count_if(F.col("status") == DELAYED).alias("delayed_flights"),
                F.count_if(F.col("status") == CANCELLED).alias("cancelled_flights"),
                exact_avg("flight_duration_minutes").alias("avg_flight_duration"),
                distinct_count("origin_airport", approx_distinct).alias("airports_served")))
    return (agg.select(
        "airline", "total_flights", "on_time_flights", "delayed_flights", "cancelled_flights",
        scoring.pct_half_up("on_time_flights", "total_flights").alias("on_time_percentage"),
        "avg_flight_duration", "airports_served",
        (F.col("delayed_flights") / F.col("total_flights") * 100).alias("delay_rate"),
        (F.col("cancelled_flights") / F.col("total_flights") * 100).alias("cancellation_rate"))
        .orderBy(F.col("total_flights").desc(), "airline"))


def best_on_time_airline(flights: DataFrame) -> DataFrame:
    """Max on-time share; a tie goes to the busier airline, then the name."""
    perf = airline_performance(flights)
    return (perf.orderBy(F.col("on_time_percentage").desc(), F.col("total_flights").desc(), "airline")
            .limit(1).select(F.col("airline").alias("best_on_time_airline"), "on_time_percentage"))


def busiest_airline(flights: DataFrame) -> DataFrame:
    per = flights.groupBy("airline").agg(F.count(F.lit(1)).alias("total_flights"))
    return (per.orderBy(F.col("total_flights").desc(), "airline").limit(1)
            .select(F.col("airline").alias("busiest_airline"), "total_flights"))


def hourly_patterns(flights: DataFrame, approx_distinct: bool = False) -> DataFrame:
    return (flights.filter(F.col("scheduled_departure").isNotNull())
            .groupBy(timefns.departure_hour("scheduled_departure").alias("departure_hour"))
            .agg(F.count(F.lit(1)).alias("flight_count"),
                 exact_avg("flight_duration_minutes").alias("avg_duration"),
                 distinct_count("airline", approx_distinct).alias("airlines_operating"))
            .orderBy("departure_hour"))


def peak_hour(flights: DataFrame) -> DataFrame:
    """Hour with the most departures; earliest hour on a tie."""
    return (hourly_patterns(flights).orderBy(F.col("flight_count").desc(), "departure_hour")
            .limit(1).select(F.col("departure_hour").alias("peak_hour"), "flight_count"))


def aircraft_usage(flights: DataFrame, approx_distinct: bool = False) -> DataFrame:
    return (flights.groupBy("aircraft_type")
            .agg(F.count(F.lit(1)).alias("flight_count"),
                 exact_avg("flight_duration_minutes").alias("avg_duration"),
                 distinct_count("airline", approx_distinct).alias("airlines_using"))
            .orderBy(F.col("flight_count").desc(), "aircraft_type"))


def most_used_aircraft(flights: DataFrame) -> DataFrame:
    """First row of ``aircraft_usage``, 'N/A' when there are no flights.

    A global aggregate over the top-1 frame always yields exactly one row.
    """
    top = aircraft_usage(flights).limit(1)
    return top.agg(F.coalesce(F.first("aircraft_type"), F.lit("N/A")).alias("most_used_aircraft"))


def schedule_overview(flights: DataFrame, approx_distinct: bool = False) -> DataFrame:
    return (flights.filter(F.col("scheduled_departure").isNotNull())
            .agg(F.count(F.lit(1)).alias("total_flights"),
                 distinct_count("airline", approx_distinct).alias("total_airlines"),
                 distinct_count("origin_airport", approx_distinct).alias("origin_airports"),
                 distinct_count("destination_airport", approx_distinct).alias("destination_airports"),
                 distinct_count("aircraft_type", approx_distinct).alias("aircraft_types"),
                 exact_avg("flight_duration_minutes").alias("avg_flight_duration"),
                 F.min("scheduled_departure").alias("earliest_flight"),
                 F.max("scheduled_departure").alias("latest_flight")))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table (union of one-row aggregates)."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def executive_summary(flights: DataFrame, realtime: DataFrame, airports: DataFrame) -> DataFrame:
    """One row: overview counts, rounded durations, coverage and status labels.

    The three sources are reduced to tagged one-row aggregates, unioned and
    folded into one row by a final aggregate (no join of one-row frames).
    """
    ov = schedule_overview(flights)
    counts = table_counts({"realtime": realtime, "airports": airports})
    folded = (ov.unionByName(counts, allowMissingColumns=True)
              .agg(*[F.max(c).alias(c) for c in ov.columns],
                   F.max(F.when(F.col("table_name") == "realtime", F.col("row_count"))).alias("rt"),
                   F.max(F.when(F.col("table_name") == "airports", F.col("row_count"))).alias("ap")))
    avg = F.col("avg_flight_duration")
    fmt = "yyyy-MM-dd HH:mm:ss"
    return folded.select(
        F.col("total_flights").alias("total_scheduled_flights"),
        F.col("rt").alias("total_realtime_flights"),
        F.col("ap").alias("total_airports_in_system"),
        F.col("total_airlines").alias("unique_airlines"),
        "origin_airports", "destination_airports", "aircraft_types",
        F.coalesce(F.bround(avg, 2), F.lit(0.0)).alias("average_flight_duration_minutes"),
        F.coalesce(F.bround(avg / 60, 2), F.lit(0.0)).alias("average_flight_duration_hours"),
        F.coalesce(F.date_format("earliest_flight", fmt), F.lit("N/A")).alias("data_coverage_start"),
        F.coalesce(F.date_format("latest_flight", fmt), F.lit("N/A")).alias("data_coverage_end"),
        F.when(F.col("total_flights") > 0, "Good").otherwise("No Data").alias("scheduled_flights_completeness"),
        F.when(F.col("rt") > 0, "Available").otherwise("Limited").alias("realtime_data_availability"),
        F.when(F.col("ap") > 0, "Complete").otherwise("Missing").alias("airport_data_coverage"),
        F.lit("Operational").alias("pipeline_status"),
    )


def top_n_slice(df: DataFrame, n: int, *order) -> DataFrame:
    """Display slice of a report: its first ``n`` rows in the given order."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)
