"""Views that map the driver's star-schema tables onto the flight data model.

``flights``   stands for the scheduled-flights table (one row per lineitem).
``positions`` stands for the merged position feeds (one row per event).
``airports``  stands for the airport reference table (one row per supplier).

All three are DataFrames over the parquet files; Catalyst prunes the
columns each report needs and pushes filters into the scans. The expressions
must stay in step with the DuckDB text in ``contrail.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Suppliers that are sent to all tasks; with more they are joined by shuffles.
SENT_SUPPLIERS = 1 << 19


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders x customer x supplier x part x nation (twice).

    Every join into the lineitem stream is a plain equi-join on one key; AQE
    turns the small sides into broadcast joins when their measured size
    allows, and keeps a sort-merge join (with skew splitting) otherwise. The
    suppliers, a count of the files' footers allowing, come last and without
    a shuffle, and names of nations after the shuffles, which carry keys only.
    """
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supp = (load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
            .join(nation.withColumnRenamed("n_name", "origin_airport"),
                  F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", F.col("s_name").alias("airline"), "origin_airport"))
    if load(spark, sf_dir, "supplier").count() <= SENT_SUPPLIERS:
        supp = F.broadcast(supp)
    cust = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = (load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
              .join(cust, F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", "o_orderdate", "c_nationkey"))
    part = load(spark, sf_dir, "part").select("p_partkey", "p_brand")
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    j = (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(part, F.col("l_partkey") == F.col("p_partkey"))
         .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(nation.withColumnRenamed("n_name", "destination_airport"), F.col("c_nationkey") == F.col("n_nationkey")))
    dep = F.expr("timestampadd(MINUTE, (l_orderkey * 7 + l_linenumber * 15) % 1440, o_orderdate)")
    return j.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string"), F.lit("-"),
                 F.col("l_orderkey").cast("string")).alias("flight_number"),
        "airline",
        "origin_airport",
        "destination_airport",
        dep.alias("scheduled_departure"),
        F.expr("timestampadd(MICROSECOND, CAST(round(l_extendedprice * 600000) AS BIGINT), "
               "timestampadd(MINUTE, (l_orderkey * 7 + l_linenumber * 15) % 1440, o_orderdate))"
               ).alias("scheduled_arrival"),
        F.col("p_brand").alias("aircraft_type"),
        F.when(F.col("l_returnflag") == "R", "Delayed")
         .when(F.col("l_returnflag") == "A", "Cancelled")
         .when(F.col("l_linestatus") == "O", "On Time")
         .otherwise("Scheduled").alias("status"),
        F.concat(F.expr("chr(65 + l_linenumber % 4)"),
                 (F.lit(1) + F.col("l_partkey") % 50).cast("string")).alias("gate"),
        F.col("l_shipdate").cast("date").alias("extraction_date"),
        F.lit("schedule").alias("data_source"),
        F.lit("scheduled").alias("flight_type"),
        (F.col("l_extendedprice") / 100).alias("flight_duration_minutes"),
    )


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw position per event (before any cleaning)."""
    ev = load(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    uid = F.col("user_id").cast("string")
    return ev.select(
        F.col("event_id").alias("seq"),
        F.lpad(uid, 6, "0").alias("icao24"),
        F.when(k % 10 == 0, F.lit("None")).when(k % 10 == 1, F.lit("  "))
         .otherwise(F.concat(F.lit(" CS"), uid, F.lit(" "))).alias("callsign"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("C"), (F.col("user_id") % 20).cast("string"))).alias("origin_country"),
        ((F.col("event_id") * 37 % 19000) / 100 - 95).alias("latitude"),
        ((F.col("event_id") * 101 % 37000) / 100 - 185).alias("longitude"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
         .otherwise(F.col("value") * 100).alias("altitude"),
        F.when(k < 5, F.lit(None).cast("double")).otherwise((k * 4).cast("double")).alias("speed"),
        (F.col("event_id") % 360).cast("double").alias("heading"),
        F.when(F.col("event_type") == "signup", F.lit(None).cast("boolean"))
         .otherwise(k < 10).alias("on_ground"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("AL"), (F.col("user_id") % 12).cast("string"))).alias("airline"),
        F.concat(F.lit("T"), (k % 5).cast("string")).alias("aircraft_type"),
        F.when(F.col("event_type") == "view", "opensky")
         .when(F.col("event_type").isin("click", "purchase"), "aviationstack")
         .otherwise("airlabs").alias("data_source"),
        F.col("ts").alias("extraction_time"),
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport reference rows, one per supplier (grows with the scale factor)."""
    nation = load(spark, sf_dir, "nation")
    region = load(spark, sf_dir, "region")
    geo = (nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("country")))
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    return (s.join(geo, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.concat(F.lit("AP"), F.col("s_suppkey").cast("string")).alias("code"),
                F.when(F.col("s_suppkey") % 17 == 0, F.lit(None).cast("string"))
                 .otherwise(F.col("s_name")).alias("name"),
                "city",
                "country",
                F.when(F.col("s_suppkey") % 13 == 0, F.lit(None).cast("double"))
                 .otherwise(F.col("s_acctbal") / 100).alias("latitude"),
                ((F.col("s_suppkey") * 37 % 400) - 200).cast("double").alias("longitude"),
                F.expr("date_add(DATE'1998-11-01', CAST(s_suppkey % 30 AS INT))").alias("extraction_date"),
            ))
