"""Stored partials that answer reports without reading the rows again.

``period_rollups``  one row per 15-minute period and region: counts, exact
                    sums and HyperLogLog sketches, which add up over any set
                    of periods and regions.
``route_moments``   one row per route and day: count, exact sum, mean and sum
                    of squared deviations, which fold over any set of days.

Both are tables partitioned by month. A day is added, or done again, from that
day's rows alone: its month's partition is replaced, the other days in it as
they are stored.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.numeric import exact_units, mean_of_units
from contrail.functions.timefns import instant_of, ntz_of_instant, ts_literal
from contrail.session import scratch_path
from contrail.sources.landing import path_exists

PERIOD_MINUTES = 15
DAY, MONTH = "rollup_day", "rollup_month"
#: log2 of a sketch's registers: a relative standard error of about 1.6 %, exact for some hundred values.
SKETCH_BITS = 12
_SKETCHED = {"countries": "origin_country", "airlines": "airline", "aircraft_types": "aircraft_type"}


def period_rollups(hist: DataFrame) -> DataFrame:
    """Per period of 15 minutes and region; the averages' sums and counts apart, so they can be added."""
    start = F.window(instant_of("extraction_time"), f"{PERIOD_MINUTES} minutes").start
    out = hist.groupBy(ntz_of_instant(start).alias("period_start"), "region").agg(
        F.count(F.lit(1)).alias("flights"),
        F.sum(exact_units("altitude")).alias("altitude_units"), F.count("altitude").alias("altitudes"),
        F.sum("speed").alias("speed_sum"), F.count("speed").alias("speeds"), F.max("speed").alias("max_speed"),
        F.sum("data_quality_score").alias("quality_sum"), F.count("data_quality_score").alias("qualities"),
        # A sketch passes over '', which counts as a value.
        *(F.hll_sketch_agg(F.concat(F.lit("="), c), F.lit(SKETCH_BITS)).alias(f"{name}_sketch")
          for name, c in _SKETCHED.items()))
    return _dated(out, F.col("period_start").cast("date"))


def _dated(partials: DataFrame, day: Column) -> DataFrame:
    return partials.withColumn(DAY, day).withColumn(MONTH, F.trunc(DAY, "month"))


def add_days(partials: DataFrame, path: str) -> None:
    """Add the partials of whole days to the table, in place of what it has of these days.

    Only the partitions of their months are read and replaced. The new
    partitions are complete in the scratch folder before the old ones go.
    """
    spark = partials.sparkSession
    new = scratch_path(spark, "rollup-days")
    partials.write.parquet(new)
    added = spark.read.schema(partials.schema).parquet(new)
    months = [r[0] for r in added.select(MONTH).distinct().collect()]  # of the days added
    whole = added
    if path_exists(spark, path):
        stored = spark.read.schema(partials.schema).parquet(path).filter(F.col(MONTH).isin(months))
        whole = scratch_path(spark, "rollup-months")
        stored.join(added.select(DAY).distinct(), DAY, "left_anti").unionByName(added).write.parquet(whole)
        whole = spark.read.schema(partials.schema).parquet(whole)
    (whole.repartition(MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(MONTH).parquet(path))


def read_days(spark: SparkSession, path: str, schema: T.StructType, since: _dt.date | None = None) -> DataFrame:
    """The table, from a day on: partitions of earlier months aren't listed."""
    df = spark.read.schema(schema).parquet(path)
    return df if since is None else df.filter(_since(since))


def _since(day: _dt.date) -> Column:
    return (F.col(MONTH) >= F.lit(day.replace(day=1))) & (F.col(DAY) >= F.lit(day))


def _window(rollups: DataFrame, hist: DataFrame, as_of: _dt.datetime, minutes: int) -> DataFrame:
    """Partials of the trailing window: whole periods as stored, the rows before the first whole one rolled up now."""
    begin = as_of - _dt.timedelta(minutes=minutes)
    period = _dt.timedelta(minutes=PERIOD_MINUTES)
    whole = _dt.datetime.min + -(-(begin - _dt.datetime.min) // period) * period
    ts = F.col("extraction_time")
    edge = hist.filter((ts >= ts_literal(begin)) & (ts < ts_literal(whole)))
    if "extraction_day" in hist.columns:
        edge = edge.filter(F.col("extraction_day").between(F.lit(begin.date()), F.lit(whole.date())))
    stored = rollups.filter((F.col("period_start") >= ts_literal(whole)) & _since(whole.date()))
    return stored.unionByName(period_rollups(edge))


def _totals(*distinct: str) -> list[Column]:
    return [F.coalesce(F.sum("flights"), F.lit(0)).alias("n"),
            *(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")), F.lit(0)).alias(c) for c in distinct),
            mean_of_units(F.sum("altitude_units"), F.sum("altitudes")).alias("avg_altitude"),
            F.try_divide(F.sum("speed_sum"), F.sum("speeds")).alias("avg_speed"), F.max("max_speed").alias("max_speed"),
            F.try_divide(F.sum("quality_sum").cast("double"), F.sum("qualities").cast("double")).alias("avg_quality")]


def live_metrics(rollups: DataFrame, hist: DataFrame, as_of: _dt.datetime, minutes: int = 30) -> DataFrame:
    """As ``live.live_metrics``, from at most minutes / 15 stored periods; the distinct counts are estimates."""
    return (_window(rollups, hist, as_of, minutes).agg(*_totals(*_SKETCHED)).withColumnRenamed("n", "total_flights")
            .select("total_flights", *_SKETCHED, "avg_altitude", "avg_speed", "max_speed", "avg_quality"))


def regional_stats(rollups: DataFrame, hist: DataFrame, as_of: _dt.datetime, minutes: int = 60) -> DataFrame:
    """As ``live.regional_stats``, from at most minutes / 15 stored periods; the distinct counts are estimates."""
    out = _window(rollups, hist, as_of, minutes).groupBy("region").agg(*_totals("countries", "airlines"))
    return (out.withColumnRenamed("n", "flight_count").drop("max_speed")
            .select("region", "flight_count", "avg_altitude", "avg_speed", "avg_quality", "countries", "airlines")
            .orderBy(F.col("flight_count").desc(), F.col("region").asc()))


# ---------------------------------------------------------------- route moments

_ROUTE = ("origin_airport", "destination_airport")


def route_moments(flights: DataFrame) -> DataFrame:
    """Per route and departure day: count, exact sum, mean and sum of squared deviations of the duration."""
    x = F.col("flight_duration_minutes")
    daily = (flights.groupBy(*_ROUTE, F.col("scheduled_departure").cast("date").alias("__day"))
             .agg(F.count(x).alias("n"), F.sum(exact_units(x)).alias("units"), F.avg(x).alias("mean"),
                  (F.var_pop(x) * F.count(x)).alias("m2"))
             .filter("n > 0"))
    return _dated(daily, F.col("__day")).drop("__day")


def route_stats(moments: DataFrame) -> DataFrame:
    """Mean and sample std per route, folded over the days at hand (a row for each route and day)."""
    def merge(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + apart * b["n"] / n).alias("mean"),
                        (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"))

    days = F.array_sort(F.collect_list(F.struct(DAY, "n", "mean", "m2")))
    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    folded = moments.groupBy(*_ROUTE).agg(
        mean_of_units(F.sum("units"), F.sum("n")).alias("avg_duration"), F.aggregate(days, nothing, merge).alias("of"))
    return folded.select(*_ROUTE, "avg_duration",
                         F.when(F.col("of.n") > 1, F.sqrt(F.col("of.m2") / (F.col("of.n") - 1))).alias("std_duration"))


def attach_route_stats(flights: DataFrame, moments: DataFrame) -> DataFrame:
    """As ``anomalies.attach_route_stats``, from stored moments instead of the flights themselves."""
    return flights.join(route_stats(moments), list(_ROUTE), "left")
