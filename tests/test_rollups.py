"""Stored partials: equal to the rows they stand for, added by day, read by day."""

import datetime as dt
import math
import os
import statistics
import tempfile

import pytest
from pyspark.sql import functions as F

from contrail.functions.timefns import ts_literal
from contrail.operators import anomalies, live, realtime, rollups
from contrail.plans import warehouse

from .conftest import SMALL


def _folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/t"


def _files(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns
            for d, _, names in os.walk(path) for n in names if n.startswith("part-")}


@pytest.mark.parametrize("minutes", [15, 30, 37, 60])
def test_views_from_rollups_equal_views_from_rows(spark, minutes):
    hist, as_of = warehouse.realtime_latest(spark, SMALL), warehouse.as_of(spark, SMALL)
    stored = warehouse.realtime_rollups(spark, SMALL)
    for shift in (0, 7, 3000):  # minutes before the newest row: windows that begin inside and at the edge of a period
        at = as_of - dt.timedelta(minutes=shift)
        cut, past = hist.filter(F.col("extraction_time") <= ts_literal(at)), stored.filter(F.col("period_start") <= ts_literal(at))
        if shift:  # the newest period of the past is not whole yet
            past = rollups.period_rollups(cut)
        for got, want in ((rollups.live_metrics(past, cut, at, minutes), live.live_metrics(cut, at, minutes)),
                          (rollups.regional_stats(past, cut, at, minutes), live.regional_stats(cut, at, minutes))):
            rows = [{k: (round(v, 9) if isinstance(v, float) else v) for k, v in r.asDict().items()} for r in got.collect()]
            assert rows == [{k: (round(v, 9) if isinstance(v, float) else v) for k, v in r.asDict().items()}
                            for r in want.select(got.columns).collect()]


def test_at_most_five_partials_of_a_region_are_read(spark):
    hist, as_of = warehouse.realtime_latest(spark, SMALL), warehouse.as_of(spark, SMALL)
    window = rollups._window(warehouse.realtime_rollups(spark, SMALL), hist, as_of, 60)
    assert window.groupBy("region").count().agg(F.max("count")).first()[0] <= 5


def test_distinct_counts_of_many_values(spark):
    rows = spark.range(200_000).select(
        (F.col("id") % 20_000).cast("string").alias("origin_country"), F.lit("A").alias("airline"),
        F.lit(None).cast("string").alias("aircraft_type"), F.lit("x").alias("region"), F.lit(1.0).alias("altitude"),
        F.lit(2.0).alias("speed"), F.lit(50).alias("data_quality_score"),
        (ts_literal("2024-01-01 00:00:00") + F.make_dt_interval(secs=(F.col("id") % 3600))).alias("extraction_time"))
    at = dt.datetime(2024, 1, 1, 1)
    got = rollups.live_metrics(rollups.period_rollups(rows), rows, at, 60).first()
    assert got.total_flights == 200_000 and (got.airlines, got.aircraft_types) == (1, 0)
    assert abs(got.countries / 20_000 - 1) < 0.05, got.countries  # 3 standard errors of 1.6 %


def test_adding_a_day_leaves_other_months_alone(spark):
    flights = warehouse.scheduled_flights(spark, SMALL).filter("scheduled_departure < '1993-01-01'")
    day = F.col("scheduled_departure").cast("date")
    last = flights.agg(F.max(day)).first()[0]
    path = _folder()
    rollups.add_days(rollups.route_moments(flights.filter(day < F.lit(last))), path)
    before = _files(path)
    added = rollups.route_moments(flights.filter(day == F.lit(last)))
    rollups.add_days(added, path)
    after = _files(path)
    assert all(f"{rollups.MONTH}={last.replace(day=1)}" in f for f in before.keys() ^ after.keys())
    rollups.add_days(added, path)  # once more: nothing counts twice
    stored = rollups.read_days(spark, path, added.schema)
    whole = rollups.route_moments(flights)
    assert sorted(map(str, stored.select(whole.columns).collect())) == sorted(map(str, whole.collect()))


def test_folded_moments_equal_the_flights(spark):
    flights = warehouse.scheduled_flights(spark, SMALL).select(
        "flight_number", "origin_airport", "destination_airport", "flight_duration_minutes")
    got, want = (df.select("flight_number", "flight_duration_minutes", "avg_duration", "std_duration").collect() for df in (
        rollups.attach_route_stats(flights, warehouse.route_moments(spark, SMALL)), anomalies.attach_route_stats(flights)))
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=str), sorted(want, key=str), strict=True):
        assert a[:2] == b[:2] and a.avg_duration == b.avg_duration
        assert (a.std_duration is None) == (b.std_duration is None)
        assert a.std_duration is None or math.isclose(a.std_duration, b.std_duration, rel_tol=1e-6)


def test_moments_of_hard_values(spark):
    """Large values that differ by little: sums of squares would lose them."""
    values = [1e9 + k / 8 for k in range(40)]
    rows = spark.createDataFrame([("A", "B", dt.datetime(2024, 1, 1 + k % 9), v) for k, v in enumerate(values)]
                                 + [("A", "C", dt.datetime(2024, 1, 1), 5.0), ("A", "D", dt.datetime(2024, 1, 1), None)],
                                 "origin_airport string, destination_airport string, scheduled_departure timestamp_ntz, "
                                 "flight_duration_minutes double")
    got = {r.destination_airport: r for r in rollups.route_stats(rollups.route_moments(rows)).collect()}
    assert set(got) == {"B", "C"} and got["C"].std_duration is None
    assert got["B"].std_duration == pytest.approx(statistics.stdev(values), rel=1e-6)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_live_views_list_the_days_of_their_window_only(spark):
    hist, as_of = warehouse.realtime_latest(spark, SMALL), warehouse.as_of(spark, SMALL)
    for view in (live.live_flights(hist, as_of), live.regional_stats(hist, as_of), live.live_metrics(hist, as_of)):
        filters = _plan(view).split("PartitionFilters: [")[1].split("]")[0]
        assert f"{live.DAY}" in filters and ">=" in filters
    days = {os.path.basename(os.path.dirname(f)) for f in live.trailing(hist, as_of, 60).inputFiles()}
    assert 0 < len(days) <= hist.select(live.DAY).distinct().count()
    month = _plan(rollups.read_days(spark, *warehouse._BUILT[(id(warehouse.scheduled_flights(spark, SMALL)), "moments")],
                                    since=dt.date(1998, 1, 5)))
    assert rollups.MONTH in month.split("PartitionFilters: [")[1].split("]")[0]


def test_stage_tables_take_no_round_robin_pass(spark):
    day = warehouse.realtime.history(warehouse.testdata.positions(spark, SMALL)).withColumn(
        live.DAY, F.col("extraction_time").cast("date")).hint("rebalance", live.DAY)
    for df in (warehouse.testdata.flights(spark, SMALL).sortWithinPartitions("scheduled_departure"), day):
        assert "RoundRobin" not in _plan(df)
    assert "REBALANCE_PARTITIONS_BY_COL" in _plan(day)


def test_summary_counts_every_source_and_region(spark):
    rows = warehouse.realtime_snapshot(spark, SMALL)
    other = rows.limit(1).withColumn("data_source", F.lit("adsb")).withColumn("region", F.lit("Moon"))
    got = realtime.realtime_summary(rows.unionByName(other)).first()
    assert got.by_source["adsb"] == 1 and got.by_region["Moon"] == 1
    assert sum(got.by_source.values()) == sum(got.by_region.values()) == got.total_flights == rows.count() + 1
