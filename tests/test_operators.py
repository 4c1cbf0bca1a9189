"""Table operators on hand-made frames: dedupe, union, anomalies, checks, split."""

import datetime as dt

from pyspark.sql import functions as F

from contrail.operators import anomalies, checks, cleaning, merge, ml, reports


def test_dedupe_first_source_order_and_null_keys(spark):
    df = spark.createDataFrame(
        [("a", "airlabs", 2, 1), ("a", "opensky", 0, 5), ("a", "aviationstack", 1, 2), (None, "airlabs", 2, 3),
         (None, "opensky", 0, 9), ("b", "opensky", 0, 7), ("b", "opensky", 0, 4)],
        "icao24 string, data_source string, source_rank int, seq long")
    out = {r.icao24: (r.data_source, r.seq) for r in merge.dedupe_first(df).collect()}
    assert out == {"a": ("opensky", 5), None: ("opensky", 9), "b": ("opensky", 4)}
    # idempotent
    again = merge.dedupe_first(merge.dedupe_first(df))
    assert again.count() == 3


def test_merge_sources_missing_columns(spark):
    a = spark.createDataFrame([("x", 1.0)], "icao24 string, latitude double").withColumn("data_source", F.lit("opensky"))
    b = spark.createDataFrame([("y", "AL")], "icao24 string, airline string").withColumn("data_source", F.lit("airlabs"))
    out = merge.merge_sources([a, b]).orderBy("icao24").collect()
    assert [(r.icao24, r.latitude, r.airline, r.source_rank) for r in out] == [("x", 1.0, None, 0), ("y", None, "AL", 2)]


def test_harmonize_adds_typed_nulls(spark):
    df = spark.createDataFrame([("x",)], "icao24 string")
    out = cleaning.harmonize_schema(df)
    assert set(cleaning.POSITION_TYPES) <= set(out.columns)
    assert out.schema["latitude"].dataType.simpleString() == "double"


def _flights(spark, rows):
    return spark.createDataFrame(
        rows, "flight_number string, airline string, origin_airport string, destination_airport string, "
              "flight_duration_minutes double, status string, scheduled_departure timestamp_ntz")


def test_duration_anomalies_std_rules(spark):
    t = dt.datetime(2024, 1, 1, 8)
    rows = [("F1", "A", "X", "Y", 100.0, "On Time", t)]                       # one-flight route: std -> 1
    rows += [(f"E{i}", "A", "P", "Q", 50.0, "On Time", t) for i in range(5)]  # std 0: never flagged
    rows += [(f"N{i}", "A", "M", "N", 60.0, "On Time", t) for i in range(9)]
    rows += [("OUT", "A", "M", "N", 600.0, "On Time", t)]                     # far outlier among ten
    recent = anomalies.recent_flights(_flights(spark, rows), None, None)
    out = anomalies.duration_anomalies(recent).collect()
    # with ten flights the largest sample z is (n - 1) / sqrt(n) = 2.85: flagged, medium
    assert [(r.flight_number, r.severity) for r in out] == [("OUT", "medium")]
    assert abs(out[0].deviation - 486 / 29160 ** 0.5) < 1e-9


def test_rare_hours_percentile(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    counts = {1: 1, 2: 2, 3: 3, 4: 4, 5: 10}   # 10th percentile = 1.4 -> only hour 1
    rows = [(f"F{h}-{i}", "A", "X", "Y", 60.0, "On Time", t(h)) for h, n in counts.items() for i in range(n)]
    recent = anomalies.recent_flights(_flights(spark, rows), None, None)
    assert [r.departure_hour for r in anomalies.rare_hours(recent).collect()] == [1]
    assert anomalies.scheduling_anomalies(recent).count() == 1


def test_performance_share_thresholds(spark):
    t = dt.datetime(2024, 1, 1, 8)
    def airline(name, delayed, total):
        return [(f"{name}{i}", name, "X", "Y", 60.0, "Delayed" if i < delayed else "On Time", t) for i in range(total)]
    rows = airline("A", 3, 10) + airline("B", 5, 10) + airline("C", 6, 10)
    recent = anomalies.recent_flights(_flights(spark, rows), None, None)
    out = {r.airline: r.severity for r in anomalies.performance_anomalies(recent).collect()}
    assert out == {"B": "medium", "C": "high"}   # exactly 0.3 is not flagged, 0.5 is medium


def test_completeness_empty_table_gives_null(spark):
    df = spark.createDataFrame([], "code string, name string")
    out = checks.dq_completeness({"airports": (df, ("code", "name"))}).collect()
    assert [(r.column_name, r.non_null, r.completeness_pct) for r in out] == [("code", 0, None), ("name", 0, None)]


def test_best_airline_tie_break(spark):
    t = dt.datetime(2024, 1, 1, 8)
    rows = [("1", "B", "X", "Y", 1.0, "On Time", t), ("2", "A", "X", "Y", 1.0, "On Time", t),
            ("3", "C", "X", "Y", 1.0, "On Time", t), ("4", "C", "X", "Y", 1.0, "On Time", t)]
    out = reports.best_on_time_airline(_flights(spark, rows)).collect()[0]
    assert out.best_on_time_airline == "C"    # equal share: the busier airline wins
    assert reports.peak_hour(_flights(spark, rows)).collect()[0].peak_hour == 8


def test_most_used_aircraft_empty(spark):
    df = spark.createDataFrame([], "aircraft_type string, flight_duration_minutes double, airline string")
    assert reports.most_used_aircraft(df).collect()[0][0] == "N/A"


def test_stratified_split_exact(spark):
    df = spark.range(0, 1003).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("is_delayed"))
    out = ml.stratified_split(df, buckets=16)
    counts = {(r.is_delayed, r.split): r["count"] for r in out.groupBy("is_delayed", "split").count().collect()}
    n1, n0 = 335, 668
    assert counts[(1, "train")] == int(n1 * 0.8 + 0.5) and counts[(0, "train")] == int(n0 * 0.8 + 0.5)
    assert counts[(1, "test")] + counts[(1, "train")] == n1
    assert out.select("id").distinct().count() == 1003


def test_dedupe_keep_null_keys_option(spark):
    df = spark.createDataFrame(
        [("a", 0, 1), ("a", 1, 2), (None, 0, 3), (None, 2, 4)], "icao24 string, source_rank int, seq long")
    assert merge.dedupe_first(df).count() == 2
    out = sorted((r.icao24 or "", r.seq) for r in merge.dedupe_first(df, keep_null_keys=True).collect())
    assert out == [("", 3), ("", 4), ("a", 1)]
