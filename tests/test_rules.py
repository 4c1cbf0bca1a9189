"""Edge cases for the column rules, on hand-made frames."""

import datetime as dt


from contrail.functions import geo, scoring, text, timefns


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_region_rule_order_and_bounds(spark):
    pts = [(35.0, -25.0, "Europe"), (36.0, 10.0, "Europe"), (80.0, 0.0, "Europe"), (35.0, 60.0, "Europe"),
           (-60.0, -50.0, "South America"), (-60.0, 0.0, "Antarctica"), (66.5, 100.0, "Arctic"),
           (60.0, 100.0, "Other"), (None, 10.0, "Unknown"), (20.0, 100.0, "Asia"), (0.0, 20.0, "Africa"),
           (40.0, -100.0, "North America"), (-30.0, 150.0, "Oceania")]
    df = spark.createDataFrame([(a, b) for a, b, _ in pts], "latitude double, longitude double")
    got = [r[0] for r in df.select(geo.classify_region()).collect()]
    assert got == [p[2] for p in pts]


def test_coordinates_inclusive_and_null(spark):
    vals = [(90.0, 180.0, True), (-90.0, -180.0, True), (90.01, 0.0, False), (0.0, -180.01, False),
            (None, 0.0, None)]
    df = spark.createDataFrame([(a, b) for a, b, _ in vals], "latitude double, longitude double")
    assert [r[0] for r in df.select(geo.coordinates_valid()).collect()] == [v[2] for v in vals]


def test_clean_text_whole_values(spark):
    vals = [None, "", "None", "nan", "\tAB1 \n", "Nonesuch", "  "]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    got = [r[0] for r in df.select(text.clean_text("c")).collect()]
    assert got == ["", "", "", "", "AB1", "Nonesuch", ""]


def test_quality_score_weights(spark):
    df = spark.createDataFrame(
        [(True, True, True, "CS1", "US"), (False, False, False, "", None), (True, True, True, "", None),
         (True, False, False, "X", "Y")],
        "has_position boolean, has_speed boolean, has_altitude boolean, callsign string, origin_country string")
    assert [r[0] for r in df.select(scoring.quality_score()).collect()] == [100, 0, 80, 60]


def test_altitude_band_edges(spark):
    vals = [-5.0, 9999.9, 10000.0, 20000.0, 30000.0, 40000.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "altitude double")
    got = [r[0] for r in df.select(scoring.altitude_band()).collect()]
    assert got == ["Low (< 10k ft)", "Low (< 10k ft)", "Medium (10k-20k ft)", "High (20k-30k ft)",
                   "Very High (30k-40k ft)", "Extreme (> 40k ft)", "Extreme (> 40k ft)"]


def test_duration_category_right_closed(spark):
    vals = [0.0, 120.0, 120.5, 240.0, 480.0, 481.0, -3.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "m double")
    got = [r[0] for r in df.select(timefns.duration_category("m")).collect()]
    assert got == [None, "short", "medium", "medium", "long", "very_long", None, None]


def test_week_and_peak(spark):
    ts = [dt.datetime(2024, 1, 6, 6), dt.datetime(2024, 1, 7, 7), dt.datetime(2024, 1, 8, 9),
          dt.datetime(2024, 1, 8, 10), dt.datetime(2024, 1, 8, 17), dt.datetime(2024, 1, 8, 19),
          dt.datetime(2024, 1, 8, 20)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    out = df.select(timefns.day_of_week_sun0("t").alias("dow"), timefns.departure_hour("t").alias("h"))
    out = out.select("dow", timefns.is_weekend("dow").alias("we"), timefns.is_peak_hour("h").alias("pk"))
    assert rows(out, "dow", "we", "pk") == [(6, 1, 0), (0, 1, 1), (1, 0, 1), (1, 0, 0), (1, 0, 1), (1, 0, 1),
                                            (1, 0, 0)]


def test_pct_half_up_exact_and_empty(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (0, 0), (5, 200)], "h long, n long")
    got = [r[0] for r in df.select(scoring.pct_half_up("h", "n")).collect()]
    assert got == [12.5, 33.33, 66.67, None, 2.5]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,), (None,)], "x double")
    assert [r[0] for r in df.select(text.nan_to_null("x")).collect()] == [None, 1.5, None]


def test_tiers(spark):
    df = spark.createDataFrame([(80, 80.5), (79, 80.0), (60, 60.0), (59, 61.0)], "s int, p double")
    got = rows(df.select(scoring.quality_tier("s").alias("q"), scoring.on_time_tier("p").alias("o")), "q", "o")
    assert got == [("high", "good"), ("medium", "warning"), ("medium", "error"), ("low", "warning")]


def test_coerce_double(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), (None,), ("1e3",)], "c string")
    assert [r[0] for r in df.select(text.coerce_double("c")).collect()] == [1.5, None, None, 1000.0]


def test_exact_avg_is_partition_independent(spark):
    from contrail.functions.numeric import exact_avg
    vals = [100.0431, 471.2219, 12.5, 0.0001] * 40 + [None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    a = df.repartition(1).agg(exact_avg("x")).collect()[0][0]
    b = df.repartition(7).agg(exact_avg("x")).collect()[0][0]
    assert a == b == round(sum(v for v in vals if v is not None) / 160, 6)
    # half-up at the 7th decimal, from exact integers
    tie = spark.createDataFrame([(0.0000005,), (0.0000005,)], "x double").agg(exact_avg("x")).collect()[0][0]
    assert tie == 0.000001
    assert spark.createDataFrame([(None,)], "x double").agg(exact_avg("x")).collect()[0][0] is None
