"""Anomaly detection over scheduled flights and the rule-based insights.

Skew: per-route and per-airline statistics are grouped aggregates (partial
aggregation), joined back to the flights; AQE broadcasts the statistics
side when its measured size is small and splits skewed partitions when it
is not. The hour-of-day side of the scheduling check has at most 24 rows,
so it is broadcast explicitly.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import timefns
from contrail.functions.numeric import exact_avg

DELAY_STATUSES = ("Delayed", "Cancelled")
# Fixed values that must equal the reference.
Z_THRESHOLD, Z_HIGH = 2.0, 3.0
RARE_HOUR_QUANTILE = 0.1
DELAY_SHARE_THRESHOLD, DELAY_SHARE_HIGH = 0.3, 0.5
TYPE_ORDER = ("duration_anomaly", "scheduling_anomaly", "performance_anomaly")

ANOMALY_COLUMNS = {
    "type": "string", "flight_number": "string", "airline": "string", "route": "string",
    "actual_duration": "double", "expected_duration": "double", "deviation": "double",
    "departure_hour": "int", "delay_rate": "double", "severity": "string",
}


def recent_flights(flights: DataFrame, as_of_date: _dt.date | None, lookback_days: int | None = 7) -> DataFrame:
    """Flights departing on/after ``as_of_date - lookback_days`` (None: all)."""
    df = flights.select("flight_number", "airline", "origin_airport", "destination_airport",
                        "flight_duration_minutes", "status", "scheduled_departure",
                        timefns.departure_hour("scheduled_departure").alias("departure_hour"))
    if lookback_days is None:
        return df.filter(F.col("scheduled_departure").isNotNull())
    lo = timefns.ts_literal(as_of_date) - F.expr(f"INTERVAL {int(lookback_days)} DAYS")
    return df.filter(F.col("scheduled_departure") >= lo)


def _route_display() -> F.Column:
    return F.concat(F.col("origin_airport"), F.lit(" -> "), F.col("destination_airport"))


def route_stats(flights: DataFrame) -> DataFrame:
    """Per (origin, destination): mean and sample std of the duration."""
    return (flights.groupBy("origin_airport", "destination_airport")
            .agg(exact_avg("flight_duration_minutes").alias("avg_duration"),
                 F.stddev_samp("flight_duration_minutes").alias("std_duration")))


def attach_route_stats(flights: DataFrame) -> DataFrame:
    """Left join of each flight to its route's mean / std.

    A grouped aggregate (partial aggregation, skew-safe) joined back on the
    route key; Spark broadcasts the statistics when their measured size is
    under the threshold and sort-merges (with AQE skew splits) otherwise.
    """
    return flights.join(route_stats(flights), ["origin_airport", "destination_airport"], "left")


def duration_anomalies(recent: DataFrame, z: float = Z_THRESHOLD, z_high: float = Z_HIGH,
                       stats: DataFrame | None = None) -> DataFrame:
    """|duration - route mean| / route sample std > z (one-flight route: std 1;
    constant route: std 0 -> undefined -> not flagged).

    ``stats``: the routes' statistics if they are at hand, for example folded
    from stored moments; else they are taken from the flights."""
    j = (attach_route_stats(recent) if stats is None
         else recent.join(stats, ["origin_airport", "destination_airport"], "left"))
    std = F.coalesce(F.col("std_duration"), F.lit(1.0))
    zc = F.abs(F.col("flight_duration_minutes") - F.col("avg_duration")) / F.nullif(std, F.lit(0.0))
    j = j.withColumn("deviation", zc).filter(F.col("deviation") > z)
    return j.select(
        F.lit("duration_anomaly").alias("type"), "flight_number", "airline",
        _route_display().alias("route"),
        F.col("flight_duration_minutes").alias("actual_duration"),
        F.col("avg_duration").alias("expected_duration"),
        "deviation",
        F.when(F.col("deviation") > z_high, "high").otherwise("medium").alias("severity"))


def rare_hours(recent: DataFrame, q: float = RARE_HOUR_QUANTILE) -> DataFrame:
    """Hours whose departure count is strictly below the q-quantile (linear
    interpolation) of the per-hour counts. At most 24 rows."""
    counts = recent.filter(F.col("departure_hour").isNotNull()).groupBy("departure_hour").agg(
        F.count(F.lit(1)).alias("n"))
    cut = counts.agg(F.percentile(F.col("n").cast("double"), q).alias("cut"))
    # the cut side is exactly one row: a broadcast theta join over <= 24 rows
    return counts.join(F.broadcast(cut), F.col("n") < F.col("cut")).select("departure_hour", "n")


def flag_unusual_hours(recent: DataFrame, q: float = RARE_HOUR_QUANTILE) -> DataFrame:
    """Flights departing in a rare hour: a semi-join with the (<= 24-row,
    so explicitly broadcast) set of rare hours."""
    rare = rare_hours(recent, q)
    return recent.join(F.broadcast(rare.select("departure_hour")), "departure_hour", "left_semi")


def scheduling_anomalies(recent: DataFrame, q: float = RARE_HOUR_QUANTILE) -> DataFrame:
    hits = flag_unusual_hours(recent, q)
    return hits.select(F.lit("scheduling_anomaly").alias("type"), "flight_number", "airline",
                       _route_display().alias("route"), "departure_hour",
                       F.lit("low").alias("severity"))


def performance_anomalies(recent: DataFrame, share: float = DELAY_SHARE_THRESHOLD,
                          high: float = DELAY_SHARE_HIGH) -> DataFrame:
    rates = recent.groupBy("airline").agg(
        F.avg(F.col("status").isin(*DELAY_STATUSES).cast("double")).alias("delay_rate"))
    return (rates.filter(F.col("delay_rate") > share)
            .select(F.lit("performance_anomaly").alias("type"), "airline", "delay_rate",
                    F.when(F.col("delay_rate") > high, "high").otherwise("medium").alias("severity")))


def all_anomalies(recent: DataFrame, **params) -> DataFrame:
    """Union of the three kinds in the common anomaly schema."""
    parts = [duration_anomalies(recent), scheduling_anomalies(recent),
             performance_anomalies(recent, **params)]
    out = None
    for p in parts:
        p = p.select(*[(F.col(c) if c in p.columns else F.lit(None)).cast(t).alias(c)
                       for c, t in ANOMALY_COLUMNS.items()])
        out = p if out is None else out.unionByName(p)
    return out


def scheduling_count(recent: DataFrame, q: float = RARE_HOUR_QUANTILE) -> DataFrame:
    """Number of flights in rare hours, from the per-hour counts alone (at most 24 rows)."""
    counts = (recent.filter(F.col("departure_hour").isNotNull()).groupBy("departure_hour")
              .agg(F.count(F.lit(1)).alias("n")))
    one = counts.agg(F.percentile(F.col("n").cast("double"), q).alias("cut"), F.collect_list("n").alias("counts"))
    return one.select(F.aggregate(F.filter("counts", lambda n: n < F.col("cut")), F.lit(0).cast("long"),
                                  lambda s, n: s + n).alias("anomaly_count"))


def anomaly_report(recent: DataFrame, **params) -> DataFrame:
    """Counts by type (all three types present, zero when none) and total; every kind is only counted."""
    kinds = (duration_anomalies(recent).agg(F.count(F.lit(1)).alias("anomaly_count")), scheduling_count(recent),
             performance_anomalies(recent, **params).agg(F.count(F.lit(1)).alias("anomaly_count")))
    out = None
    for i, (name, one) in enumerate(zip(TYPE_ORDER, kinds, strict=True)):
        one = one.select(F.lit(name).alias("type"), F.lit(i).alias("type_rank"), "anomaly_count")
        out = one if out is None else out.unionByName(one)
    all_rows = F.collect_list(F.struct("type_rank", "type", "anomaly_count"))  # three rows
    total = out.agg(F.array_sort(all_rows).alias("rows"), F.sum("anomaly_count").alias("total_anomalies"))
    return total.select(F.inline("rows"), "total_anomalies").select("type", "anomaly_count", "total_anomalies")


def anomaly_list(recent: DataFrame, n: int = 20, **params) -> DataFrame:
    """First ``n`` anomalies in type order, then a stable key."""
    rank = F.when(F.col("type") == TYPE_ORDER[0], 0).when(F.col("type") == TYPE_ORDER[1], 1).otherwise(2)
    return (all_anomalies(recent, **params).withColumn("_r", rank)
            .orderBy("_r", F.col("deviation").desc_nulls_last(),
                     *(F.col(c).asc_nulls_last() for c in ("flight_number", "airline", "route", "departure_hour",
                                                           "actual_duration", "delay_rate")))
            .limit(n).drop("_r"))


# Fixed values that must equal the reference: insight rules and texts.
INSIGHT_RULES = (
    ("accuracy", 0.8, "insight", "Flight delay prediction model shows high accuracy (>80%)"),
    ("total_anomalies", 0, "insight", "Found {value:.0f} anomalies in recent flight data"),
    ("duration_anomaly", 5, "recommendation",
     "Review flight duration planning - multiple routes showing unusual durations"),
    ("performance_anomaly", 0, "recommendation",
     "Investigate airline performance issues - some carriers showing high delay rates"),
)
GENERAL_RECOMMENDATIONS = (
    "Continue monitoring flight patterns for seasonal trends",
    "Consider weather data integration for improved delay prediction",
    "Implement real-time alerting for critical anomalies",
)

NO_MODEL = "Delay prediction model not yet trained"
NO_ANOMALY_REPORT = "Anomaly detection not yet completed"
PIPELINE_STATUS = "active"
MODEL_TYPE = "delay_prediction"


def insights(metrics: DataFrame, report: DataFrame) -> DataFrame:
    """(kind, message) from the two saved documents: the model's metrics row and the anomaly counts.

    A document that is absent (an empty frame) gives the text that says so.
    Beside insights and recommendations there is the pipeline's status and
    one ``model`` row per trained model (type, accuracy, features).
    """
    spark = metrics.sparkSession
    trained, counted = not metrics.isEmpty(), not report.isEmpty()
    rows = [("status", PIPELINE_STATUS)]
    if not trained:
        rows.append(("insight", NO_MODEL))
    if not counted:
        rows.append(("insight", NO_ANOMALY_REPORT))
    total = report.select(F.lit("total_anomalies").alias("metric"),
                          F.col("total_anomalies").cast("double").alias("value")).distinct()
    values = (metrics.select(F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value"))
              .unionByName(report.select(F.col("type").alias("metric"), F.col("anomaly_count").cast("double").alias("value")))
              .unionByName(total))
    out = insight_rules(values, metrics.select(F.col("top_feature").alias("feature")))
    models = metrics.select(F.lit("model").alias("kind"), F.concat_ws(
        " ", F.lit(MODEL_TYPE), F.format_number("accuracy", 3), F.col("features_used").cast("string")).alias("message"))
    return spark.createDataFrame(rows, "kind string, message string").unionByName(models).unionByName(out)


def insight_rules(metrics: DataFrame, top_feature: DataFrame | None = None) -> DataFrame:
    """Apply the rule table to a long ``(metric, value)`` frame.

    A rule fires when its metric's value exceeds the threshold; the message
    template is filled from the value. Then the top-feature insight and
    the fixed recommendations are appended.
    """
    spark = metrics.sparkSession
    rules = spark.createDataFrame(
        [(m, float(t), k, msg) for m, t, k, msg in INSIGHT_RULES],
        "metric string, threshold double, kind string, message string")
    whole = F.bround(F.col("value"), 0).cast("long").cast("string")
    fired = (metrics.join(F.broadcast(rules), "metric")
             .filter(F.col("value") > F.col("threshold"))
             .select("kind", F.replace(F.col("message"), F.lit("{value:.0f}"), whole).alias("message")))
    parts = [fired]
    if top_feature is not None:
        parts.append(top_feature.select(F.lit("insight").alias("kind"),
                                        F.concat(F.lit("Most important factor for delays: "),
                                                 F.col("feature")).alias("message")))
    parts.append(spark.createDataFrame([("recommendation", r) for r in GENERAL_RECOMMENDATIONS],
                                       "kind string, message string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
