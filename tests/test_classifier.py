"""Delay classifier: counts, domains, save and load, unseen categories, depth."""

import tempfile

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from contrail.operators import anomalies, ml
from contrail.plans import registry, warehouse
from contrail.sources import landing, sinks

from .conftest import SMALL


@pytest.fixture(scope="module")
def parts(spark):
    split = ml.stratified_split(ml.ml_features(warehouse.scheduled_flights(spark, SMALL)), key=ml.row_key())
    return [split.filter(F.col("split") == p).drop("split") for p in ("train", "test")]


@pytest.fixture(scope="module")
def model(parts):
    return ml.train_delay_model(parts[0], num_trees=10, max_depth=4)


def test_predictions(parts, model):
    scored = ml.score_delays(model, parts[1])
    assert scored.count() == parts[1].count()
    assert set(ml.FEATURE_COLUMNS) <= set(scored.columns)
    for r in scored.limit(200).collect():
        assert r.prediction in (0.0, 1.0) and sum(r.probability) == pytest.approx(1.0)
        assert r.prediction == float(r.probability[1] > r.probability[0])


def test_save_and_load(spark, parts, model):
    path = ml.save_model(model, tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    back = ml.DelayModel.load(spark, path)
    key = ["airline", "route", "departure_hour", "flight_duration_minutes", "status"]

    def rows(m):
        return sorted(map(str, ml.score_delays(m, parts[1]).select(*key, "prediction", "probability").collect()))
    assert rows(back) == rows(model)
    assert ml.feature_importance(back).collect() == ml.feature_importance(model).collect()


def test_predictions_in_a_session_that_observes(parts, model):
    seen = Observation()
    n = parts[1].observe(seen, F.count(F.lit(1)).alias("n")).count()
    assert seen.get["n"] == n  # from here on Spark cannot send the session to tasks
    assert not model.model.stages[-1].hasSummary
    assert len(ml.score_delays(model, parts[1]).select("prediction").collect()) == n


def test_unseen_and_missing_categories_are_scored(parts, model):
    odd = parts[1].limit(5).withColumn("airline", F.lit("never seen")).withColumn("aircraft_type", F.lit(None).cast("string"))
    assert ml.score_delays(model, odd).filter("prediction IS NOT NULL").count() == 5


def test_deep_trees_are_possible(parts):
    deep = ml.train_delay_model(parts[0], max_rows=300, num_trees=2, max_depth=30)
    assert max(t.depth for t in deep.model.stages[-1].trees) > 6
    assert ml.train_delay_model(parts[0].limit(0)) is None


def test_metrics_content(parts, model):
    m = ml.model_metrics(ml.score_delays(model, parts[1]), parts[0].count(), model).first()
    assert 0 <= m.accuracy <= 1 and m.test_samples == parts[1].count() and m.training_samples == parts[0].count()
    assert list(m.features) == list(ml.FEATURES) and len(m.top_3_features) == 3
    assert m.top_feature == m.feature_importance[0].feature
    assert sum(f.importance for f in m.feature_importance) == pytest.approx(1.0)


def test_codes_are_ranks_of_distinct_text(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("b", "y"), (None, "x")], "p string, q string")
    got = {(r.column, r.value): r.code for r in ml.fit_encoders(df, ("p", "q")).collect()}
    assert got == {("p", "a"): 0, ("p", "b"): 1, ("p", "nan"): 2, ("q", "nan"): 0, ("q", "x"): 1, ("q", "y"): 2}
    coded = ml.encode_labels(spark.createDataFrame([("zz", "y")], "p string, q string"), ml.fit_encoders(df, ("p", "q")),
                             ("p", "q"), unseen=-1).first()
    assert (coded.p, coded.q) == (-1, 2)


def test_insight_messages_keep_their_commas(spark):
    metrics = spark.createDataFrame([("total_anomalies", 12345.0), ("accuracy", 0.9)], "metric string, value double")
    messages = [r.message for r in anomalies.insight_rules(metrics).collect()]
    assert "Found 12345 anomalies in recent flight data" in messages
    assert "Consider weather data integration for improved delay prediction" in messages


def test_anomaly_report_counts_what_is_listed(spark):
    recent = registry._recent(spark, SMALL, 7)
    listed = {r.type: r["count"] for r in anomalies.all_anomalies(recent).groupBy("type").count().collect()}
    rows = anomalies.anomaly_report(recent).collect()
    assert {r.type: r.anomaly_count for r in rows} == {t: listed.get(t, 0) for t in anomalies.TYPE_ORDER}
    assert {r.total_anomalies for r in rows} == {sum(listed.values())}


def test_insights_from_saved_documents(spark):
    """Fixed documents, also absent ones."""
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    metrics = spark.createDataFrame([(0.9, 9, "airline")], "accuracy double, features_used int, top_feature string")
    report = spark.createDataFrame([("duration_anomaly", 6, 8), ("scheduling_anomaly", 0, 8), ("performance_anomaly", 2, 8)],
                                   "type string, anomaly_count long, total_anomalies long")
    for name, df in (("metrics", metrics), ("report", report)):
        sinks.write_report_json(df, f"{base}/{name}")

    def messages(m, r):
        docs = [landing.read_report_json(spark, f"{base}/{p}", df.schema) for p, df in ((m, metrics), (r, report))]
        return [(x.kind, x.message) for x in anomalies.insights(*docs).collect()]

    general = [("recommendation", x) for x in anomalies.GENERAL_RECOMMENDATIONS]
    model = [("model", "delay_prediction 0.900 9"), ("insight", "Flight delay prediction model shows high accuracy (>80%)"),
             ("insight", "Most important factor for delays: airline")]
    found = [("insight", "Found 8 anomalies in recent flight data"),
             ("recommendation", "Review flight duration planning - multiple routes showing unusual durations"),
             ("recommendation", "Investigate airline performance issues - some carriers showing high delay rates")]
    status = [("status", "active")]
    assert sorted(messages("metrics", "report")) == sorted(status + model + found + general)
    assert sorted(messages("none", "report")) == sorted(status + [("insight", anomalies.NO_MODEL)] + found + general)
    assert sorted(messages("metrics", "none")) == sorted(status + model + [("insight", anomalies.NO_ANOMALY_REPORT)] + general)
