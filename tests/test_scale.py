"""What must not grow with the tables: rows of one label or code in one task, join partitions, lines of a file."""

import pytest
from pyspark.sql import functions as F

from contrail.operators import ml
from contrail.plans import registry, warehouse
from contrail.sources import testdata

from .conftest import SMALL

BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def no_automatic_broadcast(spark):
    before = spark.conf.get(BROADCAST)
    spark.conf.set(BROADCAST, "-1")
    yield
    spark.conf.set(BROADCAST, before)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_shuffles_no_rows_by_their_label(spark, no_automatic_broadcast):
    rows = spark.range(6000).select("id", (F.col("id") % 2).cast("int").alias("is_delayed")).repartition(6)
    split = ml.stratified_split(rows)
    train = split.filter("split = 'train'")
    assert sorted(map(tuple, train.groupBy("is_delayed").count().collect())) == [(0, 2400), (1, 2400)]
    # as many writers as there are parts of the input, not one for a label
    assert train.select(F.input_file_name()).distinct().count() >= 6


def test_few_codes_are_sent_and_many_are_joined(spark, no_automatic_broadcast, monkeypatch):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("z",)], "p string")
    codes = spark.createDataFrame([("p", "a", 0), ("p", "b", 1), ("p", "nan", 2)], "column string, value string, code int")
    few = ml.encode_labels(df, codes, ("p",), unseen=-1)
    assert "SortMergeJoin" not in _plan(few) and "BroadcastHashJoin" in _plan(few)
    monkeypatch.setattr(ml, "SENT_CODES", 2)
    many = ml.encode_labels(df, codes, ("p",), unseen=-1)
    assert "SortMergeJoin" in _plan(many)
    assert sorted(r.p for r in few.collect()) == sorted(r.p for r in many.collect()) == [-1, 0, 1, 2]


def test_join_partitions_follow_the_source_files(spark):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(k, None) for k in names]
    with pytest.raises(KeyError), warehouse._join_partitions(spark, 1000 * warehouse.SOURCE_BYTES):
        assert [spark.conf.get(k) for k in names] == ["1000", warehouse.JOINED_SIZE]
        raise KeyError
    assert [spark.conf.get(k, None) for k in names] == before
    with warehouse._join_partitions(spark, 1):
        assert spark.conf.get(names[0]) == before[0]


def test_suppliers_meet_the_flights_without_a_shuffle(spark, no_automatic_broadcast, monkeypatch):
    sent = testdata.flights(spark, SMALL)
    assert "BroadcastHashJoin [l_suppkey" in _plan(sent)
    monkeypatch.setattr(testdata, "SENT_SUPPLIERS", 0)
    joined = testdata.flights(spark, SMALL)
    assert "SortMergeJoin [l_suppkey" in _plan(joined)
    assert sent.exceptAll(joined).count() == joined.exceptAll(sent).count() == 0


def test_extracts_are_compressed_files_of_bounded_length(spark, monkeypatch):
    monkeypatch.setattr(registry, "EXTRACT_LINES", 500, raising=False)
    paths = registry._write_extracts(spark, SMALL)
    for table, rows in (("scheduled_flights", registry.flights(spark, SMALL)), ("realtime_flights", registry.positions(spark, SMALL))):
        files = spark.read.text(paths[table]).groupBy(F.input_file_name().alias("f")).count().collect()
        assert all(r.f.endswith(".gz") and r["count"] <= 500 for r in files)
        assert sum(r["count"] for r in files) == rows.count()
