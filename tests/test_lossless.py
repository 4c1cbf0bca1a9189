"""Results must not depend on how files arrive, on failing writes, or on odd numbers in text."""

import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from contrail.functions.numeric import exact_avg
from contrail.functions.text import coerce_double
from contrail.operators import realtime
from contrail.operators.merge import dedupe_first
from contrail.sources import landing, sinks, testdata
from contrail.streaming import bounded
from contrail.streaming import positions as sp

from .conftest import SMALL


def _folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="module")
def feed(spark):
    """The small position feed as five landing files and the batch history."""
    base = _folder()
    pos = testdata.positions(spark, SMALL)
    sp.write_landing(pos, os.path.join(base, "feed"), files=5)
    names = sorted(n for n in os.listdir(os.path.join(base, "feed")) if n.startswith("part-"))
    return [open(os.path.join(base, "feed", n), encoding="utf-8").read() for n in names], realtime.history(pos)


def _landing(texts, order):
    """Files whose modification times follow `order`, whatever event times they hold."""
    folder = _folder()
    for k, i in enumerate(order):
        path = os.path.join(folder, f"f{i}.json")
        with open(path, "w", encoding="utf-8") as f:
            f.write(texts[i])
        os.utime(path, (1_700_000_000 + 100 * k,) * 2)
    return folder


ORDERS = [[0, 1, 2, 3, 4], [4, 3, 2, 1, 0], random.Random(3).sample(range(5), 5)]


def _dropped(query):
    return sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in p.get("stateOperators", []))


@pytest.mark.parametrize("order", ORDERS)
def test_bounded_streams_equal_batch(spark, feed, order):
    """Split, dedupe and windows: what the streams emit, with the rejects added, is the batch result."""
    texts, hist = feed
    base = _folder()
    schema = sp.split_history(spark, _landing(texts, order), base + "/split", base + "/ckpt-split")
    split = base + "/split"
    taken = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(split + "/accepted")
    late = bounded.rejected(spark, split, schema)
    assert taken.filter("data_source IS NOT NULL").count() + late.count() == hist.count()
    assert (late.count() == 0) == (order == sorted(order))
    assert len(os.listdir(split + "/newest")) <= 2 + len([x for x in os.listdir(split + "/newest") if x[0] in "._"])

    want = sp.first_per_snapshot(sp.with_event_time(hist).withColumn("snapshot_start", sp.snapshot_start())
                                 .drop("event_time"))
    got = sp.stream_dedupe_table(spark, split, schema, base + "/first", base + "/ckpt-first")
    cols = sorted(want.columns)
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))

    def rows(df):
        return sorted((str(r.window_start), r.region, r.flight_count, r.avg_altitude, round(r.avg_speed or -1, 6),
                       round(r.avg_quality, 6)) for r in df.collect())
    stats = sp.stream_region_windows(spark, split, schema, base + "/windows", base + "/ckpt-windows")
    assert rows(stats) == rows(sp.region_window_stats(sp.region_window_sums(hist)))
    assert sum(r[2] for r in rows(stats)) == 4 * hist.count()


def test_state_of_bounded_streams_expires(spark, feed):
    texts, hist = feed
    base = _folder()
    schema = sp.split_history(spark, _landing(texts, [0, 1, 2, 3, 4]), base + "/split", base + "/ckpt-split")
    rows = bounded.accepted(spark, base + "/split", schema, 1)
    for name, stream in (("first", bounded.first_per_period(rows)), ("windows", bounded.region_windows(rows))):
        q = bounded.run_to_table(stream, f"{base}/{name}", f"{base}/ckpt-{name}")
        sizes = [s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]]
        assert _dropped(q) == 0
        assert sizes[-1] <= 8  # only what the heartbeat has opened
        # Never more than one file's groups with those of the delay and a window before it.
        assert max(sizes) < 0.6 * spark.read.parquet(f"{base}/{name}").count()


@pytest.mark.parametrize("order", ORDERS[::2])
def test_batches_of_many_files_lose_nothing(spark, feed, order, monkeypatch):
    """A landing file read by many tasks stays one batch of the streams, and its files come in the order of time."""
    texts, hist = feed
    base = _folder()
    monkeypatch.setattr(bounded, "FILE_ROWS", 17)
    settings = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "0"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        schema = sp.split_history(spark, _landing(texts, order), base + "/split", base + "/ckpt-split")
    finally:
        for k in settings:
            spark.conf.unset(k)
    batches = sorted(x for x in os.listdir(base + "/split/accepted") if not x.startswith("epoch=heartbeat"))
    assert max(len([x for x in os.listdir(f"{base}/split/accepted/{b}") if x.startswith("part-")]) for b in batches) > 2
    for b in batches:
        parts = sorted((os.stat(f"{base}/split/accepted/{b}/{x}").st_mtime_ns, f"{base}/split/accepted/{b}/{x}")
                       for x in os.listdir(f"{base}/split/accepted/{b}") if x.startswith("part-"))
        times = [spark.read.parquet(x).agg(F.min("extraction_time"), F.max("extraction_time")).first() for _at, x in parts]
        assert len({at for at, _x in parts}) == len(parts)
        assert all(a[1] <= z[0] for a, z in zip(times, times[1:], strict=False))

    rows = bounded.accepted(spark, base + "/split", schema, 1)
    q = bounded.run_to_table(bounded.first_per_period(rows), base + "/count", base + "/ckpt-count")
    assert _dropped(q) == 0 and len({p["batchId"] for p in q.recentProgress}) <= len(texts) + 2
    want = sp.first_per_snapshot(sp.with_event_time(hist).withColumn("snapshot_start", sp.snapshot_start()).drop("event_time"))
    got = sp.stream_dedupe_table(spark, base + "/split", schema, base + "/first", base + "/ckpt-first")
    assert got.columns == spark.read.parquet(base + "/first").columns
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def _failing(spark, n=100):
    return spark.range(n).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("broken")).cast("long"))
                                 .otherwise(F.col("id")).alias("id"))


def test_load_replace_keeps_old_data_when_the_write_fails(spark):
    base = _folder()
    name = "keep_" + os.path.basename(base).replace("-", "_")
    assert sinks.load_replace(spark.range(5), name, base).first().loaded
    status = sinks.load_replace(_failing(spark), name, base, skip_empty=False).first()
    assert not status.loaded and status.status.startswith("failed")
    assert sorted(r.id for r in spark.table(name).collect()) == [0, 1, 2, 3, 4]
    assert sinks.load_replace(spark.range(2), name, base).first().loaded
    assert spark.table(name).count() == 2
    # another schema
    assert sinks.load_replace(spark.range(3).selectExpr("id", "'x' AS tag"), name, base).first().loaded
    assert spark.table(name).columns == ["id", "tag"]
    with pytest.raises(RuntimeError, match="1 table loads failed"):
        sinks.raise_on_failures(sinks.load_replace(_failing(spark), name, base, skip_empty=False))
    spark.sql(f"DROP TABLE {name}")


def test_insert_replace_keeps_old_rows_when_the_write_fails(spark):
    base = _folder()
    name = "declared_" + os.path.basename(base).replace("-", "_")
    sinks.declare_tables(spark, {name: ("CREATE TABLE IF NOT EXISTS {name} (id BIGINT) USING parquet "
                                        "LOCATION '{location}'", base + "/t")})
    sinks.insert_replace(spark.range(4), name)
    with pytest.raises(Exception, match="broken"):
        sinks.insert_replace(_failing(spark), name)
    assert spark.table(name).count() == 4
    sinks.insert_replace(spark.range(4).union(spark.table(name)), name)  # reads what it replaces
    assert spark.table(name).count() == 8
    spark.sql(f"DROP TABLE {name}")


def test_numbers_from_text(spark):
    given = {"nan": None, "NaN": None, "Infinity": None, "-inf": None, "1d": None, "2F": None, "0x1p3": None,
             "1_0": None, "1e999": None, "": None, "abc": None, "1.5": 1.5, " 7\t": 7.0, "-2e3": -2000.0, ".5": 0.5,
             "3.": 3.0, "+4": 4.0}
    df = spark.createDataFrame([(k,) for k in given] + [(None,)], "x string")
    got = {r.x: r.y for r in df.select("x", coerce_double("x").alias("y")).collect()}
    assert got == {**given, None: None}


def test_exact_avg_leaves_out_what_is_no_number(spark):
    df = spark.createDataFrame([(float("nan"),), (100.0,), (200.0,), (None,)], "x double")
    assert df.agg(exact_avg("x").alias("m")).first().m == 150.0
    assert df.filter("x is null").agg(exact_avg("x").alias("m")).first().m is None


def test_blank_keys_are_no_duplicates(spark):
    df = spark.createDataFrame([("", 1), ("", 2), (" ", 3), (None, 4), ("a", 5), ("a", 6)], "icao24 string, seq int")
    got = dedupe_first(df, "icao24", ("seq",), keep_null_keys=True)
    assert sorted(r.seq for r in got.collect()) == [1, 2, 3, 4, 5]


def test_unreadable_file_gives_an_empty_frame_and_a_warning(spark):
    base = _folder()
    with open(os.path.join(base, "part-0.parquet"), "wb") as f:
        f.write(b"PAR1 this is no table PAR1")
    with pytest.warns(UserWarning, match="cannot be read"):
        df = landing.read_or_empty(spark, base, spark.range(0).schema)
    assert df.count() == 0


def test_arrival_order_does_not_depend_on_splits(spark):
    base = _folder()
    for name in ("a.json", "b.json"):
        with open(os.path.join(base, name), "w", encoding="utf-8") as f:
            for k in range(40):
                f.write(json.dumps({"response": [{"hex": f"{name[0]}{k}-{j}", "lat": "1", "lng": "2"}
                                                 for j in range(3)]}) + "\n")
    want = [f"{n}{k}-{j}" for n in "ab" for k in range(40) for j in range(3)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("64m", "700b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = landing.ingest_flat_live(spark, base).orderBy("arrival").collect()
            assert [r.icao24 for r in rows] == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
