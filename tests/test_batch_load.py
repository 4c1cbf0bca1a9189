"""Lenient CSV, the batch load of three tables, and switches that leave all old tables or none."""

import csv
import gzip
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.sources import batch_load, landing, sinks


def _folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def _write(text):
    path = os.path.join(_folder(), "x.csv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def test_field_count_equals_python_csv(spark):
    rng = random.Random(6)
    lines = ["".join(rng.choice('ab ,,,"""') for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    lines += ['"', '""', '"a', 'a"b,c"d', '"a"b,c', '"a""b",c', ",,", "," * 40, '"' + "x," * 5000 + '"', 'é,"ü,ß"']
    lines = [x for x in lines if x.strip()]
    got = spark.createDataFrame([(x,) for x in lines], "v string").select("v", landing.csv_fields(F.col("v")).alias("n"))
    assert [(r.v, r.n) for r in got.collect() if r.n != len(next(csv.reader([r.v])))] == []


def test_long_rows_go_and_short_rows_are_padded(spark):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    path = _write('a,b\nx,1\n"p,q",2\ny,3,\nz,4,,\n\nshort\n"w",bad\nv,5,"six, seven"\na,b\n')
    got = landing.read_csv_lenient(spark, path, schema, header=True)
    assert [tuple(r) for r in got.collect()] == [("x", 1), ("p,q", 2), ("short", None), ("w", None)]
    assert landing.read_csv_lenient(spark, _write(""), schema, header=True).count() == 0


def test_unreadable_text_source_gives_an_empty_frame(spark):
    path = os.path.join(_folder(), "x.json.gz")
    whole = gzip.compress(b'{"id": 1}\n' * 5000)
    with open(path, "wb") as f:
        f.write(whole[:len(whole) // 2])
    with pytest.warns(UserWarning, match="cannot be read"):
        assert landing.read_or_empty(spark, path, spark.range(0).schema, fmt="json").count() == 0


AIRPORTS = 'C1,N,"Paris, FR",X,1.5,2\nC2,N,L,X,1,2,\n'
FLIGHTS = ("F1,A,O,D,2024-01-01 10:00:00,2024-01-01 12:30:00,T,On Time,G1\n"
           "F2,A,O,D,soon,2024-01-01 12:30:00,T,On Time,G1\nF3,A,O,D,2024-01-01 10:00:00\n")
POSITIONS = "k1,CS,X,1.0,2.0,3,4,5\nk2,CS,X,bad,2.0,3,4,5\nk3,CS,X,91,2.0,3,4,5\nk4,CS,X,1,2,3,4,5,\n"


def _names():
    mark = os.path.basename(_folder()).replace("-", "_")
    return {t: f"{t}_{mark}" for t in batch_load.extracts()}


def _rows(spark, names):
    return {t: sorted(map(str, spark.table(n).collect())) if spark.catalog.tableExists(n) else None for t, n in names.items()}


def test_load_counts_rejects_and_loads_all_or_none(spark, monkeypatch):
    names, base = _names(), _folder()
    paths = {"airports": _write(AIRPORTS), "scheduled_flights": _write(FLIGHTS), "realtime_flights": _write(POSITIONS)}
    told = {(r.table_name, r.rule): r.n for r in batch_load.load_batch(spark, paths, base, names).collect()}
    assert told == {("airports", "long_row"): 1, ("airports", "loaded"): 1,
                    ("scheduled_flights", "long_row"): 0, ("scheduled_flights", "bad_timestamp"): 1,
                    ("scheduled_flights", "loaded"): 2,
                    ("realtime_flights", "long_row"): 1, ("realtime_flights", "no_coordinates"): 1,
                    ("realtime_flights", "coordinates_out_of_range"): 1, ("realtime_flights", "loaded"): 1}
    first = spark.table(names["scheduled_flights"]).filter("flight_number = 'F1'").first()
    assert first.flight_duration_minutes == 150.0 and first.data_source == "schedule"
    before = _rows(spark, names)

    # One table's job fails: no table changes.
    real = batch_load.extracts()
    broken = {**real, "scheduled_flights": batch_load.Extract(
        batch_load.SCHEDULE_EXTRACT, lambda df: batch_load.schedule_rows(df.withColumn(
            "gate", F.raise_error(F.lit("broken")).cast("string"))), {}, ("timestamps_valid",))}
    again = {"airports": _write(AIRPORTS * 2), "scheduled_flights": paths["scheduled_flights"],
             "realtime_flights": _write(POSITIONS * 2)}
    with monkeypatch.context() as m:
        m.setattr(batch_load, "extracts", lambda: broken)
        with pytest.raises(RuntimeError, match="scheduled_flights"):
            batch_load.load_batch(spark, again, base, names)
    assert _rows(spark, names) == before

    # A name can't move after others have: these go back.
    move, calls = sinks._point_to, []

    def failing(spark_, table, folder, schema):
        calls.append(table)
        if table == names["realtime_flights"] and len(calls) == 3:
            raise RuntimeError("no such place")
        move(spark_, table, folder, schema)

    with monkeypatch.context() as m:
        m.setattr(sinks, "_point_to", failing)
        with pytest.raises(RuntimeError, match="no such place"):
            batch_load.load_batch(spark, again, base, names)
    assert _rows(spark, names) == before

    # An empty extract keeps its table, a missing one as well; the others are loaded.
    told = batch_load.load_batch(spark, {"airports": _write(""), "realtime_flights": again["realtime_flights"]}, base, names)
    assert {r.table_name for r in told.filter("rule = 'kept_old'").collect()} == {"airports", "scheduled_flights"}
    after = _rows(spark, names)
    assert after["airports"] == before["airports"] and len(after["realtime_flights"]) == 2
    assert len(sinks.forget_old_loads(spark, f"{base}/realtime_flights", keep=1)) >= 1
    assert _rows(spark, names) == after
    for n in names.values():
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_failed_switch_to_another_schema_keeps_the_old_table(spark, monkeypatch):
    base = _folder()
    name = "switch_" + os.path.basename(base).replace("-", "_")
    spark.range(3).write.parquet(base + "/a")
    spark.range(2).selectExpr("id", "'x' AS tag").write.parquet(base + "/b")
    sinks.switch_together(spark, {name: base + "/a"})
    real = type(spark).sql

    def failing(self, text, *args, **kwargs):
        if "RENAME TO" in text and text.endswith(name) and "_new_" in text:
            raise RuntimeError("broken")
        return real(self, text, *args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", failing)
        with pytest.raises(RuntimeError, match="broken"):
            sinks.switch_together(spark, {name: base + "/b"})
    assert spark.table(name).count() == 3 and spark.table(name).columns == ["id"]
    sinks.switch_together(spark, {name: base + "/b"})
    assert spark.table(name).count() == 2 and spark.table(name).columns == ["id", "tag"]
    spark.sql(f"DROP TABLE {name}")


def test_declared_table_is_partitioned_by_day(spark):
    from contrail.plans import warehouse
    from tests.conftest import SMALL
    base = _folder()
    name = "declared_" + os.path.basename(base).replace("-", "_")
    sinks.declare_tables(spark, {name: (sinks.REALTIME_DDL, base + "/t")})
    rows = warehouse.realtime_latest(spark, SMALL).drop("extraction_day")
    for n in (1, 2):  # the second load replaces the first
        sinks.insert_replace(rows if n == 2 else rows.limit(5), name)
    day = rows.agg(F.max("extraction_time").cast("date")).first()[0]
    recent = spark.table(name).filter(F.col("extraction_day") == F.lit(day))
    assert spark.table(name).count() == rows.count()
    assert recent.count() == rows.filter(F.col("extraction_time").cast("date") == F.lit(day)).count()
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "extraction_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(f"extraction_day={day}" in f for f in recent.inputFiles())
    with pytest.raises(Exception, match="broken"):
        sinks.insert_replace(rows.withColumn("region", F.raise_error(F.lit("broken")).cast("string")), name)
    assert spark.table(name).count() == rows.count()
    spark.sql(f"DROP TABLE {name}")
