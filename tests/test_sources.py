"""Reader edge cases on hand-made landing files (FIXTURES section 4)."""

import datetime as dt
import os
import tempfile

from pyspark.sql import types as T

from contrail.sources import landing

RUN = dt.datetime(2025, 7, 12, 13, 42, 58)
STATE = '["abc","CS1 ","X",1,2,{lon},{lat},100.0,false,5.0,90.0,null,null,110.0,null,false,0{extra}]'


def _dir(*files):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for i, text in enumerate(files):
        with open(os.path.join(d, f"part-{i}.json"), "w") as fh:
            fh.write(text)
    return d


def test_state_vectors_slots_nulls_text_and_time(spark):
    ok = STATE.format(lon=10.5, lat=20.5, extra="")
    long18 = STATE.format(lon=11.5, lat=21.5, extra=',"x"')
    text_lat = STATE.format(lon=12.5, lat='"n/a"', extra="")
    short16 = ok[: ok.rindex(",")] + "]"
    docs = [
        '{"time": 1700000000, "states": [' + ",".join([ok, long18, text_lat, short16, "null"]) + "]}",
        '{"states": [' + ok + "]}",            # no snapshot time: load time is used
        '{"time": 1700000100, "states": []}',  # empty snapshot
    ]
    df = landing.ingest_state_vectors(spark, _dir("\n".join(docs) + "\n"), run_ts=RUN)
    rows = sorted(df.collect(), key=lambda r: (r.longitude, r.data_timestamp))
    assert [r.longitude for r in rows] == [10.5, 10.5, 11.5, 12.5]      # 16-slot and null states dropped
    assert rows[3].latitude is None                                    # text latitude -> null
    assert rows[0].data_timestamp == 1700000000 and rows[1].data_timestamp > 1700000000
    assert all(r.extraction_time == RUN and r.data_source == "opensky" for r in rows)
    assert rows[0].callsign == "CS1 " and rows[0].on_ground is False and rows[0].position_source == 0


def test_missing_and_empty_sources(spark):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    assert landing.read_or_empty(spark, "/tmp/contrail-never-written-path", schema).count() == 0
    empty = _dir("")
    blank = _dir("\n")
    assert landing.read_csv_lenient(spark, empty, schema).count() == 0
    assert landing.read_csv_lenient(spark, blank, schema).count() == 0


def test_csv_long_short_and_quoted_rows(spark):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b", "c")])
    d = _dir('x,"y, with comma",z\nshort,row\nlong,row,has,extra\n')
    rows = sorted(tuple(r) for r in landing.read_csv_lenient(spark, d, schema).collect())
    assert rows == [("short", "row", None), ("x", "y, with comma", "z")]


def test_nested_live_missing_parts(spark):
    docs = ('{"data": [{"flight": {"icao": "A1", "iata": "F1"}, "live": {"latitude": 50.0, "longitude": 10.0}},'
            ' {"flight": {"iata": "F2"}, "live": {"latitude": "bad", "longitude": 1.0}},'
            ' {"flight": {"icao": "A3"}}]}\n')
    rows = landing.ingest_nested_live(spark, _dir(docs), run_ts=RUN).collect()
    assert [(r.icao24, r.callsign, r.airline, r.region) for r in rows] == [("A1", "F1", "", "Europe")]
