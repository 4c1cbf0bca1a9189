"""Stream semantics on hand-made landing files, one micro-batch per file."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from contrail.operators import realtime
from contrail.streaming import positions as sp
from contrail.streaming.upsert import read_table


def _write(folder, name, rows, mtime):
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        for icao, ts in rows:
            fh.write(json.dumps({"seq": 1, "icao24": icao, "extraction_time": ts}) + "\n")
    os.utime(path, (mtime, mtime))


def test_dedupe_watermark_late_and_closing(spark):
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    landing = os.path.join(base, "landing")
    os.makedirs(landing)
    # batch 1: A twice inside one 15-minute period (one kept), B once
    _write(landing, "f1.json", [("A", "2024-01-01T10:00:00.000000"), ("A", "2024-01-01T10:05:00.000000"),
                                ("B", "2024-01-01T10:01:00.000000")], 1_700_000_000)
    # batch 2: A again in the next period (kept); a closing record moves the watermark to 10:45
    _write(landing, "f2.json", [("A", "2024-01-01T10:20:00.000000"), ("Z", "2024-01-01T11:00:00.000000")],
           1_700_000_100)
    # batch 3: another closing record (watermark 11:45 from here on)
    _write(landing, "f3.json", [("Y", "2024-01-01T12:00:00.000000")], 1_700_000_200)
    # batch 4: the late-event watermark is 11:45 (max period 12:00 - 15 min): C (period
    # 10:00) is late and dropped; B at 11:50 (period 11:45) is on time
    _write(landing, "f4.json", [("C", "2024-01-01T10:03:00.000000"), ("B", "2024-01-01T11:50:00.000000")],
           1_700_000_300)
    stream = sp.read_stream(spark, landing, max_files_per_trigger=1)
    from contrail.functions.timefns import ntz_of_instant
    out = sp.stream_dedupe(stream).select("icao24", F.date_format(ntz_of_instant(F.col("snapshot_start")),
                                                                  "HH:mm").alias("p"))
    q = (out.writeStream.format("memory").queryName("dedupe_edge").outputMode("append")
         .option("checkpointLocation", os.path.join(base, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.icao24, r.p) for r in spark.table("dedupe_edge").collect())
    assert got == [("A", "10:00"), ("A", "10:15"), ("B", "10:00"), ("B", "11:45"), ("Y", "12:00"),
                   ("Z", "11:00")]
    dropped = sum(s.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                  for s in p.get("stateOperators", []))
    assert dropped == 1


def test_snapshot_keeps_newest_across_batches(spark):
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    landing = os.path.join(base, "landing")
    os.makedirs(landing)
    rows1 = [{"seq": 1, "icao24": "A", "latitude": 10.0, "longitude": 10.0, "data_source": "opensky",
              "extraction_time": "2024-01-01T10:00:00.000000"}]
    rows2 = [{"seq": 2, "icao24": "A", "latitude": 11.0, "longitude": 11.0, "data_source": "airlabs",
              "extraction_time": "2024-01-01T10:30:00.000000"},
             {"seq": 3, "icao24": "B", "latitude": 12.0, "longitude": 12.0, "data_source": "opensky",
              "extraction_time": "2024-01-01T09:00:00.000000"}]
    for i, rows in enumerate((rows1, rows2)):
        p = os.path.join(landing, f"f{i}.json")
        with open(p, "w") as fh:
            fh.write("\n".join(json.dumps(r) for r in rows) + "\n")
        os.utime(p, (1_700_000_000 + 100 * i,) * 2)
    table = os.path.join(base, "latest")
    sp.stream_snapshot(spark, landing, table, os.path.join(base, "ckpt"), max_files_per_trigger=1)
    rows = read_table(spark, table, realtime.history(sp.read_stream(spark, landing)).schema)
    got = sorted((r.icao24, r.seq, r.latitude) for r in rows.collect())
    assert got == [("A", 2, 11.0), ("B", 3, 12.0)]
