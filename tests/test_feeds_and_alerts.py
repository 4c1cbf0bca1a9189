"""Streams of raw feeds, the keyed table they maintain, and stale-feed alerts."""

import datetime as dt
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from contrail.operators import realtime
from contrail.sources import landing
from contrail.streaming import alerts, bounded, feeds
from contrail.streaming import positions as sp
from contrail.streaming.upsert import BUCKET, complete, read_table, touched_upsert

RUN = dt.datetime(2025, 7, 12, 13, 42, 58)


def _folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def _put(folder, texts, order):
    os.makedirs(folder, exist_ok=True)
    for k, i in enumerate(order):
        path = os.path.join(folder, f"f{i}.json")
        with open(path, "w", encoding="utf-8") as f:
            f.write(texts[i])
        os.utime(path, (1_700_000_000 + 100 * k,) * 2)


def _state(icao, lat, lon):
    return [icao, " CS1 ", "X", 1, 1, lon, lat, 900.0, False, 80.0, 10.0, None, None, 900.0, None, False, 0]


def _feeds(base, order):
    rng = random.Random(4)
    keys = [f"k{i}" for i in range(30)]
    states = ["\n".join(json.dumps({"time": 100 + i, "states": [_state(rng.choice(keys), rng.randint(-95, 95), 1.0)
                                                               for _ in range(12)] + [None, ["short"]]})
                        for _ in range(3)) for i in range(4)]
    states.append('{"time": 5, "states": [["cut off\n{"error": "limit reached"}')
    nested = [json.dumps({"data": [{"flight": {"icao": rng.choice(keys), "iata": "N1"}, "live": {
        "latitude": str(rng.randint(-95, 95)), "longitude": "2"}} for _ in range(9)]}) for _ in range(4)]
    flat = [json.dumps({"response": [{"hex": rng.choice([*keys, None, ""]), "lat": "3", "lng": str(rng.randint(-190, 190))}
                                     for _ in range(9)]}) for _ in range(3)]
    paths = {}
    for feed, texts in (("opensky", states), ("aviationstack", nested), ("airlabs", flat)):
        paths[feed] = os.path.join(base, feed)
        _put(paths[feed], texts, order(len(texts)))
    return paths


@pytest.mark.parametrize("order", [lambda n: list(range(n)), lambda n: list(range(n))[::-1]])
def test_stream_feeds_equals_batch_and_keeps_rejects(spark, order):
    base = _folder()
    paths = _feeds(base, order)
    feeds.stream_feeds(spark, paths, base + "/out", base + "/ckpt", run_ts=RUN, buckets=4)
    batch = realtime.snapshot_of_feeds([
        landing.extract_state_vectors(landing.ingest_state_vectors(spark, paths["opensky"], run_ts=RUN)),
        landing.ingest_nested_live(spark, paths["aviationstack"], run_ts=RUN),
        landing.ingest_flat_live(spark, paths["airlabs"], run_ts=RUN)])
    cols = [c for c in batch.columns if c != "arrival"]
    got = feeds.snapshot_table(spark, base + "/out")
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, batch.select(cols).collect()))
    assert got.filter("icao24 = ''").count() == 1  # rows without a key are one key, as in the reference
    bad = sorted((r.feed, os.path.basename(r.file), r.reason) for r in feeds.reject_table(spark, base + "/out").collect())
    assert bad == [("opensky", "f4.json", "broken"), ("opensky", "f4.json", "no records")]


def test_no_feed_rows_at_all(spark):
    base = _folder()
    _put(base + "/airlabs", ["{}\n"], [0])
    feeds.stream_feeds(spark, {"airlabs": base + "/airlabs"}, base + "/out", base + "/ckpt")
    assert feeds.snapshot_table(spark, base + "/out").count() == 0
    assert feeds.reject_table(spark, base + "/out").first().reason == "no records"


# ---------------------------------------------------------------- keyed table

def _rows(spark, pairs):
    return spark.createDataFrame(pairs, "icao24 string, extraction_time long, seq long")


def _files(base):
    out = {}
    for folder, _, names in os.walk(base + "/table"):
        for n in names:
            if n.startswith("part-"):
                out[os.path.join(folder, n)] = os.stat(os.path.join(folder, n)).st_mtime_ns
    return out


def test_upsert_rewrites_touched_buckets_only(spark):
    base = _folder()
    step = touched_upsert(base, sp.latest_per_key, "icao24", 8)
    step(_rows(spark, [(f"k{i}", 1, i) for i in range(60)]), 0)
    before = _files(base)
    step(_rows(spark, [("k3", 2, 100), ("k3", 0, 101)]), 1)
    after = _files(base)
    assert len(before) == 8 and len(set(before.items()) & set(after.items())) == 7
    rows = {r.icao24: r.seq for r in read_table(spark, base, _rows(spark, [("a", 1, 1)]).schema).collect()}
    assert rows == {**{f"k{i}": i for i in range(60)}, "k3": 100}
    step(_rows(spark, [("a", 1, 1)]).limit(0), 2)  # an empty batch changes nothing
    assert _files(base) == after


def test_upsert_survives_a_failure_between_its_two_writes(spark):
    base = _folder()
    step = touched_upsert(base, sp.latest_per_key, "icao24", 2)
    step(_rows(spark, [("a", 1, 1), ("b", 1, 2), ("c", 1, 3)]), 0)
    lost = spark.read.parquet(base + "/table").filter(F.col("icao24") == "a").first()[BUCKET]
    step(_rows(spark, [("a", 2, 4)]), 1)
    assert complete(spark, base + "/pending/epoch=1") and not os.path.exists(base + "/pending/epoch=0")
    # The bucket was deleted and its new files never arrived; the batch is run again.
    for name in os.listdir(f"{base}/table/{BUCKET}={lost}"):
        os.unlink(f"{base}/table/{BUCKET}={lost}/{name}")
    step(_rows(spark, [("a", 2, 4)]), 1)
    rows = sorted((r.icao24, r.seq) for r in read_table(spark, base, _rows(spark, [("a", 1, 1)]).schema).collect())
    assert rows == [("a", 4), ("b", 2), ("c", 3)]


# ---------------------------------------------------------------- alerts

def _told(times, until, silence):
    """Alerts of one source whose rows have these times, when all up to `until` are known."""
    out, times = [], sorted(times)
    for t, following in zip(times, [*times[1:], None], strict=True):
        end = t + silence
        if (following is None or following > end) and until > end:
            out.append(("stale", end, t))
            if following is not None and until >= following:
                out.append(("cleared", following, t))
    return out


def test_judged_does_not_depend_on_batches():
    rng = random.Random(8)
    for _ in range(300):
        silence, delay = 10, rng.choice([0, 15, 60])
        times = sorted(rng.sample(range(400), rng.randint(1, 25)))
        rows = sorted(times, key=lambda t: t + rng.random() * delay)  # out of order within the delay
        left, since, got, now, top = [], None, [], -1, -1
        while rows:
            n = rng.randint(1, 6)
            batch, rows = rows[:n], rows[n:]
            assert all(t > now for t in batch)
            alerts_, left, since = alerts.judged(alerts.merged(left + [(t, t) for t in batch], silence), since, now, silence)
            got += alerts_
            top = max([top, *batch])
            now = max(now, top - delay - 1)
            assert len(left) <= delay // silence + 8
        for now in (now + 5, now + 20, 1000):
            more, left, since = alerts.judged(left, since, now, silence)
            got += more
        assert got == _told(times, 1000, silence)


def test_silent_source_raises_one_alert_and_clears(spark):
    base = _folder()

    def at(text):
        return f"2024-01-01T{text}:00.000000"

    def rows(*pairs):
        return "\n".join(json.dumps({"seq": 1, "icao24": "A", "latitude": 1.0, "longitude": 1.0, "data_source": s,
                                     "extraction_time": at(t)}) for s, t in pairs)

    texts = [rows(("opensky", "10:00"), ("airlabs", "10:00")), rows(("opensky", "10:20"), ("airlabs", "10:30")),
             rows(("opensky", "10:45")), rows(("opensky", "11:10"), ("airlabs", "11:01")), rows(("opensky", "11:35")),
             rows(("opensky", "12:00"))]
    for order in ([0, 1, 2, 3, 4, 5], [1, 0, 3, 2, 4, 5]):
        out = _folder()
        _put(f"{base}/{order[0]}", texts, order)
        schema = sp.split_history(spark, f"{base}/{order[0]}", out + "/split", out + "/ckpt", close_after="20 minutes")
        assert bounded.rejected(spark, out + "/split", schema).count() == 0
        told = alerts.stale_alerts(bounded.accepted(spark, out + "/split", schema, 1))
        bounded.run_to_table(told, out + "/alerts", out + "/ckpt-alerts")
        got = sorted((r.data_source, r.alert, f"{r.at:%H:%M}", f"{r.silent_since:%H:%M}")
                     for r in spark.read.schema(told.schema).parquet(out + "/alerts").collect())
        # 30 minutes on the dot are no silence; airlabs is heard at 10:30 and 11:01, then no more.
        assert got == [("airlabs", "cleared", "11:01", "10:30"), ("airlabs", "stale", "11:00", "10:30"),
                       ("airlabs", "stale", "11:31", "11:01")]
