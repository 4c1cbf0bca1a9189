"""Position streams: the 15-minute poll re-aimed as Structured Streaming.

The landing zone is a folder of JSON files (one row per position). Streams
reuse the batch transforms of ``contrail.operators.realtime`` unchanged;
state is bounded by watermarks; checkpoints live under the shared
checkpoint dir, so a restarted query resumes where it stopped.

Event-time operators need ``timestamp`` (not ``timestamp_ntz``), so
``event_time`` is derived once as the UTC reading of the wall-clock value
(independent of the session zone); outputs go back to ``timestamp_ntz``.
"""

from __future__ import annotations

import datetime as _dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from contrail.functions.numeric import exact_units, mean_of_units
from contrail.functions.timefns import instant_of, ntz_of_instant, seconds_between, ts_literal
from contrail.operators import realtime
from contrail.operators.merge import dedupe_first
from contrail.streaming.upsert import BUCKETS, exists, file_system, touched_upsert

TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

#: Rows of one landing file when the caller does not say how many files to write.
LANDING_FILE_ROWS = 500_000
#: At least so many files, so that a poll never is one single batch.
MIN_LANDING_FILES = 4

POSITION_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("icao24", T.StringType()),
    T.StructField("callsign", T.StringType()), T.StructField("origin_country", T.StringType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("altitude", T.DoubleType()), T.StructField("speed", T.DoubleType()),
    T.StructField("heading", T.DoubleType()), T.StructField("on_ground", T.BooleanType()),
    T.StructField("airline", T.StringType()), T.StructField("aircraft_type", T.StringType()),
    T.StructField("data_source", T.StringType()), T.StructField("extraction_time", T.TimestampNTZType()),
])


def write_landing(positions: DataFrame, path: str, files: int | None = None) -> str:
    """Positions as JSON files, each holding one contiguous time range; by default as many as the rows need."""
    if files is None:
        files = max(MIN_LANDING_FILES, -(-positions.count() // LANDING_FILE_ROWS))
    (positions.repartitionByRange(files, "extraction_time").sortWithinPartitions("extraction_time", "seq")
     .write.mode("overwrite").option("timestampNTZFormat", TS_NTZ_FORMAT).json(path))
    _arrive_in_order(positions.sparkSession, path)
    return path


def _arrive_in_order(spark: SparkSession, path: str) -> None:
    """Give the files modification times a second apart in the order of their names, as if polled one after another."""
    fs, p = file_system(spark, path)
    files = sorted((s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-")),
                   key=lambda f: f.getName())
    now = int(time.time())
    for k, f in enumerate(files):
        fs.setTimes(f, (now - len(files) + k) * 1000, -1)


def read_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(POSITION_SCHEMA).option("timestampNTZFormat", TS_NTZ_FORMAT)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(landing)


def with_event_time(df: DataFrame, ts: str = "extraction_time") -> DataFrame:
    """``event_time``: the wall-clock ``timestamp_ntz`` read as UTC (zone-free)."""
    return df.withColumn("event_time", instant_of(ts))


def run_available_now(writer, timeout_s: float | None = None) -> StreamingQuery:
    """Start with ``availableNow`` (all files present now, in bounded batches) and wait."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination(timeout_s)
    if q.exception() is not None:
        raise q.exception()
    return q


def stream_positions(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                     max_files_per_trigger: int | None = 2) -> StreamingQuery:
    """Landing files -> history rows (the batch transforms) -> Parquet sink."""
    hist = realtime.history(read_stream(spark, landing, max_files_per_trigger))
    w = (hist.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", sink))
    return run_available_now(w)


def snapshot_start(period: str = "15 minutes"):
    """Start of the snapshot period that ``event_time`` falls into, as ``timestamp_ntz``."""
    return ntz_of_instant(F.window("event_time", period).start)


def first_per_snapshot(df: DataFrame, key: str = "icao24") -> DataFrame:
    """The first row in source order (rank, then arrival) per aircraft and snapshot period."""
    return dedupe_first(df, (key, "snapshot_start"), ("source_rank", "seq"))


def split_history(spark: SparkSession, landing: str, base: str, checkpoint: str,
                  max_files_per_trigger: int | None = 1, delay: str = "1 hour", close_after: str = "2 hours") -> T.StructType:
    """Landing files -> history rows, dealt to accepted and rejected ones under ``base``; their schema.

    The feed is then closed by a heartbeat ``close_after`` its newest time, so
    that the streams that read the accepted rows also emit their last windows.
    """
    from contrail.streaming import bounded
    hist = realtime.history(read_stream(spark, landing, max_files_per_trigger))
    bounded.split_late(hist, base, checkpoint, delay)
    newest = bounded.newest_time(spark, base)
    if newest is not None:
        gap = spark.range(1).select((F.lit(0) + F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(
            f"INTERVAL {close_after}") + F.expr(f"INTERVAL {delay}"))).alias("us")).first()["us"]
        bounded.write_heartbeat(spark, base, hist.schema, newest + _dt.timedelta(microseconds=gap))
    return hist.schema


def stream_dedupe_table(spark: SparkSession, base: str, schema: T.StructType, out: str, checkpoint: str,
                        delay: str = "1 hour", period: str = "15 minutes",
                        max_files_per_trigger: int | None = 1) -> DataFrame:
    """One row per aircraft and snapshot period of a split history, the first in source order.

    State expires with the period: each period's rows are emitted once, when
    it closes. Rejected rows are merged with what has been emitted when the
    table is read, so the result is that of the batch path for any order of
    the files; how many there are is for the caller to watch.
    """
    from contrail.streaming import bounded
    rows = bounded.accepted(spark, base, schema, max_files_per_trigger)
    emitted = bounded.first_per_period(rows, delay, period)
    bounded.run_to_table(emitted, out, checkpoint)
    first = spark.read.schema(emitted.schema).parquet(out)
    if not exists(spark, f"{base}/rejects"):
        return first  # each period has been emitted once, and nothing is to be added
    late = with_event_time(bounded.rejected(spark, base, schema)).withColumn("snapshot_start", snapshot_start(period))
    return first_per_snapshot(first.unionByName(late.drop("event_time")))


def stream_dedupe(stream: DataFrame, period: str = "15 minutes", delay: str = "15 minutes",
                  key: str = "icao24") -> DataFrame:
    """One row per aircraft per snapshot period, as a streaming operator with
    bounded state: the period start is the watermarked column, so dedupe state
    is dropped once the watermark passes it, and rows older than that are
    dropped and counted by Spark. Any one row of a period is kept. For files
    in no time order use :func:`stream_dedupe_table`."""
    df = with_event_time(stream).withColumn("snapshot_start", F.window("event_time", period).start)
    return (df.withWatermark("snapshot_start", delay)
            .dropDuplicates([key, "snapshot_start"]))


def latest_per_key(df: DataFrame, key: str = "icao24", order=("extraction_time", "seq")) -> DataFrame:
    """Newest row per key: ``max_by(struct(row), struct(order))`` (pre-aggregates map-side)."""
    rest = [c for c in df.columns if c != key]
    agg = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return agg.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def stream_snapshot(spark: SparkSession, landing: str, base: str, checkpoint: str,
                    max_files_per_trigger: int | None = 1, buckets: int = BUCKETS) -> StreamingQuery:
    """Keep a table of the newest position per aircraft; a batch rewrites the buckets it touches."""
    hist = realtime.history(read_stream(spark, landing, max_files_per_trigger))
    return run_available_now(hist.writeStream.foreachBatch(touched_upsert(base, latest_per_key, "icao24", buckets))
                             .option("checkpointLocation", checkpoint))


REGION_WINDOW_KEYS = ("window_start", "window_end", "region")
_WINDOW_SUMS = ("flight_count", "altitude_units", "altitude_count", "speed_sum", "speed_count",
                "quality_sum", "quality_count")


def region_window_sums(df: DataFrame, size: str = "1 hour", slide: str = "15 minutes") -> DataFrame:
    """Counts and sums per sliding window and region: sums of sums are the sums of the whole."""
    agg = (with_event_time(df).groupBy(F.window("event_time", size, slide).alias("w"), "region")
           .agg(F.count(F.lit(1)).alias("flight_count"),
                F.sum(exact_units("altitude")).alias("altitude_units"), F.count("altitude").alias("altitude_count"),
                F.sum("speed").alias("speed_sum"), F.count("speed").alias("speed_count"),
                F.sum("data_quality_score").alias("quality_sum"),
                F.count("data_quality_score").alias("quality_count")))
    return agg.select(ntz_of_instant(F.col("w.start")).alias("window_start"),
                      ntz_of_instant(F.col("w.end")).alias("window_end"), "region", *_WINDOW_SUMS)


def region_window_stats(sums: DataFrame) -> DataFrame:
    """Stats per window and region from partial sums (of any number of batches)."""
    total = sums.groupBy(*REGION_WINDOW_KEYS).agg(*(F.sum(c).alias(c) for c in _WINDOW_SUMS))
    return total.select(
        *REGION_WINDOW_KEYS, "flight_count",
        mean_of_units(F.col("altitude_units"), F.col("altitude_count")).alias("avg_altitude"),
        F.try_divide("speed_sum", "speed_count").alias("avg_speed"),
        F.try_divide("quality_sum", "quality_count").alias("avg_quality"))


def stream_region_windows(spark: SparkSession, base: str, schema: T.StructType, out: str, checkpoint: str,
                          delay: str = "1 hour", max_files_per_trigger: int | None = 1) -> DataFrame:
    """Trailing-window regional stats of a split history: the windows the stream has emitted, with rejects added."""
    from contrail.streaming import bounded
    emitted = bounded.region_windows(bounded.accepted(spark, base, schema, max_files_per_trigger), delay)
    bounded.run_to_table(emitted, out, checkpoint)
    late = region_window_sums(bounded.rejected(spark, base, schema))
    return region_window_stats(spark.read.schema(emitted.schema).parquet(out).unionByName(late))


def feed_alerts(last_update: DataFrame, as_of, min_quality: float = 70.0,
                max_silence_minutes: int = 30) -> DataFrame:
    """Per source: 'low_quality' when the average score is below the floor,
    'stale' when nothing arrived in the last ``max_silence_minutes``."""
    lo = ts_literal(as_of) - F.expr(f"INTERVAL {int(max_silence_minutes)} MINUTES")
    low = (last_update.filter(F.col("avg_quality") < min_quality)
           .select("data_source", F.lit("low_quality").alias("alert"), F.col("avg_quality").alias("value")))
    stale = (last_update.filter(F.col("last_update") < lo)
             .select("data_source", F.lit("stale").alias("alert"),
                     seconds_between("last_update", ts_literal(as_of)).alias("value")))
    return low.unionByName(stale)
