"""Event-time operators whose state is bounded, and that lose no row.

A stream with rows out of order is split first: a row that is no more than
``delay`` behind the newest time of the batches before it is accepted, any
other goes to a reject table, where it can be counted and added later. What
is accepted is a stream of its own; on that, Spark's watermark of the same
delay never drops a row, and its state store holds open windows only.
"""

from __future__ import annotations

import datetime as _dt
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from contrail.functions.numeric import exact_units
from contrail.functions.timefns import instant_of, ntz_of_instant, ts_literal
from contrail.streaming.positions import REGION_WINDOW_KEYS, run_available_now
from contrail.streaming.upsert import complete, exists, file_system, forget

TIME = "extraction_time"
DELAY = "1 hour"
#: Rows of a file of accepted rows, about; so many tasks can read a batch.
FILE_ROWS = 1 << 15


def _microseconds(interval: str) -> Column:
    return F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {interval}"))


def split_late(stream: DataFrame, base: str, checkpoint: str, delay: str = DELAY) -> StreamingQuery:
    """Deal the rows of `stream` to ``base/accepted`` and ``base/rejects``, a folder for each batch.

    Between batches one number is carried, the newest time so far. A batch
    that is run again keeps folders that are complete.
    """
    spark = stream.sparkSession

    def newest(epoch_id: int) -> int | None:
        folder = f"{base}/newest/epoch={epoch_id}"
        return spark.read.schema("us long").parquet(folder).first()["us"] if exists(spark, folder) else None

    def fn(batch: DataFrame, epoch_id: int) -> None:
        before = newest(epoch_id - 1)
        us = F.unix_micros(instant_of(TIME))
        late = F.lit(False) if before is None else F.coalesce(us <= F.lit(before) - _microseconds(delay), F.lit(False))
        rows = batch.withColumn("__late", late).persist()
        seen = rows.agg(F.greatest(F.max(us), F.lit(before).cast("long")).alias("us"),
                        F.count_if(~F.col("__late")).alias("accepted"), F.count_if("__late").alias("late")).first()
        folder = f"{base}/accepted/epoch={epoch_id:010d}"
        if not complete(spark, folder):
            (rows.filter(~F.col("__late")).drop("__late").repartitionByRange(max(1, -(-seen["accepted"] // FILE_ROWS)), TIME)
             .write.mode("overwrite").parquet(folder))
        _in_order(spark, folder)
        folder = f"{base}/rejects/epoch={epoch_id:010d}"
        if seen["late"] and not complete(spark, folder):
            rows.filter("__late").drop("__late").write.mode("overwrite").parquet(folder)
        (spark.range(1).select(F.lit(seen["us"]).cast("long").alias("us")).coalesce(1)
         .write.mode("overwrite").parquet(f"{base}/newest/epoch={epoch_id}"))
        forget(spark, f"{base}/newest/epoch={epoch_id - 2}")
        rows.unpersist()

    return run_available_now(stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint))


def _in_order(spark: SparkSession, folder: str) -> None:
    """Modification times of the files of one batch a millisecond apart, in the order of their names."""
    fs, p = file_system(spark, folder)
    now = int(time.time() * 1000)
    files = (s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-"))
    for k, f in enumerate(sorted(files, key=lambda f: f.getName())):
        fs.setTimes(f, now + k, -1)


def _most_files(spark: SparkSession, base: str) -> int:
    """Files of the batch that has most of them."""
    fs, p = file_system(spark, f"{base}/accepted/epoch=*/part-*")
    folders = [str(s.getPath().getParent()) for s in fs.globStatus(p) or []]
    return max(map(folders.count, set(folders)), default=1)


def accepted(spark: SparkSession, base: str, schema: T.StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """The accepted rows as a stream, in the order of their batches.

    ``max_files_per_trigger`` counts batches of the split, which has one for
    each file or so of the feed; a batch may be several files here.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger * _most_files(spark, base))
    return reader.parquet(f"{base}/accepted/epoch=*")


def rejected(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    if not exists(spark, f"{base}/rejects"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{base}/rejects")


def newest_time(spark: SparkSession, base: str) -> _dt.datetime | None:
    """The newest time of all batches so far (at most two one-row folders are read)."""
    rows = spark.read.schema("us long").option("recursiveFileLookup", True).parquet(f"{base}/newest")
    us = rows.agg(F.max("us")).first()[0]
    return None if us is None else _dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=us)


def write_heartbeat(spark: SparkSession, base: str, schema: T.StructType, at: _dt.datetime) -> None:
    """Tell the streams after the split that time has come to `at`: a row with nothing but a time.

    Without it the last windows of a feed that has fallen silent stay open.
    """
    row = spark.range(1).select(*((ts_literal(at) if f.name == TIME else F.lit(None)).cast(f.dataType).alias(f.name)
                                  for f in schema))
    row.write.mode("overwrite").parquet(f"{base}/accepted/epoch=heartbeat-{at:%Y%m%d%H%M%S}")


def _timed(stream: DataFrame, delay: str) -> DataFrame:
    return stream.withColumn("event_time", instant_of(TIME)).withWatermark("event_time", delay)


def region_windows(stream: DataFrame, delay: str = DELAY, size: str = "1 hour", slide: str = "15 minutes") -> DataFrame:
    """Counts and sums per sliding window and region, once for each window when it closes (append mode)."""
    # Counts leave out heartbeats, which have no source.
    own = F.col("data_source").isNotNull()
    agg = (_timed(stream, delay).groupBy(F.window("event_time", size, slide).alias("w"), "region")
           .agg(F.count_if(own).alias("flight_count"),
                F.sum(exact_units("altitude")).alias("altitude_units"), F.count("altitude").alias("altitude_count"),
                F.sum("speed").alias("speed_sum"), F.count("speed").alias("speed_count"),
                F.sum("data_quality_score").alias("quality_sum"), F.count("data_quality_score").alias("quality_count")))
    return agg.filter("flight_count > 0").select(
        ntz_of_instant(F.col("w.start")).alias("window_start"), ntz_of_instant(F.col("w.end")).alias("window_end"), "region",
        *(c for c in agg.columns if c not in ("w", *REGION_WINDOW_KEYS)))


def first_per_period(stream: DataFrame, delay: str = DELAY, period: str = "15 minutes", key: str = "icao24") -> DataFrame:
    """One row per key and period, the first in source order, when the period closes (append mode).

    A state row for each key of an open period; closed periods leave the store.
    """
    rest = [c for c in stream.columns if c != key]
    agg = (_timed(stream, delay).groupBy(F.window("event_time", period).alias("w"), key)
           .agg(F.min_by(F.struct(*rest), F.struct("source_rank", "seq")).alias("first")))
    return (agg.filter("first.data_source IS NOT NULL")  # a heartbeat has none
            .select(*(F.col(key) if c == key else F.col(f"first.{c}").alias(c) for c in stream.columns),
                    ntz_of_instant(F.col("w.start")).alias("snapshot_start")))


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what the operator emits to a Parquet table (Spark's exactly-once file sink)."""
    return run_available_now(stream.writeStream.format("parquet").outputMode("append")
                             .option("checkpointLocation", checkpoint).option("path", path))
