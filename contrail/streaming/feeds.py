"""The raw position feeds as streams: documents of three formats in, one row per aircraft out.

Each feed is a folder into which its poller puts JSON documents. Three file
streams are united into one query, so a batch holds what has come from all of
them; it is exploded, extracted, standardised and scored by the functions of
the batch path, and merged into the keyed snapshot table. Documents that can't
be parsed, or hold no list of records, go to a reject table with the reason,
their file and their text.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from contrail.operators import realtime
from contrail.operators.merge import dedupe_first
from contrail.sources import landing
from contrail.streaming.upsert import BUCKETS, complete, exists, read_table, touched_upsert

CORRUPT = "_corrupt_record"
#: Feed -> (schema of a document, the field with its list of records, extraction of its rows).
FEEDS = {
    "opensky": (landing.STATE_SNAPSHOT_SCHEMA, "states",
                lambda raw, run_ts: landing.extract_state_vectors(landing.state_vectors(raw, run_ts))),
    "aviationstack": (landing.NESTED_LIVE_SCHEMA, "data", landing.nested_live),
    "airlabs": (landing.FLAT_LIVE_SCHEMA, "response", landing.flat_live),
}
REJECT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("feed", "file", "reason", "document")])


def read_documents(spark: SparkSession, feed: str, path: str, max_files_per_trigger: int | None) -> DataFrame:
    """Documents of one feed as they come, unparsable ones with their text in ``_corrupt_record``."""
    schema = T.StructType([*FEEDS[feed][0].fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.readStream.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path).select("*", F.lit(feed).alias("feed"), F.col("_metadata.file_path").alias("file"),
                                    F.col("_metadata.file_block_start").alias("start"))


def united(spark: SparkSession, paths: dict[str, str], max_files_per_trigger: int | None = 1) -> DataFrame:
    """One stream of the documents of all feeds; a feed's own fields are null in the others' documents."""
    out = None
    for feed, path in paths.items():
        one = read_documents(spark, feed, path, max_files_per_trigger)
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def with_place(batch: DataFrame) -> DataFrame:
    """``_doc``: the place of each document in its feed, in the order of the files and of the lines in them."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    return batch.withColumn("_doc", F.struct("file", "start", row.alias("row")))


def rejects(docs: DataFrame) -> DataFrame:
    """Documents without records to read, with the reason."""
    found = F.coalesce(*(F.when(F.col("feed") == feed, F.col(field).isNotNull())
                         for feed, (_, field, _) in FEEDS.items() if field in docs.columns))
    reason = F.when(F.col(CORRUPT).isNotNull(), "broken").when(~found, "no records")
    return docs.withColumn("reason", reason).filter("reason IS NOT NULL").select(
        "feed", "file", "reason", F.col(CORRUPT).alias("document"))


def extracted(docs: DataFrame, run_ts: _dt.datetime | None) -> DataFrame:
    """Standardised, scored rows of the readable documents of a batch."""
    good = docs.filter(F.col(CORRUPT).isNull())
    feeds = [extract(good.filter(F.col("feed") == feed), run_ts)
             for feed, (_, field, extract) in FEEDS.items() if field in docs.columns]
    return realtime.rows_of_feeds(feeds)


def first_of_feeds(rows: DataFrame) -> DataFrame:
    """The first row of each aircraft in source order, then in order of arrival."""
    return dedupe_first(rows, "icao24", ("source_rank", "arrival"))


def stream_feeds(spark: SparkSession, paths: dict[str, str], base: str, checkpoint: str,
                 run_ts: _dt.datetime | None = None, max_files_per_trigger: int | None = 1,
                 buckets: int = BUCKETS) -> StreamingQuery:
    """Keep ``base/snapshot`` (one row per aircraft) and ``base/rejects`` up to date with the feeds' documents.

    Whatever order the files come in, and however they are dealt over
    batches, the table ends up as the batch path makes it of all files.
    """
    from contrail.streaming.positions import run_available_now

    upsert = touched_upsert(f"{base}/snapshot", first_of_feeds, "icao24", buckets)

    def fn(batch: DataFrame, epoch_id: int) -> None:
        docs = with_place(batch).persist()
        bad = f"{base}/rejects/epoch={epoch_id}"
        if not complete(spark, bad):
            rejects(docs).write.mode("overwrite").parquet(bad)
        upsert(extracted(docs, run_ts), epoch_id)
        docs.unpersist()

    return run_available_now(united(spark, paths, max_files_per_trigger).writeStream.foreachBatch(fn)
                             .option("checkpointLocation", checkpoint))


def snapshot_table(spark: SparkSession, base: str) -> DataFrame:
    """The snapshot as it is now."""
    docs = spark.createDataFrame([], T.StructType([f for schema, *_ in FEEDS.values() for f in schema.fields]))
    empty = docs.select("*", *(F.lit(None).cast("string").alias(c) for c in (CORRUPT, "feed", "file")),
                        F.lit(0).cast("long").alias("start"))
    return read_table(spark, f"{base}/snapshot", first_of_feeds(extracted(with_place(empty), None)).schema)


def reject_table(spark: SparkSession, base: str) -> DataFrame:
    if not exists(spark, f"{base}/rejects"):
        return spark.createDataFrame([], REJECT_SCHEMA)
    return spark.read.schema(REJECT_SCHEMA).option("recursiveFileLookup", True).parquet(f"{base}/rejects")
