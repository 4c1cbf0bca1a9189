"""Rendezvous (highest-random-weight) sharding of rows by a stable key.

Every shard s draws a pseudo-random number u in (0, 1) from
``xxhash64(key, s)``; the row goes to the shard with the smallest
``-ln(u) / weight(s)``. The draw of a shard does not depend on the other
shards, so adding a shard takes rows only into the new one, and a shard's
share of the rows is in proportion to its weight.

Everything is DataFrame functions: the assignment is one narrow projection,
the text never enters a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from contrail.llm.common import saved, table

SHARDS = 40
ROW_OVERHEAD_BYTES = 16
#: Mean rows of one (shard, bucket) group, the unit that is numbered in one task.
ROWS_PER_BUCKET = 4_000


def _draw(key: Column, shard: int, weight: float) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double") + 0.5) / float(2**53)
    return -F.log(u) / F.lit(float(weight))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Index of the winning shard; a null key hashes like any other value."""
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("weights must be positive and not empty")
    draws = [F.struct(_draw(key, s, w).alias("cost"), F.lit(s).alias("shard")) for s, w in enumerate(weights)]
    return (F.least(*draws) if len(draws) > 1 else draws[0])["shard"]


def bucket_count(n_rows: int, n_shards: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(1, math.ceil(n_rows / (n_shards * rows_per_bucket)))


def shard_rows(df: DataFrame, key: str, weights: Sequence[float], *, grown_weight: float | None = None,
               n_buckets: int = 1) -> DataFrame:
    """`df` with shard, slot and, if `grown_weight` is given, grown_shard.

    slot numbers the rows of a shard from 0 without gaps. Rows of one shard
    are spread over `n_buckets` buckets by a hash of all their columns, so a
    key with very many rows fills all buckets of its shard; each bucket is
    numbered in its own task and starts where the bucket before it ends
    (prefix sums over the bucket counts, a table of shards x buckets rows).
    Inside a bucket rows are ordered by key, then by the hash. An empty table
    gives an empty table. Columns named like the new ones are replaced.
    """
    k = F.col(key)
    ties = [f.name for f in df.schema if not isinstance(f.dataType, MapType)]

    def placed(rows: DataFrame) -> DataFrame:
        return (rows.withColumn("shard", shard_of(k, weights))
                .withColumn("__bucket", F.pmod(F.xxhash64(*ties, F.lit("bucket")), F.lit(n_buckets)).cast("int")))

    by_bucket = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed(df).groupBy("shard", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
              .select("shard", "__bucket", F.coalesce(F.sum("__n").over(by_bucket), F.lit(0)).alias("__start")))
    rows = placed(df)
    if grown_weight is not None:
        grown = shard_of(k, [*weights, grown_weight])
        rows = rows.withColumn("grown_shard", grown)
    within = Window.partitionBy("shard", "__bucket").orderBy(k, F.xxhash64(*ties))
    out = (rows.join(starts, ["shard", "__bucket"])
           .withColumn("slot", F.col("__start") + F.row_number().over(within).cast("long") - 1))
    return out.drop("__bucket", "__start")


def shard_documents(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """Digest of every document with its shard under `n_shards` equal weights.

    size is the UTF-8 length of the text plus 16 (a null text: 16), text_crc32
    its unsigned CRC-32 (a null or empty text: 0).
    """
    slim = saved(docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_OVERHEAD_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32")), "shard-digests")
    out = shard_rows(slim, "doc_id", [1.0] * n_shards, grown_weight=1.0,
                     n_buckets=bucket_count(slim.count(), n_shards))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op8_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
