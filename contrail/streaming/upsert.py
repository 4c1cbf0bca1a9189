"""Keyed tables that a stream keeps up to date by rewriting only what a batch touches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "bucket"
#: Parts a table is kept in. At scale: table size / about 128 MB, so that a batch with few keys rewrites little.
BUCKETS = 16


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a path in whatever store it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return bool(fs.exists(p))


def complete(spark: SparkSession, folder: str) -> bool:
    """Whether the job that wrote the folder has committed."""
    return exists(spark, f"{folder}/_SUCCESS")


def forget(spark: SparkSession, folder: str) -> None:
    """Remove a folder of this library's own that no later batch reads."""
    fs, p = file_system(spark, folder)
    fs.delete(p, True)


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def read_table(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """The table under ``base`` (empty before the first batch); `schema` without the bucket."""
    if not exists(spark, f"{base}/table"):
        return spark.createDataFrame([], schema)
    full = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    return spark.read.schema(full).parquet(f"{base}/table").select(*schema.names)


def touched_upsert(base: str, reduce: Callable[[DataFrame], DataFrame], key: str, buckets: int = BUCKETS):
    """``foreachBatch`` body: the table becomes ``reduce(table + batch)``, bucket by bucket.

    ``reduce`` keeps one row per key, whatever it has kept before. The table
    is partitioned by a hash of the key. A batch reads only the buckets its
    keys fall into (partition pruning) and replaces only these (dynamic
    partition overwrite); files of other buckets stay as they are.

    The new buckets are complete under ``pending`` before the table changes.
    A batch that is run again after a failure in between replaces the buckets
    once more from there, so nothing is lost or counted twice.
    """
    table = f"{base}/table"

    def fn(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        pending = f"{base}/pending/epoch={epoch_id}"
        if not complete(spark, pending):
            new = with_bucket(reduce(batch), key, buckets).persist()
            touched = [r[0] for r in new.select(BUCKET).distinct().collect()]  # at most `buckets` numbers
            merged = new
            if touched and exists(spark, table):
                old = spark.read.schema(new.schema).parquet(table).filter(F.col(BUCKET).isin(touched))
                merged = with_bucket(reduce(old.unionByName(new).drop(BUCKET)), key, buckets)
            merged.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(pending)
            schema = new.schema
            new.unpersist()
        else:
            schema = with_bucket(batch.limit(0), key, buckets).schema
        ready = spark.read.schema(schema).parquet(pending)
        if not ready.isEmpty():
            (ready.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(BUCKET).parquet(table))
        forget(spark, f"{base}/pending/epoch={epoch_id - 1}")

    return fn
