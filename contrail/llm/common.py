"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo `modulus` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Rows a Python task gets at once: whole texts are in them, some of them very long.
ROWS_PER_BATCH = 1000


def map_batches(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow(fn, schema)`` with batches of at most ROWS_PER_BATCH rows.

    The size is a setting of the session; it is lowered if it is larger. In
    local mode Python workers are told where this package is; on a cluster it
    has to be installed or shipped (``--py-files``) like any other.
    """
    context = df.sparkSession.sparkContext
    if context.master.startswith("local") and not context.master.startswith("local-cluster"):
        paths = [p for p in context.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if PACKAGE_ROOT not in paths:
            context.environment["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= ROWS_PER_BATCH:
        conf.set(key, str(ROWS_PER_BATCH))
    return df.mapInArrow(fn, schema)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to a new folder under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage (a lost executor costs a re-read) and keeps costly
    columns from being computed by every reader.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
