"""Stage tables: the fact tables the reports read, written once per session.

Files: of the partitions AQE leaves after the last join, of which there are
the more the larger the source files are, or by a rebalance on the day. The position tables are partitioned by day, so a trailing window
lists and reads the days it touches only.

The reference extracts, cleans and loads ``scheduled_flights`` and the
real-time tables, and every report then reads those tables. Here the same
tables are Parquet folders under the shared checkpoint dir, written by one
Spark job each (the six-way join for flights runs once, not once per
report) and sorted by event time within each file, so trailing-window
filters skip row groups by their min/max statistics. Writing them also
cuts the lineage: a lost executor costs a re-read of the stage table, not a
re-run of the joins.

A table is rebuilt when the source files change (fingerprint of paths,
sizes and modification times).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators import live, realtime, rollups
from contrail.session import scratch_path
from contrail.sources import testdata

_BUILT: dict[tuple, DataFrame] = {}
_AS_OF: dict[int, object] = {}

SOURCES = {
    "scheduled_flights": ("lineitem", "orders", "customer", "supplier", "part", "nation"),
    "realtime_history": ("events",),
    "realtime_snapshot": ("events",),
    "realtime_latest": ("events",),
    "airports": ("supplier", "nation", "region"),
}


def fingerprint(spark: SparkSession, sf_dir: str, tables) -> tuple:
    """Paths, lengths and modification times of all files of the source tables (a table is a file or a folder)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for t in tables:
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        files = p.getFileSystem(conf).listFiles(p, True)
        while files.hasNext():
            st = files.next()
            out.append((t, st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return tuple(sorted(out))


#: Source bytes to a join partition, and the size up to which AQE merges such partitions.
SOURCE_BYTES, JOINED_SIZE = 4 << 20, "16m"


@contextmanager
def _join_partitions(spark: SparkSession, source_bytes: int) -> Iterator[None]:
    """Joins run here have as many partitions as their sources ask for; then the session's settings are back.

    With a fixed number, or merged up to AQE's usual size, a task would sort
    more rows the larger the tables are.
    """
    partitions, size = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {k: spark.conf.get(k, None) for k in (partitions, size)}
    spark.conf.set(partitions, str(max(int(spark.conf.get(partitions)), -(-source_bytes // SOURCE_BYTES))))
    spark.conf.set(size, JOINED_SIZE)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def stage(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame],
          sort_cols: tuple[str, ...], day_of: str | None = None) -> DataFrame:
    """The table, built if it isn't; with ``day_of``, partitioned by the day of that column (``extraction_day``)."""
    files = fingerprint(spark, sf_dir, SOURCES[name])
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name, files)
    df = _BUILT.get(key)
    if df is None:
        path = scratch_path(spark, f"stage-{name}")
        # Rows are sorted in each file, so range filters skip row groups. A table by day is rebalanced on the day:
        # AQE splits a day that holds a third of the rows and merges small ones, to files of about the advisory
        # size. Others are written as the last join or aggregate leaves them, which AQE has sized and unskewed.
        df = build()
        if day_of:
            df = (df.withColumn(live.DAY, F.col(day_of).cast("date")).hint("rebalance", live.DAY)
                  .sortWithinPartitions(live.DAY, *sort_cols))
            df.write.partitionBy(live.DAY).parquet(path)
        else:
            with _join_partitions(spark, sum(length for _t, _path, length, _at in files)):
                df.sortWithinPartitions(*sort_cols).write.option("compression", "zstd").parquet(path)
        # one relation per stage table: later reports reuse its file listing
        df = _BUILT[key] = spark.read.parquet(path)
    return df


def scheduled_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, sf_dir, "scheduled_flights", lambda: testdata.flights(spark, sf_dir),
                 ("scheduled_departure",))


def realtime_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All valid positions, partitioned by day."""
    return stage(spark, sf_dir, "realtime_history",
                 lambda: realtime.history(testdata.positions(spark, sf_dir)), ("extraction_time",), "extraction_time")


def realtime_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, sf_dir, "realtime_snapshot",
                 lambda: realtime.snapshot(realtime_history(spark, sf_dir).drop(live.DAY)), ("icao24",))


def realtime_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per aircraft and 15-minute snapshot: the table the live views read."""
    return stage(spark, sf_dir, "realtime_latest",
                 lambda: realtime.latest_snapshots(realtime_history(spark, sf_dir).drop(live.DAY)), ("extraction_time",),
                 "extraction_time")


def realtime_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute partials of the live table, partitioned by day."""
    rows = realtime_latest(spark, sf_dir)
    key = (id(rows), "rollups")
    if key not in _BUILT:
        path = scratch_path(spark, "stage-realtime-rollups")
        partials = rollups.period_rollups(rows)
        rollups.add_days(partials, path)
        _BUILT[key] = rollups.read_days(spark, path, partials.schema)
    return _BUILT[key]


def route_moments(spark: SparkSession, sf_dir: str, since=None) -> DataFrame:
    """Daily moments of every route, from a day on. The last day is added by itself, as a daily job would."""
    rows = scheduled_flights(spark, sf_dir)
    key = (id(rows), "moments")
    if key not in _BUILT:
        path = scratch_path(spark, "stage-route-moments")
        last = rows.agg(F.max("scheduled_departure").cast("date")).first()[0]
        day = F.col("scheduled_departure").cast("date")
        rollups.add_days(rollups.route_moments(rows.filter(day < F.lit(last))), path)
        added = rollups.route_moments(rows.filter(day == F.lit(last)))
        rollups.add_days(added, path)
        _BUILT[key] = path, added.schema
    return rollups.read_days(spark, *_BUILT[key], since)


def as_of(spark: SparkSession, sf_dir: str):
    """Latest event time of the live table, looked up once per table."""
    df = realtime_latest(spark, sf_dir)
    key = id(df)
    if key not in _AS_OF:
        _AS_OF[key] = df.agg({"extraction_time": "max"}).first()[0]
    return _AS_OF[key]


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, sf_dir, "airports", lambda: testdata.airports(spark, sf_dir), ("code",))
