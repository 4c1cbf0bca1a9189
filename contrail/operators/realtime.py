"""Real-time position pipeline: extract filters, history, snapshot, reports.

``history``  = every valid position, standardised, with region and score
               (the append-only table a stream feeds).
``snapshot`` = one row per aircraft, first in source order (the table the
               reference replaces every 15 minutes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions import geo
from contrail.functions.numeric import exact_avg
from contrail.functions.timefns import instant_of, ntz_of_instant, ts_literal
from contrail.operators import cleaning
from contrail.operators.merge import SOURCE_ORDER, dedupe_first, merge_sources, source_rank

# Fixed values that must equal the reference: report thresholds.
HIGH_QUALITY_SCORE = 80
HIGH_ALTITUDE = 30000
SPEED_OF_SOUND = 343  # the reference compares raw speed with 343 (m/s); units as delivered

HISTORY_COLUMNS = ("seq",) + tuple(cleaning.POSITION_TYPES) + (
    "region", "is_airborne", "has_position", "has_speed", "has_altitude",
    "data_quality_score", "source_rank")


def extract_filter(df: DataFrame) -> DataFrame:
    """Per-source extract rules: coordinates present and in range; the
    state-vector source also needs its aircraft key."""
    keyed = (F.col("data_source") != "opensky") | F.col("icao24").isNotNull()
    return (df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & keyed)
              .filter(geo.coordinates_valid()))


def history(positions: DataFrame) -> DataFrame:
    """All valid positions, harmonised, cleaned, flagged, scored. Narrow only."""
    df = (positions.transform(extract_filter)
                   .transform(cleaning.standardize_positions)
                   .transform(cleaning.add_region)
                   .transform(cleaning.add_quality_score)
                   .withColumn("source_rank", source_rank()))
    return df.select(*HISTORY_COLUMNS)


def snapshot(hist: DataFrame) -> DataFrame:
    """One row per icao24, the first in source order then arrival order."""
    return dedupe_first(hist, "icao24", ("source_rank", "seq"))


def rows_of_feeds(feeds) -> DataFrame:
    """Extracted feeds (common columns, ``arrival``) -> standardised, scored rows of all sources."""
    merged = merge_sources(feeds).drop("region")
    return (merged.transform(cleaning.standardize_positions).transform(cleaning.add_region)
            .transform(cleaning.add_quality_score))


def snapshot_of_feeds(feeds, keep_null_keys: bool = False) -> DataFrame:
    """Extracted feeds -> one standardised, scored row per aircraft.

    The first row in source order, then in order of arrival, stays. Rows
    without a key collapse like those of any key (null and '' are a key each),
    as in the reference; with ``keep_null_keys`` they all stay.
    """
    return dedupe_first(rows_of_feeds(feeds), "icao24", ("source_rank", "arrival"), keep_null_keys=keep_null_keys)


def latest_snapshots(hist: DataFrame, period: str = "15 minutes", key: str = "icao24") -> DataFrame:
    """History -> one row per aircraft and snapshot period: what the table held at the end of each period."""
    start = ntz_of_instant(F.window(instant_of("extraction_time"), period).start)
    return dedupe_first(hist.withColumn("_period", start), (key, "_period"), ("source_rank", "seq")).drop("_period")


def _count_distinct_with_null(c: str) -> Column:
    """pandas ``len(s.unique())``: null counts as one more value."""
    return (F.countDistinct(c) + F.max(F.col(c).isNull().cast("int"))).cast("long")


def realtime_summary(snap: DataFrame) -> DataFrame:
    """The merge summary in one row, with the flights of every source and region that occurs.

    The counts by value come from one grouping by (source, region), whose
    groups' sums are the groups of either; null values aren't counted.
    """
    pairs = snap.groupBy("data_source", "region").agg(F.count(F.lit(1)).alias("n"))

    def counts(c: str) -> DataFrame:
        entries = F.collect_list(F.struct(c, "n"))
        return (pairs.filter(F.col(c).isNotNull()).groupBy(c).agg(F.sum("n").alias("n"))
                .agg(F.map_from_entries(entries).alias("counts")))

    whole = snap.agg(
        F.count(F.lit(1)).alias("total_flights"),
        _count_distinct_with_null("origin_country").alias("countries"),
        F.countDistinct("airline").cast("long").alias("airlines"),
        F.countDistinct("aircraft_type").cast("long").alias("aircraft_types"),
        F.avg("data_quality_score").alias("avg_quality_score"),
        F.count_if(F.col("data_quality_score") >= HIGH_QUALITY_SCORE).alias("high_quality_flights"),
        F.count_if(F.col("has_position")).alias("with_position"),
        F.count_if(F.col("has_speed")).alias("with_speed"),
        F.count_if(F.col("has_altitude")).alias("with_altitude"),
    )
    # One row each: scalar subqueries, no join.
    return whole.select(counts("data_source").scalar().alias("by_source"), counts("region").scalar().alias("by_region"), "*")


def rt_global_overview(snap: DataFrame) -> DataFrame:
    per_source = [F.count_if(F.col("data_source") == s).alias(f"flights_{s}") for s in SOURCE_ORDER]
    return snap.agg(
        F.count(F.lit(1)).alias("total_flights"),
        _count_distinct_with_null("origin_country").alias("countries_active"),
        _count_distinct_with_null("airline").alias("airlines_active"),
        *per_source,
    )


def value_counts(df: DataFrame, col: str, out: str = "flight_count", top: int | None = None) -> DataFrame:
    """pandas ``value_counts``: nulls dropped, count desc (ties by value)."""
    vc = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(out))
    vc = vc.orderBy(F.col(out).desc(), F.col(col).asc())
    return vc.limit(top) if top else vc


def rt_region_distribution(snap: DataFrame) -> DataFrame:
    return value_counts(snap, "region")


def rt_altitude_stats(snap: DataFrame, threshold: float = HIGH_ALTITUDE) -> DataFrame:
    return snap.agg(exact_avg("altitude").alias("avg_altitude"),
                    F.max("altitude").alias("max_altitude"),
                    F.count_if(F.col("altitude") > threshold).alias("flights_above_30k"))


def rt_speed_stats(snap: DataFrame, threshold: float = SPEED_OF_SOUND) -> DataFrame:
    return snap.agg(F.avg("speed").alias("avg_speed"),
                    F.max("speed").alias("max_speed"),
                    F.count_if(F.col("speed") > threshold).alias("supersonic_flights"))


def rt_quality_stats(snap: DataFrame, threshold: int = HIGH_QUALITY_SCORE) -> DataFrame:
    return snap.agg(
        F.avg("data_quality_score").alias("avg_quality_score"),
        F.try_divide(F.count_if(F.col("data_quality_score") >= threshold).cast("double") * 100.0,
                     F.count(F.lit(1)).cast("double")).alias("high_quality_percentage"))


def rt_top_airlines(snap: DataFrame, n: int = 10) -> DataFrame:
    return value_counts(snap, "airline", top=n)


def rt_top_countries(snap: DataFrame, n: int = 10) -> DataFrame:
    return value_counts(snap, "origin_country", top=n)


def source_extract_stats(positions: DataFrame) -> DataFrame:
    """Per source after its extract filter: rows and countries (null counts)."""
    return (positions.transform(extract_filter).groupBy("data_source")
            .agg(F.count(F.lit(1)).alias("flights"),
                 _count_distinct_with_null("origin_country").alias("countries")))


def source_counts(df: DataFrame) -> DataFrame:
    return value_counts(df, "data_source")


def source_last_update(hist: DataFrame) -> DataFrame:
    return (hist.groupBy("data_source")
            .agg(F.count(F.lit(1)).alias("flights"),
                 F.avg("data_quality_score").alias("avg_quality"),
                 F.max("extraction_time").alias("last_update")))


def latest_flights(hist: DataFrame, n: int = 10) -> DataFrame:
    """Newest rows (top-k: TakeOrderedAndProject, no full sort)."""
    return (hist.orderBy(F.col("extraction_time").desc(), F.col("seq").desc())
            .limit(n)
            .select("callsign", "origin_country", "region", "data_source", "extraction_time"))


def load_metadata(snap: DataFrame, table_name: str = "realtime_global_flights",
                  run_ts=None) -> DataFrame:
    """One audit row per load: count, per-source counts (map), time, average score.

    Two-level aggregate: per source first (partial aggregation, tiny
    output), then one row; no join of one-row frames.
    """
    ts = (ts_literal(run_ts) if run_ts is not None
          else F.current_timestamp().cast("timestamp_ntz"))
    per_source = snap.groupBy("data_source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("data_quality_score").alias("s"),
        F.count("data_quality_score").alias("c"))
    return per_source.agg(
        F.sum("n").alias("record_count"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("data_source", "n")))).alias("data_sources"),
        F.try_divide(F.sum("s").cast("double"), F.sum("c").cast("double")).alias("data_quality_avg"),
    ).select(F.lit(table_name).alias("table_name"), "record_count", "data_sources",
             ts.alias("last_updated"), "data_quality_avg")
