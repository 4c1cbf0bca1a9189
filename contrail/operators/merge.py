"""Union of position sources and ordered, skew-safe de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.text import strip_ws

# Fixed values that must equal the reference: source precedence.
SOURCE_ORDER = ("opensky", "aviationstack", "airlabs")


def source_rank(col: str = "data_source"):
    expr = None
    for i, name in enumerate(SOURCE_ORDER):
        cond = F.col(col) == name
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(len(SOURCE_ORDER)))


def merge_sources(frames: Sequence[DataFrame], rank_col: str = "source_rank") -> DataFrame:
    """Union by column name in the fixed source order; columns missing in one
    source are null. ``source_rank`` records the precedence for dedupe."""
    frames = [f for f in frames if f is not None]
    if not frames:
        raise ValueError("merge_sources needs at least one frame")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.withColumn(rank_col, source_rank())


def dedupe_first(df: DataFrame, key: str | Sequence[str] = "icao24",
                 order: Sequence[str] = ("source_rank", "seq"), keep_null_keys: bool = False) -> DataFrame:
    """Keep one row per key: the first by ``order`` (ascending).

    ``min_by(struct(row), struct(order))`` is a declarative aggregate, so
    Spark pre-aggregates in every map task before the shuffle: a key holding a
    third of the rows costs one row per task on the wire, not a third of the
    data in one reducer. Null keys form one group, like pandas; with
    ``keep_null_keys`` rows with a null or blank key pass through instead (such
    a key identifies nothing, so those rows are not duplicates).
    """
    keys = [key] if isinstance(key, str) else list(key)
    if keep_null_keys:
        any_null = F.lit(False)
        for k in keys:
            any_null = any_null | F.col(k).isNull() | F.coalesce(strip_ws(F.col(k).cast("string")) == "", F.lit(False))
        kept = dedupe_first(df.filter(~any_null), keys, order)
        return kept.unionByName(df.filter(any_null))
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order])
    agg = (df.groupBy(*keys)
             .agg(F.min_by(F.struct(*[F.col(c) for c in rest]), ordering).alias("_first")))
    return agg.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest]).select(*df.columns)


def rank_by_quality(df: DataFrame, score: str = "data_quality_score",
                    ts: str = "extraction_time", tiebreak: Sequence[str] = ("icao24",)) -> DataFrame:
    """Best rows first. A total sort: only worth it in front of a limit."""
    return df.orderBy(F.col(score).desc(), F.col(ts).desc(), *[F.col(c).asc() for c in tiebreak])
