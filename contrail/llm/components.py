"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import saved

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)))
                 .first())


def component_labels(edges: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable, for every node of `edges` (a, b: long, any direction).

    Large-star links a node's larger neighbours to its smallest one,
    small-star does so with the smaller ones; both only move edges towards
    smaller nodes and keep the components, and the edge count never grows.
    Neighbour minima are partial aggregates; the join back to a hub's edges
    is an equi-join that adaptive execution can split. Every round is
    written to the shared folder.
    """
    now = saved(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .distinct(), "components")
    state = _state(now)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(now.join(least.withColumnRenamed("a", "b"), "b").select("a", F.col("m").alias("b")))
                 .distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                                 F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
                                               .alias("e")).select("e.*").filter("a <> b").distinct())
        now, before = saved(small, "components"), state
        state = _state(now)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
