"""Posting-list search against brute force: recall, exact scores, order, odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import postings
from contrail.llm.common import table

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, vector array<float>"


def brute(rows, k=postings.K, every=postings.QUERY_EVERY):
    """{place of the query row: [(vec_id, score)]} over all usable rows."""
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    own = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if usable(v)]
    dims = max((len(v) for _, v in own), default=0)
    x = np.array([np.pad(v, (0, dims - len(v))) for _, v in own]).reshape(-1, dims)
    out = []
    for q, (i, _) in enumerate(own):
        if i is None or i % every:
            continue
        score = [((x[q] * y).sum(), j is None, j) for (j, _), y in zip(own, x, strict=True)]
        others = sorted(((-s, last, j if j is not None else 0) for p, (s, last, j) in enumerate(score) if p != q))
        out.append((i, [(None if last else j, -s) for s, last, j in others[:k]]))
    return sorted(out, key=repr)


def found(df):
    rows = {}
    for r in df.collect():
        rows.setdefault(r.query_id, []).append(r)
    return {q: [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] for q, got in rows.items()}


def test_recall_scores_and_order(spark):
    rows = [tuple(r) for r in table(spark, SF, "embeddings").select("vec_id", "embedding").collect()]
    got, want = found(postings.op11_balanced_postings(spark, SF)), dict(brute(rows))
    assert got.keys() == want.keys() and all(len(x) == 20 for x in got.values())
    vectors = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows}
    for q, near in got.items():
        assert all(s == pytest.approx((vectors[q] * vectors[i]).sum(), abs=1e-12) for i, s in near)
        assert near == sorted(near, key=lambda x: (-x[1], x[0])) and q not in dict(near)
    assert sum(len(dict(got[q]).keys() & dict(want[q]).keys()) for q in got) / (20 * len(got)) >= 0.95


def test_recall_with_many_lists_and_norms(spark, monkeypatch):
    """A beam much smaller than the number of lists, vectors of many lengths, a third of all rows in one place."""
    monkeypatch.setattr(postings.fit, "__defaults__", (8, 1 << 14, 1 << 17))
    monkeypatch.setattr(postings, "PAGE", 32)
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((40, 16))
    x = centers[rng.integers(0, 40, 3000)] + 0.5 * rng.standard_normal((3000, 16))
    x *= rng.uniform(0.5, 2, (3000, 1))
    x[:1000] = centers[0] + 0.01 * rng.standard_normal((1000, 16))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    got = found(postings.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, beam=64))
    want = dict(brute(rows))
    assert sum(len(dict(got[q]).keys() & dict(want[q]).keys()) for q in want) / (20 * len(want)) >= 0.9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (0, [0.0, 1.0, 0.0]), (20, [1.0, 0.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0, 0.0]),
            (4, [1.0, None, 0.0]), (5, [nan, 1.0, 0.0]), (6, [inf, 0.0, 0.0]), (None, [1.0, 1.0, 0.0]), (40, [0.5]),
            (60, None), (-20, [-1.0, 2.0, -0.0])] + [(100 + i, [1.0, 0.0, 0.0]) for i in range(45)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("entry", F.lit("own")).withColumn("query", F.lit(1))
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in
           postings.search(df, F.col("vec_id") % 20 == 0).collect()]
    want = [(q, k + 1, i, s) for q, near in brute(rows) for k, (i, s) in enumerate(near)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {q for q, *_ in got} == {0, 20, 40, -20, 100, 120, 140}


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (7, [2.0])], SCHEMA)
    asks = F.col("vec_id") % 20 == 0
    assert [tuple(r) for r in postings.search(df, asks).collect()] == [(0, 1, 7, 2.0)]
    assert postings.search(df.filter("vec_id = 0"), asks).count() == 0
    assert postings.search(df.limit(0), asks).count() == 0


def test_parts_are_balanced_and_the_graph_finds_the_nearest():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.standard_normal((900, 8)), 5 + 0.01 * rng.standard_normal((600, 8))]).astype(np.float32)
    centroids = postings.bisect(points, 75)
    assert len(centroids) == 75
    sizes = np.bincount(postings._squared(points, centroids).argmin(axis=1), minlength=75)
    assert sizes.max() <= 120
    graph = postings.Graph.of(centroids)
    ids, far = graph.nearest(points[:50], beam=16)
    exact = np.argsort(postings._squared(points[:50], centroids), axis=1)[:, :8]
    assert np.mean([len(set(a[:8]) & set(b)) / 8 for a, b in zip(ids.tolist(), exact.tolist(), strict=True)]) > 0.95
    assert (np.diff(far, axis=1) >= 0).all()
    every, _ = graph.nearest(points[:5], beam=75)
    assert all(sorted(x) == list(range(75)) for x in every.tolist())  # the ring reaches all
