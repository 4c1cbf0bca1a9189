"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as E
from contrail.sources.testdata import TABLES
from tests.conftest import SMALL

SLOW = {"train_delay_model", "score_delays", "model_metrics", "save_model", "insight_rules"}

#: The training-data operators have tests of their own in tests/llm/.
OWN_TESTS = {n for n in E.queries() if n == "pipeline" or re.match(r"op\d+_", n)}


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted(v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(str, r)))
    return [cols[i] for i in order], out


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL)
    c1, r1 = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    c2, r2 = _canon([d[0] for d in res.description], res.fetchall())
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql()) - SLOW - OWN_TESTS))
def test_rows_only_queries_run(spark, name):
    df = E.queries()[name](spark, SMALL)
    assert df.count() >= 0
    assert df.schema == E.queries()[name](spark, SMALL).schema


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["origin_airport", "destination_airport", "flight_count", "airline_count",
                          "avg_duration_minutes"]
