"""Every operator and stage on odd rows, on rows with clashing columns, and on an empty table."""

import pytest

import corpus_pipeline
from contrail.llm import (
    decontamination,
    language,
    line_windows,
    lm,
    order_minhash,
    packing,
    quality,
    secrets,
    sharding,
    simhash,
)

from .helpers import CLASHING, documents, odd_documents

BENCHMARK = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, None), (3, ""), (None, "too few"),
             (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")]
LABELS = [(1, 1), (2, 1), (3, 0), (6, 0), (None, 1), (7, None), (12, 1), (12, 0), (10, 0)]


def _benchmark(spark, rows=None):
    return spark.createDataFrame(BENCHMARK if rows is None else rows, "item_id long, text string")


def _labels(spark, rows=None):
    return spark.createDataFrame(LABELS if rows is None else rows, "doc_id long, quality int")


OPERATORS = {
    "order_minhash": lambda s, d, e: order_minhash.fingerprint_documents(d),
    "line_windows": lambda s, d, e: line_windows.dedupe_lines(d),
    "packing": lambda s, d, e: packing.pack(d).groupBy("doc_id", "doc_tokens").count(),
    "quality": lambda s, d, e: quality.score(d, quality.train(d, _labels(s, [] if e else None))),
    "secrets": lambda s, d, e: secrets.scan(d),
    "lm": lambda s, d, e: lm.score(d),
    "sharding": lambda s, d, e: sharding.shard_documents(d, 3),
    "language": lambda s, d, e: language.identify(d, language.train(d)),
    "simhash": lambda s, d, e: simhash.near_duplicates(d),
}
ONE_TO_ONE = {"order_minhash", "line_windows", "quality", "secrets", "lm", "sharding", "language", "simhash"}


@pytest.fixture(scope="module", autouse=True)
def short_training():
    steps, lm.STEPS = lm.STEPS, 20
    yield
    lm.STEPS = steps


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, name):
    rows = OPERATORS[name](spark, documents(spark), False).collect()
    if name in ONE_TO_ONE:
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in odd_documents())
    else:
        assert {r.doc_id for r in rows} == {r[0] for r in odd_documents()}


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns(spark, name):
    plain, clash = (OPERATORS[name](spark, documents(spark, clash=c), False) for c in (False, True))
    own = [c for c in plain.columns if c not in ("component_id", "group")]
    assert plain.count() == clash.count()
    if name != "line_windows":  # hands through what it is given
        assert sorted(map(str, plain.select(own).collect())) == sorted(map(str, clash.select(own).collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, documents(spark, []), True).count() == 0


def test_decontamination_odd_rows(spark):
    docs = documents(spark, [*odd_documents(), (20, "say alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a", 1)])
    rows = decontamination.contaminated(docs, _benchmark(spark)).collect()
    assert [(r.doc_id, r.item_id) for r in rows] == [(20, 1)]
    assert decontamination.contaminated(docs, _benchmark(spark, [])).count() == 0
    assert decontamination.contaminated(documents(spark, []), _benchmark(spark)).count() == 0
    assert decontamination.contaminated(documents(spark, clash=True), _benchmark(spark)).count() == 0


@pytest.mark.parametrize("clash", [False, True])
def test_stages_keep_the_columns(spark, tmp_path, clash):
    _benchmark(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents(spark, clash=clash)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows, name
        if clash:
            assert all(r[c] == "keep " + c for r in rows for c in CLASHING), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= docs.count()


def test_stages_on_an_empty_table(spark, tmp_path):
    _benchmark(spark, []).write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(spark, []), str(tmp_path)).count() == 0
