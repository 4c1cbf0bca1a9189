"""The pipeline's stages against plain-Python versions of their rules, each on its own input."""

import corpus_pipeline
from contrail.llm import simhash
from contrail.llm.common import saved, table

from .helpers import SMALL
from .test_fingerprints import _fingerprint, _groups
from .test_texts import _dedupe


def test_stages(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs = table(spark, SMALL, "documents")
    columns = docs.columns

    told = saved(stages["language_id"](spark, docs, SMALL), "t")
    rows = docs.orderBy("doc_id").collect()
    letters = [r for r in rows if r.text is not None and any(c.isalpha() for c in r.text)]
    assert told.columns == columns and sorted(told.collect()) == sorted(letters)

    lines = saved(stages["line_dedup"](spark, told, SMALL), "t")
    before = told.orderBy("doc_id").collect()
    want = {r.doc_id: t for r, t in zip(before, _dedupe([r.text for r in before])) if t.strip()}
    after = {r.doc_id: r for r in lines.collect()}
    assert lines.columns == columns and {i: r.text for i, r in after.items()} == want
    assert all(r.n_chars == len(r.text) for r in after.values())

    near = saved(stages["near_dedup"](spark, lines, SMALL), "t")
    ordered = sorted(after)
    groups = _groups([_fingerprint(after[i].text) for i in ordered])
    assert near.columns == columns
    assert sorted(r.doc_id for r in near.collect()) == [i for k, i in enumerate(ordered) if groups[k] == k]

    clean = saved(stages["decontamination"](spark, near, SMALL), "t")
    bench = [b.text for b in table(spark, SMALL, "benchmark").collect()]

    def bare(text):
        return " ".join(w.strip(".,").lower() for w in text.split())
    leaks = {r.doc_id for r in near.collect() if any(bare(b) in bare(r.text) for b in bench)}
    assert clean.columns == columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in near.collect()} - leaks

    pieces = stages["packing"](spark, clean, SMALL).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in clean.collect()}


def test_run_is_the_stages_in_turn(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    used = {}
    for r in rows:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert rows and all(n == 2048 for s, n in used.items() if s != max(used))


def test_near_dedup_keeps_one_of_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (2, "A b c d e"), (None, "q r s t"), (None, "u v w x y"),
                                  (3, "u v w x y")], "doc_id long, text string")
    rows = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted((r.doc_id or 0, r.text) for r in rows.collect()) == [(0, "q r s t"), (1, "a b c d e"), (3, "u v w x y")]
    assert simhash.RADIUS == 2 and simhash.SHINGLE == 3


def test_language_stage_acts_on_the_prediction(spark):
    """Only the classifier can tell these apart: the text of another language goes, whatever its label says."""
    words = {"en": "the house and the garden with some old trees where children play every day",
             "it": "la casa e il giardino con alcuni vecchi alberi dove giocano ogni giorno i bambini"}
    rows = [(k, " ".join((words[lang].split() * 3)[k % 7:]), lang) for k, lang in enumerate(["en", "it"] * 30)]
    asked = [(100, words["en"], None), (101, words["it"], None), (102, words["it"], "en"), (103, "12 34", "en"), (104, None, "en")]
    docs = spark.createDataFrame(rows + asked, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert kept & {100, 101, 102, 103, 104} == {100}
    assert all((k in kept) == (lang == "en") for k, _, lang in rows)
    both = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, "", ("en", "it")).collect()}
    assert both == {r[0] for r in rows} | {100, 101, 102}
