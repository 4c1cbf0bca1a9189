"""Corpus cleaning pipeline: documents -> packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes every stage's result under ``spark.checkpoint.dir`` and hands the
reread table to the next stage. All stages but the last return the columns
of their input, whatever these are; a column whose name one of the operators
uses for itself passes through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import decontamination, language, line_windows, packing, simhash
from contrail.llm.common import saved, table


def _apart(docs: DataFrame, *own: str) -> DataFrame:
    """The columns `own` that `docs` has, and all others in one struct, out of the operators' way."""
    own = [c for c in own if c in docs.columns]
    return docs.select(*own, F.struct(F.lit(0).alias("__"), *(c for c in docs.columns if c not in own)).alias("__rest"))


def _together(slim: DataFrame, columns: list[str], *own: str) -> DataFrame:
    return slim.select(*((F.col(c) if c in own else F.col("__rest")[c]).alias(c) for c in columns))


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a column that tells rows apart also where doc_id is null or repeats, and its name.

    Rows with equal keys have equal texts.
    """
    key = "__key"
    while key in docs.columns:
        key += "_"
    return docs.withColumn(key, F.struct(F.coalesce("doc_id", F.lit(-2**63)).alias("id"),
                                         F.xxhash64("text").alias("row"))), key


#: Languages the corpus is made of; documents that the classifier takes for another one go.
LANGUAGES = ("de", "en", "es", "fr")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """Keeps the documents whose predicted language is one of `languages`.

    Without a language are a null text and one without a letter. The
    classifier learns from the labelled rows of its own input, whatever their
    language; with none to learn from, every text with a letter is kept.
    """
    model = language.train(docs)
    if model is None:
        return docs.filter(F.col("text").rlike("\\p{L}"))
    told = language.identify(_apart(docs, "text"), model)
    return _together(told.filter(F.col("lang_pred").isin(*languages)), docs.columns, "text")


def dedupe_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated three-line windows out of the texts; drops documents of which nothing is left."""
    out = line_windows.dedupe_lines(_apart(docs, "doc_id", "text", "n_chars"))
    left = F.col("covered").isNull() | (F.btrim("text", F.lit(line_windows.STRIP + "\n")) != "")
    return _together(out.filter(left), docs.columns, "doc_id", "text", "n_chars")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash group: the one with the smallest doc_id (null last)."""
    keyed, key = _keyed(docs)
    groups = simhash.near_duplicates(keyed.select("doc_id", "text", F.col(key).alias("__key")))
    best = F.min(F.struct(F.col("doc_id").isNull(), "__key"))["__key"]
    keepers = groups.groupBy("group").agg(best.alias(key)).select(key)
    return keyed.join(keepers, key, "left_semi").dropDuplicates([key]).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, plain or with other numbers, names or units."""
    keyed, key = _keyed(docs)
    leaks = decontamination.contaminated(keyed.select(key, "text"), table(spark, sf_dir, "benchmark"), key)
    return keyed.join(leaks.select(key), key, "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of the packed sequences of everything that is left."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedupe_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: SQL can express neither the trained language classifier nor the tokenizer; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
