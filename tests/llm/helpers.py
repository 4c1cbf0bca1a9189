"""Hand-made documents with every odd case, and plain-Python versions of shared rules."""

import re
import zlib

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"

DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

#: Names the operators use for themselves or return.
CLASHING = ("fp", "fingerprint", "component_id", "group", "covered", "score", "lang_pred", "shard", "slot", "row", "part",
            "rank", "hash", "pos", "n", "ids", "__rest", "key", "edited", "block", "size", "held_out", "bucket", "a", "b")


def fold(doc_id, modulus):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def words(text):
    return (text or "").encode().lower().split()


def odd_documents():
    """Nulls in every column, empty and blank texts, very long ones, ties, repeated rows, odd code points."""
    plain = "The quick brown fox jumps over the lazy dog near the river bank today.\n" \
            "Another line of quiet prose follows here, and it ends well.\nA third one closes the window."
    rows = [
        (1, plain, "en", "a", len(plain)), (1, plain, "en", "a", len(plain)),  # a repeated row
        (2, plain, "en", "b", len(plain)),  # a tie
        (3, "", "en", "a", 0), (4, None, "en", "a", None), (5, "  \n\t ", None, "a", 5), (6, "word", "de", None, 4),
        (7, "!!! 123 ???", "fr", "a", 11), (None, "no id here, but some words to read.", "en", "a", 35),
        (None, None, None, None, None), (8, "é ñ ü \U0001f600 ſecret K x y", "es", "a", 20),
        (9, "x" * 200_000, "en", "a", 200_000), (10, "lorem ipsum " * 30_000, "en", "a", 360_000),
        (11, "\n" * 50 + "tail", "en", "a", 54), (12, "one two", "en", "a", 7), (-5, "negative id <|endoftext|> text", "en", "a", 30),
    ]
    return rows


def documents(spark, rows=None, clash=False):
    df = spark.createDataFrame(odd_documents() if rows is None else rows, DOC_SCHEMA)
    if clash:
        from pyspark.sql import functions as F
        for name in CLASHING:
            df = df.withColumn(name, F.lit("keep " + name))
    return df


def base_secrets(text):
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text or "") if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out)]
