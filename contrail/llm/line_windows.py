"""Line dedup on overlapping three-line windows.

The non-blank lines of a text, stripped of ASCII white space at both ends,
form overlapping windows of three consecutive lines. A window's key is a
128-bit hash of the three lines. The first occurrence of a key, by
(doc_id, text hash, position), stays; every later one marks its three lines
as covered, and a line covered by any later occurrence is removed. The first
occurrence of any single line in the corpus is never covered, so no line is
lost from the corpus altogether.

Keys are counted with map-side partial aggregates. The covered windows come
from joining the windows with the repeated keys; keys that hold more than a
ten-thousandth of all windows (at most 10,000 of them) are joined by
broadcast, the rest by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import map_batches, saved, table

#: White space that is stripped from a line's ends; the line break itself is \n.
STRIP = " \t\r\x0b\x0c"
#: A key is hot when it has more rows than this and than the total over HOT_KEYS.
HOT_ROWS = 10_000
HOT_KEYS = 10_000


def windows(docs: DataFrame) -> DataFrame:
    """(doc_id, row, i0, i1, i2, k1, k2): one row per window; i0..i2 are line numbers, row is the text's hash."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    stripped = F.filter(
        F.transform(lines, lambda x, i: F.struct(i.alias("i"), F.btrim(x, F.lit(STRIP)).alias("line"))),
        lambda s: s["line"] != "")
    hashed = F.transform(F.col("__lines"), lambda s: F.struct(
        s["i"].alias("i"), F.xxhash64(s["line"]).alias("a"), F.xxhash64(F.lit(1), s["line"]).alias("b")))

    def window(at):
        x, y, z = (F.get(F.col("__hashed"), at + d) for d in range(3))
        return F.struct(x["i"].alias("i0"), y["i"].alias("i1"), z["i"].alias("i2"),
                        F.xxhash64(x["a"], y["a"], z["a"]).alias("k1"), F.xxhash64(x["b"], y["b"], z["b"]).alias("k2"))

    return (docs.select("doc_id", F.xxhash64("text").alias("row"), stripped.alias("__lines"))
            .withColumn("__hashed", hashed)
            .filter(F.size("__hashed") >= 3)
            .select("doc_id", "row", F.inline(F.transform(F.sequence(F.lit(0), F.size("__hashed") - 3), window))))


def covered_lines(wins: DataFrame) -> DataFrame:
    """(doc_id, row, covered): sorted numbers of the lines that later occurrences cover; `wins` is read twice."""
    total = wins.count()
    at = F.struct("doc_id", "row", "i0")
    repeats = (wins.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("__n"), F.min(at).alias("__first"))
               .filter("__n > 1"))
    is_hot = F.col("__n") > max(HOT_ROWS, total // HOT_KEYS)
    hot = repeats.filter(is_hot).select("k1", "k2", F.col("__first").alias("__hot"))
    tagged = wins.join(F.broadcast(hot), ["k1", "k2"], "left")  # at most HOT_KEYS rows
    cold = (tagged.filter("__hot is null").drop("__hot")
            .join(repeats.filter(~is_hot).select("k1", "k2", "__first"), ["k1", "k2"]))
    later = (tagged.filter("__hot is not null").withColumnRenamed("__hot", "__first").unionByName(cold)
             .filter(~at.eqNullSafe(F.col("__first"))))
    return (later.select("doc_id", "row", F.explode(F.array("i0", "i1", "i2")).alias("i"))
            .groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("i")).alias("covered")))


def _rewrite(text: int, covered: int, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = batch.column(covered)
            if cut.null_count < len(cut):
                texts, removed = batch.column(text).to_pylist(), cut.to_pylist()
                for k, gone in enumerate(removed):
                    if gone:
                        drop = set(gone)
                        texts[k] = "\n".join([x for i, x in enumerate(texts[k].split("\n")) if i not in drop])
                batch = batch.set_column(text, columns[text], pa.array(texts, batch.column(text).type))
            yield batch
    return run


def dedupe_lines(docs: DataFrame) -> DataFrame:
    """`docs` with covered lines taken out of text, and ``covered`` (line numbers, null if none).

    n_chars, if there, is recomputed for changed texts. Texts with fewer than
    three non-blank lines have no window and stay as they are, as do null and
    empty texts; a text whose every line is covered becomes empty (or only its
    blank lines). Rows that repeat a doc_id with the same text count as one
    document. A null doc_id comes first in the order. A column named covered
    is replaced.
    """
    found = covered_lines(saved(windows(docs), "line-windows")).select(
        F.col("doc_id").alias("__doc"), F.col("row").alias("__row"), "covered")
    columns = [c for c in docs.columns if c != "covered"]
    joined = (docs.join(found, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64("text") == F.col("__row")),
                        "left").select(*(docs[c] for c in columns), found["covered"]))
    out = map_batches(joined, _rewrite(columns.index("text"), len(columns), [*columns, "covered"]), joined.schema)
    if "n_chars" in columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("covered").isNotNull(), changed).otherwise(F.col("n_chars")))
    return out


def op2_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its line counts and its text after dedup."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedupe_lines(docs).select(
        "doc_id", F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join("covered", ","), F.lit("")).alias("removed_lines"),
        F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, i - 1 AS i, part, trim(part, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line
  FROM (SELECT doc_id, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), wins AS (
  SELECT doc_id, i AS i0, lead(i) OVER w AS i1, lead(i, 2) OVER w AS i2,
         line || chr(10) || lead(line) OVER w || chr(10) || lead(line, 2) OVER w AS key
  FROM lines WHERE line <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), later AS (
  SELECT * FROM wins WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, i0) > 1
), covered AS (
  SELECT doc_id, i0 AS i FROM later UNION SELECT doc_id, i1 FROM later UNION SELECT doc_id, i2 FROM later
), kept AS (
  SELECT doc_id, string_agg(part, chr(10) ORDER BY i) AS text FROM lines
  WHERE (doc_id, i) NOT IN (SELECT (doc_id, i) FROM covered) GROUP BY doc_id
), removed AS (
  SELECT doc_id, count(*) AS n, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS listed FROM covered GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_removed, coalesce(listed, '') AS removed_lines,
       length(coalesce(kept.text, '')) AS n_chars, sha256(coalesce(kept.text, '')) AS text_sha256
FROM documents LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
