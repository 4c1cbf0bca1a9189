"""Write feed-format landing files from DataFrames (Spark jobs).

Used to turn the driver tables into the formats the readers parse: one
JSON document per snapshot chunk. Chunks are bounded (``chunk_rows``
consecutive sequence numbers), so ``collect_list`` never gathers an
unbounded group into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.sources.landing import STATE_SLOTS


def _json_text(c: Column) -> Column:
    """A JSON scalar for a string column: quoted and escaped, or null."""
    return F.coalesce(F.regexp_replace(F.regexp_replace(F.to_json(F.array(c)), r"^\[", ""), r"\]$", ""),
                      F.lit("null"))


def _json_num(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def _json_bool(c: Column) -> Column:
    return F.coalesce(F.when(c, F.lit("true")).when(~c, F.lit("false")), F.lit("null"))


def state_vector_json(df: DataFrame) -> Column:
    """One state as a JSON array text, from columns named like the slots."""
    parts = []
    for name, dtype in STATE_SLOTS:
        c = F.col(name)
        t = dtype.simpleString()
        if t == "string":
            parts.append(_json_text(c))
        elif t == "boolean":
            parts.append(_json_bool(c))
        else:
            parts.append(_json_num(c))
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))


def in_order(seq: str, value: Column) -> Column:
    """The group's values as an array in the order of `seq`."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(seq).alias("seq"), value.alias("value"))),
                        lambda a, b: F.when(a["seq"] < b["seq"], -1).when(a["seq"] > b["seq"], 1).otherwise(0))
    return F.transform(rows, lambda r: r["value"])


def chunks_in_order(docs: DataFrame) -> DataFrame:
    """Documents dealt to files by chunk, so that files and the documents in them stand in order."""
    return docs.repartitionByRange("_chunk").sortWithinPartitions("_chunk")


def write_state_vector_snapshots(states: DataFrame, path: str, chunk_rows: int = 1000,
                                 seq: str = "seq", time_col: str = "time_position",
                                 state_col: str = "state_json") -> str:
    """Group states into snapshot documents (JSON lines) by ``seq`` chunk.

    ``states`` must carry ``seq``, ``time_position`` and ``state_json``
    (a JSON array text, e.g. from ``state_vector_json``).
    """
    chunk = F.floor(F.col(seq) / chunk_rows)
    docs = (states.groupBy(chunk.alias("_chunk"))
            .agg(F.max(time_col).alias("_t"), in_order(seq, F.col(state_col)).alias("_states"))
            .transform(chunks_in_order))
    text = F.concat(F.lit('{"time":'), F.col("_t").cast("string"), F.lit(',"states":['),
                    F.array_join("_states", ","), F.lit("]}"))
    docs.select(text.alias("value")).write.mode("overwrite").text(path)
    return path


def write_documents(records: DataFrame, path: str, array_field: str, chunk_rows: int = 1000,
                    seq: str = "seq") -> str:
    """Group struct records into ``{array_field: [...]}`` JSON documents by seq chunk."""
    rec_cols = [c for c in records.columns if c != seq]
    chunk = F.floor(F.col(seq) / chunk_rows)
    docs = (records.groupBy(chunk.alias("_chunk"))
            .agg(in_order(seq, F.struct(*rec_cols)).alias(array_field))
            .transform(chunks_in_order).drop("_chunk"))
    docs.write.mode("overwrite").json(path)
    return path


def csv_field(c: Column) -> Column:
    """RFC-4180 field text: quote when it holds a comma, quote or newline; null -> ''."""
    s = c.cast("string")
    needs = s.contains(",") | s.contains('"') | s.contains("\n")
    quoted = F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(F.when(needs, quoted).otherwise(s), F.lit(""))


def csv_line(*cols: Column) -> Column:
    return F.concat_ws(",", *[csv_field(c) for c in cols])
