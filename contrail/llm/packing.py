"""Concatenate-and-cut packing of tokenised documents.

Pass 1 tokenises each document once, in the partition its file split gives
it, and writes the ids with the running token total of the partition. The
prefix sums over the partition totals (one row per partition) turn these
into global offsets. Pass 2 reads the ids back, cuts the global stream at
every multiple of the window and emits the boundary records: one row per
document and window it touches. No row is shuffled, and only the last window
is padded.

Ids are those of the ``tokenizers`` library for the given file. Words are
mapped through a bounded per-worker cache of whitespace-delimited pieces
(the pre-tokeniser never joins two of them); the pieces not in the cache go
to ``tiktoken``, which holds the same vocabulary as ranks and is several
times faster. A text that spells out the special token goes to
``tokenizers`` whole.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm.common import map_batches, saved, table

WINDOW = 2048
TOKENIZER = "byte_bpe_50k"
END_ID = 1
SPECIAL = "<|endoftext|>"
CACHE_PIECES = 250_000

_ODD_SPACE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
_RUNS = (b"  ", b"\n\n", b" \n", b"\n ", b"\t", b"\r", b"\x0b", b"\x0c")
_PIECE = " ?[^{0}]+|[{0}]+(?![^{0}])|[{0}]"
_ANY_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


class Encoder:
    """Token ids of the byte-level BPE vocabulary `name`, as packed 16-bit little-endian bytes."""

    def __init__(self, name: str = TOKENIZER, cache_pieces: int = CACHE_PIECES):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if max(ranks.values()) >= 2**16:
            raise ValueError("ids must fit in 16 bits")
        self._json = public_tokenizers.path(f"{name}.json")
        self._plain = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                        special_tokens={})
        self._exact = None
        self._bound = cache_pieces
        self._cache: dict[bytes, bytes] = {}
        self._after_space: dict[bytes, bytes] = {}
        self._newline = self._piece(b"\n")
        self._pieces = re.compile(_PIECE.format(_ANY_SPACE))

    def _piece(self, raw: bytes) -> bytes:
        return array("H", self._plain.encode_ordinary(raw.decode())).tobytes()

    def _look(self, cache: dict[bytes, bytes], lead: bytes, raw: bytes) -> bytes:
        ids = cache.get(raw)
        if ids is None:
            ids = self._piece(lead + raw)
            if len(cache) < self._bound:
                cache[raw] = ids
        return ids

    def word(self, raw: bytes) -> bytes:
        """Ids of a word after a space."""
        return self._after_space.get(raw) or self._look(self._after_space, b" ", raw)

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:
            if self._exact is None:
                from tokenizers import Tokenizer
                self._exact = Tokenizer.from_file(self._json)
            return array("H", self._exact.encode(text, add_special_tokens=False).ids).tobytes()
        raw = text.encode("utf-8")
        if (not raw or raw[0] in b" \n" or raw[-1] in b" \n" or any(x in raw for x in _RUNS)
                or any(x in raw for x in _ODD_SPACE)):
            return b"".join([self._look(self._cache, b"", p.encode("utf-8")) for p in self._pieces.findall(text)])
        out = []
        known, look = self._after_space.get, self._look
        for line in raw.split(b"\n"):
            first, *rest = line.split(b" ")
            out.append(self._newline)
            out.append(look(self._cache, b"", first))
            out += [known(w) or look(self._after_space, b" ", w) for w in rest]
        return b"".join(out[1:])


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(name: str) -> Encoder:
    """One encoder for each Python worker, kept between tasks."""
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(name)
    return _ENCODERS[name]


def _tokenise(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([end_id], "<u2").tobytes()
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = [enc(t or "") + end for t in batch.column(1).to_pylist()]
            n = np.array([len(x) // 2 for x in ids], dtype="int64")
            start = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(n), pa.int32()), pa.array(start, pa.int64()),
                 pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "part", "part_start", "n", "ids"])
    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, begin, n, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                wide = np.frombuffer(ids, "<u2").astype("<u4")
                at = 0
                while at < n:
                    seq, off = divmod(begin + at, window)
                    take = min(window - off, n - at)
                    rows.append((doc, at, take, zlib.crc32(wide[at:at + take].tobytes()), n, seq, off))
                    at += take
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=PIECE_COLUMNS)
    return run


PIECE_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def token_stream(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """(doc_id, begin, n, ids): every document's ids and the place of its first id in the global stream.

    A null text is empty: its only id is `end_id`.
    """
    ids = saved(map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")), _tokenise(tokenizer, end_id), "doc_id long, part int, part_start long, n long, ids binary"), "tokens")
    # One row of 12 bytes per input split: bounded by the number of tasks, so it can be broadcast.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (ids.groupBy("part").agg(F.sum("n").alias("total"))
             .select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")))
    return ids.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("part_start")).alias("begin"), "n", "ids")


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Boundary records of the packed sequences; one row per document and window.

    Documents keep their whole id list (cut, never dropped); every sequence but
    the last is full. Repeated rows are packed as often as they come; a null
    doc_id stays null; an empty table gives no rows.
    """
    if window < 1:
        raise ValueError("window must be positive")
    return map_batches(token_stream(docs, tokenizer, end_id), _cut(window), ", ".join(f"{c} long" for c in PIECE_COLUMNS))


def op4_concat_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
