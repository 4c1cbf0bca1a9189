"""Alignment of two tokenizers over the same bytes, by an associative fragment monoid.

A document's bytes, a space and its text, are cut into tokens twice: by the
byte-level vocabulary A and the piece vocabulary B. Where tokens of both end
at one offset a group of tokens closes, and the two tokens that end there are
linked.

A *fragment* is what a byte range (lo, hi] knows: the tokens that end in it,
as an open prefix (up to and with its first common end), closed groups, and
an open suffix (after its last common end). ``compose`` joins neighbouring
fragments: suffix and prefix become one closed group. It is associative and
has an identity, so the fragments of a document can be made anywhere and
joined as a tree. A very long document is cut into ranges of about RANGE
bytes whose ends may lie inside tokens and groups; each range travels as a
window that reaches to the nearest space or newline on either side, is
tokenised and aligned in some task, and rounds of FAN_IN neighbours at a time
give the document. A short document is one fragment, made where it lies.

Both vocabularies cut before a single space and around a single newline that
stand between other characters: A's pattern does, and no piece of B holds a
space after another character, or a newline (checked when it is loaded). So
windows give the tokens of the whole, and a short document without other white
space is the concatenation of the closed fragments of its words, which each
worker keeps in a bounded cache.

Counts of id pairs over all links are a shuffle of per-task counts. The
counts of the most frequent pairs (FREQUENT of them at most) are sent to the
tasks; the other pairs of a document leave the task and meet their counts in
a join, in which no pair has many rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import map_batches, saved, table
from contrail.llm.lm import least_count

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k", "piece_bpe_32k"
#: Texts of more bytes are cut into ranges of about RANGE bytes; fragments joined at once.
LONG, RANGE, FAN_IN = 1 << 16, 1 << 14, 16
#: Words a worker keeps; pairs counted before a task hands them on; pairs sent to all tasks.
CACHE_WORDS, COUNT_PAIRS, FREQUENT = 200_000, 1 << 20, 1 << 18
#: Documents worked on at once.
TEXTS = 256

#: A place where both vocabularies cut: a single space or newline between two other characters.
CUT = re.compile(r"(?<=\S)[ \n](?=\S)")
#: What keeps a text from being cut into words at every space and newline.
UNEVEN = re.compile(r"[^\S \n]|[ \n][ \n]|^[ \n]|[ \n]\Z")


class Fragment(NamedTuple):
    """The tokens that end in a byte range. Ids are little-endian 16-bit, links 32-bit (A's id << 16 | B's)."""

    ok: bool = True
    closed: bool = False  # a common end lies in the range; if not, all tokens are in the head
    n_a: int = 0
    n_b: int = 0
    head_a: bytes = b""
    head_b: bytes = b""
    body: bytes = b""
    tail_a: bytes = b""
    tail_b: bytes = b""
    links: bytes = b""


def group_text(a: bytes, b: bytes) -> bytes:
    """`a1,a2|b1` of one group."""
    return b"|".join(b",".join(map(b"%d".__mod__, np.frombuffer(x, "<u2").tolist())) for x in (a, b))


def compose(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring byte ranges."""
    ok, n_a, n_b = left.ok and right.ok, left.n_a + right.n_a, left.n_b + right.n_b
    links = left.links + right.links
    if not right.closed:
        if left.closed:
            return left._replace(ok=ok, n_a=n_a, n_b=n_b, tail_a=left.tail_a + right.head_a,
                                 tail_b=left.tail_b + right.head_b)
        return left._replace(ok=ok, n_a=n_a, n_b=n_b, head_a=left.head_a + right.head_a,
                             head_b=left.head_b + right.head_b)
    if not left.closed:
        return right._replace(ok=ok, n_a=n_a, n_b=n_b, head_a=left.head_a + right.head_a,
                              head_b=left.head_b + right.head_b)
    middle = group_text(left.tail_a + right.head_a, left.tail_b + right.head_b)
    body = b";".join(x for x in (left.body, middle, right.body) if x)
    return Fragment(ok, True, n_a, n_b, left.head_a, left.head_b, body, right.tail_a, right.tail_b, links)


def fragment(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> Fragment:
    """Of the tokens `a` and `b` (uint16) with their byte ends, ascending."""
    common, i, j = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
    if not len(common):
        return Fragment(n_a=len(a), n_b=len(b), head_a=a.tobytes(), head_b=b.tobytes())
    links = (a[i].astype("<u4") << 16 | b[j]).astype("<u4").tobytes()
    i, j = (i + 1).tolist(), (j + 1).tolist()
    raw_a, raw_b = a.tobytes(), b.tobytes()
    body = b";".join(group_text(raw_a[2 * p:2 * q], raw_b[2 * r:2 * s])
                     for p, q, r, s in zip(i, i[1:], j, j[1:], strict=False))
    return Fragment(True, True, len(a), len(b), raw_a[:2 * i[0]], raw_b[:2 * j[0]], body,
                    raw_a[2 * i[-1]:], raw_b[2 * j[-1]:], links)


class Aligned(NamedTuple):
    """A whole document: its counts, its groups as text, its links."""

    n_a: int
    n_b: int
    groups: bytes
    links: bytes


NOTHING = Aligned(0, 0, b"", b"")


def finished(whole: Fragment) -> Aligned:
    """What the fragment of all bytes of a document says; nothing if a tokenizer lost bytes of it."""
    if not whole.ok or not whole.closed or whole.tail_a or whole.tail_b:
        return NOTHING
    first = group_text(whole.head_a, whole.head_b)
    return Aligned(whole.n_a, whole.n_b, b";".join(x for x in (first, whole.body) if x), whole.links)


# ---------------------------------------------------------------- the two tokenizers

class Tokenizers:
    """Ids and byte lengths by both vocabularies, without special tokens."""

    def __init__(self, name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B, cache_words: int = CACHE_WORDS):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(public_tokenizers.path(f"{name_a}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
        self._a = tiktoken.Encoding(name_a, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._bytes_a = [b""] * (max(ranks.values()) + 1)
        for raw, i in ranks.items():
            self._bytes_a[i] = raw
        self._b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{name_b}.model"))
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        if any(re.search("[^▁]▁", p) or "\n" in p for p in pieces):
            raise ValueError(f"{name_b} has pieces across a space or newline")
        self._bytes_b = [bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode()
                         for i, p in enumerate(pieces)]
        if max(len(self._bytes_a), len(self._bytes_b)) > 2**16:
            raise ValueError("ids must fit in 16 bits")
        self._long_a, self._long_b = (np.array([len(x) for x in y]) for y in (self._bytes_a, self._bytes_b))
        self._bound = cache_words
        self._words: dict[str, Aligned | None] = {}

    def _pieces(self, texts: list[str]) -> list[list[int]]:
        """B's ids of texts that begin with a space, which B adds by itself, or with a newline."""
        got = self._b.encode([x[1:] if x[0] == " " else x for x in texts], num_threads=1)
        return [ids if x[0] == " " else ids[1:] for x, ids in zip(texts, got, strict=True)]

    def window(self, text: str, first: int, last: int) -> Fragment:
        """Of the tokens of `text`, which begins with a space or newline, that end in its bytes (first, last]."""
        raw, a, b = text.encode(), self._a.encode_ordinary(text), self._pieces([text])[0]
        if (b"".join(map(self._bytes_a.__getitem__, a)) != raw or b"".join(map(self._bytes_b.__getitem__, b)) != raw):
            return Fragment(ok=False)
        a, b = np.array(a, dtype="<u2"), np.array(b, dtype="<u2")
        a_ends, b_ends = np.cumsum(self._long_a[a]), np.cumsum(self._long_b[b])
        own_a, own_b = (a_ends > first) & (a_ends <= last), (b_ends > first) & (b_ends <= last)
        return fragment(a[own_a], a_ends[own_a], b[own_b], b_ends[own_b])

    def _word(self, text: str, b: list[int]) -> Aligned | None:
        """A word with the space or newline before it; None if a tokenizer loses bytes of it."""
        raw, a = text.encode(), self._a.encode_ordinary(text)
        own_a, own_b = [self._bytes_a[x] for x in a], [self._bytes_b[x] for x in b]
        if b"".join(own_a) != raw or b"".join(own_b) != raw:
            return None
        groups, links = [], bytearray()
        i = j = p = q = to_a = to_b = 0
        while i < len(a):
            if to_a <= to_b:
                to_a += len(own_a[i])
                i += 1
            while to_b < to_a:
                to_b += len(own_b[j])
                j += 1
            if to_a == to_b:
                groups.append(f"{','.join(map(str, a[p:i]))}|{','.join(map(str, b[q:j]))}")
                links += (a[i - 1] << 16 | b[j - 1]).to_bytes(4, "little")
                p, q = i, j
        return Aligned(len(a), len(b), ";".join(groups).encode(), bytes(links))

    def documents(self, texts: list[str | None]) -> list[Aligned]:
        """Every text aligned as a whole."""
        # Words keep a newline before them; the space before all others, the first included, isn't written.
        cut = [x.replace("\n", " \n").split(" ") if x and not UNEVEN.search(x) else None for x in texts]
        known = self._words
        new = list(set().union(*filter(None, cut)) - known.keys())
        whole = [x if x[0] == "\n" else " " + x for x in new]
        for word, text, b in zip(new, whole, self._pieces(whole) if new else [], strict=True):
            known[word] = self._word(text, b)
        out = []
        for text, words in zip(texts, cut, strict=True):
            if words is not None:
                parts = list(map(known.__getitem__, words))
                if None in parts:
                    out.append(NOTHING)
                    continue
                n_a, n_b, groups, links = zip(*parts, strict=True)
                out.append(Aligned(sum(n_a), sum(n_b), b";".join(groups), b"".join(links)))
            elif text:
                out.append(finished(self.window(" " + text, 0, len(text.encode()) + 1)))
            else:
                out.append(NOTHING)
        if len(known) > self._bound:
            for word in new:
                del known[word]
        return out


_TOKENIZERS: dict[tuple, Tokenizers] = {}


def tokenizers(*names: str) -> Tokenizers:
    """One pair for each Python worker, kept between tasks."""
    if names not in _TOKENIZERS:
        _TOKENIZERS[names] = Tokenizers(*names)
    return _TOKENIZERS[names]


def windows(text: str, size: int) -> list[tuple[str, int, int]]:
    """(window, first, last) for byte ranges of about `size` bytes of " " + text.

    Ranges end at multiples of `size`, wherever these fall; a window reaches
    from the last cut before its range to the first one after it. Where a cut
    is further off than half a range, the range goes on to the next multiple.
    """
    whole = " " + text
    raw = whole.encode()
    at = np.fromiter((m.start() for m in CUT.finditer(whole)), np.int64)
    starts = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)  # byte offset of every character
    cuts = np.concatenate([[0], starts[at], [len(raw)]])
    bounds = [(0, 0, 0)]  # (bound, cut at or before, cut at or after)
    for bound in range(size, len(raw), size):
        before = int(cuts[np.searchsorted(cuts, bound, "right") - 1])
        after = int(cuts[np.searchsorted(cuts, bound, "left")])
        if max(bound - before, after - bound) <= size // 2:
            bounds.append((bound, before, after))
    bounds.append((len(raw), len(raw), len(raw)))
    return [(raw[begin:end].decode(), lo - begin, hi - begin)
            for (lo, begin, _), (hi, _, end) in zip(bounds, bounds[1:], strict=False)]


# ---------------------------------------------------------------- Spark

ALIGNED = ("doc_id long, part int, row long, n_a long, n_b long, n_groups long, groups_sha256 string, "
           "codes binary, times binary")
FRAGMENT = ("ok boolean, closed boolean, n_a long, n_b long, head_a binary, head_b binary, body binary, tail_a binary, "
            "tail_b binary, links binary")
_KEYS = [("part", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("k", pa.int32())]
_FRAGMENT = [("ok", pa.bool_()), ("closed", pa.bool_()), ("n_a", pa.int64()), ("n_b", pa.int64()),
             *((c, pa.binary()) for c in Fragment._fields[4:])]


def _columns(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, fields, strict=True)],
                                      names=[c for c, _ in fields])


def _row(doc_id, part: int, row: int, of: Aligned) -> tuple:
    codes, times = np.unique(np.frombuffer(of.links, "<u4"), return_counts=True)
    told = hashlib.sha256(of.groups).hexdigest() if of.n_a else ""
    return (doc_id, part, row, of.n_a, of.n_b, len(of.links) // 4, told, codes.astype("<u4").tobytes(),
            times.astype("<u4").tobytes())


_ALIGNED = [("doc_id", pa.int64()), ("part", pa.int32()), ("row", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
            ("n_groups", pa.int64()), ("groups_sha256", pa.string()), ("codes", pa.binary()), ("times", pa.binary())]


def align_short(docs: DataFrame, names: tuple[str, str]) -> DataFrame:
    """ALIGNED rows of (doc_id, text), every text as one fragment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, row = tokenizers(*names), TaskContext.get().partitionId(), 0
        for whole in batches:
            for lo in range(0, len(whole), TEXTS):
                batch = whole.slice(lo, TEXTS)
                rows = []
                for doc, of in zip(batch.column(0).to_pylist(), own.documents(batch.column(1).to_pylist()), strict=True):
                    rows.append(_row(doc, part, row, of))
                    row += 1
                yield _columns(rows, _ALIGNED)

    return map_batches(docs, run, ALIGNED)


def fold_fragments(batch: pa.Table) -> Fragment:
    """The fragment of some neighbouring ranges, in the order of their numbers."""
    rows = sorted(batch.to_pylist(), key=lambda r: r["k"])
    return reduce(compose, (Fragment(**{c: r[c] for c in Fragment._fields}) for r in rows), Fragment())


def align_long(docs: DataFrame, names: tuple[str, str], size: int = RANGE, fan_in: int = FAN_IN) -> DataFrame:
    """ALIGNED rows of (doc_id, text), every text as a tree of fragments made in many tasks."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for k, (window, first, last) in enumerate(windows(text, size)):
                    yield _columns([(part, row, doc, k, window, first, last)],
                                   [*_KEYS, ("window", pa.string()), ("first", pa.int64()), ("last", pa.int64())])
                row += 1

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers(*names)
        for batch in batches:
            for part, row, doc, k, window, first, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield _columns([(part, row, doc, k, *own.window(window, first, last))], [*_KEYS, *_FRAGMENT])

    def fold(group: pa.Table) -> pa.Table:
        first = group.slice(0, 1).select([c for c, _ in _KEYS]).to_pylist()[0]
        row = (first["part"], first["row"], first["doc_id"], first["k"] // fan_in, *fold_fragments(group))
        return pa.Table.from_batches([_columns([row], [*_KEYS, *_FRAGMENT])])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                whole = Fragment(**{c: r[c] for c in Fragment._fields})
                yield _columns([_row(r["doc_id"], -1 - r["part"], r["row"], finished(whole))], _ALIGNED)

    keys = "part int, row long, doc_id long, k int"
    ranges = map_batches(docs, cut, f"{keys}, window string, first long, last long").repartition("part", "row", "k")
    made = saved(map_batches(ranges, make, f"{keys}, {FRAGMENT}"), "align-fragments")
    most = made.agg(F.max("k")).first()[0] or 0
    while most:
        made = made.groupBy("part", "row", F.floor(F.col("k") / fan_in)).applyInArrow(fold, f"{keys}, {FRAGMENT}")
        most //= fan_in
    return map_batches(made, finish, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(code, c, best): links that hold the pair over all rows; whether that is the most its B id has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, times, n = [], [], 0

        def out():
            every, where = np.unique(np.concatenate(codes), return_inverse=True)
            total = np.bincount(where, weights=np.concatenate(times), minlength=len(every)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(every.astype(np.int64)), pa.array(total)], names=["code", "c"])

        for batch in batches:
            for raw, many in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                codes.append(np.frombuffer(raw, "<u4"))
                times.append(np.frombuffer(many, "<u4"))
                n += len(codes[-1])
                if n >= COUNT_PAIRS:
                    yield out()
                    codes, times, n = [], [], 0
        if n:
            yield out()

    counts = saved(map_batches(aligned.select("codes", "times"), run, "code long, c long")
                   .groupBy("code").agg(F.sum("c").alias("c")), "align-pairs")
    piece = F.col("code").bitwiseAND(2**16 - 1)
    most = counts.groupBy(piece.alias("piece")).agg(F.max("c").alias("most"))  # a row for each id of B: at most 2^16
    return saved(counts.join(F.broadcast(most), piece == F.col("piece"))
                 .select("code", "c", (F.col("c") == F.col("most")).alias("best")), "align-counts")


def align(docs: DataFrame, names: tuple[str, str] = (TOKENIZER_A, TOKENIZER_B), long: int = LONG,
          frequent: int = FREQUENT) -> DataFrame:
    """Tokens, groups and links of every document, and how its links do corpus-wide.

    (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256). A
    null or empty text, and one whose bytes a tokenizer doesn't give back, has
    zeros and an empty groups_sha256, and no links that count. Repeated rows
    count as often as they come; a null doc_id stays null; an empty table
    gives no rows; other columns are ignored. A text of more than `long` bytes
    is aligned in ranges by many tasks; a text without spaces or newlines has
    no place to be cut and is one range whatever its length.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    is_long = F.coalesce(F.octet_length("text") > long, F.lit(False))
    aligned = saved(align_short(slim.filter(~is_long), names).unionByName(align_long(slim.filter(is_long), names)),
                    "aligned")
    counts = pair_counts(aligned)

    tops = counts.filter(F.col("c") >= least_count(counts, frequent)).orderBy("code").toArrow()  # at most `frequent` rows
    codes = np.append(tops["code"].to_numpy(), 2**40)  # ends with a code that no pair has
    times, best = np.append(tops["c"].to_numpy(), 0), np.append(tops["best"].to_numpy(), False)
    shipped = spark.sparkContext.broadcast((codes, times.astype(np.int64), best.astype(bool)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, count, best = shipped.value
        for batch in batches:
            sums, bests, rare_codes, rare_n, ends = [], [], [], [], [0]
            for raw, many in zip(batch.column("codes").to_pylist(), batch.column("times").to_pylist(), strict=True):
                own, n = np.frombuffer(raw, "<u4").astype(np.int64), np.frombuffer(many, "<u4").astype(np.int64)
                at = np.searchsorted(codes, own)
                hit = codes[at] == own
                sums.append(int((n * count[at])[hit].sum()))
                bests.append(int((n * best[at])[hit].sum()))
                rare_codes.append(own[~hit])
                rare_n.append(n[~hit])
                ends.append(ends[-1] + len(rare_n[-1]))
            rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(np.concatenate([np.empty(0, np.int64), *x])) for x in (rare_codes, rare_n)], names=["code", "n"]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "part", "row", "n_a", "n_b", "n_groups", "groups_sha256")),
                 pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), rare],
                names=["doc_id", "part", "row", "n_a", "n_b", "n_groups", "groups_sha256", "n_best", "count_sum", "rare"])

    scored = saved(map_batches(aligned, run, "doc_id long, part int, row long, n_a long, n_b long, n_groups long, "
                                             "groups_sha256 string, n_best long, count_sum long, "
                                             "rare array<struct<code: bigint, n: bigint>>"), "align-scored")
    odd = scored.filter(F.size("rare") > 0).select("part", "row", F.inline("rare")).join(counts, "code")
    of_odd = odd.groupBy("part", "row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("odd_best"),
                                            F.sum(F.col("n") * F.col("c")).alias("odd_sum"))
    return scored.join(of_odd, ["part", "row"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        (F.col("n_best") + F.coalesce("odd_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("odd_sum", F.lit(0))).alias("count_sum"), "groups_sha256")


def op12_fragment_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
