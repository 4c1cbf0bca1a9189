"""Benchmark decontamination on canonical templates.

Words become template tokens: numbers, names and units turn into typed
placeholders (slots), everything else is lower-cased and stripped of
punctuation at its ends. A capitalised word at a sentence's start may be a
name or a plain word; windows are made of both readings (in the benchmark,
of both for every capitalised word), and once more of the words as they are
written, in lower case: a window with few plain words matches by that alone.
Windows of eight tokens of documents and benchmark
items are hash-joined. Hits of one item on one alignment in a document are
then put together and their slots checked: every benchmark value must stand
for one document value (and different names for different names); windows
that contradict what the others say are left out.
A document is contaminated by an item when consistent windows cover at least
`coverage` of the item's tokens, so a copy with other numbers, names or
units is found like a plain one.

The documents' windows are compared with a bitmap of the benchmark's window
hashes (sized by their count, of bounded size) before they leave the Python
task; only the rare hits are joined by Spark, by size: nothing whole is
broadcast.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from contrail.llm.common import map_batches, saved, table

WINDOW = 8
COVERAGE = 0.6
#: A template needs as many words that are not slots; items with fewer tokens are looked for word for word.
MIN_TOKENS = 4
#: Bits of the bitmap of the benchmark's windows (two for each): 256 for each window, between these powers of two.
LEAST_BITS, MOST_BITS = 22, 28
CACHE_WORDS = 200_000
#: Windows whose readings are worked out at once; one of eight words has at most 256.
READ_WINDOWS = 1 << 14

WORD, NUMBER, NAME, UNIT = range(4)
UNITS = frozenset("""
    mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers
    mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons
    ml l liter liters litre litres gallon gallons cup cups
    s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years
    cent cents dollar dollars euro euros usd eur percent degree degrees c f k w kw v a j kj hz mph kmh
""".split())
_EDGES = ".,;:!?\"'()[]{}<>*_`“”‘’«»…-"
# English number words.
NUMBER_WORDS = frozenset("""
    zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen
    eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion
""".split())
#: Letters only, with apostrophes, hyphens and dots between them: McDonald, O'Neil, Jean-Luc, USA, U.S
_LETTERS = re.compile(r"[^\W\d_](?:['’.-]?[^\W\d_])+\Z")
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d,.]*(?:/\d+)?[%€$£]?(?:st|nd|rd|th)?\Z", re.I)
_MEASURE = re.compile(r"[+-]?\d[\d,.]*([A-Za-z]+)\Z")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _hash(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8"), 7)


class Canon:
    """Word -> template token, in flat arrays of a fixed size.

    The first `bound` distinct words are kept; later ones are worked out again in every batch that has them.
    """

    def __init__(self, bound: int = CACHE_WORDS):
        self._bound = bound
        self._at: dict[str, int] = {}
        self._table = [np.zeros(bound, np.uint64 if c < 3 else np.int8) for c in range(7)]

    def _entry(self, word: str) -> tuple:
        """(hash inside a sentence, at its start, as written, kind inside, kind at start, is a unit, ends a sentence)."""
        bare = word.strip(_EDGES)
        low = bare.lower()
        inside = start = WORD
        of_inside = of_start = written = _hash(low)
        if low == bare and low.isalpha() and low not in NUMBER_WORDS:  # most words
            pass
        elif _NUMBER.match(bare):
            inside = start = NUMBER
            of_inside = of_start = _hash("<number>")
        elif (measure := _MEASURE.match(bare)) and measure[1].lower() in UNITS:
            inside = start = NUMBER
            of_inside = of_start = _hash("<number><unit>")
        elif all(part in NUMBER_WORDS for part in low.split("-")):
            inside = start = NUMBER
            of_inside = of_start = _hash("<number>")
        elif bare[:1].isupper() and _LETTERS.match(bare):
            inside, of_inside = NAME, _hash("<name>")
        ends = word != bare and word.rstrip("\"')]}”’»")[-1:] in (".", "!", "?")
        return of_inside, of_start, written, inside, start, low in UNITS, ends

    def tokens(self, words: list[str], first: np.ndarray, every: bool) -> "Tokens":
        """The tokens of the words; first marks the words that begin a text.

        A capitalised word that opens a sentence may be a name or not and has both readings;
        with `every`, any capitalised word has.
        """
        at, kept = self._at, len(self._at)
        ids = np.fromiter(map(at.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(ids < 0).tolist()
        new = list(dict.fromkeys(words[k] for k in unknown))
        passing = {w: kept + k for k, w in enumerate(new)}
        ids[unknown] = [passing[words[k]] for k in unknown]
        at.update(zip(new[:self._bound - kept], range(kept, self._bound)))
        passing = new[self._bound - kept:]
        table = self._table
        if new:
            rows = list(zip(*map(self._entry, new), strict=True))
            fresh = [np.array(r, dtype=t.dtype) for r, t in zip(rows, table, strict=True)]
            room = min(len(new), self._bound - kept)
            for t, f in zip(table, fresh, strict=True):
                t[kept:kept + room] = f[:room]
            if passing:
                table = [np.concatenate([t[:kept + room], f[room:]]) for t, f in zip(table, fresh, strict=True)]
        inside, start, written, kind_in, kind_start, unit, ends = (c[ids] for c in table)
        opens = first.copy()
        opens[1:] |= ends[:-1].astype(bool)
        kind = np.where(opens, kind_start, kind_in)
        hashes = np.where(opens, start, inside)
        measured = unit.astype(bool) & ~first
        measured[1:] &= kind[:-1] == NUMBER
        return Tokens(np.where(measured, np.uint64(_hash("<unit>")), hashes), np.where(measured, UNIT, kind),
                      (kind_in == NAME) & (opens | every) & ~measured, np.where(opens, inside, start),
                      np.where(opens, kind_in, kind_start), written)


class Tokens(NamedTuple):
    """Hash and kind of every token; where it is open, it can also be read as other, of kind other_kind; written: no placeholder."""

    hashes: np.ndarray
    kinds: np.ndarray
    open: np.ndarray
    other: np.ndarray
    other_kinds: np.ndarray
    written: np.ndarray


def _window_hashes(tokens: Tokens, left: np.ndarray, n: int, shared: np.ndarray | None
                   ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(starts, hashes, flips) of the windows of n tokens that lie in one text, in all their readings.

    left: tokens from here to the text's end; flips: bit d is set where token d is read the other way. With `shared`
    only windows in which it is true for every token but the last.
    """
    size = max(0, len(left) - n + 1)
    inside = left[:size] >= n
    if shared is not None:
        seen = np.concatenate([[0], np.cumsum(shared, dtype=np.int32)])
        inside &= seen[n - 1:n - 1 + size] - seen[:size] == n - 1
    begin = np.flatnonzero(inside)
    plain = tokens.kinds == WORD
    more = tokens.other - tokens.hashes
    gain = (tokens.other_kinds == WORD).astype(np.int64) - plain
    power = [np.uint64(pow(int(_BASE), n - 1 - d, 2**64)) for d in range(n)]
    for lo in range(0, len(begin), READ_WINDOWS):
        at = begin[lo:lo + READ_WINDOWS]
        total, words, flips = np.zeros(len(at), np.uint64), np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        literal = np.zeros(len(at), np.uint64)
        for d in range(n):
            literal = literal * _BASE + tokens.written[at + d]
        if n < MIN_TOKENS:  # word for word
            yield at, _mixed(literal), flips
            continue
        for d in range(n):
            total = total * _BASE + tokens.hashes[at + d]
            words += plain[at + d]
        as_is = np.flatnonzero((literal != total) | (words < MIN_TOKENS))
        literal, written = literal[as_is], at[as_is]
        for d in range(n):
            two = np.flatnonzero(tokens.open[at + d])
            if len(two):
                of = at[two] + d
                total = np.concatenate([total, total[two] + more[of] * power[d]])
                words = np.concatenate([words, words[two] + gain[of]])
                flips = np.concatenate([flips, flips[two] | 1 << d])
                at = np.concatenate([at, at[two]])
        good = words >= MIN_TOKENS
        at, total = np.concatenate([at[good], written]), np.concatenate([total[good], literal])
        yield at, _mixed(total), np.concatenate([flips[good], np.zeros(len(written), np.int64)])


def _mixed(total: np.ndarray) -> np.ndarray:
    return total ^ total >> np.uint64(29)


_CANON = Canon()


def _has(bitmap: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether the packed bits at the places are set."""
    return (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mixed(first * _BASE + second)


def _word_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Body for map_batches: (text) -> hash of every word, and of every two neighbouring ones, as they are written."""
    for batch in batches:
        out = [np.empty(0, np.uint64)]
        for text in batch.column(0).to_pylist():
            words = np.array([_hash(w.strip(_EDGES).lower()) for w in (text or "").split()], np.uint64)
            out += [words, _pairs(words[:-1], words[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64))], names=["hash"])


def _held(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a bitmap of :func:`_bitmap` may hold the hashes."""
    bits = (8 * len(bitmap)).bit_length() - 1
    return _has(bitmap, hashes >> np.uint64(64 - bits)) & _has(bitmap, hashes & np.uint64(2**bits - 1))


def _windows(lengths: list[int] | None, bitmap: np.ndarray | None, pairs: np.ndarray | None = None):
    """Body for map_batches: (id, text) -> windows; lengths None: each item's own, min(WINDOW, tokens).

    A window of a document can be the benchmark's only if any two neighbouring words in it, where neither can be read as
    a placeholder, are neighbours in the benchmark, too; no other window is hashed. A word that isn't in the benchmark
    and may be a placeholder has no second reading.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), 256):
                batch = whole.slice(lo, 256)
                out: list[tuple] = []
                split = [(t or "").split() for t in batch.column(1).to_pylist()]
                sizes = np.array([len(x) for x in split], dtype=np.int64)
                words = [w for x in split for w in x]
                if words:
                    ends = np.repeat(np.cumsum(sizes), sizes)
                    left = ends - np.arange(len(words))
                    owner = np.repeat(np.arange(len(sizes)), sizes)
                    begins = np.repeat(np.cumsum(sizes) - sizes, sizes)
                    tokens = _CANON.tokens(words, begins == np.arange(len(words)), lengths is None)
                    shared = None
                    if pairs is not None:
                        sure = tokens.open & ~_held(pairs, tokens.written)
                        tokens = tokens._replace(hashes=np.where(sure, tokens.other, tokens.hashes), open=tokens.open & ~sure,
                                                 kinds=np.where(sure, tokens.other_kinds, tokens.kinds))
                        either = (tokens.kinds != WORD) | tokens.open
                        shared = np.append(either[:-1] | either[1:] | _held(pairs, _pairs(tokens.written[:-1], tokens.written[1:])),
                                           True)
                    for n in lengths or range(1, WINDOW + 1):
                        for starts, found, flips in _window_hashes(tokens, left, n, shared):
                            if lengths is None:
                                pick = np.flatnonzero(np.minimum(sizes[owner[starts]], WINDOW) == n)
                            else:
                                pick = np.flatnonzero(_held(bitmap, found))
                            if n == 1:  # a word alone is found only if it is the whole text
                                pick = pick[sizes[owner[starts[pick]]] == 1]
                            at = starts[pick, None] + np.arange(n)
                            flipped = (flips[pick, None] >> np.arange(n) & 1).astype(bool)
                            kinds = np.where(flipped, tokens.other_kinds[at], tokens.kinds[at]).tolist()
                            for s, h, of in zip(starts[pick].tolist(), found[pick].view(np.int64).tolist(), kinds,
                                                strict=True):
                                values = [None if k == WORD or n < MIN_TOKENS else f"{k}{w.strip(_EDGES).lower()}"
                                          for k, w in zip(of, words[s:s + n], strict=True)]
                                out.append((owner[s], s - begins[s], h, values, sizes[owner[s]]))
                cols = list(zip(*out, strict=True)) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()),
                     pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.list_(pa.string())),
                     pa.array(cols[4], pa.int32())],
                    names=["id", "pos", "hash", "slots", "n_tokens"])
    return run


def _schema(key: StructField) -> StructType:
    return (StructType().add("id", key.dataType).add("pos", "integer").add("hash", "long")
            .add("slots", ArrayType(StringType())).add("n_tokens", "integer"))


def agreement(windows: list[dict]) -> tuple[list[int], int, bool]:
    """(tokens covered, windows, whether a value changed) of the windows of one alignment that agree.

    Every benchmark value stands for one document value, a document name for one benchmark name: the pairs of
    most windows first, or the unchanged values first, whichever covers more. Windows with other pairs are left out.
    """
    windows = [(w["pos"], w["size"], {(p["b"], p["d"]) for p in w["pairs"]}) for w in windows]
    support = Counter(p for *_, pairs in windows for p in pairs)
    best: tuple[list[int], int, bool] = [], 0, False
    for same_first in (False, True):
        chosen: dict[str, str] = {}
        taken = set()
        for b, d in sorted(support, key=lambda p: (same_first and p[0] != p[1], -support[p], p[0] != p[1], p)):
            if b not in chosen and d not in taken:
                chosen[b] = d
                if b.startswith(str(NAME)):
                    taken.add(d)
        agree = [w for w in windows if all(chosen.get(b) == d for b, d in w[2])]
        tokens = {t for pos, size, _ in agree for t in range(pos, pos + size)}
        if len(tokens) > len(best[0]):
            best = (sorted(tokens), len({w[0] for w in agree}), any(b != d for w in agree for b, d in w[2]))
    return best


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Body for map_batches: (key, item_id, n_tokens, windows) -> the same with what agrees of the windows."""
    for batch in batches:
        rows = [agreement(w) for w in batch.column(3).to_pylist()]
        tokens, n, changed = zip(*rows, strict=True) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(tokens, pa.list_(pa.int32())), pa.array(n, pa.int32()),
             pa.array(changed, pa.bool_())], names=["__key", "item_id", "n_tokens", "tokens", "n", "changed"])


def _bitmap(items: DataFrame) -> np.ndarray:
    """Packed bits: set for the leading and for the trailing bits of every `hash` of windows, or of words and pairs.

    The bits are set by an aggregation; at most 2 ** MOST_BITS / 64 pairs of
    numbers come to the driver, and 2 ** MOST_BITS / 8 bytes (32 MB) are
    broadcast, whatever the benchmark's size.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, (256 * items.count()).bit_length()))
    both = F.explode(F.array(F.shiftrightunsigned("hash", 64 - bits), F.col("hash").bitwiseAND(2**bits - 1)))
    place = F.col("place")
    words = items.select(both.alias("place")).groupBy(F.shiftright(place, 6).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))).alias("set")).toArrow()
    out = np.zeros(2 ** (bits - 6), dtype="<i8")
    out[words["at"].to_numpy()] = words["set"].to_numpy()
    return out.view(np.uint8)


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id",
                 coverage: float = COVERAGE) -> DataFrame:
    """(key, item_id, coverage, n_windows, reparameterised): one row per document and item it holds.

    `key` names the column of `docs` that tells documents apart. Null and
    empty texts hold nothing. Items of two or three tokens are found wherever
    they stand word for word, an item of one token only in a text that is
    nothing else. Texts of any length are read whole, 256 at a time, and only
    the windows that the benchmark may share leave the task. Rows that repeat
    a key or item_id count as one. A null key or item_id is kept as such.
    Empty tables give no rows.
    """
    items = benchmark.select("item_id", "text")
    items = saved(map_batches(items, _windows(None, None), _schema(items.schema["item_id"])), "benchmark-windows")
    pairs = saved(map_batches(benchmark.select("text"), _word_pairs, "hash long"), "benchmark-pairs")
    shipped = docs.sparkSession.sparkContext.broadcast((_bitmap(items), _bitmap(pairs)))
    # At most WINDOW lengths come to the driver.
    lengths = sorted(r[0] for r in items.select(F.size("slots")).distinct().collect())
    items = items.select(F.col("id").alias("item_id"), F.col("pos").alias("item_pos"), "hash",
                         F.col("slots").alias("item_slots"), "n_tokens")
    if not lengths:
        lengths = [WINDOW]

    def hits(batches):
        yield from _windows(lengths, *shipped.value)(batches)

    found = (map_batches(docs.select(key, "text"), hits, _schema(docs.schema[key]))
             .select(F.col("id").alias("__key"), "pos", "hash", "slots").join(items, "hash"))
    pair = F.filter(F.arrays_zip(F.col("item_slots").alias("b"), F.col("slots").alias("d")),
                    lambda s: s["b"].isNotNull() & s["d"].isNotNull())
    # One alignment holds at most the item's own windows, in their readings.
    window = F.struct(F.col("item_pos").alias("pos"), F.size("slots").alias("size"), pair.alias("pairs"))
    lined_up = (found.groupBy("__key", "item_id", "n_tokens", (F.col("pos") - F.col("item_pos")).alias("shift"))
                .agg(F.collect_set(window).alias("windows")).drop("shift"))
    schema = (StructType(lined_up.schema.fields[:3]).add("tokens", ArrayType(IntegerType())).add("n", "integer")
              .add("changed", "boolean"))
    consistent = map_batches(lined_up, _agreeing, schema)
    together = (consistent.groupBy("__key", "item_id", "n_tokens")
                .agg(F.size(F.array_distinct(F.flatten(F.collect_set("tokens")))).alias("covered"),
                     F.sum("n").alias("n_windows"), F.max("changed").alias("reparameterised")))
    return (together.select(F.col("__key").alias(key), "item_id", (F.col("covered") / F.col("n_tokens")).alias("coverage"),
                            "n_windows", "reparameterised")
            .filter(F.col("coverage") >= coverage).dropDuplicates([key, "item_id"]))


def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
