"""Language identification with string kernels.

Kernel: blended-spectrum presence kernel over byte n-grams (n = 1..3) of the
lower-cased text, in which runs of anything but letters count as one space.
For each n, two texts share the n-grams both contain; the kernel is the mean
over n of that count divided by the geometric mean of the two texts' own
counts. The n-grams are those that occur in the training texts.

Nyström: a few training texts of every language are landmarks; a text is
represented by its kernel values to them, whitened by the landmarks' own
kernel matrix. One-versus-rest kernel ridge regression is solved in that
space, on a bounded sample of training texts. A batch of texts is scored by
two matrix products: presence x landmarks, kernel values x coefficients.

Only the fit is on the driver: at most `per_language` texts of at most
`max_bytes` bytes for each of at most MAX_LANGUAGES languages. Every text is
scored whole, in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from contrail.llm.common import fold, map_batches, saved, table

UNDETERMINED = "und"
FOLDS, HELD_OUT = 5, 0
#: Bound of the training sample: texts per language, bytes of a text (on average, where only long ones are there), texts in
#: all (but one of each language at least).
PER_LANGUAGE = 400
MAX_BYTES = 8192
MAX_TEXTS = 80_000
#: Languages whose counts are sent to all tasks; with more they are joined.
SENT_LANGUAGES = 100_000
#: Landmarks per language and in all, n-grams kept, ridge, sharpness of the softmax over the decision values.
LANDMARKS_PER_LANGUAGE = 24
MAX_LANDMARKS = 1024
MAX_GRAMS = 16_384  # fits the 16-bit column numbers
RIDGE = 0.1
SHARPNESS = 4.0
BATCH = 64

_SPACE = np.full(256, 0, dtype=np.uint8)
_SPACE[ord("a"):ord("z") + 1] = 1
_SPACE[128:] = 1


def _letters(text: str | None) -> bytes:
    """Lower-cased UTF-8 bytes; every byte that is not of a letter is a space, runs are one, one at each end."""
    raw = np.frombuffer(_lower(text or ""), dtype=np.uint8)
    letter = _SPACE[raw].astype(bool)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first byte after a letter stays, as a space
    out = np.where(letter, raw, np.uint8(32))[keep]
    if not letter.any():
        return b""
    return b" " + out.tobytes() + (b"" if out[-1] == 32 else b" ")


def _lower(text: str) -> bytes:
    raw = text.lower().encode("utf-8")
    if text.isascii():
        return raw
    # Characters past ASCII that are not letters (dashes, quotes, other signs) count as spaces, too.
    odd = {c for c in set(text.lower()) if ord(c) > 127 and not c.isalpha()}
    return text.lower().translate(dict.fromkeys(map(ord, odd), " ")).encode("utf-8") if odd else raw


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def _grams(text: str | None) -> list[np.ndarray]:
    """Codes of the 1-, 2- and 3-grams, repeats included: below 2^8, 2^16 and 2^24."""
    b = np.frombuffer(_letters(text), dtype=np.uint8).astype(np.int32)
    return [b, (b[:-1] << 8) | b[1:], (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]]


@dataclass
class Model:
    """languages; grams: per n the sorted codes kept; landmarks: per n a 0/1 matrix; coef: landmarks x languages."""

    languages: list[str]
    grams: list[np.ndarray]
    landmarks: list[np.ndarray]
    coef: np.ndarray

    def __post_init__(self):
        self._columns = None

    def _presence(self, texts: list[str | None]) -> list[np.ndarray]:
        if self._columns is None:
            self._columns = []
            for n, codes in enumerate(self.grams, 1):
                at = np.full(256**n, len(codes), dtype=np.int16)
                at[codes] = np.arange(len(codes))
                self._columns.append(at)
        out = [np.zeros((len(texts), len(codes) + 1), dtype=np.float32) for codes in self.grams]
        for row, text in enumerate(texts):
            for present, at, codes in zip(out, self._columns, _grams(text), strict=True):
                present[row, at[codes]] = 1.0
        return [x[:, :-1] for x in out]

    def kernel(self, texts: list[str | None]) -> np.ndarray:
        """Kernel values of the texts (rows) to the landmarks."""
        return _kernel(self._presence(texts), self.landmarks)

    def decide(self, texts: list[str | None]) -> np.ndarray:
        return self.kernel(texts) @ self.coef


def _kernel(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    total = 0.0
    for x, z in zip(a, b, strict=True):
        own, other = (np.sqrt(np.maximum(m.sum(axis=1), 1.0)) for m in (x, z))
        total = total + (x @ z.T) / own[:, None] / other[None, :]
    return total / len(a)


def fit(texts: list[str], languages: list[str]) -> Model:
    """Kernel ridge regression on a training sample given in a fixed order."""
    names = sorted(set(languages))
    grams = []
    docs = [[np.unique(g) for g in _grams(t)] for t in texts]
    for n in range(3):
        codes, seen = np.unique(np.concatenate([d[n] for d in docs]), return_counts=True)
        if len(codes) > MAX_GRAMS:  # the most widespread ones
            codes = codes[np.lexsort((codes, -seen))[:MAX_GRAMS]]
        grams.append(np.sort(codes))
    quota = max(1, min(LANDMARKS_PER_LANGUAGE, MAX_LANDMARKS // len(names)))
    picked: list[int] = []
    for name in names:
        picked += [i for i, x in enumerate(languages) if x == name][:quota]
    model = Model(names, grams, [], np.empty(0))
    model.landmarks = model._presence([texts[i] for i in picked])
    base = _kernel(model.landmarks, model.landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh(base)
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    target = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # every language weighs the same, however many of its texts are in the sample
    weight = 1.0 / np.array([languages.count(x) for x in languages], dtype=np.float64)
    weight *= len(texts) / weight.sum()
    gram, cross = np.zeros((whiten.shape[1],) * 2), np.zeros((whiten.shape[1], len(names)))
    for lo in range(0, len(texts), BATCH):
        phi = model.kernel(texts[lo:lo + BATCH]) @ whiten
        w = weight[lo:lo + BATCH, None]
        gram += phi.T @ (w * phi)
        cross += phi.T @ (w * target[lo:lo + BATCH])
    model.coef = (whiten @ np.linalg.solve(gram + RIDGE * np.eye(len(gram)), cross)).astype(np.float32)
    return model


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE, max_bytes: int = MAX_BYTES,
                    max_texts: int = MAX_TEXTS) -> DataFrame:
    """At most `per_language` labelled texts of each language outside the held-out fold, in a fixed order.

    Texts without a letter are not taken. Texts over `max_bytes` bytes are
    taken where a language has too few others, as many as fit in what the
    others might have had, and at least one. With very many languages each has
    fewer texts (`max_texts` in all), but none is left out. The ids' hashes
    choose: a rate from the language's count first, then the lowest ranks, so
    that no language's whole table meets in one task.
    """
    size = F.octet_length("text")
    usable = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("text").rlike("\\p{L}")
    ).withColumn("long", (size > max_bytes).cast("int"))
    draw = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("language")), 11).cast("double") / float(2**53))
    counts = saved(usable.groupBy("lang").agg(F.count_if(F.col("long") == 0).alias("short"), F.count(F.lit(1)).alias("n")),
                   "language-counts")
    languages = counts.count()
    each = max(1, min(per_language, max_texts // max(1, languages)))
    of_kind = F.when(F.col("long") == 0, F.col("short")).when(F.col("short") < each, F.col("n") - F.col("short"))
    near = (usable.withColumn("draw", draw).join(F.broadcast(counts) if languages <= SENT_LANGUAGES else counts, "lang")
            .filter(F.col("draw") * of_kind <= 2.0 * each + 20.0))
    order = Window.partitionBy("lang").orderBy("long", "draw", "doc_id", "text")
    ranked = (near.withColumn("rank", F.row_number().over(order))
              .withColumn("bytes", F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0))))
    fits = (F.col("bytes") <= each * max_bytes) | (F.col("rank") == 1)
    return ranked.filter((F.col("rank") <= each) & fits).select("lang", "rank", "text")


def train(docs: DataFrame) -> Model | None:
    """The model, or None if no text is labelled."""
    rows = sorted(training_sample(docs).collect(), key=lambda r: (r["lang"], r["rank"]))
    return fit([r["text"] for r in rows], [r["lang"] for r in rows]) if rows else None


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """`docs` with lang_pred and score (replacing columns of these names).

    score is the softmax over the one-versus-rest decision values. A null
    text, one without a letter, and any text if there was nothing to learn
    from gives ``und`` with score 0.
    """
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]
    text = columns.index("text")
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for whole in batches:
            for lo in range(0, len(whole), BATCH):
                batch = whole.slice(lo, BATCH)
                texts = batch.column(text).to_pylist()
                lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                some = [i for i, t in enumerate(texts) if has_letter(t)] if own else []
                if some:
                    z = own.decide([texts[i] for i in some]).astype(np.float64) * SHARPNESS
                    p = np.exp(z - z.max(axis=1, keepdims=True))
                    p /= p.sum(axis=1, keepdims=True)
                    for i, k, s in zip(some, p.argmax(axis=1), p.max(axis=1), strict=True):
                        lang[i], score[i] = own.languages[k], s
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang), pa.array(score)],
                                                 names=[*columns, "lang_pred", "score"])

    slim = docs.select(*columns)
    return map_batches(slim, run, StructType([*slim.schema.fields, StructField("lang_pred", StringType()),
                                            StructField("score", DoubleType())]))


def op9_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (identify(docs.select("doc_id", "text"), train(docs))
            .select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score"))
