"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad. A line's features describe its
characters and shape; the field sees those of the line and of its two
neighbours, and a transition weight for every pair of labels. Marginals come
from forward-backward over all lines of the text; the document's quality is
the mean probability of `good`, weighted by the lines' lengths.

Training is on the driver, on a bounded sample of labelled texts (at most
`per_label` of each label, at most `max_bytes` bytes each). Lines have no
labels of their own: they start with their document's, and in documents
marked bad the lines the field itself finds good by a wide margin are given
that label before it is fitted again (junk often follows a normal opening).
Every text is scored whole, in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import fold, map_batches, table

FOLDS, HELD_OUT = 4, 2
GOOD_FROM = 0.7
#: Bound of the training sample: texts of each label, bytes of a text.
PER_LABEL = 1200
MAX_BYTES = 16_384
ROUNDS, STEPS, RATE, DECAY = 3, 120, 0.15, 1e-3
BATCH = 128

_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _MARK, _BAR, _OTHER, _HIGH = range(9)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
for _chars, _kind in (("ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER), ("abcdefghijklmnopqrstuvwxyz", _LOWER),
                      ("0123456789", _DIGIT), (" \t\r\n\x0b\x0c", _SPACE), (".,;:'\"()-", _STOP), ("!?", _MARK),
                      ("|", _BAR)):
    _CLASS[np.frombuffer(_chars.encode(), np.uint8)] = _kind
_CLASS[128:] = _HIGH
N_OWN = 16
N_FEATURES = 3 * N_OWN


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lengths, sizes): a row of own features and a length in bytes per line, and lines per text."""
    raws = [t.encode("utf-8") for t in texts]
    sizes = np.array([r.count(b"\n") + 1 for r in raws], dtype=np.int64)
    joined = b"\n".join(raws) + b"\n"
    buf = np.frombuffer(joined, dtype=np.uint8)
    ends = np.flatnonzero(buf == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    length = (ends - starts).astype(np.float64)
    kinds = _CLASS[buf]
    counts = np.stack([np.add.reduceat(kinds == k, starts, dtype=np.int64) for k in range(9)], axis=1).astype(float)
    counts[:, _SPACE] -= 1  # the line break
    n = np.maximum(length, 1.0)[:, None]
    share = counts / n
    letters = counts[:, _UPPER] + counts[:, _LOWER] + counts[:, _HIGH]
    words = counts[:, _SPACE] + 1
    first, last = buf[starts], buf[np.maximum(ends - 1, starts)]
    same, stutter = np.zeros(len(starts)), np.zeros(len(starts))
    seen: set = set()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for i, (a, b, doc) in enumerate(zip(starts.tolist(), ends.tolist(), owner.tolist(), strict=True)):
        line = joined[a:b]
        if b > a and (doc, line) in seen:
            same[i] = 1.0
        seen.add((doc, line))
        run = line.split()
        stutter[i] = sum(map(eq, run, run[1:])) / max(1, len(run))
    own = np.stack([
        np.ones(len(starts)), np.log1p(length) / 8, counts[:, _UPPER] / np.maximum(letters, 1), share[:, _DIGIT] * 3,
        share[:, _OTHER] * 5, share[:, _MARK] * 5, share[:, _BAR] * 5, share[:, _SPACE] * 3, share[:, _STOP] * 5,
        np.isin(last, [46, 33, 63]), _CLASS[first] == _UPPER, np.minimum(length / words / 12, 3.0), same,
        length == 0, share[:, _HIGH], stutter * 3], axis=1)
    return own, length, sizes


def with_neighbours(own: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Own features beside those of the line before and after (zeros at a text's ends)."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    ends = np.cumsum(sizes)
    before[ends - sizes] = 0
    after[ends - 1] = 0
    return np.concatenate([own, before, after], axis=1)


@dataclass
class Field:
    """weights: features x 2 (bad, good); moves: 2 x 2 transition weights."""

    weights: np.ndarray
    moves: np.ndarray

    def marginals(self, x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability of good per line, expected transitions per text summed up to 2 x 2)."""
        scores = x @ self.weights
        order = np.argsort(-sizes, kind="stable")  # long texts first: the still active ones are a prefix
        sizes, starts = sizes[order], (np.cumsum(sizes) - sizes)[order]
        steps = int(sizes[0]) if len(sizes) else 0
        active = [int(np.searchsorted(-sizes, -t, side="left")) for t in range(steps)]  # texts with more than t lines
        step = np.exp(self.moves - self.moves.max())
        local = np.exp(scores - scores.max(axis=1, keepdims=True))
        alpha, beta = np.zeros_like(local), np.ones_like(local)
        for t in range(steps):
            at = starts[:active[t]] + t
            a = local[at] if t == 0 else (alpha[at - 1] @ step) * local[at]
            alpha[at] = a / a.sum(axis=1, keepdims=True)
        moved = np.zeros((2, 2))
        for t in range(steps - 2, -1, -1):
            at = starts[:active[t + 1]] + t
            ahead = local[at + 1] * beta[at + 1]
            b = ahead @ step.T
            beta[at] = b / b.sum(axis=1, keepdims=True)
            joint = alpha[at][:, :, None] * step[None] * ahead[:, None, :]
            moved += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        p = alpha * beta
        return p[:, 1] / p.sum(axis=1), moved


def document_scores(field: Field, texts: list[str]) -> np.ndarray:
    """Length-weighted mean of the lines' probability to be good; a text without characters: 0."""
    own, length, sizes = line_features(texts)
    good, _ = field.marginals(with_neighbours(own, sizes), sizes)
    at = np.cumsum(sizes) - sizes
    total = np.add.reduceat(length, at)
    return np.where(total > 0, np.add.reduceat(length * good, at) / np.maximum(total, 1.0), 0.0).clip(0.0, 1.0)


def fit(texts: list[str], labels: list[int]) -> Field:
    """Conditional likelihood by gradient steps (Adam) on line labels that start as the documents' labels."""
    own, length, sizes = line_features(texts)
    x = with_neighbours(own, sizes)
    doc = np.repeat(np.array(labels), sizes)
    weight = np.repeat(np.where(np.array(labels) == 1, 0.5 / max(1, labels.count(1)), 0.5 / max(1, labels.count(0)))
                       / sizes, sizes) * len(x)  # both labels and all documents count alike
    y = doc.copy()
    inner = np.ones(len(x), bool)
    inner[np.cumsum(sizes) - 1] = False  # lines with a next one
    field = Field(np.zeros((x.shape[1], 2)), np.zeros((2, 2)))
    for round_ in range(ROUNDS):
        state = [np.zeros_like(v) for v in (field.weights, field.weights, field.moves, field.moves)]
        pairs = np.zeros((2, 2))
        np.add.at(pairs, (y[:-1][inner[:-1]], y[1:][inner[:-1]]), 1.0)
        for k in range(1, STEPS + 1):
            good, moved = field.marginals(x, sizes)
            error = (y - good) * weight / len(x)
            down = x.T @ error
            grads = (np.stack([-down, down], axis=1) - DECAY * field.weights,
                     (pairs - moved) / len(x) - DECAY * field.moves)
            for i, (value, g) in enumerate(zip((field.weights, field.moves), grads, strict=True)):
                m, v = state[2 * i], state[2 * i + 1]
                m[:] = 0.9 * m + 0.1 * g
                v[:] = 0.99 * v + 0.01 * g * g
                value += RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        good, _ = field.marginals(x, sizes)
        y = np.where((doc == 0) & (good > 0.95), 1, doc)
    return field


def training_sample(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL,
                    max_bytes: int = MAX_BYTES) -> DataFrame:
    """(doc_id, text, quality): at most `per_label` texts of each label from outside the held-out fold.

    The ids' hashes choose the rows. Ids with labels that disagree, null
    labels and texts that are null or empty are left out; of an id that
    repeats, one text is taken. Texts over `max_bytes` bytes are taken where a
    label has too few others, as many as fit in what the others might have
    had, and at least one. At most 2 * `per_label` ids come to the driver.
    """
    known = (labels.select("doc_id", "quality").filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)
                                                       & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
             .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("__most"))
             .filter(F.col("quality") == F.col("__most")).drop("__most"))
    size = F.octet_length("text")
    texts = docs.select("doc_id", "text").filter(size >= 1)
    # One row for each id, without its text: the shortest, then by the hash. Repeats meet in the partial aggregation.
    sizes = texts.groupBy("doc_id").agg(F.min(F.struct(size.alias("size"), F.xxhash64("text").alias("hash"))).alias("of"))
    labelled = sizes.join(known, "doc_id").select("doc_id", "quality", "of.*")
    picked = []
    for q in (0, 1):
        first = (labelled.filter(F.col("quality") == q)
                 .orderBy((F.col("size") > max_bytes).cast("int"), F.xxhash64("doc_id"), "doc_id").limit(per_label).collect())
        total = 0
        for r in first:
            total += r["size"]
            if total > per_label * max_bytes and r is not first[0]:
                break
            picked.append((r["doc_id"], r["hash"], q))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.sparkSession.createDataFrame(picked, f"doc_id {kind}, __hash long, quality int")
    return (texts.withColumn("__hash", F.xxhash64("text")).join(F.broadcast(rows), ["doc_id", "__hash"])  # 2 * per_label rows
            .groupBy("doc_id").agg(F.first("text").alias("text"), F.first("quality").alias("quality")))


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Field | None:
    """The fitted field, or None if a label has no text to learn from."""
    rows = training_sample(docs, labels, per_label).select("text", "quality", F.xxhash64("doc_id").alias("h")).collect()
    rows = sorted(rows, key=lambda r: (r["h"], r["text"]))
    rows = [r for q in (0, 1) for r in rows if r["quality"] == q]
    if len({r["quality"] for r in rows}) < 2:
        return None
    return fit([r["text"] for r in rows], [r["quality"] for r in rows])


def score(docs: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, score): one row per row of `docs`.

    A null or empty text scores 0, as there is nothing good in it; without a
    field (nothing to learn from) every other text scores 0.5.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for whole in batches:
            for lo in range(0, len(whole), BATCH):
                batch = whole.slice(lo, BATCH)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                scores = (document_scores(own, texts) if own
                          else np.array([0.5 if t else 0.0 for t in texts], dtype=np.float64))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, score double")


def op5_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))
