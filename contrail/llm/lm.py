"""Language-model scoring with causal self-attention over subword ids.

A text is its words, lower-cased (A-Z), each cut into the subword ids of
" word", and one end id. The model reads windows of CONTEXT + STRIDE ids:
an embedding, one causal self-attention layer with relative position biases,
a residual sum, a hidden layer and a softmax over classes of ids in two
levels (GROUPS groups of MEMBERS classes); an id's probability is its group's
times its class's in the group times its share in the class. The most frequent
ids are classes of their own, the others are cut into classes of equal mass.
Windows overlap by CONTEXT ids, which are keys only, so every id is scored
exactly once, with at least CONTEXT ids before it (or all there are).

Word counts, id counts, classes and the shares in them come from all
training texts. Word counts are a shuffle of per-batch counts; the id counts
follow from tokenising every distinct word once. Texts are tokenised once,
into a saved table of ids that learning and scoring read. The network's
weights start from a fit on about SAMPLE_WINDOWS windows in one task and then
learn from every window of all training texts, of any length, once: each is in
one of the rounds, by a hash. The windows are dealt by their hashes to
learners, whose number grows with the windows, and the learners' weights are
averaged between the rounds; nothing depends on how the input is split into
tasks.

Beside the model there is a plain add-one unigram score of the words. The
counts of the most frequent words (FREQUENT of them at most) are sent to the
tasks; the other words of a text leave the task and meet their counts in a
join, where no word has many rows, as the frequent ones are gone.
"""

from __future__ import annotations

import base64
import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import fold, map_batches, saved, table
from contrail.llm.packing import TOKENIZER

FOLDS, HELD_OUT = 7, 2
VOCABULARY = 50_257
END = VOCABULARY  # also stands before a text
PAD = VOCABULARY + 1
CONTEXT, STRIDE = 8, 16
WIDTH, HIDDEN, GROUPS, MEMBERS, RARE_CLASSES, INPUTS = 16, 32, 8, 16, 24, 4096
CLASSES = GROUPS * MEMBERS
FREQUENT = 1 << 18
#: Windows, about, the weights are first fitted on in one task, before they learn from all training texts.
SAMPLE_WINDOWS = 50_000
STEPS, BATCH_WINDOWS, RATE = 1200, 128, 0.01
#: Learning from all texts: windows of a step, windows of a learner and round, rate of every round.
PASS_WINDOWS, LEARNER_WINDOWS, PASS_RATES = 256, 1 << 16, (0.01, 0.003)
#: Distinct words a task counts before it hands them on, words whose ids a worker keeps; windows scored at once; texts at once.
COUNT_WORDS, CACHE_WORDS = 400_000, 200_000
SCORE_WINDOWS = 1024
SCORE_TEXTS = 500
#: Windows a task gathers, about, before it hands them on in one block for each learner.
BLOCK_WINDOWS = 1 << 17


#: Every byte as it counts for words: A-Z in lower case, white space as a space.
_SPACED = np.arange(256, dtype=np.uint8)
_SPACED[65:91] += 32
_SPACED[9:14] = 32


class Read(NamedTuple):
    """The words of some texts: distinct ones, which of them stand where, and how many each text has."""

    distinct: list[bytes]
    at: np.ndarray
    n: np.ndarray


def words_in(texts: pa.Array) -> Read:
    """Words of the texts: A-Z lower-cased, cut at the six ASCII white spaces; a null text has none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    if len(texts) and data is not None:
        ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        spaced = _SPACED[np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]]
        texts = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends - ends[0]), pa.py_buffer(spaced))
    split = pc.split_pattern(texts, " ")
    flat, ends = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
    some = pc.greater(pc.binary_length(flat), 0)  # spaces next to each other give empty ones
    before = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    coded = flat.filter(some).dictionary_encode()
    return Read(coded.dictionary.cast(pa.large_binary()).to_pylist(), coded.indices.to_numpy(), np.diff(before[ends]))


class Subwords:
    """Subword ids of " word", as packed 16-bit little-endian bytes; CACHE_WORDS words are kept."""

    def __init__(self, name: str = TOKENIZER, cache_words: int = CACHE_WORDS):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
        self._plain = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._opens = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self._opens[[i for raw, i in ranks.items() if raw[:1] == b" "]] = True
        self._bound = cache_words
        self._kept: dict[bytes, bytes] = {}

    def _encode(self, words: list[bytes]) -> list[bytes]:
        """All words in one call: a word's ids begin at the only one of them that begins with a space."""
        ids = np.array(self._plain.encode_ordinary(" " + b" ".join(words).decode()), dtype="<u2")
        at = np.flatnonzero(self._opens[ids])
        if len(at) != len(words) or at[0]:
            return [np.array(self._plain.encode_ordinary(" " + w.decode()), dtype="<u2").tobytes() for w in words]
        raw, cuts = ids.tobytes(), [*(2 * at).tolist(), 2 * len(ids)]
        return [raw[lo:hi] for lo, hi in zip(cuts, cuts[1:], strict=False)]

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words."""
        out = list(map(self._kept.get, words))
        if None in out:
            gaps = [i for i, x in enumerate(out) if x is None]
            for i, ids in zip(gaps, self._encode([words[i] for i in gaps]), strict=True):
                out[i] = ids
            for i in gaps[:max(0, self._bound - len(self._kept))]:
                self._kept[words[i]] = out[i]
        return out

    def texts(self, read: Read) -> list[np.ndarray]:
        """Ids of every text."""
        ids = self.words(read.distinct)
        flat = np.frombuffer(b"".join(ids), "<u2")
        size = np.array([len(x) // 2 for x in ids], dtype=np.int64)
        begin = np.cumsum(size) - size
        n = size[read.at]
        ends = np.cumsum(n)
        whole = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[read.at] - ends + n, n)]
        cuts = np.concatenate([[0], ends])[np.cumsum(read.n)]
        return np.split(whole, cuts[:-1]) if len(cuts) else []


_SUBWORDS: dict[str, Subwords] = {}


def subwords(name: str) -> Subwords:
    """One for each Python worker, kept between tasks."""
    if name not in _SUBWORDS:
        _SUBWORDS[name] = Subwords(name)
    return _SUBWORDS[name]


# ---------------------------------------------------------------- corpus counts

def word_counts(docs: DataFrame) -> DataFrame:
    """(word: binary, c): exact counts over all texts of `docs`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()),
                                               pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
        for whole in batches:
            for lo in range(0, len(whole), SCORE_TEXTS):
                read = words_in(whole.column(0).slice(lo, SCORE_TEXTS))
                counts.update(dict(zip(read.distinct, np.bincount(read.at, minlength=len(read.distinct)).tolist(), strict=True)))
                if len(counts) > COUNT_WORDS:
                    yield out()
                    counts.clear()
        yield out()

    return map_batches(docs.select("text"), run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def id_counts(words: DataFrame, tokenizer: str = TOKENIZER) -> np.ndarray:
    """Counts of all subword ids in the counted words (at most VOCABULARY rows come to the driver)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, total = subwords(tokenizer), np.zeros(VOCABULARY, dtype=np.int64)
        for batch in batches:
            ids = [np.frombuffer(x, "<u2") for x in enc.words(batch.column(0).to_pylist())]
            if ids:
                times = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), [len(x) for x in ids])
                np.add.at(total, np.concatenate(ids), times)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["id", "c"])

    out = np.zeros(VOCABULARY, dtype=np.int64)
    for r in map_batches(words, run, "id int, c long").groupBy("id").agg(F.sum("c").alias("c")).collect():
        out[r["id"]] = r["c"]
    return out


# ---------------------------------------------------------------- the network

#: Scores and logits are cut here, so that their exponentials can be added without looking for the largest one.
LIMIT = np.float32(60)
#: What is smaller is taken as zero, as products with denormal numbers are several times slower.
TINY, LEAST_LOGIT = np.float32(1e-30), np.float32(-80)
#: Adds up the groups' and the members' columns of a row.
BOTH = np.repeat(np.eye(2, dtype=np.float32), [GROUPS, MEMBERS], axis=0)


def _exp(x: np.ndarray) -> np.ndarray:
    np.minimum(x, LIMIT, out=x)
    return np.exp(x, out=x)


@dataclass
class Attention:
    """Weights; class_of and log_share (log10) for every id; row_of: an id's embedding row."""

    class_of: np.ndarray
    log_share: np.ndarray
    row_of: np.ndarray
    weights: dict[str, np.ndarray]

    def __post_init__(self):
        self._tables = None

    def class_of_row(self) -> np.ndarray:
        """The class of a target, from its embedding row: ids that share a row are of one class. PAD is never used."""
        out = np.zeros(INPUTS, dtype=np.uint8)
        out[self.row_of[:END + 1]] = self.class_of
        out[self.row_of[PAD]] = self.class_of[END]
        return out

    def _prepared(self):
        if self._tables is None:
            w = self.weights
            scale = np.float32(1 / np.sqrt(WIDTH))
            queries, keys, values = w["E"] @ w["Q"] * scale, w["E"] @ w["K"], w["E"] @ w["V"] @ w["O"]
            # A value more, always one: its mixture is the sum of the weights. Keys a query must not see weigh nothing.
            values = np.column_stack([values, np.ones(len(values))])
            bias = np.where(MASK[CONTEXT:] > 0, w["R"][CONTEXT:], -np.inf)
            # Groups' and members' weights side by side: one product gives both levels of the softmax.
            both = np.concatenate([np.repeat(w["U"][None], GROUPS, axis=0), w["W"]], axis=2)
            both_bias = np.concatenate([np.repeat(w["u"][None], GROUPS, axis=0), w["w"]], axis=1)
            self._tables = tuple(np.ascontiguousarray(x, dtype=np.float32)
                                 for x in (w["E"], queries, keys, values, bias, both, both_bias))
            self._places = (self.class_of // MEMBERS).astype(np.uint8), (self.class_of % MEMBERS).astype(np.intp)
        return self._tables

    def log10(self, ids: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """log10 probability of `targets` (n, STRIDE) after the windows `ids` (n, CONTEXT + STRIDE)."""
        w, (own, queries, keys, values, bias, both, both_bias) = self.weights, self._prepared()
        rows = self.row_of[ids]
        late = rows[:, CONTEXT:]
        scores = np.matmul(queries[late], keys[rows].transpose(0, 2, 1))
        scores += bias
        np.minimum(scores, LIMIT, out=scores)
        np.exp(scores, out=scores)
        mixture = np.matmul(scores, values[rows])
        h = own[late] + mixture[:, :, :WIDTH] / mixture[:, :, WIDTH:]
        z = np.maximum(h.reshape(-1, WIDTH) @ w["A"] + w["a"], 0)
        flat = targets.ravel()
        group = self._places[0][flat]
        order = np.argsort(group, kind="stable")
        z, member = z[order], self._places[1][flat[order]]
        ends = np.searchsorted(group[order], np.arange(GROUPS + 1))
        out = np.empty(len(flat), dtype=np.float32)
        for g in range(GROUPS):
            lo, hi = ends[g], ends[g + 1]
            logits = z[lo:hi] @ both[g]
            logits += both_bias[g]
            np.minimum(logits, LIMIT, out=logits)
            picked = logits[:, g] + logits[np.arange(hi - lo), member[lo:hi] + GROUPS]
            np.maximum(logits, LEAST_LOGIT, out=logits)
            totals = np.exp(logits, out=logits) @ BOTH
            out[order[lo:hi]] = picked - np.log(totals[:, 0] * totals[:, 1])
        return (out * np.float32(1 / np.log(10)) + self.log_share[flat]).reshape(targets.shape)

    def text_scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 probability of every text, given as its ids without the end."""
        n = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        m = -(-n // STRIDE)
        size = CONTEXT + m * STRIDE
        begin = np.cumsum(size) - size
        flat = np.full(int(size.sum()) + 1, PAD, dtype=np.int32)
        for t, b in zip(texts, begin.tolist(), strict=True):
            flat[b + CONTEXT] = END
            flat[b + CONTEXT + 1:b + CONTEXT + 1 + len(t)] = t
            flat[b + CONTEXT + 1 + len(t)] = PAD  # the end is a target only
        first = np.repeat(begin, m) + (np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)) * STRIDE
        owner = np.repeat(np.arange(len(texts)), m)
        left = np.repeat(n, m) - (first - np.repeat(begin, m))  # targets from this window's first on
        sums = np.zeros(len(first))
        for lo in range(0, len(first), SCORE_WINDOWS):
            every = flat[first[lo:lo + SCORE_WINDOWS, None] + np.arange(CONTEXT + STRIDE + 1)]
            targets = every[:, CONTEXT + 1:].copy()
            rest = left[lo:lo + SCORE_WINDOWS]
            last = np.flatnonzero(rest <= STRIDE)  # the text ends in these
            targets[last, rest[last] - 1] = END
            got = self.log10(every[:, :-1], np.minimum(targets, END))
            got[last] *= np.arange(STRIDE) < rest[last, None]
            sums[lo:lo + SCORE_WINDOWS] = got.sum(axis=1, dtype=np.float64)
        return np.bincount(owner, weights=sums, minlength=len(texts))


MASK = np.tril(np.ones((CONTEXT + STRIDE, CONTEXT + STRIDE), dtype=np.float32))


def classes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class_of, log10 share in the class) of every id and END, from add-one counts.

    END has a class of its own; PAD is never a target. Classes are numbered by
    falling mass, so a group holds MEMBERS classes of similar mass.
    """
    mass = counts + 1.0
    order = np.lexsort((np.arange(VOCABULARY), -mass))
    class_of = np.full(VOCABULARY + 1, CLASSES - 1, dtype=np.int64)
    alone = CLASSES - 1 - RARE_CLASSES
    class_of[order[:alone]] = np.arange(alone)
    rest = order[alone:]
    before = np.cumsum(mass[rest]) - mass[rest]
    class_of[rest] = alone + np.minimum((before / mass[rest].sum() * RARE_CLASSES).astype(np.int64), RARE_CLASSES - 1)
    full = np.append(mass, 1.0)
    total = np.bincount(class_of, weights=full, minlength=CLASSES)
    share = np.log10(full / total[class_of]).astype(np.float32)
    rank = np.empty(CLASSES, dtype=np.int64)
    rank[np.lexsort((np.arange(CLASSES), -total))] = np.arange(CLASSES)
    return rank[class_of], share


APART = np.maximum(np.arange(CONTEXT + STRIDE)[:, None] - np.arange(CONTEXT + STRIDE)[None, :], 0)


def _beginning(counts: np.ndarray, ends: int, rng: np.random.Generator) -> Attention:
    """The network before it has read anything: random weights, output biases of the classes' frequencies."""
    class_of, log_share = classes(counts)
    top = np.lexsort((np.arange(VOCABULARY), -counts))[:INPUTS - CLASSES - 2]
    row_of = np.empty(VOCABULARY + 2, dtype=np.int32)
    row_of[:VOCABULARY] = len(top) + class_of[:VOCABULARY]  # an infrequent id is read as its class
    row_of[top] = np.arange(len(top))
    row_of[END], row_of[PAD] = INPUTS - 2, INPUTS - 1

    def start(*shape):
        return (rng.standard_normal(shape) * (0.5 if len(shape) == 1 else 1 / np.sqrt(shape[0]))).astype(np.float32)

    prior = np.bincount(class_of, weights=np.append(counts + 1.0, ends + 1.0), minlength=CLASSES) + 1e-9
    w = {"E": start(INPUTS, WIDTH) * np.float32(np.sqrt(INPUTS) * 0.3), "Q": start(WIDTH, WIDTH), "K": start(WIDTH, WIDTH),
         "V": start(WIDTH, WIDTH), "O": start(WIDTH, WIDTH), "r": np.zeros(CONTEXT + STRIDE, np.float32),
         "A": start(WIDTH, HIDDEN), "a": np.zeros(HIDDEN, np.float32), "U": start(HIDDEN, GROUPS) * np.float32(0.3),
         "W": start(GROUPS, HIDDEN, MEMBERS) * np.float32(0.3 * np.sqrt(GROUPS / HIDDEN))}
    prior = prior.reshape(GROUPS, MEMBERS)
    w["u"] = np.log(prior.sum(axis=1) / prior.sum()).astype(np.float32)
    w["w"] = np.log(prior / prior.sum(axis=1, keepdims=True)).astype(np.float32)
    return Attention(class_of, log_share, row_of, w)


class Windows:
    """All windows of some texts, cut as in scoring."""

    def __init__(self, texts: list[np.ndarray]):
        sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        self._flat = np.concatenate([np.concatenate([np.full(CONTEXT, PAD), [END], t, [END], np.full(STRIDE, PAD)])
                                     for t in texts]).astype(np.int32) if texts else np.empty(0, np.int32)
        span = sizes + 1 + CONTEXT + STRIDE
        begin = np.cumsum(span) - span
        chunks = -(-sizes // STRIDE)
        self._where = (np.repeat(begin, chunks)
                       + (np.arange(chunks.sum()) - np.repeat(np.cumsum(chunks) - chunks, chunks)) * STRIDE)
        self._left = np.repeat(sizes, chunks) - (self._where - np.repeat(begin, chunks))

    def __len__(self) -> int:
        return len(self._where)

    def take(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, targets, which targets belong to the text) of the picked windows."""
        at = self._where[pick, None]
        return (self._flat[at + np.arange(CONTEXT + STRIDE)], self._flat[at + np.arange(CONTEXT + 1, CONTEXT + STRIDE + 1)],
                (np.arange(STRIDE) < self._left[pick, None]).ravel())


def _softmax_error(logits: np.ndarray, at: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Gradient of the weighted cross-entropy by the logits."""
    raised = _exp(logits)
    raised *= (part / (raised @ np.ones(raised.shape[1], np.float32)))[:, None]
    raised *= raised > TINY
    raised[np.arange(len(raised)), at] -= part
    return raised


class Learner:
    """Adam on the class cross-entropy; changes the network's weights in place."""

    def __init__(self, network: Attention):
        self._network, self.steps = network, 0
        self._m1, self._m2 = ({k: np.zeros_like(v) for k, v in network.weights.items()} for _ in range(2))

    def step(self, rows: np.ndarray, classes: np.ndarray, used: np.ndarray, rate: float) -> None:
        """One batch: embedding rows (n, CONTEXT + STRIDE) and classes of the n * STRIDE targets."""
        self.steps += 1
        g = self._gradients_of(rows, classes, used)
        for name, value in self._network.weights.items():
            m1, m2, own = self._m1[name], self._m2[name], g[name]
            by = own - m1
            by *= 0.1
            m1 += by
            np.multiply(own, own, out=by)
            by -= m2
            by *= 0.01
            m2 += by
            np.divide(m2, 1 - 0.99**self.steps, out=by)
            np.sqrt(by, out=by)
            by += 1e-8
            up = rate * m1
            up /= 1 - 0.9**self.steps
            up /= by
            value -= up

    def _gradients(self, ids: np.ndarray, targets: np.ndarray, used: np.ndarray) -> dict[str, np.ndarray]:
        network = self._network
        return self._gradients_of(network.row_of[ids], network.class_of[np.minimum(targets, END).ravel()], used)

    def _gradients_of(self, rows: np.ndarray, classes: np.ndarray, used: np.ndarray) -> dict[str, np.ndarray]:
        w = self._network.weights
        scale = np.float32(1 / np.sqrt(WIDTH))
        x = w["E"][rows]
        q, k, v = x[:, CONTEXT:] @ w["Q"], x @ w["K"], x @ w["V"]
        s = q @ k.transpose(0, 2, 1)
        s *= scale
        s += w["r"][APART[CONTEXT:]]
        np.minimum(s, 60, out=s)
        np.exp(s, out=s)
        s *= MASK[CONTEXT:]
        s /= s.sum(axis=2, keepdims=True)
        c = s @ v
        h = c @ w["O"]
        h += x[:, CONTEXT:]
        part = used / np.float32(max(1, used.sum()))
        group, member = classes // MEMBERS, classes % MEMBERS
        hf = h.reshape(-1, WIDTH)
        z = hf @ w["A"]
        z += w["a"]
        np.maximum(z, 0, out=z)
        logits = z @ w["U"]
        logits += w["u"]
        p = _softmax_error(logits, group, part)
        g = {"U": z.T @ p, "u": p.sum(axis=0), "W": np.empty_like(w["W"]), "w": np.empty_like(w["w"])}
        dz = p @ w["U"].T
        # Targets in the order of their groups, so that a group's are next to each other.
        order = np.argsort(group.astype(np.uint8), kind="stable")
        ends = np.searchsorted(group[order], np.arange(GROUPS + 1))
        by_group, member, part = z[order], member[order], part[order]
        of_members = np.empty_like(by_group)
        for j in range(GROUPS):
            own = slice(ends[j], ends[j + 1])
            logits = by_group[own] @ w["W"][j]
            logits += w["w"][j]
            p = _softmax_error(logits, member[own], part[own])
            g["W"][j], g["w"][j] = by_group[own].T @ p, p.sum(axis=0)
            of_members[own] = p @ w["W"][j].T
        dz[order] += of_members
        dz *= z > 0
        g["A"], g["a"] = hf.T @ dz, dz.sum(axis=0)
        dh = dz @ w["A"].T
        g["O"] = c.reshape(-1, WIDTH).T @ dh
        dh = dh.reshape(h.shape)
        dc = dh @ w["O"].T
        ds = dc @ v.transpose(0, 2, 1)
        dv = s.transpose(0, 2, 1) @ dc
        ds -= (ds * s).sum(axis=2, keepdims=True)
        ds *= s
        g["r"] = np.bincount(APART[CONTEXT:].ravel(), weights=ds.sum(axis=0).ravel(),
                             minlength=CONTEXT + STRIDE).astype(np.float32)
        dq, dk = ds @ k, ds.transpose(0, 2, 1) @ q
        dq *= scale
        dk *= scale
        late, every = x[:, CONTEXT:].reshape(-1, WIDTH), x.reshape(-1, WIDTH)
        g["Q"], g["K"], g["V"] = (late.T @ dq.reshape(-1, WIDTH), every.T @ dk.reshape(-1, WIDTH),
                                  every.T @ dv.reshape(-1, WIDTH))
        dx = dk @ w["K"].T
        dx += dv @ w["V"].T
        dh += dq @ w["Q"].T
        dx[:, CONTEXT:] += dh
        cells = rows.reshape(-1, 1).astype(np.intp) * WIDTH + np.arange(WIDTH)
        g["E"] = np.bincount(cells.ravel(), weights=dx.ravel(), minlength=INPUTS * WIDTH).reshape(INPUTS, WIDTH).astype(w["E"].dtype)
        return g


def fit_windows(rows: np.ndarray, used: np.ndarray, counts: np.ndarray, ends: int, steps: int) -> Attention:
    """The network after `steps` batches of windows picked at random from `rows`; fixed seed, fixed order."""
    rng = np.random.default_rng(7)
    network = _beginning(counts, ends, rng)
    learner, class_of_row, rows = Learner(network), network.class_of_row(), network.row_of[rows].astype(np.uint16)
    for step in range(1, steps + 1 if len(rows) else 1):
        pick = rng.integers(0, len(rows), BATCH_WINDOWS)
        learner.step(*_parts(rows[pick], used[pick], class_of_row), RATE * min(1.0, step / 50) * (1 - 0.9 * step / steps))
    network.weights["R"] = network.weights["r"][APART].astype(np.float32)
    return network


def fit(texts: list[np.ndarray], counts: np.ndarray, ends: int, steps: int) -> Attention:
    """:func:`fit_windows` on all windows of the texts."""
    _, rows, used = drawn(np.zeros(len(texts), np.int64), texts, 0, 1, 1)
    return fit_windows(rows, used, counts, ends, steps)


def _parts(rows: np.ndarray, used: np.ndarray, class_of_row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(embedding rows, classes of the targets, which targets belong to the text) of drawn windows, given as embedding rows."""
    return rows[:, :-1], class_of_row[rows[:, CONTEXT + 1:]].ravel(), (np.arange(STRIDE) < used[:, None]).ravel()


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every bit of the result depends on every bit of `h`."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def drawn(keys: np.ndarray, texts: list[np.ndarray], round_: int, rounds: int, every: int) -> tuple[np.ndarray, ...]:
    """(hash, ids and targets as CONTEXT + STRIDE + 1 ids, used targets) of the windows drawn for a round.

    One window in `every` is drawn in one of the `rounds`, by a hash of its text's key and its number.
    """
    windows = Windows(texts)
    sizes = np.array([-(-(len(t) + 1) // STRIDE) for t in texts], dtype=np.int64)
    number = np.arange(len(windows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    h = mixed(np.repeat(keys.astype(np.uint64), sizes) + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    pick = np.flatnonzero(h % np.uint64(every * rounds) == round_)
    ids, targets, used = windows.take(pick)
    return h[pick], np.column_stack([ids, targets[:, -1]]).astype("<u2"), used.reshape(-1, STRIDE).sum(axis=1)


def learn(network: Attention, h: np.ndarray, rows: np.ndarray, used: np.ndarray, rate: float) -> None:
    """Goes once over drawn windows, in the order of their hashes."""
    learn_rows(network, h, network.row_of[rows].astype(np.uint16), used, rate)


def learn_rows(network: Attention, h: np.ndarray, rows: np.ndarray, used: np.ndarray, rate: float) -> None:
    """:func:`learn` for windows given as embedding rows."""
    learner, class_of_row = Learner(network), network.class_of_row()
    order = np.lexsort((used, h))
    for lo in range(0, len(order), PASS_WINDOWS):
        own = order[lo:lo + PASS_WINDOWS]
        learner.step(*_parts(rows[own], used[own], class_of_row), rate * min(1.0, (learner.steps + 1) / 50))


# ---------------------------------------------------------------- scoring

def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(fold(F.col("doc_id"), FOLDS) != HELD_OUT)


BLOCKS = "learner int, n int, block binary"
#: Bytes of a window in a block: hash, used targets, ids.
WINDOW_BYTES = 8 + 1 + 2 * (CONTEXT + STRIDE + 1)


def learner_of(h: np.ndarray, learners: int) -> np.ndarray:
    """``pmod(xxhash64(h), learners)`` as Spark has it, of unsigned 64-bit hashes."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                                 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turned(x, by):
        return (x << np.uint64(by)) | (x >> np.uint64(64 - by))

    x = turned(turned(h * p2, 31) * p1 ^ (p5 + np.uint64(42 + 8)), 27) * p1 + p4
    x = (x ^ (x >> np.uint64(33))) * p2
    x = (x ^ (x >> np.uint64(29))) * p3
    return (x ^ (x >> np.uint64(32))).view(np.int64) % learners


def packed(h: np.ndarray, rows: np.ndarray, used: np.ndarray) -> bytes:
    """Windows as compressed bytes, column by column; the low and the high bytes of the ids apart, as these are alike."""
    ids = np.ascontiguousarray(rows, "<u2").view(np.uint8).reshape(-1, 2)
    return pa.compress(h.astype("<u8").tobytes() + used.astype(np.uint8).tobytes() + ids.T.tobytes(), "zstd", asbytes=True)


def unpacked(n: int, block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, rows, used) of the n windows of a block."""
    raw = np.frombuffer(pa.decompress(block, n * WINDOW_BYTES, "zstd", asbytes=True), np.uint8)
    ids = np.ascontiguousarray(raw[9 * n:].reshape(2, -1).T).view("<u2")
    return raw[:8 * n].view("<u8"), ids.reshape(n, CONTEXT + STRIDE + 1), raw[8 * n:9 * n]


def draw_windows(ids: DataFrame, round_: int, rounds: int, every: int, learners: int = 1,
                 row_of: np.ndarray | None = None) -> DataFrame:
    """The windows of (key: long, ids: binary) drawn for a round, in no order: blocks of windows of one learner.

    With `row_of` their ids are turned into embedding rows.
    """
    def blocks(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        h, rows, used = (np.concatenate(x) for x in zip(*parts, strict=True))
        to = learner_of(h, learners)
        order = np.argsort(to, kind="stable")
        which, begin = np.unique(to[order], return_index=True)
        own = np.split(order, begin[1:]) if len(which) else []
        return pa.RecordBatch.from_arrays(
            [pa.array(which.astype(np.int32)), pa.array([len(x) for x in own], pa.int32()),
             pa.array([packed(h[x], rows[x], used[x]) for x in own], pa.binary())], names=["learner", "n", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for whole in batches:
            for lo in range(0, len(whole), SCORE_TEXTS):
                batch = whole.slice(lo, SCORE_TEXTS)
                texts = [np.frombuffer(x, "<u2") for x in batch.column(1).to_pylist()]
                h, rows, used = drawn(batch.column(0).to_numpy(), texts, round_, rounds, every)
                parts.append((h, rows if row_of is None else row_of[rows].astype(np.uint16), used))
                n += len(h)
                if n > BLOCK_WINDOWS:
                    yield blocks(parts)
                    parts, n = [], 0
        if parts:
            yield blocks(parts)

    return map_batches(ids.select("key", "ids"), run, BLOCKS)


def _collected(batches) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, rows, used) of the windows of blocks, in the order of their hashes."""
    parts = [(np.empty(0, "<u8"), np.empty((0, CONTEXT + STRIDE + 1), "<u2"), np.empty(0, np.uint8))]
    parts += [unpacked(n, x) for b in batches for n, x in zip(b.column("n").to_pylist(), b.column("block").to_pylist(), strict=True)]
    h, rows, used = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((used, h))
    return h[order], rows[order], used[order]


def fit_sample(ids: DataFrame, counts: np.ndarray, ends: int, n_windows: int, n: int = SAMPLE_WINDOWS) -> Attention:
    """The network fitted on about `n` of the windows of all rows of `ids`; `n_windows`: how many there are, about.

    Runs in one task (one core); only the weights come to the driver.
    """
    steps = STEPS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, rows, used = _collected(batches)
        model = fit_windows(rows, used, counts, ends, steps)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    sample = draw_windows(ids, 0, 1, max(1, n_windows // n))
    fitted = map_batches(sample.repartition(1), run, "model binary").collect()
    return pickle.loads(fitted[0]["model"]) if fitted else fit([], counts, ends, 0)


def fit_all(ids: DataFrame, network: Attention, n_windows: int, every: int = 1,
            rates: tuple[float, ...] = PASS_RATES) -> Attention:
    """`network` fitted further on all windows of all rows of `ids` (key: long, ids: binary), whatever their length.

    Each window is learnt from in one of the rounds (with `every` over 1 only
    one in so many is). The windows of a round are dealt by hash to learners of
    about LEARNER_WINDOWS windows, which start from the same weights; the next
    round starts from the mean of theirs, weighted by the windows. The results
    are added up by some tasks first, so the driver gets about the square root
    of their number. `n_windows`: windows of all texts, about.
    """
    spark = ids.sparkSession
    names = [k for k in network.weights if k != "R"]
    shapes = [network.weights[k].shape for k in names]
    ends = np.cumsum([int(np.prod(x)) for x in shapes])
    learners = max(1, -(-n_windows // (every * len(rates) * LEARNER_WINDOWS)))

    def flat(weights) -> np.ndarray:
        return np.concatenate([weights[k].ravel() for k in names])

    def back(values: np.ndarray) -> Attention:
        parts = np.split(values.astype(np.float32), ends[:-1])
        return Attention(network.class_of, network.log_share, network.row_of,
                         {k: x.reshape(shape).copy() for k, x, shape in zip(names, parts, shapes, strict=True)})

    def row(learner: int, n: int, name: str, numbers: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([learner], pa.int32()), pa.array([n], pa.int64()),
                                           pa.array([numbers.tobytes()], pa.binary())], names=["learner", "n", name])

    def total(rows) -> tuple[int, int, np.ndarray]:
        """In the order of the learners, so that the sum of doubles is always the same."""
        first, n, sums = 2**31 - 1, 0, np.zeros(ends[-1])
        for learner, k, own in sorted(rows, key=lambda r: r[0]):
            first, n = min(first, learner), n + k
            sums += own
        return first, n, sums

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(learner, n, np.frombuffer(raw, np.float32).astype(np.float64) * n)
                for batch in batches for learner, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        if rows:
            first, n, sums = total(rows)
            yield row(first, n, "sums", sums)

    def one(shipped, rate: float):
        def run(group: pa.Table) -> pa.Table:
            own = back(shipped.value)
            h, rows, used = _collected([group])
            learn_rows(own, h, rows, used, rate)
            return pa.Table.from_batches([row(group["learner"][0].as_py(), len(rows), "weights", flat(own.weights).astype(np.float32))])
        return run

    values = flat(network.weights)
    for k, rate in enumerate(rates):
        shipped = spark.sparkContext.broadcast(values)

        windows = draw_windows(ids, k, len(rates), every, learners, network.row_of)
        learnt = windows.groupBy("learner").applyInArrow(one(shipped, rate), "learner int, n long, weights binary")
        parts = max(1, round(learners**0.5))
        sums = map_batches(learnt.repartition(parts, "learner"), add_up, "learner int, n long, sums binary").collect()
        _, n, summed = total([(r["learner"], r["n"], np.frombuffer(r["sums"])) for r in sums])
        if n:
            values = summed / n
        shipped.unpersist()
    out = back(values)
    out.weights["R"] = out.weights["r"][APART].astype(np.float32)
    return out


def least_count(words: DataFrame, n: int) -> int:
    """A count that at most `n` words reach, from a histogram of some hundred buckets (no sort, no top-n)."""
    bucket = F.floor(F.log2(F.col("c").cast("double")) * 16).cast("int")
    rows = words.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).collect()
    cut, seen = 2**62, 0
    for r in sorted(rows, key=lambda r: -r["b"]):
        seen += r["n"]
        if seen > n:
            break
        cut = r["least"]
    return cut


def score(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row per row of `docs`.

    Learns from the rows outside the held-out fold. A null or empty text is
    its end token alone. With no training row every count is 0 and the
    network stays as it starts. A null doc_id counts as training text.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    train = training_rows(docs)
    words = saved(word_counts(train), "lm-words")
    n_texts = train.count()
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, vocabulary = total + n_texts, distinct + (n_texts > 0)
    out_of = tokens + vocabulary + 1
    tops = words.filter(F.col("c") >= least_count(words, FREQUENT)).toArrow()  # at most FREQUENT rows
    frequent = dict(zip(tops["word"].to_pylist(), np.log10((tops["c"].to_numpy() + 1) / out_of).tolist(), strict=True))
    del tops
    known = spark.sparkContext.broadcast(frequent)
    end_base = float(np.log10((n_texts + 1) / out_of))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, logs, part, row = subwords(tokenizer), known.value, TaskContext.get().partitionId(), 0
        for whole in batches:
            for lo in range(0, len(whole), SCORE_TEXTS):
                batch = whole.slice(lo, SCORE_TEXTS)
                seen = words_in(batch.column(1))
                of_word = np.array([logs.get(w, np.nan) for w in seen.distinct])
                owner = np.repeat(np.arange(len(batch)), seen.n)
                of_each = of_word[seen.at] if len(seen.at) else np.empty(0)
                odd = np.isnan(of_each)
                base = np.bincount(owner[~odd], weights=of_each[~odd], minlength=len(batch)) + end_base
                # The rare words of every text, in the order of the texts.
                rare, times = np.unique(owner[odd] * len(of_word) + seen.at[odd], return_counts=True)
                ends = np.searchsorted(rare, np.arange(len(batch) + 1) * max(1, len(of_word)))
                rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array([seen.distinct[i] for i in (rare % max(1, len(of_word))).tolist()], pa.binary()),
                     pa.array(times, pa.int64())], names=["word", "n"]))
                ids = [x.tobytes() for x in enc.texts(seen)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), batch.column(3), pa.array([part] * len(batch), pa.int32()),
                     pa.array(np.arange(row, row + len(batch))), pa.array(seen.n + 1, pa.int64()),
                     pa.array(seen.n - np.bincount(owner[odd], minlength=len(batch)), pa.int64()), pa.array(base),
                     pa.array(ids, pa.binary()), rare],
                    names=["doc_id", "key", "held_out", "part", "row", "n", "found", "base", "ids", "rare"])
                row += len(batch)

    own_key = F.xxhash64("doc_id", "text", F.lit("lm-window")).alias("key")
    held_out = (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out")
    ids = saved(map_batches(docs.select("doc_id", "text", own_key, held_out), read,
                            "doc_id long, key long, held_out boolean, part int, row long, n long, found long, base double, "
                            "ids binary, rare array<struct<word: binary, n: bigint>>"), "lm-ids")
    counts = id_counts(words, tokenizer)
    learnt, n_windows = ids.filter(~F.col("held_out")), (int(counts.sum()) + n_texts) // STRIDE
    model = fit_all(learnt, fit_sample(learnt, counts, n_texts, n_windows), n_windows)
    shipped = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), SCORE_TEXTS):
                batch = whole.slice(lo, SCORE_TEXTS)
                texts = [np.frombuffer(x, "<u2") for x in batch.column("ids").to_pylist()]
                kept = [c for c in batch.schema.names if c != "ids"]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(shipped.value.text_scores(texts))],
                                                 names=[*kept, "score"])

    scored = saved(map_batches(ids.drop("key", "rare"), run, "doc_id long, held_out boolean, part int, row long, n long, found long, "
                                                             "base double, score double"), "lm-scored")
    odd = ids.filter(F.size("rare") > 0).select("part", "row", F.inline("rare"))
    joined = odd.join(words, "word", "left")
    of_odd = joined.groupBy("part", "row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("odd_found"),
        F.sum(F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(out_of)))).alias("odd_base"))
    out = scored.join(of_odd, ["part", "row"], "left")
    return out.select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"),
        (F.col("found") + F.coalesce("odd_found", F.lit(0)) + F.lit(int(n_texts > 0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("odd_base", F.lit(0.0))).alias("base_score"), "score")


def op7_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
