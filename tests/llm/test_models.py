"""Trained operators: held-out accuracy, exact counts, independence of what must not matter."""

import math
from collections import Counter

import numpy as np
import pytest

from contrail.llm import language, lm, quality

from .helpers import SMALL, documents, fold, words

MEDIUM = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    rows = language.op9_string_kernel_language(spark, MEDIUM).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_language_learns_only_from_its_folds(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()
    changed = [(r.doc_id, r.text if fold(r.doc_id, 5) else "zzz", r.lang if fold(r.doc_id, 5) else "xx", "s", 1) for r in docs]
    same = [(r.doc_id, r.text, r.lang, "s", 1) for r in docs]
    a, b = (language.train(documents(spark, rows)) for rows in (same, changed))
    assert a.languages == b.languages and np.allclose(a.coef, b.coef)


def test_language_without_letters_is_undetermined(spark):
    docs = documents(spark, [(1, "the cat and the dog", "en", None, 1), (2, "12 34 !", "en", None, 1),
                             (3, "el gato y el perro", "es", None, 1), (4, None, "es", None, 1), (6, "", "en", None, 1)])
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, language.train(docs)).collect()}
    assert got[2] == got[4] == got[6] == ("und", 0.0)
    assert got[1][0] in ("en", "es")


def test_language_kernel_against_sets():
    texts = ["Hello, hello world!", "Guten Tag", "hello tag", "", "a"]
    model = language.fit(texts[:2] * 3, ["en", "de"] * 3)

    def grams(t, n):
        b = language._letters(t)
        return {b[i:i + n] for i in range(len(b) - n + 1)}
    known = [set().union(*(grams(t, n) for t in texts[:2])) for n in (1, 2, 3)]
    marks = [t for x in ("de", "en") for t in [texts[1], texts[0]][("de", "en").index(x):][:1] * 3]
    got = model.kernel(texts)
    for i, t in enumerate(texts):
        for j, m in enumerate(marks):
            want = 0.0
            for n in (1, 2, 3):
                x, z = grams(t, n) & known[n - 1], grams(m, n) & known[n - 1]
                want += len(x & z) / math.sqrt(max(1, len(x)) * max(1, len(z))) / 3
            assert got[i, j] == pytest.approx(want, abs=1e-5)


def test_quality_held_out(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    rows = quality.op5_crf_quality(spark, MEDIUM).collect()
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.95


def test_crf_marginals_against_enumeration():
    rng = np.random.default_rng(0)
    field = quality.Field(rng.standard_normal((4, 2)), rng.standard_normal((2, 2)))
    sizes = np.array([3, 1, 5])
    x = rng.standard_normal((9, 4))
    got, moved = field.marginals(x, sizes)
    want, moves, at = [], np.zeros((2, 2)), 0
    for n in sizes:
        s = x[at:at + n] @ field.weights
        total, good, pair = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(2**n):
            y = [code >> t & 1 for t in range(n)]
            p = math.exp(sum(s[t, y[t]] for t in range(n)) + sum(field.moves[y[t], y[t + 1]] for t in range(n - 1)))
            total += p
            good += p * np.array(y)
            for t in range(n - 1):
                pair[y[t], y[t + 1]] += p
        want += list(good / total)
        moves += pair / total
        at += n
    assert np.allclose(got, want) and np.allclose(moved, moves)


def test_document_score_is_the_length_weighted_mean():
    field = quality.Field(np.random.default_rng(1).standard_normal((quality.N_FEATURES, 2)) * 0.3, np.zeros((2, 2)))
    texts = ["short\na much longer line than that one\n\nx", "", "é" * 10, "a\nb"]
    own, length, sizes = quality.line_features(texts)
    good, _ = field.marginals(quality.with_neighbours(own, sizes), sizes)
    scores, at = quality.document_scores(field, texts), 0
    for t, n, s in zip(texts, sizes, scores):
        w = np.array([len(x.encode()) for x in t.split("\n")])
        assert (w == length[at:at + n]).all()
        assert s == pytest.approx((w * good[at:at + n]).sum() / w.sum() if w.sum() else 0.0)
        at += n
    # a text's score does not depend on its batch
    assert np.allclose(scores, [quality.document_scores(field, [t])[0] for t in texts])


@pytest.fixture(scope="module")
def scored(spark):
    keep = lm.STEPS, lm.FREQUENT
    lm.STEPS, lm.FREQUENT = 60, 500  # so that many words meet their counts in the join
    rows = lm.op7_attention_lm(spark, SMALL).collect()
    yield rows
    lm.STEPS, lm.FREQUENT = keep


def test_lm_base_against_counts(spark, scored):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    counts, ends = Counter(), 0
    for i, t in docs.items():
        if fold(i, 7) != 2:
            counts.update(words(t))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    for r in scored:
        c = [counts[w] for w in words(docs[r.doc_id])] + [ends]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(c), sum(x > 0 for x in c), n)
        assert r.base_score == pytest.approx(sum(math.log10((x + 1) / (n + v + 1)) for x in c), rel=1e-9)
        assert r.score < 0 and r.held_out == (fold(r.doc_id, 7) == 2)


def _model():
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 50, lm.VOCABULARY)
    return lm.fit([rng.integers(0, lm.VOCABULARY, k).astype(np.int32) for k in (3, 40, 200)], counts, 3, steps=5), counts


def test_lm_distribution_sums_to_one():
    model, _ = _model()
    ids = np.full((1, lm.CONTEXT + lm.STRIDE), 7, dtype=np.int32)
    total = 0.0
    everything = np.arange(lm.VOCABULARY + 1)
    for lo in range(0, len(everything), lm.STRIDE):
        some = np.resize(everything[lo:lo + lm.STRIDE], lm.STRIDE)
        got = np.array([model.log10(ids, np.full((1, lm.STRIDE), t))[0, 3] for t in some[:2]])
        total += len(got)
    # one position, all classes at once: class probabilities times shares
    p = 0.0
    for lo in range(0, len(everything), 512):
        part = everything[lo:lo + 512]
        batch = np.repeat(ids, len(part), axis=0)
        p += (10.0 ** model.log10(batch, np.repeat(part[:, None], lm.STRIDE, axis=1))[:, 3].astype(np.float64)).sum()
    assert p == pytest.approx(1.0, abs=1e-3) and total > 0


def test_lm_windows_score_every_token_once_and_causally():
    model, _ = _model()
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, lm.VOCABULARY, k).astype(np.int32) for k in (0, 1, 15, 16, 17, 33, 100)]
    got = model.text_scores(texts)
    for text, score in zip(texts, got):
        # by hand: position i sees the ids of its window up to i only
        seq = np.concatenate([np.full(lm.CONTEXT, lm.PAD), [lm.END], text]).astype(np.int32)
        want = 0.0
        for i, target in enumerate(np.append(text, lm.END)):
            first = i // lm.STRIDE * lm.STRIDE
            window = np.full(lm.CONTEXT + lm.STRIDE, lm.PAD, dtype=np.int32)
            have = seq[first:lm.CONTEXT + i + 1]
            window[:len(have)] = have  # nothing after position i
            targets = np.zeros((1, lm.STRIDE), dtype=np.int64)
            targets[0, i - first] = target
            want += float(model.log10(window[None], targets)[0, i - first])
        assert score == pytest.approx(want, rel=1e-4)
    assert np.allclose(got, [model.text_scores([t])[0] for t in texts], rtol=1e-4)


def test_lm_training_helps():
    rng = np.random.default_rng(3)
    cycle = np.tile([10, 20, 30, 40], 60).astype(np.int32)
    texts = [np.roll(cycle, int(k)) for k in rng.integers(0, 4, 20)]
    counts = np.bincount(np.concatenate(texts), minlength=lm.VOCABULARY)
    before, after = (lm.fit(texts, counts, 20, steps=s).text_scores(texts[:1])[0] for s in (0, 300))
    assert after > before / 4


def test_lm_learns_from_long_texts(spark):
    cycle = "red green blue yellow " * 600  # 13 KB, over the bound of the first fit
    docs = documents(spark, [(i, cycle, "en", "a", len(cycle)) for i in range(100)]).coalesce(1)
    rows = lm.score(docs).collect()
    counts = lm.id_counts(lm.word_counts(lm.training_rows(docs)))
    ids = np.frombuffer(b"".join(lm.subwords(lm.TOKENIZER).words(words(cycle))), "<u2")
    unread = lm.fit([], counts, 85, 0).text_scores([ids])[0]
    assert any(r.held_out for r in rows) and all(r.score > 0.8 * unread for r in rows), (rows[0].score, unread)


def test_lm_gradients_by_differences():
    model, _ = _model()
    rng = np.random.default_rng(2)
    # ids read by different rows, and some unused targets
    ids = rng.integers(0, 60, (5, lm.CONTEXT + lm.STRIDE)).astype(np.int32)
    targets = rng.integers(0, lm.VOCABULARY + 1, (5, lm.STRIDE))
    used = rng.random(targets.size) < 0.8
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items() if k != "R"}
    model.weights["r"] += rng.standard_normal(model.weights["r"].shape) * 0.1

    def loss():
        now = lm.Attention(model.class_of, model.log_share, model.row_of,
                           {**model.weights, "R": model.weights["r"][lm.APART]})
        got = (now.log10(ids, targets) - model.log_share[targets]) * np.log(10)
        return -(got.ravel() * used).sum() / used.sum()

    grads = lm.Learner(model)._gradients(ids, targets, used)
    for name, g in grads.items():
        flat = np.argsort(-np.abs(g), axis=None)[:4]
        for at in flat:
            at = np.unravel_index(at, g.shape)
            keep, e = model.weights[name][at], 3e-3
            model.weights[name][at] = keep + e
            up = loss()
            model.weights[name][at] = keep - e
            down = loss()
            model.weights[name][at] = keep
            assert g[at] == pytest.approx((up - down) / (2 * e), rel=0.08, abs=2e-4), name


def test_lm_learning_equals_one_loop_and_does_not_depend_on_the_split(spark, monkeypatch):
    monkeypatch.setattr(lm, "LEARNER_WINDOWS", 40)
    model, _ = _model()
    rng = np.random.default_rng(9)
    texts = [rng.integers(0, 500, int(k)).astype("<u2") for k in rng.integers(0, 900, 60)]
    keys = rng.integers(-2**62, 2**62, 60)
    n_windows, rates, every = sum(len(t) // lm.STRIDE + 1 for t in texts), (0.01, 0.005), 2
    df = spark.createDataFrame([(int(k), t.tobytes()) for k, t in zip(keys, texts)], "key long, ids binary")
    got = [lm.fit_all(df.repartition(parts), model, n_windows, every, rates).weights for parts in (1, 7)]
    assert all(np.array_equal(got[0][k], got[1][k]) for k in got[0])

    # one Python loop: learners one after the other, their weights averaged
    learners = -(-n_windows // (every * len(rates) * 40))
    assert learners > 3
    weights = {k: v for k, v in model.weights.items() if k != "R"}
    for k, rate in enumerate(rates):
        h, rows, used = lm.drawn(keys, texts, k, len(rates), every)
        to = np.array([r[0] for r in spark.createDataFrame([(int(x),) for x in h.view(np.int64)], "h long")
                      .selectExpr(f"pmod(xxhash64(h), {learners})").collect()])
        sums, n = {k: 0.0 for k in weights}, 0
        for j in sorted(set(to.tolist())):
            own = lm.Attention(model.class_of, model.log_share, model.row_of, {k: v.astype(np.float32).copy() for k, v in weights.items()})
            lm.learn(own, h[to == j], rows[to == j], used[to == j], rate)
            sums = {k: sums[k] + own.weights[k].astype(np.float64) * (to == j).sum() for k in sums}
            n += (to == j).sum()
        weights = {k: (v / n).astype(np.float32) for k, v in sums.items()}
    assert all(np.allclose(got[0][k], weights[k], atol=1e-5) for k in weights)


def test_lm_windows_travel_whole_and_in_few_bytes(spark, monkeypatch):
    """A window was a row of 62 shuffled bytes; all of a task's windows for one learner are one compressed block now."""
    monkeypatch.setattr(lm, "BLOCK_WINDOWS", 700)
    rng = np.random.default_rng(11)
    texts = [(rng.zipf(1.3, int(k)) % 3000).astype("<u2") for k in rng.integers(0, 900, 80)]
    keys = rng.integers(-2**62, 2**62, 80)
    model = lm.fit([], np.bincount(np.concatenate(texts), minlength=lm.VOCABULARY), 80, 0)
    df = spark.createDataFrame([(int(k), t.tobytes()) for k, t in zip(keys, texts)], "key long, ids binary").coalesce(1)
    n, size = 0, 0
    for round_ in (0, 1):
        blocks = lm.draw_windows(df, round_, 2, 1, 3, model.row_of).collect()
        h, rows, used = lm.drawn(keys, texts, round_, 2, 1)
        to = [r[0] for r in spark.createDataFrame([(int(x),) for x in h.view(np.int64)], "h long")
              .selectExpr("pmod(xxhash64(h), 3)").collect()]
        got = [(int(x), b.learner, r.tolist(), int(u)) for b in blocks for x, r, u in zip(*lm.unpacked(b.n, b.block))]
        assert sorted(got) == sorted(zip(h.tolist(), to, model.row_of[rows].tolist(), used.tolist()))
        n, size = n + len(got), size + sum(len(b.block) for b in blocks)
    assert n == sum(len(t) // lm.STRIDE + 1 for t in texts) and size < 45 * n


def test_lm_class_of_a_target_follows_from_its_row():
    model, _ = _model()
    ids = np.arange(lm.VOCABULARY + 1)
    assert (model.class_of_row()[model.row_of[ids]] == model.class_of[ids]).all()


def test_lm_words_and_ids_equal_plain_splitting():
    import pyarrow as pa
    from contrail.llm.packing import Encoder
    texts = ["", None, " A b\tB\n", "Ünïcode Ça υπ\x85x \xa0y", "a\x1cb", "x" * 3000, "<|endoftext|> 中文 a  b\x0b\x0cc", "don't 's"]
    read = lm.words_in(pa.array(["cut off", *texts])[1:])
    assert read.n.tolist() == [len(words(t)) for t in texts]
    assert [read.distinct[i] for i in read.at] == [w for t in texts for w in words(t)]
    whole, one = lm.Subwords(), Encoder()
    for enc in (whole, lm.Subwords(cache_words=3), whole):
        assert [x.tobytes() for x in enc.texts(read)] == [b"".join(map(one.word, words(t))) for t in texts]


# ---------------------------------------------------------------- samples without caps

def test_every_language_is_learned_and_long_texts_where_short_are_missing(spark, monkeypatch):
    rng = np.random.default_rng(4)
    names = [f"l{k:03d}" for k in range(203)]
    stem = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 5)) for _ in names]
    rows = [(i, f"{stem[i % 203]} " * 6, names[i % 203], "s", 1) for i in range(203 * 3)]
    docs = documents(spark, rows)
    assert language.train(docs).languages == names
    few = {r.lang: 0 for r in language.training_sample(docs, max_texts=250).collect()}
    assert len(few) == 203
    long = documents(spark, [(i, ("der hund und die katze " if i % 2 else "the dog and the cat ") * 500, "de" if i % 2 else "en",
                              "s", 1) for i in range(40)])
    told = language.identify(long, language.train(long)).collect()
    assert all(r.lang_pred == r.lang for r in told)
    sample = language.training_sample(long, per_language=10, max_bytes=2000).collect()
    assert Counter(r.lang for r in sample) == {"de": 1, "en": 2}  # as many as fit in 20 000 bytes


def test_language_prediction_recomputed(spark):
    """A query row by hand: presence kernels to the landmarks, ridge weights, softmax."""
    rows = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate(
        [("the dog and the cat in the house", "en"), ("der hund und die katze im haus", "de"), ("le chien et le chat ici", "fr")] * 8)]
    docs = documents(spark, rows)
    model = language.train(docs)
    asked = "the cat and die katze"
    codes = [set(g.tolist()) for g in language._grams(asked)]
    kernel = []
    for j in range(len(model.landmarks[0])):
        parts = []
        for n in range(3):
            own = codes[n] & set(model.grams[n].tolist())
            mark = {c for c, x in zip(model.grams[n].tolist(), model.landmarks[n][j]) if x}
            parts.append(len(own & mark) / math.sqrt(max(1, len(own))) / math.sqrt(max(1, len(mark))))
        kernel.append(sum(parts) / 3)
    z = np.array(kernel) @ model.coef * language.SHARPNESS
    p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    got = language.identify(documents(spark, [(1, asked, None, "s", 1)]), model).first()
    assert (got.lang_pred, got.score) == (model.languages[p.argmax()], pytest.approx(p.max(), rel=1e-3))


def test_quality_sample_long_texts_and_repeated_ids(spark):
    rows = [(i, ("good prose, well made. " if i % 2 else "zz zz zz 11 ## ") * 1000 + str(i), "en", "s", 1) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    docs = documents(spark, rows)
    field = quality.train(docs, labels)
    scores = {r.doc_id: r.score for r in quality.score(docs, field).collect()}
    assert all((scores[i] > 0.5) == bool(i % 2) for i in scores)
    sample = quality.training_sample(docs, labels, 5, 30_000).collect()
    assert len(sample) == len({r.doc_id for r in sample}) == 10
    assert Counter(r.quality for r in quality.training_sample(docs, labels, 3, 10).collect()) == {0: 1, 1: 1}
    hot = documents(spark, [(3, "the same text", "en", "s", 1)] * 20_000 + [(3, f"text {i}", "en", "s", 1) for i in range(50)]
                    + [(4, "other", "en", "s", 1)])
    assert quality.training_sample(hot, labels).count() == 2


def test_quality_score_recomputed(spark):
    """A query row by hand: all labellings of its lines, weighted by the field, then the mean by length."""
    from itertools import product
    rows = [(i, ("Well made prose, good to read.\n" if i % 2 else "zz ## 11 zz\n") * 3 + str(i), "en", "s", 1) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    field = quality.train(documents(spark, rows), labels)
    asked = "Well made prose.\n## 11 zz\nGood to read."
    got = quality.score(documents(spark, [(1, asked, None, None, None)]), field).first().score
    own, length, sizes = quality.line_features([asked])
    x = np.asarray(quality.with_neighbours(own, sizes), dtype=float)
    state = x @ field.weights
    weights = {ys: math.exp(sum(state[k][y] for k, y in enumerate(ys)) + sum(field.moves[a][b] for a, b in zip(ys, ys[1:])))
               for ys in product((0, 1), repeat=len(state))}
    good = [sum(w for ys, w in weights.items() if ys[k]) / sum(weights.values()) for k in range(len(state))]
    assert got == pytest.approx(sum(g * n for g, n in zip(good, length)) / sum(length), rel=1e-4)


def test_lm_learns_from_every_window(spark, monkeypatch):
    """Each window of each text is learnt from in just one round, unless fewer are asked for."""
    monkeypatch.setattr(lm, "LEARNER_WINDOWS", 1 << 20)
    model, _ = _model()
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 500, int(k)).astype("<u2") for k in rng.integers(0, 300, 40)]
    keys = rng.integers(-2**62, 2**62, 40)
    n_windows = sum(len(t) // lm.STRIDE + 1 for t in texts)
    df = spark.createDataFrame([(int(k), t.tobytes()) for k, t in zip(keys, texts)], "key long, ids binary")
    weights = {k: v.copy() for k, v in model.weights.items() if k != "R"}
    own = lm.Attention(model.class_of, model.log_share, model.row_of, weights)
    seen = 0
    for k, rate in enumerate(lm.PASS_RATES):
        drawn = lm.drawn(keys, texts, k, len(lm.PASS_RATES), 1)
        seen += len(drawn[0])
        lm.learn(own, *drawn, rate)
    assert seen == n_windows
    got = lm.fit_all(df, model, n_windows).weights
    assert all(np.allclose(got[k], weights[k], atol=1e-5) for k in weights)
