"""Cross-tokenizer alignment against the definition, by the reference libraries alone."""

import collections
import hashlib
import random
import re
from functools import reduce

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from contrail.llm import alignment
from contrail.llm.common import table
from tests.llm.helpers import DOC_SCHEMA, SMALL, documents, odd_documents

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
_A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
_A.encode_special_tokens = True
_B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
#: The byte-level alphabet: printable bytes stand for themselves, the others for 256 and on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE = {chr(b): b for b in _PLAIN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}

ODD = ["", None, " ", "a", "a b", "a  b\n\n c ", "é ñ ü \U0001f600 ſecret K x y", "x" * 3000, "a▁b c", "tab\there \r\n x",
       "<|endoftext|> and <s> </s> <unk> <0x41>", "lorem ipsum " * 2000, "\n\nx", "中文 测试\n没有空格" * 50,
       "a\x1cb c\x00 d", "<0x41>", "' 's 't it's", "a b  c"]


def tokens_a(text):
    return [(i, bytes(_BYTE[c] for c in _A.id_to_token(i))) for i in _A.encode(" " + text, add_special_tokens=False).ids]


def tokens_b(text):
    out = []
    for i in _B.encode(text):
        p = _B.id_to_piece(i)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", p)
        out.append((i, bytes([int(byte[1], 16)]) if byte else p.replace("▁", " ").encode()))
    return out


def defined(rows):
    docs, counts = [], collections.Counter()
    for doc, text in rows:
        a, b = (tokens_a(text), tokens_b(text)) if text else ([], [])
        if any(b"".join(x for _, x in y) != (" " + (text or "")).encode() for y in (a, b)):
            a, b = [], []
        groups, links, ends, at = [], [], {}, 0
        for i, (_, raw) in enumerate(a):
            at += len(raw)
            ends[at] = i
        at = p = q = 0
        for j, (_, raw) in enumerate(b):
            at += len(raw)
            if at in ends:
                i = ends[at]
                groups.append("|".join(",".join(str(x) for x, _ in y) for y in (a[p:i + 1], b[q:j + 1])))
                links.append((a[i][0], b[j][0]))
                p, q = i + 1, j + 1
        counts.update(links)
        docs.append((doc, len(a), len(b), groups, links))
    best = {}
    for (_, y), c in counts.items():
        best[y] = max(best.get(y, 0), c)
    return sorted(((doc, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
                   for doc, n_a, n_b, groups, links in docs), key=repr)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_query_equals_definition(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    assert found(alignment.op12_fragment_alignment(spark, SMALL)) == defined(rows)


@pytest.mark.parametrize(("long", "size", "frequent"), [(1 << 16, 1 << 14, 1 << 18), (5, 7, 20)])
def test_odd_texts_whole_and_in_ranges(spark, monkeypatch, long, size, frequent):
    monkeypatch.setattr(alignment.align_long, "__defaults__", (size, 3))
    rows = [*enumerate(ODD), (1, "twice"), (1, "twice"), (None, "no id here"), (None, None)]
    docs = documents(spark, [(d, t, "en", "s", 1) for d, t in rows], clash=True)
    assert found(alignment.align(docs, long=long, frequent=frequent)) == defined(rows)


def test_long_rows_and_no_rows(spark):
    rows = [(r[0], r[1]) for r in odd_documents()]
    assert found(alignment.align(documents(spark))) == defined(rows)
    assert alignment.align(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


def test_compose_is_associative_with_an_identity():
    rng = random.Random(5)
    for _ in range(300):
        ends = [sorted(rng.sample(range(1, 60), rng.randint(0, 25))) + [60] for _ in range(2)]
        ids = [np.array([rng.randint(0, 30_000) for _ in x], dtype="<u2") for x in ends]
        bounds = [0, *sorted(rng.sample(range(1, 60), 5)), 60]

        def of(lo, hi, ids=ids, ends=ends):
            own = [(np.array(x) > lo) & (np.array(x) <= hi) for x in ends]
            return alignment.fragment(*(y for k in (0, 1) for y in (ids[k][own[k]], np.array(ends[k])[own[k]])))

        parts = [of(lo, hi) for lo, hi in zip(bounds, bounds[1:], strict=False)]
        whole, empty = of(0, 60), alignment.Fragment()
        assert reduce(alignment.compose, parts) == whole
        assert reduce(lambda x, y: alignment.compose(y, x), parts[::-1]) == whole
        left = alignment.compose(parts[0], parts[1])
        assert alignment.compose(left, alignment.compose(parts[2], parts[3])) == reduce(alignment.compose, parts[:4])
        assert alignment.compose(empty, whole) == whole == alignment.compose(whole, empty)


def test_ranges_are_bounded_and_cut_inside_words():
    text = "some words of a text " * 400
    parts = alignment.windows(text, 64)
    assert len(parts) > 100 and max(len(w) for w, _, _ in parts) < 200
    assert sum(last - first for _, first, last in parts) == len(text) + 1
    assert any(first > 0 for _, first, _ in parts)  # a window that begins before its range
    assert len(alignment.windows("x" * 5000, 64)) == 1  # nowhere to cut


def test_full_cache_changes_nothing():
    texts = ["alpha beta gamma", "beta\ngamma delta", "delta alpha"]
    small, large = alignment.Tokenizers(cache_words=2), alignment.Tokenizers()
    assert [small.documents([t]) for t in texts] == [large.documents([t]) for t in texts]
