"""Merkle manifest against a plain tree, its SQL, and hand-made odd rows."""

import hashlib
import zlib

import duckdb
import pytest

from contrail.llm import merkle
from contrail.llm.common import table
from tests.llm.helpers import DOC_SCHEMA, SMALL, documents, odd_documents


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i:i + 8])) for i in range(0, len(below), 8)])
    return levels


def path(levels, i):
    steps = []
    for nodes in levels[:-1]:
        low = i - i % 8
        steps.append(("".join(nodes[low:i]), "".join(nodes[i + 1:low + 8])))
        i //= 8
    return steps


def manifest(rows):
    """(doc_id, source, lang, n_chars, text) rows -> what the operator returns, by whole trees."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: tree([leaf(r) for r in groups[g]]) for g in order}
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for j, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            steps = path(trees[g], i) + path(top, j)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            got = leaf((*r[:4], lowered(r[4]))) if hit else leaf(r)
            for a, b in steps:
                got = h(a + got + b)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], h("".join(a + b for a, b in steps)), got, got == top[-1][0]))
    return sorted(out, key=repr)


def ordered(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("total", [1, 2, 7, 8, 9, 64, 65, 100, 513])
def test_missing_nodes_are_minimal_and_enough(total):
    whole = tree([h(str(i)) for i in range(total)])
    for start, n in [(0, 1), (0, total), (total // 2, 1), (total // 3, max(1, total // 3)), (total - 1, 1)]:
        asked = merkle.missing(start, n, total)
        assert len(set(asked)) == len(asked)
        # Minimal: no leaf of the partition lies below a fetched node, and none is below another.
        below = [set(range(p * 8**k, (p + 1) * 8**k)) for k, p in asked]
        assert all(not b & set(range(start, start + n)) for b in below)
        assert sum(map(len, below)) == len(set().union(*below))
        got = list(merkle.proofs(whole[0][start:start + n], start, total, {(k, p): whole[k][p] for k, p in asked}))
        assert got == [path(whole, i) for i in range(start, start + n)]
        for at in asked:
            with pytest.raises(KeyError):
                list(merkle.proofs(whole[0][start:start + n], start, total,
                                   {(k, p): whole[k][p] for k, p in asked if (k, p) != at}))


def test_peaks_and_levels_give_the_tree():
    total = 777
    whole = tree([h(str(i)) for i in range(total)])
    nodes = {}
    for start in range(0, total, 50):
        for k, p, x in merkle.peaks(merkle.grow(whole[0][start:start + 50], start, total)):
            assert whole[k][p] == x
            nodes[k, p] = x
    for k in range(merkle.depth(total)):
        for p in range(merkle.width(total, k + 1)):
            own = [nodes.get((k, q)) for q in range(8 * p, min(8 * p + 8, merkle.width(total, k)))]
            if all(own):
                nodes[k + 1, p] = h("".join(own))
    assert nodes[merkle.depth(total), 0] == whole[-1][0]


@pytest.mark.parametrize("leaves", [3, 4096])
def test_manifest_equals_whole_trees(spark, monkeypatch, leaves):
    monkeypatch.setattr(merkle.leaf_partitions, "__defaults__", (leaves,))
    rows = [tuple(r) for r in table(spark, SMALL, "documents").select(*merkle.FIELDS).collect()]
    assert ordered(merkle.op13_merkle_multiproof(spark, SMALL)) == manifest(rows)


def test_manifest_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    assert ordered(merkle.op13_merkle_multiproof(spark, SMALL)) == sorted(con.execute(merkle.ORACLE).fetchall(), key=repr)


def test_odd_rows(spark):
    rows = odd_documents() + [(20 + i, "Same TEXT", "en", "s", 9) for i in range(40)] + [(7, "Hot", "en", "s", 3)] * 60
    want = manifest([(r[0], r[3], r[2], r[4], r[1]) for r in rows])
    assert ordered(merkle.manifest(documents(spark, rows, clash=True))) == want
    assert any(not r[6] for r in want) and any(r[6] for r in want)


def test_one_row_and_none(spark):
    one = [(1, "Text", None, None, None)]
    assert ordered(merkle.manifest(documents(spark, one))) == manifest([(1, None, None, None, "Text")])
    assert merkle.manifest(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
