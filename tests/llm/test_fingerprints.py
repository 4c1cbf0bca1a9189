"""Order MinHash and SimHash against plain-Python versions."""

import hashlib
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from contrail.llm import components, order_minhash, simhash

from .helpers import DOC_SCHEMA, SMALL, documents


def _signature(spark, texts):
    """Signatures by the definition: all numbered k-mers sorted for every rotation (Spark only hashes)."""
    k, size, take = order_minhash.K, order_minhash.SIZE, order_minhash.TUPLE

    def signed(x):
        return x - 2**64 if x >= 2**63 else x

    def hash_string(w):
        return signed(xxhash.xxh64_intdigest(w.encode(), 42))

    def chain(values):
        h = 42
        for v in values:
            h = xxhash.xxh64_intdigest((v % 2**64).to_bytes(8, "little"), h)
        return signed(h)

    def chain_number(h, number):  # a long, then an int
        first = xxhash.xxh64_intdigest((h % 2**64).to_bytes(8, "little"), 42)
        return signed(xxhash.xxh64_intdigest(number.to_bytes(4, "little"), first))

    out = []
    for text in texts:
        words = [w.decode() for w in (text or "").encode().split()]
        n = max(len(words) - k + 1, 1) if words else 0
        if not n:
            out.append([0] * size)
            continue
        hashes = [hash_string(w) for w in words]
        kmers = [chain(hashes[i:i + k]) for i in range(n)]
        mask = (1 << n.bit_length()) - 1
        seen, numbered = {}, []
        for pos, h in enumerate(kmers):
            number = seen.get(h, 0)
            seen[h] = number + 1
            numbered.append(signed((chain_number(h, number) & ~mask | pos) % 2**64))
        sig = []
        for j in range(size):
            begin = -2**63 + j * (2**64 // size)
            order = sorted(numbered, key=lambda v: (v - begin) % 2**64)
            chosen = sorted(order[t % n] & mask for t in range(take))
            sig.append(chain([kmers[p] for p in chosen]) & (2**31 - 1))
        out.append(sig)
    return out


def test_order_minhash_against_definition(spark):
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(["a", "b", "cc", "d d", "é"]) for _ in range(rnd.randint(0, 80))) for _ in range(40)]
    texts += ["", None, "one", "one two", "one two three", "x " * 500, "a b c\td\n e"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = order_minhash.with_fingerprint(df, "text", "fp").orderBy("i").collect()
    assert [list(r.fp) for r in got] == _signature(spark, texts)


def test_order_matters_not_only_the_set(spark):
    rnd = random.Random(1)
    words = [f"w{rnd.randint(0, 10**6)}" for _ in range(400)]
    swapped = words[200:] + words[:200]
    edited = words[:]
    edited[100] = "other"
    df = spark.createDataFrame([(" ".join(words), " ".join(swapped), " ".join(edited))], "a string, b string, c string")
    for c in "abc":
        df = order_minhash.with_fingerprint(df, c, f"f{c}")
    near = df.select(*(order_minhash.likeness(F.col("fa"), F.col(f"f{c}")).alias(c) for c in "abc")).first()
    assert near.a == 1.0 and near.c > 0.85 and 0.3 < near.b < 0.75 < near.c


def test_op1_texts_and_neighbours(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    got = order_minhash.op1_order_minhash(spark, SMALL).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    for k, (r, d) in enumerate(zip(got, rows)):
        after, half = rows[(k + 1) % len(rows)].text, len(d.text) // 2
        edited = d.text[:len(d.text) - half] + after[:half]
        assert (r.n_chars, r.edited_sha256) == (len(d.text), hashlib.sha256(edited.encode()).hexdigest())
    assert all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in got)
    big = [r for r in got if r.n_chars > 1000]
    assert sum(r.near_edited for r in big) / len(big) > 0.05 + sum(r.near_next for r in big) / len(big)


def test_next_document_across_blocks_and_gaps(spark):
    ids = [-10**18, -3, 0, 1, 127, 128, 129, 5000, 10**12, 10**12 + 1]
    df = spark.createDataFrame([(i, f"text {i}", [i % 7]) for i in ids], "doc_id long, text string, fp array<int>")
    got = {r.doc_id: (r.next_text, list(r.next_fp)) for r in order_minhash.with_next(df).collect()}
    assert got == {i: (f"text {j}", [j % 7]) for i, j in zip(ids, ids[1:] + ids[:1])}
    one = order_minhash.with_next(df.limit(1)).collect()
    assert len(one) == 1 and one[0].next_text == one[0].text


def test_hot_ids_are_cut_and_keep_their_order(spark):
    rng = random.Random(2)
    rows = [(i, f"t{i}") for i in (0, 3, 5, 9, 127, 128, 300)] + [(5, f"hot {k}") for k in range(90)]
    rows += [(9, f"warm {k}") for k in range(35)] + [(None, f"none {k}") for k in range(60)] + [(5, "hot 1")] * 3
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.array(F.lit(1)))
    hashes = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    order = sorted(rows, key=lambda r: (-2**63 if r[0] is None else r[0], hashes[r[1]]))
    want = sorted((a[0] or 0, a[1], b[1]) for a, b in zip(order, order[1:] + order[:1]))
    for hot_rows in (10, 1000):
        got = order_minhash.with_next(df, hot_rows=hot_rows).collect()
        assert sorted((r.doc_id or 0, r.text, r.next_text) for r in got) == want
    cut = order_minhash._blocked(df, order_minhash.BLOCK_BITS, 10).groupBy("__block").count()
    assert cut.agg(F.max("count")).first()[0] < 40 and cut.count() > 15


def _fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w.decode() for w in text.encode().split()]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(fps, radius=2):
    """Smallest index reachable over all pairs within `radius` bits."""
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    arr = np.array(fps, dtype=np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= radius):
            a, b = sorted((root(i), root(int(j))))
            label[b] = a
    return [root(i) for i in range(len(fps))]


def test_simhash_against_all_pairs(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    got = simhash.op10_gray_simhash(spark, SMALL).orderBy("doc_id").collect()
    fps = [_fingerprint(r.text) for r in rows]
    assert [r.fingerprint for r in got] == [f"{f:016x}" for f in fps]
    assert [r.component_id for r in got] == [rows[i].doc_id for i in _groups(fps)]


def test_links_lose_none_on_dense_clusters(spark):
    rnd = random.Random(11)
    fps = set()
    for _ in range(12):
        centre = rnd.getrandbits(64)
        for _ in range(80):
            f = centre
            for _ in range(rnd.randint(0, 4)):
                f ^= 1 << rnd.randrange(64)
            fps.add(f)
    fps = sorted(fps | {rnd.getrandbits(64) for _ in range(300)} | {0, 1, 2**64 - 1, 2**63})
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    label = {r.node: r.component for r in components.component_labels(simhash.links(df, block=8)).collect()}
    mine, want = {}, {}
    for f, g in zip(signed, _groups(fps)):
        mine.setdefault(label.get(f, f), set()).add(f)
        want.setdefault(g, set()).add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def test_gray_index_equals_scan():
    rng = np.random.default_rng(2)
    known = rng.integers(0, 2**63, 3000, dtype=np.uint64) & np.uint64(0xFFFFF)  # crowded: 20 bits
    known = np.unique(known)
    known = known[np.argsort(simhash.gray_rank(known))]
    assert (np.bitwise_count(known[1:] ^ known[:-1]) >= 1).all()
    queries = known[::7]
    q, node = simhash.GrayIndex(known).search(queries, 2)
    want = {(i, int(j)) for i, f in enumerate(queries) for j in np.flatnonzero(np.bitwise_count(known ^ f) <= 2)}
    assert set(zip(q.tolist(), node.tolist())) == want and len(q) == len(want)


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5000, 5000)]
    df = spark.createDataFrame(edges, "a long, b long")
    label = {r.node: r.component for r in components.component_labels(df).collect()}
    assert label == {i: 0 for i in range(61)} | {1000 + k: 1000 for k in range(200)}


def test_simhash_groups_by_smallest_id(spark):
    rows = [(i, t, None, None, None) for i, t in [(9, "a b c d"), (3, "A b c d"), (5, None), (4, ""), (7, "x y z")]]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(documents(spark, rows)).collect()}
    assert got == {9: 3, 3: 3, 5: 4, 4: 4, 7: 7}
    assert DOC_SCHEMA.names[0] == "doc_id"


def test_texts_are_shuffled_once(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        docs = spark.createDataFrame([(i, f"text {i}") for i in range(300)], "doc_id long, text string").withColumn("fp", F.array(F.lit(1)))
        plan = order_minhash.with_next(docs)._jdf.queryExecution().executedPlan().toString()
        # the rows meet the next block's head by the very column they were dealt by
        assert "SortMergeJoin [__block" in plan and "cast(__block" not in plan
    finally:
        spark.conf.set(key, before)
