"""SimHash near-duplicate groups with a Gray-order hierarchical index.

Fingerprints: a bit is set if it is set in over half of the XXH64 hashes of
the text's word shingles (repeats included).

Links: the distinct fingerprints are sorted by their rank in the binary
reflected Gray code, which puts fingerprints that share leading bits and
differ in few others next to each other, and cut into blocks of equal size.
A node of the index stands for a run of neighbours: a mask of the bits on
which they all agree and the pattern of those bits. Bits that an upper node
has factored out are left out of the masks below it, so the differences
counted on the way down add up to the distance; as soon as the sum exceeds
the radius, the whole group below is pruned.

The same index is used twice: over the blocks (one node per block, 24 bytes,
and at most MAX_BLOCKS of them: that is what every task is sent) to find the
blocks a fingerprint has to be compared with, and inside a block to find its partners. A pair of blocks is
compared once, from the lower one. The links of a task leave it as stars
(every linked fingerprint with the smallest of its group there), and the
groups of all tasks are joined by distributed connected components.
Fingerprints are distinct, so a group of equal copies is one entry.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from contrail.llm.common import map_batches, saved, table
from contrail.llm.components import component_labels

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Fingerprints of one index block; blocks of one index at least (for parallel tasks) and at most (then larger ones).
BLOCK = 65_536
MIN_BLOCKS, MAX_BLOCKS = 64, 1 << 20
FANOUT = 16
#: Queries searched at once in a task.
QUERIES = 1024


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a text; null or without words: 0."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z and the six ASCII spaces
    if not words:
        return 0
    if len(words) <= shingle:
        return digest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    hashes = np.array([digest(joined[a:b - 1], seed) for a, b in zip([0, *ends], ends[shingle - 1:], strict=False)],
                      dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        counts += np.unpackbits(hashes[at:at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The columns of `docs` but text, and fp: the fingerprint as a signed long (replacing a column fp)."""
    kept = [c for c in docs.columns if c not in ("text", "fp")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(len(kept)).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps.view(np.int64))], names=[*kept, "fp"])

    slim = docs.select(*kept, "text")
    return map_batches(slim, run, StructType([*slim.schema.fields[:-1], StructField("fp", LongType())]))


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """Position of each fingerprint in the binary reflected Gray code."""
    rank = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchical index over nodes (pattern, mask) that stand in Gray order; a fingerprint has a full mask."""

    def __init__(self, patterns: np.ndarray, masks: np.ndarray | None = None, fanout: int = FANOUT):
        full = np.full(len(patterns), ~np.uint64(0)) if masks is None else masks
        levels = [(patterns, full)]
        while len(levels[-1][0]) > fanout:
            pattern, mask = levels[-1]
            at = np.arange(0, len(pattern), fanout)
            ones, zeros = (np.bitwise_and.reduceat(x, at) for x in (pattern & mask, ~pattern & mask))
            levels.append((ones, ones | zeros))
        # From the top down; a node's mask loses the bits its parent has compared already.
        self.levels = []
        above = None
        for pattern, mask in reversed(levels):
            own = mask if above is None else mask & ~np.repeat(above, fanout)[:len(mask)]
            self.levels.append((pattern, own))
            above = mask
        self.fanout = fanout

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query number, node number) of every bottom node at accumulated distance `radius` or less."""
        pattern, mask = self.levels[0]
        q = np.repeat(np.arange(len(queries)), len(pattern))
        node = np.tile(np.arange(len(pattern)), len(queries))
        apart = np.zeros(len(q), dtype=np.uint8)
        for depth, (pattern, mask) in enumerate(self.levels):
            if depth:
                q, apart = np.repeat(q, self.fanout), np.repeat(apart, self.fanout)
                node = (node[:, None] * self.fanout + np.arange(self.fanout)).ravel()
                there = node < len(pattern)
                q, apart, node = q[there], apart[there], node[there]
            apart = apart + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
            near = apart <= radius
            q, apart, node = q[near], apart[near], node[near]
        return q, node


def _stars(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest number reachable over the links a-b, for 0..n-1."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _star_edges(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    """Links x-y (fingerprints) as one edge from each to the smallest of its group."""
    keep = x != y
    nodes, ids = np.unique(np.concatenate([x[keep], y[keep]]), return_inverse=True)
    label = _stars(*np.split(ids, 2), len(nodes)) if len(nodes) else np.empty(0, np.int64)
    far = np.flatnonzero(label != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([pa.array(nodes[far].view(np.int64)), pa.array(nodes[label[far]].view(np.int64))],
                                      names=["a", "b"])


def _search(radius: int):
    """Body for map_batches over rows sorted by (block, is_query): entries build the block's index, queries follow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, entries, index, known = None, [], None, None
        for batch in batches:
            of, is_query, fps = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fps = fps.view(np.uint64)
            cuts = [0, *(np.flatnonzero((of[1:] != of[:-1]) | (is_query[1:] != is_query[:-1])) + 1), len(of)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                if of[lo] != block:
                    block, entries, index = of[lo], [], None
                if not is_query[lo]:
                    entries.append(fps[lo:hi].copy())
                    continue
                if index is None:
                    known = np.concatenate(entries)
                    known = known[np.argsort(gray_rank(known))]
                    index = GrayIndex(known)
                for at in range(lo, hi, QUERIES):
                    asked = fps[at:min(at + QUERIES, hi)]
                    q, node = index.search(asked, radius)
                    yield _star_edges(asked[q], known[node])
    return run


def _route(blocks: np.ndarray, patterns: np.ndarray, masks: np.ndarray, radius: int):
    """Body for map_batches: (block, fp) -> an entry in its own block, a query in it and in every higher one in reach."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = GrayIndex(patterns, masks)
        for whole in batches:
            for lo in range(0, len(whole), QUERIES):
                own, fps = (whole.column(i).to_numpy(zero_copy_only=False)[lo:lo + QUERIES] for i in range(2))
                q, node = top.search(fps.view(np.uint64), radius)
                block = blocks[node]
                ahead = block >= own[q]
                q, block = q[ahead], block[ahead]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([own, block]).astype(np.int32)),
                     pa.array(np.concatenate([np.zeros(len(own), bool), np.ones(len(q), bool)])),
                     pa.array(np.concatenate([fps, fps[q]]))], names=["block", "is_query", "fp"])
    return run


def links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Star edges (a, b) that join the distinct fingerprints `fps` (column fp) as all links within `radius` do."""
    spark = fps.sparkSession
    distinct = saved(fps.select("fp").distinct(), "simhash-distinct")
    n = distinct.count()
    if not n:
        return spark.createDataFrame([], "a long, b long")
    n_blocks = min(MAX_BLOCKS, max(MIN_BLOCKS, n // block))

    def rank(batches):
        for b in batches:
            # shifted into the order of signed longs
            ranks = gray_rank(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)) ^ np.uint64(1 << 63)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ranks.view(np.int64))], names=["fp", "rank"])

    blocks = saved(map_batches(distinct, rank, "fp long, rank long").repartitionByRange(n_blocks, "rank")
                   .select(F.spark_partition_id().alias("block"), "fp"), "simhash-blocks")
    nodes = (blocks.groupBy("block").agg(F.bit_and("fp").alias("ones"), F.bit_or("fp").alias("any"))
             .orderBy("block").toPandas())  # at most MAX_BLOCKS rows
    ones, some = (nodes[c].to_numpy(np.int64).view(np.uint64) for c in ("ones", "any"))
    shipped = spark.sparkContext.broadcast((nodes["block"].to_numpy(np.int64), ones, ones | ~some))

    def route(batches):
        yield from _route(*shipped.value, radius)(batches)

    routed = map_batches(blocks, route, "block int, is_query boolean, fp long")
    by_block = routed.repartition("block").sortWithinPartitions("block", "is_query")
    return map_batches(by_block, _search(radius), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Every row of `docs` without its text, with fp, group and component_id (replacing columns of these names).

    group is a number of the row's near-duplicate group, component_id the
    group's smallest doc_id. Null and empty texts have fingerprint 0 and are linked like any other. A
    row without partner is its own group; equal rows are in one group. A null
    doc_id is never a group's smallest unless the group has no other. An
    empty table gives an empty table.
    """
    fps = saved(fingerprints(docs.drop("group", "component_id"), shingle), "simhash-fingerprints")
    labels = component_labels(links(fps, radius))
    ids = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    group = (ids.join(labels, F.col("fp") == F.col("node"), "left")
             .select("fp", "least", F.coalesce("component", "fp").alias("group")))
    smallest = group.groupBy("group").agg(F.min("least").alias("component_id"))
    # One row per fingerprint: equal copies meet again only here, in an equi-join that can be split.
    of_fp = group.join(smallest, "group").select("fp", "group", "component_id")
    return fps.join(of_fp, "fp").select(*fps.columns, "group", "component_id")


def op10_gray_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
