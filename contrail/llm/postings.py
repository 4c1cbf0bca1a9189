"""Nearest neighbours by largest inner product, over balanced posting lists.

Equal vectors are one entry with its K + 1 smallest rows: no query can need
more of them. Entries and queries are laid on a sphere, where the largest
inner product is the smallest distance (an entry gets one more coordinate
that fills its norm up to the largest one).

Lists: a bounded sample of the entries is bisected into parts of equal size,
so dense regions get as many centroids as they have entries; the number of
lists grows with the table up to MAX_LISTS. Every entry goes to the list of
its nearest centroid, and a *boundary* entry, one that is nearly as close to
further centroids, to up to REPLICAS lists. A list of any length is cut into
pages of about PAGE entries, so no task holds a whole long list.

Search: the centroids stay in memory in every task as a graph of near and of
random links. A beam walks it from fixed entry points; of the BEAM nearest
centroids found, the lists within RATIO times the nearest one's distance are
read. Queries meet pages in a join on the list, in blocks of about BLOCK
queries: a product of two small matrices for each page and block. Scores are
taken in double precision from the original vectors in a fixed order of
additions, so they don't depend on pages or blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm.common import map_batches, saved, table

QUERY_EVERY, K = 20, 20
#: Entries for each centroid, most centroids, entries of the sample the centroids are fitted on.
ENTRIES, MAX_LISTS, SAMPLE = 64, 1 << 14, 1 << 17
#: Lists an entry is in at most, and how much further than the nearest these may be.
REPLICAS, BOUNDARY = 4, 1.2
#: Beam of the graph walk, nodes expanded at once, and how much further than the nearest a list may be.
BEAM, EXPAND, RATIO = 256, 8, 1.17
NEAR_LINKS, RANDOM_LINKS, ENTRY_POINTS = 12, 4, 8
#: Entries of a page, queries of a block; vectors worked on at once; results a task holds before it cuts them.
PAGE, BLOCK, VECTORS, HELD = 256, 256, 256, 1 << 20


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, all components finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list array as doubles, shorter ones filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def entry_points(x: np.ndarray, radius: float) -> np.ndarray:
    """Entries on the sphere of `radius`: one more coordinate fills the norm."""
    rest = np.sqrt(np.maximum(radius**2 - (x * x).sum(axis=1), 0))
    return np.column_stack([x, rest]).astype(np.float32)


def query_points(x: np.ndarray, radius: float) -> np.ndarray:
    return np.column_stack([x * (radius / np.linalg.norm(x, axis=1))[:, None], np.zeros(len(x))]).astype(np.float32)


# ---------------------------------------------------------------- centroids and their graph

def bisect(points: np.ndarray, parts: int, rounds: int = 6) -> np.ndarray:
    """Means of `parts` parts of (nearly) equal size, by halving along the line between two means."""
    out, todo = [], [(np.arange(len(points)), max(1, min(parts, len(points))))]
    while todo:
        own, n = todo.pop()
        here = points[own]
        if n == 1:
            out.append(here.mean(axis=0))
            continue
        left = n // 2
        cut = len(own) * left // n
        far = here[np.argmax(((here - here.mean(axis=0)) ** 2).sum(axis=1))]
        line = far - here.mean(axis=0)
        for _ in range(rounds):
            side = np.argpartition(here @ line, cut)
            line = here[side[cut:]].mean(axis=0) - here[side[:cut]].mean(axis=0)
        side = np.argpartition(here @ line, cut)
        todo += [(own[side[:cut]], left), (own[side[cut:]], n - left)]
    return np.array(out, dtype=np.float32)


def _squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum((points**2).sum(axis=1)[:, None] - 2 * points @ centroids.T + (centroids**2).sum(axis=1), 0)


@dataclass
class Graph:
    """Centroids with links: the nearest ones both ways, a ring in random order, and random ones."""

    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray) -> Graph:
        n, rng = len(centroids), np.random.default_rng(11)
        near = np.empty((n, min(NEAR_LINKS, n)), dtype=np.int32)
        for lo in range(0, n, VECTORS):
            apart = _squared(centroids[lo:lo + VECTORS], centroids)
            near[lo:lo + VECTORS] = np.argpartition(apart, near.shape[1] - 1, axis=1)[:, :near.shape[1]]
        ring = rng.permutation(n)
        after = np.empty((n, 1), dtype=np.int32)
        after[ring, 0] = np.roll(ring, -1)
        links = np.column_stack([near, after, rng.integers(0, n, (n, RANDOM_LINKS))]).astype(np.int32)
        return cls(centroids, links, ring[:ENTRY_POINTS].astype(np.int32))

    def nearest(self, queries: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) of every query, nearest first, by beam search; -1 and infinity fill up."""
        n, rows = len(queries), np.arange(len(queries))[:, None]
        norms, own = (self.centroids**2).sum(axis=1), (queries**2).sum(axis=1)[:, None]
        seen = np.zeros((n, len(self.centroids)), dtype=bool)
        ids, far = np.full((n, beam), -1, np.int32), np.full((n, beam), np.inf, np.float32)
        done = np.zeros((n, beam), dtype=bool)

        def meet(new: np.ndarray) -> None:
            nonlocal ids, far, done
            new = np.sort(new, axis=1)
            known = seen[rows, new] | (new < 0)
            known[:, 1:] |= new[:, 1:] == new[:, :-1]
            seen[rows, np.maximum(new, 0)] |= new >= 0
            apart = own + norms[new] - 2 * np.matmul(self.centroids[new], queries[:, :, None])[:, :, 0]
            apart = np.where(known, np.inf, np.maximum(apart, 0)).astype(np.float32)
            every = np.concatenate([far, apart], axis=1)
            best = np.argsort(every, axis=1, kind="stable")[:, :beam]
            far = every[rows, best]
            ids = np.concatenate([ids, np.where(known, -1, new)], axis=1)[rows, best]
            done = np.concatenate([done, known], axis=1)[rows, best]

        meet(np.repeat(self.entries[None], n, axis=0))
        while True:
            open_ = ~done & (ids >= 0)
            if not open_.any():
                return ids, np.sqrt(far)
            order = np.argsort(~open_, axis=1, kind="stable")[:, :EXPAND]  # the beam is in order of distance
            picked = np.where(open_[rows, order], ids[rows, order], -1)
            done[rows, order] = True
            meet(np.where(picked[:, :, None] >= 0, self.links[picked], -1).reshape(n, -1).astype(np.int32))


def chosen_lists(ids: np.ndarray, far: np.ndarray, sizes: np.ndarray, ratio: float, least: int) -> list[np.ndarray]:
    """Of the found lists those within `ratio` of the nearest, and as many more as hold `least` postings."""
    out = []
    for own, d in zip(ids, far, strict=True):
        own, d = own[own >= 0], d[:int((own >= 0).sum())]
        held = np.cumsum(sizes[own])
        out.append(own[(d <= ratio * d[0] + 1e-6) | (held - sizes[own] < least)])
    return out


def home_lists(points: np.ndarray, centroids: np.ndarray, replicas: int, boundary: float) -> list[np.ndarray]:
    """The nearest list of every entry, and further ones that are nearly as close."""
    out = []
    for lo in range(0, len(points), VECTORS):
        apart = np.sqrt(_squared(points[lo:lo + VECTORS], centroids))
        n = min(replicas, apart.shape[1])
        near = np.argpartition(apart, n - 1, axis=1)[:, :n]
        d = np.take_along_axis(apart, near, axis=1)
        keep = d <= boundary * d.min(axis=1, keepdims=True) + 1e-6
        out += [x[k] for x, k in zip(near, keep, strict=True)]
    return out


# ---------------------------------------------------------------- results

def best_of(query: np.ndarray, score: np.ndarray, first: np.ndarray, entry: np.ndarray, k: int) -> np.ndarray:
    """Places of the `k` best different entries of every query: higher score, then smaller first id."""
    order = np.lexsort((entry, first, -score, query))
    q, e = query[order], entry[order]
    # Copies of an entry (from several lists) have equal keys and stand together.
    new = np.ones(len(order), dtype=bool)
    new[1:] = (q[1:] != q[:-1]) | (e[1:] != e[:-1])
    order, q = order[new], q[new]
    starts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.empty(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
    return order[rank < k]


def page_best(queries: np.ndarray, page: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, place in page, score) of each query's `k` best entries of a page, scores in a fixed order of additions."""
    rough = queries @ page.T
    n = min(k, len(page))
    edge = np.partition(rough, len(page) - n, axis=1)[:, len(page) - n]
    # All that reach the edge, up to rounding: ties are decided by exact scores and ids.
    q, at = np.nonzero(rough >= (edge - 1e-9 * np.maximum(1, np.abs(edge)))[:, None])
    score = (queries[q] * page[at]).sum(axis=1)
    keep = best_of(q, score, first[at], at, k)
    return q[keep], at[keep], score[keep]


class Best:
    """The best results of the queries a task has seen, cut to `k` for each whenever they are many."""

    NAMES = ("query", "score", "first", "entry")

    def __init__(self, k: int):
        self._k, self._held, self._n = k, [], 0

    def add(self, *columns: np.ndarray) -> None:
        self._held.append(columns)
        self._n += len(columns[0])

    @property
    def many(self) -> bool:
        return self._n >= HELD

    def cut(self) -> tuple[np.ndarray, ...]:
        columns = tuple(np.concatenate(x) for x in zip(*self._held, strict=True))
        keep = best_of(*columns, self._k)
        columns = tuple(x[keep] for x in columns)
        self._held, self._n = [columns], len(keep)
        return columns

    def out(self) -> Iterator[pa.RecordBatch]:
        if self._held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in self.cut()], names=list(self.NAMES))
        self._held, self._n = [], 0


# ---------------------------------------------------------------- Spark

def _listed(column: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, column)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *column]).astype(np.int32)))


def _with_lists(rows: DataFrame, pick, dims: int, name: str) -> DataFrame:
    """`rows` (id, ..., vector last) with lists = pick(matrix of the vectors)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), VECTORS):
                batch = whole.slice(lo, VECTORS)
                own = pick(matrix(batch.column("vector"), dims))
                yield pa.RecordBatch.from_arrays([*batch.columns, _listed(own)], names=[*batch.schema.names, "lists"])

    kinds = ", ".join(f"{c} {k}" for c, k in rows.dtypes)
    return saved(map_batches(rows, run, f"{kinds}, lists array<int>"), name)


def _blocks(rows: DataFrame, sizes: DataFrame, of: int, *columns: str) -> DataFrame:
    """(list, salt, one array for each column): the rows of every list in blocks of about `of` rows."""
    dealt = rows.select(F.explode("lists").alias("list"), *columns).join(F.broadcast(sizes), "list")  # a row for each list

    def field(name: str):
        return lambda x: x[name]

    salt = F.pmod(F.xxhash64(columns[0]), F.ceil(F.col("n") / of).cast("long"))
    return dealt.groupBy("list", salt.alias("salt")).agg(
        *(F.transform(F.collect_list(F.struct(*columns)), field(c)).alias(c) for c in columns))


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("n"))


def fit(entries: DataFrame, n: int, dims: int, radius: float, per_list: int = ENTRIES, max_lists: int = MAX_LISTS,
        sample: int = SAMPLE) -> np.ndarray:
    """Centroids of max(1, n / per_list) lists, at most `max_lists`, from about `sample` entries chosen by a hash.

    Runs in one task; at most max_lists rows come to the driver.
    """
    parts = max(1, min(max_lists, n // per_list))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = [entry_points(matrix(b.column(0), dims), radius) for b in batches]
        means = bisect(np.concatenate(points), parts) if points else np.empty((0, dims + 1), np.float32)
        yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(means.ravel()), dims + 1).cast(
            pa.list_(pa.float32()))], names=["centroid"])

    share = F.pmod(F.xxhash64("entry", F.lit("sample")), F.lit(1 << 30)) < F.lit(math.ceil(min(1.0, sample / max(n, 1)) * (1 << 30)))
    some = entries.filter(share).limit(2 * sample).repartition(1).sortWithinPartitions("entry").select("vector")
    rows = map_batches(some, run, "centroid array<float>").toArrow()
    return np.array(rows["centroid"].to_pylist(), dtype=np.float32).reshape(-1, dims + 1)


def search(rows: DataFrame, asks: Column, k: int = K, beam: int = BEAM, ratio: float = RATIO) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest found of every row of (vec_id, vector) for which `asks` holds.

    Candidates of a query are all rows but itself; nearest first, ties to the
    smaller vec_id (null last). Vectors that are null, zero or hold a null or
    non-finite component take no part; shorter vectors count as filled up with
    zeros. Repeated rows are candidates, and ask, as often as they come. An
    empty table, or a query without candidates, gives no rows.
    """
    spark = rows.sparkSession
    rows = saved(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "vector").filter(usable(F.col("vector")))
                 .withColumn("row", F.monotonically_increasing_id()), "nearest-rows")
    order = Window.partitionBy("vector").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    entries = saved(rows.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k + 1)
                    .groupBy("vector").agg(F.min("row").alias("entry"),
                                           F.min(F.coalesce("vec_id", F.lit(2**63 - 1))).alias("first"),
                                           F.collect_list(F.struct("vec_id", "row")).alias("members")), "nearest-entries")
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, dims, most = entries.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.max(norm)).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not n:
        return empty
    radius = math.sqrt(most)
    # At most MAX_LISTS centroids with some links each: bounded, so it can be broadcast.
    graph = Graph.of(fit(entries, n, dims, radius))
    shipped = spark.sparkContext.broadcast(graph)
    homes = _with_lists(entries.select("entry", "first", "vector"),
                        lambda x: home_lists(entry_points(x, radius), shipped.value.centroids, REPLICAS, BOUNDARY), dims,
                        "nearest-homes")
    lengths = saved(_sizes(homes), "nearest-lengths")  # a row for each list
    sizes = np.zeros(len(graph.centroids), dtype=np.int64)
    for r in lengths.collect():
        sizes[r["list"]] = r["n"]
    asking = rows.filter(F.coalesce(asks, F.lit(False)))
    asked = saved(asking.select("vector").distinct().withColumn("query", F.monotonically_increasing_id()), "nearest-asked")

    def find(x: np.ndarray) -> list[np.ndarray]:
        ids, far = shipped.value.nearest(query_points(x, radius), beam)
        return chosen_lists(ids, far, sizes, ratio, (k + 1) * REPLICAS)

    probes = _with_lists(asked.select("query", "vector"), find, dims, "nearest-probes")
    pages = _blocks(homes, lengths, PAGE, "entry", "first", "vector")
    blocks = _blocks(probes, _sizes(probes), BLOCK, "query", "vector")
    met = pages.drop("salt").join(blocks.select("list", "query", F.col("vector").alias("asked")), "list").drop("list")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k + 1)
        for batch in batches:
            for i in range(len(batch)):
                entry, first, vectors, query, own = (batch.column(c)[i].values for c in ("entry", "first", "vector", "query", "asked"))
                q, at, score = page_best(matrix(own, dims), matrix(vectors, dims), first.to_numpy(), k + 1)
                best.add(query.to_numpy()[q], score, first.to_numpy()[at], entry.to_numpy()[at])
                if best.many:
                    best.cut()
                    if best.many:
                        yield from best.out()
        yield from best.out()

    found = map_batches(met, meet, "query long, score double, first long, entry long")
    # Best first: structs sort by score downwards, then by the smallest id of the entry.
    per_query = found.groupBy("query").agg(F.slice(F.array_sort(F.array_distinct(F.collect_list(
        F.struct((-F.col("score")).alias("minus"), "first", "entry")))), 1, k + 1).alias("best"))
    named = (per_query.select("query", F.inline("best")).join(entries.select("entry", "members"), "entry")
             .select("query", "minus", F.inline("members")))
    last = F.col("vec_id").isNull().alias("last")
    tops = named.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct("minus", last, "vec_id", "row"))), 1, k + 1)
                                      .alias("tops"))
    own = asking.select(F.col("vec_id").alias("query_id"), F.col("row").alias("own"), "vector").join(asked, "vector").drop("vector")
    others = F.slice(F.filter("tops", lambda x: x["row"] != F.col("own")), 1, k)
    return (own.join(tops, "query").select("query_id", F.posexplode(others).alias("place", "of"))
            .select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("of.vec_id").alias("vec_id"),
                    (-F.col("of.minus")).alias("score")))


def op11_balanced_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return search(rows, F.col("vec_id") % QUERY_EVERY == 0)
