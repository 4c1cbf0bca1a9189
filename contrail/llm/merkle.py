"""Merkle manifest of a table with octopus multiproofs.

Every row is a leaf, the SHA-256 of its length-prefixed fields. The leaves of
a group (here: of a language) in ascending key order are the bottom of a tree
in which FAN consecutive nodes have the hash of their joined hex digests as
parent; the groups' roots, ordered by group, are the leaves of one more tree,
built by the same functions.

Leaves are range-partitioned and stored as *leaf partitions*: rows of at most
LEAVES consecutive leaves. All that follows is done for whole leaf partitions:

* each derives by itself every node whose leaves it holds; only its *peaks*,
  the nodes whose parent also needs another partition, leave it. Parents of
  peaks are made level by level, a shuffle of a few rows for each partition.
* a multiproof for all its leaves needs the minimal union of the nodes that
  are siblings on some path and that it can't derive: at most 2 (FAN - 1)
  coordinates a level, known from its place and the tree's size alone. They
  are fetched once, by one join for the whole table.
* the interior nodes follow from leaves and fetched nodes once for the whole
  partition, and the proofs of its leaves are read off them in the partition.

No task holds more than a leaf partition; a group of any size, or one key
with a third of all rows, is spread over many of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm.common import map_batches, saved, table

FAN = 8
#: Leaves of a leaf partition at most: a third of a megabyte.
LEAVES = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of a batch that hold a whole leaf partition each.
PARTITIONS_PER_BATCH = 8

Steps = list[tuple[str, str]]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- shape of a tree

def width(total: int, level: int) -> int:
    """Nodes of a level of the tree over `total` leaves."""
    for _ in range(level):
        total = -(-total // FAN)
    return total


def depth(total: int) -> int:
    """Level of the root; a lone leaf is its own root."""
    level = 0
    while total > 1:
        total, level = -(-total // FAN), level + 1
    return level


def derivable(start: int, n: int, total: int) -> list[tuple[int, int]]:
    """[begin, end) of the nodes of every level that the leaves [start, start + n) determine."""
    begin, end, out = start, start + n, [(start, start + n)]
    for level in range(depth(total)):
        last = end == width(total, level)
        begin, end = -(-begin // FAN), -(-end // FAN) if last else end // FAN
        out.append((begin, max(begin, end)))
    return out


def missing(start: int, n: int, total: int) -> list[tuple[int, int]]:
    """The minimal union of (level, position) the proofs of the leaves [start, start + n) need beside them."""
    begin, end, out = start, start + n, []
    for level in range(depth(total)):
        first, after = begin // FAN, -(-end // FAN)
        out += [(level, p) for p in range(first * FAN, begin)]
        out += [(level, p) for p in range(end, min(after * FAN, width(total, level)))]
        begin, end = first, after
    return out


def grow(leaves: list[str], start: int, total: int) -> list[tuple[int, list[str]]]:
    """(first position, digests) of every level as far as the leaves alone determine it."""
    spans = derivable(start, len(leaves), total)
    out = [(start, leaves)]
    for begin, end in spans[1:]:
        low, below = out[-1]
        out.append((begin, [digest("".join(below[p * FAN - low:(p + 1) * FAN - low])) for p in range(begin, end)]))
    return out


def peaks(levels: list[tuple[int, list[str]]]) -> list[tuple[int, int, str]]:
    """(level, position, digest) of the derived nodes whose parent isn't derived; the root counts."""
    out = []
    for level, (begin, nodes) in enumerate(levels):
        up, above = levels[level + 1] if level + 1 < len(levels) else (0, [])
        out += [(level, begin + i, x) for i, x in enumerate(nodes)
                if not up <= (begin + i) // FAN < up + len(above)]
    return out


def proofs(leaves: list[str], start: int, total: int, fetched: dict[tuple[int, int], str]) -> Iterator[Steps]:
    """(left siblings, right siblings) from the bottom up, each joined, for every leaf.

    The interior nodes, and what is above a node, are made once and shared by
    all leaves below. A node that should have been fetched and wasn't raises.
    """
    levels, begin, nodes = [], start, leaves
    for level in range(depth(total)):
        first, after = begin // FAN, -(-(begin + len(nodes)) // FAN)
        lows = [fetched[level, p] for p in range(first * FAN, begin)]
        highs = [fetched[level, p] for p in range(begin + len(nodes), min(after * FAN, width(total, level)))]
        whole = lows + nodes + highs
        levels.append((first * FAN, whole))
        begin, nodes = first, [digest("".join(whole[i:i + FAN])) for i in range(0, len(whole), FAN)]
    above: dict[int, Steps] = {0: []}
    for level in range(len(levels) - 1, 0, -1):
        low, whole = levels[level]
        above = {low + i: [(_left(whole, i), _right(whole, i)), *above[(low + i) // FAN]] for i in range(len(whole))}
    for p in range(start, start + len(leaves)):
        if not levels:
            yield []
            continue
        low, whole = levels[0]
        yield [(_left(whole, p - low), _right(whole, p - low)), *above[p // FAN]]


def _left(nodes: list[str], i: int) -> str:
    return "".join(nodes[i - i % FAN:i])


def _right(nodes: list[str], i: int) -> str:
    return "".join(nodes[i + 1:i - i % FAN + FAN])


def folded(leaf: str, steps: Steps) -> str:
    """The root that `leaf` and its siblings give."""
    for left, right in steps:
        leaf = digest(left + leaf + right)
    return leaf


# ---------------------------------------------------------------- a forest in Spark

def leaf_partitions(rows: DataFrame, leaves: int = LEAVES) -> DataFrame:
    """(part, chunk, grp, n, keys, hashes, altered): runs of consecutive leaves of one group.

    `rows`: grp, key, leaf and altered (binary digests, altered may be null).
    Leaves of equal keys follow one another by their digests.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, grp = TaskContext.get().partitionId(), 0, None
        held: tuple[list, list, list] = ([], [], [])

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([chunk], pa.int32()), pa.array([grp], pa.string()),
                 pa.array([len(held[0])], pa.int32()), pa.array([held[0]], pa.list_(key_type)),
                 pa.array([held[1]], pa.list_(pa.binary())), pa.array([held[2]], pa.list_(pa.binary()))],
                names=["part", "chunk", "grp", "n", "keys", "hashes", "altered"])

        for batch in batches:
            key_type = batch.schema.field("key").type
            for g, key, leaf, altered in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if held[0] and (g != grp or len(held[0]) == leaves):
                    yield out()
                    chunk += 1
                    for x in held:
                        x.clear()
                grp = g
                held[0].append(key)
                held[1].append(leaf)
                held[2].append(altered)
        if held[0]:
            yield out()

    # The tie tells equal rows apart, so that a range can end between them; it is fixed once the rows are written.
    fixed = saved(rows.select("grp", "key", "leaf", "altered").withColumn("tie", F.monotonically_increasing_id()),
                  "merkle-leaves")
    order = ("grp", "key", "leaf", "tie")
    dealt = fixed.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    kind = dict(dealt.dtypes)["key"]
    return saved(map_batches(dealt, run, f"part int, chunk int, grp string, n int, keys array<{kind}>, "
                                         "hashes array<binary>, altered array<binary>"), "merkle-partitions")


def places(parts: DataFrame) -> DataFrame:
    """(part, chunk, grp, n, start, total): where each leaf partition lies in its group's tree."""
    sizes = parts.select("part", "chunk", "grp", "n")
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = sizes.groupBy("grp", "part").agg(F.sum("n").alias("m")).select(
        "grp", "part", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"),
        F.sum("m").over(Window.partitionBy("grp")).alias("total"))
    inside = Window.partitionBy("grp", "part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return saved(sizes.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(by_part, ["grp", "part"])
                 .select("part", "chunk", "grp", "n", (F.col("base") + F.col("inside")).alias("start"), "total"),
                 "merkle-places")


def _rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    for lo in range(0, batch.num_rows, PARTITIONS_PER_BATCH):
        some = batch.slice(lo, PARTITIONS_PER_BATCH)
        yield from zip(*(some.column(c).to_pylist() for c in names), strict=True)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def nodes(parts: DataFrame, where: DataFrame) -> DataFrame:
    """(grp, total, level, pos, digest): all peaks and everything above them, the roots included."""
    schema = pa.schema([("grp", pa.string()), ("total", pa.int64()), ("level", pa.int32()), ("pos", pa.int64()),
                        ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grp, start, total, hashes in _rows(batch, "grp", "start", "total", "hashes"):
                own = peaks(grow([x.hex() for x in hashes], start, total))
                yield _batch([(grp, total, *x) for x in own], schema)

    kinds = "grp string, total long, level int, pos long, digest string"
    placed = parts.select("part", "chunk", "hashes").join(where, ["part", "chunk"])
    made = [saved(map_batches(placed.select("grp", "start", "total", "hashes"), run, kinds), "merkle-peaks")]
    largest = where.agg(F.max("total")).first()[0] or 0
    children = F.transform(F.sort_array(F.collect_list(F.struct("pos", "digest"))), lambda x: x["digest"])
    for level in range(depth(largest)):
        here = made[0].filter(F.col("level") == level)
        if level:
            here = here.unionByName(made[-1])
        here = here.filter(F.col("total") > FAN**level)  # more than one node is left on this level
        made.append(saved(here.groupBy("grp", "total", F.shiftright("pos", 3).alias("pos"))
                          .agg(F.sha2(F.array_join(children, ""), 256).alias("digest"))
                          .select("grp", "total", F.lit(level + 1).alias("level"), "pos", "digest"), "merkle-level"))
    out = made[0]
    for one in made[1:]:
        out = out.unionByName(one)
    return out


def multiproofs(parts: DataFrame, where: DataFrame, tree: DataFrame) -> DataFrame:
    """(part, chunk, grp, start, total, fetched): what each leaf partition needs, fetched by one join."""
    schema = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("grp", pa.string()), ("level", pa.int32()),
                        ("pos", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, chunk, grp, start, n, total in zip(*(batch.column(c).to_pylist() for c in (
                    "part", "chunk", "grp", "start", "n", "total")), strict=True):
                yield _batch([(part, chunk, grp, *x) for x in missing(start, n, total)], schema)

    asked = map_batches(where, run, "part int, chunk int, grp string, level int, pos long")
    got = (asked.join(tree.select("grp", "level", "pos", "digest"), ["grp", "level", "pos"])
           .groupBy("part", "chunk").agg(F.collect_list(F.struct("level", "pos", "digest")).alias("fetched")))
    return where.select("part", "chunk", "grp", "start", "total").join(got, ["part", "chunk"], "left")


def roots(tree: DataFrame) -> DataFrame:
    """(grp, root): the node of each group that has no parent."""
    # FAN to the power of the level: the root is the first level on which one node covers all leaves.
    covers = F.pow(F.lit(float(FAN)), F.col("level"))
    root = (F.col("pos") == 0) & (covers >= F.col("total")) & ((F.col("level") == 0) | (covers / FAN < F.col("total")))
    return tree.filter(root).select("grp", F.col("digest").alias("root"))


def expand(parts: DataFrame, proved: DataFrame, fields: pa.Schema, schema: str, tell: Callable) -> DataFrame:
    """`tell(key, leaf, altered, steps, row)` for every leaf, as rows; `row`: the partition's columns of `proved`."""
    extra = [c for c in proved.columns if c not in ("part", "chunk", "start", "total", "fetched")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, hashes, altered, start, total, fetched, *row in _rows(
                    batch, "keys", "hashes", "altered", "start", "total", "fetched", *extra):
                leaves = [x.hex() for x in hashes]
                have = {(x["level"], x["pos"]): x["digest"] for x in fetched or ()}
                every = proofs(leaves, start, total, have)
                yield _batch([tell(k, leaf, a, steps, row) for k, leaf, a, steps in
                              zip(keys, leaves, altered, every, strict=True)], fields)

    both = parts.select("part", "chunk", "keys", "hashes", "altered").join(proved, ["part", "chunk"])
    return map_batches(both, run, schema)


STEPS = "array<struct<left: string, right: string>>"


def _paths(rows: DataFrame) -> DataFrame:
    """(key, steps, root) of every leaf of a forest of one group."""
    parts = leaf_partitions(rows)
    where = places(parts)
    tree = nodes(parts, where)
    proved = multiproofs(parts, where, tree)
    pair = pa.struct([("left", pa.string()), ("right", pa.string())])
    fields = pa.schema([("key", pa.string()), ("steps", pa.list_(pair)), ("root", pa.string())])

    def tell(key, leaf, altered, steps, row):
        return key, [{"left": a, "right": b} for a, b in steps], folded(leaf, steps)

    return expand(parts, proved, fields, f"key string, steps {STEPS}, root string", tell)


# ---------------------------------------------------------------- documents

def _field(c: Column) -> Column:
    value = c.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_of(*columns: Column) -> Column:
    """Binary SHA-256 of the columns, each `-` if null, else byte count, colon and value."""
    return F.unhex(F.sha2(F.concat(*(_field(c) for c in columns)).cast("binary"), 256))


def group_key(c: Column) -> Column:
    """A text that is never null and sorts as `c` does: null first, then by UTF-8 bytes."""
    return F.when(c.isNull(), "").otherwise(F.concat(F.lit("+"), c.cast("string")))


def manifest(docs: DataFrame) -> DataFrame:
    """Every row's leaf, its group's root, the root of all, and the check of a proof, with tampering planted.

    (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified). Where
    3 divides the CRC-32 of the decimal doc_id, the proof is checked against
    the row with its text lower-cased (A-Z); a text without capitals stays as
    it is and verifies. A null doc_id comes first in its language, has no
    CRC-32 and isn't tampered with. Rows of equal doc_id follow one another by
    their leaves; repeated rows are leaves as often as they come. Texts of any
    length are hashed where they lie and never shuffled. An empty table gives
    no rows; other columns than the five hashed ones are ignored.
    """
    columns = [F.col("doc_id").cast("long"), *(F.col(c) for c in FIELDS[1:])]
    tampered = F.crc32(columns[0].cast("string").cast("binary")) % 3 == 0
    rows = docs.select(
        group_key(F.col("lang")).alias("grp"), columns[0].alias("key"), leaf_of(*columns).alias("leaf"),
        F.when(tampered, leaf_of(*columns[:-1], F.translate("text", UPPER, LOWER))).alias("altered"))
    parts = leaf_partitions(rows)
    where = places(parts)
    tree = nodes(parts, where)
    subroots = roots(tree)
    upper = _paths(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("key"), F.unhex("root").alias("leaf"),
                                   F.lit(None).cast("binary").alias("altered")))
    tops = saved(subroots.withColumnRenamed("root", "subroot").join(
        upper.withColumnRenamed("key", "grp"), "grp"), "merkle-tops")
    proved = multiproofs(parts, where, tree).join(tops, "grp").drop("grp")
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    kinds = ("long", *["string"] * 5, "boolean")
    fields = pa.schema([(c, {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[k])
                        for c, k in zip(names, kinds, strict=True)])

    def tell(key, leaf, altered, steps, row):
        subroot, upwards, root = row
        steps = steps + [(x["left"], x["right"]) for x in upwards]
        got = folded(leaf if altered is None else altered.hex(), steps)
        return key, leaf, subroot, root, digest("".join([x for pair in steps for x in pair])), got, got == root

    return expand(parts, proved, fields, ", ".join(f"{c} {k}" for c, k in zip(names, kinds, strict=True)), tell)


def op13_merkle_multiproof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def _tree_sql(name: str, levels: int) -> str:
    """CTEs of a forest over `name`_0 (g, p, h): node levels, siblings, and the fold along each leaf's path.

    `name`_path_0 (g, p, f, proof) gains a level in each `name`_path_k; a group that is down to one node passes through.
    """
    out = []
    for k in range(levels):
        pair = f"PARTITION BY g, p // {FAN} ORDER BY p ROWS BETWEEN"
        out.append(f"""{name}_siblings_{k} AS (SELECT g, p, count(*) OVER (PARTITION BY g) > 1 AS more,
  coalesce(string_agg(h, '') OVER ({pair} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER ({pair} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}_{k}),
{name}_path_{k + 1} AS (SELECT a.g, a.p, CASE WHEN more THEN sha256(l || f || r) ELSE f END AS f,
  CASE WHEN more THEN proof || l || r ELSE proof END AS proof
  FROM {name}_path_{k} a LEFT JOIN {name}_siblings_{k} s ON a.g = s.g AND a.p // {FAN**k} = s.p),
{name}_{k + 1} AS (SELECT g, p // {FAN} AS p, sha256(string_agg(h, '' ORDER BY p)) AS h FROM {name}_{k}
  WHERE g IN (SELECT g FROM {name}_{k} GROUP BY g HAVING count(*) > 1) GROUP BY g, p // {FAN})""")
    tops = " UNION ALL ".join(f"SELECT g, {k} AS k, h FROM {name}_{k} WHERE p = 0" for k in range(levels + 1))
    return ",\n".join([*out, f"{name}_roots AS (SELECT g, arg_max(h, k) AS root FROM ({tops}) GROUP BY g)"])


def oracle(levels: int = 8, upper_levels: int = 3) -> str:
    """DuckDB SQL for trees of at most FAN ** levels leaves and FAN ** upper_levels groups."""
    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(
            f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}::VARCHAR) || ':' || {v}::VARCHAR END"
            for v in (*FIELDS[:-1], text)) + ")"

    bits = "list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)"
    digits = "list_transform(range(length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, (i + 1)::INT, 1))::BIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda c, x: {bits}), 4294967295)"
    return f"""WITH leaves AS (SELECT doc_id, coalesce('+' || lang, '') AS g, {leaf("text")} AS h,
  CASE WHEN {crc} % 3 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS altered FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS p FROM leaves),
low_0 AS (SELECT g, p, h FROM placed),
low_path_0 AS (SELECT g, p, coalesce(altered, h) AS f, '' AS proof FROM placed),
{_tree_sql("low", levels)},
high_0 AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS p, root AS h, g AS of FROM low_roots),
high_path_0 AS (SELECT g, p, h AS f, '' AS proof FROM high_0),
{_tree_sql("high", upper_levels)},
tops AS (SELECT of, h AS subroot, proof AS above, root FROM high_0 JOIN high_path_{upper_levels} USING (g, p) JOIN high_roots USING (g)),
walked AS (SELECT p.doc_id, p.h AS leaf, t.subroot, t.root, t.of, w.f, w.proof || t.above AS proof, o.p AS place
  FROM placed p JOIN low_path_{levels} w ON p.g = w.g AND p.p = w.p JOIN tops t ON t.of = p.g JOIN high_0 o ON o.of = p.g),
{_climb_sql(upper_levels)}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM climbed_{upper_levels}"""


def _climb_sql(levels: int) -> str:
    """CTEs that fold each document's own path on through the tree of the groups."""
    out = ["climbed_0 AS (SELECT * FROM walked)"]
    for k in range(levels):
        out.append(f"""climbed_{k + 1} AS (SELECT c.* REPLACE (CASE WHEN s.more THEN sha256(s.l || c.f || s.r) ELSE c.f END AS f)
  FROM climbed_{k} c LEFT JOIN high_siblings_{k} s ON s.p = c.place // {FAN**k})""")
    return ",\n".join(out)


ORACLE = oracle()
