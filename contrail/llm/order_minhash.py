"""Order MinHash fingerprints, in DataFrame functions only.

The k-mers of a text are its runs of K consecutive words. Each is numbered
by how often it has occurred in the text before, so a repeated k-mer counts
as often as it comes. A hash of (k-mer, number) orders them; component j of
the signature takes the TUPLE smallest of the j-th permutation of that
order, puts them back into text order and hashes the tuple of k-mers. Two
texts agree in a component when they have the same minimal k-mers in the
same order, which follows their edit distance, not only their k-mer sets.

The permutations are rotations of the 64-bit hash space: the order of
permutation j begins at j / SIZE of the space and wraps around, so all of
them are read off one sorted array by binary search. Numbering also comes from one sort: the
k-mers' hashes are sorted with their positions in the low bits, equal ones
form runs, and the number is the place in the run. Each text costs two sorts
of its k-mers and some passes over them, inside its own row: nothing is
exploded or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm.common import saved, table

K = 3
TUPLE = 2
SIZE = 64
SPACES = " \t\n\r\x0b\x0c"
#: Ids of a block, the unit in which a document meets the next one, as a power of two.
BLOCK_BITS = 7
#: Rows of one id that make it hot: it is cut into pieces of about so many rows, by the hash of the text.
HOT_ROWS = 2_000
#: Blocks with hot ids whose list is sent to all tasks; with more it is joined.
SENT_BLOCKS = 10_000


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K, size: int = SIZE) -> DataFrame:
    """`df` with column `out`: the signature of column `text`, `size` ints.

    A text of fewer than `k` words is one k-mer; a null text or one without
    words has a signature of zeros. Texts that differ in white space alone
    are alike.
    """
    kept = df.columns
    words = F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES)), "[ \\t-\\r]+")
    kmers, sorted_, bits = F.col("__kmers"), F.col("__sorted"), F.col("__bits")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

    def at(array, i):
        return F.get(array, i)

    def kmer_of(v):
        return at(kmers, v.bitwiseAND(F.col("__mask")).cast("int"))

    def leading(v):
        return F.call_function("shiftrightunsigned", v, bits)

    def packed(value, position):
        return value.bitwiseAND(F.bitwise_not(F.col("__mask"))).bitwiseOR(position.cast("long"))

    starts = [-2**63 + j * (2**64 // size) for j in range(size)]
    step = df.select("*", F.transform(words, lambda w: F.xxhash64(w)).alias("__words"),
                     (F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES)) == "").alias("__none"))
    step = step.withColumn("__n", F.when(F.col("__none"), 0).otherwise(F.greatest(F.size("__words") - (k - 1), F.lit(1))))
    step = step.select(*kept, "__n", F.length(F.bin(F.col("__n").cast("long"))).alias("__bits"), F.transform(
        F.slice("__words", F.lit(1), F.col("__n")),
        lambda w, i: F.xxhash64(w, *(at(F.col("__words"), i + d) for d in range(1, k)))).alias("__kmers"))
    step = step.withColumn("__mask", mask)
    step = step.withColumn("__sorted", F.sort_array(F.transform(kmers, packed)))
    # Places in the sorted array where a run of equal k-mers begins.
    step = step.withColumn("__starts", F.filter(F.transform(sorted_, lambda v, i: F.when(
        leading(v).eqNullSafe(leading(at(sorted_, i - 1))), -1).otherwise(i)),
        lambda i: i >= 0))
    numbers = F.flatten(F.transform("__starts", lambda s, j: F.sequence(
        F.lit(0), F.coalesce(at(F.col("__starts"), j + 1), F.col("__n")) - s - 1)))
    # Hash of (k-mer, number), again with the text position in the low bits. The numbers are an argument of the
    # lambda: a column named in its body could be merged into it by the optimizer and be computed for every element.
    numbered = F.zip_with(sorted_, numbers, lambda v, number: F.coalesce(
        packed(F.xxhash64(kmer_of(v), number), v.bitwiseAND(F.col("__mask"))), F.lit(0).cast("long")))
    step = step.select(*kept, "__n", "__mask", "__kmers", F.sort_array(numbered).alias("__order"))
    # Powers of two from the largest that fits in n down to 1: the steps of a binary search.
    step = step.withColumn("__steps", F.transform(F.sequence(F.length(F.bin(F.col("__n").cast("long"))) - 1, F.lit(0)),
                                                  lambda e: F.call_function("shiftleft", F.lit(1), e)))

    def smaller(mark):
        """How many of the sorted hashes are below `mark`."""
        return F.aggregate("__steps", F.lit(0), lambda lo, by: F.when(
            at(F.col("__order"), lo + by - 1) < mark, lo + by).otherwise(lo))

    def component(first):
        chosen = [at(F.col("__order"), (first + t) % F.col("__n")) for t in range(TUPLE)]
        in_text = F.sort_array(F.array(*(v.bitwiseAND(F.col("__mask")) for v in chosen)))
        return F.xxhash64(*(at(kmers, at(in_text, F.lit(t)).cast("int")) for t in range(TUPLE))).bitwiseAND(
            F.lit(2**31 - 1)).cast("int")

    # Named twice, __steps and __first stay projections of their own, computed once for each row.
    firsts = F.transform(F.array(*(F.lit(s) for s in starts)), smaller)
    step = step.withColumn("__first", F.when(F.size("__steps") > 0, firsts))
    some = (F.col("__n") > 0) & (F.size("__first") == size)
    return step.select(*kept, F.when(some, F.transform("__first", component))
                       .otherwise(F.array_repeat(F.lit(0), size)).alias(out))


def likeness(a: Column, b: Column, size: int = SIZE) -> Column:
    """Share of equal components."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / F.lit(size)


def as_text(fingerprint: Column) -> Column:
    """Eight lowercase hex digits for each component."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x.cast("long")), 8, "0")), ""))


def _successors(keys: DataFrame) -> DataFrame:
    """(key, next) in ascending order of the distinct `key`; after the last comes the first.

    Keys are range-partitioned and linked inside their partition; the last of
    each partition takes the first of the next one from a table of one row
    per partition.
    """
    parts = saved(keys.repartitionByRange("key").select(F.spark_partition_id().alias("part"), "key"), "successors")
    firsts = parts.groupBy("part").agg(F.min("key").alias("first"))
    order = Window.orderBy("part")
    after = firsts.select("part", F.coalesce(F.lead("first").over(order), F.first("first").over(order)).alias("after"))
    inside = F.lead("key").over(Window.partitionBy("part").orderBy("key"))
    return (parts.withColumn("inside", inside).join(F.broadcast(after), "part")  # one row per partition
            .select("key", F.coalesce("inside", "after").alias("next")))


def _id() -> Column:
    return F.coalesce("doc_id", F.lit(-2**63).cast("long"))


def _block(base: Column, step: Column) -> Column:
    """A block, of the type it has when it is read back from a file: a join with those needs no cast, nor a shuffle for it."""
    return F.struct(base.alias("base"), step.alias("step")).cast("struct<base: bigint, step: bigint>")


def _blocked(docs: DataFrame, block_bits: int, hot_rows: int) -> DataFrame:
    """`docs` with __block, ascending with the id (null: the smallest long), then with the hash of the text.

    A block is a run of neighbouring ids. Where an id has more than `hot_rows`
    rows, its block is cut before it, after it, and by the hash inside it.
    """
    base = F.shiftright(_id(), block_bits)
    hot = saved(docs.groupBy(_id().alias("__id")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows)
                .groupBy(F.shiftright("__id", block_bits).alias("__base"))  # at most 2 ** block_bits ids
                .agg(F.collect_list(F.struct("__id", F.ceil(F.col("n") / hot_rows).cast("long").alias("pieces"))).alias("__hot")),
                "hot-ids")
    blocks = hot.count()
    if not blocks:
        return docs.withColumn("__block", _block(base, F.lit(0)))
    rows = docs.withColumn("__base", base).join(F.broadcast(hot) if blocks <= SENT_BLOCKS else hot, "__base", "left")
    place = (F.xxhash64("text").cast("double") + 2.0**63) / 2.0**64  # 0 to 1, ascending with the hash
    step = F.aggregate(F.coalesce("__hot", F.array().cast("array<struct<__id: bigint, pieces: bigint>>")), F.lit(0).cast("long"),
                       lambda s, h: s + F.when(h["__id"] < _id(), h["pieces"] + 1).when(
                           h["__id"] == _id(), 1 + F.least(F.floor(place * h["pieces"]), h["pieces"] - 1)).otherwise(0))
    return rows.withColumn("__block", _block(F.col("__base"), step)).drop("__base", "__hot")


def with_next(docs: DataFrame, block_bits: int = BLOCK_BITS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """`docs` (doc_id, text, fp) with next_text and next_fp of the next document by doc_id.

    The first document follows the last. A null doc_id counts as the smallest;
    rows of equal doc_id follow one another in the order of their texts'
    hashes. Texts are shuffled once, by blocks of neighbouring ids; only the
    first document of each block is sent to the block before it as well. An
    id, or null, with very many rows is several blocks.
    """
    blocked = _blocked(docs, block_bits, hot_rows)
    order = Window.partitionBy("__block").orderBy(_id(), F.xxhash64("text"))
    linked = blocked.repartition("__block").withColumns({
        "__at": F.row_number().over(order), "__text": F.lead("text").over(order), "__fp": F.lead("fp").over(order)})
    heads = linked.filter("__at = 1").select(F.col("__block").alias("next"), F.col("text").alias("__head"),
                                             F.col("fp").alias("__head_fp"))
    turns = _successors(blocked.select(F.col("__block").alias("key")).distinct())
    heads = turns.join(heads, "next").drop("next")
    return (linked.join(heads, (F.col("__block") == F.col("key")) & F.col("__fp").isNull(), "left")
            .select("doc_id", "text", "fp", F.coalesce("__text", "__head").alias("next_text"),
                    F.coalesce("__fp", "__head_fp").alias("next_fp")))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and its likeness to the latter and to the next document.

    Edited: the last half of the code points (rounded down) gives way to the
    first as many of the next document. A null text is empty.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    linked = with_next(with_fingerprint(slim, "text", "fp"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = linked.select("doc_id", "fp", "next_fp", n.cast("long").alias("n_chars"), F.concat(
        F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)).alias("edited"))
    done = with_fingerprint(edited, "edited", "edited_fp")
    return done.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))
