"""Near-duplicates by SuperMinHash signatures, banding, verification on full sets and union-find.

A document's set holds hashes (64 bits) of its distinct word shingles. For its signature every element
visits the components in an order of its own, a permutation, and leaves rank + fraction at each; a
component keeps the smallest value. As an element has each rank once, components are negatively
correlated, which makes the estimate less variable than independent hashes do, and as soon as every
component holds a value below the next rank, no later one can count: long documents stop after two or
three ranks. The permutation of an element is affine modulo a prime, drawn by its hash.

Equal sets are one node from the start, so a group of copies costs one row. Nodes that share a band of
the signature are candidates. They are never paired all with all: in each band bucket, nodes are
compared with a pivot, the one that meets most others, and only buckets that still hold nodes of
different components are looked at again, with further nodes as pivots: about four, twelve, forty-eight, ... at
a time. These are drawn by a hash below a threshold that depends on the bucket's size, so a bucket is never
sorted in one task, and the join of its nodes with the pivots can be dealt anew if it is skewed. There, pairs that share elements which few nodes have are found by these; for the others the number
of the rest and its parity bits (the bitmap filter of exact set joins) bound what they have in common, which
rules out most pairs just below the threshold, exactly. Links are verified on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, drop, mix, text_of, whole_row, word_hashes
from .common import cut as write
from .components import components

#: Components (a prime number of them), rows of a band and bands. At a similarity of 0.8 a pair shares no band with probability (1 - 0.8 ** 5) ** 29 = 1e-5.
COMPONENTS, ROWS, BANDS = 149, 5, 29
#: Words of 64 parity bits that sketch a set.
PARITY = 8
#: Pivots of a bucket are drawn by a hash, a whole number below this one.
DRAWS = 1 << 30


def shingles(raw: bytes, words: int) -> np.ndarray:
    """The set of a text: sorted hashes of its distinct shingles; of the whole sequence, if it has fewer words."""
    w = word_hashes(np.frombuffer(raw, np.uint8), lower=True)
    k = min(words, len(w))
    if not k:
        return w
    h = np.zeros(len(w) - k + 1, np.uint64)
    for j in range(k):
        h = h * np.uint64(0x9FB21C651E98DF25) + w[j : len(w) - k + 1 + j]
    h = np.sort(mix(h + np.uint64(k)))
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def signature(s: np.ndarray) -> np.ndarray:
    """SuperMinHash of a set that isn't empty: COMPONENTS values."""
    m = COMPONENTS
    step = (mix(s ^ np.uint64(0xA5A5A5A5)) % np.uint64(m - 1)).astype(np.int64) + 1
    place = (mix(s + np.uint64(0x1234567)) % np.uint64(m)).astype(np.int64)
    out = np.full(m, np.inf)
    for rank in range(m):
        part = (mix(s + np.uint64((rank + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(11)) * 2.0**-53
        np.minimum.at(out, place, part + rank)
        if out.max() < rank + 1:
            break
        place = (place + step) % m
    return out


def bands(sig: np.ndarray) -> np.ndarray:
    rows = sig[: ROWS * BANDS].view(np.uint64).reshape(BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + rows[:, j])
    return h.view(np.int64)


def identity(s: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    a = np.add.reduce(mix(s)) + np.uint64(len(s))
    b = np.bitwise_xor.reduce(mix(s * np.uint64(0xD6E8FEB86659FD93))) if len(s) else np.uint64(0)
    return int(np.uint64(a).astype(np.int64)), int(np.uint64(b).astype(np.int64))


def _signed(words: int):
    """Arrow batches (row_id, row_hash, raw) to (row_id, row_hash, n, k1, k2, bands)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, k1, k2, lists, last = [], [], [], [], [0]
            for raw in batch.column(2):
                s = shingles(raw.as_py(), words)
                a, b = identity(s)
                n.append(len(s)), k1.append(a), k2.append(b)
                if len(s):
                    lists.append(bands(signature(s)))
                last.append(last[-1] + (BANDS if len(s) else 0))
            values = pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64))
            got = pa.ListArray.from_arrays(pa.array(last, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), got], names=["row_id", "row_hash", "n", "k1", "k2", "bands"])

    return run


def _sets(words: int):
    """Arrow batches (nid, raw) to (nid, items)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(raw.as_py(), words).view(np.int64) for raw in batch.column(1)]
            last = np.cumsum([0, *[len(s) for s in sets]])
            items = pa.ListArray.from_arrays(pa.array(last, pa.int32()), pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), items], names=["nid", "items"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    left = sets.select(F.col("nid").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("nid").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b")


def _parity() -> list[Column]:
    """Aggregates p0, p1, ...: for each of 64 * PARITY residues of items, whether an odd number of them has it."""
    bit = F.col("item").bitwiseAND(F.lit(64 * PARITY - 1)).cast("int")
    one = F.expr("shiftleft(1L, cast(item & 63 as int))")
    return [F.bit_xor(F.when(F.shiftright(bit, 6) == i, one).otherwise(F.lit(0).cast("long"))).alias(f"p{i}") for i in range(PARITY)]


def _most(a: str, b: str) -> Column:
    """An upper bound of what two sets have in common but rare elements, of which they share none: an element
    that only one of them has flips one parity bit, so they differ in at least as many elements as bits."""
    bits = [F.bit_count(F.col(f"p{i}{a}").bitwiseXOR(F.col(f"p{i}{b}"))) for i in range(PARITY)]
    apart = sum(bits[1:], bits[0])
    return F.least(f"m{a}", f"m{b}", F.floor((F.col(f"m{a}") + F.col(f"m{b}") - apart) / 2))


def _rare(sets: DataFrame, among: DataFrame, few: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of the nodes in among, with elements being rare that at most few of them have: (nid, size, m, p0, ...), the
    elements of a set, those of them that aren't rare and the parities of these, and the pairs (a, b, common) with
    rare ones in common."""
    held = sets.join(among, "nid", "left_semi")
    items = write(held.select("nid", F.explode("items").alias("item")), "items")
    rare = write(items.join(items.groupBy("item").agg(F.count(F.lit(1)).alias("c")).where(f"c <= {few}"), "item"), "rare")
    own = rare.groupBy("nid").agg(F.count(F.lit(1)).alias("own"), *_parity())
    own = own.select("nid", "own", *(F.col(f"p{i}").alias(f"q{i}") for i in range(PARITY)))
    none = F.lit(0).cast("long")
    rest = [F.col(f"p{i}").bitwiseXOR(F.coalesce(f"q{i}", none)).alias(f"p{i}") for i in range(PARITY)]
    every = items.groupBy("nid").agg(F.count(F.lit(1)).alias("size"), *_parity())
    sizes = write(every.join(own, "nid", "left").select("nid", "size", (F.col("size") - F.coalesce("own", none)).alias("m"), *rest), "sizes")
    drop(items)
    two = rare.where("c > 1").select("item", "nid")
    pairs = two.withColumnRenamed("nid", "a").join(two.withColumnRenamed("nid", "b"), "item").where("a > b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"))
    return sizes, pairs, rare


def _open(members: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members, with their label and their bucket's size, of buckets that hold nodes of different components, and the table of these buckets."""
    marked = members.join(labels.withColumnRenamed("node", "nid"), "nid", "left").withColumn("label", F.coalesce("label", "nid"))
    split = marked.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("size")).where("x <> y").select("bucket", "size")
    split = write(split, "split")  # a table: the nodes of a bucket needn't meet in one task to learn its size
    return marked.join(split, "bucket"), split


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", few: int = 32) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, kept.

    Sets are linked where 100 * common >= percent * union; component_id is the smallest id that links reach.

    * A null or empty text, or one without words, has an empty set: n_shingles 0, linked with nothing.
    * Null ids are never the smallest; a row without an id has component_id null if it reaches no id, and is then kept.
    * Repeated rows give equal results. Rows that share an id but not a text are linked by their texts only.
    * An empty table gives an empty result. Other columns are not read, so their names don't matter.
    * Texts of any length count whole.

    Sets are of 64-bit hashes of shingles; equal sets are told by 128 bits.
    """
    scratch: list[DataFrame] = []

    def cut(df: DataFrame, name: str) -> DataFrame:
        scratch.append(write(df, name))
        return scratch[-1]

    rows = docs.select(column(id_col).alias("row_id"), F.xxhash64(column(text_col)).alias("row_hash"), text_of(text_col).alias("raw"))
    kind = docs.schema[id_col].dataType.simpleString()
    signed = cut(rows.mapInArrow(_signed(words), f"row_id {kind}, row_hash long, n long, k1 long, k2 long, bands array<long>"), "signed")
    # one node for each set; a document with it is read again where the set itself is needed
    nodes = signed.where("n > 0").groupBy("k1", "k2").agg(F.min("row_id").alias("first_id"), F.min(F.struct("row_id", "row_hash")).alias("at"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    nodes = cut(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    listed = nodes.select("nid", "n", F.explode("bands").alias("bucket"))
    sizes = cut(listed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    members = cut(listed.join(sizes, "bucket"), "buckets")
    # a node that meets many others is likely to be the one that they are copies of: the best pivot
    degree = members.groupBy("nid").agg(F.sum("size").alias("degree"))
    wanted = nodes.join(degree, "nid").select("nid", F.col("at.row_id").alias("want_id"), F.col("at.row_hash").alias("want_hash"))
    again = rows.join(wanted, rows["row_hash"].eqNullSafe(F.col("want_hash")) & rows["row_id"].eqNullSafe(F.col("want_id")))
    sets = cut(again.dropDuplicates(["nid"]).select("nid", "raw").mapInArrow(_sets(words), "nid long, items array<long>"), "sets")
    ordered = cut(members.drop("size").join(degree, "nid"), "buckets")
    drop(members)
    members = ordered

    # first, every node against one pivot: the best of its buckets' heads
    heads = cut(members.groupBy("bucket").agg(F.max(F.struct("degree", (-F.col("nid")).alias("minus"))).alias("head")), "heads")
    best = members.join(heads, "bucket").groupBy("nid").agg((-F.max("head")["minus"]).alias("b"))
    tried = cut(best.where("nid <> b").select(F.col("nid").alias("a"), "b"), "pairs")
    links = cut(_verified(tried, sets, percent), "links")
    labels = cut(components(links), "labels")
    # in what is left, pairs with rare elements in common are found by these; others can have no more in common than the rest
    still, split = _open(members, labels)
    still = cut(still.select("nid", "label").distinct(), "open")
    drop(split)
    bounds, pairs, rare = _rare(sets, still.select("nid"), few)
    scratch += [bounds, rare]
    known = bounds.join(still, "nid")
    for side in ("a", "b"):
        pairs = pairs.join(known.select(F.col("nid").alias(side), F.col("size").alias(f"n_{side}"), F.col("m").alias(f"m_{side}"), F.col("label").alias(f"label_{side}")), side)
    most = F.col("common") + F.least("m_a", "m_b")
    pairs = pairs.where((F.col("label_a") != F.col("label_b")) & (100 * most >= percent * (F.col("n_a") + F.col("n_b") - most))).select("a", "b")
    pairs = cut(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
    links = cut(links.unionByName(_verified(pairs, sets, percent)), "links")
    labels = cut(components(links), "labels")
    drawn = F.pmod(F.xxhash64("bucket", "nid"), F.lit(DRAWS)).alias("draw")
    members = members.join(bounds.drop("size"), "nid").where(100 * F.col("m") >= percent * F.col("n"))
    members = cut(members.select("bucket", "nid", drawn, "n", "m", *(f"p{i}" for i in range(PARITY))), "buckets")
    # then buckets with nodes of different components, until they agree or all of their nodes have been pivots
    low, high = 0, 4
    while True:
        opened, split = _open(members, labels)
        opened = cut(opened.where(f"size > {low}"), "open")
        drop(split)
        if opened.isEmpty():
            drop(opened)
            break
        drawn = F.col("draw") * F.col("size")
        pivot = opened.where((drawn >= F.lit(low * DRAWS)) & (drawn < F.lit(high * DRAWS)))
        pivot = pivot.select("bucket", F.col("nid").alias("b"), *(F.col(c).alias(f"{c}_b") for c in ("draw", "n", "m", "label", *(f"p{i}" for i in range(PARITY)))))
        most = _most("", "_b")
        later = (F.col("draw") > F.col("draw_b")) | ((F.col("draw") == F.col("draw_b")) & (F.col("nid") > F.col("b")))
        near = later & (F.col("label") != F.col("label_b")) & (100 * most >= percent * (F.col("n") + F.col("n_b") - most))
        pairs = opened.join(pivot, "bucket").where(near).select(F.col("nid").alias("a"), "b").distinct()
        pairs = cut(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        more = cut(_verified(pairs, sets, percent), "links")
        tried = tried.unionByName(pairs)
        if not more.isEmpty():
            links = cut(links.unionByName(more), "links")
            labels = cut(components(links), "labels")
        drop(opened)
        low, high = high, 4 * high
    held = nodes.select("k1", "k2", "nid", "first_id").join(labels.withColumnRenamed("node", "nid"), "nid", "left").withColumn("label", F.coalesce("label", "nid"))
    smallest = cut(held.groupBy("label").agg(F.min("first_id").alias("component_id")), "smallest")
    held = held.join(smallest, "label").select("k1", "k2", "component_id")
    out = signed.select("row_id", "row_hash", "n", "k1", "k2").join(held, ["k1", "k2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("row_id"))
    out = out.select(F.col("row_id").alias("doc_id"), "row_hash", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("row_id").eqNullSafe(component).alias("kept"))
    out = write(out, "near-duplicates")
    drop(*scratch)
    return out


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that near_duplicates() keeps, with all their columns."""
    kept = near_duplicates(docs, words, percent, id_col, text_col).where("kept").select("doc_id", "row_hash").distinct()
    rows = docs.select(whole_row(docs).alias("row"), column(id_col).alias("id"), F.xxhash64(column(text_col)).alias("hash"))
    same: Column = rows["id"].eqNullSafe(kept["doc_id"]) & (rows["hash"] == kept["row_hash"])
    return rows.join(kept, same, "left_semi").select("row.*")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=2)
    return out.drop("row_hash")
