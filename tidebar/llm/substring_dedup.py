"""Repeated passages by prefix-partitioned suffix trees, cut off at the depth of a window.

A suffix begins at each word. Only its first ``window`` words matter: the nodes at that depth of the
suffix tree of all documents are the distinct windows, those with suffixes of several documents are its
deep internal nodes, and runs of them along a document are the maximal repeats. The tree is never built
in one place:

1.  Candidates. Windows are sampled by their smallest ``seed``-word hash, which equal windows share and
    neighbouring windows mostly share too, so runs of windows become one row. Seeds that occur in one
    document only can't lie in a repeat between documents; the others leave the candidate suffixes.
2.  Prefixes of variable length deal the candidate suffixes out in groups of at most ``group`` suffixes. The seed,
    which lies in the first ``window`` words of each suffix, is the shortest one. Where more suffixes share it, they are
    dealt by their first ``longer`` words, and where more share these, by all ``window`` words. A million suffixes take
    about 100 MB.
3.  Subtrees. A group fits in memory. Its suffixes, as words, grow a tree from the group's prefix down, a few words a level:
    children are told apart by the words themselves, not by hashes, and only internal nodes with leaves of several
    documents grow on. Suffixes at depth ``window`` whose node has a smaller document are removable. Where
    the prefix is all of the window the subtree is a single node, and its smallest document is aggregated
    before the shuffle: a passage in a third of all documents is one row for each window and task.
4.  Repeats. Removable suffixes return to their document as ranges, and the text is cut.

The tables between these steps lie in the shared folder, so that a lost executor repeats one step's tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, cut, drop, mix, text_of, whole_groups, word_hashes, word_starts


def _sequence_hash(w: np.ndarray, n: int, factor: int) -> np.ndarray:
    """Hashes of all runs of n words."""
    h = np.zeros(len(w) - n + 1, np.uint64)
    for j in range(n):
        h = h * np.uint64(factor) + w[j : len(w) - n + 1 + j]
    return mix(h)


def seeds(w: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with the same smallest seed: its hash, the run's first window, how many."""
    if len(w) < window:
        return (np.zeros(0, np.uint64),) * 3
    h = _sequence_hash(w, seed, 0x9FB21C651E98DF25)
    low = h[: len(w) - window + 1].copy()
    for j in range(1, window - seed + 1):
        np.minimum(low, h[j : len(w) - window + 1 + j], out=low)
    first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    return low[first], first, np.diff(first, append=len(low))


def covered(first: np.ndarray, many: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of n words are covered by windows that start at first, first + 1, ..., first + many - 1."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, first + many - 1 + window, -1)
    return np.cumsum(step[:-1]) > 0


def deep_suffixes(words: np.ndarray, at: np.ndarray, group: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """Which suffixes lie below a node at depth window that has a smaller document.

    words: codes of words (equal codes, equal words); at: where in words each suffix begins; group: the
    subtree that it belongs to; doc: its document.
    """
    out = np.zeros(len(at), bool)
    live, node = np.arange(len(at)), np.unique(group, return_inverse=True)[1].astype(np.int64)
    base = int(words.max()) + 1 if len(words) else 1
    depth = 0
    while depth < window and len(live):
        key, nodes = node, int(node.max()) + 1
        while True:  # as many words as a key of 62 bits takes
            key, nodes, depth = key * base + words[at[live] + depth], nodes * base, depth + 1
            if depth == window or nodes * base >= 1 << 62:
                break
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
        count = np.diff(first, append=len(order))
        least, most = np.minimum.reduceat(doc[live][order], first), np.maximum.reduceat(doc[live][order], first)
        inner = np.repeat(least < most, count)  # leaves and nodes of one document end here
        node, least = np.repeat(np.arange(len(first)), count)[inner], np.repeat(least, count)[inner]
        live = live[order][inner]
        if depth == window:
            out[live] = doc[live] > least
    return out


def repeated_windows(docs: DataFrame, window: int = 13, seed: int = 5, longer: int = 9, group: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, hash, ranges): for each document the windows that also start in a document with a smaller id, as (first, n).

    hash is that of the text, so that rows that share an id but not a text stay apart.
    """
    if not 0 < seed <= longer <= window:
        raise ValueError("a seed is 1 to window words long, a longer prefix between them")
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.where(column(id_col).isNotNull() & column(text_col).isNotNull()).select(column(id_col).alias("id"), F.xxhash64(column(text_col)).alias("hash"), text_of(text_col).alias("raw"))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [seeds(word_hashes(np.frombuffer(raw.as_py(), np.uint8)), window, seed) for raw in batch.column(2)]
            of = np.repeat(np.arange(len(found)), [len(x[0]) for x in found])
            many = [np.concatenate([np.zeros(0, np.uint64), *[x[k] for x in found]]) for k in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(many[0].astype(np.uint64).view(np.int64)), batch.column(0).take(pa.array(of)), batch.column(1).take(pa.array(of)), pa.array(many[1].astype(np.int32)), pa.array(many[2].astype(np.int32))], names=["seed", "id", "hash", "first", "n"])

    runs = cut(texts.mapInArrow(sample, f"seed long, id {kind}, hash long, first int, n int"), "seeds")
    shared = runs.groupBy("seed").agg(F.min("id").alias("x"), F.max("id").alias("y"), F.sum("n").alias("suffixes")).where("x < y")
    shared = cut(shared.select("seed", (F.col("suffixes") > group).alias("long")), "shared")
    # a set: rows that repeat an id and a text have their places once
    places = runs.join(shared, "seed").groupBy("id", "hash").agg(F.collect_set(F.struct("first", "n", "seed", "long")).alias("places"))
    places = cut(places, "places")
    drop(runs, shared)

    def suffixes(long: bool):
        """(id, hash, raw, places) to runs of suffixes with their words; of long seeds each suffix with the hash of its longer prefix."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo in range(0, batch.num_rows, 256):  # bounded rows at a time
                    yield part(batch.slice(lo, 256))

        def part(batch: pa.RecordBatch) -> pa.RecordBatch:
            prefix, of, first, many, words = [], [], [], [], []
            for i, raw in enumerate(batch.column(2)):
                place = batch.column(3)[i].values
                f, n = place.field("first").to_numpy(), place.field("n").to_numpy()
                if long:
                    raw, key = raw.as_py(), place.field("seed").to_numpy()
                    w = word_hashes(np.frombuffer(raw, np.uint8))
                    p = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(f, n)
                    prefix.append(mix(_sequence_hash(w, longer, 0x9FB21C651E98DF25)[p] ^ np.repeat(key, n).view(np.uint64)).view(np.int64))
                    each = raw.split()  # of bytes: at the white space of ASCII only
                    words.extend(b" ".join(each[x : x + window]) for x in p.tolist())
                    f, n = p, np.ones(len(p), np.int64)
                else:
                    raw = raw.as_py()
                    begin, end = word_starts(np.frombuffer(raw, np.uint8))
                    prefix.append(place.field("seed").to_numpy())
                    words.extend(map(raw.__getitem__, map(slice, begin[f].tolist(), end[f + n + window - 2].tolist())))
                of.append(np.full(len(f), i)), first.append(f), many.append(n)
            of = pa.array(np.concatenate([np.zeros(0, np.int64), *of]).astype(np.int64))
            numbers = [pa.array(np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int32)) for x in (first, many)]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *prefix]).astype(np.int64)), batch.column(0).take(of), batch.column(1).take(of), *numbers, pa.array(words, pa.binary())], names=["prefix", "id", "hash", "first", "n", "words"])

        return run

    def subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by prefix to ranges of removable suffixes."""
        for batch in whole_groups(batches, "prefix"):
            n, first = batch["n"].to_numpy().astype(np.int64), batch["first"].to_numpy()
            row = np.repeat(np.arange(batch.num_rows), n)
            offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            words = pa.array(b" ".join(batch["words"].to_pylist()).split(), pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
            size = n + window - 1
            doc = np.unique(batch["id"].to_numpy(zero_copy_only=False), return_inverse=True)[1]
            gone = np.flatnonzero(deep_suffixes(words, (np.cumsum(size) - size)[row] + offset, batch["prefix"].to_numpy()[row], doc[row], window))
            head = np.flatnonzero(np.concatenate([[True], (row[gone][1:] != row[gone][:-1]) | (offset[gone][1:] != offset[gone][:-1] + 1)])) if len(gone) else gone
            of = row[gone][head]
            yield pa.RecordBatch.from_arrays([batch["id"].take(pa.array(of)), batch["hash"].take(pa.array(of)), pa.array((first[of] + offset[gone][head]).astype(np.int32)), pa.array(np.diff(head, append=len(gone)).astype(np.int32))], names=["id", "hash", "first", "n"])

    leaf, found = f"prefix long, id {kind}, hash long, first int, n int, words binary", f"id {kind}, hash long, first int, n int"
    grown = lambda rows: rows.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(subtrees, found)
    held = texts.join(places, ["id", "hash"]).dropDuplicates(["id", "hash"]).select("id", "hash", "raw", "places")
    of_kind = lambda long: held.select("id", "hash", "raw", F.filter("places", lambda x: x["long"] == long).alias("places")).where(F.size("places") > 0).mapInArrow(suffixes(long), leaf)
    tables = [grown(of_kind(False))]
    if not places.where(F.exists("places", lambda x: x["long"])).isEmpty():
        deep = cut(of_kind(True), "suffixes")
        sizes = deep.groupBy("prefix").agg(F.min("id").alias("x"), F.max("id").alias("y"), F.count(F.lit(1)).alias("suffixes")).where("x < y").select("prefix", "suffixes")
        sizes = cut(sizes, "prefixes")
        tables.append(grown(deep.join(sizes.where(F.col("suffixes") <= group), "prefix", "left_semi")))
        whole = deep.join(sizes.where(F.col("suffixes") > group), "prefix", "left_semi").select("id", "hash", "first", "n", "words")
        inner = whole.groupBy("words").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("words", "least")
        tables.append(whole.join(inner, "words").where("id > least").select("id", "hash", "first", "n"))
    else:
        deep = sizes = None
    every = tables[0]
    for table in tables[1:]:
        every = every.unionByName(table)
    out = cut(every.groupBy("id", "hash").agg(F.collect_set(F.struct("first", "n")).alias("ranges")), "repeats")
    drop(*filter(None, (places, deep, sizes)))
    return out


def remove_repeats(docs: DataFrame, window: int = 13, seed: int = 5, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, **options) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_removed, kept_sha256 and, with with_text, the kept words.

    A word goes if a window covers it whose words also start in a document with a smaller id; windows are
    judged on the input.

    * A null or empty text has no words: counts 0 and the hash of an empty text.
    * Rows without an id take no part: nothing of them is removed, and nothing because of them.
    * Repeated rows, and rows that share an id, don't count as each other's repeats; they cost no more than other rows.
    * Texts of fewer words than a window keep them all. Texts of any length are cut whole. An empty table gives an empty result.
    * Other columns are not read, so their names don't matter.
    """
    repeats = repeated_windows(docs, window, seed, id_col=id_col, text_col=text_col, **options)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(column(id_col).alias("id"), F.xxhash64(column(text_col)).alias("hash"), text_of(text_col).alias("raw"))
    rows = rows.join(repeats, ["id", "hash"], "left").select("id", "raw", "ranges")

    def trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, sha, texts = [], [], [], []
            for raw, ranges in zip(batch.column(1), batch.column(2), strict=True):
                words = raw.as_py().split()  # of bytes: at the white space of ASCII only
                n.append(len(words)), gone.append(0)
                if ranges.is_valid:
                    cover = covered(ranges.values.field("first").to_numpy(), ranges.values.field("n").to_numpy(), len(words), window)
                    gone[-1] = int(cover.sum())
                    words = [words[i] for i in np.flatnonzero(~cover)]
                kept = b" ".join(words)
                sha.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    texts.append(kept.decode())
            got = [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays([*got, *([pa.array(texts, pa.string())] if with_text else [])], names=["doc_id", "n_words", "n_removed", "kept_sha256", *(["text"] if with_text else [])])

    return rows.mapInArrow(trim, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + (", text string" if with_text else ""))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
