"""Packing documents into sequences by order-preserving dynamic programming.

The documents' tokens, in the order in which the table is scanned, are one stream. Sequences are cut
from it at the ends of documents (free), the ends of sentences (a small penalty) or, where a sentence is
long, after every ``grid``-th of its tokens (a higher penalty). Among all such cuts with sequences of at most ``limit`` tokens,
dynamic programming finds those with the least padding plus penalties. With f(j) the least cost of a
stream that is cut at j,

    f(j) = penalty(j) + min over limit >= j - i > 0 of f(i) + limit - (j - i)

is a sliding-window minimum of f(i) + i, which a monotone queue gives in amortised constant time.
A stretch whose length is a power of two isn't padded, so what is left at the end of a stream is cut
into powers of two.

Streams are the input partitions, so nothing is shuffled. A stream is solved in sections; the last
sequences of a section, which more tokens might change, are solved again with the next one, so memory is
bounded by a section and the longest text. A task that runs again gives the same sequences.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, unfold

END = 1


class WordTokenizer:
    """Ids of texts, by a tokenizer whose tokens never span white space: a word is encoded once and kept.

    Texts are split and their distinct words found by Arrow, a few megabytes at a time, so that only
    distinct words are looked up. The store holds the bytes of their ids in two generations of about ``most`` bytes each:
    when the young one is full it becomes the old one, from which words that turn up again are taken over.
    Texts that hold a special token's string are encoded as a whole.
    """

    def __init__(self, file: str, most: int = 64 << 20, slice_bytes: int = 8 << 20):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.most, self.slice_bytes, self.bytes, self.known, self.older = most, slice_bytes, 0, {}, {}
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join(["[\x1c-\x1f]", *special])  # Arrow takes these characters for white space; the tokenizer doesn't
        ends = re.compile(r"[.!?。！？…]+(</w>)?")
        vocabulary = self.tokenizer.get_vocab()
        self.stop = np.zeros(max(vocabulary.values()) + 2, np.int8)
        for token, i in vocabulary.items():
            if ends.fullmatch(token):
                self.stop[i] = 1

    def encode(self, texts: pa.StringArray) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        end = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(end, (end[lo - 1] if lo else 0) + self.slice_bytes, "right")))
            yield from self._encode(texts.slice(lo, hi - lo))
            lo = hi

    def _encode(self, texts: pa.StringArray) -> Iterator[np.ndarray]:
        odd = pc.match_substring_regex(texts, self.odd)
        lists = pc.utf8_split_whitespace(pc.if_else(odd, "", texts))
        words = lists.flatten().dictionary_encode()
        ids, size = self._ids(words.dictionary.to_pylist())
        code = words.indices.to_numpy()
        many = size[code]
        ends = np.concatenate([[0], np.cumsum(many)])
        begin = np.cumsum(size) - size
        every = ids[np.arange(ends[-1], dtype=np.int32) + np.repeat((begin[code] - ends[:-1]).astype(np.int32), many)]
        last = ends[np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])].tolist()
        for i, whole in enumerate(odd.to_pylist()):
            yield np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32) if whole else every[last[i] : last[i + 1]]

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, one after another, and how many each has."""
        if self.bytes > self.most:
            self.older, self.known, self.bytes = self.known, {}, 0
        found = list(map(self.known.get, words))
        if None in found:
            new = [w for w, x in zip(words, found, strict=True) if x is None]
            old = list(map(self.older.get, new))
            learned = iter(self._learn([w for w, x in zip(new, old, strict=True) if x is None]))
            got = [next(learned) if x is None else x for x in old]
            self.known.update(zip(new, got, strict=True))
            self.bytes += len("".join(new)) + len(b"".join(got)) + 180 * len(new)  # with what Python adds to each
            more = iter(got)
            found = [next(more) if x is None else x for x in found]
        return np.frombuffer(b"".join(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found)) // 4

    def _learn(self, words: list[str]) -> list[bytes]:
        """Encode words, many in one call; each token goes to the word in which it begins."""
        out: list[bytes] = []
        for lo in range(0, len(words), 256):  # longer texts take the tokenizer more time a word
            part = words[lo : lo + 256]
            e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            starts = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            cuts = (4 * np.searchsorted(np.fromiter((a for a, _ in e.offsets), np.int64, len(e)), starts)).tolist()
            ids = np.array(e.ids, np.uint32).tobytes()
            out.extend(map(ids.__getitem__, map(slice, [0, *cuts], cuts)))
        return out


_tokenizers: dict[tuple, WordTokenizer] = {}


def word_tokenizer(file: str, store: int) -> WordTokenizer:
    """This process's tokenizer; Python workers keep it, with the words it knows, from task to task."""
    if (file, store) not in _tokenizers:
        _tokenizers[file, store] = WordTokenizer(file, store, max(1 << 16, store // 8))
    return _tokenizers[file, store]


def best_cuts(ends: np.ndarray, cost: np.ndarray, limit: int, final: bool, hard: float) -> list[int]:
    """Cuts (positions in the stream, rising) of least padding plus penalty.

    ends: rising candidate positions > 0 no more than limit apart, the last one the end of the stream; cost:
    their penalties. With final the rest after the last full choice is free to be cut into powers of two.
    """
    f, back = [0.0], [0]
    at = [0, *ends.tolist()]
    pay = [0.0, *cost.tolist()]
    queue: deque[int] = deque([0])
    for j in range(1, len(at)):
        here = at[j]
        while at[queue[0]] < here - limit:
            queue.popleft()
        i = queue[0]
        value = f[i] + at[i] + limit - here + pay[j]
        if final and j == len(at) - 1:  # the last sequence may be split into powers of two
            for i2 in queue:
                parts = bin(here - at[i2]).count("1")
                if (v := f[i2] + min(limit - (here - at[i2]), (parts - 1) * hard)) < value:
                    value, i = v, i2
        f.append(value)
        back.append(i)
        key = value + here
        while queue and f[queue[-1]] + at[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(at[j])
        j = back[j]
    cuts.reverse()
    if final:
        start, end = (cuts[-2] if len(cuts) > 1 else 0), cuts[-1]
        length = end - start
        if (bin(length).count("1") - 1) * hard < limit - length:
            cuts.pop()
            for k in range(limit.bit_length() - 1, -1, -1):
                if length >> k & 1:
                    start += 1 << k
                    cuts.append(start)
    return cuts


class Packer:
    """Takes documents one by one; gives pieces (document's place in the stream, start, length, crc, sequence, offset)."""

    def __init__(self, limit: int, grid: int, sentence: float, hard: float, section: int):
        self.limit, self.grid, self.sentence, self.hard, self.section = limit, grid, sentence, hard, section
        self.docs: deque[tuple[object, int, np.ndarray, np.ndarray]] = deque()  # what is it, start, ids, is a sentence's end
        self.size, self.sequence = 0, 0

    def add(self, what: object, ids: np.ndarray, stop: np.ndarray) -> Iterator[tuple]:
        for a in range(0, len(ids), self.section):
            part = slice(a, a + self.section)
            self.docs.append((what, a, ids[part], stop[part]))
            self.size += len(ids[part])
            if self.size >= self.section + 8 * self.limit:
                yield from self.cut(False)

    def cut(self, final: bool) -> Iterator[tuple]:
        if not self.size:
            return
        stop = np.concatenate([x[3] for x in self.docs])
        pay = np.full(self.size, np.inf)
        at = np.arange(1, self.size + 1)
        since = at - np.maximum.accumulate(np.where(stop > 0, at, 0))  # tokens after the last boundary
        pay[(since > 0) & (since % self.grid == 0)] = self.hard
        pay[stop == 1] = self.sentence
        pay[stop == 2] = 0
        pay[-1] = 0
        spot = np.flatnonzero(np.isfinite(pay))
        cuts = best_cuts(spot + 1, pay[spot], self.limit, final, self.hard)
        if not final:
            cuts = [c for c in cuts if c <= self.size - 4 * self.limit]
        done = 0
        for c in cuts:
            offset = 0
            while done < c:
                what, start, ids, stop = self.docs[0]
                n = min(len(ids), c - done)
                yield what, start, n, zlib.crc32(ids[:n].astype("<u4").tobytes()), self.sequence, offset
                offset += n
                done += n
                self.docs.popleft()
                if n < len(ids):
                    self.docs.appendleft((what, start + n, ids[n:], stop[n:]))
            self.sequence += 1
        self.size -= done


def pack(docs: DataFrame, tokenizer: str, keep: list[Column], text_col: str = "text", limit: int = 2048, grid: int = 64, sentence: float = 4.0, hard: float = 32.0, section: int = 1 << 16, store: int = 64 << 20) -> DataFrame:
    """One row for each piece: the columns keep of its document, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    tokenizer: path of the tokenizer's file, the same on all machines. limit: a power of two. store: bytes of a generation
    of the word store; a worker holds two. A smaller one costs time, as words are encoded again, but changes no result.

    * A null or empty text is the one id 1, as every document ends with that id. Texts of any length are cut like others.
    * Special tokens' strings in a text have the ids that the tokenizer gives them.
    * Repeated rows are documents of their own; ids may be null; a table without rows gives no pieces.
    * A column of keep that has a result column's name is replaced by it; other names don't matter.
    * Sequence ids are unique; those of an input partition rise from its number times 2**32.
    """
    if limit & (limit - 1):
        raise ValueError("limit must be a power of two")
    rows = docs.select(F.struct(*keep).alias("kept"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    numbers = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    out = rows.select("kept").schema
    for name in numbers:
        out = out.add(name, "long", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer, store)
        packer = Packer(limit, grid, sentence, hard, section)
        first = TaskContext.get().partitionId() << 32
        got: list[tuple] = []

        def flush() -> pa.RecordBatch:
            kept = pa.concat_arrays([x[0][0].slice(x[0][1], 1) for x in got])
            values = [[x[1] for x in got], [x[2] for x in got], [x[3] for x in got], [x[0][2] for x in got], [first + x[4] for x in got], [x[5] for x in got]]
            got.clear()
            return pa.RecordBatch.from_arrays([kept, *[pa.array(v, pa.int64()) for v in values]], names=["kept", *numbers])

        for batch in batches:
            kept = batch.column(0).take(pa.array(np.arange(batch.num_rows)))  # a copy, so that the texts can go
            for i, ids in enumerate(words.encode(batch.column(1))):
                ids = np.append(ids, np.uint32(END))
                stop = words.stop[ids]
                stop[-1] = 2
                got.extend(packer.add((kept, i, len(ids)), ids, stop))
                if len(got) >= 5000:
                    yield flush()
        got.extend(packer.cut(True))
        if got:
            yield flush()

    return unfold(rows.mapInArrow(run, out), "kept", numbers)


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_file(), [F.col("doc_id")])
