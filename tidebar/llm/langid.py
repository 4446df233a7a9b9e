"""Language identification as inference of a multilingual mixture.

Every learned language has a distribution over byte trigrams (lower case, within words). A word's
likelihood under a language is that of its trigrams; a document is a mixture of words from several
languages, whose proportions expectation-maximisation estimates. The document's set of languages is
selected by penalised likelihood: each language beyond the first must raise the log-likelihood by more
than half the logarithm of the number of words.

The model is fitted on a bounded sample of labelled rows (``per_lang``, about as many for each language);
predictions read every whole text. Texts are processed in slices of bounded size within Arrow batches,
so memory depends on the longest text only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, remainder, share, text_of, unfold

BUCKETS = 1 << 16
#: Bytes as the model sees them: A-Z in lower case; digits, punctuation and control characters are gaps.
_SEEN = np.full(256, 32, np.uint8)
_SEEN[97:123] = np.arange(97, 123)
_SEEN[65:91] = np.arange(97, 123)
_SEEN[128:] = np.arange(128, 256)


def _grams(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams centred on each byte of a word, in order, and whether that byte begins a word."""
    b = _SEEN[np.frombuffer(b" " + raw + b" ", np.uint8)]
    mid = np.flatnonzero(b[1:-1] != 32) + 1
    wide = b.astype(np.uint32)
    g = (wide[mid - 1] << np.uint32(16)) | (wide[mid] << np.uint32(8)) | wide[mid + 1]
    return ((g * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64), b[mid - 1] == 32


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray, smooth: float = 0.25):
        self.langs = langs
        total = counts.sum(1, keepdims=True) + smooth * BUCKETS
        self.logp = np.ascontiguousarray(np.log((counts + smooth) / total).T.astype(np.float32))

    def words(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood of every word under every language, and the number of words of each text."""
        rows, sizes = [], []
        for raw in raws:
            g, first = _grams(raw)
            sizes.append(int(first.sum()))
            if sizes[-1]:
                rows.append(np.add.reduceat(self.logp[g], np.flatnonzero(first), axis=0))
        return np.concatenate(rows) if rows else np.zeros((0, len(self.langs)), np.float32), np.array(sizes)

    def predict(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text, the main language's index (-1: no words), its proportion, the number of languages."""
        if not self.langs:
            return np.full(len(raws), -1), np.zeros(len(raws)), np.zeros(len(raws), int)
        ll, sizes = self.words(raws)
        best, score, kinds = np.full(len(raws), -1), np.zeros(len(raws)), np.zeros(len(raws), int)
        some = np.flatnonzero(sizes)
        if not len(some):
            return best, score, kinds
        sizes = sizes[some]
        top = ll.max(1)
        like = np.exp(ll - top[:, None])
        at = np.cumsum(sizes) - sizes
        base = np.add.reduceat(top, at, dtype=np.float64)
        alone = np.add.reduceat(ll, at, axis=0, dtype=np.float64)  # every word from one language
        share, total = _em(like, sizes, np.ones((len(some), len(self.langs)), bool))
        total += base
        penalty = 0.5 * np.log(sizes + 1)
        chosen = alone.argmax(1)
        won, value = np.zeros_like(share), alone.max(1)
        won[np.arange(len(some)), chosen] = 1
        proportion = np.maximum(share[np.arange(len(some)), chosen], 1e-9)
        kind = np.ones(len(some), int)
        # More languages can only help where the full mixture beats one language by the penalty of a second.
        open_ = np.flatnonzero(total - penalty > value)
        mask = np.ones((len(open_), len(self.langs)), bool)
        part, now = share[open_], total[open_]
        while len(open_):
            cost = now - penalty[open_] * (mask.sum(1) - 1)
            better = cost > value[open_]
            value[open_[better]], won[open_[better]], kind[open_[better]] = cost[better], part[better], mask[better].sum(1)
            more = mask.sum(1) > 2
            open_, mask, part = open_[more], mask[more], part[more]
            if not len(open_):
                break
            mask[np.arange(len(open_)), np.where(mask, part, 2).argmin(1)] = False
            sub = np.concatenate([like[a : a + n] for a, n in zip(at[open_], sizes[open_], strict=True)])
            part, now = _em(sub, sizes[open_], mask)
            now += base[open_]
        mixed = kind > 1
        chosen[mixed] = won[mixed].argmax(1)
        proportion[mixed] = won[mixed].max(1)
        best[some], score[some], kinds[some] = chosen, np.clip(proportion, 0, 1), kind
        return best, score, kinds


def _em(like: np.ndarray, sizes: np.ndarray, mask: np.ndarray, steps: int = 20, tol: float = 2e-3) -> tuple[np.ndarray, np.ndarray]:
    """Mixture proportions of each text over the languages in mask, and the log-likelihood; texts leave as they converge."""
    share, total = mask / mask.sum(1, keepdims=True), np.zeros(len(sizes))
    live, at = np.arange(len(sizes)), np.cumsum(sizes) - sizes
    for step in range(steps):
        p = like * np.repeat(share[live].astype(np.float32), sizes[live], axis=0)
        norm = np.maximum(p.sum(1), np.float32(1e-30))
        total[live] = np.add.reduceat(np.log(norm), at, dtype=np.float64)
        new = np.add.reduceat(p / norm[:, None], at, axis=0) / sizes[live][:, None]
        moved = np.abs(new - share[live]).max(1)
        share[live] = new
        go = moved > tol
        if not go.any() or step == steps - 1:
            break
        if not go.all():
            like, live = like[np.repeat(go, sizes[live])], live[go]
            at = np.cumsum(sizes[live]) - sizes[live]
    return share, total


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = 2000) -> Model:
    """Learn every language that rows with a text have. The sample is bounded: about per_lang rows of each language,
    dealt by a hash of the id; trigram counts are summed on the executors. The model has 256 KB for each language."""
    known = docs.select(column(id_col).alias("id"), column(text_col).alias("text"), column(lang_col).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = known.groupBy("lang").count().orderBy("lang").collect()  # a row for each language
    langs = sorted(r["lang"] for r in counts)
    if not langs:
        return Model([], np.zeros((0, BUCKETS)))
    part = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, per_lang / r["count"]))])
    rows = known.where(share(F.col("id"), F.element_at(part, F.col("lang"))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, raw in zip(batch["lang"].to_pylist(), batch["raw"].to_pylist(), strict=True):
                got = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                got += np.bincount(_grams(raw)[0], minlength=BUCKETS)
        for lang, got in sums.items():
            some = np.flatnonzero(got)
            yield pa.record_batch({"lang": pa.array([lang] * len(some), pa.string()), "bucket": pa.array(some, pa.int64()), "n": pa.array(got[some], pa.int64())})

    sums = rows.select("lang", text_of("text").alias("raw")).mapInArrow(count, "lang string, bucket long, n long")
    found = sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS rows for each language at most
    table = np.zeros((len(langs), BUCKETS))
    place = {x: i for i, x in enumerate(langs)}
    which = np.array([place[x] for x in found["lang"].to_pylist()], int)
    table[which, found["bucket"].to_numpy()] = found["n"].to_numpy()
    return Model(langs, table)


def identify(docs: DataFrame, model: Model, keep: list[Column], text_col: str = "text") -> DataFrame:
    """The columns keep of docs and lang_pred, score, n_langs for every row.

    score is the estimated proportion of the document's words that the language accounts for.

    * A text that is null, empty or has no letter (Unicode) has lang_pred ``und`` and score 0, and so has
      every text where no language was learned. Of languages that tie the first by name counts.
    * Texts of any length are read whole; memory depends on the longest one.
    * Repeated rows give equal results; ids may be null; an empty table gives an empty result.
    * A column of keep that has a result column's name is replaced by it; other names don't matter.
    """
    rows = docs.select(F.struct(*keep).alias("kept"), column(text_col).alias("text"))
    result = ["lang_pred", "score", "n_langs"]
    out = rows.select("kept").schema.add("lang_pred", "string", False).add("score", "double", False).add("n_langs", "integer", False)
    held = docs.sparkSession.sparkContext.broadcast(model)
    slice_bytes = max(1 << 16, (1 << 22) // max(1, len(model.langs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            text = batch.column(1)
            letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            raws = text.cast(pa.binary()).to_pylist()
            best, score, kinds = np.full(len(raws), -1), np.zeros(len(raws)), np.zeros(len(raws), int)
            lot: list[int] = []
            held_bytes = 0
            for i in [*np.flatnonzero(letters), -1]:
                if lot and (i < 0 or held_bytes + len(raws[i]) > slice_bytes):
                    best[lot], score[lot], kinds[lot] = m.predict([raws[j] for j in lot])
                    lot, held_bytes = [], 0
                if i >= 0:
                    lot.append(int(i))
                    held_bytes += len(raws[i])
            langs = [m.langs[k] if k >= 0 else "und" for k in best]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(score), pa.array(kinds, pa.int32())], names=["kept", *result])

    return unfold(rows.mapInArrow(run, out), "kept", result)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(remainder("doc_id", 4) != 2))
    return identify(docs, model, [F.col("doc_id"), F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")])
