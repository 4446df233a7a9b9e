"""Document quality from a linear-chain conditional random field over lines.

Every line of a document is labelled good or bad. Its features are shares of kinds of characters, word
lengths and repetitions, those of the lines before and after, and its place; transitions couple
neighbouring lines. Forward-backward gives each line's marginal probability of being good; their mean,
weighted by the lines' lengths, is the document's quality, calibrated into a probability.

Labels exist for documents only, so the lines' labels are latent. They start as their document's label.
Then, in rounds, each document's lines get the field's own marginals, shifted by a bias so that their
weighted mean agrees with the document's label: at least ``least`` where it is good, at most ``most`` where it is bad (posterior
regularisation). So a good document may hold a few bad lines and a bad one good lines, and transitions
learn from labels that change within documents.

Training uses a bounded sample of labelled documents: about ``sample`` rows, dealt by a hash of the id, and
of each of them at most ``train_lines`` neighbouring lines, from a place that a hash of the text tells.
Scoring reads every whole text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import IS_SPACE, mix, remainder, share, text_of, unfold

_UPPER, _LOWER, _DIGIT, _SPACE, _MARK, _SIGN, _WIDE, _ODD = range(8)
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = _UPPER, _LOWER, _DIGIT, _WIDE
_KIND[IS_SPACE] = _SPACE
_KIND[[ord(c) for c in ".,;:'\"-()?"]] = _MARK
_KIND[:32][_KIND[:32] == _SIGN] = _ODD
OWN = 16
FEATURES = 3 * OWN + 4


def line_features(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features (lines x FEATURES) and lengths of a text's lines that aren't blank; an empty text has one line of length 1."""
    b = np.frombuffer(raw, np.uint8)
    ends = np.append(np.flatnonzero(b == 10), len(b))
    starts = np.append(0, ends[:-1] + 1)
    kind = _KIND[b]
    solid = kind != _SPACE
    if len(b):
        sums = np.concatenate([[0], np.cumsum(solid)])
        full = sums[ends] > sums[starts]
        starts, ends = starts[full], ends[full]
    if not len(b) or not len(starts):
        return np.zeros((1, FEATURES), np.float32), np.ones(1)
    n = len(starts)
    line = np.repeat(np.arange(n), ends - starts)
    at = np.concatenate([np.arange(s, e) for s, e in zip(starts, ends, strict=True)]) if n > 1 else np.arange(starts[0], ends[0])
    kinds = np.bincount(line * 8 + kind[at], minlength=8 * n).reshape(n, 8)
    size = (ends - starts).astype(float)
    ink = np.maximum(size - kinds[:, _SPACE], 1)
    # words, by a hash that ignores the order of letters: enough to see repetitions
    begin = np.flatnonzero(solid & ~np.concatenate([[False], solid[:-1]]))
    stop = np.flatnonzero(solid & ~np.concatenate([solid[1:], [False]])) + 1
    of = np.searchsorted(starts, begin, "right") - 1
    codes = np.where(solid, mix(b.astype(np.uint64) + np.uint64(1)), np.uint64(0))
    word = np.add.reduceat(codes, begin)
    words = np.maximum(np.bincount(of, minlength=n), 1)
    same = np.concatenate([[False], (word[1:] == word[:-1]) & (of[1:] == of[:-1])])
    order = np.lexsort((word, of))
    fresh = np.concatenate([[True], (word[order][1:] != word[order][:-1]) | (of[order][1:] != of[order][:-1])])
    unique = np.bincount(of[order], weights=fresh, minlength=n)
    signs = np.bincount(of, weights=_KIND[b[stop - 1]] == _SIGN, minlength=n)
    only = np.bincount(of, weights=((stop - begin) == 1) & (_KIND[b[begin]] == _SIGN), minlength=n)
    length = np.bincount(of, weights=np.minimum(stop - begin, 200), minlength=n) / words
    letters = kinds[:, _UPPER] + kinds[:, _LOWER] + kinds[:, _WIDE]
    own = np.column_stack([
        np.log1p(size) / 5, np.log1p(words) / 4, kinds[:, _UPPER] / ink, kinds[:, _LOWER] / ink, kinds[:, _DIGIT] / ink, kinds[:, _MARK] / ink, kinds[:, _SIGN] / ink, kinds[:, _ODD] / ink,
        kinds[:, _UPPER] / np.maximum(letters, 1), same.size and np.bincount(of, weights=same, minlength=n) / words, unique / words, signs / words, only / words, np.minimum(length, 30) / 10, np.minimum(np.log1p(words / np.maximum(unique, 1)), 3), _KIND[b[ends - 1]] == _MARK,
    ]).astype(np.float32)
    edge = np.zeros((1, OWN), np.float32)
    place = np.zeros((n, 4), np.float32)
    place[:, 0], place[0, 1], place[-1, 2], place[:, 3] = 1, 1, 1, np.log1p(n) / 5
    return np.hstack([own, np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge]), place]), size


def _pad(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents by falling number of lines, and how many of them have a t-th line."""
    order = np.argsort(-sizes, kind="stable")
    return order, np.searchsorted(-sizes[order], -np.arange(1, sizes.max() + 1), "right")


class Field:
    """States 0 (bad) and 1 (good). Unary score of good over bad: x @ w; pair: trans[s, t]."""

    def __init__(self, w: np.ndarray, trans: np.ndarray, mean: np.ndarray, std: np.ndarray, line: tuple[float, float] = (0.0, 1.0)):
        self.w, self.trans, self.mean, self.std, self.line = w, trans, mean, std, line

    def marginals(self, unary: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Each line's probability of good, expected transitions, log-partition; unary holds the documents' lines one after another."""
        at = np.cumsum(sizes) - sizes
        order, active = _pad(sizes)
        first = at[order]
        score = np.column_stack([np.zeros_like(unary), unary])
        fore, back = np.zeros((len(unary), 2)), np.zeros((len(unary), 2))
        t_exp = self.trans
        for t, n in enumerate(active):
            i = first[:n] + t
            fore[i] = score[i] + (np.logaddexp(fore[i - 1, 0, None] + t_exp[0], fore[i - 1, 1, None] + t_exp[1]) if t else 0)
        last = at + sizes - 1
        log_z = np.logaddexp(fore[last, 0], fore[last, 1])
        for t in range(len(active) - 2, -1, -1):
            i = first[: active[t + 1]] + t
            nxt = score[i + 1] + back[i + 1]
            back[i] = np.logaddexp(t_exp[:, 0] + nxt[:, 0, None], t_exp[:, 1] + nxt[:, 1, None])
        z = np.repeat(log_z, sizes)
        good = np.exp(np.minimum(0, fore[:, 1] + back[:, 1] - z))
        inner = np.ones(len(unary), bool)
        inner[at] = False
        j = np.flatnonzero(inner)
        nxt = score[j] + back[j]
        pairs = np.exp(fore[j - 1][:, :, None] + t_exp + nxt[:, None, :] - z[j][:, None, None]).sum(0) if len(j) else np.zeros((2, 2))
        return good, pairs, float(log_z.sum())

    def quality(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Length-weighted mean of the lines' marginals, for each document."""
        if not docs:
            return np.zeros(0)
        sizes = np.array([len(x[1]) for x in docs])
        x = (np.concatenate([x[0] for x in docs]) - self.mean) / self.std
        good, _, _ = self.marginals((x @ self.w).astype(float), sizes)
        weight = np.concatenate([x[1] for x in docs])
        at = np.cumsum(sizes) - sizes
        return np.add.reduceat(good * weight, at) / np.add.reduceat(weight, at)

    def score(self, quality: np.ndarray) -> np.ndarray:
        a, b = self.line
        return 1 / (1 + np.exp(-np.clip(a + b * _logit(quality), -30, 30)))


def _logit(q: np.ndarray) -> np.ndarray:
    q = np.clip(q, 1e-4, 1 - 1e-4)
    return np.log(q / (1 - q))


def train(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = 80, rounds: int = 3, ridge: float = 1e-3, least: float = 0.9, most: float = 0.5) -> Field:
    """Gradient ascent (Adam) on the expected log-likelihood of the lines' labels, each document with the same weight."""
    x = np.concatenate([d[0] for d in docs]).astype(float)
    mean, std = x.mean(0), x.std(0)
    mean[-4], std[std < 1e-6], std[-4] = 0, 1, 1
    x = (x - mean) / std
    sizes = np.array([len(d[1]) for d in docs])
    weight = np.concatenate([d[1] for d in docs])
    each = np.repeat(1 / sizes, sizes)
    y = np.repeat(labels.astype(float), sizes)
    first = np.zeros(len(y), bool)
    first[np.cumsum(sizes) - sizes] = True
    pairs_y = np.diag([(~first & (y == v)).sum() for v in (0, 1)]).astype(float)
    n_inner = max(1, (~first).sum())
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        field = Field(theta[:-4], theta[-4:].reshape(2, 2), mean, std)
        unary = x @ field.w
        if step > steps // 2 and (step - 1) % max(1, steps // (2 * rounds)) == 0:
            y, pairs_y = agreeing(field, unary, sizes, weight, labels, least, most)
        good, pairs, _ = field.marginals(unary, sizes)
        grad = np.concatenate([x.T @ ((y - good) * each) / len(docs), ((pairs_y - pairs) / n_inner).ravel()]) - ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    field = Field(theta[:-4].astype(np.float32), theta[-4:].reshape(2, 2), mean.astype(np.float32), std.astype(np.float32))
    return Field(field.w, field.trans, field.mean, field.std, _calibrate(_logit(field.quality(docs)), labels.astype(float)))


def agreeing(field: Field, unary: np.ndarray, sizes: np.ndarray, weight: np.ndarray, labels: np.ndarray, least: float, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Lines' marginals and expected transitions under the smallest bias of each document with which its
    weighted mean agrees with its label, found by bisection."""
    at = np.cumsum(sizes) - sizes
    total = np.add.reduceat(weight, at)
    sign = np.where(labels == 1, 1.0, -1.0)
    bound = np.where(labels == 1, least, most)

    def enough(bias: np.ndarray) -> np.ndarray:
        good = field.marginals(unary + np.repeat(sign * bias, sizes), sizes)[0]
        return sign * (np.add.reduceat(good * weight, at) / total - bound) >= 0

    low, high = np.zeros(len(sizes)), np.where(enough(np.zeros(len(sizes))), 0.0, 16.0)
    for _ in range(8):
        middle = (low + high) / 2
        ok = enough(middle)
        low, high = np.where(ok, low, middle), np.where(ok, middle, high)
    good, pairs, _ = field.marginals(unary + np.repeat(sign * high, sizes), sizes)
    return good, pairs


def _calibrate(z: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Logistic regression of y on z by Newton's method."""
    x, c = np.column_stack([np.ones_like(z), z]), np.array([0.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        grad = x.T @ (y - p) - ridge * (c - [0, 1])
        c = c + np.clip(np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(2), grad), -1, 1)
    return float(c[0]), max(1e-3, float(c[1]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 6000, train_lines: int = 64) -> Field:
    """Learn from labelled documents whose crc32(id) mod 5 isn't 0; sample and train_lines bound what the driver gets (about 80 MB).

    Where a document has several labels the smallest counts. Without labels of both kinds every text scores the share of label 1.
    """
    known = labels.where(F.col(label_col).isNotNull() & (remainder(id_col, 5) != 0)).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("y"))
    n = known.count()
    known = known.where(share(F.col("id"), min(1.0, sample / max(n, 1))))
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("raw")).join(F.broadcast(known), "id")  # about sample rows of 12 bytes

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ys, xs, ls = [], [], []
            for y, raw in zip(batch["y"].to_pylist(), batch["raw"].to_pylist(), strict=True):
                x, size = line_features(raw)
                a = zlib.crc32(raw) % max(1, len(size) - train_lines + 1)
                ys.append(y), xs.append(x[a : a + train_lines].tobytes()), ls.append(size[a : a + train_lines].tobytes())
            yield pa.record_batch({"y": pa.array(ys, pa.int32()), "x": pa.array(xs, pa.binary()), "size": pa.array(ls, pa.binary())})

    got = rows.select(F.col("y").cast("int"), "raw").mapInArrow(features, "y int, x binary, size binary").toArrow()
    y = np.array(got["y"].to_pylist(), int)
    if not len(y) or y.min() == y.max():
        rate = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
        return Field(np.zeros(FEATURES, np.float32), np.zeros((2, 2)), np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32), (float(_logit(rate)), 0.0))
    read = [(np.frombuffer(x, np.float32).reshape(-1, FEATURES), np.frombuffer(s)) for x, s in zip(got["x"].to_pylist(), got["size"].to_pylist(), strict=True)]
    order = sorted(range(len(read)), key=lambda i: (int(y[i]), got["x"][i].as_py()))  # whatever order the rows came in
    return train([read[i] for i in order], y[order])


def quality_score(docs: DataFrame, field: Field, text_col: str = "text") -> Column:
    """The score of docs' texts as a column: only texts travel to Python, and only numbers back."""
    held = docs.sparkSession.sparkContext.broadcast(field)

    @F.arrow_udf("double")
    def score(raws: pa.Array) -> pa.Array:
        f = held.value
        parts, lot, lines = [], [], 0
        for raw in raws:
            lot.append(line_features(raw.as_py()))
            lines += len(lot[-1][1])
            if lines > 10_000:
                parts.append(f.quality(lot))
                lot, lines = [], 0
        return pa.array(f.score(np.concatenate([*parts, f.quality(lot)])))

    return score(text_of(text_col))


def score_quality(docs: DataFrame, field: Field, keep: list[Column], text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The columns keep, score (0 to 1) and predicted (1 if score >= threshold) of every row.

    * A null or empty text, or one of blank lines, counts as one empty line. Texts of any length are scored whole.
    * Repeated rows give equal results; ids may be null; an empty table gives an empty result.
    * A column of keep called score or predicted is replaced; other names don't matter.
    """
    rows = docs.select(F.struct(*keep).alias("kept"), quality_score(docs, field, text_col).alias("score"))
    return unfold(rows.withColumn("predicted", (F.col("score") >= threshold).cast("int")), "kept", ["score", "predicted"])


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    field = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, field, [F.col("doc_id"), F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")])
