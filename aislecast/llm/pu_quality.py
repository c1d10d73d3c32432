"""A quality classifier learned from trusted positives and unlabelled text.

The class prior is estimated by the best bin of a classifier of positives
against unlabelled rows: where the unlabelled share of scores above a value is
smallest against the positive share, almost only positives are left. Then a
linear model minimises the non-negative unbiased risk
    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)),
so no negative is ever needed and the estimated risk of negatives cannot fall
below zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislecast.llm import text
from aislecast.llm.blocks import bounded_batches
from aislecast.llm.common import crc_remainder
from aislecast.session import stage

# Classes of bytes whose pairs are counted: lower, upper, digit, blank, line end,
# sentence marks, symbols, other ASCII, beyond ASCII.
_CLASSES = 9


def _byte_classes() -> np.ndarray:
    out = np.full(256, 7, dtype=np.int64)
    for k, chars in enumerate((range(97, 123), range(65, 91), range(48, 58), b" \t\v\f", b"\n\r", b".,;:!?'\"", b"#*$%&|<>")):
        out[list(chars)] = k
    out[128:] = 8
    return out


CLASS = _byte_classes()


@dataclass(frozen=True)
class Quality:
    modulus: int = 5
    held_out: int = 0  # remainder of the rows whose labels are not used
    positives: int = 20_000  # rows learned from, about so many
    unlabelled: int = 40_000
    rounds: int = 400
    rate: float = 0.05
    decay: float = 1e-4
    threshold: float = 0.3


def features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of numbers per text: shares of byte-class pairs, and shapes of words and lines."""
    n = len(at) - 1
    row = np.repeat(np.arange(n), np.diff(at))
    kind = CLASS[data]
    pair = kind[:-1] * _CLASSES + kind[1:]
    inside = row[1:] == row[:-1] if len(row) else np.empty(0, bool)
    cells = np.bincount(row[:-1][inside] * _CLASSES**2 + pair[inside], minlength=n * _CLASSES**2) if len(row) else np.zeros(n * _CLASSES**2)
    pairs = np.sqrt(cells.reshape(n, -1) / np.maximum(np.diff(at) - 1, 1)[:, None])

    starts, ends, bounds = text.words(data, at)
    count = np.diff(bounds)
    of = np.repeat(np.arange(n), count)
    hashed = text.hashes(data, starts, ends)
    words = np.maximum(count, 1)
    length = np.bincount(of, ends - starts, n) / words
    echo = np.zeros(len(of))
    echo[1:] = (hashed[1:] == hashed[:-1]) & (of[1:] == of[:-1])
    distinct = np.zeros(n)
    new_grams = np.zeros(n)
    for i in range(n):
        own = hashed[bounds[i] : bounds[i + 1]]
        if len(own):
            distinct[i] = len(np.unique(own)) / len(own)
            new_grams[i] = len(text.shingles(own, 3)) / max(1, len(own) - 2)
    lines = np.bincount(row[data == 0x0A], minlength=n) + 1 if len(row) else np.ones(n)
    shapes = [
        np.log1p(count) / 10,
        np.minimum(length, 40) / 10,
        np.bincount(of, echo, n) / words,
        distinct,
        new_grams,
        np.log1p(count / lines) / 5,
        (count == 0).astype(float),
    ]
    return np.concatenate([pairs, np.stack(shapes, axis=1)], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Linear:
    """A linear model on standardised numbers, fitted by Adam."""

    def __init__(self, x: np.ndarray, p: Quality):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        self.weights, self.p = np.zeros(x.shape[1] + 1), p

    def lay(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([z, np.ones((len(x), 1))], axis=1)

    def value(self, x: np.ndarray) -> np.ndarray:
        return self.lay(x) @ self.weights

    def fit(self, gradient) -> Linear:
        m, v = np.zeros_like(self.weights), np.zeros_like(self.weights)
        for t in range(1, self.p.rounds + 1):
            g = gradient(self.weights) + self.p.decay * np.append(self.weights[:-1], 0)
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            self.weights -= self.p.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return self


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, p: Quality) -> float:
    """The share of positives among the unlabelled, by the best bin of held-back halves."""
    half = lambda x: (x[0::2], x[1::2])
    (p1, p2), (u1, u2) = half(positive), half(unlabelled)
    model = Linear(np.concatenate([p1, u1]), p)
    a, b = model.lay(p1), model.lay(u1)
    model.fit(lambda w: a.T @ (_sigmoid(a @ w) - 1) / len(a) + b.T @ _sigmoid(b @ w) / len(b))
    sp, su = np.sort(model.value(p2)), np.sort(model.value(u2))
    cuts = np.unique(np.quantile(sp, np.linspace(0.0, 0.99, 100)))
    above_p = 1 - np.searchsorted(sp, cuts) / len(sp)
    above_u = 1 - np.searchsorted(su, cuts) / len(su)
    slack = lambda n: np.sqrt(np.log(4 / 0.1) / (2 * max(1, n)))
    bound = (above_u + slack(len(su))) / np.maximum(above_p, 1e-9) + slack(len(sp)) / np.maximum(above_p, 1e-9)
    best = int(np.argmin(bound))
    return float(np.clip(above_u[best] / max(above_p[best], 1e-9), 0.05, 0.98))


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, p: Quality) -> tuple[Linear, float]:
    """The model of least non-negative risk, and the prior."""
    prior = estimate_prior(positive, unlabelled, p)
    model = Linear(unlabelled, p)
    a, b = model.lay(positive), model.lay(unlabelled)

    def gradient(w: np.ndarray) -> np.ndarray:
        fa, fb = _sigmoid(a @ w), _sigmoid(b @ w)
        low = lambda f: -np.log(np.maximum(1 - f, 1e-12))  # noqa: E731  loss of calling it negative
        negative = low(fb).mean() - prior * low(fa).mean()
        plus = prior * (a.T @ (fa - 1)) / len(a)
        minus = b.T @ fb / len(b) - prior * (a.T @ fa) / len(a)
        return plus + minus if negative >= 0 else -minus

    return model.fit(gradient), prior


def _features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in text.chunks(batch.column(1)):
                found = [row.tobytes() for row in features(data, at)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(found, pa.binary())], ["doc_id", "features"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, features binary")


def _draw(rows: DataFrame, n: int, salt: str) -> np.ndarray:
    """About n rows by a hash of the id, as an array."""
    rate = min(1.0, n / max(1, rows.count()))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 20)) / float(1 << 20)
    found = rows.filter(draw < rate).orderBy("doc_id", "features").select("features").toPandas()["features"]
    return np.stack([np.frombuffer(x, np.float32) for x in found]).astype(np.float64) if len(found) else np.empty((0, 0))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    params: Quality | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """One row per input row: doc_id, held_out, score and predicted.

    Trusted positives are rows labelled 1, the unlabelled are rows of any or no
    label; both come from rows whose crc32 of the id's text has another
    remainder than held_out, about positives and unlabelled of them. Scores
    depend on the text alone; null and empty text is a text of no words. With
    fewer than two positives or unlabelled rows every score is 0.5. Repeated
    rows get equal scores, no rows give no rows, other columns are ignored.
    """
    p = params or Quality()
    bounded_batches(docs.sparkSession)
    every = stage(_features(docs, id_col, text_col), "quality-features")
    learned = every.filter(crc_remainder("doc_id", p.modulus) != p.held_out)
    trusted = labels.filter(F.col(label_col) == 1).select("doc_id").distinct()
    positive = _draw(learned.join(trusted, "doc_id", "left_semi"), p.positives, "positive")
    unlabelled = _draw(learned, p.unlabelled, "unlabelled")
    model = fit_pu(positive, unlabelled, p)[0] if min(len(positive), len(unlabelled)) > 1 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("features").to_pylist()), np.float32).reshape(len(batch), -1)
            scores = _sigmoid(model.value(x.astype(np.float64))) if model else np.full(len(batch), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return every.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        (crc_remainder("doc_id", p.modulus) == p.held_out).alias("held_out"),
        "score",
        (F.col("score") >= p.threshold).cast("int").alias("predicted"),
    )
