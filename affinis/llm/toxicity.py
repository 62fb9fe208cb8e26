"""Toxicity grades by cumulative-link ordinal regression on hashed words.

P(grade <= k) = logistic(threshold_k - w.x): one weight vector serves all ordered thresholds. x marks which hashed words
a text holds. The model is fitted on a bounded sample of labelled rows (MAX_ROWS, those with the smallest hash of their
id); it is applied to every whole text in one pass without a shuffle, and has a fixed size.

Nulls and edge cases: a null or empty text has no words and gets the grade of the intercept; labels that are null are
not used; of repeated ids the least text and the highest label count for the fit; without labels, or with one grade only, every
severity is 0 and nothing is toxic; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textops import TERMS, rows_of, sliced, word_hashes

#: Labelled rows that the fit may use, and the smallest number of them that must hold a word for it to be a feature.
MAX_ROWS, MIN_ROWS = 8000, 3
BITS = 18


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def below(self, eta: np.ndarray) -> np.ndarray:
        """P(grade <= k), one column per threshold."""
        return 1 / (1 + np.exp(np.clip(eta[:, None] - self.thresholds[None, :], -40, 40)))


def features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text's index, feature) of the distinct hashed words of each text."""
    h, first = word_hashes(texts, TERMS)
    key = np.unique(rows_of(first).astype(np.uint64) << np.uint64(bits) | h >> np.uint64(64 - bits))
    return (key >> np.uint64(bits)).astype(np.int64), (key & np.uint64((1 << bits) - 1)).astype(np.int64)


def _descend(x: tuple[np.ndarray, np.ndarray, np.ndarray], grades: np.ndarray, width: int, steps: np.ndarray, lasso: float, ridge: float, epochs: int) -> tuple[np.ndarray, np.ndarray]:
    """Accelerated proximal descent on the mean negative log-likelihood; x: rows, columns and values of the entries.

    Steps are as long as the curvature allows, which is up to 1/4 a row for two grades and 1/2 for more, where weights and
    thresholds (the first, and the gaps between them) share it.
    """
    rows, col, val = x
    n, levels = len(grades), len(steps) + 1
    times = lambda w: np.bincount(rows, val * w[col], minlength=n)
    back = lambda r: np.bincount(col, val * r[rows], minlength=width)
    v = np.ones(width)
    for _ in range(12):
        v = back(times(v))
        size = np.linalg.norm(v)
        v /= size or 1.0
    rate, pace = (1 / (0.25 * size / n + ridge + 1e-9), 1.0) if levels == 2 else (0.5 / (0.5 * size / n + ridge + 1e-9), 0.5 / (levels - 1))
    w, look, t = np.zeros(width), np.zeros(width), 1.0
    for _ in range(epochs):
        theta = np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])]))
        edge = np.concatenate([np.zeros((n, 1)), Ordinal(w, theta).below(times(look)), np.ones((n, 1))], 1)
        hi, lo = edge[np.arange(n), grades + 1], edge[np.arange(n), grades]
        p = np.maximum(hi - lo, 1e-12)
        dhi, dlo = hi * (1 - hi) / p / n, lo * (1 - lo) / p / n
        fresh = look - rate * (back(dhi - dlo) + ridge * look)
        fresh = np.sign(fresh) * np.maximum(np.abs(fresh) - rate * lasso, 0)
        grown = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w, look, t = fresh, fresh + (t - 1) / grown * (fresh - w), grown
        dt = np.bincount(grades, dhi, minlength=levels)[:-1] - np.bincount(grades, dlo, minlength=levels)[1:]
        ahead = np.concatenate([steps[:1], np.exp(steps[1:])]) + pace * np.cumsum(dt[::-1])[::-1]
        steps = np.concatenate([ahead[:1], np.log(np.maximum(ahead[1:], 1e-6))])
    return w, steps


def fit(rows: np.ndarray, feats: np.ndarray, grades: np.ndarray, bits: int = BITS, epochs: int = 120, common: float = 0.5) -> Ordinal:
    """Fit on sparse entries (rows, feats) and the grade 0, 1, ... of each row.

    Features are scaled to like variance; those in too few rows or in more than the share common of them are left out.
    A lasso at four times the noise of a feature without effect selects, then a fit on what it selected sets weights.
    """
    levels, n = int(grades.max()) + 1, len(grades)
    df = np.bincount(feats, minlength=1 << bits)
    use = (df[feats] >= MIN_ROWS) & (df[feats] <= common * n)
    share = np.clip(np.cumsum(np.bincount(grades, minlength=levels))[:-1] / n, 0.5 / n, 1 - 0.5 / n)
    theta = np.log(share / (1 - share))
    steps = np.concatenate([theta[:1], np.log(np.maximum(np.diff(theta), 1e-3))])
    full = np.zeros(1 << bits)
    noise = 4 * np.sqrt(share[0] * (1 - share[0]) / n)
    for lasso, ridge, rounds in ((noise, 0.0, epochs), (0.0, 1e-6, 25 * epochs)):
        names, col = np.unique(feats[use], return_inverse=True)
        p = df[names] / n
        scale = 1 / np.sqrt(p * (1 - p))
        if not len(names):
            break
        w, steps = _descend((rows[use], col, scale[col]), grades, len(names), steps, lasso, ridge, rounds)
        full[:] = 0
        full[names] = w * scale
        use &= full[feats] != 0
    return Ordinal(full, np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])])))


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, grade: Column, max_rows: int = MAX_ROWS) -> Ordinal | None:
    """Fit on at most max_rows labelled rows; None if they hold fewer than two grades. grade: an expression on labels."""
    known = labels.select(F.col(id_col).alias("id"), grade.cast("int").alias("grade")).where("id is not null and grade >= 0").groupBy("id").agg(F.max("grade").alias("grade"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(max_rows)  # bounded, so it may be broadcast
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(sample), "id").groupBy("id", "grade").agg(F.min("text").alias("text"))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            r, f = features(b.column(0))
            lists = np.split(f, np.searchsorted(r, np.arange(1, b.num_rows)))
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([x.astype(np.int32) for x in lists], pa.list_(pa.int32()))], ["grade", "f"])

    got = texts.select("text", "grade").mapInArrow(entries, "grade int, f array<int>").toArrow()
    grades = got.column("grade").to_numpy()
    if not len(grades) or len(np.unique(grades)) < 2:
        return None
    _, grades = np.unique(grades, return_inverse=True)
    lists = got.column("f").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    return fit(np.repeat(np.arange(len(grades)), sizes), lists.flatten().to_numpy().astype(np.int64), grades)


def score(docs: DataFrame, model: Ordinal | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, severity (expected grade), p_toxic (grade above 0), grade (most likely)."""
    held = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds) if model else None)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Ordinal(*held.value) if held.value else None
        for b in sliced(batches):
            n = b.num_rows
            if own is None:
                below = np.ones((n, 1))
            else:
                r, f = features(b.column(1))
                below = own.below(np.bincount(r, own.weights[f], minlength=n))
            p = np.diff(np.concatenate([np.zeros((n, 1)), below, np.ones((n, 1))], 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array((1 - below).sum(1)), pa.array(1 - below[:, 0]), pa.array(p.argmax(1).astype(np.int32))], ["id", "severity", "p_toxic", "grade"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(apply, f"id {kind}, severity double, p_toxic double, grade int")


def rejected(p_toxic: Column, most: float = 0.5) -> Column:
    return p_toxic > most


def without_rejected(docs: DataFrame, model: Ordinal | None, text_col: str = "text", most: float = 0.5) -> DataFrame:
    """docs without the rows whose text the model rejects, judged in one pass; columns as they were."""
    if model is None:
        return docs
    held = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Ordinal(*held.value)
        for b in sliced(batches, text_col):
            r, f = features(b.column(at))
            yield b.filter(pa.array(1 - own.below(np.bincount(r, own.weights[f], minlength=b.num_rows))[:, 0] <= most))

    return docs.mapInArrow(keep, docs.schema)
