"""Quality classifier: regularised quadratic discriminant over document statistics.

Class means and covariances come from sums over every labelled training row, added
up by Spark, so the driver holds one matrix a class whatever the corpus.  Covariances
are shrunk to the pooled one and then to a scaled identity; a score is the difference
of two Gaussian log densities, with Mahalanobis distances taken through inverse
Cholesky factors that are computed once.  The difference is calibrated by a logistic
curve fitted to its histogram over the training rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytespan import text_bytes
from .docstats import NAMES, statistics, with_statistics
from ..scratch import Scratch

#: Log-density differences are cut to this range and counted in this many bins.
RANGE, BINS = 60.0, 480


@dataclass
class Discriminant:
    """Two shrunk Gaussians and the calibration of their log-density difference."""

    mean: list[np.ndarray]
    factor: list[np.ndarray]  # inverse Cholesky factors
    log_det: list[float]
    slope: float = 1.0
    offset: float = 0.0
    constant: float | None = None  # the score where a class has too few rows

    def difference(self, x: np.ndarray) -> np.ndarray:
        logs = []
        for k in (0, 1):
            z = (x - self.mean[k]) @ self.factor[k].T
            logs.append(-0.5 * np.einsum("ij,ij->i", z, z) - self.log_det[k])
        return np.clip(logs[1] - logs[0], -RANGE, RANGE)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-(self.slope * self.difference(x) + self.offset)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


def _moments(train: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """By class: rows, sum and sum of outer products of (x, label)."""
    p = len(NAMES)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = _matrix(b.column(0)), np.asarray(b.column(1))
            for k in (0, 1):
                z = x[y == k]
                if len(z):
                    flat = np.concatenate([[len(z)], z.sum(0), (z.T @ z).ravel()])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), k, np.int32)), pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["k", "i", "v"])

    rows = train.mapInArrow(partial, "k int, i int, v double").groupBy("k", "i").agg(F.sum("v").alias("v")).collect()
    flat = {k: np.zeros(1 + p + p * p) for k in (0, 1)}
    for r in rows:
        flat[r.k][r.i] = r.v
    return {k: (v[0], v[1 : 1 + p], v[1 + p :].reshape(p, p)) for k, v in flat.items()}


def fit(train: DataFrame, to_pooled: float = 0.2, to_identity: float = 0.02, least_rows: int = 10) -> Discriminant:
    """Fit on rows (x, label); a class with under ``least_rows`` rows gives a constant smoothed score."""
    m = _moments(train)
    n = [m[k][0] for k in (0, 1)]
    if min(n) < least_rows:
        return Discriminant([], [], [], constant=(n[1] + 1) / (sum(n) + 2))
    mean = [m[k][1] / n[k] for k in (0, 1)]
    cov = [m[k][2] / n[k] - np.outer(mean[k], mean[k]) for k in (0, 1)]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / sum(n)
    factor, log_det = [], []
    for k in (0, 1):
        c = (1 - to_pooled) * cov[k] + to_pooled * pooled
        c = (1 - to_identity) * c + to_identity * (np.trace(c) / len(c) + 1e-6) * np.eye(len(c))
        lower = np.linalg.cholesky(c)
        factor.append(np.linalg.inv(lower))
        log_det.append(float(np.log(np.diag(lower)).sum()))
    model = Discriminant(mean, factor, log_det)

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = np.floor((model.difference(_matrix(b.column(0))) + RANGE) * (BINS / (2 * RANGE))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(d), b.column(1)], ["bin", "y"])

    rows = train.mapInArrow(histogram, "bin int, y int").groupBy("bin", "y").count().collect()
    d = np.array([(r.bin + 0.5) * (2 * RANGE / BINS) - RANGE for r in rows])
    y, w = np.array([r.y for r in rows], float), np.array([r["count"] for r in rows], float)
    model.slope, model.offset = _logistic(d, y, w)
    return model


def _logistic(d: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a weighted logistic fit, by damped Newton steps with a light ridge."""
    a, b, x = 0.1, 0.0, np.stack([d, np.ones_like(d)], 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * d + b, -40, 40)))
        g = x.T @ (w * (y - p)) - 1e-3 * np.array([a, b])
        h = (x * (w * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        step *= min(1.0, 1.0 / max(np.abs(step * [1, 0.2]).max(), 1e-12))
        a, b = max(a + step[0], 1e-3), b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def _known(labels: DataFrame, id_col: str, label_col: str, folds: int, held_out_fold: int) -> DataFrame:
    """(id, y) of the labelled ids outside the held-out fold."""
    known = labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    return known.filter(_fold(folds) != held_out_fold)


def train_quality(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, held_out_fold: int) -> tuple[Discriminant, DataFrame]:
    """(model, statistics of all documents): fitted to the labelled documents outside the held-out fold."""
    s = Scratch(docs.sparkSession, "quality")
    stats = s.table(with_statistics(docs, id_col, text_col))
    train = s.table(stats.join(_known(labels, id_col, label_col, folds, held_out_fold), "id").select("x", "y"))
    return fit(train), stats


def _fold(folds: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 5,
    held_out_fold: int = 0,
    threshold: float = 0.3,
) -> DataFrame:
    """One row per document row: (id_col, held_out, score, predicted).

    Trains on labelled documents outside the held-out fold, crc32(id as text) mod
    ``folds``; a null id counts as the empty text and is never labelled.  Labels other
    than 0 and 1 are ignored, of several for one id the largest holds.  Null and
    empty texts have zero counts and get a score.  With no documents there are no rows;
    without labels of both classes every score is the smoothed share of label 1.
    """
    model, stats = train_quality(docs, labels, id_col, text_col, label_col, folds, held_out_fold)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(_matrix(b.column(1))))], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = stats.mapInArrow(scan, f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_col), (_fold(folds) == held_out_fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 5, held_out_fold: int = 0, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``threshold``.

    Scores are those of :func:`quality_scores`.  Statistics are taken of the labelled rows
    alone to fit, and then of each text where it lies, so no text that is unlabelled goes
    through a shuffle while the labels are small enough for Spark to broadcast them.
    """
    s = Scratch(docs.sparkSession, "quality")
    known = s.table(_known(labels, id_col, label_col, folds, held_out_fold))
    some = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(known, "id")
    model = fit(s.table(_labelled_statistics(some)))
    place = docs.columns.index(text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(model.score(statistics(*text_bytes(b.column(place)))) >= threshold))

    return docs.mapInArrow(scan, docs.schema)


def _labelled_statistics(rows: DataFrame) -> DataFrame:
    """(id, text, y) -> (x, y)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = statistics(*text_bytes(b.column(0)))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, len(NAMES), dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([flat, b.column(1)], ["x", "y"])

    return rows.select("text", "y").mapInArrow(scan, "x array<double>, y int")
