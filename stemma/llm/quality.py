"""Text quality by a support vector machine over naive-Bayes-scaled n-gram indicators.

Indicators are n-grams of a text's bytes, of its outline (runs of letters, digits
and marks) and of the sequence that tells which words repeat the one before. Each
is scaled by the logarithm of how much likelier it is in good texts than in bad
ones, and a linear hinge-loss model is fitted to the scaled indicators by dual
coordinate descent. A sigmoid, fitted to rows left out, turns margins to scores.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm import grams
from stemma.llm.common import annotate, arrow_of, batch_of, held_out, rows_of, texts

#: Labelled rows that are learned from: at most so many, those whose ids hash lowest.
SAMPLE = 6000
#: Of these, one in so many sets the sigmoid instead.
CALIBRATE = 5
BITS, PRIOR, COST, ROUNDS = 17, 1.0, 1.0, 12
#: A score under this is a rejection.
THRESHOLD = 0.3
_MODEL = "weights binary, slope double, offset double"
_OWN = "_quality_score"


def features(text: str, marks: grams.Marks) -> np.ndarray:
    raw = grams.as_bytes(text)
    marks.add(raw, range(1, 4), 1)
    marks.add(grams.outline(raw), range(1, 8), 2)
    marks.add(grams.repeats(raw), range(1, 9), 3)
    return marks.take()


def log_ratios(rows: list[np.ndarray], good: np.ndarray, size: int) -> np.ndarray:
    """Log of each indicator's share in good rows over its share in bad ones, smoothed."""
    counts = np.full((2, size), PRIOR)
    for own, label in zip(rows, good, strict=True):
        counts[int(label), own] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def descend(rows: list[np.ndarray], good: np.ndarray, scale: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the hinge-loss machine by dual coordinate descent, one row's multiplier at a time.

    Rows have length one after scaling; each class has the same total cost.
    """
    signs = np.where(good, 1.0, -1.0)
    costs = COST * len(rows) / (2 * np.maximum(1, np.where(good, good.sum(), (~good).sum())))
    weights, alpha = np.zeros(len(scale)), np.zeros(len(rows))
    values = [scale[own] / max(1e-12, float(np.linalg.norm(scale[own]))) for own in rows]
    order = np.random.default_rng(0)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            own, value = rows[i], values[i]
            gradient = signs[i] * float(weights[own] @ value) - 1
            new = min(max(alpha[i] - gradient, 0.0), costs[i])  # rows of length one: the curvature is 1
            if new != alpha[i]:
                weights[own] += (new - alpha[i]) * signs[i] * value
                alpha[i] = new
    return weights


def sigmoid_of(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the sigmoid that fits labels to margins, by Newton steps on smoothed targets."""
    n, bad = int(good.sum()), int((~good).sum())
    target = np.where(good, (n + 1) / (n + 2), 1 / (bad + 2))
    a, b = 1.0, np.log((n + 1) / (bad + 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - target) * margins).sum() + 1e-3 * (a - 1), (p - target).sum()])
        h = np.array([[(w * margins**2).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5 / max(1e-12, float(np.abs(step).max())))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[bytes, float, float]:
    """Weights (64-bit floats) and the sigmoid, from at most ``sample`` labelled rows that aren't held out.

    One task fits them; what it reads is bounded by ``sample``, not by the input.
    Where a document's labels differ, the lowest counts. Without rows of both
    labels all weights are 0.
    """
    chosen = labels.where("quality is not null and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = texts(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality")

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, found, good, ids = grams.Marks(BITS), [], [], []
        for docs_in, bodies, quality in rows_of(batches, "doc_id", "text", "quality"):
            found += [features(x, marks).astype(np.int32) for x in bodies]
            good += [q == 1 for q in quality]
            ids += docs_in
        order = sorted(range(len(ids)), key=ids.__getitem__)  # the same rows in the same order give the same model
        found, good = [found[i] for i in order], np.array([good[i] for i in order], bool)
        size, slope, offset = 1 << BITS, 1.0, 0.0
        weights = np.zeros(size)
        if good.any() and not good.all():
            aside = np.arange(len(good)) % CALIBRATE == 0
            own, kept = [found[i] for i in np.flatnonzero(~aside)], good[~aside]
            if kept.any() and not kept.all():
                scale = log_ratios(own, kept, size)
                weights = descend(own, kept, scale)
                margins = np.array([_margin(x, weights, scale) for i, x in enumerate(found) if aside[i]])
                slope, offset = sigmoid_of(margins, good[aside])
                weights = np.stack([weights * scale, scale**2])
        if weights.ndim == 1:
            weights = np.stack([weights, np.ones(size)])
        yield batch_of(arrow_of(_MODEL), [weights.tobytes()], [slope], [offset])

    model = rows.repartition(1).mapInArrow(train, _MODEL).collect()
    return tuple(model[0]) if model else (np.stack([np.zeros(1 << BITS), np.ones(1 << BITS)]).tobytes(), 1.0, 0.0)


def _margin(own: np.ndarray, weights: np.ndarray, scale: np.ndarray) -> float:
    value = scale[own]
    return float(weights[own] @ value) / max(1e-12, float(np.linalg.norm(value)))


def mark(docs: DataFrame, model: tuple[bytes, float, float], column: str = "score") -> DataFrame:
    """Every row of ``docs`` with its score (0 to 1, higher is better); only the text counts, null as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        raw, slope, offset = shared.value
        weights, squares = np.frombuffer(raw).reshape(2, -1)
        marks = grams.Marks(BITS)

        def margin(text: str | None) -> float:
            own = features(text or "", marks)
            return float(weights[own].sum()) / max(1e-12, float(np.sqrt(squares[own].sum())))

        return lambda bodies: [1 / (1 + np.exp(-np.clip(slope * np.array([margin(x) for x in bodies]) + offset, -30, 30)))]

    return annotate(docs, make, f"{column} double")


def score(docs: DataFrame, model: tuple[bytes, float, float]) -> DataFrame:
    """``doc_id, score`` of every row."""
    return mark(docs.select("doc_id", "text"), model).select("doc_id", "score")


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't rejected, with their columns."""
    return mark(docs, fit(docs, labels), _OWN).where(F.col(_OWN) >= THRESHOLD).select(docs.columns)
