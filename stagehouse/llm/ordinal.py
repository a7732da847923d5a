"""Quality by ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector over hashed text features, shared by
all grades, and ordered thresholds.  Features are the shares of hashed words, and hashed marks of a
text's shape (bins of the shares of capitals, digits, marks and distinct words, of word length and
text length).  The result is the expected grade and the tail probability P(grade >= least_grade).

Fitted on at most ``fit_rows`` rated rows, those of least hash; equal texts count once.  Null and
empty texts have only shape marks.  With fewer than two grades rated, every text gets that grade
(0 without ratings).  Repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stagehouse.llm.features import (
    distinct_features,
    labelled_sample,
    sampled_features,
    sigmoid,
    sparse,
    word_features,
)
from stagehouse.llm.storage import map_batches
from stagehouse.llm.text import MARKS, SPACES, mix, text_slices

BITS = 16
WORD_SCALE = 4.0
#: Upper edges of the bins of each shape mark.
EDGES = {
    "capitals": (0.005, 0.02, 0.05, 0.1, 0.3, 0.6),
    "digits": (0.005, 0.02, 0.05, 0.1, 0.3),
    "marks": (0.005, 0.02, 0.04, 0.08, 0.15, 0.3),
    "distinct": (0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9),
    "repeated": (0.02, 0.05, 0.1, 0.2, 0.4, 0.7),
    "word_length": (2.5, 3.5, 4.5, 5.5, 7.0, 10.0),
    "words": (1, 4, 16, 64, 256, 1024, 4096),
}


def shape_features(data: np.ndarray, bounds: np.ndarray, rows: np.ndarray, words: np.ndarray):
    """(row, feature) of each text's shape marks."""
    n = len(bounds) - 1
    kinds = np.zeros((4, len(data) + 1), np.int64)
    for i, mask in enumerate(
        (
            (data >= 65) & (data <= 90),
            (data >= 48) & (data <= 57),
            MARKS[data] & ~SPACES[data],
            ~SPACES[data],
        )
    ):
        np.cumsum(mask, out=kinds[i, 1:])
    inside = kinds[:, bounds[1:]] - kinds[:, bounds[:-1]]
    printed = np.maximum(inside[3], 1)
    n_words = np.bincount(rows, minlength=n)
    once = np.bincount(distinct_features(rows, words, BITS)[0], minlength=n)
    same = np.zeros(len(rows), bool)
    same[1:] = (rows[1:] == rows[:-1]) & (words[1:] == words[:-1])
    values = {
        "capitals": inside[0] / printed,
        "digits": inside[1] / printed,
        "marks": inside[2] / printed,
        "distinct": once / np.maximum(n_words, 1),
        "repeated": np.bincount(rows[same], minlength=n) / np.maximum(n_words, 1),
        "word_length": printed / np.maximum(n_words, 1),
        "words": n_words,
    }
    features = []
    for kind, (name, value) in enumerate(values.items()):
        bin_of = np.searchsorted(EDGES[name], value, "right")
        hashed = mix((np.uint64(kind * 64 + 1) + bin_of.astype(np.uint64)) * np.uint64(0x2545F491))
        features.append((hashed >> np.uint64(64 - BITS)).astype(np.int64))
    return np.tile(np.arange(n), len(values)), np.concatenate(features)


def text_features(data: np.ndarray, bounds: np.ndarray):
    """(row, feature, value), ordered by row."""
    rows, words = word_features(data, bounds, BITS)
    row, feature, count = distinct_features(rows, words, BITS)
    n_words = np.bincount(rows, minlength=len(bounds) - 1)
    value = WORD_SCALE * count / n_words[row]
    shape_row, shape = shape_features(data, bounds, rows, words)
    row = np.concatenate([row, shape_row])
    order = np.argsort(row, kind="stable")
    value = np.concatenate([value, np.ones(len(shape))])
    return row[order], np.concatenate([feature, shape])[order], value[order]


@dataclass
class OrdinalModel:
    grades: np.ndarray
    thresholds: np.ndarray
    weights: np.ndarray

    def at_least(self, projected: np.ndarray) -> np.ndarray:
        """P(grade >= g) for every grade above the lowest, one row each."""
        return sigmoid(projected[None, :] - self.thresholds[:, None])


def fit_ordinal(row, feature, value, grade, rounds: int = 200) -> OrdinalModel:
    """Maximum likelihood with a small ridge.  Thresholds stay ordered: each is the one before it
    plus the exponential of a free number."""
    grades, y = np.unique(grade, return_inverse=True)
    k, n, size = len(grades) - 1, len(y), 1 << BITS
    if k < 1:
        return OrdinalModel(grades if len(grades) else np.zeros(1), np.zeros(0), np.zeros(size))
    below = np.array([(y <= j).mean() for j in range(k)])
    start = np.log(below) - np.log1p(-below)
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    weights = np.zeros(size)
    first, second = np.zeros(size + k), np.zeros(size + k)
    for step in range(1, rounds + 1):
        thresholds = np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
        projected = np.bincount(row, weights=weights[feature] * value, minlength=n)
        up_to = np.concatenate(
            [np.zeros((1, n)), sigmoid(thresholds[:, None] - projected[None, :]), np.ones((1, n))]
        )
        density = up_to * (1 - up_to)
        at = np.arange(n)
        mass = np.maximum(up_to[y + 1, at] - up_to[y, at], 1e-9)
        slope_x = (density[y + 1, at] - density[y, at]) / mass / n
        slope_w = np.bincount(feature, weights=slope_x[row] * value, minlength=size)
        slope_t = np.zeros(k)
        for j in range(k):
            slope_t[j] = (
                (density[j + 1] / mass)[y == j + 1].sum() - (density[j + 1] / mass)[y == j].sum()
            ) / n
        slope_free = np.cumsum(slope_t[::-1])[::-1].copy()
        slope_free[1:] *= np.exp(free[1:])
        slope = np.concatenate([slope_w + 1e-5 * weights, slope_free])
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        move = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights, free = weights - 0.05 * move[:size], free - 0.05 * move[size:]
    thresholds = np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
    return OrdinalModel(grades, thresholds, weights)


def fit(
    docs: DataFrame, ratings: DataFrame, *, grade: str = "grade", fit_rows: int = 10_000
) -> OrdinalModel:
    """The model, from the rows of ``docs`` that ``ratings`` (doc_id, grade) names."""
    sample = labelled_sample(docs, ratings, grade, fit_rows)
    return fit_ordinal(*sparse(sampled_features(sample, text_features, BITS)))


def grade_documents(docs: DataFrame, model: OrdinalModel, least_grade: int) -> DataFrame:
    """(doc_id, expected_grade, tail_probability, selected) of every row: selected where
    P(grade >= least_grade) is at least one half."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in text_slices(batches):
            row, feature, value = text_features(data, bounds)
            projected = np.bincount(
                row, weights=model.weights[feature] * value, minlength=part.num_rows
            )
            tails = model.at_least(projected)
            steps = np.diff(model.grades)
            expected = model.grades[0] + (tails * steps[:, None]).sum(0)
            above = np.flatnonzero(model.grades[1:] >= least_grade)
            if model.grades[0] >= least_grade:
                tail = np.ones(part.num_rows)
            else:
                tail = tails[above[0]] if len(above) else np.zeros(part.num_rows)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column(0),
                    "expected_grade": expected,
                    "tail_probability": tail,
                    "selected": tail >= 0.5,
                }
            )

    return map_batches(
        docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text"),
        rate,
        "doc_id long, expected_grade double, tail_probability double, selected boolean",
    )
