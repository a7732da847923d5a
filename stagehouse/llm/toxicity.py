"""Toxicity by weak supervision.

1. Voters: single words (lexicon) and word beginnings (patterns) that mark toxic rows of the
   labelled sample.  Each votes "toxic" where it occurs and is silent elsewhere.
2. A generative label model, fitted by expectation-maximisation on the votes, estimates how often
   each voter speaks in either class (its accuracy) and how voters go together within a class
   (their correlations); correlated voters share one voice.  It turns votes into the
   probability of the label.
3. A linear classifier over hashed words and word beginnings learns these probabilities.  It
   scores every whole text in one pass without a shuffle.

Models are fitted on at most ``fit_rows`` labelled rows, those of least hash; texts of equal
features count once.  Null and empty texts have no features and score the classifier's bias.  Ids, source and
language are no inputs.  Without labelled rows of both classes every score is the share of toxic
rows, or 0.  Repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagehouse.llm.features import (
    distinct_features,
    labelled_sample,
    sampled_features,
    sigmoid,
    sparse,
    word_features,
)
from stagehouse.llm.storage import inner_names, map_batches, own_names
from stagehouse.llm.text import give_back, text_slices

BITS = 20
PREFIXES = (5, 7)
#: Features that the driver sums up at a time.
PORTION = 1 << 18


@dataclass
class LabelModel:
    """How often each voter speaks in toxic and in clean rows, how voters go together, and the
    log odds of a row in which none speaks."""

    toxic: np.ndarray
    clean: np.ndarray
    together: np.ndarray
    silent: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """A voter counts less the more it goes together with others that speak in the row."""
        weight = np.log(self.toxic) - np.log(self.clean)
        voice = votes @ self.together
        voice += 1
        np.divide(votes, voice, out=voice)
        return sigmoid(self.silent + voice @ weight)


def fit_label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 8) -> LabelModel:
    """Expectation-maximisation from the beliefs ``start``: rates and positive correlations of the
    voters given the class, then beliefs from the votes, in turn."""
    belief = start
    none = votes.sum(1) == 0
    for _ in range(rounds):
        toxic = (belief @ votes + 0.02) / (belief.sum() + 1)
        clean = ((1 - belief) @ votes + 0.02) / ((1 - belief).sum() + 1)
        toxic = np.maximum(toxic, 1.05 * clean)  # a voter never speaks against its own vote
        residual = np.outer(belief, toxic)  # in place: the driver holds all votes
        np.subtract(votes, residual, out=residual)
        residual -= np.outer(1 - belief, clean)
        spread = np.sqrt((residual**2).sum(0)) + 1e-9
        together = np.maximum((residual.T @ residual) / np.outer(spread, spread), 0)
        np.fill_diagonal(together, 0)
        del residual
        share = (belief[none].sum() + 0.1) / (none.sum() + 1)
        share = min(max(share, 1e-3), 0.5)
        model = LabelModel(toxic, clean, together, float(np.log(share / (1 - share))))
        belief = model.posterior(votes)
    return model


def association(row, feature, belief, size: int):
    """Log odds of each feature for belief, shrunk, and the rows that have it."""
    have, toxic = np.zeros(size, np.int64), np.zeros(size)
    belief = belief.astype(float)
    for at in range(0, len(feature), PORTION):  # in order, so sums are those of one pass
        part = feature[at : at + PORTION]
        np.add.at(have, part, 1)
        np.add.at(toxic, part, belief[row[at : at + PORTION]])
    n, total = len(belief), belief.sum()
    odds = np.log((toxic + 0.5) / (total + 1)) - np.log((have - toxic + 0.5) / (n - total + 1))
    return odds, have, toxic


def choose_voters(row, feature, label, most: int, least_rows: int) -> np.ndarray:
    """Features that mostly stand in toxic rows, the most telling first."""
    odds, have, toxic = association(row, feature, label, 1 << BITS)
    good = np.flatnonzero((have >= least_rows) & (toxic >= 0.8 * have) & (odds > 2))
    return good[np.argsort(-(odds[good] * np.sqrt(have[good])), kind="stable")][:most]


@dataclass
class LinearModel:
    features: np.ndarray
    weights: np.ndarray
    bias: float


def fit_linear(
    row, feature, belief: np.ndarray, most: int, least_rows: int, rounds: int = 150
) -> LinearModel:
    """Logistic regression of ``belief`` on the presence of the ``most`` telling features."""
    _, have, toxic = association(row, feature, belief, 1 << BITS)
    share = belief.mean()
    tell = np.abs(toxic - have * share) / np.sqrt(np.maximum(have, 1) * share * (1 - share))
    tell[(have < least_rows) | (tell < 4)] = 0
    chosen = np.sort(np.argsort(-tell, kind="stable")[:most])
    chosen = chosen[tell[chosen] > 0]
    place = np.full(1 << BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    keep = place[feature] >= 0
    row, column = row[keep], place[feature[keep]]
    n, k = len(belief), len(chosen)
    weights, bias = np.zeros(k), float(np.log(belief.mean() / (1 - belief.mean())))
    first, second = np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, rounds + 1):
        p = sigmoid(bias + np.bincount(row, weights=weights[column], minlength=n))
        error = (p - belief) / n
        slope = np.bincount(column, weights=error[row], minlength=k) + 5e-5 * weights
        slope = np.append(slope, error.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        move = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - 0.08 * move[:k], bias - 0.08 * move[k]
    return LinearModel(chosen, weights, float(bias))


def presence(data: np.ndarray, bounds: np.ndarray):
    row, feature, _ = distinct_features(*word_features(data, bounds, BITS, PREFIXES), BITS)
    return row, feature, None


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    fit_rows: int = 12_000,
    most_voters: int = 300,
    most_features: int = 4096,
    least_rows: int = 8,
) -> LinearModel:
    """The classifier, from the rows of ``docs`` that ``labels`` (doc_id, toxic) names.  The driver gives
    back what the sample took there."""
    try:
        return _fitted(docs, labels, fit_rows, most_voters, most_features, least_rows)
    finally:
        give_back()


def _fitted(
    docs: DataFrame,
    labels: DataFrame,
    fit_rows: int,
    most_voters: int,
    most_features: int,
    least_rows: int,
) -> LinearModel:
    sample = labelled_sample(docs, labels, "toxic", fit_rows)
    row, feature, _, label = sparse(sampled_features(sample, presence, BITS))
    give_back()
    label = (label > 0).astype(np.int64)
    none = np.zeros(0, np.int64)
    if not len(label) or label.min() == label.max():
        share = float(label.mean()) if len(label) else 0.0
        return LinearModel(none, none.astype(float), 40.0 if share else -40.0)
    least_rows = min(least_rows, max(1, int(label.sum()) // 8))
    voters = choose_voters(row, feature, label, most_voters, least_rows)
    votes = np.zeros((len(label), len(voters)), np.float32)
    place = np.full(1 << BITS, -1, np.int32)
    place[voters] = np.arange(len(voters))
    spoken = place[feature] >= 0
    votes[row[spoken], place[feature[spoken]]] = 1
    model = fit_label_model(votes, np.where(label, 0.95, 0.005))
    belief = np.clip(model.posterior(votes), 1e-4, 1 - 1e-4)
    return fit_linear(row, feature, belief, most_features, least_rows)


def score_toxicity(docs: DataFrame, model: LinearModel, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on)."""
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    names = [*(c for c in kept if c != "text"), "text"]
    picked = docs.select(*[f"`{n}`" for n in names])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(1 << BITS)
        weight[model.features] = model.weights
        for part, data, bounds in text_slices(batches):
            row, feature = word_features(data, bounds, BITS, PREFIXES)
            counts = weight[feature] != 0
            row, feature, _ = distinct_features(row[counts], feature[counts], BITS)
            sums = np.bincount(row, weights=weight[feature], minlength=part.num_rows)
            p = sigmoid(model.bias + sums)
            columns = [*part.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "score", "predicted"])

    return map_batches(picked, score, ", ".join([*fields, "score double", "predicted int"]))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` below the threshold, with their own columns, whatever their names."""
    inner = inner_names(docs.columns, "text")
    scored = score_toxicity(docs.toDF(*inner), fit(docs, labels), threshold)
    return own_names(scored.where(F.col("predicted") == 0), inner, docs.columns)
