"""Language identification with hyperdimensional profiles.

Every letter has a random vector of signs, made from its code point.  The vector of an n-gram
binds the vectors of its letters, each rotated by its place, by multiplication; a text's vector
bundles those of all its n-grams by addition.  A language's prototype bundles all its training
texts.  A text gets the language whose prototype has the largest cosine with its vector.

Letters are lower-cased; every other character is a gap, and n-grams centred on a gap do not
count.  Texts that are null or have no letter are ``und`` with score 0, as is everything when
nothing was learned.  Ties go to the language first in order.  Repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagehouse.llm.storage import map_batches
from stagehouse.llm.text import text_slices

DIMENSIONS = 1024
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point of the first plane: its lower-case letter, or 0 for other characters."""
    out = np.zeros(1 << 16, np.uint32)
    for point in range(1 << 16):
        character = chr(point)
        if character.isalpha():
            low = character.lower()
            out[point] = ord(low) if len(low) == 1 else point
    return out


def letters_of(points: np.ndarray) -> np.ndarray:
    out = _letters()[np.minimum(points, 0xFFFF)]
    for point in np.unique(points[points > 0xFFFF]).tolist():
        low = chr(point).lower()
        out[points == point] = ord(low) if chr(point).isalpha() and len(low) == 1 else 0
    return out


@lru_cache(1 << 14)
def letter_vector(point: int) -> np.ndarray:
    random = np.random.default_rng(0x5EED0000 + point)
    return (random.integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1).astype(np.int8)


def ngram_vectors(points: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """One bound vector per row of ``grams``, which holds places in ``points``."""
    table = np.stack([letter_vector(int(p)) for p in points])
    first, middle = np.roll(table, 2, axis=1), np.roll(table, 1, axis=1)
    return (first[grams[:, 0]] * middle[grams[:, 1]] * table[grams[:, 2]]).astype(np.float32)


def ngram_counts(data: np.ndarray, bounds: np.ndarray, group: np.ndarray | None = None):
    """(points, grams, group of each entry, gram of each entry, count) of a slice's trigrams.
    ``group`` gives each row's group, by default the row itself; below 0 the row is left out."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
    letters = letters_of(points)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(at))
    symbols, local = np.unique(letters, return_inverse=True)
    if not len(symbols) or symbols[0] != 0:
        symbols, local = np.concatenate([[0], symbols]), local + 1
    size = len(symbols)
    before = np.concatenate([[0], local[:-1]]) if len(local) else local
    after = np.concatenate([local[1:], [0]]) if len(local) else local
    edges = at[(at < len(local))]
    if len(local):
        before[edges] = 0
        ends = at[at > 0] - 1
        after[ends] = 0
    which = owner if group is None else group[owner]
    keep = (local != 0) & (which >= 0)
    code = ((which * size + before) * size + local) * size + after
    code, count = np.unique(code[keep], return_counts=True)
    gram, inverse = np.unique(code % size**3, return_inverse=True)
    grams = np.stack([gram // size**2, gram // size % size, gram % size], axis=1)
    return symbols, grams, code // size**3, inverse, count


def bundles(data: np.ndarray, bounds: np.ndarray, groups: int, group: np.ndarray | None = None):
    """The bundled vector of each group, one row each; rows without n-grams are 0."""
    points, grams, which, gram, count = ngram_counts(data, bounds, group)
    out = np.zeros((groups, DIMENSIONS), np.float32)
    if not len(grams):
        return out
    cut = np.searchsorted(which, np.arange(groups + 1))
    if len(grams) * DIMENSIONS <= 1 << 24:
        vectors = ngram_vectors(points, grams)
        for i in np.flatnonzero(np.diff(cut)):
            a, b = cut[i], cut[i + 1]
            out[i] = count[a:b].astype(np.float32) @ vectors[gram[a:b]]
        return out
    for low in range(0, len(grams), 1 << 13):  # many scripts: their n-grams in parts
        vectors = ngram_vectors(points, grams[low : low + (1 << 13)])
        inside = (gram >= low) & (gram < low + (1 << 13))
        for i in np.flatnonzero(np.bincount(which[inside], minlength=groups)):
            own = inside & (which == i)
            out[i] += count[own].astype(np.float32) @ vectors[gram[own] - low]
    return out


def learn_prototypes(docs: DataFrame) -> dict[str, np.ndarray]:
    """The unit prototype of each language of ``docs`` (text, lang), over all its rows.  Each task
    bundles its rows; one vector per task and language is shuffled."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part, data, bounds in text_slices(batches):
            names = part.column(1).dictionary_encode()
            group = np.array(names.indices.fill_null(-1))
            languages = names.dictionary.to_pylist()
            found = bundles(data, bounds, len(languages), group)
            for name, vector in zip(languages, found, strict=True):
                sums[name] = sums.get(name, 0) + vector.astype(np.float64)
        for name, vector in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": [name] * DIMENSIONS, "place": np.arange(DIMENSIONS), "total": vector}
            )

    parts = docs.where(F.col("lang").isNotNull()).select("text", "lang")
    summed = (
        map_batches(parts, bundle, "lang string, place long, total double")
        .groupBy("lang", "place")
        .agg(F.sum("total").alias("total"))
    )
    out: dict[str, np.ndarray] = {}
    for lang, place, total in summed.collect():  # languages times DIMENSIONS
        out.setdefault(lang, np.zeros(DIMENSIONS))[place] = total
    return {k: v / n for k, v in sorted(out.items()) if (n := np.linalg.norm(v)) > 0}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, lang_pred, score): score is the cosine, at least 0."""
    names = list(prototypes)
    matrix = np.array([prototypes[n] for n in names], np.float32).reshape(len(names), DIMENSIONS)

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in text_slices(batches):
            vectors = bundles(data, bounds, part.num_rows)
            norm = np.linalg.norm(vectors, axis=1)
            cosine = vectors @ matrix.T / np.maximum(norm, 1e-9)[:, None]
            if names:
                best = cosine.argmax(1)
                score = np.clip(cosine[np.arange(len(best)), best], 0, 1).astype(float)
            else:
                best, score = np.zeros(part.num_rows, int), np.zeros(part.num_rows)
            known = (norm > 0) & bool(names)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column(0),
                    "lang_pred": [names[b] if k else UNKNOWN for b, k in zip(best, known)],
                    "score": np.where(known, score, 0.0),
                }
            )

    return map_batches(
        docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text"),
        classify,
        "doc_id long, lang_pred string, score double",
    )
