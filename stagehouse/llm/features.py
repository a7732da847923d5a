"""Hashed text features of whole texts, and the bounded labelled samples that models are fitted on."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagehouse.llm.storage import map_batches
from stagehouse.llm.text import MARKS, mix, rows_of, span_hashes, text_slices, word_spans

PREFIX_SALT = np.uint64(0x5851F42D4C957F2D)


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null ids give null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, most_rows: int, text_column: str = "text"
) -> DataFrame:
    """(doc_id, text, label) of at most ``most_rows`` labelled ids, the ones of least hash.  An id
    with several labels takes the largest; of an id with several texts one is used."""
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most_rows)
    )
    picked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    return picked.join(F.broadcast(ids), "doc_id")  # at most most_rows pairs of numbers


def word_features(data: np.ndarray, bounds: np.ndarray, bits: int, prefixes: tuple[int, ...] = ()):
    """(row, feature) of every word, and of its first bytes where it is longer."""
    starts, ends = word_spans(data, bounds, MARKS)
    rows = rows_of(bounds, starts)
    shift = np.uint64(64 - bits)
    all_rows = [rows]
    all_features = [(span_hashes(data, starts, ends) >> shift).astype(np.int64)]
    for n in prefixes:
        longer = ends - starts > n
        hashes = span_hashes(data, starts[longer], starts[longer] + n)
        salted = mix(hashes + np.uint64(n * int(PREFIX_SALT) % 2**64))
        all_rows.append(rows[longer])
        all_features.append((salted >> shift).astype(np.int64))
    return np.concatenate(all_rows), np.concatenate(all_features)


def distinct_features(rows: np.ndarray, features: np.ndarray, bits: int):
    """(row, feature, count), ordered, each pair once."""
    key, counts = np.unique((rows << bits) | features, return_counts=True)
    return key >> bits, key & ((1 << bits) - 1), counts


def sampled_features(sample: DataFrame, extract, bits: int) -> pa.Table:
    """(doc_id, label, features, counts) of a bounded sample, in the driver.  ``extract`` gives
    (row, feature, value) of a slice, ordered by row; value may be None."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in text_slices(batches):
            row, feature, value = extract(data, bounds)
            cut = np.searchsorted(row, np.arange(len(bounds)))
            pairs = list(zip(cut[:-1], cut[1:], strict=True))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column(part.schema.get_field_index("doc_id")),
                    "label": part.column(part.schema.get_field_index("label")),
                    "features": [feature[a:b].astype("<u4").tobytes() for a, b in pairs],
                    "counts": [
                        b"" if value is None else value[a:b].astype("<f4").tobytes()
                        for a, b in pairs
                    ],
                }
            )

    found = map_batches(
        sample.select("doc_id", "label", "text"),
        rows,
        "doc_id long, label int, features binary, counts binary",
    )
    # repeated rows of an id would break the bound
    once = found.groupBy("doc_id").agg(
        F.max(F.struct("features", "counts", "label")).alias("one")
    )
    return once.select("doc_id", "one.label", "one.features", "one.counts").toArrow()


def sparse(sample: pa.Table):
    """(row, feature, value, label) arrays of the sample, by id; equal features count once.  Numbers
    of 4 bytes, since the driver holds them all."""
    once = {}
    for i in np.argsort(sample["doc_id"].to_numpy(), kind="stable"):
        once[sample["features"][i].as_py(), sample["counts"][i].as_py()] = sample["label"][i].as_py()
    features = [np.frombuffer(f, "<u4") for f, _ in once]
    values = [np.frombuffer(v, "<f4") for _, v in once]
    row = np.repeat(np.arange(len(features), dtype=np.int32), [len(f) for f in features])
    return (
        row,
        np.concatenate(features or [np.zeros(0, "<u4")]).view(np.int32),
        np.concatenate(values or [np.zeros(0, np.float32)]),
        np.array(list(once.values()), np.int64),
    )


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
