"""Token-id output: best-fit-decreasing packing into fixed-length id rows.

Every partition packs its own documents, so nothing is shuffled and no document meets another task.
A task holds a window of about ``window_tokens`` ids.  Documents longer than a row are cut into
whole rows first, losslessly; what is left of each, longest first, goes to the open row with the
least sufficient room, found by descending a segment tree over capacities.

A row of the result is one row of the id matrix: ``ids`` (little-endian, padded with the end id),
``cu_seqlens`` (where its segments start, and where the last ends), ``position_resets`` (the first
position id of each segment: 0, or where a cut document goes on), ``doc_ids`` and ``starts``.
Sequence ids are unique: the partition's number above a running number.

Null and empty texts give the end id alone.  Repeated rows and null ids are packed like any other
row.  Columns beside the id and the text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagehouse.llm.encoding import encoder, tokenizer_path
from stagehouse.llm.storage import map_batches
from stagehouse.llm.text import give_back, text_slices

SCHEMA = (
    "sequence_id long, n_segments int, n_tokens int, ids binary, cu_seqlens array<int>, "
    "position_resets array<long>, doc_ids array<long>, starts array<long>"
)
#: Text that is encoded at once: its chunks take some forty times as much for a moment.
ENCODED_BYTES = 1 << 20


class CapacityTree:
    """How many open bins have each remaining capacity; finds the least capacity of at least n."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, capacity: int, which: int) -> None:
        self.bins[capacity].append(which)
        self._change(capacity, 1)

    def take(self, n: int) -> tuple[int, int] | None:
        """Removes and returns (capacity, bin) of the best fit, or None."""
        capacity = self._least(n)
        if capacity is None:
            return None
        self._change(capacity, -1)
        return capacity, self.bins[capacity].pop()

    def take_below(self, n: int) -> tuple[int, int] | None:
        """The same for the largest capacity of at most n."""
        capacity = self._most(n)
        if capacity is None:
            return None
        self._change(capacity, -1)
        return capacity, self.bins[capacity].pop()

    def __len__(self) -> int:
        return self.count[1]

    def _change(self, capacity: int, by: int) -> None:
        node = self.size + capacity
        while node:
            self.count[node] += by
            node >>= 1

    def _least(self, n: int) -> int | None:
        node = self.size + n
        if self.count[node]:
            return n
        while node > 1 and (node & 1 or not self.count[node + 1]):
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.size:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        return node - self.size

    def _most(self, n: int) -> int | None:
        node = self.size + n
        if self.count[node]:
            return n
        while node > 1 and (not node & 1 or not self.count[node - 1]):
            node >>= 1
        if node <= 1:
            return None
        node -= 1
        while node < self.size:
            node = 2 * node + 1 if self.count[2 * node + 1] else 2 * node
        return node - self.size


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices into ``lengths``, longest first, none above ``capacity``."""
    tree, bins = CapacityTree(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[i])
        if found is None:
            found = capacity, len(bins)
            bins.append([])
        room, which = found
        bins[which].append(i)
        tree.add(room - lengths[i], which)
    return bins


def encoded_documents(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int
) -> Iterator[tuple[int | None, np.ndarray]]:
    """Each row's id and its token ids with ``end_id`` behind them."""
    encode = encoder(path, with_ids=True)
    for part, data, bounds in text_slices(batches, limit=ENCODED_BYTES):
        ids, counts = encode.encode(data, bounds)
        ends = np.cumsum(counts)
        for doc_id, a, b in zip(part.column(0).to_pylist(), ends - counts, ends, strict=True):
            yield doc_id, np.append(ids[a:b], np.uint32(end_id))
        del part, data, bounds, ids, counts, ends
        give_back()


def first_sequence_id() -> int:
    return TaskContext.get().partitionId() << 33


def pack_token_rows(
    docs: DataFrame,
    *,
    tokenizer: str | None = None,
    row_tokens: int = 2048,
    end_id: int = 50256,
    id_bytes: int = 2,
    window_tokens: int = 2_000_000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` as packed id rows of ``row_tokens`` ids (see the module's text)."""
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    kind = {2: "<u2", 4: "<u4"}[id_bytes]

    def rows(window: list, number: int) -> Iterator[dict]:
        whole, rest = [], []
        for doc_id, ids in window:
            full = len(ids) // row_tokens * row_tokens
            whole += [[(doc_id, a, ids[a : a + row_tokens])] for a in range(0, full, row_tokens)]
            if full < len(ids):
                rest.append((doc_id, full, ids[full:]))
        bins = best_fit([len(ids) for *_, ids in rest], row_tokens)
        for segments in [*whole, *([rest[i] for i in b] for b in bins)]:
            lengths = [len(ids) for *_, ids in segments]
            matrix_row = np.full(row_tokens, end_id, kind)
            matrix_row[: sum(lengths)] = np.concatenate([ids for *_, ids in segments])
            yield {
                "sequence_id": number,
                "n_segments": len(segments),
                "n_tokens": sum(lengths),
                "ids": matrix_row.tobytes(),
                "cu_seqlens": [0, *np.cumsum(lengths).tolist()],
                "position_resets": [int(start) for _, start, _ in segments],
                "doc_ids": [doc_id for doc_id, *_ in segments],
                "starts": [int(start) for _, start, _ in segments],
            }
            number += 1

    layout = pa.schema(
        [
            ("sequence_id", pa.int64()),
            ("n_segments", pa.int32()),
            ("n_tokens", pa.int32()),
            ("ids", pa.binary()),
            ("cu_seqlens", pa.list_(pa.int32())),
            ("position_resets", pa.list_(pa.int64())),
            ("doc_ids", pa.list_(pa.int64())),
            ("starts", pa.list_(pa.int64())),
        ]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, window, held = first_sequence_id(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, window, held
            done = list(rows(window, number))
            number, window, held = number + len(done), [], 0
            for at in range(0, len(done), 256):
                yield pa.RecordBatch.from_pylist(done[at : at + 256], schema=layout)

        for doc_id, ids in encoded_documents(batches, path, end_id):
            window.append((doc_id, ids))
            held += len(ids)
            if held >= window_tokens:
                yield from flush()
        if window:
            yield from flush()

    picked = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    return map_batches(picked, pack, SCHEMA)
