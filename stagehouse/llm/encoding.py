"""Token ids of whole texts by a public tokenizer, one encoding per distinct chunk.

Both tokenizers end every token before white space, so the ids of a text are the ids of its
chunks one after the other.  A worker keeps the chunks it has seen in sorted arrays of bounded
size, known by one hash and checked by a second one; only new ones go to the tokenizers library.
"""

from __future__ import annotations

import os

import numpy as np

from stagehouse.llm.text import chunk_spans, rows_of, span_hash_pairs

#: Chunks that a worker keeps before it starts anew.
KEPT_CHUNKS = 1_000_000
_encoders: dict = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, with_ids: bool, kind: type[ChunkEncoder] | None = None) -> ChunkEncoder:
    """The encoder of this worker; it outlives a task where Spark reuses workers."""
    key = (path, with_ids, kind)
    if key not in _encoders:
        _encoders[key] = (kind or ChunkEncoder)(path, with_ids)
    return _encoders[key]


class ChunkEncoder:
    """``with_ids`` keeps the ids of each chunk, else only their number."""

    #: Chunks that the library holds at once, each as an object of some hundred bytes or more.
    batch = 2_000

    def __init__(self, path: str, with_ids: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        self.with_ids = with_ids
        self.seed = 0
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.counts = np.zeros(0, np.int32)
        self.first = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, data: np.ndarray, hashes: np.ndarray, checks, starts, ends) -> None:
        if len(self.keys) + len(hashes) > KEPT_CHUNKS:
            self._clear()
        raw = data.tobytes()
        counts, ids = np.zeros(len(hashes), np.int32), [self.ids]
        for at in range(0, len(hashes), self.batch):
            chunks = [
                raw[a:b].decode("utf-8", "replace")
                for a, b in zip(starts[at : at + self.batch], ends[at : at + self.batch], strict=True)
            ]
            counts[at : at + len(chunks)], made = self._found(chunks)
            ids.append(made)
        first = np.zeros(len(counts), np.int64)
        if self.with_ids:
            np.cumsum(counts[:-1], out=first[1:])
            first += len(self.ids)
            self.ids = np.concatenate(ids)
        keys = np.concatenate([self.keys, hashes])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.checks = np.concatenate([self.checks, checks])[order]
        self.counts = np.concatenate([self.counts, counts])[order]
        self.first = np.concatenate([self.first, first])[order]

    def _found(self, chunks: list[str]) -> tuple[list[int], np.ndarray | None]:
        """How many ids each chunk has, and, if wanted, the ids of all one after the other."""
        encoded = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        if not self.with_ids:
            return [len(e) for e in encoded], None
        ids = [e.ids for e in encoded]
        return [len(i) for i in ids], np.fromiter((k for i in ids for k in i), np.uint32)

    def places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where each chunk stands in ``counts`` and ``first``."""
        hashes, checks = span_hash_pairs(data, starts, ends, self.seed)
        distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        where = np.searchsorted(self.keys, distinct)
        if len(self.keys):
            new = self.keys[np.minimum(where, len(self.keys) - 1)] != distinct
        else:
            new = np.ones(len(distinct), bool)
        if new.any():
            if len(self.keys) + int(new.sum()) > KEPT_CHUNKS:
                new[:] = True  # the worker starts anew, with all chunks of this slice
            first = at[new]
            self._learn(data, distinct[new], checks[first], starts[first], ends[first])
            where = np.searchsorted(self.keys, distinct)
        places = where[inverse]
        if len(places) and np.any(self.checks[places] != checks):
            self.seed += 1  # two chunks share a hash: other hashes, from the beginning
            self._clear()
            return self.places(data, starts, ends)
        return places

    def counts_of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        place = self.places(data, starts, ends)
        return self.counts[place].astype(np.int64)

    def encode(self, data: np.ndarray, bounds: np.ndarray):
        """(ids of all rows one after the other, number of ids per row)"""
        starts, ends = chunk_spans(data, bounds)
        place = self.places(data, starts, ends)
        counts = self.counts[place].astype(np.int64)
        total = int(counts.sum())
        offsets = np.cumsum(counts) - counts
        index = np.arange(total) + np.repeat(self.first[place] - offsets, counts)
        rows = rows_of(bounds, starts)
        per_row = np.bincount(rows, weights=counts, minlength=len(bounds) - 1).astype(np.int64)
        return self.ids[index], per_row
