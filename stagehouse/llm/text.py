"""Words and chunks of whole texts, as arrays over the bytes of Arrow batches.

A word is known by a 64-bit hash of its bytes, mixed eight bytes at a time for all words of a batch
together, so no Python object is made per word; only words of over ``LONG_SPAN`` bytes go one by one
through BLAKE2.  Two words of one comparison share a hash with a chance of about 1 in 10^19.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
LONG_SPAN = 128
_STEP = np.uint64(0x9E3779B97F4A7C15)
_OTHER_STEP = np.uint64(0xD6E8FEB86659FD93)
_EIGHT = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)  # masks of the last bytes

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(9, 14)]] = True
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".,;:!?"]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[b for b in range(128) if chr(b).isalnum()]] = True
#: Every ASCII byte that is no letter or digit.
MARKS = np.zeros(256, bool)
MARKS[[b for b in range(128) if not chr(b).isalnum()]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


#: What a byte counts as: itself, or its lower-case letter.
EXACT_BYTES = np.arange(256, dtype=np.uint8)
LOWER_BYTES = EXACT_BYTES.copy()
LOWER_BYTES[65:91] += 32


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of the batches with about ``limit`` bytes of text, or one row.  Each comes with its
    bytes and the bounds of its rows; null texts are empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
        if texts.null_count:
            texts = texts.fill_null("")
        _, bounds, data = texts.buffers()
        bounds = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            part = bounds[at : to + 1]
            yield batch.slice(at, to - at), data[part[0] : part[-1]], part - part[0]
            at = to
        del batch, texts, bounds, data, part
        give_back()


def give_back() -> None:
    """Free memory goes back to the machine: a Python worker outlives its task beside a JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_libc(), "malloc_trim", None)
    if trim is not None:
        trim(0)


@lru_cache(1)
def _libc():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:  # another C library, which has no such call
        return None


def word_spans(
    data: np.ndarray, bounds: np.ndarray, separators: np.ndarray = SPACES
) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of bytes that are no separators; runs end with their row."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = edge[:-1].copy()
    before[1:] |= ~inside[:-1]
    after = edge[1:].copy()
    after[:-1] |= ~inside[1:]
    return np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1


def chunk_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks that a tokenizer treats alike alone and in their text: a new one starts at every
    blank, tab or line end that follows no white space of any kind, and at stops after ASCII
    letters and digits.  (Some characters of two and three bytes count as white space here; that
    only makes chunks longer.)"""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.zeros(len(data), bool)
    starts[1:] = (data[1:] == 32) | ((data[1:] >= 9) & (data[1:] <= 13))
    maybe_space = (data <= 32) & ((data == 32) | ((data >= 9) & (data <= 13)) | (data >= 28))
    high = data >= 128
    maybe_space[1:] |= high[1:] & (data[:-1] == 0xC2)
    maybe_space[2:] |= high[2:] & (data[:-2] >= 0xE1) & (data[:-2] <= 0xE3)
    starts[1:] &= ~maybe_space[:-1]
    starts[1:] |= _STOPS[data[1:]] & _ALNUM[data[:-1]]
    starts[bounds[:-1][bounds[:-1] < len(data)]] = True
    first = np.flatnonzero(starts)
    return first, np.append(first[1:], len(data))


def span_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = LOWER_BYTES
) -> np.ndarray:
    """A hash of the bytes of each span.  Every step is a bijection of the hash so far and of the eight
    bytes taken in, so spans that differ in one place only never share a hash."""
    return _hashed(data, starts, ends, values, 0, False)[0]


def span_hash_pairs(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the exact bytes of each span, made by different steps."""
    return _hashed(data, starts, ends, EXACT_BYTES, seed, True)


def _hashed(data, starts, ends, values, seed: int, second: bool):
    size = (ends - starts).astype(np.int64)
    out = mix((size.astype(np.uint64) + np.uint64(1 + seed)) * _STEP)
    other = out + _STEP if second else None
    if not len(data):
        return out, other
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data if values is EXACT_BYTES else values[data]
    words = np.ndarray(len(data), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    active, at = np.flatnonzero((size > 0) & (size <= LONG_SPAN)), 0
    while len(active):
        left = size[active] - at
        taken = mix((words[starts[active] + at] & _EIGHT[np.minimum(left, 8)]) + _STEP)
        if second:
            so_far = other[active] * _OTHER_STEP
            other[active] = (so_far ^ (so_far >> np.uint64(29))) + taken
        out[active] = mix((out[active] ^ taken) * _STEP + np.uint64(at + 1))
        at += 8
        active = active[left > 8]
    for i in np.flatnonzero(size > LONG_SPAN):
        raw = padded[starts[i] : ends[i]].tobytes()
        digest = hashlib.blake2b(raw, digest_size=16, key=seed.to_bytes(8, "little")).digest()
        out[i] = int.from_bytes(digest[:8], "little")
        if second:
            other[i] = int.from_bytes(digest[8:], "little")
    return out, other


def rows_of(bounds: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The row that holds each position."""
    return np.searchsorted(bounds, starts, "right") - 1
