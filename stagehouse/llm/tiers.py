"""Hierarchical packing into several context sizes.

Documents are encoded and packed within their partition, window by window; nothing is shuffled.
A document longer than the largest tier gives whole windows of that size; the rest of it, like any
shorter document, goes to the smallest tier that holds it.  Tiers are packed from the longest down,
each best-fit-decreasing; the gaps of a tier's windows are filled with the largest fitting
documents of shorter tiers, at last with a cut one whose rest returns to its tier.  So every window
is full.  What the last window of a partition lacks is avoided by closing with smaller powers of
two, which need no padding.  Windows of a tier are dealt to step groups of equal token budget in
order of their attention cost, back and forth, so that no group gets the costly ones.

Null and empty texts give the end id alone.  Repeated rows are packed each; a null id stays null.
Columns beside the id and the text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagehouse.llm.best_fit import CapacityTree, best_fit, encoded_documents, first_sequence_id
from stagehouse.llm.storage import map_batches
from stagehouse.llm.encoding import tokenizer_path
from stagehouse.llm.text import give_back

TIERS = (512, 1024, 2048, 4096)
LAYOUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("tier", pa.int32()),
        ("step_group", pa.int64()),
    ]
)
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, tier int, step_group long"
)
Piece = tuple[int, int, int]  # document of the window, first id, number of ids


def route(lengths: list[int], tiers: tuple[int, ...]) -> tuple[list[list[Piece]], dict]:
    """Whole windows of the largest tier, and the pieces that each tier is to pack."""
    largest, windows, pools = tiers[-1], [], {t: [] for t in tiers}
    for i, n in enumerate(lengths):
        full = n // largest * largest
        windows += [[(i, a, largest)] for a in range(0, full, largest)]
        if n > full:
            tier = next(t for t in tiers if t >= n - full)
            pools[tier].append((i, full, n - full))
    return windows, pools


def pack_tiers(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[Piece]]]:
    """(window size, its pieces): every window is full, and its size is a tier or, for the last
    ones, a smaller power of two."""
    whole, pools = route(lengths, tiers)
    out = [(tiers[-1], w) for w in whole]
    shorter = {t: CapacityTree(t) for t in tiers}
    pieces: list[Piece] = []

    def put(piece: Piece) -> None:
        tier = next(t for t in tiers if t >= piece[2])
        shorter[tier].add(piece[2], len(pieces))
        pieces.append(piece)

    for tier in tiers[:-1]:
        for piece in pools[tier]:
            put(piece)
    for k in range(len(tiers) - 1, -1, -1):
        size = tiers[k]
        own = list(pools[size]) if k == len(tiers) - 1 else []
        while k < len(tiers) - 1 and (found := shorter[size].take_below(size)):
            own.append(pieces[found[1]])
        below = tiers[:k] if k else ()
        bins = best_fit([p[2] for p in own], size)
        packed = [[own[i] for i in b] for b in bins]
        room = [size - sum(p[2] for p in w) for w in packed]
        for w in range(len(packed)):
            gap = room[w]
            while gap:
                best = _largest(shorter, below, gap)
                if best is not None:
                    packed[w].append(pieces[best])
                    gap -= pieces[best][2]
                    continue
                longer = _smallest_above(shorter, below, gap)
                if longer is None:
                    break
                doc, start, n = pieces[longer]
                packed[w].append((doc, start, gap))
                put((doc, start + gap, n - gap))
                gap = 0
            room[w] = gap
        full = [w for w, gap in zip(packed, room, strict=True) if not gap]
        open_windows = [w for w, gap in zip(packed, room, strict=True) if gap]
        merged, rest = refill(open_windows, size)
        out += [(size, w) for w in full + merged]
        if k:
            for piece in rest:
                while piece[2] > tiers[k - 1]:
                    put((piece[0], piece[1], tiers[k - 1]))
                    piece = (piece[0], piece[1] + tiers[k - 1], piece[2] - tiers[k - 1])
                put(piece)
        else:
            out += close(rest, size)
    return out


def _largest(trees: dict, below: tuple[int, ...], gap: int) -> int | None:
    """The largest piece of the shorter tiers that fits the gap, taken from its tier."""
    for tier in reversed(below):
        if len(trees[tier]) and (found := trees[tier].take_below(min(gap, tier))):
            return found[1]
    return None


def _smallest_above(trees: dict, below: tuple[int, ...], gap: int) -> int | None:
    for tier in below:
        if tier > gap and (found := trees[tier].take(gap)):
            return found[1]
    return None


def refill(windows: list[list[Piece]], size: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Fills windows from the pieces of others, cutting where one ends; and what is left over."""
    full, now, room = [], [], size
    for doc, start, n in (p for w in windows for p in w):
        while n:
            take = min(n, room)
            now.append((doc, start, take))
            start, n, room = start + take, n - take, room - take
            if not room:
                full.append(now)
                now, room = [], size
    return full, now


def close(pieces: list[Piece], size: int) -> list[tuple[int, list[Piece]]]:
    """The last pieces in windows of falling powers of two, so that none is padded."""
    out = []
    while pieces:
        total = sum(n for *_, n in pieces)
        size = min(size, 1 << (total.bit_length() - 1))
        full, _ = refill([pieces], size)
        out += [(size, full[0])]
        taken, rest = size, []
        for doc, start, n in pieces:
            cut = min(n, taken)
            taken -= cut
            if cut < n:
                rest.append((doc, start + cut, n - cut))
        pieces = rest
    return out


def step_groups(
    windows: list[tuple[int, list[Piece]]], tokens: int, first: int
) -> tuple[list[int], int]:
    """A step group per window: windows of one size, equal tokens, even attention cost."""
    by_size: dict[int, list[int]] = {}
    for i, (size, _) in enumerate(windows):
        by_size.setdefault(size, []).append(i)
    group = [0] * len(windows)
    for size, members in sorted(by_size.items(), reverse=True):
        members.sort(key=lambda i: (-sum(n * n for *_, n in windows[i][1]), i))
        groups = max(1, round(len(members) * size / tokens))
        for rank, i in enumerate(members):
            turn, place = divmod(rank, groups)
            group[i] = first + (groups - 1 - place if turn % 2 else place)
        first += groups
    return group, first


def pack_documents(
    docs: DataFrame,
    *,
    tokenizer: str | None = None,
    end_id: int = 2,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = 32_768,
    window_tokens: int = 4_000_000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece of a document (see the module's text).  ``start`` counts the document's
    ids before the piece, ``offset`` the window's."""
    path = tokenizer or tokenizer_path("word_bpe_49k.json")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = group = first_sequence_id()
        window: list[tuple[int | None, np.ndarray]] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, group, window, held
            packed = pack_tiers([len(ids) for _, ids in window], tiers)
            groups, group = step_groups(packed, step_tokens, group)
            rows = []
            for (size, pieces), step in zip(packed, groups, strict=True):
                offset = 0
                for i, start, n in pieces:
                    doc_id, ids = window[i]
                    crc = zlib.crc32(ids[start : start + n].astype("<u4").tobytes())
                    rows.append((doc_id, start, n, crc, len(ids), number, offset, size, step))
                    offset += n
                number += 1
            window, held, packed = [], 0, []
            for at in range(0, len(rows), 20_000):
                columns = zip(*rows[at : at + 20_000], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, LAYOUT, strict=True)],
                    schema=LAYOUT,
                )
            del rows, groups
            give_back()

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
