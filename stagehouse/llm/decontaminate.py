"""Benchmark decontamination with a BM25 index of test items and block-max pruning.

Test items are cut into units of at most ``UNIT_WORDS`` words, one every ``UNIT_STEP`` words, and so
are their question (all but the last sentence) and answer alone, if they have ``LEAST_SIDE`` shingles.
Units are indexed: for each word the units
that hold it with their BM25 weights, in runs of ``BLOCK_UNITS`` units, each run with its largest
weight.  Weights are divided by the unit's score for itself, so one threshold serves all units.

Every training passage is a query: windows of twice a unit's length that start at every unit's
length, so each unit lies whole in a window.  As in block-max WAND, the largest weights of the
passage's words are summed per block of units first; a block whose sum is below the threshold is
skipped, in the others each unit's exact score decides.  Items of units above the threshold are
verified by the share of their five-word shingles that the passage holds: ``overlap`` of the item,
``question_overlap`` and ``answer_overlap`` of the shingles that lie in one of its sides.  Of more than
``UNIT_WORDS`` words the best run of that many counts, wherever it starts; from one and a half times as
many words on, runs may hang over either end by up to half their length.  An item is leaked if 0.8
or more of it, or of a side with ``LEAST_SIDE`` shingles, is held.  Words are compared in lower case (A-Z),
without ASCII punctuation.

Items with fewer than five words, null and empty items and texts match nothing.  Repeated rows are
found each.  The index goes to the workers in parts of at most ``part_bytes`` of item text, one pass over the documents
per part, so it never outgrows them.  Document frequencies are those of all items.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagehouse.llm.storage import map_batches
from stagehouse.llm.text import MARKS, mix, rows_of, span_hashes, text_slices, word_spans

#: Block entries that are looked at together; bounds what a search holds, whatever the test items.
MOST_ENTRIES = 1 << 18
#: Bytes of passages that a task searches together.
PASSAGE_BYTES = 1 << 20
UNIT_WORDS, UNIT_STEP, SHINGLE, BLOCK_UNITS = 64, 16, 5, 16
#: Shingles that a question or an answer must have to be a leak without the other: eight words.
LEAST_SIDE = 4
K1, B = 1.2, 0.75
_STEP = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = (
    "doc_id long, item_id long, score double, overlap double, question_overlap double, "
    "answer_overlap double, first_word long"
)


def words_of(data: np.ndarray, bounds: np.ndarray):
    """(row of each word, hash of each word)"""
    starts, ends = word_spans(data, bounds, MARKS)
    return rows_of(bounds, starts), span_hashes(data, starts, ends)


def _words(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return words_of(data, np.array([0, len(data)]))[1]


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of every five words in a row."""
    n = max(0, len(words) - SHINGLE + 1)
    out = words[:n]
    for k in range(1, SHINGLE):
        out = mix(out * _STEP + words[k : n + k])
    return out


def split_answer(text: str) -> tuple[str, str]:
    """(question, answer): the answer is the last sentence, if there are two or more."""
    at = len(text.rstrip(" .!?\t\r\n\v\f"))
    while at > 0 and not (text[at - 1] in ".!?" and text[at : at + 1].isspace()):
        at -= 1
    return text[:at], text[at:]


def runs(n_words: int, step: int) -> list[tuple[int, int]]:
    """(first word, end) of runs of ``UNIT_WORDS`` of ``n_words`` words, one every ``step`` words and the
    last one.  Runs of long texts may hang over both ends."""
    over = UNIT_WORDS // 2 if n_words >= UNIT_WORDS + UNIT_WORDS // 2 else 0
    last = max(n_words - UNIT_WORDS, 0) + over
    starts = [*range(-over, last, step), last]
    return [(max(a, 0), min(a + UNIT_WORDS, n_words)) for a in starts]


def most_held(held: np.ndarray) -> float | None:
    """The largest share of shingles held in a run of words, ``held`` telling for each shingle."""
    if not len(held):
        return None
    first, end = np.array(runs(len(held) + SHINGLE - 1, 1)).T
    end = end - SHINGLE + 1
    sums = np.concatenate([[0], np.cumsum(held)])
    return float(((sums[end] - sums[first]) / (end - first)).max())


@dataclass
class Item:
    item_id: int
    words: np.ndarray
    n_question: int

    @classmethod
    def of(cls, item_id: int, text: str) -> Item:
        return cls(item_id, _words(text), len(_words(split_answer(text)[0])))

    def units(self) -> list[tuple[int, int]]:
        """(first word, end) of the runs of the item and of its sides."""
        n = len(self.words)
        out = set(runs(n, UNIT_STEP))
        for a, b in ((0, self.n_question), (self.n_question, n)):
            if b - a >= LEAST_SIDE + SHINGLE - 1:
                out |= {(a + c, a + d) for c, d in runs(b - a, UNIT_STEP)}
        return sorted(out)

    def overlaps(self, held: np.ndarray) -> list[float | None]:
        """[item's, question's, answer's] overlap; ``held`` tells for each shingle of the item."""
        question = held[: max(self.n_question - SHINGLE + 1, 0)]
        return [most_held(x) for x in (held, question, held[self.n_question :])]

    def is_leaked(self, held: np.ndarray, overlaps: list[float | None], least: float) -> bool:
        sizes = (LEAST_SIDE, self.n_question - SHINGLE + 1, len(held) - self.n_question)
        return any(
            share is not None and share >= least and size >= LEAST_SIDE
            for share, size in zip(overlaps, sizes, strict=True)
        )


@dataclass
class Units:
    """Test items, their shingles, and their units: number of the item, words."""

    items: list[Item]
    shingles: list[np.ndarray]
    item: list[int]
    words: list[np.ndarray]

    @classmethod
    def of(cls, items: list[tuple[int, str]]) -> Units:
        out = cls([], [], [], [])
        for item in (Item.of(*i) for i in items):
            if len(item.words) < SHINGLE:
                continue
            for a, b in item.units():
                out.item.append(len(out.items))
                out.words.append(item.words[a:b])
            out.items.append(item)
            out.shingles.append(shingles(item.words))
        return out


@dataclass
class BlockMaxIndex:
    vocabulary: np.ndarray  # hashes, ascending
    block_first: np.ndarray  # by word: its first entry in block and block_most
    block: np.ndarray
    block_most: np.ndarray
    posting_first: np.ndarray  # by entry of block: its first posting
    unit: np.ndarray
    weight: np.ndarray
    units: Units

    @classmethod
    def build(cls, units: Units, frequency: dict[int, int], n_items: int, mean_words: float):
        rows = []
        for u, words in enumerate(units.words):
            terms, counts = np.unique(words, return_counts=True)
            seen = np.array([frequency[int(t)] for t in terms.view(np.int64)])
            idf = np.log1p((n_items - seen + 0.5) / (seen + 0.5))
            length = 1 - B + B * len(words) / mean_words
            weight = idf * counts * (K1 + 1) / (counts + K1 * length)
            rows.append((terms, np.full(len(terms), u), weight / weight.sum()))
        empty = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0))
        terms, unit, weight = (np.concatenate(x) for x in zip(*(rows or [empty]), strict=True))
        order = np.lexsort((unit, terms))
        terms, unit, weight = terms[order], unit[order], weight[order]
        vocabulary, word = np.unique(terms, return_inverse=True)
        run = word * (len(units.words) // BLOCK_UNITS + 1) + unit // BLOCK_UNITS
        _, first = np.unique(run, return_index=True)
        most = np.maximum.reduceat(weight, first) if len(first) else weight
        return cls(
            vocabulary,
            np.searchsorted(word[first], np.arange(len(vocabulary) + 1)),
            unit[first] // BLOCK_UNITS,
            most,
            np.append(first, len(unit)),
            unit,
            weight,
            units,
        )


def _expand(first: np.ndarray, last: np.ndarray):
    """(source, entry) for all entries first..last-1 of each source."""
    count = last - first
    source = np.repeat(np.arange(len(first)), count)
    entry = np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)
    return source, entry


def search(index: BlockMaxIndex, rows: np.ndarray, words: np.ndarray, threshold: float):
    """(passage's first word, its last, unit, score) of all passages at or above the threshold.
    A passage is a window of a row's words."""
    none = np.zeros(0, np.int64)
    if not len(words) or not len(index.vocabulary):
        return none, none, none, np.zeros(0)
    row_first = np.searchsorted(rows, rows)  # the first word of each word's row
    cell = (np.arange(len(words)) - row_first) // UNIT_WORDS
    opens = np.ones(len(words), bool)
    opens[1:] = (rows[1:] != rows[:-1]) | (cell[1:] != cell[:-1])
    cell_first = np.flatnonzero(opens)
    number = np.cumsum(opens) - 1
    cell_row = rows[cell_first]
    where = np.searchsorted(index.vocabulary, words)
    where[where == len(index.vocabulary)] = 0
    known = index.vocabulary[where] == words
    number, where = number[known], where[known]
    follows = np.zeros(len(cell_first), bool)
    follows[1:] = cell_row[1:] == cell_row[:-1]
    second = follows[number]  # the word also stands in the window that the cell before opens
    passage = np.concatenate([number, number[second] - 1])
    term = np.concatenate([where, where[second]])
    size = len(index.vocabulary)
    pair = np.unique(passage * size + term)
    passage, term = pair // size, pair % size
    found = [
        _scored(index, passage[low:high], term[low:high], threshold)
        for low, high in _portions(passage, np.diff(index.block_first)[term])
    ]
    passage, unit, score = (np.concatenate(parts) for parts in zip(*found, strict=True))
    first = cell_first[passage]
    row_end = np.searchsorted(rows, rows[first], "right")
    return first, np.minimum(first + 2 * UNIT_WORDS, row_end), unit, score


def _portions(passage: np.ndarray, entries: np.ndarray) -> list[tuple[int, int]]:
    """Runs of whole passages with about ``MOST_ENTRIES`` block entries together, or one passage."""
    after = np.cumsum(entries)
    ends = np.append(np.flatnonzero(np.diff(passage)) + 1, len(passage))  # ends of passages
    out, low = [], 0
    while low < len(passage):
        most = (after[low - 1] if low else 0) + MOST_ENTRIES
        at = int(np.searchsorted(after[ends - 1], most, "right")) - 1
        high = int(ends[max(at, np.searchsorted(ends, low, "right"))])
        out.append((low, high))
        low = high
    return out or [(0, 0)]


def _scored(index: BlockMaxIndex, passage: np.ndarray, term: np.ndarray, threshold: float):
    """(passage, unit, score) of the pairs at the threshold or above.  Block maxima are summed for all
    terms of a passage first; only postings of blocks whose sum reaches the threshold are looked at."""
    blocks = int(index.block.max()) + 1
    source, entry = _expand(index.block_first[term], index.block_first[term + 1])
    cell, key = np.unique(passage[source] * blocks + index.block[entry], return_inverse=True)
    open_ = np.bincount(key, weights=index.block_most[entry])[key] >= threshold - 1e-9
    key, entry = cell[key[open_]], entry[open_]
    source, posting = _expand(index.posting_first[entry], index.posting_first[entry + 1])
    n_units = len(index.units.words)
    key = (key[source] // blocks) * n_units + index.unit[posting]
    distinct, inverse = np.unique(key, return_inverse=True)
    score = np.bincount(inverse, weights=index.weight[posting], minlength=len(distinct))
    good = score >= threshold - 1e-9
    return distinct[good] // n_units, distinct[good] % n_units, score[good]


def leaks_of(index: BlockMaxIndex, data, bounds, threshold: float, least_overlap: float):
    """(row, item, score, overlap, question overlap, answer overlap, first word), the best passage
    of each row and item."""
    rows, words = words_of(data, bounds)
    units = index.units
    near: dict[tuple[int, int], tuple[int, float]] = {}  # one test per passage and item
    for first, last, unit, score in zip(
        *search(index, rows, words, threshold), strict=True
    ):
        key = int(first), units.item[unit]
        near[key] = int(last), max(float(score), near.get(key, (0, 0.0))[1])
    best: dict[tuple[int, int], tuple] = {}
    for (first, number), (last, score) in near.items():
        item = units.items[number]
        held = np.isin(units.shingles[number], shingles(words[first:last]))
        overlaps = item.overlaps(held)
        if not item.is_leaked(held, overlaps, least_overlap):
            continue
        key = row, _ = int(rows[first]), item.item_id
        found = (score, *overlaps, first - int(np.searchsorted(rows, row)))
        if key not in best or best[key][:2] < found[:2]:
            best[key] = found
    return [(*key, *found) for key, found in sorted(best.items())]


def build_indexes(items: DataFrame, part_bytes: int = 4 << 20) -> list[BlockMaxIndex]:
    """One index per part of the items (item_id, text), with frequencies over all of them."""
    items = items.selectExpr("CAST(item_id AS long) AS item_id", "text").where(
        "text IS NOT NULL AND item_id IS NOT NULL"
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = math.ceil(size / part_bytes)

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = Units.of(list(zip(*(c.to_pylist() for c in batch.columns), strict=True)))
            for item in units.items:
                term = np.unique(item.words).view(np.int64)
                length = min(len(item.words), UNIT_WORDS)
                yield pa.RecordBatch.from_pydict(
                    {"term": term, "n": np.where(np.arange(len(term)) == 0, length, 0)}
                )

    found = map_batches(items, terms, "term long, n long")
    n_items, mean = found.agg(
        F.count(F.when(F.col("n") > 0, 1)), F.sum("n") / F.count(F.when(F.col("n") > 0, 1))
    ).first()
    frequency = found.groupBy("term").agg(F.count("*").alias("seen"))
    out = []
    for part in range(parts):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        units = Units.of([tuple(r) for r in mine.distinct().orderBy("item_id", "text").collect()])
        own = map_batches(mine, terms, "term long, n long").select("term").distinct()
        seen = dict(tuple(r) for r in own.join(frequency, "term").collect())
        out.append(BlockMaxIndex.build(units, seen, n_items, mean or 1.0))
    return out


def find_leaks(
    docs: DataFrame, items: DataFrame, *, threshold: float = 0.5, least_overlap: float = 0.8
) -> DataFrame:
    """One row per document and test item that it leaks."""
    layout = pa.schema(
        [("doc_id", pa.int64()), ("item_id", pa.int64())]
        + [(n, pa.float64()) for n in ("score", "overlap", "question_overlap", "answer_overlap")]
        + [("first_word", pa.int64())]
    )
    docs = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text")

    def over(index: BlockMaxIndex) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)  # at most one part of the items

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, data, bounds in text_slices(batches, limit=PASSAGE_BYTES):
                found = leaks_of(shared.value, data, bounds, threshold, least_overlap)
                ids = part.column(0)
                rows = [(ids[row].as_py(), *rest) for row, *rest in found]
                columns = zip(*rows, strict=True) if rows else [[]] * len(layout)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, layout, strict=True)],
                    schema=layout,
                )

        return map_batches(docs, find, SCHEMA)

    indexes = build_indexes(items)
    if not indexes:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    return reduce(DataFrame.union, map(over, indexes))


def drop_leaking(
    docs: DataFrame, items: DataFrame, *, threshold: float = 0.5, least_overlap: float = 0.8
) -> DataFrame:
    """The rows of ``docs`` that leak no test item; one pass, no join."""
    for index in build_indexes(items):
        docs = _without(docs, index, threshold, least_overlap)
    return docs


def _without(docs: DataFrame, index: BlockMaxIndex, threshold: float, least: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in text_slices(batches, limit=PASSAGE_BYTES):
            clean = np.ones(part.num_rows, bool)
            clean[[row for row, *_ in leaks_of(shared.value, data, bounds, threshold, least)]] = False
            yield part.filter(pa.array(clean))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return map_batches(docs, keep, ", ".join(fields))
