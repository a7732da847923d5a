"""Similarity join on word shingles, with signatures of token combinations.

A document's set holds the hashes of its distinct shingles.  All sets order shingles alike, by how
many of all sets fall into their slots: rare ones first.  Two sets of similarity t or more differ by
at most m = n - ceil(t n) shingles of either, so they share a shingle among the first m + 1.  Shingles of frequent classes are poor
signatures (a passage that many documents share), so they are indexed in pairs: the prefix is
extended until rare shingles, plus the frequent ones of each of ``GROUPS`` groups less one per
group, make m + 1; then the sets share a rare shingle or two frequent ones of a group.  Sets too
small for that, and huge ones with too many pairs, index single shingles; sizes near those borders
do both, so that any two sets that may be linked have one way in common.

Equal sets are one node.  Nodes under one signature form a bucket.  No bucket is expanded into
pairs: its members are compared with a hub, the member with the fewest rare shingles (the text
that near copies came from), and only those not linked to it are compared with the others: within
the task that holds a small bucket, block by block in large ones; only pairs that may be links become
rows.  Each is compared with its likeliest partner first, then with those it is not connected with yet.  A comparison looks at parities first: bit i tells whether a
set has an odd number of shingles in slot i, so two sets differ by at least as many shingles as
their parities by bits.  What may still be similar is looked at again in finer parities, whose bound
is closer, and then decided on the whole sets.  So every link between different texts counts for
the components, though not each is listed.

Words are runs of anything but blank, tab and line ends; A-Z are lower-cased.  A text with fewer
words than a shingle is one shingle; null texts and texts without words are empty and linked with
nothing.  Repeated rows get the same class.  A null id is the smallest of no class.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagehouse.llm.graph import components
from stagehouse.llm.storage import dropped, inner_names, map_batches, own_names, written
from stagehouse.llm.text import give_back, mix, rows_of, span_hashes, text_slices, word_spans

SLOT_BITS = 19
FILTER_BITS = 20
GROUPS = 64
LEAST_PAIRED, MOST_PAIRED = 80, 50_000
SMALL_BUCKET, BLOCK_MEMBERS = 32, 256
LEAST_PARITY_BITS = 1024
#: Slots per shingle of the finer parities; they take an eighth to a quarter of a large set's bytes.
FINE_SLOTS = 8
#: Rounds in which only likeliest partners are compared, before all that are left are.
ROUNDS = 1
_GROUP = ("sig", "class", "r", "c")  # what a group of blocks is known by
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, n: int):
    """(bounds of each row's set, shingles ascending within a row) of a slice."""
    starts, ends = word_spans(data, bounds)
    words = span_hashes(data, starts, ends)
    rows = rows_of(bounds, starts)
    count = np.bincount(rows, minlength=len(bounds) - 1)
    place = np.arange(len(words)) - np.repeat(np.cumsum(count) - count, count)
    left = np.repeat(count, count) - place  # words from here to the row's end
    out = words.copy()
    for k in range(1, n):
        more = np.flatnonzero(left > k)
        out[more] = mix(out[more] * _STEP + words[more + k])
    keep = (left >= n) | (place == 0)
    rows, out = rows[keep], out[keep]
    cut = np.searchsorted(rows, np.arange(len(bounds)))
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        out[a:b].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (out[1:] != out[:-1])
    rows, out = rows[fresh], out[fresh]
    return np.searchsorted(rows, np.arange(len(bounds))), out


def set_keys(cut: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """One number per set, the same for equal sets."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles ^ _PAIR))])
    return mix(sums[cut[1:]] - sums[cut[:-1]]).view(np.int64)


def _slot(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def summarize(docs: DataFrame, n: int) -> DataFrame:
    """Two kinds of rows: (doc_id, tag, key, n_shingles) per document (doc_id, tag, text), and, per task, how many
    shingles fell into each of 2^SLOT_BITS slots (slot, total)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for part, data, bounds in text_slices(batches):
            cut, shingles = shingle_sets(data, bounds, n)
            total += np.bincount(_slot(shingles, SLOT_BITS), minlength=len(total))
            size = np.diff(cut)
            yield _record(
                doc_id=part.column(0),
                tag=part.column(1),
                key=pa.array(set_keys(cut, shingles), mask=size == 0),
                n_shingles=pa.array(size),
                slot=pa.nulls(len(size), pa.int64()),
                total=pa.nulls(len(size), pa.int64()),
            )
        used = np.flatnonzero(total)
        none = pa.nulls(len(used), pa.int64())
        yield _record(
            doc_id=none,
            tag=none,
            key=none,
            n_shingles=none,
            slot=pa.array(used),
            total=pa.array(total[used]),
        )

    return map_batches(
        docs, rows, "doc_id long, tag long, key long, n_shingles long, slot long, total long"
    )


def _record(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def slot_counts(summary: DataFrame) -> np.ndarray:
    """How many shingles of all sets each slot holds, 2^SLOT_BITS counts: a fixed size, whatever the
    input."""
    sums = summary.where("slot IS NOT NULL").groupBy("slot").agg(F.sum("total").alias("total"))
    found = sums.toArrow()
    out = np.zeros(1 << SLOT_BITS, np.int64)
    out[found["slot"].to_numpy()] = found["total"].to_numpy()
    del found
    give_back()
    return out


def frequent_from(counts: np.ndarray) -> int:
    """The least count that is clearly more than chance would give a slot."""
    mean = counts.mean()
    return int(mean + 5 * np.sqrt(mean) + 8) + 1


def signatures_of(shingles: np.ndarray, counts: np.ndarray, frequent: int, percent: int):
    """(signatures, rare shingles in the prefix) of one set.  Shingles of the emptiest slots come
    first, among the rare ones too: a passage that some documents share fills its slots a little, and
    would make a bucket of those documents wherever it came first."""
    n = len(shingles)
    spare = n - (percent * n + 99) // 100
    count = counts[_slot(shingles, SLOT_BITS)]
    order = np.argsort(count, kind="stable")
    ordered, often = shingles[order], count[order] >= frequent
    rare = int((~often[: spare + 1]).sum())
    out = []
    if n * percent < LEAST_PAIRED * 100 or n * 100 > MOST_PAIRED * percent:
        out.append(ordered[: spare + 1])
    if LEAST_PAIRED <= n <= MOST_PAIRED:
        first = n - int(often.sum())
        if first > spare:
            out.append(ordered[: spare + 1])
        else:
            group = (ordered[first:] % np.uint64(GROUPS)).astype(np.int64)
            seen = np.ones(len(group), np.int64)
            seen[np.unique(group, return_index=True)[1]] = 0
            enough = int(np.searchsorted(np.cumsum(seen), spare + 1 - first)) + 1
            out.append(ordered[:first])
            chosen, group = ordered[first : first + enough], group[:enough]
            for g in np.unique(group):
                own = np.sort(chosen[group == g])
                a, b = np.triu_indices(len(own), 1)
                out.append(mix(own[a] * _PAIR + own[b]))
    return np.unique(np.concatenate(out)), rare


def signatures(docs: DataFrame, counts: np.ndarray, n: int, percent: int) -> DataFrame:
    """(sig, key, n, rare): the signatures of every document's set."""
    context = docs.sparkSession.sparkContext
    frequent = frequent_from(counts)
    slots = context.broadcast(counts)  # 2^SLOT_BITS numbers

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, bounds in text_slices(batches):
            cut, shingles = shingle_sets(data, bounds, n)
            keys = set_keys(cut, shingles)
            done: set[int] = set()
            sigs, key, size, rare = [], [], [], []
            for i in np.flatnonzero(np.diff(cut)):
                if int(keys[i]) in done:
                    continue
                done.add(int(keys[i]))
                own = shingles[cut[i] : cut[i + 1]]
                found, few = signatures_of(own, slots.value, frequent, percent)
                sigs.append(found)
                key.append(np.full(len(found), keys[i]))
                size.append(np.full(len(found), cut[i + 1] - cut[i], np.int32))
                rare.append(np.full(len(found), few, np.int32))
            if sigs:
                yield _record(
                    sig=pa.array(np.concatenate(sigs).view(np.int64)),
                    key=pa.array(np.concatenate(key)),
                    n=pa.array(np.concatenate(size)),
                    rare=pa.array(np.concatenate(rare)),
                )

    return map_batches(docs.select("text"), rows, "sig long, key long, n int, rare int")


def shared_signatures(sigs: DataFrame) -> DataFrame:
    """The rows of ``sigs`` (sig, key, n, rare), each once, whose signature two sets or more have.  One shuffle:
    rows of a signature stand together, in the order of their keys, and only the last one waits for
    the next, so a task holds one batch, however many sets share a signature."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, is_shared = None, False  # the last row, and whether the one before has its signature
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            if held is not None:
                now = pa.concat_tables([held, now])
            sig, key = (now[c].to_numpy() for c in ("sig", "key"))
            again = (sig[1:] == sig[:-1]) & (key[1:] == key[:-1])
            once = np.concatenate([[True], ~again])
            now, sig = now.filter(pa.array(once)), sig[once]
            same = sig[1:] == sig[:-1]
            before = np.concatenate([[is_shared], same])
            yield from now.slice(0, len(sig) - 1).filter(pa.array(before[:-1] | same)).to_batches()
            held, is_shared = now.slice(len(sig) - 1), bool(before[-1])
            held = pa.Table.from_pylist(held.to_pylist(), held.schema)  # not a view of the batch
            del batch, now
            give_back()
        if is_shared:
            yield from held.to_batches()

    dealt = sigs.repartition("sig").sortWithinPartitions("sig", "key")
    return map_batches(dealt, rows, "sig long, key long, n int, rare int")


def _bits(keys: DataFrame) -> np.ndarray:
    """A bit per slot of keys, 2^FILTER_BITS of them: which sets may be wanted."""
    slots = keys.select(F.expr(f"shiftrightunsigned(key, {64 - FILTER_BITS})").alias("slot"))
    out = np.zeros(1 << FILTER_BITS, bool)
    out[slots.distinct().toArrow()["slot"].to_numpy()] = True
    give_back()
    return np.packbits(out)


def _has_bit(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = _slot(keys.view(np.uint64), FILTER_BITS)
    return (packed[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 > 0


def parity_of(shingles: np.ndarray, slots_each: int = 1) -> bytes:
    """One bit per slot; at least ``slots_each`` (a power of 2) times as many slots as shingles, so
    that large sets differ visibly."""
    bits = max(LEAST_PARITY_BITS, slots_each << (len(shingles) - 1).bit_length())
    slots = np.bincount((shingles % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits(slots & 1).tobytes()


def fine_parity_of(shingles: np.ndarray) -> bytes:
    return parity_of(shingles, FINE_SLOTS)


def folded(parity: bytes, size: int) -> np.ndarray:
    """The same parity over fewer slots, ``size`` bytes."""
    return np.bitwise_xor.reduce(np.frombuffer(parity, np.uint8).reshape(-1, size), axis=0)


def parity_difference(a: bytes, b: bytes) -> int:
    size = min(len(a), len(b))
    return int(np.bitwise_count(folded(a, size) ^ folded(b, size)).sum())


def _wanted(docs: DataFrame, keys: DataFrame, n: int, columns: dict) -> DataFrame:
    """(key, then the binary ``columns``, each a function of a set) of the documents whose key may be in
    ``keys``; copies once per slice."""
    wanted = docs.sparkSession.sparkContext.broadcast(_bits(keys))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, bounds in text_slices(batches):
            cut, shingles = shingle_sets(data, bounds, n)
            keys = set_keys(cut, shingles)
            pick = np.flatnonzero((np.diff(cut) > 0) & _has_bit(wanted.value, keys))
            pick = pick[np.unique(keys[pick], return_index=True)[1]]
            found = [shingles[cut[i] : cut[i + 1]] for i in pick]
            yield _record(
                key=pa.array(keys[pick]),
                **{c: pa.array([of(f) for f in found], pa.binary()) for c, of in columns.items()},
            )

    schema = ", ".join(["key long", *(f"{c} binary" for c in columns)])
    return map_batches(docs.select("text"), rows, schema)


def candidate_sets(docs: DataFrame, keys: DataFrame, n: int) -> DataFrame:
    """(key, parity, fine) of the documents whose key may be in ``keys``."""
    return _wanted(docs, keys, n, {"parity": parity_of, "fine": fine_parity_of})


def whole_sets(docs: DataFrame, keys: DataFrame, n: int) -> DataFrame:
    """(key, shingles) likewise: made anew from the texts whenever whole sets are compared, since all of
    them together take more room than the texts."""
    return _wanted(docs, keys, n, {"shingles": np.ndarray.tobytes})


def _set(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint64)


def is_linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _differ_at_most(sizes, percent: int):
    """The most shingles by which two linked sets of these sizes together can differ."""
    return sizes * (100 - percent) // (100 + percent)


def _side(sets: DataFrame, column: str, key: str, value: str) -> DataFrame:
    once = sets.groupBy("key").agg(F.min(column).alias(value))
    return once.select(F.col("key").alias(key), value)


def likely(pairs: DataFrame, sets: DataFrame, percent: int, column: str = "parity") -> DataFrame:
    """The rows of ``pairs`` (a, b, sizes) whose parities in ``column`` allow a link, as
    (a, b, sizes, differ)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column(3), batch.column(4), strict=True)
            differ = np.array([parity_difference(a.as_py(), b.as_py()) for a, b in sides], int)
            keep = differ <= _differ_at_most(batch.column(2).to_numpy(), percent)
            a, b, sizes = (batch.column(i) for i in range(3))
            yield _record(a=a, b=b, sizes=sizes, differ=pa.array(differ)).filter(pa.array(keep))
            del batch, sides, a, b, sizes
            give_back()

    both = pairs.join(_side(sets, column, "a", "left"), "a").join(
        _side(sets, column, "b", "right"), "b"
    )
    return map_batches(
        both.select("a", "b", F.col("sizes").cast("long"), "left", "right"),
        rows,
        "a long, b long, sizes long, differ long",
    )


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("key")).union(pairs.select("b"))


def _named(sets: DataFrame, column: str, pairs: DataFrame) -> DataFrame:
    """(key, ``column``) of the sets that ``pairs``, a written table, may name."""
    wanted = pairs.sparkSession.sparkContext.broadcast(_bits(_ends(pairs)))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = _has_bit(wanted.value, np.asarray(batch.column(0), np.int64))
            yield batch.filter(pa.array(keep))
            del batch
            give_back()

    return map_batches(sets.select("key", column), named, f"key long, {column} binary")


def linked(
    pairs: DataFrame, sets: DataFrame, docs: DataFrame, n: int, percent: int
) -> DataFrame:
    """The rows of ``pairs`` (a, b, sizes; a written table) whose sets are similar, as (a, b).  Whole
    sets are made and moved only for pairs that the finer parities allow."""
    near = likely(pairs, _named(sets, "fine", pairs), percent, "fine")
    near = written(near.select("a", "b"), "near")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                is_linked(_set(a.as_py()), _set(b.as_py()), percent)
                for a, b in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
            del batch
            give_back()

    some = whole_sets(docs, _ends(near), n)
    both = near.join(_side(some, "shingles", "a", "left"), "a").join(
        _side(some, "shingles", "b", "right"), "b"
    )
    return map_batches(both.select("a", "b", "left", "right"), rows, "a long, b long")


def _sizes_fit(a: str, b: str, percent: int) -> str:
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def _whole_groups(
    batches: Iterator[pa.RecordBatch], by: tuple[str, ...]
) -> Iterator[tuple[pa.Table, list[int]]]:
    """Rows in portions of whole groups, which stand together, and the groups' bounds in them.  A group
    may go on in the next batch, so the last one waits."""
    held = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
        if held is None or not held.num_rows:
            continue
        group = np.stack([np.array(held[c], np.int64) for c in by])
        starts = np.flatnonzero(np.any(group[:, 1:] != group[:, :-1], axis=0)) + 1
        starts = [0, *starts.tolist(), held.num_rows]
        ready = starts if batch is None else starts[:-1]
        yield held.slice(0, ready[-1]), ready
        held = held.slice(ready[-1])


def bucket_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, sizes, differ) in small buckets whose parities allow a link and whose ``root`` differs.
    ``members`` (sig, key, n, odd, root): a bucket is one group, in which odd members meet all others;
    only pairs that may be links become rows."""
    parities = sets.groupBy("key").agg(F.min("parity").alias("parity"))

    def pairs(keys, n, root, odd, parity) -> Iterator[tuple[np.ndarray, ...]]:
        size = np.array([len(p) for p in parity])
        # by size: the parities of sets that have that many bytes or more
        cuts = {
            s: np.stack([folded(p, s) if len(p) >= s else np.zeros(s, np.uint8) for p in parity])
            for s in np.unique(size).tolist()
        }
        for i in np.flatnonzero(odd):
            sizes = n.astype(np.int64) + n[i]
            may = (root != root[i]) & (~odd | (keys[i] < keys))
            may &= 100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])
            common = np.minimum(size, size[i])
            for s in np.unique(common[may]).tolist():
                j = np.flatnonzero(may & (common == s))
                found = cuts[s].view(np.uint64)
                differ = np.bitwise_count(found[j] ^ found[i]).sum(1, dtype=np.int64)
                near = differ <= _differ_at_most(sizes[j], percent)
                j, differ = j[near], differ[near]
                yield np.minimum(keys[j], keys[i]), np.maximum(keys[j], keys[i]), sizes[j], differ

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for done, ready in _whole_groups(batches, ("sig",)):
            columns = [np.array(done[c]) for c in ("key", "n", "root", "odd")]
            parity = done["parity"].to_pylist()
            found = [(np.zeros(0, np.int64),) * 4]
            for low, high in zip(ready[:-1], ready[1:], strict=True):
                found += pairs(*(c[low:high] for c in columns), parity[low:high])
            parts = [np.concatenate(c) for c in zip(*found, strict=True)]
            yield _record(**dict(zip(("a", "b", "sizes", "differ"), map(pa.array, parts), strict=True)))
            del done, parity, parts
            give_back()

    met = members.join(parities, "key").select("sig", "key", "n", "odd", "root", "parity")
    grouped = met.repartition("sig").sortWithinPartitions("sig")
    return map_batches(grouped, rows, "a long, b long, sizes long, differ long").distinct()


def block_pairs(members: DataFrame, sets: DataFrame, percent: int, best_only: bool) -> DataFrame:
    """(a, b, sizes) in large buckets whose parities allow a link and whose ``root`` differs.  ``members``
    (sig, key, n, odd, root): each bucket is cut by size, so that odd members meet those of their own
    and the two neighbouring classes only, and each class into blocks of about BLOCK_MEMBERS; every
    block meets every block of odd members, each pair of blocks being one group.  With ``best_only``
    an odd member gives its likeliest partner of the block."""
    # a little wider than the largest ratio of linked sizes, for the logarithm's last digit
    width = 1.001 * max(math.log(100 / percent), 0.01)

    def block(size: str) -> str:
        return f"cast(pmod(xxhash64(key), ceil({size} / {BLOCK_MEMBERS})) AS int)"

    def blocks(size: str) -> str:
        return f"explode(sequence(0, cast(ceil({size} / {BLOCK_MEMBERS}) AS int) - 1))"

    rest = ["sig", "key", "n", "root"]
    classed = members.withColumn("class", F.floor(F.log("n") / width).cast("int"))
    both = classed.selectExpr(*rest, "class", "false AS is_odd").union(
        classed.where("odd").selectExpr(
            *rest, "explode(array(class - 1, class, class + 1)) AS class", "true AS is_odd"
        )
    )
    sizes = both.groupBy("sig", "class").agg(
        F.count_if(~F.col("is_odd")).alias("size"),
        F.count_if("is_odd").alias("n_odd"),
        F.min("key").alias("low"),
        F.max("key").alias("high"),
    )
    parities = sets.groupBy("key").agg(F.min("parity").alias("parity"))
    # a class of one key only is an odd member beside itself
    cut = both.join(
        sizes.where("size > 0 AND n_odd > 0 AND low < high").drop("low", "high"), ["sig", "class"]
    ).join(parities, "key")
    rest = ["key", "n", "root", "parity", "is_odd"]
    one = cut.where("NOT is_odd").selectExpr(
        "sig", "class", f"{block('size')} AS r", f"{blocks('n_odd')} AS c", *rest
    )
    other = cut.where("is_odd").selectExpr(
        "sig", "class", f"{blocks('size')} AS r", f"{block('n_odd')} AS c", *rest
    )

    def pairs(keys, n, root, odd, parity) -> dict[str, list]:
        least = min(map(len, parity))
        parity = np.stack([folded(p, least) for p in parity]).view(np.uint64)
        left, right = np.flatnonzero(~odd), np.flatnonzero(odd)
        out = {"a": [], "b": [], "sizes": []}
        for i in right:
            differ = np.bitwise_count(parity[left] ^ parity[i]).sum(1, dtype=np.int64)
            may = (
                (differ <= _differ_at_most(n[left].astype(np.int64) + n[i], percent))
                & (100 * np.minimum(n[left], n[i]) >= percent * np.maximum(n[left], n[i]))
                & (root[left] != root[i])
            )
            found = left[may]
            if best_only and len(found):
                found = found[[np.argmin(differ[may])]]
            out["a"].append(np.minimum(keys[found], keys[i]))
            out["b"].append(np.maximum(keys[found], keys[i]))
            out["sizes"].append(n[found].astype(np.int64) + n[i])
        return out

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for done, ready in _whole_groups(batches, _GROUP):
            keys, n, root, odd = (np.array(done[c]) for c in ("key", "n", "root", "is_odd"))
            parity = done["parity"].to_pylist()
            found = {"a": [], "b": [], "sizes": []}
            for low, high in zip(ready[:-1], ready[1:], strict=True):
                if odd[low:high].any() and not odd[low:high].all():
                    cut = slice(low, high)
                    for c, parts in pairs(keys[cut], n[cut], root[cut], odd[cut], parity[cut]).items():
                        found[c] += parts
            none = [np.zeros(0, np.int64)]
            yield _record(**{c: pa.array(np.concatenate(parts or none)) for c, parts in found.items()})

    met = one.union(other).select(*_GROUP, "key", "n", "root", "is_odd", "parity")
    grouped = met.repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    return map_batches(grouped, rows, "a long, b long, sizes long")


def set_components(docs: DataFrame, counts: np.ndarray, n: int, percent: int) -> DataFrame:
    """(node, root) of the keys of sets that are similar to another: any two that a chain of similar
    sets connects have the same root."""
    distinct = written(shared_signatures(signatures(docs, counts, n, percent)), "buckets")
    hubs = distinct.groupBy("sig").agg(
        F.min(F.struct("rare", "key", "n")).alias("hub"),
        F.count("*").alias("size"),
        F.expr("bit_xor(xxhash64(key))").alias("content"),
    )
    # a shared passage gives many buckets of the same members: one is enough
    once = hubs.groupBy("hub", "size", "content").agg(F.min("sig").alias("sig"))
    members = written(
        distinct.join(once, "sig").select(
            "sig", "key", "n", F.col("hub.key").alias("hub"), F.col("hub.n").alias("hub_n")
        ),
        "members",
    )
    dropped(distinct)
    sets = written(candidate_sets(docs, members, n), "sets")
    to_hub = (
        members.where(f"key <> hub AND {_sizes_fit('n', 'hub_n', percent)}")
        .selectExpr("key AS a", "hub AS b", "n + hub_n AS sizes")
        .distinct()
    )
    to_hub = written(likely(to_hub, sets, percent), "to_hub")
    none = to_hub.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    roots = _connect(none, to_hub, sets, docs, n, percent)
    rooted = _with_root(_with_root(members, roots, "key", "root"), roots, "hub", "hub_root")
    rooted = rooted.withColumn("odd", F.col("root") != F.col("hub_root"))
    sizes = rooted.groupBy("sig").agg(
        F.count("*").alias("size"), F.sum(F.col("odd").cast("int")).alias("n_odd")
    )
    mixed = written(
        rooted.where("key <> hub")
        .join(sizes.where("n_odd > 0 AND size > 2"), "sig")
        .select("sig", "key", "n", "odd", "size", "root"),
        "mixed",
    )
    dropped(members)
    large = mixed.where(f"size > {SMALL_BUCKET}")
    small = mixed.where(f"size <= {SMALL_BUCKET}")
    pairs = written(bucket_pairs(small, sets, percent), "likely")
    roots = _connect(roots, pairs, sets, docs, n, percent)
    if large.isEmpty():
        return roots
    for best_only in [True] * ROUNDS + [False]:
        rooted = _with_root(large.drop("root"), roots, "key", "root")
        pairs = written(block_pairs(rooted, sets, percent, best_only).distinct(), "blocks")
        if pairs.isEmpty():
            break
        roots = _joined(roots, linked(pairs, sets, docs, n, percent))
        # a member without a likely partner now has none later on, when more are connected
        hit = pairs.select(F.col("a").alias("hit")).union(pairs.select("b")).distinct()
        large = large.join(hit, F.col("key") == F.col("hit"), "left").withColumn(
            "odd", F.col("odd") & F.col("hit").isNotNull()
        )
        large = written(large.drop("hit"), "large")
    return roots


def _connect(
    roots: DataFrame, pairs: DataFrame, sets: DataFrame, docs: DataFrame, n: int, percent: int
) -> DataFrame:
    """``roots`` (node, root) with the links among ``pairs`` (a, b, sizes, differ).  Each node's likeliest
    partner in another component is looked at first, for some rounds that join components; then all
    pairs still apart."""
    for best_only in [True] * ROUNDS + [False]:
        apart = _apart(pairs, roots)
        if best_only:
            best = F.min(F.struct("differ", "b", "sizes"))
            apart = apart.groupBy("a").agg(best.alias("best")).select("a", "best.b", "best.sizes")
        apart = written(apart.select("a", "b", "sizes"), "apart")
        if apart.isEmpty():
            break
        roots = _joined(roots, linked(apart, sets, docs, n, percent))
    return roots


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (node, root) after ``links`` (a, b) have joined components."""
    stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return components(stars.union(links))


def _with_root(rows: DataFrame, roots: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with the component of ``key``; a node without links is its own."""
    roots = roots.select(F.col("node").alias(key), F.col("root").alias("found"))
    joined = rows.join(roots, key, "left")
    return joined.withColumn(name, F.coalesce("found", key)).drop("found")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    both = _with_root(_with_root(pairs, roots, "a", "root_a"), roots, "b", "root_b")
    return both.where("root_a <> root_b")


def similarity_classes(
    docs: DataFrame,
    *,
    words: int = 3,
    percent: int = 90,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``: two documents link when
    100 * |intersection| >= percent * |union|; component_id is the smallest id reachable."""
    picked = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.lit(None).cast("long").alias("tag"),
        F.col(text_column).alias("text"),
    )
    return _classified(picked, words, percent).select("doc_id", "n_shingles", "component_id")


def _classified(picked: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, tag, root, n_shingles, component_id) per row of ``picked`` (doc_id, tag, text)."""
    summary = written(summarize(picked, words), "summary")
    rows = summary.where("slot IS NULL").select("doc_id", "tag", "key", "n_shingles")
    counts = slot_counts(summary)
    roots = set_components(picked.select("text"), counts, words, percent)
    least = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least"))
    rooted = written(
        least.join(roots, F.col("key") == F.col("node"), "left").select(
            "key", "least", F.coalesce("root", "key").alias("root")
        ),
        "roots",
    )
    classes = rooted.join(
        rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root"
    ).select("key", "root", "component_id")
    return rows.join(classes, "key", "left").select(
        "doc_id",
        "tag",
        "root",
        "n_shingles",
        F.when(F.col("key").isNull(), F.col("doc_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
    )


def one_per_class(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those that have a smaller id in their class.  An id may come with
    several texts: one row stays of each id and class, so texts of different classes all do.  Rows with
    null ids and empty texts stay."""
    inner = inner_names(docs.columns, "doc_id", "text")
    held = docs.toDF(*inner).withColumn("tag", F.xxhash64("text"))
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    picked = held.select(F.col("doc_id").cast("long").alias("doc_id"), "tag", "text")
    first = (
        _classified(picked, words, percent)
        .where("doc_id = component_id AND n_shingles > 0")
        .groupBy("doc_id", "root")
        .agg(F.min("tag").alias("tag"))
        .select("doc_id", "tag")
        .distinct()
    )
    alone = held.where(F.col("doc_id").isNull() | ~has_words)
    kept = held.where(has_words).join(first, ["doc_id", "tag"], "left_semi")
    kept = kept.dropDuplicates(["doc_id", "tag"])
    return own_names(kept.select(*inner).unionByName(alone.select(*inner)), inner, docs.columns)
