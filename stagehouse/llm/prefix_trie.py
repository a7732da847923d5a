"""The prefix trie of conversations: what a cache of shared beginnings would save.

Conversations become byte strings of fixed-width turns (a 128-bit digest of role and text, and the
number of code points), so their order as bytes is the order of a depth-first walk.  Distinct ones are
dealt out to shards by ranges of that order.  A shard numbers its turns by a dictionary, inserts its
conversations into ternary search trees, median first, and sums members, leaves and savings up from
the last node to the first.  Only nodes on the path of a shard's first or last conversation can go on
in another shard; these, at most two paths a shard, are merged afterwards.

Turns deeper than ``head_turns`` are not kept in one row: they become nodes by running hashes, and
their sums come up by pointer doubling, so a conversation may be of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagehouse.llm.storage import map_batches, written
from stagehouse.operators.running import number_rows
from stagehouse.plans.workspace import work_folder
from stagehouse.sources.staging import StagingArea

DIGEST, WIDTH = 16, 20  # bytes of a turn's digest, and with its number of code points
HEAD_TURNS = 128
TAKEN = 5  # the most turns taken over from another conversation
ID_BLOCK = 256  # member ids in one row before they are hashed
SHARD_TURNS, SHARD_MOST = 5_000, 400_000  # turns of a shard: few tables make small ones
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
COLUMNS = (
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
)


# -- turns ------------------------------------------------------------------------------------------


def encoded_turns(conversations: DataFrame, area: StagingArea) -> DataFrame:
    """(conv_id, pos from 1, code: 40 hexadecimal digits).  Turns are numbered by turn (null first),
    equal ones by the digest of role and text.  Texts are not shuffled."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    parts = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.sha2(parts.cast("binary"), 256), 1, 2 * DIGEST)
    size = F.lpad(F.lower(F.hex(F.length(text).cast("long"))), 2 * (WIDTH - DIGEST), "0")
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.concat(digest, size).alias("code"),
    )
    return number_rows(turns, ["conv_id"], ["turn", "code"], area, number="pos").drop("turn")


def rebuilt(turns: DataFrame, head_turns: int) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (conv_id, head: binary) with at most ``head_turns`` turns, and the
    deeper turns (conv_id, head, depth, code).  No group is larger than a head."""
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (TAKEN + 1)).cast("int")
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("pos", "code"))), lambda x: x.code)
    first = (
        turns.where(f"pos <= {TAKEN} AND conv_id % 100 = 0")
        .groupBy(F.col("conv_id").alias("base"))
        .agg(in_order.alias("first"))
    )
    own = turns.where(F.col("pos") <= head_turns + TAKEN).groupBy("conv_id").agg(in_order.alias("own"))
    own = own.withColumn("base", F.expr("conv_id - conv_id % 100"))
    none = F.expr("cast(array() as array<string>)")
    parts = own.join(first, "base", "left").select(
        "conv_id",
        F.slice(F.coalesce("first", none), 1, taken).alias("a"),
        F.slice("own", taken + 1, head_turns + TAKEN).alias("b"),
    )
    head = F.unhex(F.array_join(F.slice(F.concat("a", "b"), 1, head_turns), ""))
    heads = written(parts.select("conv_id", F.size("a").alias("n_taken"), head.alias("head")), "heads")
    later = (
        turns.where(F.col("pos") > head_turns)
        .join(heads, "conv_id")
        .withColumn("depth", F.col("pos") - taken + F.col("n_taken"))
        .where(F.col("depth") > head_turns)
        .select("conv_id", "head", "depth", "code")
    )
    return heads.select("conv_id", "head"), later


# -- members ----------------------------------------------------------------------------------------


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a key, from rows in order of key and block: ids are hashed as they stream by."""
    key, state, fed, n, least = None, None, False, 0, 0
    kinds = [("key", pa.binary()), ("n", pa.int64()), ("least", pa.int64()), ("ends", pa.string())]
    for batch in batches:
        done = []
        for found, m, low, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if found != key:
                if key is not None:
                    done.append((key, n, least, state.hexdigest()))
                key, state, fed, n, least = found, hashlib.sha256(), False, 0, low
            n, least = n + m, min(least, low)
            if ids:
                state.update((b"," if fed else b"") + ids.encode())
                fed = True
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, (_, k) in zip(zip(*done), kinds)], schema=pa.schema(kinds)
            )
    if key is not None:
        last = (key, n, least, state.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, (_, k) in zip(last, kinds)], schema=pa.schema(kinds)
        )


def members(rows: DataFrame) -> DataFrame:
    """(key, n, least, ends) of rows (key: binary, conv_id, is_end): the number of members, the least,
    and the hash of the ids of those that end there.  Ids are put together in blocks of ``ID_BLOCK``
    before they are moved, so copies meet as few long rows, and a hash is fed block by block."""
    ending = F.sort_array(F.collect_list(F.when(F.col("is_end"), F.col("conv_id"))))
    blocks = rows.groupBy("key", F.floor(F.col("conv_id") / ID_BLOCK).alias("block")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("least"),
        F.array_join(ending, ",").alias("ids"),
    )
    ordered = blocks.repartition("key").sortWithinPartitions("key", "block")
    ordered = ordered.select("key", "n", "least", "ids")
    return map_batches(ordered, _hash_ids, "key binary, n long, least long, ends string")


# -- deep turns -------------------------------------------------------------------------------------


def deep_nodes(later: DataFrame, head_turns: int, area: StagingArea) -> DataFrame:
    """Nodes below ``head_turns`` (key, up: key of the parent or null at the top, head, depth, n,
    least, ends, n_children, n_leaves, saved), written.

    A node's key is the hash of the head, the depth, and the exact sums of two 60-bit hashes of every
    (depth, turn) on the way: running sums, so that a long conversation spreads over tasks.  Sums over
    subtrees come up by doubling: after round r every node has what lies less than 2^r below it."""
    number = "decimal(38,0)"
    sha = F.sha2(F.concat_ws(":", F.col("depth").cast("string"), "code").cast("binary"), 256)
    terms = later.withColumn("sha", sha).withColumns(
        {f"t{i}": F.conv(F.substring("sha", 1 + 15 * i, 15), 16, 10).cast(number) for i in (0, 1)}
    )
    summed = number_rows(
        terms, ["conv_id"], ["depth"], area, number="nth", totals={"s0": "t0", "s1": "t1"}
    )

    def key(depth: Column, a: Column, b: Column) -> Column:
        parts = F.concat_ws(":", F.hex("head"), depth.cast("string"), a.cast("string"), b.cast("string"))
        return F.unhex(F.substring(F.sha2(parts.cast("binary"), 256), 1, 2 * DIGEST))

    depth, s0, s1 = F.col("depth"), F.col("s0"), F.col("s1")
    above = key(depth - 1, (s0 - F.col("t0")).cast(number), (s1 - F.col("t1")).cast(number))
    rows = written(
        summed.select(
            "conv_id",
            "head",
            "depth",
            key(depth, s0.cast(number), s1.cast(number)).alias("key"),
            F.when(depth > head_turns + 1, above).alias("up"),
            F.conv(F.substring("code", 2 * DIGEST + 1, 2 * (WIDTH - DIGEST)), 16, 10)
            .cast("long")
            .alias("size"),
        ),
        "deep_turns",
    )
    ends = rows.groupBy("conv_id").agg(F.max("depth").alias("depth"), F.lit(True).alias("is_end"))
    ended = rows.join(ends, ["conv_id", "depth"], "left").select(
        "key", "conv_id", F.coalesce("is_end", F.lit(False)).alias("is_end")
    )
    shape = rows.groupBy("key").agg(
        *[F.max(c).alias(c) for c in ("up", "head", "depth", "size")]
    )
    children = rows.where("up IS NOT NULL").select("key", "up").distinct()
    children = children.groupBy(F.col("up").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = shape.join(members(ended), "key").join(children, "key", "left")
    nodes = nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(nodes, "deep_nodes")
    sums = nodes.select(
        "key",
        "up",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n") - 1) * F.col("size")).alias("saved"),
    )
    deepest = nodes.agg(F.max("depth")).first()[0]
    for _ in range(max(deepest - head_turns - 1, 0).bit_length()):
        below = sums.where("up IS NOT NULL").groupBy(F.col("up").alias("key")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        jump = sums.select(F.col("key").alias("up"), F.col("up").alias("farther"))
        sums = written(
            sums.join(below, "key", "left")
            .join(jump, "up", "left")
            .select(
                "key",
                F.col("farther").alias("up"),
                (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "deep_sums",
        )
    return written(nodes.join(sums.drop("up"), "key"), "deep_result")


# -- shards -----------------------------------------------------------------------------------------


class TernaryTrie:
    """Ternary search trees over turn ids, one below each node.  Node 0 is the root; a node comes
    after its parent."""

    def __init__(self):
        self.turn, self.low, self.high, self.below = [-1], [-1], [-1], [-1]
        self.parent, self.depth, self.size = [-1], [0], [0]
        self.n, self.least, self.ends = [0], [None], [None]

    def insert(self, turns: list[int], sizes: list[int], n: int, least: int, ends: str) -> list[int]:
        """The nodes on the way, the root first."""
        path = [0]
        for turn, size in zip(turns, sizes, strict=True):
            links, place = self.below, path[-1]
            here = links[place]
            while here >= 0 and self.turn[here] != turn:
                links, place = (self.low if turn < self.turn[here] else self.high), here
                here = links[place]
            if here < 0:
                here = links[place] = self._add(turn, path[-1], size)
            path.append(here)
        for at in path:
            self.n[at] += n
            if self.least[at] is None or least < self.least[at]:
                self.least[at] = least
        self.ends[path[-1]] = ends
        return path

    def _add(self, turn: int, parent: int, size: int) -> int:
        for links in (self.low, self.high, self.below):
            links.append(-1)
        self.turn.append(turn)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.size.append(size)
        self.n.append(0)
        self.least.append(None)
        self.ends.append(None)
        return len(self.turn) - 1


def medians(n: int) -> Iterator[int]:
    """0 to n-1, the middle of every range before its halves, so that the trees come out balanced."""
    ranges = [(0, n)]
    for low, high in ranges:
        if low < high:
            middle = (low + high) // 2
            yield middle
            ranges += [(low, middle), (middle + 1, high)]


def path_key(head: bytes) -> bytes:
    return hashlib.blake2b(head, digest_size=DIGEST).digest()


_SHARD = {
    "conv_id": pa.int64(),
    "depth": pa.int64(),
    "parent_conv_id": pa.int64(),
    "n_convs": pa.int64(),
    "n_children": pa.int64(),
    "n_leaves": pa.int64(),
    "saved_tokens": pa.int64(),
    "ends_sha256": pa.string(),
    "size": pa.int64(),
    "key": pa.binary(),
    "parent_key": pa.binary(),
    "above": pa.list_(pa.binary()),
}
_SHARD_DDL = ", ".join([f"{c} long" for c in COLUMNS[:-1]]) + (
    ", ends_sha256 string, size long, key binary, parent_key binary, above array<binary>"
)


def shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trie of one range of heads (head, n, least, ends, and n_children, n_leaves, saved of the deep
    nodes below).  Inner nodes are complete, but for the parent's id where ``parent_key`` names an
    edge node.  Edge nodes, on the first and the last path, have a ``key`` and the keys ``above``; their
    sums are what hangs below them inside, without themselves."""
    rows = [r for batch in batches for r in batch.to_pylist()]
    if not rows:
        return
    rows.sort(key=lambda r: r["head"])
    cells = np.frombuffer(b"".join(r["head"] for r in rows), np.uint8).reshape(-1, WIDTH)
    digests = np.ascontiguousarray(cells[:, :DIGEST]).view(">u8").astype(np.uint64)
    sizes = np.ascontiguousarray(cells[:, DIGEST:]).view(">u4").ravel().tolist()
    turns = _dictionary(digests).tolist()
    bounds = np.cumsum([0, *(len(r["head"]) // WIDTH for r in rows)]).tolist()
    trie, deep, paths = TernaryTrie(), {}, {}
    for i in medians(len(rows)):
        row, span = rows[i], slice(bounds[i], bounds[i + 1])
        path = trie.insert(turns[span], sizes[span], row["n"], row["least"], row["ends"])
        if row["n_children"]:
            deep[path[-1]] = row
        if i in (0, len(rows) - 1):
            paths |= {at: row["head"][: depth * WIDTH] for depth, at in enumerate(path)}
    count = len(trie.turn)
    children, leaves, saved = [0] * count, [0] * count, [0] * count
    for at in range(count - 1, -1, -1):  # upwards, since a node comes after its parent
        if at in deep:
            children[at] += deep[at]["n_children"]
            leaves[at] += deep[at]["n_leaves"]
            saved[at] += deep[at]["saved"]
        if at not in paths:
            leaves[at] += children[at] == 0
            saved[at] += (trie.n[at] - 1) * trie.size[at]
            up = trie.parent[at]
            children[up] += 1
            leaves[up] += leaves[at]
            saved[up] += saved[at]
    keys = {at: path_key(path) for at, path in paths.items()}
    for low in range(0, count, 10_000):
        some = range(low, min(low + 10_000, count))
        up = [trie.parent[at] for at in some]
        columns = [
            [trie.least[at] for at in some],
            [trie.depth[at] for at in some],
            [trie.least[u] if u >= 0 and u not in keys else None for u in up],
            [trie.n[at] for at in some],
            [children[at] for at in some],
            [leaves[at] for at in some],
            [saved[at] for at in some],
            [trie.ends[at] for at in some],
            [trie.size[at] for at in some],
            [keys.get(at) for at in some],
            [keys.get(u) for u in up],
            [
                [path_key(paths[at][:i]) for i in range(0, len(paths[at]), WIDTH)]
                if at in paths
                else None
                for at in some
            ],
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, _SHARD.values(), strict=True)],
            names=list(_SHARD),
        )


def _dictionary(digests: np.ndarray) -> np.ndarray:
    """A number for every distinct digest, in the digests' order."""
    if not len(digests):
        return np.zeros(0, np.int64)
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    new = np.any(np.diff(digests[order], axis=0) != 0, axis=1)
    ids = np.empty(len(digests), np.int64)
    ids[order] = np.concatenate([[0], np.cumsum(new)])
    return ids


def merged_edges(nodes: DataFrame) -> DataFrame:
    """The edge nodes of all shards, each once, whole.  There are at most 2 x shards x (head turns + 1)
    of them.  Sums go from every edge node to all edge nodes above it, which it names."""
    edges = nodes.where("key IS NOT NULL")
    one = edges.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"),
        *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256"),
        F.max("size").alias("size"),
        F.max("parent_key").alias("parent_key"),
        F.max("above").alias("above"),
    )
    one = written(one, "trie_edges")
    more = one.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key"))
    one = one.join(more.agg(F.count(F.lit(1)).alias("edge_children")), "key", "left")
    one = one.withColumn("n_children", F.col("n_children") + F.coalesce("edge_children", F.lit(0)))
    parts = one.select(
        F.explode(F.concat("above", F.array("key"))).alias("key"),
        (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
    )
    sums = parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens")])
    one = one.drop("n_leaves", "saved_tokens", "edge_children", "above").join(sums, "key")
    return written(one, "trie_edges")


def prefix_trie(conversations: DataFrame, head_turns: int = HEAD_TURNS) -> DataFrame:
    """Every node of the trie of the rebuilt conversations.

    A conversation c begins with the first h turns of conversation c - c % 100 (% as in SQL), h = crc32
    of c's digits modulo 6, followed by its own turns after its first h.  One row a node: conv_id (least
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without an id are left out; null roles and texts count as empty, null turns come first, turns
    of one number are ordered by the digest of role and text, and repeated rows are repeated turns.
    Texts may be of any length: only their digests are moved.  An empty table has no node, not even a
    root.  Other columns are not looked at.  Two different turns count as one if 128 bits of their
    SHA-256 agree."""
    if head_turns < TAKEN:
        raise ValueError(f"head_turns must be {TAKEN} or more")
    spark = conversations.sparkSession
    area = StagingArea(spark, work_folder(spark))
    heads, later = rebuilt(encoded_turns(conversations, area), head_turns)
    marked = heads.select(F.col("head").alias("key"), "conv_id", F.lit(True).alias("is_end"))
    none = {c: F.lit(0).cast("long") for c in ("n_children", "n_leaves", "saved")}
    has_deep = not later.isEmpty()
    if has_deep:
        deep = deep_nodes(later, head_turns, area)
        on = later.select("conv_id", F.lit(False).alias("ends_later")).distinct()
        marked = marked.join(on, "conv_id", "left").select(
            "key", "conv_id", F.coalesce("ends_later", F.lit(True)).alias("is_end")
        )
    distinct = members(marked).withColumnRenamed("key", "head").withColumns(none)
    if has_deep:
        top = deep.where("up IS NULL").groupBy("head").agg(
            F.count(F.lit(1)).alias("d0"), F.sum("n_leaves").alias("d1"), F.sum("saved").alias("d2")
        )
        distinct = distinct.join(top, "head", "left").withColumns(
            {c: F.coalesce(f"d{i}", F.lit(0)).cast("long") for i, c in enumerate(none)}
        )
    names = ("head", "n", "least", "ends", *none)
    distinct = written(distinct.select(*names), "trie_heads")
    turns = distinct.agg(F.sum(F.length("head"))).first()[0]
    if turns is None:
        return spark.createDataFrame([], f"{' long, '.join(COLUMNS)} string")
    turns //= WIDTH
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(-(-turns // SHARD_MOST), min(-(-turns // SHARD_TURNS), few), 1)
    ranged = distinct.repartitionByRange(shards, "head")
    nodes = written(map_batches(ranged, shard_nodes, _SHARD_DDL), "trie_nodes")
    edges = merged_edges(nodes)
    # at most 2 x shards x (head turns + 1) rows
    named = F.broadcast(
        edges.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("named"))
    )
    ends = F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")
    middle = [c for c in COLUMNS if c not in ("parent_conv_id", "ends_sha256")]

    def final(some: DataFrame, parent: Column) -> DataFrame:
        return some.select(*middle, parent.alias("parent_conv_id"), ends).select(*COLUMNS)

    inner = nodes.where("key IS NULL").join(named, "parent_key", "left")
    out = final(inner, F.coalesce("parent_conv_id", "named"))
    out = out.union(final(edges.join(named, "parent_key", "left"), F.col("named")))
    if has_deep:
        above = deep.select(F.col("key").alias("up"), F.col("least").alias("above"))
        top = distinct.select("head", F.col("least").alias("top"))
        known = deep.join(above, "up", "left").join(top, "head", "left")
        known = known.withColumnsRenamed(
            {"least": "conv_id", "n": "n_convs", "saved": "saved_tokens", "ends": "ends_sha256"}
        )
        out = out.union(final(known, F.coalesce("above", "top")))
    return out
