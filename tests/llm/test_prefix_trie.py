"""The prefix trie against a brute-force one."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from stagehouse.llm import prefix_trie
from stagehouse.llm.prefix_trie import prefix_trie as trie_of

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))

    def order(x):
        part = f"{len(x[2])}:{x[2]}{x[3]}".encode()
        return x[0], x[1], hashlib.sha256(part).hexdigest()[:32], len(x[3])

    turns = {c: [x[2:] for x in sorted(v, key=order)] for c, v in own.items()}
    made = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        made[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
    nodes = defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append(c)
    children = defaultdict(int)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, convs in nodes.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1]) if path else 0
    out = []
    for path, convs in nodes.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(made[c]) == len(path))
        out.append(
            (
                min(convs), len(path), min(nodes[path[:-1]]) if path else None, len(convs),
                children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select(*prefix_trie.COLUMNS).collect()), key=repr)


def conversations(seed: int, n: int = 260, most: int = 9):
    r = random.Random(seed)
    rows = []
    for c in [*range(-30, n), 10**12, 10**12 + 7]:
        if r.random() < 0.1:
            continue
        words = ["", "a", "é𝄞", "long " * 3]
        for t in range(r.randint(1, most)):
            hot = c % 3 == 0
            text = "same" if hot else r.choice(words)
            rows.append((c, t, "user" if hot or t % 2 else r.choice(["assistant", None]), text))
    return rows


@pytest.mark.parametrize("shard_turns", [40, 100_000])
@pytest.mark.parametrize("head_turns", [5, 128])
def test_against_brute_force(spark, monkeypatch, shard_turns, head_turns):
    monkeypatch.setattr(prefix_trie, "SHARD_MOST", shard_turns)
    rows = conversations(head_turns)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(trie_of(df, head_turns)) == brute(rows)


def test_long_conversations_share_deep_turns(spark):
    rows = []
    for c, length, fork in [(1, 60, 99), (2, 60, 40), (3, 60, 40), (4, 33, 99), (200, 60, 99)]:
        rows += [(c, t, "user", f"{t}-{c if t >= fork else 0}") for t in range(length)]
    expected = brute(rows)
    assert found(trie_of(spark.createDataFrame(rows, SCHEMA), 5)) == expected
    assert found(trie_of(spark.createDataFrame(rows, SCHEMA))) == expected


def test_nulls_ties_repeats_and_other_columns(spark):
    rows = [
        (None, 0, "user", "gone"), (7, None, "user", "first"), (7, 0, None, None), (7, 0, "b", "x"),
        (7, 0, "b", "x"), (7, 0, "a", "tie"), (100, 1, "user", "base"), (101, 1, "user", "y" * 300_000),
        (102, 5, "ab", "c"), (103, 5, "a", "bc"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "'z' AS key", "2 AS pos")
    assert found(trie_of(df)) == brute(rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(trie_of(empty)) == []
    assert trie_of(empty).columns == list(prefix_trie.COLUMNS)


def test_trees_are_balanced_by_median_order():
    assert sorted(prefix_trie.medians(1000)) == list(range(1000))
    trie = prefix_trie.TernaryTrie()
    for i in prefix_trie.medians(1023):
        trie.insert([i], [1], 1, i, "")

    def height(at):
        return 0 if at < 0 else 1 + max(height(trie.low[at]), height(trie.high[at]))

    assert height(trie.below[0]) == 10
