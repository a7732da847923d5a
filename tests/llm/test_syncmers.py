"""Closed syncmers: context-free anchors, links, and the edited texts."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from stagehouse.llm.syncmers import fingerprint, fingerprint_documents, likeness, with_links

WORDS = [f"word{i}" for i in range(400)]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def rows_of(df, id_column="doc_id"):
    return {r[id_column]: r for r in df.collect()}


def pairs(spark, *texts):
    df = spark.createDataFrame([texts], [f"t{i}" for i in range(len(texts))])
    for i in range(len(texts)):
        df = with_links(df, f"t{i}", f"l{i}")
    return df


def brute_places(keys: list[int], k: int, s: int) -> list[int]:
    """Where a run of k keys has its least inner run (of s keys, here s = 1) at an edge."""
    return [
        i
        for i in range(len(keys) - k + 1)
        if min(keys[i : i + k]) in (keys[i], keys[i + k - 1])
    ]


def test_anchors_against_brute_force(spark):
    text = prose(1, 3000)
    words = text.split(" ")
    hashes = spark.createDataFrame([(words,)], "w array<string>").select(
        F.transform("w", lambda w: F.xxhash64(w))
    )
    keys = hashes.first()[0]
    links = pairs(spark, text).select("l0").first()[0]
    places = brute_places(keys, 5, 1)
    assert len(links) == len(places)
    frame = spark.createDataFrame([(keys, places)], "w array<long>, p array<int>")
    anchors = frame.select(F.transform("p", lambda p: F.xxhash64(F.slice("w", p + 1, 5)))).first()[0]
    gaps = [b - a for a, b in zip(places, places[1:])] + [None]
    linked = spark.createDataFrame(
        list(zip(range(len(anchors)), anchors, [*anchors[1:], None], gaps)),
        "i int, a long, b long, g int",
    ).select("i", F.hash("a", "b", "g"))
    assert [x for _, x in sorted(map(tuple, linked.collect()))] == links
    longest = max(b - a for a, b in zip(places, places[1:]))
    assert longest <= 5  # closed syncmers leave no window of words without an anchor


def test_inner_runs_of_several_words(spark):
    df = spark.createDataFrame([(prose(2, 500),)], ["t"])
    many = with_links(with_links(df, "t", "a", 8, 3), "t", "b", 5, 4).first()
    assert 0 < len(many.a) < len(many.b) == 496


def test_anchors_do_not_depend_on_what_is_around(spark):
    passage = prose(3, 200)
    row = pairs(spark, passage, f"{prose(4, 37)} {passage} {prose(5, 90)}").first()
    inside = set(row.l1)
    assert sum(x in inside for x in row.l0) >= len(row.l0) - 1  # the last link has no next anchor


def test_edited_text_and_next_document(spark):
    texts = {5: prose(6, 300), 4: prose(7, 20), 3: "é𝄞x" * 50, 2: "", 1: None, 0: prose(6, 300)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = rows_of(fingerprint_documents(df))
    order = [5, 4, 3, 2, 1, 0]
    assert sorted(found) == sorted(order)
    for doc, after in zip(order, [*order[1:], order[0]]):
        text, following = texts[doc] or "", texts[after] or ""
        m = len(text) // 3
        edited = text[: len(text) - m] + following[:m]
        row = found[doc]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own = pairs(spark, text, edited, following).select(
            fingerprint("l0").alias("f"), fingerprint("l1").alias("e"),
            likeness("l0", "l1").alias("near_edited"), likeness("l0", "l2").alias("near_next"),
        ).first()
        assert (row.fingerprint, row.edited_fingerprint) == (own.f, own.e)
        assert (row.near_edited, row.near_next) == (own.near_edited, own.near_next)
    assert found[0].near_next == 1.0 and found[0].fingerprint == found[5].fingerprint
    assert found[2].near_edited == 1.0 and found[2].fingerprint == ""
    assert 0.5 < found[5].near_edited < 0.8 and found[5].near_next < 0.05


def test_repeated_ids_null_ids_and_other_columns(spark):
    a, b, c = prose(8, 60), prose(9, 60), prose(10, 60)
    rows = [(2, a), (2, a), (2, b), (None, c), (None, c), (0, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS key", "'x' AS node", "2 AS links", "3 AS n"
    )
    out = fingerprint_documents(df)
    assert out.columns[0] == "doc_id" and out.count() == 6
    found = [tuple(r) for r in out.collect()]
    assert len(set(found)) == 4  # equal rows get equal results
    edits = {r[2] for r in found if r[0] == 0}
    m = len(b) // 3  # null ids are last, so 0 is followed by the null id
    assert edits == {hashlib.sha256((b[: len(b) - m] + c[:m]).encode()).hexdigest()}


def test_single_empty_and_long(spark):
    schema = "doc_id long, text string"
    assert fingerprint_documents(spark.createDataFrame([], schema)).collect() == []
    only = fingerprint_documents(spark.createDataFrame([(1, "a b c d e f g h i")], schema)).first()
    assert only.near_next == 1.0
    assert only.edited_sha256 == hashlib.sha256(b"a b c d e f a b c").hexdigest()
    long = spark.createDataFrame([(1, prose(11, 100_000)), (0, "x" * 1_000_000)], schema)
    assert fingerprint_documents(long).count() == 2


def test_only_dataframe_functions(spark, documents):
    plan = fingerprint_documents(documents((1, "a b"), (2, "c")))._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan
