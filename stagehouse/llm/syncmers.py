"""Document fingerprints from closed syncmers, in DataFrame functions only.

The letters of a document are its words (runs of no white space, in pieces of at most eight code
points).  Of all runs of ``k`` words those are chosen whose least inner run of ``s`` words, by hash,
is the first or the last one: a choice that looks at nothing outside the run, so equal passages
choose equal anchors wherever they stand.  An anchor is matched by position through its link: its
hash, the hash of the anchor after it, and the distance between the two in words, which do not
change when text is put in before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagehouse.llm.storage import written
from stagehouse.operators.running import number_rows
from stagehouse.plans.workspace import work_folder
from stagehouse.sources.staging import StagingArea

K_WORDS, S_WORDS = 5, 1


def with_links(df: DataFrame, text: str, links: str, k: int = K_WORDS, s: int = S_WORDS) -> DataFrame:
    """``df`` with ``links``, the array of 32-bit link hashes of column ``text`` in order of place.

    A text of less than ``k`` words has one anchor, the whole run of its words; a null text, or one
    without words, has none.  Time and memory grow with the length of the text."""
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\s]{1,8}"), 0)
    out = df.withColumn("__w", F.transform(words, lambda w: F.xxhash64(w)))
    inner = "__w"
    if s > 1:
        inner = "__s"
        starts = F.sequence(F.lit(0), F.greatest(F.size("__w") - s, F.lit(0)))
        run = F.transform(starts, lambda i: F.xxhash64(*[F.get("__w", i + j) for j in range(s)]))
        out = out.withColumn(inner, run)

    def at_an_edge(i: Column) -> Column:
        among = [F.get(inner, i + j) for j in range(k - s + 1)]
        if len(among) < 3:
            return F.lit(True)
        between = F.least(*among[1:-1]) if len(among) > 3 else among[1]
        return F.least(among[0], among[-1]) <= between

    n = F.size("__w")
    places = (
        F.when(n >= k, F.filter(F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))), at_an_edge))
        .when(n > 0, F.array(F.lit(0)))
        .otherwise(F.expr("cast(array() as array<int>)"))
    )
    out = out.withColumn("__p", places)
    out = out.withColumn("__a", F.transform("__p", lambda p: F.xxhash64(F.slice("__w", p + 1, k))))

    def link(a: Column, i: Column) -> Column:
        return F.hash(a, F.get("__a", i + 1), F.get("__p", i + 1) - F.get("__p", i))

    return out.withColumn(links, F.transform("__a", link)).drop("__w", "__s", "__p", "__a")


def fingerprint(links: str | Column) -> Column:
    """The links as text: eight hexadecimal digits each, in order of place."""
    return F.array_join(
        F.transform(links, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0")), ""
    )


def likeness(a: str, b: str) -> Column:
    """Share of distinct links that two fingerprints have in common, of the larger one: 1 for equal
    ones (two empty ones too), 0 for ones without a common link."""
    larger = F.greatest(F.size(F.array_distinct(F.col(a))), F.size(F.array_distinct(F.col(b))))
    common = F.size(F.array_intersect(F.col(a), F.col(b)))
    return F.when(larger == 0, F.lit(1.0)).otherwise(common / larger)


def successors(docs: DataFrame) -> DataFrame:
    """(node, key, n, next_node, next_key): for every distinct document the one that follows it by
    falling id (null ids last; of one id, by text hash), after the last the first.  Only ids, hashes
    and lengths are moved; places come from ranges, so no task holds the whole order."""
    area = StagingArea(docs.sparkSession, work_folder(docs.sparkSession))
    units = docs.select("node", "key", F.length("text").alias("n")).distinct()
    units = units.withColumn("id", F.col("node.id"))
    numbered = number_rows(units, [], [("id", "desc"), "key", "n"], area, number="at")
    after = numbered.select(
        F.col("node").alias("next_node"), F.col("key").alias("next_key"), F.col("at").alias("next_at")
    )
    total = numbered.agg(F.max("at")).first()[0]
    here = numbered.withColumn("next_at", F.when(F.col("at") == total, 1).otherwise(F.col("at") + 1))
    pairs = here.join(after, "next_at").select("node", "key", "n", "next_node", "next_key")
    return written(pairs, "successors")


def fingerprint_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    k: int = K_WORDS,
    s: int = S_WORDS,
) -> DataFrame:
    """Fingerprint of every whole text and of its edited text, whose last floor(n / 3) code points are
    replaced by the first as many (or all) of the next document.

    One row per row: the id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited`` and ``near_next`` (``likeness`` to the edited text's and the next document's
    fingerprint).  The next document is the one after it by falling id; null ids come last, and the
    last is followed by the first.  Rows of one id follow each other by text hash; equal rows count as
    one document there and get equal results.  Null texts count as empty.  A single document is
    followed by itself.  An empty table gives an empty result; other columns are not looked at.

    Texts are shuffled once, and of each text a third as the next document's beginning; links, about a
    quarter of a byte for a letter, go to the document before and to the document itself.  Rows of one id spread by text; equal rows are combined before they are sent."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    docs = docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"))
    # a null id within a struct equals itself
    docs = docs.select(F.struct("id").alias("node"), F.xxhash64("text").alias("key"), "text")
    pairs = successors(docs)
    # every text meets the document before it, which asks for its beginning
    asked = pairs.select(
        F.col("next_node").alias("node"),
        F.col("next_key").alias("key"),
        F.col("node").alias("for_node"),
        F.col("key").alias("for_key"),
        F.floor(F.col("n") / 3).cast("int").alias("m"),
    )
    met = with_links(docs.join(asked, ["node", "key"]), "text", "links", k, s)
    to_the_one_before = F.struct(
        F.col("for_node").alias("node"),
        F.col("for_key").alias("key"),
        F.expr("substring(text, 1, m)").alias("beginning"),
        F.col("links").alias("next_links"),
        F.lit(None).cast("array<int>").alias("links"),
    )
    to_itself = F.struct(
        "node",
        "key",
        F.lit(None).cast("string").alias("beginning"),
        F.lit(None).cast("array<int>").alias("next_links"),
        "links",
    )
    sent = met.select(F.inline(F.array(to_the_one_before, to_itself)))
    given = sent.groupBy("node", "key").agg(
        *[F.max(c).alias(c) for c in ("beginning", "next_links", "links")]
    )
    own = docs.join(given, ["node", "key"]).withColumn("n", F.length("text"))
    own = own.withColumn(
        "edited",
        F.concat(F.expr("substring(text, 1, n - int(floor(n / 3)))"), F.col("beginning")),
    )
    own = with_links(own, "edited", "edited_links", k, s)
    return own.select(
        F.col("node.id").alias(id_column),
        F.col("n").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint("links").alias("fingerprint"),
        fingerprint("edited_links").alias("edited_fingerprint"),
        likeness("links", "edited_links").alias("near_edited"),
        likeness("links", "next_links").alias("near_next"),
    )

