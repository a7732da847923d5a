"""Multipart credential linking, with DataFrame functions only.

Base spans are found in every whole text: assignments of a secret, access identifiers, long
hexadecimal runs.  Weak candidates are parts that mean little alone: short assigned secrets, account names,
mixed runs of letters and digits, endpoints.  An interval join within scopes decides about them:
two parts are near if at most ``SCOPE`` code points of one text lie between them.  A weak secret needs a near identifier or endpoint, a weak identifier a near secret, an endpoint both.

The join is on cells of ``SCOPE`` code points.  Parts of a cell are reduced to the least start and
greatest end of each role first; a weak part meets its own cells and the two beside them, and those two
numbers decide exactly, since the range that it asks for is wider than a cell.  So work grows with the number
of parts and their length, however many share a text; positions come from running sums in blocks, overlaps with
base spans from halving.

Positions are code points, ends exclusive.  Null texts are empty.  Rows that are equal in id and text get
the same result; null ids stay null.  Other columns are ignored by ``credential_spans`` and kept
by ``redact``.  Weak parts that overlap a base span are not reported again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagehouse.llm.storage import inner_names, own_names, written

SCOPE = 200
#: Array entries that one level of a running sum takes together; code points that one piece of a redacted
#: text is cut from.
BLOCK, TEXT_BLOCK = 64, 1024
#: The patterns of the parts.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ACCOUNT = (
    r"""(?i)(username|user|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9@._-]+)"""
)
MIXED = r"[A-Za-z0-9+/]{32,}"
ENDPOINT = r"https?://[A-Za-z0-9.-]+(:[0-9]+)?(/[A-Za-z0-9._~/?#=&%+-]*)?"
KINDS = ("assign", "access", "hex", "weak_assign", "weak_access", "weak_secret", "endpoint")
ROLES = {
    "assign": "secret",
    "access": "id",
    "hex": "secret",
    "weak_assign": "secret",
    "weak_access": "id",
    "weak_secret": "secret",
    "endpoint": "endpoint",
}
PART = "array<struct<start:long,kind:int,end:long>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is evaluated once however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(values: Column, join: Callable[[Column, Column], Column], levels: int = 3) -> Column:
    """The running sums, or greatest values, of an array of longs that are not negative: in blocks, whose
    last values are run through in the same way, so that the work stays in proportion to the array."""
    none = F.array().cast("array<long>")

    def add(so_far: Column, value: Column) -> Column:
        last = F.coalesce(F.get(so_far, F.size(so_far) - 1), F.lit(0).cast("long"))
        return F.array_append(so_far, join(last, value))

    if levels == 0:
        return F.aggregate(values, none, add)

    def in_blocks(all_values: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(all_values), F.lit(BLOCK))
        blocks = F.transform(
            starts, lambda at: F.aggregate(F.slice(all_values, at, BLOCK), none, add)
        )
        return _let(blocks, carried)

    def carried(blocks: Column) -> Column:
        lasts = _running(F.transform(blocks, lambda b: F.element_at(b, -1)), join, levels - 1)

        def shifted(carries: Column) -> Column:
            before = lambda i: F.coalesce(F.get(carries, i - 1), F.lit(0).cast("long"))
            return F.flatten(
                F.transform(
                    blocks,
                    lambda block, i: _let(
                        before(i), lambda carry: F.transform(block, lambda v: join(carry, v))
                    ),
                )
            )

        return _let(lasts, shifted)

    return F.when(F.size(values) <= BLOCK, F.aggregate(values, none, add)).otherwise(
        _let(values, in_blocks)
    )


def _sum(one: Column, other: Column) -> Column:
    return one + other


def _parts(text: Column, pattern: str, kind: Callable[[Column], Column], group: int = 0) -> Column:
    """The matches as parts, ``kind`` of the matched value each; those without a kind go.  What stands
    between matches and the matches themselves, laid end to end, give the positions."""
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )

    def placed(found: Column) -> Column:
        lengths = F.transform(
            found, lambda one: (F.length(one["gap"]) + F.length(one["whole"])).cast("long")
        )

        def part(ends: Column, one: Column, i: Column) -> Column:
            end = F.get(ends, i)
            return F.struct(
                (end - F.length(one["whole"])).alias("start"),
                kind(one["value"]).alias("kind"),
                end.alias("end"),
            )

        return _let(
            _running(lengths, _sum),
            lambda ends: F.transform(found, lambda one, i: part(ends, one, i)),
        )

    matches = F.filter(pieces, lambda one: one["whole"].isNotNull())
    parts = F.filter(_let(matches, placed), lambda part: part["kind"].isNotNull()).cast(PART)
    return F.when(text.rlike(pattern), parts).otherwise(F.array().cast(PART))


def _kind(name: str) -> Column:
    return F.lit(KINDS.index(name))


def _apart(parts: Column, base: Column) -> Column:
    """``parts`` that overlap none of ``base``, which is sorted: of the spans that start before the part's
    end, found by halving, the greatest end decides."""

    def among(furthest: Column) -> Column:
        halvings = F.sequence(F.lit(0), F.ceil(F.log2(F.size(base) + F.lit(1))).cast("int"))

        def overlaps(part: Column) -> Column:
            def halve(range_: Column, _: Column) -> Column:
                middle = F.floor((range_["lo"] + range_["hi"]) / 2).cast("int")
                right = F.get(base, middle)["start"] < part["end"]
                open_ = range_["lo"] < range_["hi"]
                return F.struct(
                    F.when(open_ & right, middle + 1).otherwise(range_["lo"]).alias("lo"),
                    F.when(open_ & ~right, middle).otherwise(range_["hi"]).alias("hi"),
                )

            every = F.struct(F.lit(0).alias("lo"), F.size(base).alias("hi"))
            starting = F.aggregate(halvings, every, halve, lambda range_: range_["lo"])
            end = F.get(furthest, starting - 1)
            return F.coalesce(end > part["start"], F.lit(False))

        return F.filter(parts, lambda part: ~overlaps(part))

    ends = F.transform(base, lambda b: b["end"])
    return F.when((F.size(base) == 0) | (F.size(parts) == 0), parts).otherwise(
        _let(_running(ends, F.greatest), among)
    )


def _mixed(value: Column) -> Column:
    return value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9]")


def scanned(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``weak``, both sorted arrays of parts."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    assigned = _parts(
        text,
        ASSIGN,
        lambda v: F.when(F.length(v) >= 6, _kind("assign")).otherwise(_kind("weak_assign")),
        2,
    )
    first = docs.withColumn("assigned", assigned).withColumn(
        "base",
        F.array_sort(
            F.concat(
                F.filter("assigned", lambda p: p["kind"] == _kind("assign")),
                _parts(text, ACCESS, lambda v: _kind("access")),
                _parts(text, HEX, lambda v: _kind("hex")),
            )
        ),
    )
    weak = F.concat(
        F.filter("assigned", lambda p: p["kind"] == _kind("weak_assign")),
        _parts(text, ACCOUNT, lambda v: _kind("weak_access")),
        _parts(text, MIXED, lambda v: F.when(_mixed(v), _kind("weak_secret"))),
        _parts(text, ENDPOINT, lambda v: _kind("endpoint")),
    )
    return first.withColumn(
        "weak", F.array_sort(_let(weak, lambda parts: _apart(parts, F.col("base"))))
    ).drop("assigned")


def _keyed(docs: DataFrame, text_column: str = "text") -> DataFrame:
    return docs.withColumns(
        {"k1": F.xxhash64("doc_id", text_column), "k2": F.hash(text_column, "doc_id")}
    )


def linked_parts(scan: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(k1, k2, linked): the weak parts of each text that complementary parts stand near to."""
    roles = F.array(*[F.lit(ROLES[k]) for k in KINDS])
    some = scan.where(F.size("weak") > 0).select("k1", "k2", "base", "weak").distinct()
    parts = some.select(
        "k1", "k2", F.explode(F.concat("base", "weak")).alias("part")
    ).select(
        "k1",
        "k2",
        "part",
        roles[F.col("part.kind")].alias("role"),
        F.col("part.start").alias("lo"),
        F.col("part.end").alias("hi"),
    )

    def cell(more: int) -> Column:
        ends = [F.floor(F.col(c) / scope) + d for c, d in (("lo", -more), ("hi", more))]
        return F.explode(F.sequence(*ends)).alias("cell")

    cells = (
        parts.select("k1", "k2", "role", "lo", "hi", cell(0))
        .groupBy("k1", "k2", "cell", F.col("role").alias("near_role"))
        .agg(F.min("lo").alias("low"), F.max("hi").alias("high"))
    )
    asks = parts.where(F.col("part.kind") >= KINDS.index("weak_assign")).select(
        "k1", "k2", "part", "role", "lo", "hi", cell(1)
    )
    near = (F.col("high") >= F.col("lo") - scope) & (F.col("low") <= F.col("hi") + scope)
    met = (
        asks.join(cells, ["k1", "k2", "cell"])
        .where((F.col("role") != F.col("near_role")) & near)
        .groupBy("k1", "k2", "part", "role")
        .agg(
            *[
                F.bool_or(F.col("near_role") == r).alias(r)
                for r in ("id", "secret", "endpoint")
            ]
        )
        .where(
            "CASE role WHEN 'secret' THEN id OR endpoint WHEN 'id' THEN secret "
            "ELSE id AND secret END"
        )
    )
    return met.groupBy("k1", "k2").agg(F.array_sort(F.collect_list("part")).alias("linked"))


def _joined(parts: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            parts,
            lambda p: F.concat_ws(
                ":", names[p["kind"]], p["start"].cast("string"), p["end"].cast("string")
            ),
        ),
        ",",
    )


def credential_spans(
    docs: DataFrame,
    *,
    scope: int = SCOPE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex (base spans), base_sha256 (of
    the base spans as text), n_linked (weak parts reported), spans (all, as text)."""
    picked = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    scan = written(_keyed(scanned(picked)).drop("text"), "credentials")
    all_rows = scan.join(linked_parts(scan, scope), ["k1", "k2"], "left")
    linked = F.coalesce("linked", F.array().cast(PART))
    count = lambda kind: F.size(
        F.filter("base", lambda p: p["kind"] == KINDS.index(kind))
    ).cast("long")
    return all_rows.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        F.size(linked).cast("long").alias("n_linked"),
        _joined(F.array_sort(F.concat("base", linked))).alias("spans"),
    )


def _redacted(text: Column, parts: Column, mark: str) -> Column:
    """``text`` with ``mark`` for each run of overlapping ``parts``, which are sorted.  What stays is cut from
    blocks of the text, not from its start, and joined once."""

    def pieces(blocks: Column) -> Column:
        def between(start: Column, end: Column) -> Column:
            numbers = F.sequence(
                F.floor(start / TEXT_BLOCK), F.floor((end - 1) / TEXT_BLOCK), F.lit(1).cast("long")
            )
            cut = F.transform(
                numbers,
                lambda n: F.substring(
                    F.get(blocks, n.cast("int")),
                    (F.greatest(start - n * TEXT_BLOCK, F.lit(0)) + 1).cast("int"),
                    (end - F.greatest(start, n * TEXT_BLOCK)).cast("int"),
                ),
            )
            return F.when(end > start, F.array_join(cut, "")).otherwise("")

        def piece(furthest: Column, part: Column, i: Column) -> Column:
            at = F.coalesce(F.get(furthest, i - 1), F.lit(0).cast("long"))
            return F.when(
                part["start"] >= at, F.concat(between(at, part["start"]), F.lit(mark))
            ).otherwise("")

        def joined(furthest: Column) -> Column:
            rest = between(F.element_at(furthest, -1), F.length(text).cast("long"))
            marked = F.transform(parts, lambda part, i: piece(furthest, part, i))
            return F.concat(F.array_join(marked, ""), rest)

        ends = F.transform(parts, lambda part: part["end"])
        return _let(_running(ends, F.greatest), joined)

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0))
    return _let(blocks, pieces)


def redact(docs: DataFrame, *, mark: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by ``mark`` and ``n_chars``, if there, set
    anew.  The rows are written once with what was found in them, so no pattern runs twice; only texts with
    weak candidates take part in the join."""
    own = docs.columns
    inner = inner_names(own, "doc_id", "text")
    scan = written(_keyed(scanned(docs.toDF(*inner))), "credentials")
    plain = scan.where(F.size("weak") == 0).withColumn("spans", F.col("base"))
    asked = scan.where(F.size("weak") > 0)
    joined = asked.join(linked_parts(scan, scope), ["k1", "k2"], "left").withColumn(
        "spans", F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(PART))))
    )
    every = plain.select(*inner, "spans").union(joined.select(*inner, "spans"))
    text = F.when(
        F.size("spans") > 0, _redacted(F.col("text"), F.col("spans"), mark)
    ).otherwise(F.col("text"))
    out = every.withColumn("text", text)
    if "n_chars" in own:
        name = inner[own.index("n_chars")]
        length = F.when(F.size("spans") > 0, F.length("text").cast(dict(docs.dtypes)["n_chars"]))
        out = out.withColumn(name, F.coalesce(length, name))
    return own_names(out, inner, own)


def _sql_hits(kind: str, pattern: str, group: int, test: str) -> str:
    quoted = pattern.replace("'", "''")
    return (
        f"SELECT rid, {KINDS.index(kind)} AS kind, i, g, m, v, coalesce({test}, false) AS ok FROM "
        f"(SELECT rid, unnest(regexp_split_to_array(t, '{quoted}')) AS g, "
        f"unnest(regexp_extract_all(t, '{quoted}', 0)) AS m, "
        f"unnest(regexp_extract_all(t, '{quoted}', {group})) AS v, "
        f"unnest(range(len(regexp_split_to_array(t, '{quoted}')))) AS i FROM d)"
    )


def oracle() -> str:
    """The same result in DuckDB's SQL."""
    mixed = " AND ".join(f"regexp_matches(v, '{c}')" for c in ("[a-z]", "[A-Z]", "[0-9]"))
    hits = " UNION ALL ".join(
        [
            _sql_hits("assign", ASSIGN, 2, "length(v) >= 6"),
            _sql_hits("access", ACCESS, 0, "v IS NOT NULL"),
            _sql_hits("hex", HEX, 0, "v IS NOT NULL"),
            _sql_hits("weak_assign", ASSIGN, 2, "length(v) < 6"),
            _sql_hits("weak_access", ACCOUNT, 0, "v IS NOT NULL"),
            _sql_hits("weak_secret", MIXED, 0, mixed),
            _sql_hits("endpoint", ENDPOINT, 0, "v IS NOT NULL"),
        ]
    )
    names = ", ".join(f"'{k}'" for k in KINDS)
    roles = ", ".join(f"'{ROLES[k]}'" for k in KINDS)
    span = f"[{names}][kind + 1] || ':' || s || ':' || e"
    near = (
        "EXISTS (SELECT 1 FROM p q WHERE q.rid = p.rid AND q.role = '{}' AND "
        f"q.s <= p.e + {SCOPE} AND q.e >= p.s - {SCOPE})"
    )
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
hit AS ({hits}),
placed AS (SELECT rid, kind, ok, CAST(sum(length(g) + coalesce(length(m), 0))
  OVER (PARTITION BY rid, kind ORDER BY i) AS BIGINT) AS e, length(m) AS n FROM hit),
span AS (SELECT rid, kind, e - n AS s, e FROM placed WHERE ok),
p AS (SELECT *, [{roles}][kind + 1] AS role FROM span WHERE kind < 3 OR NOT EXISTS
  (SELECT 1 FROM span b WHERE b.rid = span.rid AND b.kind < 3 AND b.s < span.e AND span.s < b.e)),
kept AS (SELECT * FROM p WHERE kind < 3 OR (role = 'secret' AND ({near.format('id')} OR
  {near.format('endpoint')})) OR (role = 'id' AND {near.format('secret')}) OR (role = 'endpoint'
  AND {near.format('id')} AND {near.format('secret')})),
g AS (SELECT rid, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b,
  count(*) FILTER (kind = 2) AS c, count(*) FILTER (kind > 2) AS l,
  string_agg({span}, ',' ORDER BY s, kind) FILTER (kind < 3) AS base,
  string_agg({span}, ',' ORDER BY s, kind) AS spans FROM kept GROUP BY rid)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(l, 0) AS n_linked,
  coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)"""
