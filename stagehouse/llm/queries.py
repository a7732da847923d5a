"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.llm import (
    best_fit,
    credentials,
    decontaminate,
    jaccard,
    language,
    ordinal,
    prefix_tokens,
    prefix_trie,
    syncmers,
    tiers,
    topk,
    toxicity,
    whitening,
)
from stagehouse.llm.features import remainder
from stagehouse.llm.storage import table

GRADES = "CASE WHEN quality = 0 THEN 0 WHEN toxic = 1 THEN 1 WHEN quality = 1 THEN 2 END"


def op1_norm_bucket_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.expr("vec_id % 50 = 0"), k=5, scale=256)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op3_best_fit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack_token_rows(table(spark, sf_dir, "documents"))


def op4_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.credential_spans(table(spark, sf_dir, "documents"))


def op5_tiered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiers.pack_documents(table(spark, sf_dir, "documents"))


def op6_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 low quality, 1 good but toxic, 2 good.  Rows whose crc32 mod 4 is 2 are held out."""
    docs = table(spark, sf_dir, "documents")
    ratings = table(spark, sf_dir, "labels").select("doc_id", F.expr(GRADES).alias("grade"))
    model = ordinal.fit(docs, ratings.where(remainder("doc_id", 4) != 2))
    return ordinal.grade_documents(docs, model, least_grade=1)


def op7_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = language.learn_prototypes(docs.where(remainder("doc_id", 3) != 1))
    held = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return language.identify(docs, prototypes).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score"
    )


def op8_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return prefix_tokens.count_tokens(docs, limit=1024)


def op9_token_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_classes(table(spark, sf_dir, "documents"), words=3, percent=90)


def op10_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), toxicity.fit(docs, labels))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_documents(table(spark, sf_dir, "documents"))


def op13_jacobi_davidson_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)


QUERIES = {
    f.__name__: f
    for f in (
        op1_norm_bucket_topk,
        op2_decontaminate,
        op3_best_fit_rows,
        op4_credentials,
        op5_tiered_packing,
        op6_ordinal_quality,
        op7_hyperdimensional_language,
        op8_prefix_tokens,
        op9_token_combinations,
        op10_weak_toxicity,
        op11_prefix_trie,
        op12_closed_syncmers,
        op13_jacobi_davidson_whitening,
    )
}

OP1_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
  CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT)
  AS rank, vec_id, score FROM s QUALIFY rank <= 5"""

OP9_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, list_filter_words AS w FROM (SELECT doc_id,
  [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS list_filter_words
  FROM documents)),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3
  THEN [array_to_string(w, ' ')]
  ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])
  END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach
  JOIN link ON link.a = reach.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN n USING (doc_id) JOIN least USING (doc_id)"""

SQL = {
    "op1_norm_bucket_topk": OP1_SQL,
    "op4_credentials": credentials.oracle(),
    "op9_token_combinations": OP9_SQL,
}
