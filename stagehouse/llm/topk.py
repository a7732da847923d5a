"""Exact top-k search by inner product, with norm buckets.

Vectors are grouped by length into buckets of about ``BUCKET_VECTORS``.  Each query first meets
the longest vectors; its k-th best score there is a lower bound of its final one.  A bucket whose
longest vector, at cosine 1, stays below that bound is not visited at all: the query is sent only
to the buckets that remain, in blocks of queries.  In a bucket the bound gives a cosine threshold
of its own.  Where it is high, coordinates prune: a unit vector can reach cosine t with the query only
if its coordinate at the query's largest ones lies in a narrow interval.  Else length prunes: the
bucket is sorted by length, and vectors too short to reach the bound at cosine 1 end the scan.
What is left is verified by exact integer products; buckets are searched side by side, with one bound.

Components are floor(scale * x).  Vectors that are null, empty or hold null or non-finite components take no
part, nor do null ids.  Vectors meet only those of the same number of components.  Of rows with the
same id the least vector counts.  Components and scores beyond 64 bits count as the nearest number that fits.
Ties go to the smaller id.  Fewer candidates than k give all.
"""

from __future__ import annotations

import math
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagehouse.llm.storage import ship_package, written

BUCKET_VECTORS, QUERY_BLOCK, HEAD_VECTORS = 4096, 512, 2048
HIGH_COSINE = 0.5
MOST = 2**63 - 1
FOCUS = 3


def quantized(vectors: DataFrame, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v, norm): one row per id, integer components."""
    x = F.col(vector_column)
    scaled = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    finite = F.forall(
        x,
        lambda c: c.isNotNull()
        & ~F.isnan(c.cast("double"))
        & (F.abs(c.cast("double")) < F.lit(float("inf"))),
    )
    usable = vectors.where(
        F.col(id_column).isNotNull() & x.isNotNull() & (F.size(x) > 0) & finite
    ).select(F.col(id_column).cast("long").alias("vec_id"), scaled.alias("v"))
    once = usable.groupBy("vec_id").agg(F.min("v").alias("v"))
    square = F.aggregate(
        "v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")
    )
    return once.withColumn("norm", F.sqrt(square)).withColumn("dims", F.size("v"))


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles where every partial sum fits, else in 64-bit integers, else in
    integers of any length, of which those beyond 64 bits become the nearest that fits."""
    most = 1.0 * queries.shape[1]
    for side in (queries, vectors):
        most *= float(np.abs(side.astype(float)).max(initial=0))
    if most < 2**53:
        return np.rint(queries.astype(float) @ vectors.astype(float).T).astype(np.int64)
    if most < 2**62:
        return queries @ vectors.T
    exact = queries.astype(object) @ vectors.astype(object).T
    return np.clip(exact, -MOST, MOST).astype(np.int64)


def best_in_bucket(
    query: np.ndarray, query_id: int, norm: float, bound: float, k: int, bucket: Bucket
) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the bucket's vectors that may be among the k best, best first."""
    if bound <= 0 or norm == 0:
        pick = slice(None)  # nothing can be pruned below a positive bound
    else:
        slack = bound * (1 - 1e-9)
        local = slack / (norm * bucket.norms[0]) if bucket.norms[0] else 2.0
        if local > 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # length: the bucket is sorted by length, longest first
        reach = int(np.searchsorted(-bucket.norms, -slack / norm, "right"))
        pick = slice(reach)
        if local >= HIGH_COSINE:
            pick, unit = np.arange(reach), query / norm
            for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
                width = math.sqrt((1 - local**2) * max(0.0, 1 - unit[f] ** 2)) + 1e-9
                at = bucket.units[pick, f]
                pick = pick[(at >= unit[f] * local - width) | (unit[f] < 0)]
                at = bucket.units[pick, f]
                pick = pick[(at <= unit[f] * local + width) | (unit[f] > 0)]
    ids = bucket.ids[pick]
    scores = bucket.scores(query, pick)
    other = (ids != query_id) & (scores >= bound - abs(bound) * 1e-9)
    if other.sum() > k:
        other &= scores >= np.partition(scores[other], -k)[-k]
    ids, scores = ids[other], scores[other]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


class Bucket:
    """Vectors of one group, longest first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray):
        order = np.lexsort((ids, -norms))
        self.ids, self.vectors, self.norms = ids[order], vectors[order], norms[order]
        self.doubles = self.vectors.astype(float)
        self.units = self.doubles / np.maximum(self.norms, 1e-12)[:, None]
        self.most = float(np.abs(self.doubles).max(initial=0))

    def scores(self, query: np.ndarray, pick: slice | np.ndarray) -> np.ndarray:
        asked = query.astype(float)
        if self.most * float(np.abs(asked).max(initial=0)) * len(query) < 2**53:
            return np.rint(self.doubles[pick] @ asked).astype(np.int64)
        return products(query[None, :], self.vectors[pick])[0]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1), np.int64)


def head_bounds(queries: DataFrame, candidates: DataFrame, k: int, blocks: int) -> DataFrame:
    """``queries`` with ``bound`` and ``block``: the k-th best score among the longest vectors of their number
    of components, or the least double where those are fewer than k."""
    longest = Window.partitionBy("dims").orderBy(F.desc("norm"), "vec_id")
    heads = (
        candidates.withColumn("place", F.row_number().over(longest))
        .where(f"place <= {HEAD_VECTORS} AND place <= greatest(64, {HEAD_VECTORS * 64} div dims)")
        .select("dims", "vec_id", "v")
    )
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")
    asked = queries.select("dims", block, "vec_id", "v", "norm")
    held = heads.join(asked.select("dims", "block").distinct(), "dims")

    def bound(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = []
        if asked.num_rows:
            ids, vectors = held["vec_id"].to_numpy(), _matrix(held["v"])
            for query_id, v in zip(asked["vec_id"].to_pylist(), _matrix(asked["v"]), strict=True):
                scores = products(v[None, :], vectors)[0][ids != query_id]
                enough = len(scores) >= k
                out.append(float(-np.partition(-scores, k - 1)[k - 1]) if enough else -math.inf)
        return asked.append_column("bound", pa.array(out, pa.float64()))

    ship_package(queries.sparkSession)
    asked, held = asked.toDF(*asked.columns), held.toDF(*held.columns)
    return (
        asked.groupBy("dims", "block")
        .cogroup(held.groupBy("dims", "block"))
        .applyInArrow(
            bound, "dims int, block int, vec_id long, v array<long>, norm double, bound double"
        )
    )


def bucket_edges(candidates: DataFrame) -> dict[int, np.ndarray]:
    """For each number of components with more than a bucket's vectors, the norms that part its buckets,
    rising."""
    out = {}
    many = candidates.groupBy("dims").count().where(f"count > {BUCKET_VECTORS}")
    for d, n in many.collect():
        parts = math.ceil(n / BUCKET_VECTORS)
        found = (
            candidates.where(F.col("dims") == d)
            .agg(F.percentile_approx("norm", [i / parts for i in range(1, parts)], 10_000))
            .first()[0]
        )
        out[d] = np.unique(np.array(found, float))
    return out


def _bucket_of(edges: dict[int, np.ndarray]):
    """A function of (dims, length): the bucket of that length, 0 for the longest."""

    def bucket(dims: pd.Series, length: pd.Series) -> pd.Series:
        dims, length = dims.to_numpy(), length.to_numpy()
        out = np.zeros(len(dims), np.int32)
        for d in np.unique(dims):
            own, marks = dims == d, edges.get(int(d), np.zeros(0))
            out[own] = len(marks) - np.searchsorted(marks, length[own], "left")
        return pd.Series(out)

    return F.pandas_udf(bucket, "int")


def top_k(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 5,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` whose id meets ``is_query`` (a
    condition on ``vec_id``)."""
    candidates = written(quantized(vectors, scale, id_column, vector_column), "vectors")
    asked = candidates.where(is_query)
    blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    queries = written(head_bounds(asked, candidates, k, blocks), "queries")
    spark = vectors.sparkSession
    ship_package(spark)
    bucket_of = _bucket_of(bucket_edges(candidates))  # a number per BUCKET_VECTORS vectors
    placed = candidates.withColumn("bucket", bucket_of("dims", "norm"))
    # buckets that hold many equal norms are cut further, by id
    size = placed.groupBy("dims", "bucket").agg(
        F.count("*").alias("n"), F.max("norm").alias("longest")
    )
    sizes = written(
        size.withColumn("parts", F.ceil(F.col("n") / (2 * BUCKET_VECTORS)).cast("int")), "sizes"
    )
    group = ["dims", "bucket", "part", "block"]
    # buckets fall in length: a query visits all down to the length that its bound asks for
    needed = F.when(
        (F.col("bound") > 0) & (F.col("norm") > 0), F.col("bound") * (1 - 1e-9) / F.col("norm")
    ).otherwise(F.lit(0.0))
    query_side = (
        queries.withColumn("last", bucket_of("dims", needed))
        .withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("last"))))
        .join(sizes, ["dims", "bucket"])
        .where("bound <= 0 OR norm * longest >= bound * (1 - 1e-9)")
        .select(
            "dims",
            "bucket",
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
            "block",
            "vec_id",
            "v",
            "norm",
            "bound",
        )
    )
    asking = query_side.select(*group).distinct()
    vector_side = (
        placed.join(sizes.select("dims", "bucket", "parts"), ["dims", "bucket"])
        .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
        .join(asking, group[:3])  # one copy for each block of queries that comes here
        .select(*group, "vec_id", "v", "norm")
    )

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if asked.num_rows and held.num_rows:
            bucket = Bucket(
                held["vec_id"].to_numpy(), _matrix(held["v"]), held["norm"].to_numpy()
            )
            for query_id, v, norm, bound in zip(
                asked["vec_id"].to_pylist(),
                _matrix(asked["v"]),
                asked["norm"].to_pylist(),
                asked["bound"].to_pylist(),
                strict=True,
            ):
                ids, scores = best_in_bucket(v, query_id, norm, bound, k, bucket)
                out["query_id"] += [query_id] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += scores.tolist()
        return pa.table({n: pa.array(x, pa.int64()) for n, x in out.items()})

    query_side = query_side.toDF(*query_side.columns)  # columns of their own on either side
    vector_side = vector_side.toDF(*vector_side.columns)
    found = (
        query_side.groupBy(*group)
        .cogroup(vector_side.groupBy(*group))
        .applyInArrow(search, "query_id long, vec_id long, score long")
    )
    best = F.sort_array(
        F.collect_list(F.struct((-F.col("score")).alias("low"), "vec_id")), asc=True
    )
    return (
        found.groupBy("query_id")  # k rows per bucket visited
        .agg(F.slice(best, 1, k).alias("best"))
        .select("query_id", F.posexplode("best").alias("place", "one"))
        .select(
            "query_id",
            (F.col("place") + 1).cast("int").alias("rank"),
            "one.vec_id",
            (-F.col("one.low")).alias("score"),
        )
    )
