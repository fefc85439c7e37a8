"""Vector search: exact cosine against all vectors, in blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_QUERIES = 4096


def top_k(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int, exclude_self: bool = True, block: int = MOST_QUERIES) -> DataFrame:
    """(query_id, id, similarity, rank): the k nearest of all vectors for every query, ties by smaller id.

    The queries are taken in blocks of bounded size; every task keeps its own k best per query in one matrix product,
    and only those meet in the shuffle.  Null vectors are skipped.
    """
    spark = vectors.sparkSession
    rows = queries.where(F.col(vector).isNotNull()).select(F.col(key).alias("q"), F.col(vector).alias("v")).orderBy("q")
    out = None
    last = None
    while True:
        part = rows.where(F.col("q") > last) if last is not None else rows
        got = part.limit(block).collect()
        if not got:
            break
        last = got[-1]["q"]
        ids = np.array([r["q"] for r in got])
        matrix = _unit(np.array([r["v"] for r in got], np.float32))
        near = _scan(vectors, spark.sparkContext.broadcast((ids, matrix)), key, vector, k, exclude_self)
        out = near if out is None else out.unionByName(near)
        if len(got) < block:
            break
    if out is None:
        return spark.createDataFrame([], "query_id long, id long, similarity double, rank int")
    ranked = out.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("similarity")).alias("s"), "id"))), 1, k).alias("best"))
    return ranked.select("query_id", F.posexplode("best").alias("pos", "b")).select("query_id", F.col("b.id").alias("id"), (-F.col("b.s")).alias("similarity"), (F.col("pos") + 1).alias("rank"))


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n == 0, 1, n)


def _scan(vectors: DataFrame, shared, key: str, vector: str, k: int, exclude_self: bool) -> DataFrame:
    def run(batches):
        ids, matrix = shared.value
        best_s, best_i = np.full((len(ids), 0), -2.0, np.float32), np.zeros((len(ids), 0), np.int64)
        for batch in batches:
            own = batch.column(0).to_numpy()
            flat = batch.column(1)
            rows = _unit(np.asarray(flat.flatten().to_numpy(zero_copy_only=False), np.float32).reshape(len(own), -1)) if len(own) else np.zeros((0, matrix.shape[1]), np.float32)
            sims = matrix @ rows.T
            if exclude_self:
                sims[ids[:, None] == own[None, :]] = -2.0
            s, i = np.concatenate([best_s, sims], 1), np.concatenate([best_i, np.broadcast_to(own, sims.shape)], 1)
            order = np.lexsort((i, -s), axis=1)[:, :k]
            best_s, best_i = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
        ok = best_s > -1.5
        q = np.broadcast_to(ids[:, None], best_s.shape)
        yield pa.record_batch([pa.array(q[ok]), pa.array(best_i[ok]), pa.array(best_s[ok].astype(np.float64))], names=["query_id", "id", "similarity"])

    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("i"), F.col(vector).alias("v"))
    return rows.mapInArrow(run, "query_id long, id long, similarity double")


def cosine(a, b):
    """Cosine of two arrays as a JVM expression."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(F.transform(v, lambda x: x.cast("double") * x), F.lit(0.0), lambda s, x: s + x))
    return F.try_divide(dot, norm(a) * norm(b))
