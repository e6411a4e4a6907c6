"""Exact top-k search by tiled matrix products.

Queries are cut into blocks and candidates into shards, both by hash and both of bounded
size; every (block, shard) pair is one tile that multiplies two matrices and keeps the k
best candidates of each query (partial selection). The lists of a query are then merged
as a tree: groups of ``fan_in`` shards, level by level, until one list is left.

Scores are integer inner products of ``floor(scale * x)``; tiles compute them in doubles
while every partial sum is exact there (below 2**53) and in Python integers otherwise.
Vectors that are null or hold null or non-finite components take no part; vectors are
compared only with vectors of the same length. Null ids take no part. Repeated rows are
candidates one by one, and a query's own id is never its candidate. Ties go to the
smaller id. An empty vector scores 0 against other empty vectors. Scaled components
saturate at 2**60 either way and scores at the range of a long, so huge finite components
are ranked as far as longs tell them apart.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for vectors that are not null and hold only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def _matrix(vectors: pd.Series, scale: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        whole = np.floor(np.stack([np.asarray(v, dtype=np.float64) for v in vectors]) * scale)
    return np.clip(whole, -2.0 ** 60, 2.0 ** 60)


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products of two integral double matrices."""
    if q.shape[1] == 0:
        return np.zeros((len(q), len(c)))
    if np.abs(q).max() * np.abs(c).max() * q.shape[1] < 2.0 ** 53:
        return q @ c.T
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(q).dot(whole(c).T), -2 ** 63, 2 ** 63 - 1)


def _tile(k: int, scale: float):
    def work(key, queries: pd.DataFrame, cands: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(cands):
            cands = cands.sort_values("cand", kind="stable")  # then a stable sort breaks ties
            cid = cands["cand"].to_numpy()
            scores = _products(_matrix(queries["v"], scale), _matrix(cands["cv"], scale))
            for qid, row in zip(queries["id"], scores):
                keep = np.flatnonzero(cid != qid)
                s = row[keep]
                if len(s) > k:  # partial selection: everything at least as good as the k-th
                    at_least = np.partition(s, len(s) - k)[len(s) - k] if s.dtype != object \
                        else sorted(s)[-k]
                    keep = keep[s >= at_least]
                    s = row[keep]
                best = sorted(range(len(s)), key=lambda i: -s[i])[:k]
                out += [(qid, key[2], int(cid[keep[i]]), int(s[i])) for i in best]
        return pd.DataFrame(out, columns=["query_id", "shard", "vec_id", "score"])
    return work


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0,
          id_col: str = "vec_id", vector_col: str = "embedding", query_block: int = 1024,
          shard_rows: int = 8192, fan_in: int = 16) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of all other rows for each query row."""
    rows = vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
        F.size(vector_col).alias("dim"), is_query.alias("is_query"))
    n, nq = rows.agg(F.count("*"), F.count_if("is_query")).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-nq // query_block))
    # Rows are spread by hash, repeats of one id included, so no tile exceeds its size by much.
    spread = F.xxhash64("id", F.monotonically_increasing_id())
    queries = (rows.filter("is_query").withColumn("block", F.pmod(spread, F.lit(blocks)))
               .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
               .select("dim", F.col("block").cast("int"), F.col("shard").cast("int"), "id", "v"))
    cands = (rows.withColumn("shard", F.pmod(spread, F.lit(shards)))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .select(*(F.col(c).cast("int").alias(c) for c in ("dim", "block", "shard")),
                     F.col("id").alias("cand"), F.col("v").alias("cv")))
    key = ["dim", "block", "shard"]
    lists = queries.groupBy(*key).cogroup(cands.groupBy(*key)).applyInPandas(
        _tile(k, scale), "query_id long, shard int, vec_id long, score long")

    def best(part: list[str]):
        return Window.partitionBy(*part).orderBy(F.col("score").desc(), "vec_id")

    while shards > fan_in:
        shards = -(-shards // fan_in)
        lists = (lists.withColumn("shard", F.floor(F.col("shard") / fan_in).cast("int"))
                 .withColumn("rank", F.row_number().over(best(["query_id", "shard"])))
                 .filter(F.col("rank") <= k).drop("rank"))
    return (lists.withColumn("rank", F.row_number().over(best(["query_id"])))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
