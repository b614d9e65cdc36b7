"""Exact top-k search by inner product over scaled integer vectors.

Queries and candidates are cut into blocks, and every pair of blocks is a tile: matrix products of a few queries at
a time with the candidates, from which each query keeps its k best at once. The lists of a query are then merged
``FAN`` at a time until one is left.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.session import stored_copy

SCALE = 1024
K = 10
#: Vectors of a block of queries and of a block of candidates: a candidate travels once for each block of queries.
QUERIES, SHARD = 32_768, 16_384
#: Lists that one merge reads.
FAN = 16


def scaled(column: pa.ListArray | pa.ChunkedArray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as 64-bit floats: whole numbers, exact for every component that a double holds exactly."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Whole-number inner products as 64-bit integers; beyond their range the nearest such number.

    Below 2^53 sums of doubles are exact in any order; larger ones are summed as Python's whole numbers.
    """
    bound = np.abs(queries).max(initial=0) * np.abs(shard).max(initial=0) * max(1, queries.shape[1])
    if bound < 2.0 ** 53:
        return (queries @ shard.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in shard]
    out = np.empty((len(queries), len(shard)), dtype=np.int64)
    for i, row in enumerate(queries):
        q = [int(x) for x in row]
        out[i] = [min(max(sum(a * b for a, b in zip(q, s)), -(1 << 63)), (1 << 63) - 1) for s in whole]
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id: partial selection, then a sort of what is left."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        chosen = np.flatnonzero(scores >= least)
    else:
        chosen = np.arange(len(scores))
    order = np.lexsort((ids[chosen], -scores[chosen].astype(object) if (scores == -(1 << 63)).any() else -scores[chosen]))
    return chosen[order[:k]]


_SCHEMA = "query_id long, vec_id long, score long, list long"


def _tile(k: int, scale: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def search(queries: pa.Table, shard: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if queries.num_rows and shard.num_rows:
            qid, sid = (t.column("vec_id").to_numpy() for t in (queries, shard))
            mark = shard.column("shard")[0].as_py()
            a, b = scaled(queries.column("embedding"), scale), scaled(shard.column("embedding"), scale)
            for start in range(0, len(a), 64):
                scores = products(a[start:start + 64], b)
                for q, row in zip(qid[start:start + 64], scores):
                    other = np.flatnonzero(sid != q)
                    top = other[best(row[other], sid[other], k)]
                    out.append((np.full(len(top), q), sid[top], row[top], np.full(len(top), mark)))
        columns = [np.concatenate([x[i] for x in out]) if out else np.zeros(0, dtype=np.int64) for i in range(4)]
        return pa.table(dict(zip(("query_id", "vec_id", "score", "list"), columns)))
    return search


def _block(n: int):
    return F.pmod(F.xxhash64("row"), F.lit(n))


def search(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, query_rows: int = QUERIES,
           shard_rows: int = SHARD) -> DataFrame:
    """The k best candidates of each query: query_id, rank (from 1), vec_id, score.

    Both tables have vec_id and embedding; other columns are not read. The score is the inner product of
    floor(scale * x); ties go to the smaller vec_id. A query's own id is no candidate. Rows with a null id,
    a null vector, or a null or non-finite component take no part, and vectors of another length than the
    query's neither. Every row takes part, those too that repeat an id or a whole row: each is a candidate of its own,
    and a query id of several rows has one list, of the best pairs of one of its rows and a candidate. Scores beyond 64 bits
    are cut to that range. Empty tables give no row.
    """
    def sound(df: DataFrame) -> DataFrame:
        df = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
        fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        # Stored with a number each, so that a row lies in one block whatever task is run again.
        return stored_copy(df.filter(F.col("vec_id").isNotNull() & fine).withColumn("row", F.monotonically_increasing_id()), "vectors")

    vectors, queries = sound(vectors), sound(queries)
    n_queries, n_vectors = queries.count(), vectors.count()
    blocks, shards = max(1, -(-n_queries // query_rows)), max(1, -(-n_vectors // shard_rows))
    # Enough tiles to use the cluster even where both sides are short.
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(shards, min(tasks, -(-n_vectors // 1024)))
    grid = ["dim", "query_block", "shard"]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = (queries.select("vec_id", "embedding", F.size("embedding").alias("dim"), _block(blocks).cast("int").alias("query_block"))
            .select("*", every(shards).alias("shard")))
    right = (vectors.select("vec_id", "embedding", F.size("embedding").alias("dim"), _block(shards).cast("int").alias("shard"))
             .select("*", every(blocks).alias("query_block")))
    lists = left.groupBy(*grid).cogroup(right.groupBy(*grid)).applyInArrow(_tile(k, scale), _SCHEMA)
    order = F.struct("score", (-F.col("vec_id")).alias("v"))
    n = shards
    while True:
        n = -(-n // FAN)
        merged = lists.groupBy("query_id", F.floor(F.col("list") / FAN).alias("list")).agg(
            F.slice(F.sort_array(F.collect_list(order), asc=False), 1, k).alias("top"))
        if n <= 1:
            break
        lists = merged.select("query_id", "list", F.explode("top").alias("t")).select(
            "query_id", (-F.col("t.v")).alias("vec_id"), "t.score", "list")
    return merged.select("query_id", F.posexplode("top").alias("at", "t")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), (-F.col("t.v")).alias("vec_id"), F.col("t.score").alias("score"))
