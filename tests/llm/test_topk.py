import math
import random

from ratecraft.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, shard string, rank int"


def brute(rows, queries, k):
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v, *_ in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted(set(queries)):
        scores = sorted((-sum(a * b for a, b in zip(w, v)), i) for j, w in whole if j == q for i, v in whole if i != q and len(v) == len(w))
        out += [(q, r, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for r, (s, i) in enumerate(scores[:k], 1)]
    return out


def check(spark, rows, queries, k=10, **sizes):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = topk.search(df, df.filter(df.vec_id.isin(queries)), k, **sizes).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, queries, k)


def test_against_brute_force(spark):
    rng = random.Random(1)
    grid = [x / 8 for x in range(-20, 20)]
    rows = [(i, [rng.choice(grid) for _ in range(6)], "", "", 1) for i in range(300)]
    rows += [(300 + i, rows[7][1], "", "", 1) for i in range(40)] + [rows[5]] * 3  # a very common vector, repeated rows
    rows += [(400, None, "", "", 1), (401, [None] * 6, "", "", 1), (402, [float("nan")] * 6, "", "", 1),
             (403, [float("inf")] * 6, "", "", 1), (None, rows[1][1], "", "", 1), (404, [1.0, 2.0], "", "", 1), (405, [2.0, 1.0], "", "", 1), (406, [], "", "", 1)]
    queries = [0, 5, 7, 310, 400, 402, 404, 406, 9999]
    check(spark, rows, queries)
    check(spark, rows, queries, query_rows=2, shard_rows=7)
    check(spark, rows, queries, k=3, query_rows=3, shard_rows=11)


def test_few_rows_large_values_and_empty_table(spark):
    check(spark, [(0, [1.0], "", "", 1), (1, [2.0], "", "", 1)], [0, 1])
    check(spark, [(0, [3e38, 1.0], "", "", 1), (1, [-3e38, 1.0], "", "", 1), (2, [1e9, 3e9], "", "", 1), (3, [1e9, 2e9], "", "", 1)], [0, 2])
    check(spark, [], [0])


def test_ids_of_several_vectors(spark):
    """No row is lost: the best of an id's vectors is found, and a query of two vectors has one list."""
    rows = [(100, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0]), (1, [1.0, 0.0]), (7, [0.25, 0.0]), (7, [0.0, 0.5])]
    rows = [(*r, "", "", 1) for r in rows]
    check(spark, rows, [100, 7])
    check(spark, rows, [100, 7], k=3, query_rows=1, shard_rows=2)
