import math
import random

import numpy as np
from pyspark.sql import functions as F

from ratecraft.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<float>, row string, shard string, anchor string, dim int"


def brute(rows, anchors, positives=5, chosen=3):
    fine = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v, *_ in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    cut = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    out = []
    for at, (i, label, v) in enumerate(fine):
        if i not in anchors:
            continue
        scored = [(-cut(sum(a * b for a, b in zip(v, w))), j, other) for k, (j, other, w) in enumerate(fine) if k != at and len(w) == len(v)]
        for s, j, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            inside = sorted(x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s)
            out += [(i, j, rank, k, -s, -t) for rank, (t, k, _) in enumerate(inside[:chosen], 1)]
    return sorted(out)


def check(spark, rows, anchors, **sizes):
    df = spark.createDataFrame([(*r, "", "", "", 1) for r in rows], SCHEMA).repartition(3)
    found = negatives.mine(df, F.col("vec_id").isin(anchors), **sizes).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, anchors)


def vectors(rng, n, dims=12):
    """Vectors around a few centres, on a grid that makes ties."""
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(6)]
    return [[round(8 * (c + rng.gauss(0, 0.4))) / 8 for c in rng.choice(centres)] for _ in range(n)]


def test_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(4), v) for i, v in enumerate(vectors(rng, 300))]
    rows += [(300 + i, i % 3, rows[7][2]) for i in range(40)]  # a very common vector
    rows += [rows[5]] * 2 + [(5, 3, rows[9][2])]  # rows repeated, and an id with another label
    rows += [(400, None, rows[1][2]), (401, 1, None), (402, 1, [None] * 12), (403, 1, [float("nan")] * 12), (404, 1, [float("inf")] * 12),
             (None, 1, rows[1][2]), (405, 1, [1.0, 2.0]), (406, 2, [2.0, 1.0]), (407, 1, [1.0, 2.0]), (408, 1, []), (409, 2, [])]
    anchors = [0, 5, 7, 31, 310, 400, 402, 405, 408, 9999]
    check(spark, rows, anchors)
    check(spark, rows, anchors, shard_rows=50, block_rows=3)


def test_few_rows_large_values_and_empty_table(spark):
    check(spark, [], [0])
    check(spark, [(0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.75]), (3, 2, [0.5]), (4, 2, [0.25])], [0])
    check(spark, [(0, 1, [0.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.5, 0.5])], [0])  # every score is 0
    check(spark, [(0, 1, [1.0]), (1, 1, [-1.0]), (2, 2, [-0.75])], [0])  # a negative score has no window
    check(spark, [(0, 1, [1e9, 3e8]), (1, 1, [1e9, 1.0]), (2, 2, [8e8, 3e8]), (3, 2, [5e8, 1.0]), (4, 2, [5e8, -1e8])], [0])
    check(spark, [(0, 1, [3e7, 3e6]), (1, 1, [2e6, 1.0]), (2, 2, [1.5e6, 3e6]), (3, 2, [1.25e6, 1.0]), (4, 2, [5e5, -1e7])], [0])  # beyond doubles


def test_bounds_save_reading():
    """The scan of a shard leaves most components unread, and finds what the whole product finds."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 64)) * 200
    values = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 64)) * 20)
    anchor = np.floor(centres[0])
    shard = negatives.Columns(np.ascontiguousarray(values.T))
    left, score = shard.scan(anchor, np.ones(4000, dtype=bool), negatives.among_best(5))
    assert set(np.argsort(-(values @ anchor))[:5]) <= set(left) and (score == values[left] @ anchor).all()
    assert shard.read < 0.6 * values.size
