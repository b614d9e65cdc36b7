import random

import pytest
from pyspark.sql import functions as F

from ratecraft.operators import ranking


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows belong to user 1; many equal scores."""
    rng = random.Random(5)
    rows = [(1 if n % 3 == 0 else rng.randrange(2, 30), n, float(rng.randrange(4))) for n in range(3000)]
    return spark.createDataFrame(rows, "user_id long, business_id long, prediction double").repartition(7)


def expected_ranks(rows):
    users = {}
    for user, item, score in rows:
        users.setdefault(user, []).append((-score, item))
    return {(u, item): n for u, pairs in users.items() for n, (_, item) in enumerate(sorted(pairs), 1)}


def test_rank_within_a_hot_key(skewed):
    expected = expected_ranks(map(tuple, skewed.collect()))
    out = ranking.rank_by_prediction(skewed, size="n").collect()
    assert {(r.user_id, r.business_id): r["rank"] for r in out} == expected
    per_user = {}
    for user, _ in expected:
        per_user[user] = per_user.get(user, 0) + 1
    assert all(r.n == per_user[r.user_id] for r in out)


def test_rank_with_ties(skewed):
    out = ranking.rank_within(skewed, ["user_id"], [F.col("prediction")], ties=True).collect()
    scores = {}
    for r in out:
        scores.setdefault(r.user_id, []).append(r.prediction)
    assert all(r["rank"] == 1 + sum(s < r.prediction for s in scores[r.user_id]) for r in out)
    assert out[0].__fields__ == ["user_id", "business_id", "prediction", "rank"] or "rank" in out[0].__fields__


def test_positions_over_many_partitions(spark):
    frame = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x")).repartition(6)
    placed, n = ranking.positions(frame, [F.col("x").asc()])
    assert n == 5000
    assert placed.filter("x <> position").count() == 0


def test_positions_of_nothing(spark):
    placed, n = ranking.positions(spark.range(0).select(F.col("id").alias("x")), [F.col("x").asc()])
    assert n == 0 and placed.count() == 0


def test_top_n(skewed):
    rows = list(map(tuple, skewed.collect()))
    expected = {k for k, rank in expected_ranks(rows).items() if rank <= 4}
    got = ranking.top_n(skewed, 4).collect()
    assert {(r.user_id, r.business_id) for r in got} == expected and len(got) == len(expected)


def test_top_n_is_cut_before_the_shuffle(skewed):
    plan = ranking.top_n(skewed, 4)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_encoding_of_strings(spark):
    frame = spark.createDataFrame([("b", "x"), ("a", "y"), ("c", "x"), ("a", "x")], "user_id string, business_id string")
    table = ranking.encode_ids(frame, "user_id")
    assert {r.user_id: r.code for r in table.collect()} == {"a": 0, "b": 1, "c": 2}
    coded = ranking.with_codes(frame, table, "user_id")
    assert sorted(map(tuple, coded.collect())) == [(0, "x"), (0, "y"), (1, "x"), (2, "x")]


def test_rank_probability(spark):
    rows = spark.createDataFrame([(1, 1), (1, 5), (5, 5), (3, 5)], "rank long, n long")
    out = [r[0] for r in rows.select(ranking.rank_probability(F.col("rank"), F.col("n"))).collect()]
    assert out == [1.0, 1.0, 0.0, 0.5]


def test_rank_evaluates_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).selectExpr("id % 3 AS user_id", "id AS business_id", "id % 5 / 1.0D AS prediction")
    ranking.rank_by_prediction(rows.mapInArrow(count, rows.schema)).collect()
    assert seen.value == 1000


def test_rank_with_null_keys(spark):
    rows = spark.createDataFrame([(None, 1, 2.0), (None, 2, 3.0), (1, 1, 1.0)], "user_id long, business_id long, prediction double")
    out = {(r.user_id, r.business_id): (r["rank"], r.n) for r in ranking.rank_by_prediction(rows, size="n").collect()}
    assert out == {(None, 2): (1, 2), (None, 1): (2, 2), (1, 1): (1, 1)}
