import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft import PAIR
from ratecraft.metrics.accuracy import aligned_errors
from ratecraft.models import als, content, neural
from ratecraft.models.als import AlsModel
from ratecraft.models.bias import BiasModel
from ratecraft.models.content import ContentModel
from ratecraft.models.factor import LogisticModel, SvdppModel
from ratecraft.operators.splits import hash_split
from ratecraft.plans import jobs, tuning


@pytest.fixture(scope="module")
def planted(spark):
    """Ratings from two hidden traits that offsets alone cannot explain."""
    rng = np.random.default_rng(4)
    p, q = rng.normal(size=(60, 2)), rng.normal(size=(40, 2))
    rows = [(u, i, float(3 + p[u] @ q[i] + rng.normal() * 0.1)) for u in range(60) for i in range(40)
            if rng.random() < 0.5]
    frame = spark.createDataFrame(rows, "user_id long, business_id long, rating double").cache()
    return tuple(x.cache() for x in hash_split(frame))


def rmse(scored):
    return aligned_errors(scored).first().rmse


def bias_by_hand(rows, epochs=10, reg_item=10, reg_user=15):
    mean = sum(r for *_, r in rows) / len(rows)
    bu, bi = {}, {}
    for _ in range(epochs):
        sums = {}
        for u, i, r in rows:
            total, n = sums.get(i, (0, 0))
            sums[i] = (total + r - mean - bu.get(u, 0), n + 1)
        bi = {i: t / (reg_item + n) for i, (t, n) in sums.items()}
        sums = {}
        for u, i, r in rows:
            total, n = sums.get(u, (0, 0))
            sums[u] = (total + r - mean - bi[i], n + 1)
        bu = {u: t / (reg_user + n) for u, (t, n) in sums.items()}
    return mean, bu, bi


def test_bias_by_hand_with_unknown_ids(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(5), rng.randrange(6), float(rng.randrange(1, 6))) for _ in range(40)]
    fitted = BiasModel(checkpoint_every=3).fit(spark.createDataFrame(rows, "user_id long, business_id long, rating double"))
    mean, bu, bi = bias_by_hand(rows)
    pairs = [(0, 1), (4, 5), (99, 1), (2, 99)]
    got = fitted.predict(spark.createDataFrame(pairs, "user_id long, business_id long")).collect()
    for row in got:
        raw = mean + bu.get(row.user_id, 0) + bi.get(row.business_id, 0)
        assert row.prediction == pytest.approx(min(max(raw, 1), 5))


def test_svdpp_error_falls(planted):
    train, _ = planted
    flat = rmse(train.withColumn("prediction", F.lit(train.agg(F.avg("rating")).first()[0])))
    one, more = (rmse(SvdppModel(factors=2, epochs=n, lr=0.3, damping=4.0).fit(train).predict(train)) for n in (1, 7))
    assert more < one < flat


def test_als_lists_and_predictions(planted):
    train, test = planted
    fitted = AlsModel(rank=3, reg_param=0.05, nonnegative=False, max_iter=8).fit(train)
    assert rmse(fitted.predict(test)) < rmse(BiasModel(low=-9, high=9).fit(train).predict(test))
    lists = fitted.recommend(5).groupBy("user_id").count().collect()
    assert all(r["count"] == 5 for r in lists)


def test_logistic_loss_falls(spark):
    rng = random.Random(6)
    rows = [(u, i) for u in range(40) for i in range(30) if (u + i) % 2 == 0 and rng.random() < 0.6]
    frame = spark.createDataFrame(rows, "user_id long, business_id long")
    model = LogisticModel(factors=2, epochs=5, lr=0.5)
    samples = model.samples(frame)
    labels = {(r.user_id, r.business_id): r.label for r in samples.collect()}
    assert {k for k, y in labels.items() if y} == set(rows) and len(labels) == samples.count()
    losses = [m.loss(samples).first().loss for m in model.fit_epochs(frame)]
    assert losses[-1] < losses[0] and losses[-1] < np.log(2)


def test_network_gradient_matches_differences():
    rng = np.random.default_rng(0)
    x, y, flat = rng.normal(size=(7, 3)), rng.normal(size=7), neural._start_weights(3, 1)
    assert len(flat) == neural.weight_count(3) and neural.weight_count(25) == 713
    flat = flat + rng.normal(size=len(flat)) * 0.1
    grad = neural._gradient(flat, 3, x, y)

    def loss(w):
        return ((neural._forward(neural._split(w, 3), x)[-1][:, 0] - y) ** 2).mean()
    for k in range(0, len(flat), 17):
        step = np.zeros(len(flat))
        step[k] = 1e-6
        assert grad[k] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-6, abs=1e-5)


def test_network_loss_falls_and_clips(spark):
    rng = random.Random(9)
    rows = [(float(rng.randrange(10)), rng.random(), None if rng.random() < 0.1 else 1.0) for _ in range(4000)]
    frame = spark.createDataFrame(rows, "a double, b double, c double").withColumn(
        "rating", F.lit(1.0) + F.col("a") * 0.4 + F.col("b"))
    fitted = neural.NeuralModel(epochs=6, batch_size=64, rate=0.01).fit(frame)
    assert fitted.losses[-1] < 0.5 * fitted.losses[0]
    low, high = fitted.predict(frame).agg(F.min("prediction"), F.max("prediction")).first()
    assert 1 <= low <= high <= 5


@pytest.fixture(scope="module")
def reviews(spark):
    rng = random.Random(12)
    words = [f"w{k}" for k in range(30)]
    rows = [(d, rng.randrange(5), rng.randrange(4), float(rng.randrange(1, 6)),
             " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for d in range(40)]
    rows.append((40, 1, 1, 3.0, "42 17"))  # no token at all
    return spark.createDataFrame(rows, "doc_id long, user_id long, business_id long, rating double, text string")


@pytest.mark.parametrize("tile,dense", [(256, 4096), (2, 3)])
def test_pair_scores_equal_the_full_product(reviews, monkeypatch, tile, dense):
    monkeypatch.setattr(content, "TILE", tile)
    monkeypatch.setattr(content, "DENSE", dense)
    fitted = ContentModel((1, 2)).fit(reviews)
    full = {(r.user_id, r.business_id): r.prediction for r in fitted.full_scores().collect()}
    pairs = fitted.predict(reviews.select(*PAIR)).collect()
    assert len(pairs) == 41
    assert all(r.prediction == pytest.approx(full.get((r.user_id, r.business_id), 0.0)) for r in pairs)
    users, items = {}, {}
    for table, key, out in ((fitted.users, "user_id", users), (fitted.items, "business_id", items)):
        for r in table.collect():
            out.setdefault(r[key], {})[r.term] = r.weight
    plain = {(u, i): sum(w * b.get(t, 0.0) for t, w in a.items()) for u, a in users.items() for i, b in items.items()}
    assert full == pytest.approx({k: x for k, x in plain.items() if x})
    best = {(r.user_id, r["rank"]): r.prediction for r in fitted.top_lists(2).collect()}
    for u in users:
        scores = sorted((s for (v, _), s in full.items() if v == u), reverse=True)[:2]
        assert [best[u, n + 1] for n in range(len(scores))] == pytest.approx(scores)


def test_bounds_skip_blocks_of_items_and_lose_no_list(spark, monkeypatch):
    """Users of a topic skip the other topics' blocks; ties, short lists and users without a common term stay right."""
    monkeypatch.setattr(content, "TILE", 6)
    rng = random.Random(21)
    users, items = [], []
    for topic in range(6):
        for k in range(18):
            words = [0, *rng.sample(range(1, 12), 5)]
            items += [(100 * topic + k, f"t{topic}w{w}", rng.choice([0.25, 0.5, 1.0])) for w in words] + [(100 * topic + k, "all", 0.01)]
            users += [(1000 * topic + k, f"t{topic}w{w}", 0.5) for w in words[:4]] + [(1000 * topic + k, "all", 0.01)]
    users += [(9000, "nobody", 1.0), (9001, "t0w0", 1.0), (None, "all", 1.0)]
    found = content.ContentVectors(spark.createDataFrame(users, "user_id long, term string, weight double"),
                                   spark.createDataFrame(items, "business_id long, term string, weight double"))
    of = {}
    for i, t, w in items:
        of.setdefault(i, {})[t] = w
    want = {}
    for u in {u for u, _, _ in users if u is not None}:
        scores = {i: sum(w * of[i].get(t, 0.0) for v, t, w in users if v == u) for i in of}
        for rank, (score, i) in enumerate(sorted((-round(s, 6), i) for i, s in scores.items() if s)[:3], 1):
            want[u, rank] = (i, -score)
    got = {(r.user_id, r["rank"]): (r.business_id, round(r.prediction, 6)) for r in found.bounded_lists(3).collect()}
    assert got == want
    tiles = found.search(3)[1].groupBy("scored").count().collect()
    counts = {r.scored: r["count"] for r in tiles}
    assert counts[False] > counts[True]
    none = content.ContentVectors(found.users.limit(0), found.items.limit(0))
    assert none.bounded_lists(3).count() == 0


def test_cross_validator_takes_the_bias_model(planted):
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    from ratecraft.models.estimators import BiasEstimator, rmse
    from ratecraft.operators.splits import folds

    ratings = planted[0].select("user_id", "business_id", "rating")
    bias = BiasEstimator(epochs=2)
    grid = ParamGridBuilder().addGrid(bias.regUser, [15.0, 500.0]).build()
    found = CrossValidator(estimator=bias, estimatorParamMaps=grid, evaluator=rmse(), numFolds=2, foldCol="fold",
                           parallelism=2).fit(folds(ratings, 2))
    for point, weight in enumerate((15.0, 500.0)):
        plain = tuning.cross_validate_bias(ratings, 2, BiasModel(epochs=2, reg_user=weight)).collect()
        assert found.avgMetrics[point] == pytest.approx(sum(r.rmse for r in plain) / 2)
    assert "prediction" in found.transform(ratings).columns


def test_network_takes_string_ids_and_ignores_partitions(spark, planted):
    train, test = planted
    name = lambda df: df.withColumn("user_id", F.concat(F.lit("u"), F.col("user_id"))).withColumn("business_id", F.concat(F.lit("b"), F.col("business_id")))
    whole = name(train.unionByName(test)).select("user_id", "business_id", "rating")
    outcome = jobs.neural_job(whole, neural.NeuralModel(epochs=1))
    assert outcome.predictions.count() == outcome.test.count() > 0
    assert tuning.sweep_neural(whole, (1,), (64,)).count() == 1
    one = neural.NeuralModel(epochs=2, batch_size=64).fit(train.select("user_id", "business_id", "rating"))
    two = neural.NeuralModel(epochs=2, batch_size=64).fit(train.select("user_id", "business_id", "rating").repartition(7))
    assert one.weights == pytest.approx(two.weights, abs=1e-6)


def test_network_weights_for_any_partitioning_and_a_hot_row(spark, planted):
    """Lanes follow the data, copies of one row spread over them, and partitions change nothing."""
    rows = planted[0].select("user_id", "business_id", "rating")
    rows = rows.unionByName(spark.range(600).select(F.lit(3).cast(rows.schema["user_id"].dataType).alias("user_id"),
                                                    F.lit(4).cast(rows.schema["business_id"].dataType).alias("business_id"), F.lit(2.0).alias("rating")))
    model = neural.NeuralModel(epochs=2, batch_size=64, lane_rows=150)
    fitted = [model.fit(rows.repartition(n)) for n in (4, 200)]
    assert fitted[0].weights == pytest.approx(fitted[1].weights, abs=1e-9)
    assert neural.NeuralModel(epochs=1, lane_rows=10 ** 6).fit(rows).weights != pytest.approx(fitted[0].weights, abs=1e-3)


def test_a_sweep_lays_out_rows_once_for_each_fold(planted, monkeypatch):
    calls = []
    monkeypatch.setattr(neural, "positions", lambda *a, f=neural.positions, **k: calls.append(1) or f(*a, **k))
    assert tuning.sweep_neural(planted[0].unionByName(planted[1]), (1, 2), (64,)).count() == 2
    assert len(calls) == 2


def test_network_refuses_null_labels(planted):
    rows = planted[0].select("user_id", "business_id", F.when(F.col("user_id") > 0, F.col("rating")).alias("rating"))
    rows = rows.unionByName(rows.limit(1).withColumn("rating", F.lit(None).cast("double")))
    with pytest.raises(ValueError, match="null"):
        neural.NeuralModel(epochs=1).fit(rows)


def test_fits_of_shared_lanes_are_those_of_their_own(planted):
    rows = planted[0].select("user_id", "business_id", "rating")
    model = neural.NeuralModel(epochs=2, batch_size=64, lane_rows=150)
    lanes = model.laid_out(rows)
    assert lanes.rows.count() == -(-rows.count() // 150)  # a row for each lane
    assert model.fit(rows, lanes=lanes).weights == pytest.approx(model.fit(rows).weights, abs=1e-12)
    lanes.close()


def test_content_sweep_names_every_point(reviews):
    rows = tuning.sweep_content(reviews, ((1, 1),), (True, False)).collect()
    assert [r.model for r in rows] == ["ngram_range = (1, 1), sublinear_tf = True",
                                       "ngram_range = (1, 1), sublinear_tf = False"]


def test_jobs_and_sweeps(planted):
    train, test = planted
    whole = train.unionByName(test)
    row = jobs.als_job(whole, AlsModel(rank=2, reg_param=0.1)).report("als").first()
    assert row.model == "als" and row.rmse > 0 and row.avg_novelty <= 0
    grid = tuning.sweep_als(train, test, (2,), (0.1, 1.0)).collect()
    assert [(r["rank"], r.reg_param) for r in grid] == [(2, 0.1), (2, 1.0)]
    assert all(0 <= r.coverage_train <= 1 and r.running_time > 0 for r in grid)
    neural_rows = tuning.sweep_neural(whole, (1,), (64, 128)).collect()
    assert {r.batch_size for r in neural_rows} == {64, 128} and min(r.rank_test_score for r in neural_rows) == 1
    row = jobs.interaction_job(whole, LogisticModel(factors=2, epochs=2), 5).first()
    assert 0 <= row.test_auc_mean <= 1 and 0 <= row.train_precision <= 1


def test_als_lists_do_not_pair_the_blocks_of_the_fit(spark, planted):
    """The factors' partitions follow their size, and the lists are those of the factors."""
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        fitted = AlsModel(rank=3).fit(planted[0])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    factors = fitted.model.userFactors, fitted.model.itemFactors
    assert all(f.rdd.getNumPartitions() <= 12 for f in factors)
    users, items = ({r.id: np.array(r.features) for r in f.collect()} for f in factors)
    got = {}
    for r in fitted.recommend(2).collect():
        got.setdefault(r.user_id, []).append(r.prediction)
    assert len(got) == len(users)
    for user, best in got.items():
        scores = sorted((float(users[user] @ v) for v in items.values()), reverse=True)[:2]
        assert sorted(best, reverse=True) == pytest.approx(scores, abs=1e-4)


def test_als_lists_from_tiles_are_the_best_and_equal_scores_go_by_id(spark, planted, monkeypatch, capsys):
    """No list is made by a product of factor rows one by one; a user's lists from several tiles of items are merged."""
    for name, value in {"TILE": 16, "LEAST_TILE": 8, "TILE_NUMBERS": 45, "HEIGHT": 3, "WIDTH": 4, "FIRST": 3}.items():
        monkeypatch.setattr(als, name, value)
    train = planted[0].unionByName(planted[0].select("user_id", (F.col("business_id") + 100).alias("business_id"), "rating"))  # twins: equal factors
    fitted = AlsModel(rank=3).fit(train)
    users, items = ({r.id: np.array(r.features, np.float32) for r in f.collect()} for f in (fitted.model.userFactors, fitted.model.itemFactors))
    lists = fitted.recommend(5)
    lists.explain()
    assert not any(x in capsys.readouterr().out for x in ("CartesianProduct", "NestedLoop"))
    got = {}
    for r in lists.collect():
        got.setdefault(r.user_id, []).append((-r.prediction, r.business_id))
    assert set(got) == set(users)
    for user, found in got.items():
        score = {i: float(users[user] @ v) for i, v in items.items()}
        assert [-s for s, _ in sorted(found)] == pytest.approx(sorted(score.values(), reverse=True)[:5], abs=1e-5)
        assert all(-s == pytest.approx(score[i], abs=1e-5) for s, i in found) and len({i for _, i in found}) == 5


def test_lists_of_equal_scores():
    rng = np.random.default_rng(5)
    vectors = [rng.integers(0, 2, size=(m, 3)).astype(np.float32) for m in (40, 1500)]
    users, items = (als.pa.table({"ids": [list(range(len(v)))[::-1]], "vectors": [v.tolist()]}) for v in vectors)
    got = als._lists(7)(users, items).to_pydict()
    scores = vectors[0] @ vectors[1].T
    want = [(39 - u, 1499 - i) for u in range(40) for i in sorted(range(1500), key=lambda i: (-scores[u, i], -i))[:7]]
    assert sorted(zip(got["user_id"], got["business_id"])) == sorted(want)
