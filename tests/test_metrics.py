"""Measures against plain Python on frames with repeated pairs, missing pairs and ties."""

import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from ratecraft.metrics import accuracy, coverage, diversity, report, serendipity, toplist
from ratecraft.metrics.novelty import item_probability, novelty
from ratecraft.operators import ranking
from ratecraft.operators.relational import corpus
from ratecraft.plans import jobs

SCHEMA = "user_id long, business_id long, {} double"


def cosine(a, b):
    return 1 - sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    pick = lambda n: [(rng.randrange(6), rng.randrange(12), float(rng.randrange(1, 6))) for _ in range(n)]
    train, test = pick(60), pick(30)
    preds = [(u, i, round(rng.uniform(0.5, 5.5), 3)) for u, i, _ in test[:20] + pick(20)]
    preds += preds[:5]  # copies
    content = {i: [rng.uniform(-1, 1) for _ in range(5)] for i in range(10)}
    frames = {
        "train": spark.createDataFrame(train, SCHEMA.format("rating")),
        "test": spark.createDataFrame(test, SCHEMA.format("rating")),
        "preds": spark.createDataFrame(preds, SCHEMA.format("prediction")),
        "content": spark.createDataFrame(list(content.items()), "business_id long, features array<double>")}
    return {"train": train, "test": test, "preds": preds, "content": content}, frames


def joined(preds, actual):
    by = defaultdict(list)
    for u, i, r in actual:
        by[u, i].append(r)
    return [(u, i, p, r) for u, i, p in preds for r in by[u, i]]


def test_rmse_counts_every_copy(data):
    raw, df = data
    pairs = joined(raw["preds"], raw["train"] + raw["test"])
    expected = math.sqrt(sum((p - r) ** 2 for _, _, p, r in pairs) / len(pairs))
    assert accuracy.rmse(df["train"], df["test"], df["preds"]).first().rmse == pytest.approx(expected)


def test_mae_counts_every_copy(data):
    raw, df = data
    pairs = joined(raw["preds"], raw["test"])
    assert accuracy.mae(df["test"], df["preds"]).first().mae == pytest.approx(
        sum(abs(p - r) for _, _, p, r in pairs) / len(pairs))


def test_empty_join_gives_null(spark, data):
    _, df = data
    nothing = df["preds"].filter("user_id < 0")
    assert accuracy.rmse(df["train"], df["test"], nothing).first().rmse is None
    assert accuracy.mae(df["test"], nothing).first().mae is None
    assert accuracy.precision_at_n(df["test"], nothing, 5).first()[0] == 0


def test_class_scores(data):
    raw, df = data
    pairs = [(round(p), round(r)) for _, _, p, r in joined(raw["preds"], raw["test"])]
    got = {r.label: r for r in accuracy.class_scores(df["test"], df["preds"]).collect()}
    labels = {x for pair in pairs for x in pair}
    assert set(got) == labels
    for label in labels:
        hits = sum(p == r == label for p, r in pairs)
        made, real = sum(p == label for p, _ in pairs), sum(r == label for _, r in pairs)
        precision, recall = hits / made if made else 0, hits / real if real else 0
        f = 2 * precision * recall / (precision + recall) if hits else 0
        assert (got[label].precision, got[label].recall, got[label].fscore, got[label].support) == (
            pytest.approx(precision), pytest.approx(recall), pytest.approx(f), real)


def test_list_distance_equals_all_pairs(data):
    raw, df = data
    lists = defaultdict(list)
    for u, i, _ in raw["preds"]:
        if i in raw["content"]:
            lists[u].append(raw["content"][i])
    got = {r.user_id: r.ils_distance for r in
           diversity.list_distance_per_user(df["preds"], df["content"]).collect()}
    for user, vectors in lists.items():
        pairs = [cosine(a, b) for a, b in itertools.combinations(vectors, 2)]
        assert got[user] == pytest.approx(sum(pairs) / len(pairs) if pairs else 0.0, abs=1e-9)


def test_category_diversity_by_definition(data):
    raw, df = data
    rows = [raw["content"][i] for _, i, _ in raw["preds"] if i in raw["content"]]
    item_mean = sum(map(sum, raw["content"].values())) / len(raw["content"])
    expected = sum(sum(col) / len(rows) for col in zip(*rows)) * item_mean / 5
    assert diversity.category_diversity(df["preds"], df["content"]).first()[0] == pytest.approx(expected)


def item_probabilities(ratings):
    sums = defaultdict(list)
    for _, i, r in ratings:
        sums[i].append(r)
    order = sorted(sums, key=lambda i: (-round(sum(sums[i]) / len(sums[i]), 6), i))
    n = len(order)
    return {i: (n - rank) / (n - 1) for rank, i in enumerate(order, 1)}


def test_serendipity_and_novelty(data):
    raw, df = data
    prob = item_probabilities(raw["train"] + raw["test"])
    table = item_probability(corpus(df["train"], df["test"]))
    found = defaultdict(list)
    for u, i, p, r in joined(raw["preds"], [t for t in raw["test"] if t[2] >= 3]):
        found[u].append((-p, i))
    gains = {u: [max((1.0 if len(rows) == 1 else (len(rows) - k) / (len(rows) - 1)) - prob[i], 0)
                 for k, (_, i) in enumerate(sorted(rows), 1)] for u, rows in found.items()}
    flat = [g for rows in gains.values() for g in rows]
    row = serendipity.serendipity(df["test"], df["preds"], table, 3.0).first()
    assert row.avg_overall_serendipity == pytest.approx(sum(flat) / len(flat))
    assert row.avg_serendipity == pytest.approx(sum(sum(g) / len(g) for g in gains.values()) / len(gains))
    per_user = defaultdict(list)
    for u, i, _ in raw["preds"]:
        if i in prob:
            per_user[u].append(math.log2(max(prob[i], 1e-100)))
    flat = [x for xs in per_user.values() for x in xs]
    row = novelty(df["preds"], table).first()
    assert row.avg_overall_novelty == pytest.approx(sum(flat) / len(flat))
    assert row.avg_novelty == pytest.approx(sum(sum(x) / len(x) for x in per_user.values()) / len(per_user))


@pytest.mark.parametrize("block", [256, 2])
def test_content_serendipity_over_blocks(data, monkeypatch, block):
    monkeypatch.setattr(serendipity, "BLOCK", block)
    raw, df = data
    owned = defaultdict(set)
    for u, i, _ in raw["train"]:
        owned[u].add(i)
    got = {(r.user_id, r.business_id): r.min_dist for r in
           serendipity.nearest_profile_distance(df["train"], df["preds"], df["content"]).collect()}
    expected = {}
    for u, i, _ in raw["preds"]:
        near = [cosine(raw["content"][i], raw["content"][j]) for j in owned[u] if j in raw["content"]
                ] if i in raw["content"] else []
        if near:
            expected[u, i] = min(near)
    assert set(got) == set(expected)
    assert all(got[k] == pytest.approx(v, abs=1e-9) for k, v in expected.items())


def test_rank_stats(data):
    raw, df = data
    unique = df["preds"].dropDuplicates(["user_id", "business_id"])
    ranks = {(r.user_id, r.business_id): r["rank"] for r in ranking.rank_by_prediction(unique).collect()}
    hits = defaultdict(list)
    for u, i, _ in raw["test"]:
        if (u, i) in ranks:
            hits[u].append(ranks[u, i])
    row = accuracy.relevant_rank_stats(df["test"], unique).first()
    n = len(hits)
    assert tuple(row) == pytest.approx((sum(min(h) for h in hits.values()) / n,
                                        sum(sum(h) / len(h) for h in hits.values()) / n,
                                        sum(max(h) for h in hits.values()) / n))


def test_coverages(data):
    raw, df = data
    both = raw["train"] + raw["test"]
    users, items = {r[0] for r in both}, {r[1] for r in both}
    made_items, made_users = {p[1] for p in raw["preds"]}, {p[0] for p in raw["preds"]}
    args = (df["test"], df["train"])
    assert coverage.catalog_coverage(*args, df["preds"]).first()[0] == pytest.approx(
        100 * len(raw["preds"]) / (len(users) * len(items)))
    assert coverage.item_coverage(*args, df["content"], df["preds"]).first()[0] == pytest.approx(
        100 * len(made_items) / len(items | set(raw["content"])))
    assert coverage.user_coverage(*args, df["preds"]).first()[0] == pytest.approx(100 * len(made_users) / len(users))
    assert coverage.prediction_coverage(df["test"], df["preds"]).first()[0] == pytest.approx(
        100 * len(joined(raw["preds"], raw["test"])) / len(raw["test"]))
    assert coverage.catalogue_share(df["preds"], 3.0, 50).first()[0] == pytest.approx(
        len({i for _, i, p in raw["preds"] if p >= 3}) / 50)


def brute_ranking(score, positives, excluded, items, k):
    """{user: (auc, precision)} by looking at every item of every user."""
    out = {}
    for user, hits in positives.items():
        allowed = [i for i in items if i in hits or i not in excluded.get(user, set())]
        wrong = [i for i in allowed if i not in hits]
        wins = sum((score(user, h) > score(user, w)) + 0.5 * (score(user, h) == score(user, w))
                   for h in hits for w in wrong)
        best = sorted(allowed, key=lambda i: (-score(user, i), i))[:k]
        out[user] = (wins / (len(hits) * len(wrong)) if wrong else 0.5, sum(i in hits for i in best) / k)
    return out


def sets_of(rows):
    out = defaultdict(set)
    for u, i, *_ in rows:
        out[u].add(i)
    return out


def test_auc_and_precision_by_item_score(spark, data):
    raw, df = data
    scores = {i: float(i * 7 % 5) for i in range(12)}  # with ties
    table = spark.createDataFrame(list(scores.items()), "business_id long, score double")
    expected = brute_ranking(lambda u, i: scores[i], sets_of(raw["test"]), sets_of(raw["train"]), scores, 3)
    auc = {r.user_id: r.auc for r in toplist.auc_by_item_score(table, df["test"], df["train"]).collect()}
    precision = {r.user_id: r.precision for r in
                 toplist.precision_by_item_score(table, df["test"], 3, df["train"]).collect()}
    assert auc == pytest.approx({u: v[0] for u, v in expected.items()})
    assert precision == pytest.approx({u: v[1] for u, v in expected.items()})


@pytest.mark.parametrize("block", [4096, 5])
@pytest.mark.parametrize("ties", [False, True])
def test_auc_and_precision_by_factors(spark, data, monkeypatch, block, ties):
    monkeypatch.setattr(toplist, "BLOCK", block)
    monkeypatch.setattr(toplist, "USERS", 2)
    raw, df = data
    rng = random.Random(8)
    draw = (lambda: rng.choice([0.0, 0.5])) if ties else (lambda: rng.uniform(-1, 1))
    users = {u: [draw() for _ in range(3)] for u in range(6)}
    items = {i: [draw() for _ in range(3)] for i in range(12)}
    uf = spark.createDataFrame([(u, *x) for u, x in users.items()], "user_id long, bu double, p0 double, p1 double")
    itf = spark.createDataFrame([(i, *x) for i, x in items.items()], "business_id long, bi double, q0 double, q1 double")

    def score(u, i):
        return items[i][0] + users[u][1] * items[i][1] + users[u][2] * items[i][2]
    expected = brute_ranking(score, sets_of(raw["test"]), sets_of(raw["train"]), items, 3)
    places, n = toplist.catalogue_places(uf, itf, df["test"], df["train"], 2)
    assert n == 12
    auc = {r.user_id: r.auc for r in toplist.auc_by_factors(places, n).collect()}
    precision = {r.user_id: r.precision for r in toplist.precision_by_factors(places, n, 3).collect()}
    assert auc == pytest.approx({u: v[0] for u, v in expected.items()})
    assert precision == pytest.approx({u: v[1] for u, v in expected.items()})


@pytest.mark.parametrize("ties", [False, True])
def test_users_are_scored_once_for_train_and_test(spark, data, monkeypatch, ties):
    """Pairs of both, users cut into parts, and rows of few items."""
    for name, value in (("BLOCK", 3), ("ITEM_ROW", 2), ("HITS", 2), ("BUCKET", 4)):
        monkeypatch.setattr(toplist, name, value)
    raw, df = data
    rng = random.Random(3)
    draw = (lambda: rng.choice([0.0, 0.5])) if ties else (lambda: rng.uniform(-1, 1))
    users, items = ({x: [draw(), draw()] for x in range(n)} for n in (6, 12))
    uf = spark.createDataFrame([(u, *x) for u, x in users.items()], "user_id long, bu double, p0 double")
    itf = spark.createDataFrame([(i, *x) for i, x in items.items()], "business_id long, bi double, q0 double")
    test = df["test"].select("user_id", "business_id").unionByName(df["train"].limit(3).select("user_id", "business_id"))
    both = [(r.user_id, r.business_id) for r in test.collect()]
    pairs = jobs.rated_pairs(df["train"], spark.createDataFrame(both, "user_id long, business_id long"))
    places, n = toplist.pair_places(uf, itf, pairs, 1)
    found = toplist.user_measures(places, n, 3, {"train": (1, 1), "test": (0, 2)}).collect()
    known, held = sets_of(raw["train"]), sets_of(both)
    score = lambda u, i: items[i][0] + users[u][1] * items[i][1]
    for part, hits, exclude in (("train", known, defaultdict(set)), ("test", held, {u: x - held[u] for u, x in known.items()})):
        expected = brute_ranking(score, hits, defaultdict(set, exclude), items, 3)
        assert {r.user_id: (r.auc, r.precision) for r in found if r.part == part} == {u: pytest.approx(tuple(v)) for u, v in expected.items()}


def test_precision_of_equal_scores_is_at_most_one(spark):
    users = spark.createDataFrame([(1, 0.0, 1.0)], "user_id long, bu double, p0 double")
    items = spark.createDataFrame([(i, 0.0, 1.0) for i in range(30)], "business_id long, bi double, q0 double")
    hits = spark.createDataFrame([(1, i) for i in range(0, 20, 2)], "user_id long, business_id long")
    places, n = toplist.catalogue_places(users, items, hits, None, 1)
    assert [tuple(r) for r in toplist.precision_by_factors(places, n, 4).collect()] == [(1, 0.5)]
    assert [tuple(r) for r in toplist.auc_by_factors(places, n).collect()] == [(1, 0.5)]


def test_reports_have_one_row(data):
    raw, df = data
    row = report.standard_report(df["train"], df["test"], df["preds"], "x").collect()
    assert len(row) == 1 and row[0].model == "x" and 0 <= row[0].avg_serendipity <= 1 and row[0].avg_novelty <= 0
    full = report.full_report(df["train"], df["test"], df["preds"], df["content"], "x", 3).collect()
    assert len(full) == 1 and all(full[0][c] is not None for c in report.FULL)
    assert Counter(full[0].__fields__) == Counter(["model", *report.FULL])


def test_model_coverage(spark, data):
    raw, df = data
    recommended = spark.createDataFrame([(1, 0), (2, 1)], "user_id long, business_id long")
    got = {r.part: r.coverage for r in coverage.model_coverage(recommended, df["train"], df["test"]).collect()}
    for part in ("train", "test"):
        items = {r[1] for r in raw[part]}
        assert got[part] == pytest.approx(len(items & {0, 1}) / len(items))


def test_rank_by_rating_option(data):
    _, df = data
    prob = item_probability(corpus(df["train"], df["test"]))
    row = serendipity.serendipity(df["test"], df["preds"], prob, rank_by="rating").first()
    assert 0 <= row.avg_serendipity <= 1


@pytest.mark.parametrize("parts", [1, 3])
def test_profile_distance_moves_no_vector_for_a_pair(spark, monkeypatch, capsys, parts):
    """Groups of users meet parts of the items; ids of several vectors count with the nearest, pairs of none are left out."""
    monkeypatch.setattr(serendipity, "PART_ENTRIES", -(-26 // parts))
    monkeypatch.setattr(serendipity, "GROUP_PAIRS", 9)
    vectors = [(i, [math.cos(i), math.sin(i)]) for i in range(10)] + [(3, [0.0, 1.0]), (4, [0.0, 0.0]), (None, [1.0, 0.0])]
    owned = [(u, (u * 3 + j) % 12) for u in range(8) for j in range(4)] * 2 + [(None, 1), (1, None)]
    recs = [(u, (u * 5 + j) % 11) for u in range(9) for j in range(2)] + [(None, 2)]
    pairs = "user_id long, business_id long"
    profile, listed = spark.createDataFrame(owned, pairs), spark.createDataFrame(recs, pairs)
    content = spark.createDataFrame(vectors, "business_id long, features array<double>")
    nearest = serendipity.nearest_profile_distance(profile, listed, content)
    got = {(r.user_id, r.business_id): r.min_dist for r in nearest.collect()}
    want = {}
    for u, i in recs:
        near = [1 - (x @ y) / np.linalg.norm(x) / np.linalg.norm(y) for v, j in owned if u is not None and v == u
                for a, x in ((a, np.array(x)) for a, x in vectors) for b, y in ((b, np.array(y)) for b, y in vectors)
                if a == i and b == j and x.any() and y.any()]
        if near:
            want[u, i] = min(near)
    assert got == pytest.approx(want, abs=1e-9)
    nearest.explain()
    plan = capsys.readouterr().out
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list(struct" not in plan
