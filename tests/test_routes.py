"""Ratings laid out by blocks: what a step sends, and sums of ids that are cut over several blocks."""

import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratecraft.models import routes
from ratecraft.models.bias import BiasModel
from ratecraft.models.factor import SvdppModel

SCHEMA = "user_id string, business_id long, rating double"


@pytest.fixture(scope="module")
def ratings():
    rng = random.Random(3)
    rows = [(f"u{rng.randrange(30)}", rng.randrange(20), float(rng.randrange(1, 6))) for _ in range(400)]
    rows += [("hot", rng.randrange(20), 4.0) for _ in range(200)] + [(f"u{rng.randrange(30)}", 99, 2.0) for _ in range(200)]  # a third each
    return rows + rows[:5]


@pytest.mark.parametrize("block_rows", [50, 100_000])
def test_sums_of_a_step(spark, ratings, block_rows, capsys):
    def weighted(value, at, to, begins, own, far):
        return np.add.reduceat(np.column_stack([value, own[at, 0] * far[to, 0]]), begins)

    laid = routes.Routes(spark.createDataFrame(ratings, SCHEMA).repartition(3), "rating", block_rows)
    users = laid.ids["user_id"].withColumn("x", F.length("user_id").cast("double"))
    items = laid.ids["business_id"].withColumn("y", F.col("business_id") + 0.5)
    if block_rows == 50:
        assert laid.blocks > 10 and users.filter("user_id = 'hot'").select(F.size("own")).first()[0] > 3
    want = defaultdict(lambda: [0.0, 0.0])
    for u, i, r in ratings:
        for key in (u, i):
            want[key][0] += r
            want[key][1] += len(u) * (i + 0.5)
    for side, own, far, states in (("user_id", users, items, ("x", "y")), ("business_id", items, users, ("y", "x"))):
        step = laid.step(side, own, states[:1], far, states[1:], weighted, ("a", "b"))
        got = {r[side]: [r.a, r.b] for r in step.collect()}
        assert set(got) == {r[0 if side == "user_id" else 1] for r in ratings}
        assert all(got[k] == pytest.approx(want[k]) for k in got)
        step.explain()
        plan = capsys.readouterr().out
        # The stored blocks are scanned and grouped where they lie: what is exchanged are states and sums.
        scan = next(line for line in plan.splitlines() if "FileScan" in line and "value#" in line)
        above = plan[:plan.index(scan)].splitlines()
        assert "Bucketed: true" in plan and "Exchange" not in above[-1] and "Exchange" not in above[-2]
    laid.close()


def test_bias_is_the_alternating_mean(spark, ratings):
    model = BiasModel(epochs=3)
    fitted = model.fit(spark.createDataFrame(ratings, SCHEMA))
    mean = sum(r for *_, r in ratings) / len(ratings)
    users, items = defaultdict(float), defaultdict(float)
    for _ in range(3):
        for keys, other, place, weight in ((items, users, 1, model.reg_item), (users, items, 0, model.reg_user)):
            rows = defaultdict(list)
            for r in ratings:
                rows[r[place]].append(r[2] - mean - other[r[1 - place]])
            for k, x in rows.items():
                keys[k] = sum(x) / (weight + len(x))
    assert {r.user_id: r.b_u for r in fitted.users.collect()} == pytest.approx(dict(users))
    assert {r.business_id: r.b_i for r in fitted.items.collect()} == pytest.approx(dict(items))


def test_ids_of_the_larger_side_are_sent_once(spark, ratings, monkeypatch):
    """Both sides' steps use the same blocks: users go to one block each, but for those that are cut, and items to every block."""
    monkeypatch.setattr(routes, "CHUNK", 7)
    laid = routes.Routes(spark.createDataFrame(ratings, SCHEMA), "rating", 50)
    sent = {k: t.agg(F.sum(F.size("far")), F.count(F.lit(1))).first() for k, t in laid.ids.items()}
    assert sent["user_id"][0] <= sent["user_id"][1] + laid.blocks
    assert sent["business_id"][0] <= sent["business_id"][1] * laid.blocks
    items = laid.ids["business_id"]
    got = laid.step("business_id", items, (), laid.ids["user_id"].withColumn("x", F.lit(1.0)), ("x",),
                    lambda value, at, to, begins, own, far: np.add.reduceat(far[to] * value[:, None], begins), ("a",)).collect()
    want = defaultdict(float)
    for _, i, r in ratings:
        want[i] += r
    assert {r.business_id: r.a for r in got} == pytest.approx(dict(want))
    laid.close()


def test_an_epoch_of_svdpp_is_one_turn_where_no_user_is_cut(spark, ratings, monkeypatch):
    """The steps of a fit do not grow with its epochs, and both ways give the same; ids may be null."""
    monkeypatch.setattr(routes, "CHUNK", 7)
    monkeypatch.setattr(routes, "LEAST", 210)
    odd = [(None, 3, 1.0), (None, 99, 5.0), ("u3", None, 2.0)]
    rows = spark.createDataFrame(ratings + odd, SCHEMA)
    steps, step = [], routes.Routes.step
    monkeypatch.setattr(routes.Routes, "step", lambda *a: steps.append(1) or step(*a))
    model = SvdppModel(factors=3, epochs=3, lr=0.3, damping=4.0)
    fits = [model.fit(rows)]
    assert len(steps) == 2
    monkeypatch.setattr(routes.Routes, "undivided", lambda self, side: False)
    fits.append(model.fit(rows))
    assert len(steps) > 10
    one, two = (sorted((tuple(r) for t in (f.users, f.items) for r in t.collect()), key=str) for f in fits)
    assert len(one) == len(two) and all(a[0] == b[0] and a[1:] == pytest.approx(b[1:]) for a, b in zip(one, two))


def test_only_ids_of_very_many_ratings_are_cut(spark, ratings):
    laid = routes.Routes(spark.createDataFrame(ratings, SCHEMA), "rating", 60)
    cut = {r.user_id: len(r.own) for r in laid.ids["user_id"].collect() if len(r.own) > 1}
    assert set(cut) == {"hot"} and laid.blocks > 10 and not laid.undivided("user_id")
    laid.close()


def test_blocks_grow_with_the_ids_that_are_sent_to_them(spark, monkeypatch):
    """Ids of the smaller side that every block asks for: what is sent grows with the ratings, not with ids times blocks."""
    monkeypatch.setattr(routes, "LEAST", 50)
    monkeypatch.setattr(routes, "BLOCK", 50)
    sent = []
    for times in (1, 4):
        rows = [(u, (u * 7 + j * 13) % (100 * times), 1.0) for u in range(400 * times) for j in range(10)]
        laid = routes.Routes(spark.createDataFrame(rows, "user_id long, business_id long, rating double"), "rating")
        sent.append(laid.ids["business_id"].agg(F.sum(F.size("far"))).first()[0] / len(rows))
        laid.close()
    assert max(sent) < 0.3


def test_a_turn_holds_the_states_once(monkeypatch):
    """numpy's own memory of a turn: the items' states, which become what is sent back, and little more."""
    monkeypatch.setattr(routes, "CHUNK", 1024)
    monkeypatch.setattr("ratecraft.models.factor.CHUNK", 1024)
    k, n, width = 20, 20_000, 41
    rng = np.random.default_rng(1)
    at, to = np.sort(rng.integers(0, 50, n)).astype(np.int32), rng.permutation(n).astype(np.int32)
    whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x))
    block = pa.table({"block": pa.array([3], pa.int32()), "own": whole(np.arange(50)), "far": whole(np.arange(n)), "at": pa.array([at.tobytes()]),
                      "to": pa.array([to.tobytes()]), "value": pa.array([np.ones(n).tobytes()])})
    sent = [pa.table({"mine": pa.array([own] * len(ids), pa.bool_()), "id": ids, "x": x}) for own, ids, x in (
        (False, pa.array(np.arange(n)[::-1].copy()), pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(rng.normal(size=n * width)))),
        (True, pa.nulls(1, pa.int64()), whole(rng.normal(size=50 * (k + 1)))))]
    turn, before = routes._turned(SvdppModel(factors=k)._turn(1.0), (k + 1, width), pa.int64()), pa.total_allocated_bytes()
    tracemalloc.start()
    out = turn(block, pa.concat_tables(sent))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.num_rows == n + 1 and peak < 1.6 * n * width * 8 and pa.total_allocated_bytes() - before < n * width * 4
