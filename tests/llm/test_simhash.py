import random

import numpy as np
from brute import components, fingerprint, words
from hypothesis import given, settings
from hypothesis import strategies as st

from ratecraft.llm import graph, simhash

SCHEMA = "doc_id long, text string, fp string, root string, component_id string, key string"


@settings(max_examples=60, deadline=None)
@given(st.text("abAÉé \t\n\x0b\x1c ", max_size=40))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == fingerprint(text)


def test_steps_meet_each_pair_of_tiles_once():
    moves = {tuple(m) for m in simhash.steps(3).tolist()}
    assert (0, 0, 0, 0) in moves and len(moves) == 65
    assert not any(tuple(-x for x in m) in moves for m in moves if any(m))


def near(rng, base, bits):
    for b in rng.sample(range(64), bits):
        base ^= 1 << b
    return base


def test_links_against_all_pairs(spark):
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(150)]
    prints += [near(rng, rng.choice(prints), rng.randrange(1, 6)) for _ in range(250)] + [0, (1 << 64) - 1, 1]
    prints = sorted(set(prints))
    rows = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = spark.createDataFrame(rows, "fp long")
    want = components(prints)
    for residents, guests in ((8192, 65536), (3, 5)):
        edges = graph.components(simhash.links(df, 3, residents, guests)).collect()
        root = {r.u: r.v for r in edges}
        got = [root.get(x, x) for (x,) in rows]
        pairs = {(a, b) for a, b in zip(want, got)}
        assert len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs})


def test_trees_are_linear_in_a_dense_group():
    rng = random.Random(1)
    base = rng.getrandbits(64)
    prints = np.array(sorted({near(rng, base, 1 + i % 2) for i in range(600)}), dtype=np.uint64)
    nodes, roots = simhash.trees(prints, prints, 3)
    assert len(nodes) == len(prints) - 1 and len(set(roots.tolist())) == 1


def test_components_of_a_long_path(spark):
    n = 200
    ids = list(range(n))
    random.Random(5).shuffle(ids)
    found = graph.components(spark.createDataFrame(list(zip(ids, ids[1:])), "u long, v long")).collect()
    assert sorted(r.u for r in found) == list(range(1, n)) and {r.v for r in found} == {0}
    assert graph.components(spark.createDataFrame([], "u long, v long")).collect() == []


def documents(rng):
    base = [words(rng, 300) for _ in range(6)]
    texts = base + [b.replace("stone", "stones", 1) for b in base] + base[:3] + [None, "", " \n", "one", "ONE", "one two"]
    rows = [(i * 3 % 97, t, "x", "y", "z", "k") for i, t in enumerate(texts)]
    return rows + [rows[0], rows[0], (None, base[0], "", "", "", ""), (None, "alone " * 5, "", "", "", "")]


def test_near_duplicates_and_keep_one(spark):
    rows = documents(random.Random(2))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    prints = [fingerprint(r[1] or "") for r in rows]
    label = components(prints)
    least = {}
    for r, c in zip(rows, label):
        least.setdefault(c, []).append(r[0])
    least = {c: min((i for i in ids if i is not None), default=None) for c, ids in least.items()}
    want = sorted(((r[0], least[c]) for r, c in zip(rows, label)), key=str)
    found = simhash.near_duplicates(df)
    assert sorted(((r.doc_id, r.component_id) for r in found.collect()), key=str) == want
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(least.values(), key=str)


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(df).collect() == [] and simhash.keep_one(df).collect() == []
