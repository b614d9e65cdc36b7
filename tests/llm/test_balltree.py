import math
import random
import re
from collections import Counter

import numpy as np
from brute import words

from ratecraft.llm import balltree

DOCS, ITEMS = "doc_id long, text string, n string, terms string, rank int", "item_id long, text string, terms string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    bags = [(i, Counter(plain(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for doc, bag in bags:
            m = 100 - 90 + (90 * sum(bag.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m))
                        for t in set(plain(text)) if t in bag)
            if score > 0:
                scores.append((-score, doc is None, doc))
        out += [(item, r, doc, -s) for r, (s, _, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def check(spark, docs, items, **sizes):
    d = spark.createDataFrame([(i, t, "", "", 1) for i, t in docs], DOCS).repartition(3)
    found = balltree.search(d, spark.createDataFrame([(i, t, "") for i, t in items], ITEMS), **sizes).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(docs, items)


def corpus(rng):
    docs = [(i, words(rng, rng.randrange(1, 60))) for i in range(300)]
    docs += [(300 + i, docs[3][1]) for i in range(60)]  # a group of copies: ties
    docs += [docs[5], docs[5], (None, docs[6][1]), (400, None), (401, ""), (402, " .,; "), (403, "Ñandú ñandÚ naïve ÅÄ 你好 你好, 123 a_b"),
             (404, " ".join(words(rng, 50) for _ in range(200)))]  # a very long text
    items = [(i, words(rng, rng.randrange(1, 12))) for i in range(20)]
    items += [(20, None), (21, ""), (22, "nowhere found"), (23, "NAÏVE 你好 123 A"), (3, "another river"), (None, docs[3][1]), (24, docs[404 - 40][1] or "x")]
    return docs, items


def test_against_brute_force(spark):
    docs, items = corpus(random.Random(8))
    check(spark, docs, items)
    check(spark, docs, items, tree=16, terms_per_block=40)


def test_empty_tables(spark):
    check(spark, [], [(1, "river")])
    check(spark, [(1, "river")], [])
    check(spark, [(1, "river")], [(1, "river"), (2, "stone")])
    check(spark, [(1, None), (2, ".")], [(1, "river")])


def test_bounds_hold_and_prune():
    """No document of a node scores above the node's bound, and far topics are not scored at all."""
    rng = np.random.default_rng(5)
    topics, each, size = 40, 60, 50
    rows = [rng.choice(size, 20, replace=False) + size * (i // each) for i in range(topics * each)]
    at = np.arange(0, 20 * len(rows) + 1, 20)
    columns, values = np.concatenate(rows), rng.integers(100_000, 900_000, 20 * len(rows))
    asked = [np.sort(rng.choice(size, 12, replace=False)) + size * t for t in range(topics)]
    items = balltree.Items(np.arange(0, 12 * topics + 1, 12), np.concatenate(asked), rng.integers(1, 9000, 12 * topics), topics * size)
    tree = balltree.Tree(np.arange(len(rows)), at, columns, values, items, leaf=8)
    dense = np.zeros((len(rows), topics * size), dtype=np.int64)
    dense[np.repeat(np.arange(len(rows)), 20), columns] = values
    asked_dense = np.zeros((topics, topics * size), dtype=np.int64)
    asked_dense[items.item, items.terms] = items.weights
    exact = dense @ asked_dense.T
    below = lambda n: tree.leaves[n][0] if tree.leaves[n] else np.concatenate([below(c) for c in tree.children[n]])
    for node, bound in enumerate(tree.bounds):
        assert (exact[below(node)].max(axis=0) <= bound).all()
    none = np.zeros(0, dtype=np.int64)
    scored = 0
    for i in range(topics):
        (scores, ids), n = tree.search(i, (none, none), 10)
        want = sorted((-s, d) for d, s in enumerate(exact[:, i]) if s > 0)[:10]
        assert list(zip((-scores).tolist(), ids.tolist())) == want
        scored += n
    assert scored < 0.5 * topics * len(rows)
