import math
import random
from collections import Counter, defaultdict

import numpy as np
from brute import words

from ratecraft.llm import quality

SCHEMA = "doc_id long, text string, lang string, logp string, chars string, keep string"


def kneser_ney(texts, order):
    """Interpolated modified Kneser-Ney over characters, by its definition: p(gram)."""
    top = Counter()
    for t in texts:
        t = quality.PAD * (order - 1) + " ".join(t.split())
        top.update(t[i - order + 1:i + 1] for i in range(order - 1, len(t)))
    counts = {order: top}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    model = {}
    for n, c in counts.items():
        of = Counter(c.values())
        n1, n2, n3, n4 = (of[i] for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 + n2 else 0
        rest = {1: (n1, n2), 2: (n2, n3), 3: (n3, n4)}
        d = {i: max(0.05, i - (i + 1) * y * b / a) if n1 and a and b else (0.5 * i if i < 3 else 1.25) for i, (a, b) in rest.items()}
        total, freed, types = Counter(), defaultdict(float), Counter()
        for g, k in c.items():
            total[g[:-1]] += k
            freed[g[:-1]] += d[min(k, 3)]
            types[g[:-1]] += 1
        model[n] = (c, d, total, freed, types)

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / (model[1][4][""] + 1)
        c, d, total, freed, _ = model[n]
        lower = p(gram[1:])
        ctx = gram[:-1]
        if not total[ctx]:
            return lower
        return (max(0, c[gram] - d[min(c[gram], 3)]) / total[ctx] if c[gram] else 0) + freed[ctx] / total[ctx] * lower
    return p, sorted({g for g in counts[1]})


def test_probabilities_and_scores(spark):
    rng = random.Random(1)
    texts = [words(rng, 30) for _ in range(12)] + ["ab", "", "é\n é  x"]
    p, letters = kneser_ney(texts, 4)
    for ctx in ("", "t", "on", "xyz", "sto"):
        assert abs(sum(p(ctx + c) for c in letters) + p(ctx + "\x03") - 1) < 1e-9
    trained = spark.createDataFrame([("aa", t) for t in texts], "lang string, text string").repartition(3)
    rows = quality.model_rows(trained)
    for r in rows.filter("not context").collect():
        if r.gram:
            assert math.isclose(math.exp(r.value), p(r.gram), rel_tol=1e-6), r
    tried = texts[:3] + ["unlike Ω text", "x", "", None]
    docs = spark.createDataFrame([(i, t, "aa", "", "", "") for i, t in enumerate(tried)], SCHEMA)
    for size in (10_000_000, 100):
        for r in quality.scored(docs, rows, shard_rows=size).collect():
            text = quality.PAD * 3 + " ".join((tried[r.doc_id] or "").split())
            want = sum(math.log(p(text[i - 3:i + 1])) for i in range(3, len(text)))
            assert r.chars == len(text) - 3 and math.isclose(r.logp, want, rel_tol=1e-4, abs_tol=1e-6)


def test_lookup():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(1, 1 << 63, 5000).astype(np.uint64))
    keys[:50] = (np.uint64(5) << np.uint64(50)) + np.arange(50, dtype=np.uint64)  # all in one slot
    table = quality.Lookup(keys, np.arange(len(keys), dtype=np.float32))
    assert (table(keys) == np.arange(len(keys))).all()
    assert np.isnan(table(keys + np.uint64(1 << 20))).all()


def test_judge(spark):
    rng = random.Random(2)
    good = [words(rng, rng.randrange(20, 80)) for _ in range(80)]
    bad = ["".join(rng.choice("#$%&xqzjvkw") + rng.choice(" QXZ") for _ in range(200)) for _ in range(10)]
    rows = [(i, t, "aa" if i % 2 else None, "", "", "") for i, t in enumerate(good)]
    rows += [(200 + i, t, "aa", "", "", "") for i, t in enumerate(bad)]
    rows += [(300, None, "aa", "", "", ""), (301, "", "aa", "", "", ""), (302, good[1], "zz", "", "", ""), (303, "stone water", "aa", "", "", ""), (None, good[3], "aa", "", "", ""), rows[1]]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    trusted = spark.createDataFrame([(i, 1) for i in range(60)] + [(None, 1), (3, 1)], "doc_id long, quality int")
    found = quality.judge(df, trusted).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    assert sum(by[i].keep for i in range(80)) >= 78
    assert not any(by[200 + i].keep for i in range(10)) and not by[300].keep and not by[301].keep and by[300].perplexity is None
    assert by[303].keep and by[302].threshold is not None and by[0].lang == "und"
    assert quality.judge(df.limit(0), trusted).collect() == []
    assert not any(r.keep for r in quality.judge(df, trusted.limit(0)).collect())
