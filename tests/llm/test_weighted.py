import hashlib
import math
import random
import re
import struct
from collections import Counter

import numpy as np
import xxhash
from brute import words

from ratecraft.llm import weighted

SCHEMA = "doc_id long, text string, _at string, fingerprint string, text2 string"


def bag(text):
    text = re.sub("[ぁ-んァ-ヺ一-龯]", r" \g<0> ", text.lower())
    return Counter(re.findall(r"[^\W_]+", text)) or Counter([text])


def spread(term, n):
    """Two numbers from a term and a number, as Spark's xxhash64 draws them."""
    h = xxhash.xxh64_intdigest(struct.pack("<q", struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(term.encode(), 42)))[0]), 42)
    x = xxhash.xxh64_intdigest(struct.pack("<i", n), h)
    return ((x & 0xFFFFFFFF) + 0.5) / 2 ** 32, ((x >> 32) + 0.5) / 2 ** 32


def samples(text, n=weighted.SAMPLES):
    """(term, t) of each sample, by the definition."""
    out = []
    for i in range(n):
        drawn = []
        for term, count in bag(text).items():
            low, high = spread(term, 4 * i + 7)
            r = -math.log(low * high)
            low, high = spread(term, 4 * (i % 8) + 8)
            c = -math.log(low * high)
            b = spread(term, 4 * (i // 2) + 9)[i % 2]
            t = math.floor(math.log(count) / r + b)
            drawn.append((math.log(c) - r * (t - b + 1), term, t))
        out.append(min(drawn)[1:])
    return out


def share(a, b):
    return sum(x == y for x, y in zip(a, b)) / len(a)


def jaccard(a, b):
    a, b = bag(a), bag(b)
    return sum((a & b).values()) / sum((a | b).values())


def edited(text, following):
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def test_report_against_the_definition(spark):
    rng = random.Random(1)
    texts = [words(rng, rng.randrange(1, 80)) for _ in range(40)]
    texts += [texts[3], texts[3].upper(), "", None, "?!", "?!?", "ab\U0001F600cd ef", "a" * 7, "日本語テキスト 東京 abc", "日本", texts[4] * 60]
    rows = [(3 * i, t, "", "", "") for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, rows[7], (None, texts[9], "", "", "")], SCHEMA).repartition(3)
    found = weighted.edits_and_neighbours(df).collect()
    assert len(found) == len(rows) + 2
    order = [(i, t or "") for i, t, *_ in sorted(rows, reverse=True)] + [(None, texts[9])]
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(by_id[rows[7][0]]) == 2 and len(set(by_id[rows[7][0]])) == 1
    for at, (doc, text) in enumerate(order):
        following = order[(at + 1) % len(order)][1]
        changed = edited(text, following)
        r = by_id[doc][0]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 8 * weighted.SAMPLES
        own = samples(text)
        assert r.near_edited == share(own, samples(changed)) and r.near_next == share(own, samples(following))
    prints = {}
    for (_, text), r in ((o, by_id[o[0]][0]) for o in order):
        prints.setdefault(frozenset(bag(text).items()), set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values()) and len({p for s in prints.values() for p in s}) == len(prints)
    alone = {r.doc_id: r.fingerprint for r in weighted.fingerprints(df).collect()}
    assert alone == {i: rs[0].fingerprint for i, rs in by_id.items()}


def test_collision_rate_is_the_similarity(spark):
    """Over many pairs the mean share of equal samples is the generalised Jaccard similarity."""
    rng = random.Random(2)
    texts = []
    for i in range(400):
        own = [f"w{i}x{j}" for j in range(30)]
        a = [w for w in own for _ in range(rng.choice((1, 1, 1, 2, 5, 20)))]
        b = a[:rng.randrange(len(a))] + [f"v{i}x{j}" for j in range(rng.randrange(60))]
        texts += [" ".join(a), " ".join(b) or "x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = dict(weighted.fingerprints(df).collect())
    cut = lambda f: [f[i:i + 8] for i in range(0, len(f), 8)]
    gap = np.array([share(cut(found[i]), cut(found[i + 1])) - jaccard(texts[i], texts[i + 1]) for i in range(0, len(texts), 2)])
    assert abs(gap.mean()) < 0.012 and gap.std() < 0.1


def test_few_rows_and_native_plan(spark, capsys):
    df = spark.createDataFrame([], SCHEMA)
    assert weighted.edits_and_neighbours(df).collect() == [] and weighted.fingerprints(df).collect() == []
    one = weighted.edits_and_neighbours(spark.createDataFrame([(5, "one two three", "", "", "")], SCHEMA)).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"one twoone tw"[:7] + b"one tw").hexdigest() and one[0].near_next == 1.0
    rows = spark.createDataFrame([(i, f"text {i}", "", "", "") for i in range(9)], SCHEMA)
    weighted.sketches(rows.select("doc_id", "text"), ["doc_id"]).explain()
    assert "Python" not in capsys.readouterr().out
