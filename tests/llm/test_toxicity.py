import itertools
import random

import numpy as np
from brute import words

from ratecraft.llm import toxicity

SCHEMA = "doc_id long, text string, score string, predicted string, toxic string"
INSULTS = ["blockhead", "dimwit", "scoundrel", "numbskull"]


def subsequence_kernel(a, b):
    """By definition: every triple of places in both words, no wider than five letters."""
    def features(w):
        codes = [toxicity._FIRST, *map(toxicity._code, w), toxicity._LAST]
        out = {}
        for i, j, k in itertools.combinations(range(len(codes)), 3):
            if k - i <= 4:
                key = (codes[i], codes[j], codes[k])
                out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i - 2)
        return out
    x, y = features(a), features(b)
    dot = lambda p, q: sum(v * q.get(k, 0) for k, v in p.items())
    return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5


def test_kernel_by_definition():
    rng = random.Random(0)
    names = INSULTS + ["a", "ab", "éèa"]
    tried = names + ["blxockhead", "numb", "unrelated", "aaaaaaaaaa", "dimmwit"] + [words(rng, 1) for _ in range(20)]
    found = toxicity.Kernel(names).similarity(tried)
    want = np.array([[max(0, (subsequence_kernel(t, n) - toxicity.FLOOR) / (1 - toxicity.FLOOR)) for n in names] for t in tried])
    assert np.allclose(found, want, atol=1e-4)


def documents(rng, n=400):
    rows, labels = [], []
    for i in range(n):
        text, bad = words(rng, rng.randrange(3, 60)), int(i % 4 == 0)
        if bad:
            text += f" {rng.choice(INSULTS)} " + words(rng, 5)
        rows.append((i, text, "", "", ""))
        labels.append((i, 1, bad))
    return rows, labels


def test_held_out_and_disguised_insults(spark):
    rng = random.Random(3)
    rows, labels = documents(rng)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    marks = spark.createDataFrame(labels + [(5, 1, None), (None, 0, 1)] + labels[:9], "doc_id long, quality int, toxic int")
    model = toxicity.fit(df.filter(~toxicity_held()), marks)
    found = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    assert all((found[i].predicted == 1) == bool(bad) for i, _, bad in labels)
    disguised = ["b-l-o-c-k-h-e-a-d", "block.head", "n u m b s k u l l", "scoundrxel", "Dimwit!!!", "di.mwit"]
    tests = [(i, f"{words(rng, 20)} {w} {words(rng, 20)}", "", "", "") for i, w in enumerate(disguised)]
    tests += [(100, None, "", "", ""), (101, "", "", "", ""), (102, "block and head", "", "", ""), (103, words(rng, 40_000), "", "", ""),
              (None, "dimwit", "", "", ""), (101, "", "", "", "")]
    got = toxicity.score(spark.createDataFrame(tests, SCHEMA), model).collect()
    assert len(got) == len(tests)
    for r in got:
        assert r.predicted == (r.doc_id is None or r.doc_id < 100) and 0 <= r.score <= 1, r


def toxicity_held():
    from ratecraft.llm.common import held_out
    return held_out()


def test_without_classes(spark):
    rows, labels = documents(random.Random(4), 20)
    df = spark.createDataFrame(rows, SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    clean = spark.createDataFrame([x for x in labels if not x[2]], none.schema)
    assert toxicity.fit(df, none) is None and toxicity.fit(df, clean) is None and toxicity.fit(df.limit(0), clean) is None
    assert {(r.score, r.predicted) for r in toxicity.score(df, None).collect()} == {(0.0, 0)}
    assert toxicity.score(df.limit(0), None).collect() == []


def test_insult_deep_in_a_long_run():
    rng = random.Random(8)
    kernel = toxicity.Kernel(INSULTS)
    for insult in INSULTS:
        clean = "".join(words(rng, 60).split())
        glued = clean[:100] + insult + clean[100:]
        kept, found, spelled = kernel.describe([clean, glued, " ".join(glued)])
        at = INSULTS.index(insult)
        # The insult is seen as if it stood with few letters around it, not as a part of a word of hundreds.
        assert found[at] > 0.4 and spelled[at] > 0.4 and kept[at] < found[at] - 0.2
        early = kernel.describe([clean[:30] + insult + clean[30:60]])
        assert early[0][at] > 0.4


def test_windows_cover_every_place():
    for n in (25, 63, 64, 65, 200, 201, 203):
        form = "".join(chr(0x4E00 + i) for i in range(n))
        seen = list(toxicity.windows(form))
        assert all(any(form[at:at + 19] in w for w in seen) for at in range(n - 18))
    assert list(toxicity.windows("blockhead")) == ["blockhead"]
