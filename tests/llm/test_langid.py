import random

import numpy as np
from brute import words

from ratecraft.llm import langid

SCHEMA = "doc_id long, text string, lang string, score string, rejected int, source string, n_chars long"
SOUNDS = {"aa": "ka lo mi tu sa".split(), "bb": "strend gruft klamm zwack".split(), "cc": "ление ство ать при".split()}


def documents(rng, n=150):
    rows = []
    for i in range(n):
        lang = rng.choice(list(SOUNDS))
        text = " ".join(rng.choice(SOUNDS[lang]) + rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(3, 80)))
        rows.append((i, text, lang, "s", 1, "src", len(text)))
    return rows


def test_predictions(spark):
    rows = documents(random.Random(1))
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, " 12 %", "bb"), (1003, "一二三四五六七八九十" * 20, None), (None, rows[0][1], "aa"), (1004, "kalo " * 30_000, "aa")]
    rows += [(*r, "s", 1, "src", 0) for r in odd] + [rows[0], rows[0]]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = langid.fit(langid.training_rows(df))
    found = langid.predict(df, model).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    assert all(by[r[0]].lang_pred == r[2] and not by[r[0]].rejected for r in rows[:150])
    assert all(by[i].lang_pred == "und" and by[i].rejected and by[i].score == 0 for i in (1000, 1001, 1002))
    assert by[1003].rejected and by[1003].lang_pred != "und" and by[1004].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in found)
    kept = langid.keep_known(df, model)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in found if not r.rejected)
    # The nearest centroid, computed plainly.
    known = langid.unpacked(model)
    point, _ = langid.vectors([rows[3][1]], known["weight"])
    cosine = [float(np.dot(point[0], c)) for c in known["centre"]]
    assert abs(max(cosine) - by[3].score) < 1e-5


def test_nothing_held_out_is_learnt(spark):
    rows = documents(random.Random(2))
    df = spark.createDataFrame(rows, SCHEMA)
    spoiled = df.withColumn("lang", langid.F.when(langid.held_out(), "zz").otherwise(langid.F.col("lang")))
    model = langid.fit(langid.training_rows(spoiled))
    assert "zz" not in langid.unpacked(model)["lang"].tolist()


def test_without_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert langid.fit(df) is None and langid.predict(df, None).collect() == []
    one = spark.createDataFrame([(1, words(random.Random(0), 9), "aa", "", 1, "", 1)], SCHEMA)
    assert langid.predict(one, None).first().rejected and langid.keep_known(one, None).count() == 0


def test_left_out_language_and_gibberish_are_rejected(spark):
    rng = random.Random(5)
    learnt = {"aa": "ka lo mi tu sa".split(), "bb": "strend gruft klamm zwack".split()}
    rows = []
    for i in range(300):
        lang = rng.choice(list(learnt))
        text = " ".join(rng.choice(learnt[lang]) + rng.choice(learnt[lang]) for _ in range(rng.randrange(1, 80)))
        rows.append((i, text, lang, "s", 1, "src", len(text)))
    foreign = [" ".join(rng.choice("quiv phex joor wyd".split()) + rng.choice("eng ophy ird".split()) for _ in range(rng.randrange(8, 60))) for _ in range(40)]
    noise = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(3, 9))) for _ in range(rng.randrange(8, 60))) for _ in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = langid.fit(langid.training_rows(df))
    strange = spark.createDataFrame([(1000 + i, t, None, "s", 1, "src", 0) for i, t in enumerate(foreign + noise)], SCHEMA)
    assert sum(r.rejected for r in langid.predict(strange, model).collect()) >= 78
    # Clean rows stay, also the third that the model has not seen.
    assert sum(r.rejected for r in langid.predict(df, model).collect()) <= 3


def test_copies_do_not_crowd_a_language_out_of_the_sample(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices(SOUNDS["aa"], k=9)), "aa", "s", 1, "src", 0) for i in range(60)]
    rows += [(100 + i, " ".join(rng.choices(SOUNDS["bb"], k=9)), "bb", "s", 1, "src", 0) for i in range(60)]
    rows += [(1000 + i, "strend gruft", "bb", "s", 1, "src", 0) for i in range(20_000)]
    known = langid.unpacked(langid.fit(spark.createDataFrame(rows, SCHEMA), sample=40))
    # By rows, the share of "bb" gave 40 / 20,060 of its 61 texts: none as a rule.
    assert known["lang"].tolist().count("bb") == langid.CENTROIDS
