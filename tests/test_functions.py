import datetime
import math

import pytest
from pyspark.sql import functions as F

from ratecraft.functions import scalar, text


def one(spark, column, **values):
    frame = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    return frame.select(column.alias("out")).first()["out"]


def test_cosine_distance_example(spark):
    a, b = F.array(*map(F.lit, [0.0, 1.0, 1.0, 1.0])), F.array(*map(F.lit, [0.0, 1.0, 0.0, 1.0]))
    assert one(spark, scalar.cosine_distance(a, b)) == pytest.approx(1 - 2 / math.sqrt(6))
    zero = F.array(*map(F.lit, [0.0, 0.0, 0.0, 0.0]))
    assert one(spark, scalar.cosine_distance(a, zero)) is None


def test_unit_vector(spark):
    assert one(spark, scalar.unit(F.array(F.lit(3.0), F.lit(4.0)))) == pytest.approx([0.6, 0.8])
    assert one(spark, scalar.unit(F.array(F.lit(0.0), F.lit(0.0)))) is None


def test_half_even_rounding(spark):
    rows = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (3.4,)], "x double")
    assert [r[0] for r in rows.select(scalar.rating_class(F.col("x"))).collect()] == [0, 2, 2, 3]


def test_age_counts_whole_days(spark):
    late, early = datetime.datetime(2020, 3, 1, 12), datetime.datetime(2020, 1, 1, 13)
    rows = spark.createDataFrame([(early, late)], "a timestamp_ntz, b timestamp_ntz")
    # 59 days and 23 hours elapsed: 59 whole days
    assert rows.select(scalar.age_in_months(F.col("a"), F.col("b"))).first()[0] == pytest.approx(59 / 30)


def test_decays_stay_in_range(spark):
    rows = spark.range(50).select(scalar.age_decay(F.col("id").cast("double")).alias("a"),
                                  scalar.distance_decay(F.col("id").cast("double")).alias("d"))
    for a, d in rows.collect():
        assert 1 / math.e < a <= 1 and 1 / math.e < d <= 1
    assert rows.first() == (1.0, 1.0)


def test_novelty_ends(spark):
    assert one(spark, scalar.novelty_of(F.lit(1.0))) == 0
    assert one(spark, scalar.novelty_of(F.lit(0.0))) == pytest.approx(-332.19, abs=0.01)


def test_tokens_and_stop_words(spark):
    words = text.tokens(F.lit("The 3rd CAT-dog, 42 and naïve x_1!"))
    assert one(spark, words) == ["the", "3rd", "cat", "dog", "and", "naïve", "x_1"]
    assert one(spark, text.without_stop_words(words)) == ["3rd", "cat", "dog", "naïve", "x_1"]


@pytest.mark.parametrize("low,high,expected", [
    (1, 1, ["a", "b", "c"]), (1, 2, ["a", "b", "c", "a b", "b c"]), (2, 3, ["a b", "b c", "a b c"]), (4, 5, [])])
def test_ngrams(spark, low, high, expected):
    assert one(spark, text.ngrams(F.array(F.lit("a"), F.lit("b"), F.lit("c")), low, high)) == expected


@pytest.mark.parametrize("sublinear", [True, False])
def test_tf_idf_by_hand(spark, sublinear):
    docs = {1: "red red car", 2: "red bike", 3: "boat"}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    counts = text.term_counts(frame, ["doc_id"])
    got = {(r.doc_id, r.term): r.weight for r in text.tf_idf(counts, F.lit(3), sublinear_tf=sublinear).collect()}
    idf = {t: math.log(4 / (1 + n)) + 1 for t, n in (("red", 2), ("car", 1), ("bike", 1), ("boat", 1))}
    tf = 1 + math.log(2) if sublinear else 2
    length = math.hypot(tf * idf["red"], idf["car"])
    assert got[(1, "red")] == pytest.approx(tf * idf["red"] / length)
    assert got[(1, "car")] == pytest.approx(idf["car"] / length)
    assert got[(3, "boat")] == pytest.approx(1.0)


def test_top_terms(spark):
    frame = spark.createDataFrame([("b a1 b",), ("c a1 b the",)], "text string")
    assert [tuple(r) for r in text.top_terms(frame, 2).collect()] == [("b", 3, 1.0), ("a1", 2, 2 / 3)]


def test_term_ids_name_the_same_terms(spark):
    """Ids rolled from word to word count as the texts do, and the dictionary reads them back."""
    docs = spark.createDataFrame([(1, "red fox and red fox ran"), (2, "fox"), (3, ""), (4, "red red red red")], "doc_id long, text string")
    by_text = {(r.doc_id, r.term): r.tf for r in text.term_counts(docs, ["doc_id"], (1, 3), ()).collect()}
    ids = text.term_id_counts(docs, ["doc_id"], (1, 3), ())
    named = ids.join(text.term_ids(docs, (1, 3), ()).withColumnRenamed("term", "word"), ids.term == F.col("id"))
    assert {(r.doc_id, r.word): r.tf for r in named.collect()} == by_text and by_text[1, "red fox"] == 2 and by_text[4, "red red red"] == 2
