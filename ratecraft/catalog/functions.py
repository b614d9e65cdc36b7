"""Section 2.8: scalar functions, each over a whole view."""

from pyspark.sql import functions as F

from ratecraft import ITEM, PAIR, PREDICTION, RATING, USER
from ratecraft.catalog.columns import rounded
from ratecraft.catalog.registry import query
from ratecraft.functions import scalar, text
from ratecraft.metrics import novelty, serendipity
from ratecraft.operators import ranking, relational as rel
from ratecraft.plans import discount
from ratecraft.session import new_path
from ratecraft.sources import readers, writers


def _detail(v, *columns):
    return rounded(discount.discounted_detail(v.ratings, v.business).select(*PAIR, *columns), *columns)


def _of_discounted(*columns):
    shown = ", ".join(f"round({c}, 6) AS {c}" for c in columns)
    return {"uses": "discounted", "sql": f"SELECT user_id, business_id, {shown} FROM discounted"}


@query("fn_01_squared_distance", uses="discounted", sql="""
    SELECT user_id, business_id, round(distance, 8) AS distance FROM discounted""")
def squared_distance(v):
    detail = discount.discounted_detail(v.ratings, v.business)
    return detail.select(*PAIR, F.round("distance", 8).alias("distance"))


@query("fn_02_age_in_months", **_of_discounted("date_diff"))
def age_in_months(v):
    return _detail(v, "date_diff")


@query("fn_03_distance_decay", **_of_discounted("dist_scale"))
def distance_decay(v):
    return _detail(v, "dist_scale")


@query("fn_04_age_decay", **_of_discounted("date_scale"))
def age_decay(v):
    return _detail(v, "date_scale")


@query("fn_05_discounted_rating", **_of_discounted("date_rating", "dist_rating", "date_dist_rating"))
def discounted_rating(v):
    return _detail(v, "date_rating", "dist_rating", "date_dist_rating")


@query("fn_06_to_timestamp", uses="ratings", sql="SELECT user_id, business_id, date FROM ratings")
def to_timestamp(v):
    written = v.ratings.select(*PAIR, F.date_format("date", readers.TIMESTAMP).alias("written"))
    return written.select(*PAIR, F.expr(f"to_timestamp_ntz(written, '{readers.TIMESTAMP}')").alias("date"))


@query("fn_07_json_columns", uses="reviews", sql="""
    SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(business_id AS VARCHAR) AS business_id, rating FROM reviews""")
def json_columns(v):
    lines = v.reviews.select(F.to_json(F.struct(F.col(USER).cast("string").alias(USER),
                                                F.col(ITEM).cast("string").alias(ITEM),
                                                F.col(RATING).alias("stars"), "text")).alias("value"))
    path = new_path(v.spark, "lines")
    lines.write.text(path)
    parsed = v.spark.read.text(path).select(
        F.from_json("value", "user_id string, business_id string, stars double").alias("j"))
    return parsed.select("j.user_id", "j.business_id", F.col("j.stars").alias(RATING))


@query("fn_08_tokens", uses="reviews", sql=f"""
    SELECT doc_id, len(t) AS n, array_to_string(t, ' ') AS joined
    FROM (SELECT doc_id, regexp_extract_all(lower(text), '{text.TOKEN}') AS t FROM reviews)""")
def tokens(v):
    words = v.reviews.select("doc_id", text.tokens(F.col("text")).alias("t"))
    return words.select("doc_id", F.size("t").cast("long").alias("n"), F.array_join("t", " ").alias("joined"))


@query("fn_09_stop_words", uses="words", sql="""
    SELECT doc_id, len(words) AS n, array_to_string(words, ' ') AS joined FROM words""")
def stop_words(v):
    words = v.reviews.select("doc_id", text.without_stop_words(text.tokens(F.col("text"))).alias("t"))
    return words.select("doc_id", F.size("t").cast("long").alias("n"), F.array_join("t", " ").alias("joined"))


@query("fn_10_ngrams", uses="words", sql="""
    SELECT doc_id, term, count(*) AS n FROM (
      SELECT doc_id, unnest(words) AS term FROM words
      UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))
      FROM words
      UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(words) - 1),
             lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) FROM words)
    GROUP BY doc_id, term""")
def ngrams(v):
    return text.term_counts(v.reviews, ["doc_id"], (1, 3)).withColumnRenamed("tf", "n")


@query("fn_11_item_novelty", uses="item_prob", sql="""
    SELECT business_id, round(log2(greatest(prob, 1e-100)), 6) AS novelty FROM item_prob""")
def item_novelty(v):
    prob = novelty.item_probability(rel.corpus(v.train, v.test))
    return prob.select(ITEM, F.round(scalar.novelty_of(F.col("prob")), 6).alias("novelty"))


@query("fn_12_clamp", uses="predictions", sql="""
    SELECT user_id, business_id, round(greatest(prediction - rating, 0), 6) AS gain FROM predictions""")
def clamp(v):
    return v.predictions.select(*PAIR, F.round(scalar.clamp_at_zero(F.col(PREDICTION) - F.col(RATING)), 6)
                                .alias("gain"))


@query("fn_13_clip", uses="predictions", sql="""
    SELECT user_id, business_id, round(least(greatest(2 * prediction - 3, 1), 5), 6) AS clipped FROM predictions""")
def clip(v):
    stretched = F.lit(2.0) * F.col(PREDICTION) - F.lit(3.0)
    return v.predictions.select(*PAIR, F.round(scalar.clip(stretched, 1, 5), 6).alias("clipped"))


@query("fn_14_half_even", uses="ratings", sql="""
    SELECT user_id, business_id, CAST(round_even(rating / 2, 0) AS INTEGER) AS class FROM ratings""")
def half_even(v):
    return v.ratings.select(*PAIR, scalar.rating_class(F.col(RATING) / 2).alias("class"))


@query("fn_15_cosine_distance", uses="train top10 item_content", sql="""
    WITH needed AS (
      SELECT DISTINCT least(a.business_id, t.business_id) AS item_a, greatest(a.business_id, t.business_id) AS item_b
      FROM train a JOIN top10 t ON a.user_id = t.user_id)
    SELECT n.item_a, round(max(list_cosine_distance(x.features, y.features)), 6) AS farthest
    FROM needed n JOIN item_content x ON x.business_id = n.item_a JOIN item_content y ON y.business_id = n.item_b
    GROUP BY n.item_a""")
def cosine_distance(v):
    dist = serendipity.needed_distances(v.train, ranking.top_n(v.predictions), v.item_content)
    return rounded(dist.groupBy("item_a").agg(F.max("dist").alias("farthest")), "farthest")


@query("fn_16_errors", uses="predictions", sql="""
    SELECT user_id, business_id, round(pow(prediction - rating, 2), 6) AS squared,
           round(abs(prediction - rating), 6) AS absolute FROM predictions""")
def errors(v):
    gap = F.col(PREDICTION) - F.col(RATING)
    return v.predictions.select(*PAIR, F.round(F.pow(gap, F.lit(2.0)), 6).alias("squared"),
                                F.round(F.abs(gap), 6).alias("absolute"))


@query("fn_17_tf_idf", uses="tfidf", sql="SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf")
def tf_idf(v):
    counts = text.term_counts(v.reviews, ["doc_id"])
    docs = v.reviews.agg(F.count(F.lit(1))).scalar()
    return rounded(text.tf_idf(counts, docs, sublinear_tf=True), "weight")
