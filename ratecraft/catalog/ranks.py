"""Section 2.5: window functions."""

from pyspark.sql import functions as F

from ratecraft import ITEM, PAIR, USER
from ratecraft.catalog.columns import rounded
from ratecraft.catalog.registry import query
from ratecraft.operators import ranking, relational as rel


@query("win_01_item_rank", uses="item_rank", sql="""
    SELECT business_id, round(avg_rating, 6) AS avg_rating, rank FROM item_rank""")
def item_rank(v):
    ranked, _ = ranking.item_ranking(rel.corpus(v.train, v.test))
    return rounded(ranked, "avg_rating")


@query("win_02_rank_in_user", uses="ranked", sql="""
    SELECT user_id, business_id, round(prediction, 6) AS prediction, rank FROM ranked""")
def rank_in_user(v):
    return rounded(ranking.rank_by_prediction(v.predictions.drop("rating")), "prediction")


@query("win_03_top_n", uses="ranked", sql="""
    SELECT user_id, business_id, round(prediction, 6) AS prediction, rank FROM ranked WHERE rank <= 10""")
def top_n(v):
    return rounded(ranking.top_n(v.predictions.drop("rating"), 10, keep_rank=True), "prediction")


@query("win_04_encode", uses="ratings", sql="""
    SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS code FROM (SELECT DISTINCT user_id FROM ratings)""")
def encode(v):
    return ranking.encode_ids(v.ratings, USER)


@query("win_05_rank_probability", uses="ranked", sql="""
    SELECT user_id, business_id, rank, n, round(CASE WHEN n = 1 THEN 1.0::DOUBLE
           ELSE (n - rank) / CAST(n - 1 AS DOUBLE) END, 6) AS prob
    FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM ranked)""")
def rank_probability(v):
    ranks = ranking.rank_by_prediction(v.predictions.drop("rating"), size="n")
    return ranks.select(*PAIR, "rank", "n",
                        F.round(ranking.rank_probability(F.col("rank"), F.col("n")), 6).alias("prob"))


@query("win_06_latest_per_user", uses="ratings", sql="""
    SELECT user_id, business_id, rating, date FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date DESC, business_id DESC, rating DESC) AS rn
      FROM ratings) WHERE rn = 1""")
def latest_per_user(v):
    return ranking.latest_per_user(v.ratings).select(USER, ITEM, "rating", "date")
