"""Section 2.4: aggregations; section 2.6: sorts and limits."""

from pyspark.sql import functions as F

from ratecraft import ITEM, PAIR, RATING, USER
from ratecraft.catalog.columns import rounded, wide
from ratecraft.catalog.registry import query
from ratecraft.functions import text
from ratecraft.metrics import accuracy, novelty, serendipity
from ratecraft.operators import ranking, relational as rel
from ratecraft.plans import discount


@query("agg_01_ratings_per_user", uses="ratings", sql="SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id")
def ratings_per_user(v):
    return rel.count_by(v.ratings, [USER])


@query("agg_02_centroid", uses="detail", sql="""
    SELECT user_id, round(avg(latitude), 8) AS mean_lat, round(avg(longitude), 8) AS mean_long
    FROM detail GROUP BY user_id""")
def centroid(v):
    return rounded(rel.centroids(rel.with_business(v.ratings, v.business)), "mean_lat", "mean_long", places=8)


@query("agg_03_latest_date", uses="ratings", sql="SELECT user_id, max(date) AS last_date FROM ratings GROUP BY user_id")
def latest_date(v):
    return v.ratings.groupBy(USER).agg(F.max("date").alias("last_date"))


@query("agg_04_open_counts", uses="wide", sql="""
    SELECT 'city' AS kind, city AS name, count(is_open) AS n FROM wide GROUP BY city
    UNION ALL SELECT 'state', state, count(is_open) FROM wide GROUP BY state
    UNION ALL SELECT 'rating', CAST(CAST(rating AS INTEGER) AS VARCHAR), count(is_open) FROM wide GROUP BY rating""")
def open_counts(v):
    # One expand over three grouping sets instead of three passes over the wide table.
    keyed = wide(v).select("is_open", F.explode(F.create_map(
        F.lit("city"), F.col("city"), F.lit("state"), F.col("state"),
        F.lit("rating"), F.col("rating").cast("int").cast("string"))).alias("kind", "name"))
    return rel.count_by(keyed, ["kind", "name"], "is_open")


@query("agg_05_address_counts", uses="wide", sql="SELECT city, count(address) AS n FROM wide GROUP BY city")
def address_counts(v):
    return rel.count_by(wide(v), ["city"], "address")


@query("agg_06_cities_per_user", uses="detail", sql="""
    SELECT user_id, count(DISTINCT city) AS cities FROM detail GROUP BY user_id""")
def cities_per_user(v):
    return rel.with_business(v.ratings, v.business).groupBy(USER).agg(F.count_distinct("city").alias("cities"))


@query("agg_07_histogram", uses="wide", sql="""
    WITH x AS (SELECT CAST(review_count_x AS DOUBLE) AS x FROM wide WHERE review_count_x < 1000),
         e AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 10 AS w FROM x),
         c AS (SELECT CAST(least(floor((x - lo) / w), 9) AS INTEGER) AS bin, count(*) AS n FROM x, e GROUP BY 1)
    SELECT CAST(b.i AS INTEGER) AS bin, round(lo + b.i * w, 6) AS low, round(lo + (b.i + 1) * w, 6) AS high,
           coalesce(c.n, 0) AS n
    FROM range(10) b(i) CROSS JOIN e LEFT JOIN c ON c.bin = b.i""")
def histogram(v):
    return rounded(rel.histogram(wide(v).filter(F.col("review_count_x") < 1000), "review_count_x"), "low", "high")


@query("agg_08_distinct_counts", uses="corpus", sql="""
    SELECT count(DISTINCT user_id) AS users, count(DISTINCT business_id) AS items FROM corpus""")
def distinct_counts(v):
    both = rel.corpus(v.train, v.test)
    return both.agg(F.count_distinct(USER).alias("users"), F.count_distinct(ITEM).alias("items"))


@query("agg_09_min_max", uses="discounted", sql="""
    SELECT round(min(date_dist_rating), 6) AS lower, round(max(date_dist_rating), 6) AS upper FROM discounted""")
def min_max(v):
    detail = discount.discounted_detail(v.ratings, v.business)
    return detail.agg(F.round(F.min("date_dist_rating"), 6).alias("lower"),
                      F.round(F.max("date_dist_rating"), 6).alias("upper"))


@query("agg_10_global_mean", uses="interactions", sql="SELECT round(avg(rating), 6) AS mean FROM interactions")
def global_mean(v):
    return v.interactions.agg(F.round(F.avg(RATING), 6).alias("mean"))


@query("agg_11_user_mean", uses="interactions", sql="""
    SELECT user_id, round(avg(rating), 6) AS mean FROM interactions GROUP BY user_id""")
def user_mean(v):
    return v.interactions.groupBy(USER).agg(F.round(F.avg(RATING), 6).alias("mean"))


@query("agg_12_nested_min_mean", uses="interactions", sql="""
    SELECT round(avg(m), 6) AS mean FROM (
      SELECT user_id, avg(low) AS m FROM (
        SELECT user_id, business_id, min(rating) AS low FROM interactions GROUP BY 1, 2) GROUP BY user_id)""")
def nested_min_mean(v):
    low = v.interactions.groupBy(*PAIR).agg(F.min(RATING).alias("low"))
    return low.groupBy(USER).agg(F.avg("low").alias("m")).agg(F.round(F.avg("m"), 6).alias("mean"))


@query("agg_13_rank_statistics", uses="ranked test", sql="""
    SELECT k.user_id, min(k.rank) AS first, round(avg(k.rank), 6) AS middle, max(k.rank) AS last
    FROM ranked k JOIN test t ON t.user_id = k.user_id AND t.business_id = k.business_id GROUP BY k.user_id""")
def rank_statistics(v):
    return rounded(accuracy.ranks_per_user(v.predictions, v.test), "middle")


@query("agg_14_vector_sum", uses="predictions item_content", sql="""
    SELECT CAST(position AS INTEGER) AS position, round(sum(value), 6) AS total FROM (
      SELECT unnest(range(len(c.features))) AS position, unnest(c.features) AS value
      FROM predictions p JOIN item_content c ON c.business_id = p.business_id) GROUP BY position""")
def vector_sum(v):
    # Copies of one item add up first; each vector is then scaled once instead of once per prediction.
    times = rel.count_by(v.predictions, [ITEM])
    scaled = times.join(v.item_content, ITEM).withColumn(
        "features", F.transform("features", lambda x: x * F.col("n")))
    return rounded(rel.vector_sum(scaled), "total")


@query("agg_16_mean_std", uses="interactions", sql="""
    SELECT round(avg(m), 6) AS mean, round(stddev_pop(m), 6) AS std
    FROM (SELECT user_id, avg(rating) AS m FROM interactions GROUP BY user_id)""")
def mean_std(v):
    per_user = v.interactions.groupBy(USER).agg(F.avg(RATING).alias("m"))
    return rounded(rel.mean_std(per_user, "m"), "mean", "std")


PROFILE = [("name", "string"), ("business_id", "bigint"), ("address", "string"), ("city", "string"),
           ("state", "string"), ("postal_code", "string"), ("latitude", "double"), ("longitude", "double"),
           ("stars", "double"), ("review_count", "bigint"), ("is_open", "int")]


@query("agg_17_column_profile", uses="business", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS \"type\", count({c}) AS non_null FROM business" for c, t in PROFILE))
def column_profile(v):
    return rel.column_profile(v.business)


@query("agg_18_top_terms", uses="words", sql="""
    WITH c AS (SELECT term, count(*) AS n FROM (SELECT unnest(words) AS term FROM words) GROUP BY term)
    SELECT term, n, round(n / CAST((SELECT max(n) FROM c) AS DOUBLE), 6) AS relative
    FROM c ORDER BY n DESC, term LIMIT 2000""")
def top_terms(v):
    return rounded(text.top_terms(v.reviews), "relative")


@query("ord_01_order", uses="ranked", sql="""
    SELECT user_id, business_id, round(prediction, 6) AS prediction, rank FROM ranked
    ORDER BY user_id, prediction DESC""")
def order(v):
    ranks = ranking.rank_by_prediction(v.predictions.drop("rating"))
    return rounded(ranks, "prediction").orderBy(USER, F.col("prediction").desc())


@query("ord_02_top_groups", uses="wide", sql="""
    SELECT city, count(is_open) AS n FROM wide GROUP BY city ORDER BY n DESC, city LIMIT 10""")
def top_groups(v):
    return rel.top_groups(wide(v), "city", "is_open", 10)


@query("ord_04_preview", uses="ratings", sql="""
    SELECT user_id, business_id, rating, date FROM ratings ORDER BY user_id, business_id LIMIT 20""")
def preview(v):
    return v.ratings.orderBy(*PAIR).limit(20)
