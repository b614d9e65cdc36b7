"""Section 2.1: scans, sources, sinks. Views are written to the shared folder and scanned back."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ratecraft import ITEM, PAIR, RATING, USER, schemas
from ratecraft.catalog.columns import wide
from ratecraft.catalog.registry import query
from ratecraft.operators.splits import COHORTS, cohorts
from ratecraft.plans import discount
from ratecraft.session import new_path
from ratecraft.sources import readers, writers


def _as_text(df, *keys):
    return df.withColumns({k: F.col(k).cast("string") for k in keys})


def _json_copy(v, df, name, compression="none"):
    return writers.write_json(df, new_path(v.spark, f"{name}.json"), compression)


def _csv_copy(v, df, name, compression="none"):
    return writers.write_csv(df, new_path(v.spark, f"{name}.csv"), compression=compression)


@query("src_01_reviews", uses="reviews", sql="""
    SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(business_id AS VARCHAR) AS business_id, rating, text, date
    FROM reviews""")
def reviews(v):
    stored = _as_text(v.reviews.drop("doc_id").withColumnRenamed("rating", "stars"), *PAIR)
    return readers.read_reviews(v.spark, _json_copy(v, stored, "review"))


@query("src_02_reviews_no_text", uses="reviews", sql="""
    SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(business_id AS VARCHAR) AS business_id, rating, date
    FROM reviews""")
def reviews_no_text(v):
    stored = _as_text(v.reviews.drop("doc_id").withColumnRenamed("rating", "stars"), *PAIR)
    return readers.read_reviews(v.spark, _json_copy(v, stored, "review"), text=False)


@query("src_03_business", uses="business", sql="""
    SELECT * REPLACE (CAST(business_id AS VARCHAR) AS business_id) FROM business""")
def business(v):
    return readers.read_business(v.spark, _json_copy(v, _as_text(v.business, "business_id"), "business"))


@query("src_04_users", uses="users", sql="SELECT * REPLACE (CAST(user_id AS VARCHAR) AS user_id) FROM users")
def users(v):
    return readers.read_users(v.spark, _json_copy(v, _as_text(v.users, "user_id"), "user"))


@query("src_05_tips", uses="tip", sql="""
    SELECT CAST(business_id AS VARCHAR) AS business_id, CAST(user_id AS VARCHAR) AS user_id, text, date,
           compliment_count FROM tip""")
def tips(v):
    return readers.read_tips(v.spark, _json_copy(v, _as_text(v.tip, *PAIR), "tip", "gzip"))


@query("src_06_photos", uses="photos", sql="""
    SELECT caption, photo_id, CAST(business_id AS VARCHAR) AS business_id, label FROM photos""")
def photos(v):
    return readers.read_photos(v.spark, _json_copy(v, _as_text(v.photos, "business_id"), "photo"))


@query("src_07_csv", uses="ratings", sql="SELECT user_id, business_id, rating, date FROM ratings")
def csv(v):
    return readers.read_csv(v.spark, _csv_copy(v, v.ratings, "ratings"), schemas.rating_csv())


@query("src_07_csv_business", uses="business", sql="SELECT * FROM business")
def csv_business(v):
    return readers.read_csv(v.spark, _csv_copy(v, v.business, "business"), schemas.business(LongType()))


@query("src_07_csv_reviews", uses="reviews", sql="SELECT user_id, business_id, rating, text, date FROM reviews")
def csv_reviews(v):
    """Texts with line breaks and quotes in them."""
    table = v.reviews.drop("doc_id")
    return readers.read_csv(v.spark, _csv_copy(v, table.select(*PAIR, "rating", "text", "date"), "reviews"), schemas.review_csv())


@query("src_07_csv_wide", uses="wide", sql="""
    SELECT * REPLACE (round(stars, 6) AS stars, round(average_stars, 6) AS average_stars, nullif(elite, '') AS elite) FROM wide""")
def csv_wide(v):
    """In CSV an empty value is a null."""
    table = wide(v)
    back = readers.read_csv(v.spark, _csv_copy(v, table, "wide", "gzip"), table.schema)
    return back.withColumns({c: F.round(c, 6) for c in ("stars", "average_stars")})


@query("src_07_csv_discounted", uses="discounted", sql="""
    SELECT user_id, business_id, rating, round(date_dist_rating, 6) AS date_dist_rating FROM discounted""")
def csv_discounted(v):
    table = discount.export_columns(discount.discounted_detail(v.ratings, v.business))
    back = readers.read_csv(v.spark, _csv_copy(v, table, "discounted"), schemas.discounted_csv())
    return back.select(*PAIR, "rating", F.round("date_dist_rating", 6).alias("date_dist_rating"))


@query("src_01_quarantine", uses="reviews", sql="""
    SELECT kind, count(*) AS n, CAST(sum(CASE WHEN kind = 'kept' THEN rating END) AS DOUBLE) AS ratings FROM (
      SELECT rating, CASE doc_id % 50 WHEN 0 THEN 'unreadable' WHEN 1 THEN 'does not fit' ELSE 'kept' END AS kind FROM reviews) t
    GROUP BY kind""")
def quarantined_reviews(v):
    """Of every 50 lines one is cut off and one has a word for its rating."""
    fields = lambda stars: F.to_json(
        F.struct(F.col(USER).cast("string").alias(USER), F.col(ITEM).cast("string").alias(ITEM), stars.alias("stars"), "text", "date"),
        {"timestampNTZFormat": readers.TIMESTAMP})
    whole = fields(F.col(RATING))
    line = F.when(F.col("doc_id") % 50 == 0, F.substring(whole, 1, 12)).when(F.col("doc_id") % 50 == 1, fields(F.lit("many"))).otherwise(whole)
    path = new_path(v.spark, "broken")
    v.reviews.select(line.alias("value")).write.text(path)
    read = readers.read_quarantined(v.spark, path, schemas.review())
    kept = read.rows.agg(F.lit("kept").alias("kind"), F.count(F.lit(1)).alias("n"), F.sum("stars").alias("ratings"))
    return kept.unionByName(read.rejects.groupBy(F.col("reason").alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("ratings")))


@query("src_08_cohort_files", uses="cohort_rows", sql="SELECT * FROM cohort_rows")
def cohort_files(v):
    folder = new_path(v.spark, "special")
    tagged = v.stored("cohorts", lambda: cohorts(v.train, v.test))
    for name in COHORTS:
        writers.write_csv(tagged.filter(F.col("cohort") == name).drop("cohort"), f"{folder}/{name}.csv")
    return readers.read_cohorts(v.spark, folder, COHORTS)


@query("src_09_result_files", uses="ratings", sql="""
    SELECT rating, count(*) AS n, round(avg(business_id), 6) AS mean_item FROM ratings GROUP BY rating""")
def result_files(v):
    report = v.ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("n"),
                                             F.round(F.avg("business_id"), 6).alias("mean_item"))
    path = _csv_copy(v, report, "results")
    return readers.read_csv(v.spark, path, "rating double, n long, mean_item double")


@query("src_10_sql_view", uses="ratings", sql="""
    SELECT business_id, count(*) AS n, round(avg(rating), 6) AS mean FROM ratings GROUP BY business_id""")
def sql_view(v):
    readers.register_view(v.ratings, "ratecraft_ratings")
    return v.spark.sql("SELECT business_id, count(*) AS n, round(avg(rating), 6) AS mean FROM ratecraft_ratings "
                       "GROUP BY business_id")


RATING_WORDS = [(1.0, "bad"), (2.0, "weak"), (3.0, "fair"), (4.0, "good"), (5.0, "best")]


@query("src_11_local_rows", uses="ratings", sql="""
    SELECT w.word, count(*) AS n FROM ratings r
    JOIN (VALUES (1.0, 'bad'), (2.0, 'weak'), (3.0, 'fair'), (4.0, 'good'), (5.0, 'best')) w(rating, word)
      ON r.rating = w.rating GROUP BY w.word""")
def local_rows(v):
    words = readers.local_rows(v.spark, RATING_WORDS, "rating double, word string")
    counts = v.ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(words, "rating").select("word", "n")


@query("snk_01_csv", uses="discounted", sql="""
    SELECT user_id, business_id, rating, round(date_rating, 6) AS date_rating, round(dist_rating, 6) AS dist_rating,
           round(date_dist_rating, 6) AS date_dist_rating FROM discounted""")
def csv_sink(v):
    table = discount.export_columns(discount.discounted_detail(v.ratings, v.business))
    back = readers.read_csv(v.spark, _csv_copy(v, table, "time_location_aware"), schemas.discounted_csv(LongType()))
    return back.select(*PAIR, "rating", *(F.round(c, 6).alias(c) for c in
                                          ("date_rating", "dist_rating", "date_dist_rating")))


@query("snk_02_materialize", uses="ratings", sql="""
    SELECT user_id, count(*) AS n, max(date) AS last_date FROM ratings GROUP BY user_id""")
def materialized(v):
    def build():
        return v.ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("date").alias("last_date"))
    name = f"{v.key}/user_activity"
    writers.materialize(v.spark, name, build, use_cache=False)
    return writers.materialize(v.spark, name, build)
