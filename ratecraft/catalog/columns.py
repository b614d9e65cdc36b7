"""Section 2.2: projections, filters, predicates."""

from pyspark.sql import functions as F

from ratecraft import ITEM, PAIR
from ratecraft.catalog.registry import query
from ratecraft.fixtures import COMPLIMENT_MODULI
from ratecraft.operators import relational as rel
from ratecraft.operators.ranking import top_n
from ratecraft.plans import discount

NUMERIC_WIDE = ("user_id, business_id, rating, latitude, longitude, round(stars, 6) AS stars, review_count_x, is_open, "
                "review_count_y, useful, funny, cool, fans, round(average_stars, 6) AS average_stars, "
                + ", ".join(f"compliment_{k}" for k in COMPLIMENT_MODULI) + ", compliment_count")


def rounded(df, *columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


def wide(v):
    """Texts come last: the joins before move documents' numbers."""
    table = rel.wide_table(v.ratings, v.business, v.users, v.tip_marks)
    return rel.with_texts(table, v.tip_texts, "doc_id", ["compliment_count"])


@query("prj_01_triples", uses="train test", sql="""
    SELECT user_id, business_id, rating, 'train' AS part FROM train
    UNION ALL SELECT user_id, business_id, rating, 'test' AS part FROM test""")
def triples(v):
    return (rel.triples(v.train).withColumn("part", F.lit("train"))
            .unionByName(rel.triples(v.test).withColumn("part", F.lit("test"))))


@query("prj_02_id_view", uses="ratings", sql="SELECT user_id, business_id, rating FROM ratings")
def id_view(v):
    return rel.id_view(v.ratings)


@query("prj_03_business_view", uses="detail", sql="""
    SELECT user_id, business_id, longitude, latitude, stars, review_count, is_open, rating FROM detail""")
def business_view(v):
    return rel.business_view(rel.with_business(v.ratings, v.business))


@query("prj_04_full_view", uses="wide", sql=f"SELECT {NUMERIC_WIDE} FROM wide")
def full_view(v):
    return rounded(rel.full_view(wide(v)), "stars", "average_stars")


@query("prj_05_drop", uses="discounted", sql="""
    SELECT user_id, business_id, round(date_dist_rating, 6) AS date_dist_rating FROM discounted""")
def drop(v):
    table = discount.export_columns(discount.discounted_detail(v.ratings, v.business))
    return rounded(table.drop("rating", "dist_rating", "date_rating"), "date_dist_rating")


@query("prj_06_rename", uses="detail", sql="""
    SELECT user_id, round(avg(latitude), 8) AS mean_lat, round(avg(longitude), 8) AS mean_long, max(date) AS last_date
    FROM detail GROUP BY user_id""")
def rename(v):
    # Eight places: means of these coordinates often end in an exact 5 at the seventh.
    return rounded(discount.user_context(rel.with_business(v.ratings, v.business)), "mean_lat", "mean_long", places=8)


@query("prj_07_cast", uses="predictions", sql="""
    SELECT CAST(user_id AS INTEGER) AS user_id, CAST(business_id AS INTEGER) AS business_id,
           round(CAST(prediction AS DOUBLE), 6) AS prediction FROM predictions""")
def cast(v):
    ids = rel.cast_columns(v.predictions.drop("rating"), {"user_id": "int", "business_id": "int",
                                                         "prediction": "double"})
    return rounded(ids, "prediction")


@query("prj_08_numeric", uses="wide", sql=f"SELECT {NUMERIC_WIDE} FROM wide")
def numeric(v):
    return rounded(rel.numeric_columns(wide(v)), "stars", "average_stars")


@query("prj_09_export", uses="discounted", sql="""
    SELECT user_id, business_id, rating, round(date_rating, 6) AS date_rating, round(dist_rating, 6) AS dist_rating,
           round(date_dist_rating, 6) AS date_dist_rating FROM discounted""")
def export(v):
    table = discount.export_columns(discount.discounted_detail(v.ratings, v.business))
    return rounded(table, "date_rating", "dist_rating", "date_dist_rating")


@query("prj_10_fill_zero", uses="wide", sql="""
    SELECT user_id, business_id, coalesce(compliment_count, 0) AS compliment_count,
           round(coalesce(average_stars, 0), 6) AS average_stars, review_count_y FROM wide""")
def fill_zero(v):
    filled = rel.zero_for_null(rel.full_view(wide(v)))
    return rounded(filled.select(*PAIR, "compliment_count", "average_stars", "review_count_y"), "average_stars")


@query("flt_01_relevant", uses="test", sql="SELECT user_id, business_id, rating FROM test WHERE rating >= 3")
def relevant(v):
    return rel.relevant(rel.triples(v.test), 3)


@query("flt_02_prediction_threshold", uses="predictions", sql="""
    SELECT user_id, business_id, round(prediction, 6) AS prediction FROM predictions WHERE prediction >= 3""")
def prediction_threshold(v):
    return rounded(rel.predicted_at_least(v.predictions.drop("rating"), 3), "prediction")


@query("flt_03_active_users", uses="test", sql="""
    SELECT user_id, business_id, rating FROM test
    WHERE user_id IN (SELECT user_id FROM test GROUP BY user_id HAVING count(*) >= 5)""")
def active_users(v):
    return rel.active_users(rel.triples(v.test), 5)


@query("flt_04_ranges", uses="wide", sql="""
    SELECT user_id, business_id, fans, cool, review_count_x FROM wide
    WHERE fans <= 10 AND cool < 50 AND review_count_x < 1000""")
def ranges(v):
    kept = wide(v).filter((F.col("fans") <= 10) & (F.col("cool") < 50) & (F.col("review_count_x") < 1000))
    return kept.select(*PAIR, "fans", "cool", "review_count_x")


@query("flt_05_membership", uses="top10 train", sql="""
    SELECT DISTINCT business_id FROM top10 WHERE business_id IN (SELECT business_id FROM train)""")
def membership(v):
    return rel.found_in(top_n(v.predictions).select(ITEM).distinct(), v.train)


@query("flt_06_nonzero_vectors", uses="item_content", sql="""
    SELECT business_id, len(features) AS dims FROM item_content
    WHERE len(list_filter(features, lambda x: x <> 0)) > 0""")
def nonzero_vectors(v):
    return rel.with_content(v.item_content).select(ITEM, F.size("features").cast("long").alias("dims"))
