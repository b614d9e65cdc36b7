"""Section 2.9: sampling, splits, cohorts, folds."""

from pyspark.sql import functions as F

from ratecraft import PAIR
from ratecraft.catalog.columns import rounded
from ratecraft.catalog.oracle_views import VIEWS, bias_scored, bias_views
from ratecraft.catalog.registry import query
from ratecraft.operators import splits
from ratecraft.plans import tuning

_HASH = "md5(concat(CAST(user_id AS VARCHAR), ':', CAST(business_id AS VARCHAR)))"


@query("spl_01_sample", uses="ratings", sql=f"""
    SELECT user_id, business_id, rating FROM ratings WHERE substr({_HASH}, 1, 12) < '199999999999'""")
def sample(v):
    return splits.hash_sample(v.ratings, 0.1).select(*PAIR, "rating")


@query("spl_02_split", uses="ratings", sql=f"""
    SELECT user_id, business_id, rating, substr({_HASH}, 1, 12) >= 'cccccccccccc' AS is_test FROM ratings""")
def split(v):
    train, test = splits.hash_split(v.ratings.select(*PAIR, "rating"))
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


@query("spl_03_leave_latest_out", uses="ratings", sql="""
    SELECT user_id, business_id, rating, rn = 1 AS is_test FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date DESC, business_id DESC) AS rn FROM ratings)""")
def leave_latest_out(v):
    train, test = splits.leave_latest_out(v.ratings)
    both = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return both.drop("date")


@query("spl_04_cohorts", uses="cohort_rows", sql="SELECT * FROM cohort_rows")
def cohorts(v):
    return splits.cohorts(v.train, v.test)


_FOLDS = 3
_FOLD = f"CAST(concat('0x', substr({_HASH}, 1, 4)) AS INTEGER) % {_FOLDS}"
VIEWS["folded"] = ("ratings", f"SELECT user_id, business_id, rating, {_FOLD} AS fold FROM ratings")
for _k in range(_FOLDS):
    VIEWS[f"fold{_k}_train"] = ("folded", f"SELECT * FROM folded WHERE fold <> {_k}")
    VIEWS[f"fold{_k}_test"] = ("folded", f"SELECT * FROM folded WHERE fold = {_k}")
    VIEWS |= bias_views(f"fold{_k}_train", f"fold{_k}")
_PARTS = [f"""SELECT {k} AS fold, round(sqrt(avg(pow(prediction - rating, 2))), 6) AS rmse, count(*) AS n
              FROM ({bias_scored(f"fold{k}_test", f"fold{k}")})""" for k in range(_FOLDS)]


@query("spl_05_cross_validation", " UNION ALL ".join(_PARTS),
       " ".join(f"fold{k}_test fold{k}_mu fold{k}_u fold{k}_i" for k in range(_FOLDS)))
def cross_validation(v):
    return rounded(tuning.cross_validate_bias(v.ratings, _FOLDS), "rmse")
