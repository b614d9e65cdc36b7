"""Error, classification and precision measures over predictions joined with actual ratings.

Repeated pairs count as often as the join would repeat them, but the join itself never
does: both sides are first reduced to one row per pair (or pair and value) with a weight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft import PAIR, PREDICTION, RATING, USER
from ratecraft.functions.scalar import rating_class
from ratecraft.operators.ranking import rank_by_prediction, top_n
from ratecraft.operators.relational import corpus


def _moments(df: DataFrame, value: str, tag: str) -> DataFrame:
    """Count, mean and sum of squared deviations per pair."""
    return df.groupBy(*PAIR).agg(
        F.count(value).alias(f"n_{tag}"), F.avg(value).alias(f"mean_{tag}"),
        (F.var_pop(value) * F.count(value)).alias(f"dev_{tag}"))


def _weighted(df: DataFrame, value, name: str, weight: str) -> DataFrame:
    return df.groupBy(*PAIR, value.alias(name)).agg(F.count(F.lit(1)).alias(weight))


def squared_error(predictions: DataFrame, actual: DataFrame) -> DataFrame:
    """One row (total, n): the sum of (prediction - rating)^2 over all matching rows, and their number.

    For a pair with n_p predictions and n_a ratings the n_p * n_a differences sum to
    n_p n_a (mean_p - mean_a)^2 + n_a dev_p + n_p dev_a.
    """
    joined = _moments(predictions, PREDICTION, "p").join(_moments(actual, RATING, "a"), PAIR)
    gap = F.col("mean_p") - F.col("mean_a")
    weight = F.col("n_p") * F.col("n_a")
    total = weight * gap * gap + F.col("n_a") * F.col("dev_p") + F.col("n_p") * F.col("dev_a")
    return joined.agg(F.sum(total).alias("total"), F.sum(weight).alias("n"))


def rmse(train: DataFrame, test: DataFrame, predictions: DataFrame) -> DataFrame:
    """Against train and test together; null when no pair matches."""
    return rmse_against(corpus(train, test), predictions)


def rmse_against(actual: DataFrame, predictions: DataFrame) -> DataFrame:
    return squared_error(predictions, actual).select(F.sqrt(F.try_divide("total", "n")).alias("rmse"))


def aligned_errors(df: DataFrame, prediction: str = PREDICTION, rating: str = RATING) -> DataFrame:
    """RMSE and MSE of columns that stand side by side."""
    gap = F.col(prediction) - F.col(rating)
    return df.agg(F.sqrt(F.avg(gap * gap)).alias("rmse"), F.avg(gap * gap).alias("mse"))


def mae(actual: DataFrame, predictions: DataFrame) -> DataFrame:
    joined = _weighted(predictions, F.col(PREDICTION), "p", "n_p").join(
        _weighted(actual, F.col(RATING), "a", "n_a"), PAIR)
    weight = F.col("n_p") * F.col("n_a")
    return joined.agg((F.sum(weight * F.abs(F.col("p") - F.col("a"))) / F.nullif(F.sum(weight), F.lit(0)))
                      .alias("mae"))


def class_scores(actual: DataFrame, predictions: DataFrame) -> DataFrame:
    """(label, precision, recall, fscore, support) per rounded rating; 0 where a ratio has no base."""
    joined = _weighted(predictions, rating_class(F.col(PREDICTION)), "p", "n_p").join(
        _weighted(actual, rating_class(F.col(RATING)), "a", "n_a"), PAIR)
    return _scores(joined.select("p", "a", (F.col("n_p") * F.col("n_a")).alias("n")))


def aligned_class_scores(df: DataFrame, prediction: str = PREDICTION, rating: str = RATING) -> DataFrame:
    return _scores(df.select(rating_class(F.col(prediction)).alias("p"), rating_class(F.col(rating)).alias("a"),
                             F.lit(1).cast("long").alias("n")))


def _scores(cells: DataFrame) -> DataFrame:
    confusion = cells.groupBy("p", "a").agg(F.sum("n").alias("n"))
    none = F.lit(0).cast("long")
    hit = F.when(F.col("p") == F.col("a"), F.col("n")).otherwise(none)
    sides = confusion.select(F.inline(F.array(
        F.struct(F.col("p").alias("label"), F.col("n").alias("predicted"), none.alias("actual"), hit.alias("hits")),
        F.struct(F.col("a").alias("label"), none.alias("predicted"), F.col("n").alias("actual"), none.alias("hits")))))
    sums = sides.groupBy("label").agg(*(F.sum(c).alias(c) for c in ("predicted", "actual", "hits")))
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("hits", "predicted"), zero)
    recall = F.coalesce(F.try_divide("hits", "actual"), zero)
    fscore = F.coalesce(F.try_divide(F.lit(2.0) * F.col("hits"), F.col("predicted") + F.col("actual")), zero)
    return sums.select("label", precision.alias("precision"), recall.alias("recall"), fscore.alias("fscore"),
                       F.col("actual").alias("support"))


SCORES = ("precision", "recall", "fscore")


def macro_scores(per_class: DataFrame) -> DataFrame:
    """Plain means over the classes."""
    return per_class.agg(*(F.avg(c).alias(c) for c in SCORES))


def weighted_scores(per_class: DataFrame) -> DataFrame:
    """Means over the classes, weighted by their support; null without any row."""
    return per_class.agg(*(F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in SCORES))


def micro_scores(per_class: DataFrame) -> DataFrame:
    """From the sums over all classes: every row has one label and one prediction, so all three are the share of hits."""
    share = F.try_divide(F.sum(F.rint(F.col("recall") * F.col("support"))), F.sum("support"))
    return per_class.agg(*(share.alias(c) for c in SCORES))


def precision_at_n(actual: DataFrame, predictions: DataFrame, n: int = 100) -> DataFrame:
    """Hits in the users' top n over n times the users that have ratings."""
    listed = top_n(predictions, n).groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n_p"))
    rated = actual.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n_a"))
    hits = listed.join(rated, PAIR).agg(F.sum(F.col("n_p") * F.col("n_a"))).scalar()
    users = actual.agg(F.count_distinct(USER).alias("users"))
    return users.select(F.try_divide(F.coalesce(hits, F.lit(0)).cast("double"), F.col("users") * n)
                        .alias("precision_at_n"))


def ranks_per_user(predictions: DataFrame, actual: DataFrame) -> DataFrame:
    """(user, first, middle, last): lowest, mean and highest rank of the rated items."""
    ranked = rank_by_prediction(predictions.select(*PAIR, PREDICTION))
    found = ranked.join(actual.select(*PAIR), PAIR)
    return found.groupBy(USER).agg(F.min("rank").alias("first"), F.avg("rank").alias("middle"),
                                   F.max("rank").alias("last"))


def relevant_rank_stats(actual: DataFrame, predictions: DataFrame) -> DataFrame:
    return ranks_per_user(predictions, actual).agg(
        F.avg("first").alias("mean_min_rank"), F.avg("middle").alias("mean_avg_rank"),
        F.avg("last").alias("mean_max_rank"))
