"""Samples, splits, cohorts and folds that repeat on every run and engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft import ITEM, PAIR, RATING, USER
from ratecraft.operators.ranking import latest_per_user, rank_within

#: The cohort test sets, in the order of the report.
COHORTS = ("test_least_items", "test_most_items", "test_mostrecent", "test_nonprolific_users",
           "test_prolific_users")


def pair_digest() -> Column:
    """Hex digest of the (user, item) pair; its prefix is a uniform bucket."""
    return F.md5(F.concat(F.col(USER).cast("string"), F.lit(":"), F.col(ITEM).cast("string")))


def below_share(share: float) -> Column:
    """True for about ``share`` of the pairs: the first 48 bits of the digest, below that part of their range.

    Hex digits of equal number sort as the numbers they stand for. None at 0 or less, all at 1 or more.
    """
    if share >= 1:
        return F.lit(True)
    return F.substring(pair_digest(), 1, 12) < f"{int(max(share, 0.0) * (1 << 48)):012x}"


def hash_split_flag(train_share: float = 0.8) -> Column:
    """True for test rows: about ``1 - train_share`` of the pairs, by digest."""
    return ~below_share(train_share)


def hash_split(ratings: DataFrame, train_share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    flag = hash_split_flag(train_share)
    return ratings.filter(~flag), ratings.filter(flag)


def random_split(ratings: DataFrame, train_share: float = 0.8, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """Spark's own split; repeatable only while the partitioning stays the same."""
    train, test = ratings.randomSplit([train_share, 1 - train_share], seed=seed)
    return train, test


def sample(df: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(ratings: DataFrame, fraction: float) -> DataFrame:
    """Sample without replacement by pair digest."""
    return ratings.filter(below_share(fraction))


def leave_latest_out(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test): test holds each user's latest rating, train all other rows, copies included."""
    newest_first = [F.col("date").desc(), F.col(ITEM).desc(), F.col(RATING).desc()]
    ranked = rank_within(ratings, [USER], newest_first, "_age")
    return ranked.filter("_age > 1").drop("_age"), ranked.filter("_age = 1").drop("_age")


def folds(ratings: DataFrame, k: int, name: str = "fold") -> DataFrame:
    """Fold number 0..k-1 from the pair digest."""
    digest = F.conv(F.substring(pair_digest(), 1, 4), 16, 10).cast("int")
    return ratings.withColumn(name, digest % k)


def cohorts(train: DataFrame, test: DataFrame, low: float = 0.2, high: float = 0.8) -> DataFrame:
    """Test rows tagged with every cohort they fall in.

    Counts come from ``train``; the cuts are the ``low`` and ``high`` quantiles of the
    ratings per item and per user.
    """
    per_item = train.groupBy(ITEM).agg(F.count(F.lit(1)).alias("n_item"))
    per_user = train.groupBy(USER).agg(F.count(F.lit(1)).alias("n_user"))
    item_cut = per_item.agg(F.percentile("n_item", F.array(F.lit(low), F.lit(high))).alias("cut")).scalar()
    user_cut = per_user.agg(F.percentile("n_user", F.array(F.lit(low), F.lit(high))).alias("cut")).scalar()
    recent = latest_per_user(test).select(*PAIR, F.lit(True).alias("is_recent"))
    tagged = (test.select(*PAIR, RATING)
              .join(per_item, ITEM, "left").join(per_user, USER, "left").join(recent, PAIR, "left"))
    names = F.array(
        F.when(F.col("n_item") <= item_cut[0], COHORTS[0]), F.when(F.col("n_item") >= item_cut[1], COHORTS[1]),
        F.when(F.col("is_recent"), COHORTS[2]),
        F.when(F.col("n_user") <= user_cut[0], COHORTS[3]), F.when(F.col("n_user") >= user_cut[1], COHORTS[4]))
    return tagged.select(*PAIR, RATING, F.explode(F.array_compact(names)).alias("cohort"))
