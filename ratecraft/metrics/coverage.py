"""How much of the catalogue, the users and the rated pairs a model reaches. Percent, except the share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft import ITEM, PAIR, USER
from ratecraft.operators.relational import corpus, known_items, predicted_at_least


def _distinct(df: DataFrame, column: str):
    return df.agg(F.count_distinct(column)).scalar()


def catalog_coverage(test: DataFrame, train: DataFrame, predictions: DataFrame) -> DataFrame:
    both = corpus(train, test)
    counted = predictions.agg(F.count(F.lit(1)).alias("n"))
    pairs = _distinct(both, USER).cast("double") * _distinct(both, ITEM)
    return counted.select((F.lit(100.0) * F.try_divide(F.col("n").cast("double"), pairs)).alias("catalog_coverage"))


def item_coverage(test: DataFrame, train: DataFrame, content: DataFrame, predictions: DataFrame) -> DataFrame:
    items = known_items(corpus(train, test), content).agg(F.count(F.lit(1))).scalar()
    reached = predictions.agg(F.count_distinct(ITEM).alias("n"))
    return reached.select((F.lit(100.0) * F.try_divide(F.col("n").cast("double"), items)).alias("item_coverage"))


def user_coverage(test: DataFrame, train: DataFrame, predictions: DataFrame) -> DataFrame:
    users = _distinct(corpus(train, test), USER)
    reached = predictions.agg(F.count_distinct(USER).alias("n"))
    return reached.select((F.lit(100.0) * F.try_divide(F.col("n").cast("double"), users)).alias("user_coverage"))


def prediction_coverage(actual: DataFrame, predictions: DataFrame) -> DataFrame:
    """Matching rows of predictions and ratings over the number of ratings."""
    made = predictions.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n_p"))
    rated = actual.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n_a"))
    sums = rated.join(made, PAIR, "left").agg(
        F.sum(F.col("n_a") * F.coalesce("n_p", F.lit(0))).alias("found"), F.sum("n_a").alias("n"))
    return sums.select((F.lit(100.0) * F.try_divide(F.col("found").cast("double"), F.col("n")))
                       .alias("prediction_coverage"))


def catalogue_share(predictions: DataFrame, rate: float, total) -> DataFrame:
    """Distinct items predicted at ``rate`` or more, over ``total`` (a number or a column)."""
    total = F.lit(total) if isinstance(total, (int, float)) else total
    reached = predicted_at_least(predictions, rate).agg(F.count_distinct(ITEM).alias("n"))
    return reached.select(F.try_divide(F.col("n").cast("double"), total).alias("coverage"))


def model_coverage(recommended: DataFrame, train: DataFrame, test: DataFrame) -> DataFrame:
    """Share of the train (test) items that somebody was recommended."""
    listed = recommended.select(ITEM).distinct().withColumn("listed", F.lit(1))

    def share(rows: DataFrame, part: str) -> DataFrame:
        seen = rows.select(ITEM).distinct().join(listed, ITEM, "left")
        return seen.agg(F.lit(part).alias("part"),
                        F.try_divide(F.count("listed"), F.count(F.lit(1))).alias("coverage"))
    return share(train, "train").unionByName(share(test, "test"))


