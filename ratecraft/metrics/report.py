"""One row per model from many one-row measures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft import ITEM, PAIR, PREDICTION
from ratecraft.metrics import accuracy, coverage, diversity
from ratecraft.metrics.novelty import item_probability, novelty
from ratecraft.metrics.serendipity import content_serendipity, serendipity
from ratecraft.operators.ranking import top_n
from ratecraft.operators.relational import corpus, with_content

STANDARD = ("avg_overall_novelty", "avg_novelty", "avg_overall_serendipity", "avg_serendipity", "rmse", "coverage")


def side_by_side(measures: list[DataFrame], columns: tuple[str, ...], label: str, name: str = "model") -> DataFrame:
    """Put one-row frames into one row: stacked as (metric, value) and pivoted by a grouped maximum."""
    long = reduce(DataFrame.unionByName, (
        m.select(F.inline(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                                    for c in m.columns)))) for m in measures))
    values = (F.max(F.when(F.col("metric") == c, F.col("value"))).alias(c) for c in columns)
    return long.agg(*values).select(F.lit(label).alias(name), *columns)


def standard_report(train: DataFrame, test: DataFrame, predictions: DataFrame, label: str,
                    rate: float = 1.0, total: int | None = None) -> DataFrame:
    """Novelty and serendipity (two means each), RMSE and catalogue share of one model.

    ``total`` is the size of the catalogue; without it the distinct items of train and test count.
    """
    made = predictions.select(*PAIR, PREDICTION)
    both = corpus(train, test)
    prob = item_probability(both)  # ranked once, from a checkpoint, for both measures
    items = F.lit(total) if total else both.agg(F.count_distinct(ITEM)).scalar()
    measures = [novelty(made, prob), serendipity(test, made, prob), accuracy.rmse(train, test, made),
                coverage.catalogue_share(made, rate, items)]
    return side_by_side(measures, STANDARD, label)


FULL = ("rmse", "mae", "precision_at_n", "cat_diversity", "ils_distance", "catalog_coverage", "item_coverage",
        "user_coverage", "prediction_coverage", "avg_overall_serendipity", "avg_serendipity", "avg_overall_novelty",
        "avg_novelty", "avg_overall_content_serendipity", "avg_content_serendipity", "mean_min_rank", "mean_avg_rank",
        "mean_max_rank")


def full_report(train: DataFrame, test: DataFrame, predictions: DataFrame, content: DataFrame, label: str,
                n: int = 100) -> DataFrame:
    """Every measure of one model, each over the users' n best predictions; test ratings are the profiles."""
    listed = top_n(predictions.select(*PAIR, PREDICTION), n)
    vectors = with_content(content)
    prob = item_probability(corpus(train, test))
    measures = [
        accuracy.rmse_against(test, listed), accuracy.mae(test, listed), accuracy.precision_at_n(test, listed, n),
        diversity.category_diversity(listed, vectors), diversity.intra_list_distance(listed, vectors),
        coverage.catalog_coverage(test, train, listed), coverage.item_coverage(test, train, vectors, listed),
        coverage.user_coverage(test, train, listed), coverage.prediction_coverage(test, listed),
        serendipity(test, listed, prob), novelty(listed, prob), content_serendipity(test, listed, vectors),
        accuracy.relevant_rank_stats(test, listed)]
    return side_by_side(measures, FULL, label)


def cohort_errors(tagged: DataFrame) -> DataFrame:
    """(cohort, mse, number_of_data_points) of predictions that carry a cohort name."""
    gap = F.col(PREDICTION) - F.col("rating")
    return tagged.groupBy("cohort").agg(F.avg(gap * gap).alias("mse"), F.count(F.lit(1)).alias("number_of_data_points"))


def compare_models(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)
