"""End-to-end jobs: from rating tables to a report row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft import ITEM, PAIR, PREDICTION, RATING, USER
from ratecraft.metrics import toplist
from ratecraft.metrics.report import cohort_errors, side_by_side, standard_report
from ratecraft.models.als import AlsModel
from ratecraft.models.bias import BiasModel
from ratecraft.models.content import ContentModel, Counts
from ratecraft.models.factor import LogisticModel, SvdppModel
from ratecraft.models.neural import NeuralModel
from ratecraft.operators import ranking, relational as rel
from ratecraft.operators.splits import cohorts, hash_split
from ratecraft.plans.discount import discounted_detail, export_columns
from ratecraft.session import stored_copy


@dataclass
class Outcome:
    """What every job hands to the metrics: train and test triples, and predictions."""

    train: DataFrame
    test: DataFrame
    predictions: DataFrame

    def report(self, label: str) -> DataFrame:
        return standard_report(self.train, self.test, self.predictions, label)


def encoded(ratings: DataFrame) -> DataFrame:
    """Both ids replaced by numbers without gaps."""
    coded = ranking.with_codes(ratings, ranking.encode_ids(ratings, USER), USER)
    return ranking.with_codes(coded, ranking.encode_ids(ratings, ITEM), ITEM)


def discounted_ratings(ratings: DataFrame, business: DataFrame) -> DataFrame:
    return export_columns(discounted_detail(ratings, business))


def bias_job(train: DataFrame, test: DataFrame, model: BiasModel | None = None) -> Outcome:
    scored = (model or BiasModel()).fit(train).predict(rel.triples(test))
    return Outcome(rel.triples(train), rel.triples(test), scored.select(*PAIR, PREDICTION))


def als_job(ratings: DataFrame, model: AlsModel | None = None) -> Outcome:
    train, test = hash_split(stored_copy(encoded(rel.triples(ratings))))
    scored = (model or AlsModel()).fit(train).predict(test)
    return Outcome(train, test, scored.select(*PAIR, PREDICTION))


def content_job(reviews: DataFrame, model: ContentModel | None = None, counts: Counts | None = None) -> Outcome:
    """Vectors come from all reviews, predictions cover train and test alike."""
    fitted = (model or ContentModel()).fit(reviews, counts)
    scored = stored_copy(fitted.predict(rel.triples(reviews)).select(*PAIR, PREDICTION))
    fitted.close()
    return Outcome(*hash_split(rel.triples(reviews)), scored)


def discounted_job(ratings: DataFrame, business: DataFrame, model: SvdppModel | None = None) -> Outcome:
    """SVD++ on the rating discounted by age and distance."""
    table = discounted_ratings(ratings, business).select(*PAIR, F.col("date_dist_rating").alias(RATING))
    train, test = hash_split(stored_copy(table))
    scored = (model or SvdppModel()).fit(train).predict(test)
    return Outcome(train, test, scored.select(*PAIR, PREDICTION))


def neural_job(table: DataFrame, model: NeuralModel | None = None) -> Outcome:
    """``table`` is one of the feature views: ids, + business, or + user columns; ids of any type."""
    train, test = hash_split(stored_copy(encoded(table)))
    scored = (model or NeuralModel()).fit(train).predict(test)
    return Outcome(rel.triples(train), rel.triples(test), scored.select(*PAIR, PREDICTION))


def neural_cohorts(train: DataFrame, test: DataFrame, model: NeuralModel | None = None) -> DataFrame:
    """Squared error per cohort of a network on ids alone; one numbering of the ids for train and cohorts."""
    tagged = cohorts(train, test)
    part = rel.id_view(train).withColumn("cohort", F.lit(None).cast("string"))
    both = stored_copy(encoded(part.unionByName(tagged.select(*part.columns))))
    fitted = (model or NeuralModel(epochs=3)).fit(both.filter("cohort is null").drop("cohort"))
    return cohort_errors(fitted.predict(both.filter("cohort is not null")))


def rated_pairs(train: DataFrame, test: DataFrame) -> DataFrame:
    """The distinct pairs of both, laid out once for all models that are measured on them; mark 1 for train, 2 for test, 3 for both."""
    marked = train.select(*PAIR, F.lit(1).alias("mark")).unionByName(test.select(*PAIR, F.lit(2).alias("mark")))
    return toplist.parted(marked.groupBy(*PAIR).agg(F.bit_or("mark").alias("mark")))


def interaction_scores(fitted, pairs: DataFrame, k: int) -> DataFrame:
    """One row: mean and deviation of the users' AUC and mean precision, on train and on test.

    ``pairs`` are ``rated_pairs``. Users are scored once for both; on test, training items are left out.
    """
    places, n_items = toplist.pair_places(fitted.users, fitted.items, pairs, fitted.k)
    scores = stored_copy(toplist.user_measures(places, n_items, k, {"train": (1, 1), "test": (0, 2)}), "measures")
    measures, columns = [], []
    for part in ("train", "test"):
        columns += [f"{part}_auc_mean", f"{part}_auc_std", f"{part}_precision"]
        measures.append(scores.filter(F.col("part") == part).agg(*(f.alias(c) for f, c in zip(
            (F.avg("auc"), F.stddev_pop("auc"), F.avg("precision")), columns[-3:]))))
    out = side_by_side(measures, tuple(columns), "").drop("model")
    return out.withColumn("prec_at_k", F.lit(k))


def interaction_job(ratings: DataFrame, model: LogisticModel | None = None, k: int = 100) -> DataFrame:
    train, test = hash_split(stored_copy(encoded(rel.triples(ratings))))
    return interaction_scores((model or LogisticModel()).fit(train), rated_pairs(train, test), k)
