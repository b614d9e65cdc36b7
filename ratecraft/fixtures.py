"""Review-shaped views over the star-schema test tables.

Each view is a plain DataFrame over the parquet files of one folder. ``ratings`` and
``predictions`` feed most queries, so they are written once per session and read back.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft import ITEM, PAIR, USER
from ratecraft.operators.splits import hash_split_flag
from ratecraft.session import configure
from ratecraft.sources.writers import materialize

#: Prime moduli that give every compliment counter its own pattern.
COMPLIMENT_MODULI = {"hot": 13, "more": 17, "profile": 19, "cute": 23, "list": 29, "note": 31, "plain": 41,
                     "cool": 43, "funny": 47, "writer": 53, "photos": 59}


class Views:
    """The tables of one data folder in the shapes that section 1 of the survey lists."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")
        self.key = self.folder.replace("/", "_").strip("_")
        self._kept: dict[str, object] = {}

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def stored(self, name: str, build) -> DataFrame:
        return materialize(self.spark, f"{self.key}/{name}", build)

    def kept(self, name: str, build):
        """What ``build`` returns, a model on stored tables, made once for these views."""
        if name not in self._kept:
            self._kept[name] = build()
        return self._kept[name]

    @cached_property
    def interactions(self) -> DataFrame:
        lines = self.raw("lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
            F.col("o_custkey").alias(USER), F.col("l_suppkey").alias(ITEM),
            F.ceil(F.col("l_quantity") / 10).cast("double").alias("rating"), F.col("o_orderdate").alias("date"))

    def _latest_ratings(self) -> DataFrame:
        latest = self.interactions.groupBy(*PAIR).agg(F.max(F.struct("date", "rating")).alias("last"))
        return latest.select(*PAIR, "last.rating", "last.date").withColumn("is_test", hash_split_flag())

    @cached_property
    def split_ratings(self) -> DataFrame:
        return self.stored("ratings", self._latest_ratings)

    @cached_property
    def ratings(self) -> DataFrame:
        return self.split_ratings.drop("is_test")

    @cached_property
    def train(self) -> DataFrame:
        return self.split_ratings.filter(~F.col("is_test")).drop("is_test")

    @cached_property
    def test(self) -> DataFrame:
        return self.split_ratings.filter("is_test").drop("is_test")

    @cached_property
    def business(self) -> DataFrame:
        rated = self.interactions.groupBy(ITEM).agg(F.avg("rating").alias("mean_rating"),
                                                    F.count(F.lit(1)).alias("review_count"))
        suppliers = self.raw("supplier").withColumnRenamed("s_suppkey", ITEM)
        places = self.raw("nation").join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        located = suppliers.join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        return located.join(rated, ITEM, "left").selectExpr(
            "s_name AS name", "business_id", "concat('no ', CAST(business_id AS STRING)) AS address",
            "n_name AS city", "r_name AS state",
            "CASE WHEN business_id % 11 = 0 THEN NULL ELSE CAST(n_nationkey AS STRING) END AS postal_code",
            "CAST(25.0 + n_nationkey + (business_id % 10) * 0.05 AS DOUBLE) AS latitude",
            "CAST(-120.0 + 2 * n_nationkey + (business_id % 7) * 0.05 AS DOUBLE) AS longitude",
            "round(mean_rating * 2) / 2 AS stars", "review_count",
            "CASE WHEN business_id % 5 = 0 THEN 0 ELSE 1 END AS is_open")

    @cached_property
    def users(self) -> DataFrame:
        rated = self.interactions.groupBy(USER).agg(
            F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.avg("rating").alias("mean_rating"))
        people = self.raw("customer").select(F.col("c_custkey").alias(USER), "c_name")
        return people.join(rated, USER, "left").selectExpr(
            "c_name AS name", "user_id", "coalesce(n, 0L) AS review_count", "first_date AS yelping_since",
            "user_id % 101 AS useful", "user_id % 67 AS funny", "user_id % 83 AS cool",
            "CASE WHEN user_id % 9 = 0 THEN '2017' ELSE '' END AS elite",
            "user_id % 37 AS fans", "mean_rating AS average_stars",
            *(f"user_id % {m} AS compliment_{kind}" for kind, m in COMPLIMENT_MODULI.items()))

    @cached_property
    def tip_texts(self) -> DataFrame:
        return self.raw("documents").select("doc_id", "text")

    @cached_property
    def tip_marks(self) -> DataFrame:
        """Tips with the number of their document in place of its text."""
        n_docs = self.tip_texts.agg(F.count(F.lit(1))).scalar()
        marked = self.ratings.filter((F.col(USER) + F.col(ITEM)) % 4 == 0)
        return marked.select(ITEM, USER, ((F.col(USER) * 31 + F.col(ITEM)) % n_docs).alias("doc_id"), "date",
                             ((F.col(USER) + F.col(ITEM)) % 3).alias("compliment_count"))

    @cached_property
    def tip(self) -> DataFrame:
        return self.tip_marks.join(self.tip_texts, "doc_id").select(ITEM, USER, "text", "date", "compliment_count")

    @cached_property
    def reviews(self) -> DataFrame:
        """Users and items grow with the documents: one for 10 and for 20 of them, 40 and 25 at least."""
        docs = self.raw("documents")
        sized = docs.withColumn("_n", docs.agg(F.count(F.lit(1))).scalar())
        return sized.selectExpr(
            "doc_id", "doc_id % greatest(40L, _n div 10) AS user_id", "(doc_id * 7 + doc_id % 3) % greatest(25L, _n div 20) AS business_id",
            "CAST(1 + n_chars % 5 AS DOUBLE) AS rating", "text",
            "timestamp_ntz'2015-01-01 00:00:00' + make_dt_interval(CAST(doc_id % 1000 AS INT)) AS date")

    @cached_property
    def photos(self) -> DataFrame:
        pages = self.raw("pages")
        return pages.withColumn("_n", pages.agg(F.count(F.lit(1))).scalar()).selectExpr(
            "url AS caption", "concat('p', CAST(page_id AS STRING)) AS photo_id",
            "page_id % greatest(25L, _n div 10) AS business_id", "CASE page_id % 3 WHEN 0 THEN 'food' WHEN 1 THEN 'inside' "
            "ELSE 'outside' END AS label")

    @cached_property
    def item_content(self) -> DataFrame:
        return self.raw("embeddings").select(F.col("vec_id").alias(ITEM),
                                             F.col("embedding").cast("array<double>").alias("features"))

    @cached_property
    def item_categories(self) -> DataFrame:
        """0/1 category flags; the first category holds every item, so no vector is all zero."""
        flags = [F.lit(1.0)] + [F.when(F.col(ITEM) % p == 0, 1.0).otherwise(0.0) for p in (2, 3, 5, 7)]
        return self.business.select(ITEM, F.array(*flags).alias("features"))

    @cached_property
    def predictions(self) -> DataFrame:
        """Bias baseline fitted on ``train`` and scored on ``test``: the input of every metric query."""
        from ratecraft.models.bias import BiasModel

        def score() -> DataFrame:
            return BiasModel().fit(self.train).predict(self.test).select(*PAIR, "rating", "prediction")
        return self.stored("predictions", score)


_open: dict[tuple[str, str], Views] = {}


def views(spark: SparkSession, folder: str) -> Views:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _open:
        _open[key] = Views(spark, folder)
    configure(spark)
    return _open[key]
