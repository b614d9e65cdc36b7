"""Projections, filters, joins and groups that carry the meaning of the review data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ratecraft import ITEM, PAIR, PREDICTION, RATING, USER
from ratecraft.functions.scalar import has_content

BUSINESS_INPUTS = ("longitude", "latitude", "stars", "review_count", "is_open")
#: Text, name, place and date columns of the wide table that are no model inputs.
WIDE_NON_INPUTS = ("date", "name_x", "address", "city", "state", "postal_code", "text", "name_y", "elite",
                   "yelping_since")


# Projections

def triples(df: DataFrame) -> DataFrame:
    return df.select(*PAIR, RATING)


def id_view(df: DataFrame) -> DataFrame:
    return df.select(*PAIR, RATING)


def business_view(df: DataFrame) -> DataFrame:
    return df.select(*PAIR, *BUSINESS_INPUTS, RATING)


def full_view(wide: DataFrame) -> DataFrame:
    """All numeric inputs: the wide table without its text, name, place and date columns."""
    return wide.drop(*WIDE_NON_INPUTS)


def numeric_columns(df: DataFrame) -> DataFrame:
    return df.select(*(f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)))


def cast_columns(df: DataFrame, types: dict[str, str], strict: bool = True) -> DataFrame:
    """Cast by name; ``strict=False`` turns values that do not fit into null."""
    return df.withColumns({c: (F.col(c).cast(t) if strict else F.col(c).try_cast(t)) for c, t in types.items()})


def zero_for_null(df: DataFrame) -> DataFrame:
    return df.fillna(0)


# Filters

def relevant(ratings: DataFrame, threshold: float = 1.0) -> DataFrame:
    return ratings.filter(F.col(RATING) >= threshold)


def predicted_at_least(predictions: DataFrame, rate: float) -> DataFrame:
    return predictions.filter(F.col(PREDICTION) >= rate)


def active_users(ratings: DataFrame, minimum: int = 5) -> DataFrame:
    """Ratings of users with at least ``minimum`` of them."""
    busy = ratings.groupBy(USER).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= minimum)
    return ratings.join(busy, USER, "left_semi")


def found_in(df: DataFrame, other: DataFrame, column: str = ITEM) -> DataFrame:
    return df.join(other.select(column).distinct(), column, "left_semi")


def with_content(content: DataFrame) -> DataFrame:
    """Items whose vector is not all zero; cosine measures need a direction."""
    return content.filter(has_content(F.col("features")))


# Joins

def with_business(ratings: DataFrame, business: DataFrame) -> DataFrame:
    return ratings.join(business, ITEM, "left")


def wide_table(ratings: DataFrame, business: DataFrame, users: DataFrame, tips: DataFrame) -> DataFrame:
    """Ratings with business, user and tip columns; equal names get ``_x`` (business) and ``_y`` (user).

    A rating with several tips of the same day appears once per tip.
    """
    shared = [c for c in business.columns if c in users.columns]
    left = business.withColumnsRenamed({c: f"{c}_x" for c in shared})
    right = users.withColumnsRenamed({c: f"{c}_y" for c in shared})
    keys = [ITEM, USER, "date"]
    # The narrow tables first: a row gets wide in the last shuffle only.
    joined = ratings.join(tips, keys, "left").join(left, ITEM, "left").join(right, USER, "left")
    sides = (ratings.columns, left.columns, right.columns, tips.columns)
    return joined.select(*keys, *(c for columns in sides for c in columns if c not in keys))


def with_texts(table: DataFrame, texts: DataFrame, key: str, also: Sequence[str] = ()) -> DataFrame:
    """``table`` with the text of each row's ``key`` in its place; a row without one loses the columns ``also``, too.

    A text is shuffled once, and not once per row. Rows without a key are spread by a hash of their pair.
    """
    spread = F.when(F.col(key).isNull(), F.xxhash64(*PAIR)).otherwise(F.lit(0).cast("long"))
    found = texts.select(key, F.lit(0).cast("long").alias("_spread"), "text", F.lit(True).alias("_found"))
    joined = table.withColumn("_spread", spread).join(found, [key, "_spread"], "left")
    kept = {c: F.when(F.col("_found"), F.col(c)).alias(c) for c in also}
    return joined.select(*(F.col("text") if c == key else kept.get(c, F.col(c)) for c in table.columns))


def scored_pairs(predictions: DataFrame, actual: DataFrame) -> DataFrame:
    """(user, item, prediction, rating) of pairs that have both; repeated pairs multiply."""
    return predictions.select(*PAIR, PREDICTION).join(actual.select(*PAIR, RATING), PAIR)


# Groups

def count_by(df: DataFrame, keys: Sequence[str], counted: str | None = None, name: str = "n") -> DataFrame:
    """Rows per key, or the non-null values of one column."""
    what = F.count(F.lit(1)) if counted is None else F.count(counted)
    return df.groupBy(*keys).agg(what.alias(name))


def top_groups(df: DataFrame, key: str, counted: str, limit: int = 10) -> DataFrame:
    return count_by(df, [key], counted).orderBy(F.col("n").desc(), F.col(key).asc()).limit(limit)


def centroids(detail: DataFrame) -> DataFrame:
    return detail.groupBy(USER).agg(F.avg("latitude").alias("mean_lat"), F.avg("longitude").alias("mean_long"))


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """(bin, low, high, n): equal widths over [min, max], the last bin closed, empty bins included.

    The two edges are scalar subqueries of one row; the counting combines before its shuffle.
    """
    value = F.col(column).cast("double")
    clean = df.select(value.alias("x")).filter(F.col("x").isNotNull())
    edges = clean.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    low, high = edges.select("lo").scalar(), edges.select("hi").scalar()
    # All values equal: the axis is widened by half a unit on both sides.
    start = F.when(high > low, low).otherwise(low - 0.5)
    width = F.when(high > low, (high - low) / F.lit(float(bins))).otherwise(F.lit(1.0 / bins))
    placed = clean.select(F.least(F.floor((F.col("x") - start) / width), F.lit(bins - 1)).cast("int").alias("bin"))
    counted = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    axis = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return axis.join(counted, "bin", "left").select(
        "bin", (start + F.col("bin") * width).alias("low"), (start + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def column_profile(df: DataFrame) -> DataFrame:
    """(column, type, non_null) for every column, from one pass."""
    counts = df.agg(*(F.count(c).alias(c) for c in df.columns))
    lines = F.array(*(F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                               F.col(f.name).alias("non_null")) for f in df.schema.fields))
    return counts.select(F.inline(lines))


def mean_std(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("std"))


def vector_sum(df: DataFrame, column: str = "features") -> DataFrame:
    """(position, total): element-wise sum of the vectors."""
    return (df.select(F.posexplode(column).alias("position", "value"))
            .groupBy("position").agg(F.sum("value").alias("total")))


# Sets

def corpus(train: DataFrame, test: DataFrame) -> DataFrame:
    """Train and test together, duplicates kept."""
    return triples(train).unionByName(triples(test))


def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def known_items(interacted: DataFrame, content: DataFrame) -> DataFrame:
    return interacted.select(ITEM).union(content.select(ITEM)).distinct()




def coordinates(encoded: DataFrame, major: str = "user") -> DataFrame:
    """(row, col, value, mask) of the sparse user-item matrix; ``major="item"`` transposes it.

    Absent pairs stay absent: the rating triples are the coordinate list.
    """
    if major not in ("user", "item"):
        raise ValueError("major must be 'user' or 'item'")
    row, col = (USER, ITEM) if major == "user" else (ITEM, USER)
    return encoded.select(F.col(row).alias("row"), F.col(col).alias("col"), F.col(RATING).alias("value"),
                          F.lit(1).alias("mask"))
