"""Declared layouts of the source files; nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (DataType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

#: The eleven compliment counters of a user record.
COMPLIMENTS = ("hot", "more", "profile", "cute", "list", "note", "plain", "cool", "funny", "writer", "photos")


def _struct(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


def review(key: DataType = StringType(), text: bool = True) -> StructType:
    """Review file; ``stars`` becomes ``rating`` on reading."""
    fields = [("user_id", key), ("business_id", key), ("stars", DoubleType())]
    if text:
        fields.append(("text", StringType()))
    return _struct(*fields, ("date", TimestampNTZType()))


def business(key: DataType = StringType()) -> StructType:
    return _struct(
        ("name", StringType()), ("business_id", key), ("address", StringType()), ("city", StringType()),
        ("state", StringType()), ("postal_code", StringType()), ("latitude", DoubleType()),
        ("longitude", DoubleType()), ("stars", DoubleType()), ("review_count", LongType()),
        ("is_open", IntegerType()))


def user(key: DataType = StringType()) -> StructType:
    return _struct(
        ("name", StringType()), ("user_id", key), ("review_count", LongType()),
        ("yelping_since", TimestampNTZType()), ("useful", LongType()), ("funny", LongType()), ("cool", LongType()),
        ("elite", StringType()), ("fans", LongType()), ("average_stars", DoubleType()),
        *((f"compliment_{kind}", LongType()) for kind in COMPLIMENTS))


def tip(key: DataType = StringType()) -> StructType:
    return _struct(
        ("business_id", key), ("user_id", key), ("text", StringType()), ("date", TimestampNTZType()),
        ("compliment_count", LongType()))


def photo(key: DataType = StringType()) -> StructType:
    return _struct(("caption", StringType()), ("photo_id", StringType()), ("business_id", key),
                   ("label", StringType()))


def rating_csv(key: DataType = LongType()) -> StructType:
    return _struct(("user_id", key), ("business_id", key), ("rating", DoubleType()), ("date", TimestampNTZType()))


def review_csv(key: DataType = LongType()) -> StructType:
    return _struct(("user_id", key), ("business_id", key), ("rating", DoubleType()), ("text", StringType()), ("date", TimestampNTZType()))


def discounted_csv(key: DataType = LongType()) -> StructType:
    return _struct(("user_id", key), ("business_id", key), ("rating", DoubleType()), ("date_rating", DoubleType()),
                   ("dist_rating", DoubleType()), ("date_dist_rating", DoubleType()))


def cohort_csv(key: DataType = LongType()) -> StructType:
    return _struct(("user_id", key), ("business_id", key), ("rating", DoubleType()))
