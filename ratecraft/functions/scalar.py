"""Column functions; all of them stay inside generated code or built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400
MONTH_DAYS = 30.0
#: Fixed value: the floor under a probability before its logarithm is taken.
MIN_PROBABILITY = 1e-100


def squared_distance(lat: Column, long: Column, mean_lat: Column, mean_long: Column) -> Column:
    """Squared distance in degrees to a centroid; no root, no earth curvature."""
    return (mean_lat - lat) * (mean_lat - lat) + (mean_long - long) * (mean_long - long)


def seconds(moment: Column) -> Column:
    return F.unix_seconds(moment.cast("timestamp"))


def age_in_months(moment: Column, latest: Column) -> Column:
    """Whole elapsed days before ``latest``, in months of 30 days."""
    days = F.floor((seconds(latest) - seconds(moment)) / F.lit(float(DAY_SECONDS)))
    return days.cast("double") / F.lit(MONTH_DAYS)


def distance_decay(distance: Column) -> Column:
    """1 at the centroid, falling to 1/e."""
    return F.exp(F.lit(1.0) / (F.lit(1.0) + distance)) / F.exp(F.lit(1.0))


def age_decay(months: Column) -> Column:
    """1 for the newest rating, falling to 1/e with the logarithm of the age."""
    return F.exp(F.lit(1.0) / (F.lit(1.0) + F.ln(months + F.lit(1.0)))) / F.exp(F.lit(1.0))


def novelty_of(probability: Column) -> Column:
    """log2 of the rank probability: 0 for the top item, about -332 for the last."""
    return F.log2(F.greatest(probability, F.lit(MIN_PROBABILITY)))


def clamp_at_zero(value: Column) -> Column:
    return F.greatest(value, F.lit(0.0))


def clip(value: Column, low: Column | float, high: Column | float) -> Column:
    return F.least(F.greatest(value, _column(low)), _column(high))


def rating_class(value: Column) -> Column:
    """Nearest whole rating; halves go to the even neighbour."""
    return F.rint(value).cast("int")


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))


def unit(vector: Column) -> Column:
    """The vector scaled to length 1; null for a zero vector.

    Vector and length are bound to a lambda variable first: written into the inner
    function the length would be worked out anew for every element.
    """
    length = F.nullif(norm(vector), F.lit(0.0))
    pair = F.array(F.struct(vector.alias("v"), length.alias("n")))
    scaled = F.transform(pair, lambda p: F.when(p["n"].isNotNull(), F.transform(p["v"], lambda x: x / p["n"])))
    return F.element_at(scaled, 1)


def cosine_distance(left: Column, right: Column) -> Column:
    """1 - cos; null when either vector is zero."""
    lengths = F.nullif(norm(left) * norm(right), F.lit(0.0))
    return F.lit(1.0) - dot(left, right) / lengths


def has_content(vector: Column) -> Column:
    return F.exists(vector, lambda x: x != 0)


def _column(value: Column | float) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))
