"""Connected components of a large edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.session import forget, stored_copy


def _loose(edges: DataFrame) -> DataFrame:
    return edges.filter("u <> v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    met = both.join(least, "u").filter("v > u")
    return _loose(met.select(F.col("v").alias("u"), F.least("u", "least").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node, and its neighbours below it, are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("least"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return _loose(moved.unionByName(least.withColumnRenamed("least", "v")))


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node with an edge, u, except the least of its component, and that least node, v.

    ``edges`` has the columns u and v of one orderable type. Alternates the large-star and small-star
    steps, which end in stars after a number of rounds that grows with the logarithm of the nodes. All
    sums are grouped minima that combine before the shuffle; each round is written to the shared folder.
    """
    mark, now = None, stored_copy(_loose(edges.select("u", "v")), "edges")
    while True:
        here = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == tuple(here) or not here[0]:
            return now
        mark = tuple(here)
        last, now = now, stored_copy(_small_star(_large_star(now)), "edges")
        forget(last)
