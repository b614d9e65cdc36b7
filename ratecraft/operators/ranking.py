"""Row numbers over data of any size.

A window keeps all rows of a key in one task, and a window without a key keeps the whole
table there. Here rows get their position from a distributed sort, so that a key may hold
any share of them; the same way serves every size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ratecraft import ITEM, PREDICTION, RATING, USER
from ratecraft.session import stored_copy

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row within it below


def score_order(score: str, item: str = ITEM) -> list[Column]:
    """Best first; equal scores (to six places) by id, so that ranks are reproducible."""
    return [F.round(F.col(score), 6).desc(), F.col(item).asc()]


def positions(df: DataFrame, order: Sequence[Column], name: str = "position",
              spread_equal: bool = False) -> tuple[DataFrame, int]:
    """0-based place of every row in the global order, and the number of rows.

    ``spread_equal`` is for orders that leave many rows equal: those are told apart by a
    row hash, and plain copies by a running number, so that ranges can cut between them.

    Range-partitioned sort; each partition then needs one number, the rows before it.
    The sorted rows are stored first, because a recomputed sort may cut the
    ranges elsewhere; as columns, which take a fraction of a checkpoint's plain rows.
    """
    spark = df.sparkSession
    if spread_equal:
        extra = {"_hash": F.xxhash64(*df.columns), "_copy": F.monotonically_increasing_id()}
        sorted_rows = df.withColumns(extra).orderBy(*order, "_hash", "_copy").drop(*extra)
    else:
        sorted_rows = df.orderBy(*order)
    placed = stored_copy(sorted_rows.withColumn("_seq", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_seq", _ROW_BITS).cast("int")
    counts = sorted(placed.groupBy(part.alias("part")).count().collect())  # one row per partition
    offsets, total = [], 0
    for index, count in counts:
        offsets.append((index, total))
        total += count
    row = F.col("_seq").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    if len(offsets) <= 1:
        return placed.withColumn(name, row).drop("_seq"), total
    table = spark.createDataFrame(offsets, "_part int, _before long")
    located = placed.withColumn("_part", part).join(F.broadcast(table), "_part")
    return located.withColumn(name, F.col("_before") + row).drop("_seq", "_part", "_before"), total


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank",
                size: str | None = None, ties: bool = False) -> DataFrame:
    """1-based rank inside each key; ``size`` adds the number of rows of the key.

    ``ties`` gives equal rows the same, lowest rank; ``order`` is then plain ascending columns.
    Otherwise rows that ``order`` leaves equal follow the hash of their columns. The input is
    evaluated once: it is stored, as a sort into ranges reads its input twice.
    """
    columns = {f"_o{i}": c for i, c in enumerate(order)} if ties else {}
    kept = stored_copy(df.withColumns(columns), "ranked")
    placed, _ = positions(kept, [*(F.col(k).asc() for k in keys), *order], "_pos", spread_equal=True)
    groups = placed.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_size"))
    # A null key is a group like any other.
    same_key = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)))
    out = placed.join(groups, same_key).drop(*(f"_k{i}" for i in range(len(keys))))
    if ties:
        same = placed.groupBy(*keys, *columns).agg(F.min("_pos").alias("_place"))
        out = out.join(same, [*keys, *columns])
    else:
        out = out.withColumn("_place", F.col("_pos"))
    out = out.withColumn(name, F.col("_place") - F.col("_first") + 1)
    if size:
        out = out.withColumn(size, F.col("_size"))
    return out.drop("_pos", "_first", "_size", "_place", *columns)


def item_ranking(ratings: DataFrame) -> tuple[DataFrame, int]:
    """Items by mean rating, best first: (business_id, avg_rating, rank), and the number of items."""
    means = ratings.groupBy(ITEM).agg(F.avg(RATING).alias("avg_rating"))
    placed, n = positions(means, score_order("avg_rating"))
    return placed.select(ITEM, "avg_rating", (F.col("position") + 1).alias("rank")), n


def rank_by_prediction(predictions: DataFrame, size: str | None = None) -> DataFrame:
    return rank_within(predictions, [USER], score_order(PREDICTION), "rank", size)


def top_n(df: DataFrame, n: int = 10, score: str = PREDICTION, keep_rank: bool = False) -> DataFrame:
    """The n best rows of every user.

    Spark cuts each user to n rows before the shuffle (WindowGroupLimit), so a user with
    very many rows sends at most n per map task.
    """
    ranked = df.withColumn("rank", F.row_number().over(W.partitionBy(USER).orderBy(*score_order(score))))
    kept = ranked.filter(F.col("rank") <= n)
    return kept.withColumn("rank", F.col("rank").cast("long")) if keep_rank else kept.drop("rank")


def rank_probability(rank: Column, n: Column) -> Column:
    """1 for the first of n, 0 for the last, 1 for the only one."""
    return F.when(n == 1, F.lit(1.0)).otherwise((n - rank) / F.nullif(n - 1, F.lit(0)))


def encode_ids(df: DataFrame, column: str, code: str = "code") -> DataFrame:
    """(column, code): the distinct ids in sorted order, numbered from 0 without gaps."""
    placed, _ = positions(df.select(column).distinct(), [F.col(column).asc()], code)
    return placed


def with_codes(df: DataFrame, table: DataFrame, column: str, code: str = "code") -> DataFrame:
    """Replace the id by its number."""
    coded = df.join(table.select(column, F.col(code).alias("_code")), column)
    return coded.select(*(F.col("_code").alias(c) if c == column else F.col(c) for c in df.columns))


def latest_per_user(ratings: DataFrame) -> DataFrame:
    """Each user's last rating: a grouped maximum, which combines before the shuffle."""
    latest = F.max(F.struct("date", F.struct(ITEM, RATING).alias("what"))).alias("last")
    out = ratings.groupBy(USER).agg(latest)
    return out.select(USER, F.col("last.what.business_id"), F.col("last.what.rating"), F.col("last.date"))
