"""Hard negatives by a BOND scan: branch and bound over vertically stored vectors.

Candidates are cut into shards, each stored by columns: an array of all rows for one dimension after another.
Anchors are cut into blocks, and every pair of a block and a shard is a tile. Within a tile each anchor reads
the shard's dimensions in descending order of its own components, a few at a time. What the dimensions not yet
read can add lies between sums of least and greatest contributions, and a bitmap keeps the candidates whose bounds
still allow a place: among the best of the anchor's label in the first pass, inside the score window of one of
its positives in the second. Bounds are whole numbers, so no candidate is lost to rounding.

Each tile sends an anchor's few best rows; lists of all tiles are merged by rank.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ratecraft.llm.topk import best, scaled
from ratecraft.session import forget, stored_copy

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 50, 95
#: Vectors of a shard and of a block of anchors.
SHARD, BLOCK = 32_768, 32_768
#: Dimensions read between two looks at the bounds.
STEP = 8


def _cut(scores: np.ndarray) -> np.ndarray:
    """Whole numbers beyond 64 bits become the nearest one inside; doubles never get that far here."""
    return np.minimum(np.maximum(scores, -(1 << 63)), (1 << 63) - 1) if scores.dtype == object else scores


class Columns:
    """A shard by columns, and the range of each."""

    def __init__(self, values: np.ndarray):
        self.values = values  # dimensions by rows
        self.low, self.high = self.values.min(axis=1, initial=np.inf), self.values.max(axis=1, initial=-np.inf)
        self.largest = np.abs(self.values).max(initial=0)
        self.read = 0  # components read so far

    def fit(self, anchor: np.ndarray) -> tuple[Columns, np.ndarray]:
        """This shard and the anchor in numbers whose products are exact: doubles, or else Python's whole numbers."""
        if np.abs(anchor).max(initial=0) * self.largest * max(1, len(anchor)) < 2.0 ** 53:
            return self, anchor
        whole = object.__new__(Columns)
        for name in ("values", "low", "high"):
            old = getattr(self, name)
            setattr(whole, name, np.array([int(x) for x in old.ravel()], dtype=object).reshape(old.shape))
        whole.largest, whole.read = self.largest, 0
        return whole, np.array([int(x) for x in anchor], dtype=object)

    def scan(self, anchor: np.ndarray, bitmap: np.ndarray, keep: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the candidates of ``bitmap`` that are left when all dimensions are read.

        ``keep`` gets lower and upper bounds of the scores of those left so far, and says which of them stay.
        """
        order = np.argsort(-np.abs(anchor.astype(np.float64)), kind="stable")
        ends = np.stack([anchor * self.low, anchor * self.high])[:, order]
        none = np.zeros(1, dtype=ends.dtype)
        least, most = (np.concatenate([np.cumsum(x[::-1])[::-1], none]) for x in (ends.min(axis=0), ends.max(axis=0)))
        left = np.flatnonzero(bitmap)
        score = np.zeros(len(left), dtype=ends.dtype)
        for at in range(0, len(order), STEP):
            if not len(left):
                break
            dims = order[at:at + STEP]
            part = self.values[dims] if len(left) == self.values.shape[1] else self.values[np.ix_(dims, left)]
            self.read += part.size
            score = score + anchor[dims] @ part
            done = at + len(dims)
            stay = keep(_cut(score + least[done]), _cut(score + most[done]))
            left, score = left[stay], score[stay]
        return left, _cut(score)


def among_best(k: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Candidates that can still be among the k highest scores, ties included."""
    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        if len(lower) <= k:
            return np.ones(len(lower), dtype=bool)
        return upper >= np.sort(lower)[len(lower) - k] if lower.dtype == object else upper >= np.partition(lower, len(lower) - k)[len(lower) - k]
    return keep


def inside_windows(windows: list[tuple[int, int]], k: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Candidates that can still be among the k highest scores inside one of the windows (both ends included)."""
    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(lower), dtype=bool)
        for low, high in windows:
            certain = np.sort(lower[((lower >= low) & (upper <= high)).astype(bool)])
            least = max(low, certain[-k]) if len(certain) >= k else low
            stay |= ((upper >= least) & (lower <= high)).astype(bool)
        return stay
    return keep


def window(positive: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Whole scores s with low * positive <= 100 * s <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


_FOUND = "row long, place int, vec_id long, score long"


_SHARD = "dim int, shard int, ids binary, rows binary, labels binary, columns binary"


def _stand(key: tuple, shard: pa.Table) -> pa.Table:
    """A shard as one row that holds it column by column."""
    columns = np.ascontiguousarray(scaled(shard.column("embedding"), shard.column("scale")[0].as_py()).T)
    held = [shard.column(c).to_numpy().astype(np.int64).tobytes() for c in ("vec_id", "row", "label")]
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()),
                     *(pa.array([x], pa.binary()) for x in (*held, columns.tobytes()))],
                    names=["dim", "shard", "ids", "rows", "labels", "columns"])


def _tile(kind: str, k: int, scale: int, low: int, high: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def search(block: pa.Table, shard: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if block.num_rows and shard.num_rows:
            ids, rows, labels = (np.frombuffer(shard.column(c)[0].as_py(), dtype=np.int64) for c in ("ids", "rows", "labels"))
            columns = Columns(np.frombuffer(shard.column("columns")[0].as_py()).reshape(shard.column("dim")[0].as_py(), len(ids)))
            vectors = scaled(block.column("embedding"), scale)
            positives = block.column("positives").to_pylist() if kind == "negatives" else [None] * len(vectors)
            for row, label, vector, scores in zip(block.column("row").to_pylist(), block.column("label").to_pylist(), vectors, positives):
                exact, anchor = columns.fit(vector)
                if kind == "positives":
                    left, score = exact.scan(anchor, (labels == label) & (rows != row), among_best(k))
                    picked = [(0, best(score, ids[left], k))]
                else:
                    windows = [window(s, low, high) for s in scores]
                    left, score = exact.scan(anchor, labels != label, inside_windows(windows, k))
                    inside = [np.flatnonzero(((score >= a) & (score <= b)).astype(bool)) for a, b in windows]
                    picked = [(i, at[best(score[at], ids[left[at]], k)]) for i, at in enumerate(inside)]
                out += [(row, i, int(ids[left[j]]), int(score[j])) for i, chosen in picked for j in chosen]
        found = zip(*out) if out else [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(found, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                        names=["row", "place", "vec_id", "score"])
    return search


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best of the lists that the tiles sent; each map task sends k rows of a key at most."""
    order = W.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         scale: int = SCALE, shard_rows: int = SHARD, block_rows: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and embedding; other columns are read by the condition ``anchors`` alone. Scores are
    inner products of floor(scale * x); higher ones come first, ties by vec_id. An anchor's positives are its ``positives``
    best other rows of its label; for each of them the ``negatives`` best rows of other labels are returned whose score is
    between ``low`` and ``high`` hundredths of the positive's, both included.

    Rows with a null id, label or vector, or with a null or non-finite component take no part, nor do vectors of another length
    than the anchor's. Every row stands for itself: rows that repeat an id, or all of a row, are each an anchor, a positive and
    a negative. Scores beyond 64 bits are cut to that range before they are compared. Empty tables give no row.
    """
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    sound = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & fine)
    rows = stored_copy(sound.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                                    F.col("label").cast("long").alias("label"), v.alias("embedding"), F.size(v).alias("dim"),
                                    F.coalesce(anchors, F.lit(False)).alias("anchor")), "vectors")
    n, m = rows.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-n // shard_rows), min(tasks, -(-n // 2048)))
    blocks = max(1, -(-m // block_rows))
    part = lambda k: F.pmod(F.xxhash64("row"), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    grid = ["dim", "block", "shard"]
    standing = stored_copy(rows.select("dim", part(shards).alias("shard"), "row", "vec_id", "label", "embedding", F.lit(scale).alias("scale"))
                           .groupBy("dim", "shard").applyInArrow(_stand, _SHARD), "shards")
    candidates = standing.withColumn("block", every(blocks)).groupBy(*grid)

    def tiles(side: DataFrame, kind: str, k: int) -> DataFrame:
        cut = side.withColumn("block", part(blocks)).withColumn("shard", every(shards))
        return cut.groupBy(*grid).cogroup(candidates).applyInArrow(_tile(kind, k, scale, low, high), _FOUND)

    of_anchors = rows.filter("anchor").select("dim", "row", "vec_id", "label", "embedding")
    first = _ranked(tiles(of_anchors, "positives", positives), ["row"], positives)
    # Of an anchor's few positives each has a place, and its score a window.
    lists = stored_copy(first.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("best")), "positives")
    with_lists = of_anchors.join(lists.select("row", F.col("best.score").alias("positives")), "row")
    second = _ranked(tiles(with_lists, "negatives", negatives), ["row", "place"], negatives)
    chosen = lists.select("row", F.posexplode("best").alias("place", "positive")).join(
        rows.filter("anchor").select("row", F.col("vec_id").alias("anchor_id")), "row")
    out = second.join(chosen, ["row", "place"]).select(
        "anchor_id", F.col("positive.vec_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score"))
    result = stored_copy(out, "negatives")
    for table in (rows, standing, lists):
        forget(table)
    return result
