"""Ranked lexical search: exact inner products by sparse ball trees.

A document is the sparse vector of its terms' saturated counts, an item the vector of its terms' weights; the score is
their inner product in whole numbers. One pass over the texts keeps, of each document, its length and the counts
of those terms that some item has: no other term can add to a score. These vectors are stored, and give the
statistics of the collection.

For the search every task cuts its vectors into trees of ``TREE`` documents. A node is a ball: the mean of its documents and
the distance of the farthest. For an item q no document of a ball scores more than q * mean + |q| * radius, rounded
up, nor more than q * most, where most holds each term's largest value in the ball; the smaller of both is the bound. Each item visits the nodes best-first and stops where no bound reaches its k-th score so far; in leaves the scores
are exact. An item's lists of all tasks are merged by rank.

Items are taken in blocks of about ``TERMS`` terms, whose vocabulary is small enough to be sent to every task; the texts are
read once per block.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ratecraft.llm.common import packed, slices, unpacked
from ratecraft.llm.topk import best
from ratecraft.session import forget, stored_copy

K = 10
#: Terms of a block of items, repeats among items included.
TERMS = 250_000
#: Documents of a tree, and of a leaf.
TREE, LEAF = 16_384, 128

#: Bytes of terms stay, A-Z become lower case, all others divide terms; every byte of a non-ASCII character stays.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
#: Stands for a null id, so that it comes last among equal scores.
_NO_ID = (1 << 63) - 1


def terms(text: str) -> list[bytes]:
    """The text's terms in order: maximal runs of ASCII letters and digits and of characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            found = [sorted(set(terms(t))) for t in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.list_(pa.binary()))], ["row", "item_id", "terms"])


_VECTORS = "doc_id long, n long, terms array<int>, counts array<int>"


def _vectors(vocabulary: list[bytes]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(vocabulary)}
        for batch in batches:
            for part in slices(batch):
                lengths, found = [], []
                for text in part.column(1).to_pylist():
                    all_terms = terms(text)
                    lengths.append(len(all_terms))
                    found.append({number[t]: c for t, c in Counter(all_terms).items() if t in number})
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lengths, pa.int64()), pa.array([list(x) for x in found], pa.list_(pa.int32())),
                     pa.array([list(x.values()) for x in found], pa.list_(pa.int32()))], ["doc_id", "n", "terms", "counts"])
    return kernel


class Items:
    """The items of a block: their terms' numbers and weights, one item after the other."""

    def __init__(self, at: np.ndarray, terms: np.ndarray, weights: np.ndarray, vocabulary: int):
        self.at, self.terms, self.weights, self.vocabulary = at, terms, weights, vocabulary
        self.item = np.repeat(np.arange(len(at) - 1), np.diff(at))
        self.norm = np.sqrt(np.bincount(self.item, weights.astype(np.float64) ** 2, minlength=len(at) - 1))

    def __len__(self) -> int:
        return len(self.at) - 1

    def products(self, point: np.ndarray) -> np.ndarray:
        """Inner product of each item with a point that has a number for every term."""
        return np.bincount(self.item, self.weights * point[self.terms], minlength=len(self))


class Tree:
    """A ball tree over documents in rows: terms and values of row i lie from at[i] to at[i + 1]; no row is empty."""

    def __init__(self, ids: np.ndarray, at: np.ndarray, terms: np.ndarray, values: np.ndarray, items: Items, leaf: int = LEAF):
        self.items, self.leaf = items, leaf
        self.children: list[tuple[int, int] | None] = []
        self.leaves: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None] = []
        self.bounds: list[np.ndarray] = []
        self._add(ids, at, terms, values)

    def _add(self, ids: np.ndarray, at: np.ndarray, terms: np.ndarray, values: np.ndarray) -> int:
        me, n = len(self.bounds), len(ids)
        row, x = np.repeat(np.arange(n), np.diff(at)), values.astype(np.float64)
        size = np.bincount(row, x * x, minlength=n)

        def distances(point: np.ndarray, point_size: float) -> np.ndarray:
            return size + point_size - 2.0 * np.bincount(row, x * point[terms], minlength=n)

        mean = np.bincount(terms, x, minlength=self.items.vocabulary) / n
        mean_size = float(mean @ mean)
        around = distances(mean, mean_size)
        # Safe rounding: far more than the sums above can be off, under the root and above the bound.
        radius = math.sqrt(max(0.0, float(around.max())) + 1e-9 * (float(size.max()) + mean_size))
        ball = np.ceil((self.items.products(mean) + self.items.norm * radius) * (1.0 + 1e-9)) + 1.0
        most = np.zeros(self.items.vocabulary)
        np.maximum.at(most, terms, x)
        self.bounds.append(np.minimum(ball, np.ceil(self.items.products(most) * (1.0 + 1e-9))))
        self.children.append(None)
        self.leaves.append(None)
        if n <= self.leaf:
            self.leaves[me] = ids, at, terms, values
            return me
        # Between two far documents, cut in the middle: equal halves, whatever the documents are.
        sides = []
        far = int(around.argmax())
        for _ in range(2):
            point = np.zeros(self.items.vocabulary)
            point[terms[at[far]:at[far + 1]]] = x[at[far]:at[far + 1]]
            sides.append(distances(point, size[far]))
            far = int(sides[-1].argmax())
        order = np.argsort(sides[0] - sides[1], kind="stable")
        self.children[me] = tuple(self._add(*_rows(half, ids, at, terms, values)) for half in (order[:n // 2], order[n // 2:]))
        return me

    def search(self, i: int, top: tuple[np.ndarray, np.ndarray], k: int) -> tuple[tuple[np.ndarray, np.ndarray], int]:
        """The k best (scores, ids) of ``top`` and this tree for item i, and how many documents were scored."""
        terms, weights = (a[self.items.at[i]:self.items.at[i + 1]] for a in (self.items.terms, self.items.weights))
        weight = np.zeros(self.items.vocabulary, dtype=np.int64)
        weight[terms] = weights
        scored = 0
        waiting = [(-self.bounds[0][i], 0)]
        while waiting:
            bound, node = heapq.heappop(waiting)
            least = int(top[0][-1]) if len(top[0]) == k else 1
            if -bound < least:
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(waiting, (max(bound, -self.bounds[child][i]), child))
                continue
            ids, at, columns, values = self.leaves[node]
            score = np.add.reduceat(weight[columns] * values, at[:-1])
            scored += len(ids)
            near = score >= least
            if near.any():
                scores, names = np.concatenate([top[0], score[near]]), np.concatenate([top[1], ids[near]])
                chosen = best(scores, names, k)
                top = scores[chosen], names[chosen]
        return top, scored


def _rows(chosen: np.ndarray, ids: np.ndarray, at: np.ndarray, terms: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, ...]:
    lengths = np.diff(at)[chosen]
    new = np.concatenate([[0], np.cumsum(lengths)])
    where = np.repeat(at[chosen] - new[:-1], lengths) + np.arange(new[-1])
    return ids[chosen], new, terms[where], values[where]


def saturated(counts: np.ndarray, lengths: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    """A term's value in a document: a thousandth of a count of 1,000 at most, less the longer the document is."""
    m = 100 - 90 + (90 * lengths * documents) // all_terms
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


_FOUND = "item long, doc_id long, score long"


def _search(model: bytes, vocabulary: int, documents: int, all_terms: int, k: int, tree: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(**unpacked(model), vocabulary=vocabulary)
        none = np.zeros(0, dtype=np.int64)
        top = [(none, none)] * len(items)

        def grow(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            lengths = table.column("n").to_numpy()
            names = table.column("doc_id").fill_null(_NO_ID).to_numpy()
            lists = [table.column(c).combine_chunks() for c in ("terms", "counts")]
            size = lists[0].value_lengths().to_numpy()
            columns, counts = (a.flatten().to_numpy() for a in lists)
            values = saturated(counts.astype(np.int64), np.repeat(lengths, size), documents, all_terms)
            at = np.concatenate([[0], np.cumsum(size)])
            grown = Tree(names, at, columns, values, items)
            for i in range(len(items)):
                top[i] = grown.search(i, top[i], k)[0]

        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            for part in slices(batch, tree):
                if rows + part.num_rows > tree and held:
                    grow(held)
                    held, rows = [], 0
                held.append(part)
                rows += part.num_rows
        if held:
            grow(held)
        for start in range(0, len(items), 1024):
            lists = top[start:start + 1024]
            ids = np.concatenate([names for _, names in lists])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(start, start + len(lists)), [len(x) for x, _ in lists]), pa.int64()),
                 pa.array(ids, pa.int64(), mask=ids == _NO_ID), pa.array(np.concatenate([x for x, _ in lists]), pa.int64())],
                ["item", "doc_id", "score"])
    return kernel


def _block(docs: DataFrame, held: list[tuple], k: int, tree: int) -> DataFrame:
    """The lists of one block of items (item_id, terms): item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    vocabulary = sorted({t for _, found in held for t in found})
    vectors = stored_copy(docs.mapInArrow(_vectors(vocabulary), _VECTORS).filter("n > 0"), "vectors")
    documents, all_terms = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    # One number for each term of the vocabulary at most.
    holding = dict(vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    number = {t: i for i, t in enumerate(vocabulary)}
    at, columns, weights = [0], [], []
    for _, found in held:
        mine = [(number[t], weight(documents, holding[number[t]])) for t in found if number[t] in holding]
        columns += [t for t, w in mine if w > 0]
        weights += [w for _, w in mine if w > 0]
        at.append(len(columns))
    model = packed(at=np.array(at), terms=np.array(columns, dtype=np.int64), weights=np.array(weights, dtype=np.int64))
    found = vectors.filter(F.size("terms") > 0).mapInArrow(_search(model, max(1, len(vocabulary)), documents, all_terms or 1, k, tree), _FOUND)
    order = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(held)], "item long, item_id long")
    out = stored_copy(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"), "ranked")
    forget(vectors)
    return out


def search(docs: DataFrame, items: DataFrame, k: int = K, terms_per_block: int = TERMS, tree: int = TREE) -> DataFrame:
    """The k best documents of each item with a score above 0: item_id, rank (from 1), doc_id, score.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not read. Higher scores come first, ties by
    doc_id, null last. Null texts have no terms; documents without terms do not count, and items without terms, or
    without a term that some document has, give no row. Every row stands for itself: repeated documents are counted and
    listed as often as they come, and of items that repeat an id each has a list. Empty tables give no row.
    """
    asked = items.filter("text is not null").select(F.monotonically_increasing_id().alias("row"), F.col("item_id").cast("long").alias("item_id"), "text")
    asked = stored_copy(asked.mapInArrow(_items, "row long, item_id long, terms array<binary>").filter(F.size("terms") > 0), "items")
    blocks = max(1, -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // terms_per_block))
    docs = docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = []
    for block in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).orderBy("row")
        held = [(r.item_id, [bytes(t) for t in r.terms]) for r in mine.collect()]
        if held:
            found.append(_block(docs, held, k, tree))
    forget(asked)
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
