"""Ratings laid out once for models that alternate between users and items.

The ratings lie in the order of the ids of the side that has more of them, cut every so many rows into blocks, so a user
or item with very many ratings lies in several blocks. A block is one stored row of arrays, and the table is bucketed by
block. Every id knows the blocks that hold its ratings, so a step of either side sends each state to just these
blocks, works on whole arrays there, and returns sums for each id of a block; sums of an id of several blocks are
added up. Ids of the side with more of them lie in one block, nearly all; the others are sent once for each block, not
once for each rating. Ratings never move after they have been laid out. An id of the side with more of them is only cut where
it has more ratings than a block may hold, so where none has, a block can do a whole turn for its own ids (``turn``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ratecraft import ITEM, USER
from ratecraft.operators.ranking import positions
from ratecraft.session import forget, new_path, stored_copy

#: Ratings of a block, but for the rest of its last id, where there are many; more where the other side has many ids, as each of them
#: may be sent to each block: so many ratings then for each of these ids, so that what is sent follows the ratings; but not over
#: the largest.
BLOCK = 1_048_576
FOR_EACH = 16
LARGEST = 4_194_304
#: Ratings of a block that are worked on at a time.
CHUNK = 32_768
#: Blocks for each core where the input is small, with so many ratings at least.
SPREAD = 2
LEAST = 16_384

#: Sums of a block: from the ratings' values, the places of their own and of their other ids among the block's,
#: where each own id's ratings begin, and the states of both kinds of ids, one row each.
Kernel = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
#: A block's turn: from the ratings' values, the places of their own and of their other ids, which of the own ids are known (not
#: null), and the states of both kinds of ids, the new states of its own ids and sums for the others, one row each.
Turn = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _pack(own: str, far: str) -> Callable[[tuple, pa.Table], pa.Table]:
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by([(own, "ascending"), (far, "ascending")])
        places = []
        for name in (own, far):
            column = rows.column(name).combine_chunks()
            ids = pc.unique(column)
            ids = ids.take(pc.sort_indices(ids))
            places.append((ids, pc.index_in(column, ids).to_numpy(zero_copy_only=False).astype(np.int32)))
        values = rows.column("value").to_numpy().astype(np.float64)
        one = lambda x, t: pa.array([x], t)
        whole = lambda ids: pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        return pa.table({"block": one(key[0].as_py(), pa.int32()), "own": whole(places[0][0]), "far": whole(places[1][0]),
                         "at": one(places[0][1].tobytes(), pa.binary()), "to": one(places[1][1].tobytes(), pa.binary()),
                         "value": one(values.tobytes(), pa.binary())})
    return run


def _states(sent: pa.Table, name: str, ids: pa.Array, width: int) -> np.ndarray:
    """The states that were sent for ``ids``, in their order; one that did not come has zeros. They are copied a batch at a time."""
    out = np.zeros((len(ids), width))
    if width:
        place = pc.index_in(sent.column(name).cast(ids.type), ids, skip_nulls=True).fill_null(-1).to_numpy()
        begin = 0
        for x in sent.column("x").chunks:
            at = place[begin:begin + len(x)]
            begin += len(x)
            mine = at >= 0
            if mine.any():
                out[at[mine]] = x.filter(pa.array(mine)).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return out


def _opened(block: pa.Table) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    own, far = (block.column(c).combine_chunks().flatten() for c in ("own", "far"))
    at, to = (np.frombuffer(block.column(c)[0].as_py(), dtype=np.int32) for c in ("at", "to"))
    return own, far, at, to, np.frombuffer(block.column("value")[0].as_py())


def added_up(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Add ``rows`` to the rows ``at`` of ``out``; ``at`` is in order, and not empty."""
    begins = np.flatnonzero(np.diff(at, prepend=-1))
    out[at[begins]] += np.add.reduceat(rows, begins)


def _in_rows(sizes: list[int], values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(values))


def _gathered(width: int, id_type: pa.DataType) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A block's states of its own ids as one row."""
    def run(block: pa.Table, sent: pa.Table) -> pa.Table:
        rows = []
        if block.num_rows:
            rows = [_states(sent, "own", block.column("own").combine_chunks().flatten(), width).ravel()]
        return pa.table({"block": block.column("block").cast(pa.int32()), "mine": pa.array([True] * len(rows), pa.bool_()), "id": pa.nulls(len(rows), id_type),
                         "x": pa.array(rows, pa.list_(pa.float64()))})
    return run


def _spread(width: int, id_type: pa.DataType) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The states of a block's own ids, a row for each of them."""
    def run(block: pa.Table, mine: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.table({"id": pa.array([], id_type), "x": pa.array([], pa.list_(pa.float64()))})
        own = block.column("own").combine_chunks().flatten()
        return pa.table({"id": own.cast(id_type), "x": _in_rows([width] * len(own), mine.column("x").combine_chunks().flatten())}).filter(own.is_valid())
    return run


def _turned(kernel: Turn, widths: tuple[int, int], id_type: pa.DataType) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(block: pa.Table, sent: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.table({"block": pa.array([], pa.int32()), "mine": pa.array([], pa.bool_()), "id": pa.array([], id_type), "x": pa.array([], pa.list_(pa.float64()))})
        own, far, at, to, value = _opened(block)
        mine = sent.filter(sent.column("mine")).column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(own), widths[0])
        # The block's own states have no id. The new states and the sums leave as they are, not copied into one array.
        new, sums = kernel(value, at, to, own.is_valid().to_numpy(zero_copy_only=False), mine, _states(sent, "id", far, widths[1]))
        number = block.column("block")[0].as_py()
        tables = [pa.table({"block": pa.array(np.full(len(ids), number), pa.int32()), "mine": pa.array(np.full(len(ids), own_row)), "id": ids, "x": _in_rows(sizes, x.ravel())})
                  for own_row, ids, sizes, x in ((True, pa.nulls(1, id_type), [new.size], new), (False, far.cast(id_type), [sums.shape[1]] * len(sums), sums))]
        return pa.concat_tables([tables[0], tables[1].filter(far.is_valid()) if far.null_count else tables[1]])
    return run


def _sums(kernel: Kernel, widths: tuple[int, int], names: list[str], id_type: pa.DataType, turned: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """``turned``: the sums are for the ids that the block is not in the order of."""
    def run(block: pa.Table, sent: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.table({"id": pa.array([], id_type)} | {n: pa.array([], pa.float64()) for n in names})
        own, far, at, to, value = _opened(block)
        if turned:
            order = np.argsort(to, kind="stable")
            own, far, at, to, value = far, own, to[order], at[order], value[order]
        own_states, far_states = _states(sent, "own", own, widths[0]), _states(sent, "far", far, widths[1])
        out = np.zeros((len(own), len(names)))
        for start in range(0, len(at), CHUNK):  # an id cut here has its sums added up
            rows = slice(start, start + CHUNK)
            begins = np.flatnonzero(np.diff(at[rows], prepend=-1))
            out[at[rows][begins]] += kernel(value[rows], at[rows], to[rows], begins, own_states, far_states)
        return pa.table({"id": own.cast(id_type)} | {n: pa.array(np.ascontiguousarray(out[:, j])) for j, n in enumerate(names)})
    return run


class Routes:
    """Ratings (user, item, value) by blocks, and the blocks where each id is wanted."""

    def __init__(self, rows: DataFrame, value: str, block_rows: int | None = None):
        spark = rows.sparkSession
        rows = stored_copy(rows.select(USER, ITEM, F.col(value).cast("double").alias("value")), "rows")
        n, *different = rows.agg(F.count(F.lit(1)), F.approx_count_distinct(USER), F.approx_count_distinct(ITEM)).first()
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        whole = block_rows or max(BLOCK, min(LARGEST, FOR_EACH * min(different)))
        self.size = max(1, min(whole, max(LEAST, -(-n // (SPREAD * spark.sparkContext.defaultParallelism)))))
        self.blocks = max(1, -(-n // self.size))
        #: At least as many buckets as Spark would take, so that it leaves the ratings where they are.
        self.buckets = max(tasks, -(-self.blocks // 8))
        self.types = {k: rows.schema[k].dataType for k in (USER, ITEM)}
        self._names: list[str] = []
        self._spark = spark
        self.lead, self.other = (USER, ITEM) if different[0] >= different[1] else (ITEM, USER)
        self.table = self._laid_out(rows, self.lead, self.other)
        self.ids = {self.lead: self._wanted(rows, self.lead, "own"), self.other: self._wanted(rows, self.other, "far")}
        self.span = rows.agg(F.avg("value"), F.min("value"), F.max("value")).first()
        self.rows = rows

    def _laid_out(self, rows: DataFrame, own: str, far: str) -> DataFrame:
        placed, _ = positions(rows, [F.col(own).asc(), F.col(far).asc()], "_place", spread_equal=True)
        # An id that a block would begin amidst of goes to the block where it begins, unless it has too many ratings for that.
        begun = placed.filter(F.col("_place") % self.size == 0).select(F.col(own).alias("_own")).distinct()
        begun = placed.join(begun, F.col(own) == F.col("_own")).groupBy("_own").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
        begun = stored_copy(begun.filter(F.col("_n") <= self.size), "begun")  # a row for each block at most
        place = F.coalesce("_first", "_place")
        cut = placed.join(begun, F.col(own) == F.col("_own"), "left").select(USER, ITEM, "value", F.floor(place / self.size).cast("int").alias("block"))
        kinds = ", ".join(f"{name} array<{self.types[k].simpleString()}>" for name, k in (("own", own), ("far", far)))
        packed = cut.groupBy("block").applyInArrow(_pack(own, far), f"block int, {kinds}, at binary, to binary, value binary")
        name = f"ratecraft_{own}_{uuid.uuid4().hex[:12]}"
        path = new_path(self._spark, name)
        packed.repartition(self.buckets, "block").write.format("parquet").bucketBy(self.buckets, "block").option("path", path).saveAsTable(name)
        self._names.append(name)
        table = self._spark.table(name)
        table._stored_at = path
        forget(begun)
        return table

    def _wanted(self, rows: DataFrame, key: str, name: str) -> DataFrame:
        """(key, n, own, far): an id's ratings, and the blocks that hold them, whichever side asks."""
        asks = self.table.select("block", F.explode(name).alias(key)).groupBy(key).agg(F.collect_set("block").alias("own"))
        number = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        return stored_copy(number.join(asks, key).withColumn("far", F.col("own")), "ids")

    def step(self, side: str, own: DataFrame, own_state: Sequence[str], far: DataFrame, far_state: Sequence[str], kernel: Kernel,
             sums: Sequence[str]) -> DataFrame:
        """(id, *sums) for the ids of ``side``: what ``kernel`` adds up for each of them over its ratings.

        ``own`` and ``far`` are states of this side and of the other, with the columns of ``ids``; the columns named go to the
        blocks as arrays. Only states and sums are shuffled.
        """
        other = ITEM if side == USER else USER
        blank = lambda k: F.lit(None).cast(self.types[k])
        wide = lambda names: F.array(*(F.col(c).cast("double") for c in names)).cast("array<double>")
        sent = far.select(F.explode("far").alias("block"), blank(side).alias("own"), F.col(other).alias("far"), wide(far_state).alias("x"))
        if own_state:
            sent = sent.unionByName(own.select(F.explode("own").alias("block"), F.col(side).alias("own"), blank(other).alias("far"), wide(own_state).alias("x")))
        schema = f"id {self.types[side].simpleString()}, " + ", ".join(f"{s} double" for s in sums)
        run = _sums(kernel, (len(own_state), len(far_state)), list(sums), to_arrow_type(self.types[side]), side != self.lead)
        parts = self.table.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(run, schema)
        return parts.groupBy(F.col("id").alias(side)).agg(*(F.sum(s).alias(s) for s in sums))

    def undivided(self, side: str) -> bool:
        """Whether each id of ``side`` has all its ratings in one block."""
        return side == self.lead and self.ids[side].filter(F.size("own") > 1).isEmpty()

    def gathered(self, own: DataFrame, state: Sequence[str]) -> DataFrame:
        """(block, mine, id, x), stored: what ``turn`` starts from, the states of each block's own ids."""
        x = F.array(*(F.col(c).cast("double") for c in state)).cast("array<double>").alias("x")
        sent = own.select(F.explode("own").alias("block"), F.col(self.lead).alias("own"), x)
        kind = self.types[self.other]
        parts = self.table.select("block", "own").groupBy("block").cogroup(sent.groupBy("block"))
        return stored_copy(parts.applyInArrow(_gathered(len(state), to_arrow_type(kind)), f"block int, mine boolean, id {kind.simpleString()}, x array<double>"), "mine")

    def turn(self, last: DataFrame, own_width: int, far: DataFrame, far_state: Sequence[str], kernel: Turn) -> DataFrame:
        """(block, mine, id, x), stored: by block the new states of its own ids (``mine``), and sums for its other ones.

        ``last`` is what the turn before or ``gathered`` has returned. States of own ids stay by block, in one row.
        """
        x = F.array(*(F.col(c).cast("double") for c in far_state)).cast("array<double>").alias("x")
        sent = far.select(F.explode("far").alias("block"), F.lit(False).alias("mine"), F.col(self.other).alias("id"), x)
        kind = self.types[self.other]
        parts = self.table.groupBy("block").cogroup(sent.unionByName(last.filter("mine")).groupBy("block"))
        run = _turned(kernel, (own_width, len(far_state)), to_arrow_type(kind))
        return stored_copy(parts.applyInArrow(run, f"block int, mine boolean, id {kind.simpleString()}, x array<double>"), "turn")

    def far_sums(self, turned: DataFrame, sums: Sequence[str]) -> DataFrame:
        """(id, *sums) of a turn, added up over the blocks."""
        return turned.filter("not mine").groupBy(F.col("id").alias(self.other)).agg(*(F.sum(F.get("x", F.lit(j))).alias(s) for j, s in enumerate(sums)))

    def spread(self, turned: DataFrame, state: Sequence[str]) -> DataFrame:
        """(id, *state) of the own ids after a turn."""
        kind = self.types[self.lead]
        parts = self.table.select("block", "own").groupBy("block").cogroup(turned.filter("mine").groupBy("block"))
        rows = parts.applyInArrow(_spread(len(state), to_arrow_type(kind)), f"id {kind.simpleString()}, x array<double>")
        return rows.select(F.col("id").alias(self.lead), *(F.get("x", F.lit(j)).alias(s) for j, s in enumerate(state)))

    def close(self) -> None:
        """Delete what was laid out; frames that still read it end with it."""
        for name in self._names:
            self._spark.sql(f"DROP TABLE IF EXISTS {name}")
        for table in (self.table, *self.ids.values(), self.rows):
            forget(table)
