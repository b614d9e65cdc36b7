"""SimHash fingerprints and exact links between them by tiled comparison.

Fingerprints are cut into four quarters of 16 bits. The population counts of the quarters name a tile
(17^4 tiles at most), and two fingerprints that differ in r bits have tiles whose counts differ by r
in sum at most; all other tile pairs are skipped. What remains is compared exactly: exclusive-or and bit
count over blocks of numpy arrays. Large tiles are cut into chunks, so that a task never holds more than
``RESIDENTS`` and ``GUESTS`` fingerprints at a time.

Only spanning trees of the links leave a task, so a group of n near copies yields edges in proportion to n.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ratecraft.llm.common import slices, text_of
from ratecraft.llm.graph import components
from ratecraft.session import stored_copy

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Fingerprints of a tile's own, and of it and its neighbours, that one comparison holds.
RESIDENTS, GUESTS = 8192, 65536
#: Rows of a comparison matrix at a time.
BLOCK = 128


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text; 0 if it has no word.

    ASCII letters are folded; words are divided by ASCII white space; every shingle counts as often as
    it comes; a text of fewer words is one shingle. A bit is set if over half of the hashes set it.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    at = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum([len(w) + 1 for w in words], out=at[1:])
    width = min(shingle, len(words))
    starts, ends = at[:len(words) - width + 1].tolist(), (at[width:] - 1).tolist()
    hashed, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for i in range(0, len(starts), 1 << 16):
        part = zip(starts[i:i + (1 << 16)], ends[i:i + (1 << 16)])
        values = np.array([hashed(joined[a:b], SEED) for a, b in part], dtype="<u8")
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    set_bits = np.packbits(2 * counts > len(starts), bitorder="little")
    return int.from_bytes(set_bits.tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number. Null text counts as empty."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = np.array([fingerprint(t, shingle) for t in text_of(part.column(1))], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(kernel, "doc_id long, fp long")


def _with_fingerprint(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(text, row) to (row, fp)."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = np.array([fingerprint(t, shingle) for t in text_of(part.column(0))], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(found.view(np.int64))], ["row", "fp"])
    return kernel


def quarter_counts(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps.view("<u2").reshape(-1, 4)).astype(np.int64)


def tile_of(counts: np.ndarray) -> np.ndarray:
    return counts @ np.array([1, 17, 289, 4913])


def steps(radius: int) -> np.ndarray:
    """Moves from a tile to those that can hold partners: half of all moves, so that a pair of tiles meets once."""
    near = range(-radius, radius + 1)
    moves = [m for m in itertools.product(near, repeat=4) if sum(map(abs, m)) <= radius and m >= (0, 0, 0, 0)]
    return np.array(moves)


def _deal(radius: int, sizes: dict[int, tuple[int, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Send each fingerprint to its own tile as resident, and there and to the tiles around as guest.

    ``sizes`` has each tile's numbers of chunks of residents and of guests; a resident goes to all chunks
    of guests and a guest to all chunks of residents. Arrays, not single numbers, travel.
    """
    moves = steps(radius)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = np.zeros((17 ** 4, 2), dtype=np.int64)
        for tile, size in sizes.items():
            chunks[tile] = size
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            counts = quarter_counts(fps)
            mix = (fps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
            keys: list[np.ndarray] = []
            roles: list[np.ndarray] = []
            values: list[np.ndarray] = []

            def send(tile, who, role):
                own = chunks[tile]
                mine, other = own[:, role], own[:, 1 - role]
                at = (mix[who] % mine.astype(np.uint64)).astype(np.int64)
                each = np.repeat(np.arange(len(who)), other)
                across = np.arange(len(each)) - np.repeat(np.cumsum(other) - other, other)
                pair = (at[each], across) if role == 0 else (across, at[each])
                keys.append((tile[each] << 44) | (pair[0] << 22) | pair[1])
                roles.append(np.full(len(each), role, dtype=np.int8))
                values.append(fps[who[each]])

            everyone = np.arange(len(fps))
            send(tile_of(counts), everyone, 0)
            for move in moves:
                to = counts + move
                tile = tile_of(to)
                inside = ((to >= 0) & (to <= 16)).all(axis=1)
                inside[inside] = chunks[tile[inside], 0] > 0
                if inside.any():
                    send(tile[inside], everyone[inside], 1)
            key, role, value = np.concatenate(keys), np.concatenate(roles), np.concatenate(values)
            order = np.lexsort((role, key))
            key, role, value = key[order], role[order], value[order]
            cuts = np.flatnonzero(np.diff(key, prepend=-1) | np.diff(role, prepend=-1))
            parts = np.split(value, cuts[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[cuts]), pa.array(role[cuts]), pa.array([p.tobytes() for p in parts], pa.binary())],
                ["key", "role", "fps"])
    return kernel


def trees(residents: np.ndarray, guests: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for every fingerprint that links to another one here: stars that connect all linked ones."""
    nodes, inverse = np.unique(np.concatenate([residents, guests]), return_inverse=True)
    mine, other = inverse[:len(residents)], inverse[len(residents):]
    label = np.arange(len(nodes))
    for start in range(0, len(residents), BLOCK):
        rows = residents[start:start + BLOCK]
        i, j = np.nonzero(np.bitwise_count(rows[:, None] ^ guests[None, :]) <= radius)
        u, v = mine[start + i], other[j]
        apart = u != v
        u, v = u[apart], v[apart]
        while len(u):
            a, b = label[u], label[v]
            apart = a != b
            if not apart.any():
                break
            u, v, a, b = u[apart], v[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                higher = label[label]
                if (higher == label).all():
                    break
                label = higher
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _compare(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows come sorted by key: gather one key's arrays at a time and link them."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, ([], [])

        def linked() -> pa.RecordBatch:
            if held[0] and held[1]:
                both = [np.frombuffer(b"".join(x), dtype=np.uint64) for x in held]
                nodes, roots = trees(*both, radius)
            else:
                nodes = roots = np.zeros(0, dtype=np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), pa.array(roots.view(np.int64))], ["u", "v"])

        for batch in batches:
            for k, role, fps in zip(*(batch.column(n).to_pylist() for n in ("key", "role", "fps")), strict=True):
                if k != key:
                    if (out := linked()).num_rows:
                        yield out
                    key, held = k, ([], [])
                held[role].append(fps)
        yield linked()
    return kernel


def links(distinct: DataFrame, radius: int = RADIUS, residents: int = RESIDENTS, guests: int = GUESTS) -> DataFrame:
    """(u, v): trees that connect all fingerprints of ``distinct`` (fp) within ``radius`` bits of each other.

    The driver gets one count per tile: 83,521 at most, whatever the size of the input.
    """
    quarter = [F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(4)]
    tile = quarter[0] + 17 * quarter[1] + 289 * quarter[2] + 4913 * quarter[3]
    counts = {int(t): int(n) for t, n in distinct.groupBy(tile.alias("tile")).count().collect()}
    moves = steps(radius)
    sizes = {}
    for t, n in counts.items():
        own = np.array([t % 17, t // 17 % 17, t // 289 % 17, t // 4913])
        around = own - moves
        near = around[((around >= 0) & (around <= 16)).all(axis=1)]
        total = sum(counts.get(int(x), 0) for x in tile_of(near))
        sizes[t] = (-(-n // residents), -(-total // guests))
    spark = distinct.sparkSession
    dealt = distinct.select("fp").mapInArrow(_deal(radius, sizes), "key long, role byte, fps binary")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartition(tasks, "key").sortWithinPartitions("key")
            .mapInArrow(_compare(radius), "u long, v long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fp, root (the component's fingerprint) and component_id, its smallest doc_id.

    ``docs`` has doc_id and text; other columns are not read. Documents without words (null, empty) have
    the fingerprint 0, which links like any other. Rows repeated stay repeated; a null doc_id stays null and
    never names a component unless all of its documents have none. An empty table gives no row.
    """
    prints = stored_copy(fingerprints(docs, shingle), "prints")
    distinct = stored_copy(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    root = components(links(distinct, radius)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    placed = distinct.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = placed.select("fp", "root").join(named, "root")
    return prints.join(classes, "fp").select("doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents without near copies of others: of each component the one with the smallest doc_id stays.

    Of rows that share this id one stays. Columns are those of ``docs``, whatever they are called. Null texts count as empty,
    and empty texts are copies of each other; a null doc_id stays only where no document of the component has an id.
    An empty table gives no row.
    """
    found = near_duplicates(docs, shingle, radius)
    kept = found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    # Rows travel as one value, so no name of theirs can clash. Texts are shuffled once, and rows of one id then lie together.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    named = rows.select("doc_id", "row").join(kept, "doc_id").dropDuplicates(["doc_id"]).select("row")
    # Components of documents without an id are told apart by their fingerprints, taken anew.
    roots = found.filter("doc_id is null and component_id is null").groupBy("fp").agg(F.first("root").alias("root"))
    without_id = rows.filter("doc_id is null").select("text", "row")
    printed = without_id.mapInArrow(_with_fingerprint(shingle), StructType([without_id.schema["row"], StructField("fp", LongType())]))
    nameless = printed.join(roots, "fp").dropDuplicates(["root"]).select("row")
    return named.unionByName(nameless).select("row.*")
