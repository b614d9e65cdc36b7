"""Benchmark decontamination by the pigeonhole principle.

Texts are folded: lower case, and everything but letters and digits is one space. A test item is split into
passages of ``PASSAGE`` characters, one every ``STRIDE`` at least, so that every verbatim fragment of
``PASSAGE + STRIDE`` characters holds a whole one; a passage of n characters may differ by
``n // PER_ERROR`` edits. Cut into that number plus one pieces, one piece at least is unharmed wherever
the passage occurs within its budget. One pass over a document (Aho-Corasick) finds all pieces, and
the text around each is compared with the passage by Myers' bit-parallel edit distance: first the piece and
its neighbour, for many hits at once in 64-bit arrays, then the whole passage where they were near enough.
The neighbours are fixed groups of two or three pieces; as there are more pieces than edits, some group has fewer
edits than pieces, so it holds an unharmed piece and is within that smaller budget of the text around.
The arrays hold ``SLOTS`` letters per part whatever the script; letters that share a slot count as equal
there, which can only let a hit through to the exact comparison.

Test items are taken in blocks of ``BLOCK`` passages; a block's pieces have a bounded size, so each block
is sent to all tasks, which read the documents once per block.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import slices, text_of

PASSAGE = 50
STRIDE = 15
#: One edit is allowed for so many characters.
PER_ERROR = 10
#: Shorter items say too little to be looked for in pieces; they must occur as they are, as whole words.
LEAST = 40
BLOCK = 30_000

#: Characters of a group that the first comparison looks at, at most, and hits that it takes at once.
WORD = 64
HITS = 8192
#: Letters that the first comparison tells apart.
SLOTS = 127

_fold = re.compile(r"[\W_]+").sub
_ascii = bytes(c if chr(c).isalnum() and c < 128 else 32 for c in range(256))


def folded(text: str) -> str:
    text = text.lower()
    if text.isascii():  # the same, faster
        return b" ".join(text.encode().translate(_ascii).split()).decode()
    return _fold(" ", text).strip()


def passages(item: str, size: int = PASSAGE, stride: int = STRIDE) -> list[str]:
    """Overlapping passages of equal length that cover the folded item, ``stride`` apart at most."""
    if len(item) <= size:
        return [item] if item else []
    n = -(-(len(item) - size) // stride) + 1
    return [item[a:a + size] for a in (i * (len(item) - size) // (n - 1) for i in range(n))]


def budget(passage: str, per_error: int = PER_ERROR) -> int:
    return len(passage) // per_error if len(passage) >= LEAST else 0


def pieces(passage: str, errors: int) -> list[tuple[int, str]]:
    """(start, piece): errors + 1 pieces of nearly equal length."""
    at = [i * len(passage) // (errors + 1) for i in range(errors + 2)]
    return [(a, passage[a:b]) for a, b in zip(at, at[1:])]


def groups(n: int) -> list[tuple[int, int]]:
    """For each of n pieces the (first, last) of its group: two neighbours, three at an odd end."""
    pairs = max(1, n // 2)
    return [(2 * g, n - 1 if g == pairs - 1 else 2 * g + 1) for g in (min(k // 2, pairs - 1) for k in range(n))]


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def nearest(pattern: str, where: dict[str, int], text: str) -> tuple[int, int]:
    """(distance, end): least edit distance of the pattern to any part of the text, and where that part ends."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for i, c in enumerate(text):
        eq = where.get(c, 0)
        cross = eq | minus
        zero = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(zero | plus))
        down = plus & zero
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full
        down = down << 1 & full
        plus = down | (full & ~(cross | up))
        minus = up & cross
        if score < best:
            best, end = score, i + 1
    return best, end


def distances(eq: np.ndarray, rows: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Least edit distance of pattern ``rows[i]`` to any part of text ``codes[i]``, for all i side by side.

    ``eq[pattern, code]`` has a bit for each place of the pattern that holds the character; ``sizes`` are the
    patterns' lengths, 64 at most.
    """
    top = np.uint64(1) << (sizes - 1).astype(np.uint64)
    plus, minus = np.full(len(rows), ~np.uint64(0)), np.zeros(len(rows), dtype=np.uint64)
    score = sizes.astype(np.int64)
    best = score.copy()
    one = np.uint64(1)
    for j in range(codes.shape[1]):
        e = eq[rows, codes[:, j]]
        zero = (((e & plus) + plus) ^ plus) | e | minus
        up, down = minus | ~(zero | plus), plus & zero
        score += ((up & top) != 0).astype(np.int64) - ((down & top) != 0)
        np.minimum(best, score, out=best)
        up, down = up << one, down << one
        plus, minus = down | ~(zero | up), up & zero
    return best


class Finder:
    """All passages of one block of items."""

    def __init__(self, rows: list[tuple[int, str]]):
        import ahocorasick

        self.rows = [(item, text, budget(text)) for item, text in rows]
        self.automaton = ahocorasick.Automaton()
        found: dict[str, list[tuple[int, int, int]]] = {}  # piece -> (passage, start, part) of its uses
        parts: list[tuple[int, str, int]] = []  # start, characters, budget
        numbers: dict[tuple[int, int], int] = {}
        for n, (_, text, errors) in enumerate(self.rows):
            cut = pieces(text if errors else f" {text} ", errors)
            for (start, piece), (one, other) in zip(cut, groups(len(cut)), strict=True):
                # The group, or the characters around the piece; an item that must occur as it is has only itself.
                begin, end = cut[one][0], min(cut[other][0] + len(cut[other][1]), len(text))
                left = min(max(begin, start - (WORD - len(piece)) // 2), max(begin, end - WORD))
                part = numbers.setdefault((n, left), len(parts))
                if part == len(parts):
                    parts.append((left, text[left:min(end, left + WORD)], other - one))
                found.setdefault(piece, []).append((n, start, part))
        for k, piece in enumerate(found):
            self.automaton.add_word(piece, k)
        self.width = np.array([len(piece) for piece in found], dtype=np.int64)
        self.uses = np.array([use for uses in found.values() for use in uses], dtype=np.int64).reshape(-1, 3)
        self.begins = np.cumsum([0] + [len(uses) for uses in found.values()])
        if found:
            self.automaton.make_automaton()
        self.empty = not found
        letters = sorted({c for _, part, _ in parts for c in part})
        slot = {c: 1 + i % SLOTS for i, c in enumerate(letters)}
        self.code = np.zeros(0x110000, dtype=np.uint8)
        self.code[[ord(c) for c in letters]] = list(slot.values())
        self.eq = np.zeros((len(parts), min(len(letters), SLOTS) + 1), dtype=np.uint64)
        for i, (_, part, _) in enumerate(parts):
            for c, bits in masks(part).items():
                self.eq[i, slot[c]] |= np.uint64(bits)
        self.left = np.array([left for left, _, _ in parts], dtype=np.int64)
        self.size = np.array([len(part) for _, part, _ in parts], dtype=np.int64)
        self.slack = np.array([slack for _, _, slack in parts], dtype=np.int64)

    def find(self, text: str) -> dict[int, tuple[int, int, int]]:
        return self.find_all([text])[0]

    def find_all(self, texts: list[str]) -> list[dict[int, tuple[int, int, int]]]:
        """Per text: item -> (distance, start, end) of its best passage; start and end in the folded text."""
        out: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        if self.empty:
            return out
        texts = [f" {folded(t)} " for t in texts]
        codes = self.code[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        ends = np.cumsum([len(t) for t in texts])
        for places in self._places(texts):
            for d, n, at in self._near(places, codes, ends):
                item, passage, errors = self.rows[n]
                low = max(0, at - errors)
                distance, end = nearest(passage, masks(passage), texts[d][low:at + len(passage) + errors + (2 if not errors else 0)])
                if distance <= errors:
                    hit = (distance, max(0, low + end - len(passage) - 1), low + end - 1)
                    out[d][item] = min(out[d].get(item, hit), hit)
        return out

    def _places(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Where pieces say that a passage may be: rows of (text, passage, place of its start, part)."""
        held: list[np.ndarray] = []
        size = 0
        for d, text in enumerate(texts):
            found = np.array(list(self.automaton.iter(text)), dtype=np.int64).reshape(-1, 2)
            held.append(np.column_stack([np.full(len(found), d), found]))
            size += len(found)
            if size >= HITS or d + 1 == len(texts):
                hits = np.concatenate(held)
                held, size = [], 0
                for i in range(0, len(hits), HITS):
                    yield self._uses(*hits[i:i + HITS].T)

    def _uses(self, d: np.ndarray, last: np.ndarray, piece: np.ndarray) -> np.ndarray:
        n = self.begins[piece + 1] - self.begins[piece]
        row = np.repeat(np.arange(len(piece)), n)
        passage, start, part = self.uses[np.arange(len(row)) + np.repeat(self.begins[piece] - (np.cumsum(n) - n), n)].T
        at = last[row] + 1 - self.width[piece[row]] - start
        order = np.lexsort((part, at, passage, d[row]))
        out = np.column_stack([d[row], passage, at, part])[order]
        return out[np.r_[True, (np.diff(out, axis=0) != 0).any(axis=1)]] if len(out) else out

    def _near(self, places: np.ndarray, codes: np.ndarray, ends: np.ndarray) -> Iterator[list[int]]:
        """(text, passage, place) where the group around the piece is within its budget of the text."""
        for i in range(0, len(places), HITS):
            d, _, at, part = places[i:i + HITS].T
            slack = self.slack[part]
            begin = np.concatenate([[0], ends[:-1]])[d]
            first = begin + at + self.left[part] - slack
            length = self.size[part] + 2 * slack + 2
            place = first + np.arange(int(length.max()))[:, None]
            inside = (place >= begin) & (place < ends[d])
            around = np.where(inside, codes[np.clip(place, 0, len(codes) - 1)], 0)
            best = distances(self.eq, part, self.size[part], around.T)
            yield from places[i:i + HITS][best <= slack][:, :3].tolist()


SCHEMA = "doc_id long, item_id long, distance long, start long, end long"


def _find(rows: list[tuple[int, str]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(rows)
        for batch in batches:
            for part in slices(batch):
                out: list[tuple] = []
                for doc_id, found in zip(part.column(0).to_pylist(), finder.find_all(text_of(part.column(1))), strict=True):
                    out += [(doc_id, item, *hit) for item, hit in sorted(found.items())]
                columns = zip(*out) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                                 [x.split()[0] for x in SCHEMA.split(", ")])
    return kernel


def blocks(benchmark: DataFrame, block: int = BLOCK) -> Iterator[list[tuple[int, str]]]:
    """The passages of all items, in blocks: one block at a time comes to the driver."""
    items = benchmark.filter("text is not null and item_id is not null").select(F.col("item_id").cast("long"), "text")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = [(i, p) for i, t in zip(part.column(0).to_pylist(), text_of(part.column(1)), strict=True)
                       for p in passages(folded(t))]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())],
                                                 ["item_id", "passage"])

    held: list[tuple[int, str]] = []
    rows = items.mapInArrow(kernel, "item_id long, passage string").distinct().orderBy("item_id", "passage")
    for row in rows.toLocalIterator():
        held.append((row.item_id, row.passage))
        if len(held) == block:
            yield held
            held = []
    if held:
        yield held


def contaminated(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document and test item found in it: doc_id, item_id, distance, start, end.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are not read. distance is
    the least edit distance of one of the item's passages, start and end its place in the folded text
    (the start is its end less the passage's length). Null or empty texts and items match nothing; a
    document or item that is repeated gives its rows once per document row. Empty tables give no row.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = [docs.mapInArrow(_find(rows), SCHEMA) for rows in blocks(benchmark, block)]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], SCHEMA)


def _clean(rows: list[tuple[int, str]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(rows)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part in slices(batch):
                yield part.filter(pa.array([not found for found in finder.find_all(text_of(part.column(at)))], pa.bool_()))
    return kernel


def keep_clean(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` (any columns, among them text) that hold no test item; block after block, no shuffle."""
    for rows in blocks(benchmark, block):
        docs = docs.mapInArrow(_clean(rows), docs.schema)
    return docs
