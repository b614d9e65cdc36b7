"""Harmonic packing of documents into training sequences.

A document's ids are cut into pieces; a piece of length n has the class ``capacity // n``, the
number of such pieces that fit one sequence, and a sequence of class k takes exactly k pieces.
Cuts are made at the lengths ``capacity / 2^j``, which fill their class without padding, until a
piece below ``WHOLE_BELOW`` is left; so only these short rests pad, by at most 1/32 of their length.

Every task packs the rows of its own partition, class by class, and sees no other task: there is no
shuffle, and a lost task is simply run again. What its unfinished sequences hold at the end (less than
one sequence a class) is joined end to end and cut at the capacity; the last of these sequences falls
into powers of two, which need no padding.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ratecraft.llm.common import slices, text_of

CAPACITY = 4096
END_ID = 2
#: Pieces shorter than this are not cut any more.
WHOLE_BELOW = 128
#: Words whose ids a Python worker remembers; beyond that it starts anew (about 150 bytes each).
CACHED_WORDS = 800_000

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_TYPES = pa.schema([(x.split()[0], pa.int64()) for x in SCHEMA.split(", ")])
_TASK_BITS = 36


class WordIds(dict):
    """Ids of a word between white space, as little-endian 32-bit bytes; asks the tokenizer once a word.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its words.
    """

    #: Words that the second cache may split by the tokenizer's own pattern.
    PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+").fullmatch
    PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+").findall
    #: The tokenizer's letter for each byte, where PLAIN words have bytes of 128 and more.
    LETTERS = {b: b + 162 if b < 161 else 323 if b == 173 else b for b in range(128, 256)}
    #: White space for Python, but not for the tokenizer; and the start of its special tokens.
    UNLIKE = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pieces: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode_piece(self, piece: str) -> bytes:
        """As ``encode``, for one lower-case piece of a plain word: normal form and split are known, so the model alone is asked."""
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.LETTERS)
        ids = array("I", [token.id for token in self.model.tokenize(piece)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) > CACHED_WORDS:
            self.clear()
            self.pieces.clear()
        if self.PLAIN(word):
            known, out = self.pieces, []
            for piece in self.PIECES(word.lower()):
                ids = known.get(piece)
                if ids is None:
                    ids = known[piece] = self.encode_piece(piece)
                out.append(ids)
            ids = b"".join(out)
        else:
            ids = self.encode(word)
        self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        if any(x in text for x in self.UNLIKE):
            return self.encode(text)
        return b"".join(map(self.__getitem__, text.split()))


_words: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's own, kept from task to task."""
    if path not in _words:
        _words[path] = WordIds(path)
    return _words[path]


def cut(n: int, capacity: int = CAPACITY, whole_below: int = WHOLE_BELOW) -> list[int]:
    """Lengths of a document's pieces, in order; they add up to n."""
    full, rest = divmod(n, capacity)
    out = [capacity] * full
    while rest >= max(2, whole_below):
        out.append(1 << (rest.bit_length() - 1))
        rest -= out[-1]
    return out + [rest] * (rest > 0)


class Packer:
    """Bins of one task. A piece is (doc_id, start, ids as bytes, doc_tokens)."""

    def __init__(self, first_id: int, capacity: int = CAPACITY):
        self.next_id, self.capacity = first_id, capacity
        self.open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        for n in cut(total, self.capacity):
            count = self.capacity // n
            held = self.open.setdefault(count, [])
            held.append((doc_id, start, ids[4 * start:4 * (start + n)], total))
            start += n
            if len(held) == count:
                self.close(self.open.pop(count))

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, zlib.crc32(ids), total, self.next_id, offset))
            offset += n
        self.next_id += 1

    def finish(self) -> None:
        """Join what is left, longest pieces first, and cut it at the capacity, then at powers of two."""
        left = [piece for count in sorted(self.open) for piece in self.open[count]]
        self.open = {}
        total = sum(len(piece[2]) // 4 for piece in left)
        sizes = [self.capacity] * (total // self.capacity)
        rest = total % self.capacity
        sizes += [1 << j for j in reversed(range(rest.bit_length())) if rest >> j & 1]
        held: list[tuple] = []
        room, sizes = (sizes[0], sizes[1:]) if sizes else (0, [])
        for doc_id, start, ids, doc_tokens in left:
            while ids:
                part = ids[:4 * room]
                held.append((doc_id, start, part, doc_tokens))
                start, ids, room = start + len(part) // 4, ids[len(part):], room - len(part) // 4
                if not room:
                    self.close(held)
                    held = []
                    room, sizes = (sizes[0], sizes[1:]) if sizes else (0, [])

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else [[] for _ in _TYPES]
        out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_TYPES)
        self.rows = []
        return out


def _pack(tokenizer: str, end_id: int, capacity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = word_ids(tokenizer), int(end_id).to_bytes(4, "little")
        packer = Packer(TaskContext.get().partitionId() << _TASK_BITS, capacity)
        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column(0).to_pylist(), text_of(part.column(1)), strict=True):
                    packer.add(doc_id, words.of(text) + end)
                yield packer.batch()
        packer.finish()
        yield packer.batch()
    return kernel


def pack(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``docs`` has doc_id and text; other columns are not read. A null or empty text gives the end id
    alone. Equal rows are packed as often as they come, a null doc_id stays null, and an empty table
    gives no row. ``tokenizer`` is a file that every executor can read, ``capacity`` a power of two.
    """
    if capacity < 2 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    return docs.select("doc_id", "text").mapInArrow(_pack(tokenizer, end_id, capacity), SCHEMA)
