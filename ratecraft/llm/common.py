"""Small helpers that several of the operators share."""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of ``documents``: what the filtering stages of a pipeline return.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")

#: Rows that one step of a Python kernel holds as Python objects.
SLICE_ROWS = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def slices(batch: pa.RecordBatch, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """A batch in short pieces, so that the Python objects of one piece stay small."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def text_of(column: pa.Array) -> list[str]:
    """Texts as Python strings, null as empty."""
    return [x or "" for x in column.to_pylist()]


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the third of the documents that no model learns from; also where the id is null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(True))


def hash_share(columns: list[str], share: float) -> Column:
    """A repeatable choice of about ``share`` of the rows, by the hash of columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) < F.lit(int(min(1.0, share) * (1 << 40)))


def packed(**arrays: np.ndarray) -> bytes:
    """Arrays of a fitted model as bytes, to travel in a closure or a binary column."""
    out = io.BytesIO()
    np.savez(out, **arrays)
    return zlib.compress(out.getvalue(), 1)


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(zlib.decompress(data))) as found:
        return {name: found[name] for name in found.files}
