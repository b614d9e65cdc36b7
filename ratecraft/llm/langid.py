"""Language identification by nearest centroid.

A text becomes a unit vector of TF-IDF weights over hashed character n-grams (1 to 3 letters, lower
case, anything but letters as one gap). Document frequencies cover every training document. Each
language has several centroids, found by spherical k-means over a bounded sample of its training
documents. A text gets the language of the centroid with the highest cosine, and is rejected if it is
farther from it than nearly all training documents of that language.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import held_out, packed, slices, text_of, unpacked

#: Hashed n-grams; the model has languages x centroids x this many 32-bit floats.
BUCKETS = 1 << 13
CENTROIDS = 4
#: Bound of the sample that centroids are fitted on: documents of one language.
SAMPLE = 400
#: Reject below this part of the cosine that all but ``TAIL`` of the sample's texts of that length reach.
SLACK, TAIL = 0.9, 0.005
#: Lengths are told apart by the power of two of the number of n-grams.
LENGTHS = 24
UNDETERMINED = "und"

_letters: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    """By code point, built once a worker."""
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _letters[0]


def grams(text: str) -> np.ndarray | None:
    """Bucket of every n-gram of the text, or None if it has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = is_letter()[codes]
    if not letter.any():
        return None
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    codes = np.where(letter, codes, np.uint32(32))[kept]
    if codes[0] != 32:
        codes = np.concatenate([np.array([32], dtype=np.uint32), codes])
    if codes[-1] != 32:
        codes = np.concatenate([codes, np.array([32], dtype=np.uint32)])
    one = codes * np.uint32(2654435761)
    two = one[1:] + codes[:-1] * np.uint32(2246822519) + np.uint32(374761393)
    three = two[1:] + codes[:-2] * np.uint32(3266489917) + np.uint32(668265263)
    out = np.concatenate([one, two, three])
    out ^= out >> np.uint32(15)
    out *= np.uint32(2246822519)
    return out >> np.uint32(32 - 13)


def measured(texts: list[str], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, and the texts' lengths in powers of two of n-grams, -1 if a text has no letter."""
    out, length = np.zeros((len(texts), BUCKETS), dtype=np.float32), np.full(len(texts), -1)
    for i, text in enumerate(texts):
        found = grams(text)
        if found is not None:
            row = np.log1p(np.bincount(found, minlength=BUCKETS)) * weight
            out[i], length[i] = row / max(np.sqrt(row @ row), 1e-12), min(len(found).bit_length(), LENGTHS - 1)
    return out, length


def vectors(texts: list[str], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, and which texts have a letter."""
    out, length = measured(texts, weight)
    return out, length >= 0


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, docs = np.zeros(BUCKETS, dtype=np.int64), 0
    for batch in batches:
        for part in slices(batch):
            for text in text_of(part.column(0)):
                found = grams(text)
                if found is not None:
                    seen += np.bincount(found, minlength=BUCKETS) > 0
                    docs += 1
    bucket = np.append(np.arange(BUCKETS), -1)
    yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.append(seen, docs))], ["bucket", "n"])


def clusters(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from points far from each other."""
    chosen = [points.mean(axis=0)]
    near = points @ chosen[0]
    centres = []
    for _ in range(min(k, len(points))):
        centres.append(points[int(np.argmin(near))])
        near = np.maximum(near, points @ centres[-1]) if len(centres) > 1 else points @ centres[-1]
    out = np.array(centres)
    for _ in range(rounds):
        own = np.argmax(points @ out.T, axis=1)
        for c in range(len(out)):
            if (own == c).any():
                mean = points[own == c].mean(axis=0)
                out[c] = mean / max(np.linalg.norm(mean), 1e-12)
    return out


def limits(texts: list[str], points: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """Least cosine of an accepted text for every length; ``points`` are the vectors of ``texts``.

    A length that too few texts have for the quantile takes the limit of the next shorter one, or else of the shortest.
    """
    found: list[list[np.ndarray]] = [[] for _ in range(LENGTHS)]
    half = np.arange(len(texts)) % 2
    for side in (0, 1):
        own = [texts[i] for i in np.flatnonzero(half == side)]
        others = points[half != side] if len(texts) > 1 else points
        centres = clusters(others, k)
        for size in (None, *(2 ** p for p in range(1, LENGTHS - 2))):
            # The whole texts, and the starts of those that are longer.
            part = own if size is None else [t[:size] for t in own if len(t) > size]
            for at in range(0, len(part), 64):
                close, length = measured(part[at:at + 64], weight)
                best = (close @ centres.T).max(axis=1)
                for n in set(length[length >= 0].tolist()):
                    found[n].append(best[length == n])
    all_of = [np.concatenate([np.zeros(0), *f]) for f in found]
    enough = max(1, min(round(1 / TAIL), len(texts) // 2, max(map(len, all_of))))
    known = np.flatnonzero([len(f) >= enough for f in all_of])
    out = np.zeros(LENGTHS)
    out[known] = [SLACK * float(np.quantile(all_of[i], TAIL)) for i in known]
    return out[known[np.maximum(np.searchsorted(known, np.arange(LENGTHS), "right") - 1, 0)]]


def _centroids(weight: np.ndarray, k: int) -> Callable[[pa.Table], pa.Table]:
    def fit(sample: pa.Table) -> pa.Table:
        lang = sample.column("lang")[0].as_py()
        order = np.argsort([x for x in sample.column("rank").to_pylist()], kind="stable")
        texts = text_of(sample.column("text"))
        texts = [texts[i] for i in order]
        points, real = vectors(texts, weight)
        points, texts = points[real], [t for t, r in zip(texts, real) if r]
        if not len(points):
            return pa.table({"lang": pa.array([], pa.string()), "centre": pa.array([], pa.binary()), "least": pa.array([], pa.binary())})
        centres = clusters(points, k)
        least = limits(texts, points, weight, k).tobytes()
        return pa.table({"lang": [lang] * len(centres), "centre": [c.tobytes() for c in centres], "least": [least] * len(centres)})
    return fit


def fit(train: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> bytes | None:
    """The model, learnt from the rows of ``train`` (text, lang) with both; None if there is nothing to learn."""
    train = train.select("text", "lang").filter("text is not null and lang is not null")
    sums = dict(train.select("text").mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect())
    docs = sums.pop(-1, 0)
    if not docs:
        return None
    seen = np.array([sums.get(i, 0) for i in range(BUCKETS)], dtype=np.float64)
    weight = (np.log((1 + docs) / (1 + seen)) + 1).astype(np.float32)
    # About ``sample`` texts of each language, by the hash of the text: every copy of a text has the same hash, and
    # counts once, so that copies do not crowd out the others.
    rank = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    sizes = train.select("lang", rank.alias("rank")).distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = {row.lang: min(1.0, sample / row.n) for row in sizes.collect()}
    limit = F.create_map(*[F.lit(x) for lang, s in share.items() for x in (lang, int(s * (1 << 40)))])
    chosen = (train.withColumn("rank", rank).filter(F.col("rank") < limit[F.col("lang")])
              .dropDuplicates(["lang", "rank"]))
    found = (chosen.groupBy("lang").applyInArrow(_centroids(weight, centroids), "lang string, centre binary, least binary")
             .orderBy("lang", "centre").collect())
    if not found:
        return None
    return packed(weight=weight, lang=np.array([r.lang for r in found]), least=np.array([np.frombuffer(r.least) for r in found]),
                  centre=np.array([np.frombuffer(r.centre, dtype=np.float32) for r in found]))


_SCHEMA = "doc_id long, lang_pred string, score double, rejected boolean"


def _predict(model: bytes | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = unpacked(model) if model is not None else None
        for batch in batches:
            for part in slices(batch, 64):
                n = part.num_rows
                lang, score, far = [UNDETERMINED] * n, np.zeros(n), np.ones(n, dtype=bool)
                if known is not None:
                    points, length = measured(text_of(part.column(1)), known["weight"])
                    real = length >= 0
                    cosine = points @ known["centre"].T
                    best = np.argmax(cosine, axis=1)
                    score = np.where(real, np.clip(cosine[np.arange(n), best], 0, 1), 0.0).astype(np.float64)
                    far = ~real | (score < known["least"][best, length])
                    lang = [str(known["lang"][b]) if r else UNDETERMINED for b, r in zip(best, real)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang), pa.array(score), pa.array(far)],
                                                 ["doc_id", "lang_pred", "score", "rejected"])
    return kernel


def predict(docs: DataFrame, model: bytes | None) -> DataFrame:
    """Per document: doc_id, lang_pred, score (cosine to the nearest centroid, 0 to 1), rejected.

    ``docs`` has doc_id and text; other columns are not read. A text that is null or has no letter gets
    ``und``, score 0, and is rejected; so is every text without a model. Rows repeated stay repeated;
    equal cosines go to the first language in order. An empty table gives no row.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_predict(model), _SCHEMA)


def _flag(model: bytes | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    judge = _predict(model)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part in slices(batch):
                two = pa.RecordBatch.from_arrays([pa.nulls(part.num_rows, pa.int64()), part.column(at)], ["doc_id", "text"])
                far = np.concatenate([x.column(3).to_numpy(zero_copy_only=False) for x in judge(iter([two]))])
                yield part.filter(pa.array(~far))
    return kernel


def keep_known(docs: DataFrame, model: bytes | None) -> DataFrame:
    """The rows of ``docs`` (any columns, among them text) that ``predict`` does not reject; no shuffle."""
    return docs.mapInArrow(_flag(model), docs.schema)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out())
