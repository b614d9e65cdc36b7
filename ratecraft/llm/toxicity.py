"""Toxicity by a support vector machine on a gapped subsequence string kernel.

The kernel of two words sums over the three-letter subsequences they share, with ``DECAY`` for each letter
that a subsequence skips, and is normalised to 1 for equal words; marks at both ends of a word count as
letters. Inserted characters and gaps thus lower the similarity to an insult but do not hide it.
A form of a word is compared once and remembered.
Landmarks are the words of the training sample that tell toxic from clean texts best; a text is
described by its closest word to each landmark, the Nystroem map of the landmarks' own kernel makes
these similarities coordinates, and a linear machine with a calibrated score decides.

The machine is fitted on a bounded sample of labelled rows (``SAMPLE``); every whole text is scored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import hash_share, packed, slices, text_of, unpacked
from ratecraft.session import stored_copy

#: Bound of the sample of labelled rows: toxic, clean.
SAMPLE = (4000, 8000)
LANDMARKS = 160
DECAY = 0.6
#: Similarities up to here count as none.
FLOOR = 0.4
#: Landmarks at least so similar share a group in the bound that sorts words out.
GROUPED = 0.25
#: Penalty on the machine's weights.
PENALTY = 0.1
#: Toxic rows are also learnt with their similarities weakened to this share, as disguise weakens them, at half weight.
DISGUISE = 0.6
THRESHOLD = 0.7
#: Words that a Python worker remembers; beyond that it starts anew.
CACHED_WORDS = 1_000_000

#: Longer forms are also read through windows of these widths, a quarter apart: all places, and words of all lengths.
LONG, WIDTHS = 24, (8, 12, 24, 48)

_PATTERNS = [(a, b) for b in range(2, 5) for a in range(1, b)]
_FIRST, _LAST = 62, 63
_parts = re.compile(r"[^\W\d_]+").findall
_spelled = re.compile(r"(?<!\S)(?:\S\s){3,}\S(?!\S)").findall


def units(text: str) -> set[str]:
    """The text's words, lower case, and words spelled with a space after each letter."""
    text = text.lower()
    out = set(text.split())
    out.update("".join(x.split()) for x in _spelled(text))
    return out


def forms(unit: str) -> list[str]:
    """What a unit may be read as: its letters joined, and its runs of letters."""
    runs = _parts(unit)
    if len(runs) < 2:
        return runs
    return ["".join(runs), *(r for r in runs if len(r) > 2)]


def windows(form: str) -> Iterator[str]:
    """What of a form is compared: the form as a word, and if it is long, the parts that cover all of it."""
    if len(form) <= 64:
        yield form
    if len(form) > LONG:
        for width in WIDTHS:
            yield from (form[at:at + width] for at in range(0, max(1, len(form) - width + width // 4), width // 4))


def _code(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 35


_codes: list[np.ndarray] = []


def encoded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of all words in one array, and the word each belongs to; four zeros part the words."""
    if not _codes:
        _codes.append(np.array([0, _FIRST, _LAST, *(_code(chr(i)) for i in range(3, 0x110000))], dtype=np.int64))
    joined = "\x01" + "\x02\0\0\0\0\x01".join(words) + "\x02\0\0\0\0"
    flat = _codes[0][np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    return flat, np.cumsum(flat == _FIRST) - 1


def triples(flat: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(word, subsequence, weight) of every occurrence, one way of skipping letters after the other."""
    for a, b in _PATTERNS:
        n = max(0, len(flat) - b)
        # Four zeros stand between words, so letters b apart are of one word.
        real = np.flatnonzero((flat[:n] > 0) & (flat[a:a + n] > 0) & (flat[b:b + n] > 0))
        yield owner[real], (flat[real] << 12) | (flat[real + a] << 6) | flat[real + b], DECAY ** (b - 2)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, weight), one entry for each occurrence, ordered by word."""
    found = list(triples(*encoded(words)))
    word, what = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    weight = np.repeat(np.array([f[2] for f in found], dtype=np.float32), [len(f[0]) for f in found])
    order = np.argsort(word, kind="stable")
    return word[order], what[order], weight[order]


def norms(word: np.ndarray, what: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Square root of each word's kernel with itself."""
    key, inverse = np.unique((word << 18) | what, return_inverse=True)
    total = np.bincount(inverse, weight, minlength=len(key))
    return np.sqrt(np.bincount(key >> 18, total * total, minlength=n))


class Kernel:
    """Similarities of words to landmarks, remembered for the words that have any."""

    def __init__(self, landmarks: list[str]):
        self.m = len(landmarks)
        word, what, weight = subsequences(landmarks)
        rows, inverse = np.unique(what, return_inverse=True)
        self.table = np.zeros((len(rows) + 1, self.m), dtype=np.float32)
        np.add.at(self.table, (inverse + 1, word), weight)
        self.table /= np.maximum(norms(word, what, weight, self.m), 1e-9).astype(np.float32)
        self.row = np.zeros(1 << 18, dtype=np.int32)
        self.row[rows] = np.arange(1, len(rows) + 1)
        self.bound = self._bounds()
        self.seen: set[str] = set()
        self.seen_forms: set[str] = set()
        self.close: dict[str, np.ndarray] = {}
        self.close_forms: dict[str, np.ndarray] = {}

    def _bounds(self) -> np.ndarray:
        """Each subsequence's largest part in any landmark of a group, for groups of landmarks that are alike."""
        alike = self.table.T @ self.table
        group, heads = np.zeros(self.m, dtype=np.int64), []
        for i in range(self.m):
            near = [alike[i, h] for h in heads]
            if not heads or max(near) < GROUPED:
                heads.append(i)
                group[i] = len(heads) - 1
            else:
                group[i] = int(np.argmax(near))
        return np.stack([self.table[:, group == g].max(axis=1) for g in range(len(heads))], axis=1)

    def similarity(self, words: list[str]) -> np.ndarray:
        """Similarity of each word to each landmark, from 0 (at ``FLOOR`` or less) to 1."""
        out = np.zeros((len(words), self.m), dtype=np.float32)
        near = self.near(words)
        height = len(self.table)
        for at in range(0, len(near), 512):
            chosen = near[at:at + 512]
            word, what, weight = subsequences([words[i] for i in chosen])
            counts = np.bincount(word * height + self.row[what], weight, minlength=len(chosen) * height)
            total = counts.astype(np.float32).reshape(-1, height) @ self.table  # row 0 of the table is 0
            norm = np.maximum(norms(word, what, weight, len(chosen)), 1e-9).astype(np.float32)
            out[chosen] = total / norm[:, None]
        return np.maximum(0, (out - FLOOR) / (1 - FLOOR))

    def near(self, words: list[str]) -> np.ndarray:
        """Words that may be above ``FLOOR``: most fail by two bounds.

        In no group of landmarks is a word's kernel larger than the sum over its subsequences of their largest
        part in the group, and the norm of a word is no smaller than if its subsequences were all different.
        """
        out = [np.zeros(0, dtype=np.int64)]
        for at in range(0, len(words), 4096):
            part = words[at:at + 4096]
            word, what, weight = subsequences(part)
            row = self.row[what]
            hit = np.flatnonzero(row)
            if len(hit):
                start = np.flatnonzero(np.diff(word[hit], prepend=-1))
                most = np.add.reduceat(self.bound[row[hit]] * weight[hit, None], start, axis=0).max(axis=1)
                least = np.sqrt(np.bincount(word, weight * weight, minlength=len(part)))
                owner = word[hit][start]
                out.append(owner[most > FLOOR * least[owner]] + at)
        return np.concatenate(out)

    def learn(self, new: set[str]) -> None:
        if max(len(self.seen), len(self.seen_forms)) > CACHED_WORDS:
            for held in (self.seen, self.seen_forms, self.close, self.close_forms):
                held.clear()
        new = new - self.seen
        read = {u: {w for f in forms(u) for w in windows(f)} for u in new}
        fresh = sorted({f for fs in read.values() for f in fs} - self.seen_forms)
        for at in range(0, len(fresh), 20_000):
            part = fresh[at:at + 20_000]
            found = self.similarity(part)
            self.close_forms.update((part[i], found[i].copy()) for i in np.flatnonzero(found.any(axis=1)))
        self.seen_forms.update(fresh)
        for u, fs in read.items():
            rows = [self.close_forms[f] for f in fs if f in self.close_forms]
            if rows:
                self.close[u] = rows[0] if len(rows) == 1 else np.max(rows, axis=0)
        self.seen |= new

    def describe(self, texts: list[str]) -> np.ndarray:
        """For each text its highest similarity to every landmark."""
        sets = [units(t) for t in texts]
        self.learn(set().union(*sets))
        out = np.zeros((len(texts), self.m), dtype=np.float32)
        for i, own in enumerate(sets):
            rows = [self.close[u] for u in own & self.close.keys()]
            if rows:
                out[i] = np.max(rows, axis=0)
        return out


_kernels: dict[tuple[str, ...], Kernel] = {}


def kernel_of(landmarks: list[str]) -> Kernel:
    """The worker's own, kept from task to task while the landmarks stay the same."""
    key = tuple(landmarks)
    if key not in _kernels:
        _kernels.clear()
        _kernels[key] = Kernel(landmarks)
    return _kernels[key]


def machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Linear support vector machine with squared hinge loss, by Newton steps; the last weight is the offset."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(x.shape[1]) * penalty
    ridge[-1, -1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(50):
        inside = y * (x @ w) < 1
        xs = x[inside] * weight[inside, None]
        step = np.linalg.solve(ridge + xs.T @ x[inside], xs.T @ y[inside])
        if np.allclose(step, w, atol=1e-8):
            break
        w = 0.5 * w + 0.5 * step if _ > 20 else step
    return w


def calibration(f: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve that turns the machine's value into a probability."""
    t = np.where(y > 0, (weight[y > 0].sum() + 1) / (weight[y > 0].sum() + 2), 1 / (weight[y < 0].sum() + 2))
    ab = np.array([1.0, 0.0])
    x = np.stack([f, np.ones_like(f)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        grad = x.T @ (weight * (p - t)) + 1e-3 * ab
        hess = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2)
        ab = ab - np.linalg.solve(hess, grad)
        ab[0] = np.clip(ab[0], 0.0, 20.0)
    return float(ab[0]), float(ab[1])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            words, toxic = [], []
            for text, label in zip(text_of(part.column(0)), part.column(1).to_pylist(), strict=True):
                own = {f for u in units(text) for f in forms(u) if 2 < len(f) < 40}
                words += own
                toxic += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(toxic, pa.int32())], ["word", "toxic"])


def _describe(landmarks: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = kernel_of(landmarks)
        for batch in batches:
            for part in slices(batch):
                found = k.describe(text_of(part.column(0)))
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in found], pa.binary()), part.column(1)], ["x", "toxic"])
    return kernel


def fit(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE, landmarks: int = LANDMARKS) -> bytes | None:
    """The model, learnt from ``docs`` (doc_id, text) with a label in ``labels`` (doc_id, toxic 0 or 1).

    The sample holds about ``sample`` toxic and clean rows, chosen by the hash of doc_id; the driver gets the
    landmarks and the sample's similarities. None if one of the two classes is missing.
    """
    labels = labels.select(F.col("doc_id").alias("_label_id"), F.col("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)")
    labels = labels.groupBy("_label_id").agg(F.max("toxic").alias("toxic"))
    sizes = dict(labels.groupBy("toxic").count().collect())
    if len(sizes) < 2:
        return None
    share = [min(1.0, sample[1] / sizes[0]), min(1.0, sample[0] / sizes[1])]
    some = labels.filter(F.when(F.col("toxic") == 1, hash_share(["_label_id"], share[1])).otherwise(hash_share(["_label_id"], share[0])))
    # The looser of the two shares bounds which documents can be in the sample before any text is moved.
    mine = docs.filter("text is not null").filter(hash_share(["doc_id"], max(share))).select("doc_id", "text")
    drawn = stored_copy(mine.join(some, F.col("doc_id") == F.col("_label_id")).select("text", "toxic"), "labelled")
    total = dict(drawn.groupBy("toxic").count().collect())
    if len(total) < 2:
        return None
    rate = (F.col("hits") + 0.5) / (total[1] + 1), (F.col("n") - F.col("hits") + 0.5) / (total[0] + 1)
    words = (drawn.mapInArrow(_words, "word string, toxic int").groupBy("word")
             .agg(F.sum("toxic").alias("hits"), F.count(F.lit(1)).alias("n")).filter("hits > 1"))
    gain = F.log(rate[0] / rate[1]) * F.sqrt(F.col("hits"))
    chosen = [r.word for r in words.filter(rate[0] > 3 * rate[1]).orderBy(gain.desc(), "word").limit(landmarks).collect()]
    if not chosen:
        return None
    rows = drawn.mapInArrow(_describe(chosen), "x binary, toxic int").toArrow()
    x = np.array([np.frombuffer(b, dtype=np.float32) for b in rows.column("x").to_pylist()], dtype=np.float64)
    y = np.where(rows.column("toxic").to_numpy() == 1, 1.0, -1.0)
    # Clean rows were drawn more sparsely: weigh them back, so that the score is a probability.
    weight = np.where(y > 0, 1 / share[1], 1 / share[0]) / max(1 / share[1], 1 / share[0])
    own, axes = np.linalg.eigh(kernel_of(chosen).similarity(chosen).astype(np.float64) + 1e-3 * np.eye(len(chosen)))
    large = own > 1e-2
    nystroem = axes[:, large] / np.sqrt(own[large])
    toxic = y > 0
    w = machine(np.vstack([x, DISGUISE * x[toxic]]) @ nystroem, np.append(y, y[toxic]), np.append(weight, 0.5 * weight[toxic]))
    slope, offset = calibration(x @ nystroem @ w[:-1] + w[-1], y, weight)
    return packed(landmarks=np.array(chosen), weight=nystroem @ w[:-1] * slope, offset=np.array(w[-1] * slope + offset))


def score(docs: DataFrame, model: bytes | None, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, score (0 to 1), predicted (1 at ``threshold`` or more).

    ``docs`` has doc_id and text; other columns are not read. Null and empty texts are scored like a text
    without any word near an insult. Without a model all scores are 0. Rows repeated stay repeated.
    """
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = unpacked(model) if model is not None else None
        k = kernel_of([str(x) for x in known["landmarks"]]) if known is not None else None
        for batch in batches:
            for part in slices(batch):
                found = np.zeros(part.num_rows)
                if known is not None:
                    value = k.describe(text_of(part.column(1))) @ known["weight"] + known["offset"]
                    found = 1 / (1 + np.exp(-np.clip(value, -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                                                 ["doc_id", "score", "predicted"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(kernel, "doc_id long, score double, predicted int")
