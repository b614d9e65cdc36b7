"""Perplexity under an interpolated modified Kneser-Ney model of characters, per language.

Counts of the trusted texts' character n-grams are combined inside each task, then summed by (language,
n-gram); the lower orders, discounts and interpolation weights are grouped sums and joins on these keys, all
of them sharded by Spark. The finished table has one row per n-gram seen (its log probability) and
per context (the log weight of the next lower order).

To score, the table is cut into shards by the last character before the predicted one. A position of
a text needs rows of one shard only, so each shard adds its positions' share to the documents' sums while
the texts stay where they are; a shard's size is bounded by ``SHARD_ROWS`` (but for a single character's rows).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import packed, slices, text_of, unpacked
from ratecraft.session import stored_copy

ORDER = 4
#: Documents up to this quantile of their language's trusted documents are kept, with ``SLACK`` more loss per
#: character allowed. One trusted document in ``CALIBRATION`` is not trained on but sets the quantile:
#: texts that the model knows would set it too low for others.
QUANTILE, SLACK, CALIBRATION = 0.995, 0.05, 5
#: A document counts as that many more characters of its language's mean, so that short ones do not vary freely.
PRIOR = 200.0
SHARD_ROWS = 2_000_000
NO_LANGUAGE = "und"

PAD = "\x02"
_PRIME = np.uint64(0x100000001B3)
_spaces = re.compile(r"\s+").sub


def points(text: str, order: int) -> np.ndarray:
    """Code points of the text, white space as one space, after order - 1 pads."""
    text = PAD * (order - 1) + _spaces(" ", text.replace(PAD, " ")).strip()
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """hashes[n][i]: of the n characters that end at i (for i below n - 1 it is not defined); index 0 is unused."""
    wide = codes.astype(np.uint64)
    out = [np.zeros(len(codes), dtype=np.uint64), wide + np.uint64(1)]
    for n in range(2, order + 1):
        last = np.zeros_like(wide)
        last[1:] = out[n - 1][:-1]
        out.append(last * _PRIME + wide + np.uint64(1))
    return out


def salt(lang: str, n: int, context: bool) -> np.uint64:
    value = 0xCBF29CE484222325
    for byte in f"{lang}\x00{n}\x00{int(context)}".encode():
        value = (value ^ byte) * 0x100000001B3 % (1 << 64)
    return np.uint64(value)


def mixed(h: np.ndarray, salted: np.uint64) -> np.ndarray:
    h = (h ^ salted) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


def _count(order: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(lang, gram, c) of one task; merged whenever a few million are held."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple]] = {}
        size = 0

        def merge() -> None:
            for lang, parts in held.items():
                key, count, gram = (np.concatenate([p[i] for p in parts]) for i in range(3))
                key, first, inverse = np.unique(key, return_index=True, return_inverse=True)
                held[lang] = [(key, np.bincount(inverse, count).astype(np.int64), gram[first])]

        for batch in batches:
            for part in slices(batch):
                by: dict[str, list[np.ndarray]] = {}
                for lang, text in zip(part.column(0).to_pylist(), text_of(part.column(1)), strict=True):
                    by.setdefault(lang, []).append(points(text, order))
                for lang, texts in by.items():
                    codes = np.concatenate(texts)
                    real = np.flatnonzero(codes[order - 1:] != ord(PAD)) + order - 1
                    key, first, count = np.unique(hashes(codes, order)[order][real], return_index=True, return_counts=True)
                    at = real[first]
                    held.setdefault(lang, []).append((key, count, np.stack([codes[at - order + 1 + i] for i in range(order)], axis=1)))
                    size += len(key)
                if size > 4_000_000:
                    merge()
                    size = 0
        merge()
        for lang, parts in held.items():
            for _, count, gram in parts:
                for at in range(0, len(count), 50_000):
                    text = gram[at:at + 50_000].tobytes().decode("utf-32-le", "surrogatepass")
                    c = count[at:at + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(c)), pa.array([text[i:i + order] for i in range(0, len(text), order)]), pa.array(c)],
                        ["lang", "gram", "c"])
    return kernel


def _discount(c: Column, name: str = "d") -> Column:
    return F.when(c == 1, F.col(f"{name}1")).when(c == 2, F.col(f"{name}2")).otherwise(F.col(f"{name}3"))


def model_rows(trusted: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, context boolean, gram, value): log probability of each n-gram, log weight of each context.

    ``trusted`` has lang and text. The empty n-gram's value is the log probability of a character never seen.
    """
    counts = stored_copy(trusted.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text").filter("text is not null")
                         .mapInArrow(_count(order), "lang string, gram string, c long")
                         .groupBy("lang", "gram").agg(F.sum("c").alias("c")), "grams")
    by_order = {order: counts}
    for n in range(order - 1, 0, -1):  # lower orders count different characters to the left
        by_order[n] = by_order[n + 1].groupBy("lang", F.substring("gram", 2, n).alias("gram")).agg(F.count(F.lit(1)).alias("c"))
    lower, out = None, []
    for n in range(1, order + 1):
        grams = by_order[n]
        n_of = grams.groupBy("lang").agg(*[F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)])
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        # Where a count of counts is missing the usual fallbacks hold, so that 0 < discount < count.
        cut = lambda i: F.when((F.col("n1") > 0) & (F.col(f"n{i}") > 0) & (F.col(f"n{i + 1}") > 0),
                               F.greatest(F.lit(0.05), i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}"))).otherwise(F.lit(0.5 * i if i < 3 else 1.25))
        discounts = n_of.select("lang", cut(1).alias("d1"), cut(2).alias("d2"), cut(3).alias("d3"))
        rows = grams.join(discounts, "lang").withColumn("ctx", F.substring("gram", 1, n - 1) if n > 1 else F.lit(""))
        sums = rows.groupBy("lang", "ctx").agg(F.sum("c").alias("total"), F.sum(_discount(F.col("c"))).alias("freed"),
                                               F.count(F.lit(1)).alias("types"))
        weight = sums.select("lang", "ctx", "total", "types", (F.col("freed") / F.col("total")).alias("gamma"))
        own = rows.join(weight, ["lang", "ctx"])
        base = (F.col("c") - _discount(F.col("c"))) / F.col("total")
        if n == 1:
            own = own.withColumn("p", base + F.col("gamma") / (F.col("types") + 1))
            unseen = weight.select("lang", F.lit(False).alias("context"), F.lit("").alias("gram"), F.log(F.col("gamma") / (F.col("types") + 1)).alias("value"))
            out.append(unseen)
        else:
            below = lower.select("lang", F.col("gram").alias("_tail"), F.col("p").alias("_p"))
            own = (own.withColumn("_tail", F.substring("gram", 2, n - 1)).join(below, ["lang", "_tail"])
                   .withColumn("p", base + F.col("gamma") * F.col("_p")))
            out.append(weight.select("lang", F.lit(True).alias("context"), F.col("ctx").alias("gram"), F.log("gamma").alias("value")))
        lower = stored_copy(own.select("lang", "gram", "p"), "order")
        out.append(lower.select("lang", F.lit(False).alias("context"), "gram", F.log("p").alias("value")))
    whole = out[0]
    for rows in out[1:]:
        whole = whole.unionByName(rows)
    return whole


def shard_of(codes: np.ndarray, shards: int) -> np.ndarray:
    """By the character before the predicted one."""
    return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(shards)


def _keys(order: int, shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Hashed key of each row and its shard; rows that every shard needs come once for each."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, value, shard = [], [], []
            lang, context, gram, val = (batch.column(i).to_pylist() for i in range(4))
            for a, c, g, v in zip(lang, context, gram, val, strict=True):
                codes = np.frombuffer(g.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                n = len(codes)
                h = hashes(codes, n)[n][-1:] if n else np.zeros(1, dtype=np.uint64)
                k = mixed(h, salt(a, n, c)).view(np.int64)[0]
                before = codes[-1:] if c and n else codes[-2:-1]
                for s in (shard_of(before, shards).tolist() if len(before) else range(shards)):
                    key.append(k)
                    value.append(v)
                    shard.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(value, pa.float32()), pa.array(shard, pa.int32())],
                                             ["key", "value", "shard"])
    return kernel


class Lookup:
    """Open-addressing table over arrays: key -> value, many at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2.5))))
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.values = np.full(1 << self.bits, np.nan, dtype=np.float32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] == 0
            taken, first = np.unique(slot[free], return_index=True)
            put = left[free][first]
            self.keys[taken], self.values[taken] = keys[put], values[put]
            stay = np.ones(len(left), dtype=bool)
            stay[np.flatnonzero(free)[first]] = False
            left, slot = left[stay], slot[stay]
            busy = self.keys[slot] != 0
            slot = np.where(busy, (slot + 1) & ((1 << self.bits) - 1), slot)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Values, NaN where a key is missing."""
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], np.float32(np.nan))
        left = np.flatnonzero((there != keys) & (there != 0))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot]
            same = there == keys[left]
            out[left[same]] = self.values[slot[same]]
            on = ~same & (there != 0)
            left, slot = left[on], slot[on]
        return out


def text_score(table: Lookup, codes: np.ndarray, lang: str, order: int, mine: np.ndarray) -> float:
    """Sum of log probabilities of the characters at ``mine``, positions in ``codes``."""
    h = hashes(codes, order)
    total, left = 0.0, mine
    for n in range(order, 0, -1):
        p = table(mixed(h[n][left], salt(lang, n, False)))
        seen = ~np.isnan(p)
        total += float(p[seen].sum(dtype=np.float64))
        left = left[~seen]
        if not len(left):
            return total
        if n > 1:
            total += float(np.nansum(table(mixed(h[n - 1][left - 1], salt(lang, n - 1, True))), dtype=np.float64))
    unseen = table(mixed(np.zeros(1, dtype=np.uint64), salt(lang, 0, False)))[0]
    return total + len(left) * (float(unseen) if not np.isnan(unseen) else -np.log(1 << 16))


def _add(shard: bytes, at: int, shards: int, order: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = unpacked(shard)
        table = Lookup(rows["key"], rows["value"])
        for batch in batches:
            for part in slices(batch):
                logp, chars = [], []
                for lang, text in zip(part.column(1).to_pylist(), text_of(part.column(2)), strict=True):
                    codes = points(text, order)
                    mine = np.arange(order - 1, len(codes))
                    chars.append(len(mine))
                    if shards > 1:
                        mine = mine[shard_of(codes[mine - 1], shards) == at]
                    logp.append(text_score(table, codes, lang, order, mine))
                sums = np.array(logp) + part.column(3).to_numpy()
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(sums), pa.array(chars, pa.int64())],
                                                 ["doc_id", "lang", "text", "logp", "chars"])
    return kernel


def scored(docs: DataFrame, rows: DataFrame, order: int = ORDER, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, lang, logp, chars) of every document under the model ``rows``."""
    rows = stored_copy(rows, "model")
    shards = max(1, -(-rows.count() // shard_rows))
    keyed = stored_copy(rows.mapInArrow(_keys(order, shards), "key long, value float, shard int"), "keys")
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text",
                      F.lit(0.0).alias("logp"), F.lit(0).cast("long").alias("chars"))
    for at in range(shards):
        part = keyed.filter(F.col("shard") == at).select("key", "value").distinct().toArrow()
        shard = packed(key=part.column("key").to_numpy().view(np.uint64), value=part.column("value").to_numpy())
        out = out.mapInArrow(_add(shard, at, shards, order), "doc_id long, lang string, text string, logp double, chars long")
    return out.drop("text")


def judge(docs: DataFrame, trusted_ids: DataFrame, order: int = ORDER, quantile: float = QUANTILE,
          prior: float = PRIOR, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Per document: doc_id, lang, perplexity (per character), threshold (its language's), keep.

    ``docs`` has doc_id, lang and text, ``trusted_ids`` the doc_id of trusted documents; other columns are not read.
    Null and empty texts have no perplexity and are not kept; a null language is one of its own, ``und``.
    A language without trusted text has no threshold, and its documents are judged by the largest one of all.
    Rows repeated stay repeated, and a trusted text that is repeated counts as often. Empty tables
    give no row; without trusted text nothing is kept.
    """
    docs = docs.select("doc_id", "lang", "text")
    marked = trusted_ids.select(F.col("doc_id").alias("_id")).filter("_id is not null").distinct()
    marked = marked.withColumn("_held", F.crc32(F.col("_id").cast("string")) % CALIBRATION == 0)
    # One way for every size: texts and ids meet by a shuffle, whether or not the ids would fit a broadcast.
    trained = docs.join(marked.filter("not _held").hint("merge"), F.col("doc_id") == F.col("_id"), "left_semi")
    found = stored_copy(scored(docs, model_rows(trained, order), order, shard_rows), "scored")
    known = found.join(marked, F.col("doc_id") == F.col("_id")).filter("chars > 0")
    mean = known.groupBy("lang").agg((-F.sum("logp") / F.sum("chars")).alias("mean"))
    loss = (-F.col("logp") + prior * F.col("mean")) / (F.col("chars") + prior)
    # A language without a held-out document takes all its trusted ones.
    at = lambda rows: F.percentile_approx(F.when(rows, F.col("loss")), quantile, 10_000)
    limits = (known.join(mean, "lang").withColumn("loss", loss).groupBy("lang", "mean")
              .agg((F.coalesce(at(F.col("_held")), at(F.lit(True))) + SLACK).alias("limit")))
    overall = limits.agg(F.max("limit").alias("limit"), F.avg("mean").alias("mean")).first()
    judged = found.join(limits, "lang", "left")
    judged = judged.withColumns({"mean": F.coalesce("mean", F.lit(overall["mean"]).cast("double")),
                                 "limit": F.coalesce("limit", F.lit(overall["limit"]).cast("double"))}).withColumn("loss", loss)
    real = F.col("chars") > 0
    return judged.select("doc_id", "lang", F.when(real, F.exp("loss")).alias("perplexity"), F.exp("limit").alias("threshold"),
                         F.coalesce(real & (F.col("loss") <= F.col("limit")), F.lit(False)).alias("keep"))
