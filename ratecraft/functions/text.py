"""Tokens, n-grams and TF-IDF weights as tables of (document, term, weight)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Fixed value: a token is a run of letters, digits and underscores with at least one of a-z in it.
TOKEN = r"[\p{L}\p{N}_]*[a-z][\p{L}\p{N}_]*"

#: Default English stop words (function words). Pass another sequence for another list.
STOP_WORDS = tuple("""
a about above after again against all also am an and any are as at be because been before being below between both but
by can could did do does doing down during each few for from further had has have having he her here hers herself him
himself his how however i if in into is it its itself just me more most my myself no nor not now of off on once only or
other our ours ourselves out over own same she should so some such than that the their theirs them themselves then there
these they this those through to too under until up very was we were what when where which while who whom why will with
would you your yours yourself yourselves
""".split())


def tokens(text: Column) -> Column:
    """Lower-cased tokens of the whole text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def without_stop_words(words: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    return F.filter(words, lambda w: ~w.isin(*stop_words)) if stop_words else words


def ngrams(words: Column, low: int = 1, high: int = 1) -> Column:
    """All runs of ``low`` to ``high`` words, joined by one space.

    The word list is bound to a lambda variable first: written into the inner function it
    would be split anew for every position.
    """
    if (low, high) == (1, 1):
        return words

    def runs(w: Column, n: int) -> Column:
        if n == 1:
            return w
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - (n - 1))).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "))

    bound = F.transform(F.array(words), lambda w: F.concat(*(runs(w, n) for n in range(low, high + 1))))
    return F.element_at(bound, 1)


def terms_of(text: Column, ngram_range: tuple[int, int] = (1, 1),
             stop_words: Sequence[str] = STOP_WORDS) -> Column:
    return ngrams(without_stop_words(tokens(text), stop_words), *ngram_range)


def _runs(docs: DataFrame, key: Sequence[str], terms: str) -> DataFrame:
    """(key..., term, tf): the different values of the array column ``terms`` of each row, with their numbers.

    Equal terms lie together once the array is sorted; a term's number is the length of its run. No row is grouped, so
    nothing is shuffled.
    """
    named = [f"_k{i}" for i in range(len(key))]  # whatever the keys are called
    s, b = F.col("_s"), F.col("_b")
    rows = docs.select(*(F.col(k).alias(n) for k, n in zip(key, named)), F.sort_array(terms).alias("_s")).filter(F.size("_s") > 0)
    begins = F.filter(F.sequence(F.lit(0), F.size(s)), lambda i: (i == 0) | (i == F.size(s)) | (F.get(s, i) != F.get(s, i - 1)))
    cut = rows.select(*named, "_s", begins.alias("_b"))
    each = cut.select(*named, "_s", "_b", F.posexplode(F.slice(b, 1, F.size(b) - 1)).alias("_run", "_from"))
    return each.select(*(F.col(n).alias(k) for k, n in zip(key, named)), F.get(s, F.col("_from")).alias("term"),
                       (F.get(b, F.col("_run") + 1) - F.col("_from")).cast("long").alias("tf"))


def term_counts(docs: DataFrame, key: Sequence[str], ngram_range: tuple[int, int] = (1, 1),
                stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """(key..., term, tf) for every document; ``key[0]`` is unique per document.

    A document is one row, so its terms are counted where it lies; neither texts nor single words move.
    """
    words = docs.select(*key, without_stop_words(tokens(F.col("text")), stop_words).alias("_words"))
    return _runs(words.select(*key, ngrams(F.col("_words"), *ngram_range).alias("_terms")), key, "_terms")


#: What stands for a term where only equality counts: two hashes, 128 bits.
TERM_ID = "struct<a:bigint,b:bigint>"


def term_id(term: Column) -> Column:
    return F.struct(F.xxhash64(term).alias("a"), F.xxhash64(F.lit(1), term).alias("b"))


def term_id_counts(docs: DataFrame, key: Sequence[str], ngram_range: tuple[int, int] = (1, 1),
                   stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """``term_counts`` with ids for terms: an n-gram's follows from that of its first n - 1 words and its last word.

    The texts of long n-grams are never written; ``term_ids`` has them where they are wanted.
    """
    words = docs.select(*key, without_stop_words(tokens(F.col("text")), stop_words).alias("_words"))
    ids = words.select(*key, F.transform("_words", term_id).alias("_ids"))
    return _runs(ids.select(*key, _rolled(F.col("_ids"), *ngram_range).alias("_terms")), key, "_terms")


def _rolled(words: Column, low: int, high: int) -> Column:
    """Ids of all runs of ``low`` to ``high`` words from the words' ids.

    Each length is bound to a lambda variable: written into the next ones it would be computed anew in each of them.
    """
    def longer(last: Column, n: int, found: list[Column]) -> Column:
        if n > high:
            return F.concat(*found)
        left = F.greatest(F.size(last) - 1, F.lit(0))
        runs = F.zip_with(F.slice(last, F.lit(1), left), F.slice(words, F.lit(n), left), _joined)
        return F.element_at(F.transform(F.array(runs), lambda x: longer(x, n + 1, [*found, x] if n >= low else found)), 1)
    return longer(words, 2, [words] if low == 1 else [])


def _joined(head: Column, word: Column) -> Column:
    return F.struct(F.xxhash64(head["a"], word["a"]).alias("a"), F.xxhash64(head["b"], word["b"]).alias("b"))


_PRIMES = tuple(np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def hashed(value: np.ndarray, seed: np.ndarray | np.uint64) -> np.ndarray:
    """Spark's xxhash64 of numbers of 64 bits, as uint64."""
    p1, p2, p3, p4, p5 = _PRIMES
    out = (seed + p5 + np.uint64(8)) ^ (_rotated(value * p2, 31) * p1)
    out = _rotated(out, 27) * p1 + p4
    out = (out ^ (out >> np.uint64(33))) * p2
    out = (out ^ (out >> np.uint64(29))) * p3
    return out ^ (out >> np.uint64(32))


def rolled(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, a, b) of all runs of ``low`` to ``high`` words, from the ids (uint64) of all words and the documents' numbers of them."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(a))  # words from here to the document's end
    at, heads, out, seed = np.arange(len(a)), (a, b), [], np.uint64(42)
    for n in range(1, high + 1):
        if n > 1:
            more = left[at] >= n
            at = at[more]
            heads = tuple(hashed(word[at + n - 1], hashed(head[more], seed)) for head, word in zip(heads, (a, b)))
        if n >= low:
            out.append((doc[at], *heads))
    return tuple(np.concatenate(x) for x in zip(*out))


def term_ids(docs: DataFrame, ngram_range: tuple[int, int] = (1, 1), stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """(id, term): the dictionary of the corpus, to be joined where terms are to be read."""
    words = docs.select(without_stop_words(tokens(F.col("text")), stop_words).alias("_words"))
    terms = words.select(F.explode(ngrams(F.col("_words"), *ngram_range)).alias("term")).distinct()
    parts = terms.select("term", F.transform(F.split("term", " "), term_id).alias("_ids"))
    first = F.element_at("_ids", 1)
    return parts.select(F.aggregate(F.slice("_ids", 2, F.size("_ids")), first, _joined).alias("id"), "term")


def idf(frequency: Column, n_docs: Column) -> Column:
    """Smooth inverse document frequency."""
    return F.ln((F.lit(1.0) + n_docs) / (F.lit(1.0) + frequency)) + F.lit(1.0)


def term_scale(tf: Column, sublinear_tf: bool) -> Column:
    return F.lit(1.0) + F.ln(tf.cast("double")) if sublinear_tf else tf.cast("double")


def tf_idf(counts: DataFrame, n_docs: Column, doc: str = "doc_id", sublinear_tf: bool = False) -> DataFrame:
    """Smooth inverse document frequency, optional 1 + ln(tf), each document scaled to length 1.

    The norm is a window per document: its rows are the distinct terms of one text, which
    one task already held when it split that text.
    """
    frequency = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    raw = counts.join(frequency, "term").withColumn("raw", term_scale(F.col("tf"), sublinear_tf) * idf(F.col("df"), n_docs))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy(doc)))
    return raw.withColumn("weight", F.col("raw") / length).drop("raw", "df", "tf")


def top_terms(docs: DataFrame, limit: int = 2000, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """The most frequent terms of a corpus with their frequency relative to the first."""
    words = docs.select(F.explode(terms_of(F.col("text"), (1, 1), stop_words)).alias("term"))
    counted = words.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    best = counted.orderBy(F.col("n").desc(), F.col("term").asc()).limit(limit)
    # The first of at most ``limit`` rows: the words are counted once.
    return best.withColumn("relative", F.col("n") / F.max("n").over(W.partitionBy(F.lit(0))))
