"""Document fingerprints by consistent weighted sampling (Ioffe 2010), with Spark expressions only.

A text's terms are its lower-case words, weighted by how often they come. For each of ``SAMPLES`` samples every
term draws r and c from the gamma distribution with shape 2 and b from [0, 1), always the same for a term and a
sample. With weight S, t = floor(ln S / r + b), and the term's value is c * exp(-r (t - b + 1)); the term with
the smallest value is the sample, together with its t. Two texts draw the same sample with a probability that equals
their generalised Jaccard similarity (the sum of the smaller weights over the sum of the larger). The value
follows from the term and t alone, so a sample is stored as 32 bits of the value's hash.

Samples whose numbers are equal modulo ``SHARED`` share c, which leaves that probability as it is for each of
them and saves most logarithms.

The samples of a text are minima over its exploded terms. Terms never travel: texts are dealt by their key once, and
all that follows is grouped by the same key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.operators.ranking import positions
from ratecraft.session import stored_copy

SAMPLES = 32
SHARED = 8
SEED = 7

#: What divides words, and the scripts that put no space between them: there every character is a word.
BETWEEN = r"[^\p{L}\p{M}\p{N}]+"
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"

_HALF = 1.0 / (1 << 32)


def _with_words(rows: DataFrame, kept: list[str]) -> DataFrame:
    """(*kept, _w): the words of ``text``; a text without any is one word as it is, the empty text too."""
    t = F.col("_t")  # one step after the other, as each result is used more than once
    wide = F.octet_length(t) > F.char_length(t)
    spaced = F.when(wide & F.rlike(t, F.lit(UNSPACED)), F.regexp_replace(t, UNSPACED, " $0 ")).otherwise(t)
    split = (rows.select(*kept, F.lower("text").alias("_t")).select(*kept, spaced.alias("_t"))
             .select(*kept, "_t", F.array_remove(F.split("_t", BETWEEN, -1), "").alias("_w")))
    return split.select(*kept, F.when(F.size("_w") > 0, F.col("_w")).otherwise(F.array("_t")).alias("_w"))


def _low(x: Column) -> Column:
    return (x.bitwiseAND(F.lit((1 << 32) - 1)) + F.lit(0.5)) * F.lit(_HALF)


def _high(x: Column) -> Column:
    return (F.shiftrightunsigned(x, 32) + F.lit(0.5)) * F.lit(_HALF)


def _value(term: str, log_weight: str, i: int) -> Column:
    """Logarithm of the value that a term draws for sample i."""
    draw = lambda n: F.xxhash64(term, F.lit(n))
    of_r, of_c, of_b = draw(4 * i + SEED), draw(4 * (i % SHARED) + SEED + 1), draw(4 * (i // 2) + SEED + 2)
    r = -F.ln(_low(of_r) * _high(of_r))  # the sum of two exponential draws
    log_c = F.ln(-F.ln(_low(of_c) * _high(of_c)))
    b = (_high if i % 2 else _low)(of_b)
    return log_c - r * (F.floor(F.col(log_weight) / r + b) - b + F.lit(1.0))


def sketches(texts: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """(*keys, sketch): the samples of each row's ``text``, as an array of numbers below 2^32.

    ``texts`` has the columns ``keys``, whose values tell its rows apart, and text, never null. An input that is already
    dealt by some of the keys is not shuffled again.
    """
    s, b = F.col("_s"), F.col("_b")
    named = [f"_k{i}" for i in range(len(keys))]  # whatever the keys are called
    rows = texts.select(*(F.col(f"`{k}`").alias(n) for k, n in zip(keys, named)), "text")
    # Equal words lie together once their hashes are sorted; _b has the places where another word begins, and the end.
    sorted_words = _with_words(rows, named).select(*named, F.sort_array(F.transform("_w", lambda w: F.xxhash64(w))).alias("_s"))
    begins = F.filter(F.sequence(F.lit(0), F.size(s)), lambda i: (i == 0) | (i == F.size(s)) | (F.get(s, i) != F.get(s, i - 1)))
    runs = sorted_words.select(*named, "_s", begins.alias("_b"))
    each = runs.select(*named, "_s", "_b", F.posexplode(F.slice(b, 1, F.size(b) - 1)).alias("_run", "_from"))
    terms = each.select(*named, F.get(s, F.col("_from")).alias("_term"),
                        F.ln((F.get(b, F.col("_run") + 1) - F.col("_from")).cast("double")).alias("_log"))
    least = terms.groupBy(*named).agg(*(F.min(_value("_term", "_log", i)).alias(f"_a{i}") for i in range(samples)))
    code = lambda i: F.xxhash64(f"_a{i}").bitwiseAND(F.lit((1 << 32) - 1))
    return least.select(*(F.col(n).alias(k) for k, n in zip(keys, named)), F.array(*map(code, range(samples))).alias("sketch"))


def likeness(a: str, b: str) -> Column:
    """Share of equal samples of two sketches: an estimate of the texts' generalised Jaccard similarity."""
    same = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda total, x: total + x) / F.size(a).cast("double")


def written(sketch: str) -> Column:
    """A sketch as a string, eight hexadecimal digits a sample."""
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(doc_id, fingerprint) for every row of ``docs`` (doc_id, text); other columns are not read.

    Null counts as an empty text; texts without words are one term as they are, so empty texts equal each other. Rows
    repeated stay repeated, ids may be null, and an empty table gives no row. Equal texts have equal fingerprints.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    marked = stored_copy(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    return sketches(marked, ["doc_id", "_row"], samples).select("doc_id", written("sketch").alias("fingerprint"))


_REPORT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edits_and_neighbours(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Every text's fingerprint beside those of its edited text and of the next document.

    Columns: doc_id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The next document is the one with the next smaller doc_id, for the last the first; the edited text
    has its last floor(n_chars / 2) code points replaced by the first as many of the next text (or all of it).

    ``docs`` has doc_id and text; other columns are not read. Null texts count as empty. Null ids come last, and rows of
    one id follow the hash of their text; rows that repeat id and text stand together at one place, and each of them is
    returned. An empty table gives no row. Texts as ``fingerprints``.
    """
    key = ["_m1", "_m2"]  # 128 bits name a row, its id included
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_m1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("_m2"))
    # The order is settled by ids alone; no text travels for it.
    names = rows.select("doc_id", *key, F.char_length("text").cast("long").alias("n_chars")).groupBy("doc_id", *key, "n_chars").agg(
        F.count(F.lit(1)).alias("_copies"))
    placed, n = positions(names, [F.col("doc_id").desc_nulls_last(), *map(F.col, key)], "_at")
    if not n:
        return docs.sparkSession.createDataFrame([], _REPORT)
    ahead = placed.select(((F.col("_at") + 1) % n).alias("_at"), F.col("_m1").alias("_to1"), F.col("_m2").alias("_to2"),
                          F.floor(F.col("n_chars") / 2).cast("int").alias("_wanted"))
    chain = stored_copy(placed.join(ahead, "_at"), "chain")
    # Texts are dealt by their key once; what a text needs of the next one is sent to it, half of its own length at most.
    texts = rows.groupBy(*key).agg(F.first("text").alias("text")).join(chain, key)
    heads = texts.select(F.col("_to1").alias("_m1"), F.col("_to2").alias("_m2"), F.expr("substring(text, 1, _wanted)").alias("_head"))
    half = F.floor(F.col("n_chars") / 2)
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")), F.col("_head"))
    both = texts.join(heads, key).select(*key, "doc_id", "n_chars", "_copies", "_at", "text", edited.alias("_edited"))
    kept = [*key, "doc_id", "n_chars", "_copies", "_at", "edited_sha256"]
    sides = both.select(*kept[:-1], F.sha2("_edited", 256).alias("edited_sha256"), F.explode(F.array(
        F.struct(F.lit(0).alias("_side"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("_side"), F.col("_edited").alias("text")))).alias("_x")).select(*kept, "_x._side", "_x.text")
    found = sketches(sides, [*kept, "_side"], samples)
    side = lambda i: F.max(F.when(F.col("_side") == i, F.col("sketch")))
    paired = found.groupBy(*kept).agg(side(0).alias("_own"), side(1).alias("_other"))
    paired = stored_copy(paired.drop(*key), "sketches")
    following = paired.select(((F.col("_at") + n - 1) % n).alias("_at"), F.col("_own").alias("_next"))
    rows = paired.join(following, "_at").withColumn("_each", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return rows.select("doc_id", "n_chars", "edited_sha256", written("_own").alias("fingerprint"), written("_other").alias("edited_fingerprint"),
                       likeness("_own", "_other").alias("near_edited"), likeness("_own", "_next").alias("near_next"))
