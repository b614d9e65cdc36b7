"""Secret scan with DataFrame expressions only.

Three base patterns give spans of the kinds assign, access and hex. What lies outside of them is cut into runs of ASCII
letters, digits and ``+``. Every run of ``LEAST`` characters or more, pure numbers aside, is judged by two first-order Markov models over
characters, one of random strings and one of ordinary identifiers: where the log-likelihood ratio of the two
reaches ``FIXED`` and ``PER_CHARACTER`` for each character, the run becomes a span of the kind random. A key glued to a path or a name by
``/ = _ -`` is a run of its own. Both models are learnt from labelled samples of the documents: what the base
patterns find, and the shorter runs around.

Positions come from splitting: the lengths of the texts between matches and of the matches add up to
the places of the matches, in code points. All steps are in proportion to the text; running totals over n
matches cost n * sqrt(n).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import hash_share

#: The base patterns, by kind, in the order that breaks ties of spans with equal starts.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LEAST = 8

#: Runs that the Markov models judge; the shortest length.
LEAST = 16
RUN = rf"[A-Za-z0-9+]{{{LEAST},}}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+"
#: A run is random if its log-likelihood ratio is at least so much, and so much for each of its characters.
FIXED, PER_CHARACTER = 8.0, 1.0
#: Pseudo-counts with which ordinary text falls back on single characters.
BACKOFF = 20.0
#: Bounds of the labelled samples: documents for ordinary words, and documents with base spans.
WORD_DOCS, SECRET_DOCS = 4_000, 20_000
MARK = "[secret]"
#: Characters of a chunk: a piece of a text is cut from the chunks it touches, not counted from the text's start.
CHUNK = 8192

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, zero: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each place the total of the values before it: of whole blocks first, then within its block of sqrt(n)."""
    total = lambda part: F.aggregate(part, zero, join)

    def of(v: Column) -> Column:
        n = F.size(v)
        step = F.ceil(F.sqrt(n.cast("double"))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(n / step).cast("int") - 1), lambda b: total(F.slice(v, b * step + 1, step)))
        heads = _let(blocks, lambda t: F.transform(F.sequence(F.lit(0), F.size(t) - 1), lambda b: total(F.slice(t, F.lit(1), b))))
        each = _let(heads, lambda h: F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.aggregate(
            F.slice(v, i - i % step + 1, i % step), F.get(h, F.floor(i / step).cast("int")), join)))
        return F.when(n > 0, each).otherwise(F.slice(v, 1, 0))
    return _let(values, of)


def matches(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Spans of a pattern: start, kind, end, token; where ``group`` is shorter than ``least`` the span is dropped."""
    size = lambda x: F.char_length(x)
    gaps = F.transform(F.split(text, pattern, -1), size)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), size) if group else F.transform(whole, size)
    zipped = F.arrays_zip(whole.alias("token"), part.alias("part"), gaps.alias("gap"))  # the last gap has no match

    def spans(z: Column) -> Column:
        widths = F.transform(z, lambda x: x["gap"] + F.coalesce(F.char_length(x["token"]), F.lit(0)))
        placed = F.zip_with(z, running(widths, F.lit(0), lambda a, b: a + b), lambda x, before: F.struct(
            (before + x["gap"]).alias("start"), F.lit(kind).alias("kind"), (before + x["gap"] + F.char_length(x["token"])).alias("end"),
            x["token"].alias("token"), x["part"].alias("part")))
        return F.filter(placed, lambda x: x["token"].isNotNull() & (x["part"] >= least))

    found = F.transform(_let(zipped, spans), lambda x: F.struct(x["start"], x["kind"], x["end"], x["token"]))
    return F.when(F.rlike(text, F.lit(pattern)), found)


def _places(found: Column) -> Column:
    none = F.array().cast(_SPAN)
    return F.coalesce(F.transform(found, lambda x: F.struct(x["start"], x["kind"], x["end"])), none)


def _outside(text: str, spans: str, mark: Callable[[Column], Column]) -> Column:
    """The text with the union of its spans replaced: ``mark`` gets a stretch's length. Touching spans are two stretches."""
    def cut(chunks: Column, at: Column, n: Column) -> Column:
        first, last = F.floor(at / CHUNK).cast("int"), F.floor((at + n) / CHUNK).cast("int")
        return F.substring(F.array_join(F.slice(chunks, first + 1, last - first + 1), ""), at - first * CHUNK + 1, n)

    ends = F.transform(spans, lambda s: s["end"])
    reach = running(ends, F.lit(0), lambda a, b: F.greatest(a, b))
    # A stretch begins where a span starts at or behind all that came before.
    opened = F.filter(F.zip_with(spans, reach, lambda s, m: F.struct(s["start"].alias("start"), m.alias("before"))), lambda x: x["start"] >= x["before"])

    def joined(chunks: Column) -> Column:
        def of(o: Column) -> Column:
            end = lambda i: F.coalesce(F.get(o, i + 1)["before"], F.array_max(ends))
            parts = F.transform(o, lambda x, i: F.concat(cut(chunks, x["before"], x["start"] - x["before"]), mark(end(i) - x["start"])))
            rest = cut(chunks, F.array_max(ends), F.char_length(text) - F.array_max(ends))
            return F.concat(F.array_join(parts, ""), rest)
        return _let(opened, of)

    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, _let(chunks, joined)).otherwise(F.col(text))


def base_spans(docs: DataFrame) -> DataFrame:
    """(row, text, base): each row as one value, its text, never null, and the base spans by start, then kind."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    access = F.when(F.contains("text", F.lit("AKIA")), matches(F.col("text"), ACCESS, 1))
    found = rows.select("row", "text", matches(F.col("text"), ASSIGN, 0, 2, ASSIGN_LEAST).alias("a"), access.alias("b"),
                        matches(F.col("text"), HEX, 2).alias("c"))
    return found.select("row", "text", F.array_sort(F.concat(*(_places(F.col(c)) for c in "abc"))).alias("base"))


def _characters(token: Column) -> Column:
    """The token's characters with their predecessors (a space in front of the first), as structs of before and own."""
    def pairs(c: Column) -> Column:
        return F.zip_with(F.concat(F.array(F.lit(" ")), F.slice(c, 1, F.size(c) - 1)), c, lambda a, b: F.struct(a.alias("before"), b.alias("own")))
    return _let(F.regexp_extract_all(token, F.lit("."), F.lit(0)), pairs)


def fit(docs: DataFrame, word_docs: int = WORD_DOCS, secret_docs: int = SECRET_DOCS) -> list[float]:
    """Log-likelihood ratios, random over ordinary, of each character after each other one (or none).

    Random strings: runs in access and hex spans and in the values of assignments, from about ``secret_docs`` of the
    documents that have any. Ordinary identifiers: runs of the other text of about ``word_docs`` documents, but for those long
    enough to be judged. Null texts teach nothing; repeated rows count as often as they come. An empty table
    gives ratios of two models that know nothing. One pass counts the documents, one reads the samples.
    """
    docs = docs.select("doc_id", "text").filter("text is not null")
    has = F.rlike("text", F.lit(f"(?:{ACCESS}|{HEX})")) | F.rlike("text", F.lit(ASSIGN))
    n, m = docs.agg(F.count(F.lit(1)), F.count_if(has)).first()
    teaches = hash_share(["doc_id", "text"], word_docs / max(1, n))
    shows = hash_share(["doc_id", "text"], secret_docs / max(1, m)) & has
    every = lambda pattern, group=0: F.regexp_extract_all("text", F.lit(pattern), F.lit(group))
    values = F.filter(F.concat(every(ASSIGN, 2), every(ACCESS), every(HEX)), lambda v: (F.char_length(v) >= ASSIGN_LEAST) & F.rlike(v, F.lit("[0-9]")))
    runs = F.flatten(F.transform(values, lambda v: F.regexp_extract_all(v, F.lit("[A-Za-z0-9+]+"), F.lit(0))))
    rest = F.regexp_extract_all(F.regexp_replace("text", f"{ACCESS}|{HEX}|{ASSIGN}", " "), F.lit("[A-Za-z0-9+]{4,}"), F.lit(0))
    ordinary = F.filter(rest, lambda w: F.char_length(w) < LEAST)
    kinds = lambda tokens, random: F.transform(tokens, lambda t: F.struct(F.lit(random).alias("random"), t.alias("token")))
    none = F.array().cast("array<struct<random:boolean,token:string>>")
    tokens = docs.filter(teaches | shows).select(F.explode(F.concat(
        F.when(shows, kinds(runs, True)).otherwise(none), F.when(teaches, kinds(ordinary, False)).otherwise(none))).alias("t"))
    # Equal words first: few are different. What comes to the driver are counts of character pairs, (alphabet + 1)^2 twice at most.
    words = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    pairs = words.select("t.random", "n", F.explode(_characters(F.col("t.token"))).alias("p"))
    counted = pairs.groupBy("random", F.concat("p.before", "p.own").alias("pair")).agg(F.sum("n").alias("n")).collect()
    random, plain = (_model({r.pair: r.n for r in counted if r.random == kind}, backoff) for kind, backoff in ((True, None), (False, BACKOFF)))
    return [round(math.log(x) - math.log(y), 5) for x, y in zip(random, plain)]


def _model(counts: dict[str, int], backoff: float | None) -> list[float]:
    """Probabilities of each character after each other one (or none), all above 0.

    Ordinary text falls back on its single characters, by ``backoff`` pseudo-counts; random strings, of which
    few may be known, on even chances for half of the weight.
    """
    single = [1 + sum(counts.get(before + c, 0) for before in " " + ALPHABET) for c in ALPHABET]
    out = []
    for before in " " + ALPHABET:
        n = [counts.get(before + c, 0) for c in ALPHABET]
        if backoff is None:
            out += [0.5 * (x + 1) / (sum(n) + len(n)) + 0.5 / len(n) for x in n]
        else:
            out += [(x + backoff * s / sum(single)) / (sum(n) + backoff) for x, s in zip(n, single)]
    return out


def log_ratio(token: Column, ratios: list[float]) -> Column:
    """Sum of the ratios over the token's characters; the table is one constant array."""
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
    place = lambda c: F.instr(F.lit(ALPHABET), c)  # noqa: E731  1-based; 0 for the space in front
    value = lambda p: F.element_at(table, place(p["before"]) * len(ALPHABET) + place(p["own"]))
    return F.aggregate(_characters(token), F.lit(0.0), lambda total, p: total + value(p))


def scan(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """(row, text, base, spans): as ``base_spans``, and all spans by start, then kind. A random span overlaps no base span."""
    # Base spans are blanked, so that what is left around them is judged on its own.
    open_text = base_spans(docs).select("row", "text", "base", _outside("text", "base", lambda n: F.repeat(F.lit(" "), n)).alias("open"))
    with_runs = open_text.select("row", "text", "base", matches(F.col("open"), RUN, 3).alias("runs"))
    random = lambda x: F.rlike(x["token"], F.lit("[A-Za-z]")) & (log_ratio(x["token"], ratios) >= FIXED + PER_CHARACTER * F.char_length(x["token"]))
    more = F.when(F.col("runs").isNotNull(), F.array_sort(F.concat("base", _places(F.filter("runs", random)))))
    return with_runs.select("row", "text", "base", F.coalesce(more, F.col("base")).alias("spans"))


def listed(spans: str) -> Column:
    """``kind:start:end``, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def report(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans.

    ``docs`` has doc_id and text; other columns are not read. Null and empty texts have no span; their
    base_sha256 is that of an empty string. Rows repeated stay repeated; an empty table gives no row.
    """
    found = scan(docs.select("doc_id", "text"), ratios)
    number = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("row.doc_id", *[number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                        F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def redact(docs: DataFrame, ratios: list[float], mark: str = MARK) -> DataFrame:
    """``docs`` (any columns, among them text and n_chars) with every span's text replaced by ``mark``.

    Overlapping spans are replaced together. Texts without a span stay as they are (null too); where a text
    changes, n_chars follows it. Rows travel as one value, so no name of theirs can clash. All rows stay, repeated ones too;
    an empty table gives no row.
    """
    changed = scan(docs, ratios).select("row", (F.size("spans") > 0).alias("hit"), _outside("text", "spans", lambda n: F.lit(mark)).alias("clean"))
    new = {"text": F.when(F.col("hit"), F.col("clean")).otherwise(F.col("row.text")),
           "n_chars": F.when(F.col("hit"), F.char_length("clean").cast("long")).otherwise(F.col("row").getField("n_chars") if "n_chars" in docs.columns else F.lit(None))}
    return changed.select(*((new[c] if c in new else F.col("row").getField(c)).alias(c) for c in docs.columns))
