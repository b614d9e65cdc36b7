import hashlib
import random
import time

from brute import base_spans, markov_ratios, random_spans, words
from hypothesis import given, settings
from hypothesis import strategies as st

from ratecraft.llm import secrets

SCHEMA = "doc_id long, text string, spans string, row string, n_chars long, base string, _whole string"
HEXES = "0123456789abcdef"
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def drawn(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


def documents(rng):
    odd = ["secret: token = abcdefgh1", "TOKEN='x' Api_Key\": \"abc/def+123=\"", "apikey=short", "AKIAAKIA1234", "AKIA" + "A" * 12 + "b" * 40,
           "password==12345678 é password : ünder", "ſecret=12345678901", "𝔘𝔘 token=12345678,secret=abcdefghij", "passwd:" + "0" * 33, "a" * 31 + "g" + "f" * 32,
           "$1 \\ token=aaaaaaaa$", "", None, " ", "token=aaaaaaaa" * 40, "secrettoken=" + "9" * 64]  # 16 texts
    texts = odd + [words(rng, 40) for _ in range(20)]
    texts += [f"{words(rng, 9)} key {drawn(rng, LETTERS, 40)} {words(rng, 5)}" for _ in range(20)]
    texts += [f"{words(rng, 5)} token = {drawn(rng, HEXES, 40)}, {words(rng, 5)} AKIA{drawn(rng, LETTERS[26:], 16)}" for _ in range(40)]
    return texts


def listed(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


def test_report_and_redact(spark):
    texts = documents(random.Random(6))
    rows = [(i, t, "x", "y", len(t) if t else None, "b", "w") for i, t in enumerate(texts)]
    rows += [(0, texts[0], "", "", 3, "", ""), (None, texts[0], "", "", 3, "", "")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    ratios = secrets.fit(df)
    found = secrets.report(df, ratios).collect()
    assert len(found) == len(rows)
    for r in found:
        text = texts[r.doc_id or 0] or ""
        base = base_spans(text)
        assert listed(base) == ",".join(s for s in r.spans.split(",") if not s.startswith("random"))
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[3] == k for s in base) for k in ("assign", "access", "hex"))
    # Random strings that no base pattern names are found; ordinary words are left alone.
    random_in = {r.doc_id for r in found if r.n_random}
    assert set(range(36, 56)) <= random_in and not random_in & set(range(16, 36))
    clean = secrets.redact(df, ratios)
    assert clean.schema == df.schema
    assert {(r.spans, r.row, r.base) for r in clean.collect()} == {("x", "y", "b"), ("", "", "")} and {r._whole for r in clean.collect()} == {"w", ""}
    for r in clean.collect():
        text = texts[r.doc_id or 0]
        spans = [s for s in next(f.spans for f in found if f.doc_id == r.doc_id).split(",") if s]
        if not spans:
            assert r.text == text
            continue
        hidden = set()
        for s in spans:
            _, a, b = s.split(":")
            hidden |= set(range(int(a), int(b)))
        shown = [c if i not in hidden else "\0" for i, c in enumerate(text)]
        kept = "".join(c for c in shown if c != "\0")
        assert r.text.replace(secrets.MARK, "") == kept and r.n_chars == len(r.text)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("tokenTOKEN=:'\" 0aAKI_-é", max_size=60), max_size=12))
def test_base_spans_of_any_text(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in secrets.base_spans(df).select("row.doc_id", secrets.listed("base").alias("spans")).collect():
        assert r.spans == listed(base_spans(texts[r.doc_id]))


def test_empty_table_and_native_plan(spark, capsys):
    df = spark.createDataFrame([], SCHEMA)
    ratios = secrets.fit(df)
    assert set(ratios) == {0.0}
    for out in (secrets.report(df, ratios), secrets.redact(df, ratios)):
        assert out.collect() == []
        out.explain()
        assert "Python" not in capsys.readouterr().out


def test_random_spans_against_a_plain_model(spark):
    """Every span of the kind random, by models and positions computed one character at a time."""
    rng = random.Random(11)
    keys = [drawn(rng, LETTERS[:52], 24) for _ in range(6)] + [drawn(rng, LETTERS, 16) for _ in range(6)]
    texts = documents(rng) + [f"see /srv/{k}/house_{k}-{words(rng, 2)}= {k} 4929123412341234" for k in keys]
    texts += [f"{drawn(rng, LETTERS, 40)}{drawn(rng, HEXES, 32)}_{drawn(rng, LETTERS, 20)}" for _ in range(6)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    ratios = secrets.fit(df)
    plain = markov_ratios([t or "" for t in texts])
    assert max(abs(a - b) for a, b in zip(ratios, plain)) < 1e-4
    for r in secrets.report(df, ratios).collect():
        text = texts[r.doc_id] or ""
        assert r.spans == listed(sorted(base_spans(text) + random_spans(text, ratios))), text
    # Keys of letters alone or of 16 characters, behind a path, in a name, or beside a base span.
    found = {r.doc_id: r.n_random for r in secrets.report(df, ratios).collect()}
    first = len(texts) - 18
    assert [found[first + i] for i in range(12)] == [3] * 12 and all(found[first + 12 + i] >= 1 for i in range(6))


def test_very_long_texts(spark):
    """One run of a million characters, and very many spans, in linear time."""
    rng = random.Random(3)
    long = drawn(rng, LETTERS, 1_000_000)
    many = " ".join(f"token={drawn(rng, LETTERS, 9)} é" for _ in range(16_000))
    df = spark.createDataFrame([(1, long), (2, many), (3, "word " * 200_000)], "doc_id long, text string")
    ratios = secrets.fit(spark.createDataFrame([(i, t) for i, t in enumerate(documents(rng))], "doc_id long, text string"))
    begin = time.time()
    found = {r.doc_id: r for r in secrets.report(df, ratios).collect()}
    clean = {r.doc_id: r.text for r in secrets.redact(df, ratios).collect()}
    assert time.time() - begin < 60
    assert found[1].spans == "random:0:1000000" or found[1].n_hex and found[1].n_random
    assert found[2].n_assign == 16_000 and clean[2] == " ".join([f"{secrets.MARK} é"] * 16_000)
    assert clean[3] == "word " * 200_000
