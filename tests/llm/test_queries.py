import re

import __spark_entry__ as entry
import corpus_pipeline
import duckdb
import pytest
from brute import base_spans, components, edit_distance, fingerprint

from ratecraft.llm import decontaminate, langid, packing
from ratecraft.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def plain(value):
    return str(round(value, 6)) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", ORACLES)
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    found = con.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    got = QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(columns)
    want = sorted(tuple(map(plain, r)) for r in found.fetchall())
    assert sorted(tuple(map(plain, r)) for r in got.select(*columns).collect()) == want


def test_all_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14)) and "pipeline" in entry.queries()
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]


def test_every_query_returns_its_documents(spark):
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    for name in QUERIES:
        if name.split("_")[0] in ("op2", "op3", "op5", "op8", "op10", "op11"):
            assert sorted(r.doc_id for r in QUERIES[name](spark, FOLDER).collect()) == ids, name
    packed = QUERIES["op1_harmonic_packing"](spark, FOLDER)
    assert sorted({r.doc_id for r in packed.collect()}) == ids


def test_pipeline_against_brute_force(spark):
    docs = sorted(spark.read.parquet(f"{FOLDER}/documents.parquet").collect(), key=lambda r: r.doc_id)
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    far = {r.doc_id for r in langid.predict(table, langid.fit(langid.training_rows(table))).filter("rejected").collect()}
    docs = [r for r in docs if r.doc_id not in far]
    label = components([fingerprint(r.text or "") for r in docs])
    docs = [r for i, r in enumerate(docs) if label[i] == i]
    items = [p for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect() for p in decontaminate.passages(decontaminate.folded(r.text))]
    # An exact piece is left wherever a passage is within its budget: the text around is enough to compare.
    cut = [(piece, p, decontaminate.budget(p)) for p in items for _, piece in decontaminate.pieces(p, decontaminate.budget(p))]

    def leaks(text):
        text = decontaminate.folded(text)
        return any(edit_distance(p, text[max(0, m.start() - 130):m.start() + 130]) <= errors
                   for piece, p, errors in cut if piece in text for m in re.finditer(re.escape(piece), text))
    docs = [r for r in docs if not leaks(r.text or "")]
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in found} == {r.doc_id for r in docs}
    words = packing.WordIds(packing_file())
    tokens = {r.doc_id: r.doc_tokens for r in found}
    for r in docs:
        if not base_spans(r.text or ""):  # texts without secrets come through as they were
            assert tokens[r.doc_id] == len(words.of(r.text or "")) // 4 + 1
    assert sum(r.length for r in found) == sum(tokens.values())


def packing_file():
    from ratecraft.llm.queries import tokenizer_path
    return tokenizer_path()


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (docs, docs.limit(0)):
            assert stage(spark, rows, FOLDER).columns == docs.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).collect() == []
