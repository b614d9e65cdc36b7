"""The operators as named queries over the test tables, with their SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm import (
    balltree, chat, decontaminate, langid, negatives, packing, quality, secrets, simhash, topk, toxicity, warc, weighted,
)
from ratecraft.llm.common import held_out, table
from ratecraft.session import configure, new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(configure(spark), folder)
        if sql is not None:
            ORACLES[name] = sql
        return build
    return register


def tokenizer_path() -> str:
    from public_tokenizers import path

    return path("word_bpe_49k.json")


@query("op1_harmonic_packing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


@query("op2_kneser_ney_quality")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    trusted = table(spark, folder, "labels").filter("quality = 1")
    return quality.judge(table(spark, folder, "documents"), trusted)


@query("op3_string_kernel_toxicity")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs.filter(~held_out()), table(spark, folder, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query("op4_chat_formatting", """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
near AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
written AS (
  SELECT *, replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lb;'), '|', '&bar;') AS r,
         replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lb;'), '|', '&bar;') AS t FROM near)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(t) + CASE WHEN before IS NOT DISTINCT FROM role THEN 3 ELSE length(r) + 4 END
                + CASE WHEN after IS NOT DISTINCT FROM role THEN 0 ELSE 4 END) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id""")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    same = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), same.alias("text"))
    return chat.digest(chat.format_conversations(rows.unionByName(extra)))


@query("op5_secret_scan")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return secrets.report(docs, secrets.fit(docs))


@query("op6_exact_top_k", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) t
WHERE rank <= 10""")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk.search(vectors, vectors.filter("vec_id % 100 = 0"))


@query("op7_warc_reassembly", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
f AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f""")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), path)
    return warc.pages_of(warc.read_archives(spark, path))


@query("op8_simhash_near_duplicates")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op9_benchmark_decontamination")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op10_language_id")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = langid.predict(docs, langid.fit(langid.training_rows(docs)))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query("op11_weighted_fingerprints")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return weighted.edits_and_neighbours(table(spark, folder, "documents"))


@query("op12_bond_hard_negatives", """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
positives AS (
  SELECT * FROM (
    SELECT a.r, a.vec_id AS anchor_id, a.label, a.e, b.vec_id AS positive_id, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS positive_score,
           row_number() OVER (PARTITION BY a.r ORDER BY list_inner_product(a.e, b.e) DESC, b.vec_id) AS place
    FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0) t WHERE place <= 5),
scored AS (
  SELECT p.r, p.place, p.anchor_id, p.positive_id, c.vec_id AS negative_id, p.positive_score, CAST(list_inner_product(p.e, c.e) AS BIGINT) AS negative_score
  FROM positives p JOIN v c ON p.label <> c.label AND len(p.e) = len(c.e))
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT *, row_number() OVER (PARTITION BY r, place ORDER BY negative_score DESC, negative_id) AS rank FROM scored
  WHERE 50 * positive_score <= 100 * negative_score AND 100 * negative_score <= 95 * positive_score) t
WHERE rank <= 3""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").withColumn("label", moved)
    return negatives.mine(vectors, F.col("vec_id") % 50 == 0)


@query("op13_ball_tree_search", r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n_docs, sum(len(t)) AS n_terms FROM d WHERE len(t) > 0),
held AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d) u GROUP BY r, doc_id, n, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, s GROUP BY term),
i AS MATERIALIZED (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark WHERE text IS NOT NULL),
asked AS (SELECT DISTINCT q, item_id, term FROM (SELECT q, item_id, unnest(t) AS term FROM i) u),
scored AS (
  SELECT q, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms))))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN w USING (term), s GROUP BY q, item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) t
WHERE rank <= 10""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return balltree.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
