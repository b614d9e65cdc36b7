"""From raw documents to packed training sequences, stage after stage.

Every stage reads what the one before has written and returns the columns of ``documents``; the last returns
the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm import decontaminate, langid, packing, secrets, simhash
from ratecraft.llm.common import DOCUMENT, table
from ratecraft.llm.queries import tokenizer_path
from ratecraft.session import configure, stored_copy


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.col(c) for c in DOCUMENT))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are far from every learnt language go, and those without a letter: null and empty texts too.

    Repeated rows stay or go together; no document gives no row.
    """
    docs = _documents(docs)
    return langid.keep_known(docs, langid.fit(langid.training_rows(docs)))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints (three-word shingles, three bits at most) the one with the smallest id stays.

    Null texts count as empty, and empty texts are copies of each other; of rows that share an id one stays, and a null id
    stays only where its group has no other. No document gives no row.
    """
    return simhash.keep_one(_documents(docs))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a test item go; null and empty texts hold none and stay, as do all rows without items."""
    return decontaminate.keep_clean(_documents(docs), table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, null texts and repeated rows too; secrets in their texts are replaced by a mark."""
    docs = _documents(docs)
    return secrets.redact(docs, secrets.fit(docs))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences; null and empty texts are one closing token each."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", known_language),
    ("simhash_near_dedup", one_of_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("packing", packed_sequences),
]

#: Centroids, edit distances and Markov models have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; each stage is written to the shared folder and reread."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored_copy(stage(spark, docs, sf_dir), name)
    return docs
