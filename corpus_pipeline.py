"""From raw documents to token ids: language, near duplicates, benchmark passages, personal data, tokens.

Each stage gets what the one before kept, as a Parquet table, and returns the columns of `documents`; the last one
returns token ids. An empty table passes all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, jaccard, language, pii
from millrace.llm.common import prepare, table
from millrace.session import materialize


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those that are `und` (null text or no letter) go."""
    prepare(spark)
    model = language.fit(docs.where(~language.held_out(docs)))
    return language.identify(docs, model).where(F.col("lang_pred") != language.UNKNOWN).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; one without an id only if none has one.

    Groups are of texts: different texts that nothing links all stay, also with the same id or without any. Rows with
    the same id and the same shingles become one row, that with the smallest text.
    """
    prepare(spark)
    return jaccard.first_of_each_group(docs)


def no_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind; n_chars follows the text."""
    prepare(spark)
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and token_ids of every document."""
    prepare(spark)
    encoded = bpe.encode(docs, bpe.VOCABULARY, keep=["doc_id", "lang", "source"])
    return encoded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("language", known_language),
    ("near duplicates", one_of_each_group),
    ("benchmark passages", no_benchmark_passages),
    ("personal data", no_personal_data),
    ("tokens", tokens),
]

# Models, components and tokens are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
