"""From raw documents to packed training sequences: five operators, one after the other.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept and returns the
columns of ``docs``; the last returns the pieces of the packed sequences. ``run`` writes each stage's
result as Parquet to the shared folder and rereads it as the next one's ``docs``.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.checks.base import table
from gleanery.llm import langid, packing, quality, secrets, simhash
from gleanery.llm.common import unused, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is unknown or not clear go."""
    into = unused(docs, "_language")
    found = langid.with_language(docs, langid.train(docs), into)
    return found.where(F.col(into)["accepted"]).select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifiers score as bad go."""
    into = unused(docs, "_quality")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.with_quality(docs, model, into).where(F.col(into)["accepted"]).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id."""
    return simhash.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; a mask replaces the secrets in their texts, and ``n_chars`` follows."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language", language),
    ("good_quality", good_quality),
    ("simhash_dedup", simhash_dedup),
    ("without_secrets", without_secrets),
    ("packed", packed),
]

#: SQL has no compression, training or tokenizer; the tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
