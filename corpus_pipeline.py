"""Documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rallymart.llm import language, packing, pii, simhash
from rallymart.llm.shared import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the classifier learns from these documents."""
    known = language.classify(docs.select(*COLUMNS), language.learn(docs))
    return known.where(~F.col("rejected")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links, the one with the smallest doc_id.

    Shingle length and distance are those of the operator: three words and two bits. Of rows with
    the same doc_id one stays; a group without any doc_id keeps nothing but one row.
    """
    return simhash.deduplicated(docs.select(*COLUMNS))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; n_chars follows the new text."""
    return pii.replace(docs.select(*COLUMNS)).select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("private_data", private_data),
    ("best_fit_packing", packed),
]

#: The stages need a trained classifier, xxHash and tokenizers, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
