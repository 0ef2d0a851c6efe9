"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. Each works on everything its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statmart.llm import mixing, ngram_join, pieces, pii, toxicity
from statmart.llm.common import table
from statmart.session import materialize


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are predicted toxic."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return ngram_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by its kind in brackets."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that each source's words come to its target."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mixed documents, with their next best segmentations."""
    return pieces.encode(docs)


STAGES = [("toxicity", toxic_documents), ("ngram_jaccard", near_duplicates), ("personal_data", personal_data),
          ("source_mixing", source_mix), ("sentencepiece", encoded)]

#: SQL can't express the learnt stages; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
