"""A training corpus from raw documents: five stages, each on all that the one before it kept.

Every stage reads what its predecessor wrote and returns the columns of `documents`; the last one
returns the encoded documents. Documents appear twice in the mix where their source is taken twice.

Defined results: texts that are null or have no letter go with the first stage; of equal texts, and of near-duplicates, the
smallest doc_id stays, so ties and repeated rows leave one; very long texts are taken whole; a null source is a source of its
own; other columns are kept up to the mix and may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from graftline.llm import exact_dedup, language_id, mixing, near_dedup, sentence_pieces
from graftline.llm.common import table, written


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with a score of one half or more stay."""
    return language_id.accepted(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays."""
    return exact_dedup.exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (5-word shingles, similarity of 0.8) the smallest doc_id stays."""
    return near_dedup.near_dedup(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document."""
    return sentence_pieces.encode_pieces(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("sentence_pieces", encoding_stage),
]

#: SQL can't express language ID and encoding; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
