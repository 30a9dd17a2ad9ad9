"""A training-data pipeline over ``documents``: each stage works on what its
predecessor kept and returns the columns of documents; the last returns tokens.

Defined results: nulls, empty texts, repeated rows, empty tables and further
columns are handled as each operator states; columns a stage does not read pass
through unchanged."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import bpe, exact_dedup, jaccard_join, mixing, toxicity
from tideline.llm.common import read, saved


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays."""
    return jaccard_join.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document of the mix: doc_id, source, ids, n_tokens and whether
    decoding the ids gives the text again."""
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                       ["doc_id", "source", "text"], with_bytes=True)
    return coded.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
                        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [("toxicity", clean), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixed), ("byte_bpe", tokens)]
#: Toxicity and near duplicates can't be expressed in SQL; tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
