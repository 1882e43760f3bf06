"""From raw documents to packed sequences: five stages of corpus operators, each over all that the one before kept."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trailmark.llm import mixing, packing, quality_rules, secrets, simhash  # noqa: E402
from trailmark.llm._shared import cut, table  # noqa: E402
from trailmark.llm.queries import MIX, domains, tokenizer_path  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects; see ``quality_rules.keep`` for nulls, ties, repeats and names."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each class of near-duplicates: a similarity of 0.8 of the five-word shingles.

    See ``simhash.keep_one`` for nulls, ties, repeats and names.
    """
    return simhash.keep_one(docs, shingle=5, least=0.8)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets masked; n_chars, where there is one, follows. See ``secrets.redact`` for nulls and repeats."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents thinned out to the target shares of clean, low and toxic text; see ``mixing.resample`` for nulls and repeats."""
    return mixing.resample(docs, domains(table(spark, sf_dir, "labels")), MIX, anchor="clean")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 4096 tokens; see ``packing.pieces`` and ``packing.pack``."""
    rows = packing.pack(packing.pieces(docs, tokenizer_path()))
    return rows.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

#: SimHash and the tokenizer can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as Parquet and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
