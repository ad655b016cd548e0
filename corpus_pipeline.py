"""The corpus pipeline: five stages from raw documents to packed training sequences.

Every stage takes what the stage before it kept, written as Parquet and read again. All but the
last return the columns of ``documents``; the last returns the packing (a row per piece).

Edge cases. A null or empty text fails the quality rules and goes there; given to a later stage it stays: it
links with nothing, holds no personal data, is never drawn but gets its source's certain copies, and packs as one
piece holding the end id. A null source is a source of its own. Rows that share an id, or have none, are judged
row by row; of equal rows the Jaccard stage keeps one. Ties go to the smaller id, then to the smaller columns.
Very long texts are read whole. An empty table gives an empty table; further columns pass through, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helixframe.llm import jaccard, mixing, packing, pii, quality_rules
from helixframe.llm.common import cut, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules or their host's verdict reject go."""
    return quality_rules.keep_good(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity of 0.8 or more."""
    return jaccard.keep_one(spark, docs, k=5, num=80, den=100)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind in brackets."""
    return pii.redact_documents(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.apply_mix(spark, docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their place in a sequence."""
    return packing.pack(spark, docs)


STAGES = [
    ("quality_rules", rules),
    ("ngram_jaccard_join", near_duplicates),
    ("pii", personal_data),
    ("mixing", mixture),
    ("best_fit_packing", packed),
]

#: Token ids and the packing have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(spark, docs, f"stage-{name}")
    return docs
