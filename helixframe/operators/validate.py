"""Validation counters; partial and final aggregation are Spark's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contracts as C


def violations(df: DataFrame, vocabulary: dict = C.VOCABULARY) -> DataFrame:
    """Rows per column outside its vocabulary; null counts."""
    return df.agg(*[F.count_if(~F.coalesce(F.col(c).isin(*v), F.lit(False))).alias(c) for c, v in vocabulary.items() if c in df.columns])


def null_counts(df: DataFrame, required=C.REQUIRED) -> dict[str, int]:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first().asDict()
    return {c: n for c, n in row.items() if n}


def boundary_pairs(df: DataFrame, begin: str, end: str, valid=C.BOUNDARY_PAIRS) -> DataFrame:
    """Distribution of begin/end pairs; null is written None. ``matched`` marks valid pairs."""
    b, e = (F.coalesce(F.col(c), F.lit("None")) for c in (begin, end))
    ok = F.lit(False)
    for x, y in valid:
        ok = ok | ((b == x) & (e == y))
    return df.groupBy(F.concat_ws("/", b, e).alias("pair"), ok.alias("matched")).agg(F.count(F.lit(1)).alias("n"))


def summary(df: DataFrame) -> DataFrame:
    """One row of counters over sequences, coordinates and tokens."""
    seq, n = F.coalesce("sequence", F.lit("")), F.length(F.coalesce("sequence", F.lit("")))
    some = n > 0
    clean = some & seq.rlike("^[ACGT]+$")
    start, end = (F.col(c).cast("string").try_cast("double") for c in ("start", "end"))
    negative = F.coalesce((start < 0) | (end < 0), F.lit(True))
    out = df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(~some).alias("empty_sequences"), F.count_if(clean).alias("clean_sequences"),
        F.count_if(some & ~seq.rlike("^[ACGTNRYSWKMBDHV-]*$")).alias("bad_alphabet"), F.min(F.when(some, n)).cast("bigint").alias("min_length"),
        F.max(F.when(some, n)).cast("bigint").alias("max_length"), F.coalesce(F.sum(n), F.lit(0)).alias("total_bases"), F.count_if(negative).alias("negative_coordinates"),
        F.count_if(F.coalesce(start >= end, F.lit(False))).alias("inverted_coordinates"), F.count_if(~F.col("begin_of_sequence").eqNullSafe(F.lit("<s>"))).alias("invalid_begin"),
        F.count_if(~F.col("end_of_sequence").eqNullSafe(F.lit("</s>"))).alias("invalid_end"), F.count_if(F.col("gene_type").isNull()).alias("null_gene_type"), F.count_if(some).alias("_some"),
        F.round(F.avg(F.when(some, n)), 1).alias("mean_length"),
    )
    return out.withColumn("clean_percent", F.round(100.0 * F.try_divide("clean_sequences", "_some"), 2)).drop("_some")
