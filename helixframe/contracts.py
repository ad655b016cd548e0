"""Schemas, vocabularies and checks at stage boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns of the tables, in their order.
KEY = ("record_id", "start", "end")
_TEXT = (
    "begin_of_sequence", "end_of_sequence", "begin_of_gene", "end_of_gene", "gene_type", "species_type",
    "strand", "sequence", "molecule_type", "topology", "taxonomy", "record_id",
)
RAW = T.StructType([T.StructField(c, T.StringType()) for c in _TEXT] + [T.StructField(c, T.LongType()) for c in ("start", "end")])
REQUIRED = ("record_id", "sequence", "taxonomy", "strand", "start", "end")
TOKENIZED = (*KEY, "token_ids", "token_mask", "token_length")
EMBEDDING = (*KEY, "embedding", "embedding_norm")
LIKELIHOOD = (
    *KEY, "mean_log_prob", "sum_log_prob", "perplexity", "supervised_position_count",
    "min_token_logprob", "argmin_position", "per_token_logprob_std",
)
#: Categorical vocabularies, alphabets, lineage roots, row tiers, length limits.
VOCABULARY = {
    "begin_of_sequence": ("<s>",), "end_of_sequence": ("</s>",), "begin_of_gene": ("<bog>", "<bok>"), "end_of_gene": ("<eog>", "<eok>"),
    "species_type": ("<fng>",), "strand": ("<+>", "<->"), "molecule_type": ("DNA",), "topology": ("linear", "circular"),
}
BOUNDARY_PAIRS = (("<bog>", "<eog>"), ("<bok>", "<eok>"))
ALPHABET, CLEAN = "ACGTNRYSWKMBDHV-", "ACGT"
ROOTS = ("Eukaryota", "Bacteria", "Archaea", "Viruses")
MIN_DEPTH = 2
TIERS = {"dev": 1_000, "integration": 3_241_000, "auth": 32_410_000}
TEXT_MASK, PAD_MASK, SPECIAL_MASK = -1, -2, 0


def assert_schema(df: DataFrame, expected=RAW.names) -> None:
    """Exact set of columns; a set comparison of names, no job."""
    missing, unexpected = set(expected) - set(df.columns), set(df.columns) - set(expected)
    if missing or unexpected:
        raise ValueError(f"missing columns {sorted(missing)}, unexpected columns {sorted(unexpected)}")


def assert_columns(df: DataFrame, required) -> None:
    if missing := set(required) - set(df.columns):
        raise ValueError(f"missing columns {sorted(missing)}")


def missing_by_input(inputs: dict[str, DataFrame], required: dict[str, tuple]) -> dict[str, list[str]]:
    """Preflight: columns that each input lacks."""
    return {n: m for n, df in inputs.items() if (m := sorted(set(required[n]) - set(df.columns)))}


def preflight(inputs: dict[str, DataFrame], required: dict[str, tuple], status: str) -> bool:
    """Whether no input lacks a column; writes a status document (``ready`` or ``halted``, with what is missing)."""
    import json

    lacking = missing_by_input(inputs, required)
    with open(status, "w") as f:
        json.dump({"status": "halted" if lacking else "ready", "missing": lacking}, f, indent=2, sort_keys=True)
    return not lacking


def assert_ordered(df: DataFrame, expected) -> None:
    if tuple(df.columns) != tuple(expected):
        raise ValueError(f"columns {df.columns}, expected {list(expected)}")


def assert_unique(df: DataFrame, key=KEY) -> None:
    """Raise if any key occurs twice."""
    if row := df.groupBy(*key).count().where("count > 1").limit(1).collect():
        raise ValueError(f"duplicate key {row[0].asDict()}")


def assert_not_null(df: DataFrame, column: str) -> None:
    n, m = df.agg(F.count(F.lit(1)), F.count(column)).first()
    if n != m:
        raise ValueError(f"{column}: {n - m} nulls")


def column_or_null(df: DataFrame, aliases, kind: str):
    """The first alias that ``df`` has, cast; a typed null where it has none."""
    name = next((a for a in aliases if a in df.columns), None)
    return (F.lit(None) if name is None else F.col(name)).cast(kind).alias(aliases[0])


def normalize_name(name: str) -> str:
    import re

    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def find_column(df: DataFrame, *names: str) -> str | None:
    """First column whose normalized name is one of ``names``, in their order."""
    by = {}
    for c in df.columns:
        by.setdefault(normalize_name(c), c)
    return next((by[normalize_name(n)] for n in names if normalize_name(n) in by), None)
