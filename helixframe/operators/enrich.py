"""The feature stage: append-only derived columns; one scan, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lineage as L
from ..functions import sequence as S

TOKENS = ("begin_of_sequence", "end_of_sequence", "begin_of_gene", "end_of_gene", "gene_type", "species_type", "strand", "molecule_type", "topology", "record_id")


def normalize(df: DataFrame) -> DataFrame:
    """Token columns trimmed, sequence trimmed and upper-cased, lineage components trimmed; order kept."""
    new = {c: S.trim(F.col(c)) for c in TOKENS if c in df.columns}
    if "sequence" in df.columns:
        new["sequence"] = S.normalize_sequence(F.col("sequence"))
    if "taxonomy" in df.columns:
        new["taxonomy"] = L.normalize(F.col("taxonomy"))
    return df.withColumns(new).select(*df.columns)


def enrich(df: DataFrame, kmers: bool = False) -> DataFrame:
    """All input columns, then the derived ones; ``kmers`` adds the 64 three-mer frequencies."""
    seq = F.coalesce("sequence", F.lit(""))
    d, n = S.with_counts(df, seq)
    new = {
        "gc_content": S.gc_content(seq, n), "gc_skew": S.gc_skew(seq, n), "shannon_entropy": S.entropy(seq, n), "sequence_length": F.length(seq),
        "gene_length": S.gene_length(F.col("start"), F.col("end")), "strand_normalized_sequence": S.reverse_complement(F.col("sequence"), F.col("strand")),
        "taxonomy_domain": L.domain(F.col("taxonomy")), "taxonomy_depth": L.depth(F.col("taxonomy")), "is_coding_region": S.coding(F.col("gene_type")),
        "qc_flag": S.qc_flag(F.col("sequence"), F.col("begin_of_sequence"), F.col("end_of_sequence"), n),
    }
    if kmers:
        new["kmer_frequency_vector"] = S.kmer_frequencies(F.col("sequence"))
    return d.withColumns(new).drop(*d.columns[len(df.columns):])


def phase2(df: DataFrame) -> DataFrame:
    """Longest run, purine ratio, CpG odds, melting temperature, stop codons, Fickett proxy."""
    seq = F.coalesce("sequence", F.lit(""))
    d, n = S.with_counts(df, seq)
    d = d.withColumns({"longest_run": S.homopolymer(seq), "purine_ratio": S.purine_ratio(seq, n), "cpg_odds": S.cpg_odds(seq, n), "melting": S.melting(seq, n), "_c": S.codon_statistics(F.col("sequence"))})
    return d.select(*df.columns, "longest_run", "purine_ratio", "cpg_odds", "melting", "_c.*")
