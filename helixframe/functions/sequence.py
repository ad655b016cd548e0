"""Sequence expressions; all JVM-side except the fused statistics, which run on Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EDGE = r"(?U)^\s+|\s+$"
#: Complement of IUPAC codes.
COMPLEMENT = ("ATCGNRYSWKMBVDH-", "TAGCNYRSWMKVBHD-")


def trim(c: Column) -> Column:
    """Unicode white space off both ends."""
    return F.regexp_replace(c, _EDGE, "")


def normalize_sequence(c: Column) -> Column:
    return F.upper(trim(c))


def squeeze_sequence(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, r"(?U)\s+", ""))


def count_base(seq: Column, base: str) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit(base), F.lit("")))


def ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    return F.when(den != 0, num / den).otherwise(F.lit(default))


def counts(seq: Column) -> tuple[Column, ...]:
    return tuple(count_base(seq, b) for b in "ACGT")


def with_counts(df: DataFrame, seq: Column) -> tuple[DataFrame, tuple[Column, ...]]:
    """``df`` with the base counts as columns of a projection of their own, and these: features made of them (argument
    ``n``) read a sequence once, where expressions in the branches of a CASE would each count again."""
    names = [f"_n_{b}" for b in "acgt"]
    return df.withColumns(dict(zip(names, counts(seq)))), tuple(F.col(c) for c in names)


def gc_content(seq: Column, n: tuple[Column, ...] | None = None) -> Column:
    a, c, g, t = n or counts(seq)
    return F.coalesce(ratio(c + g, a + c + g + t), F.lit(0.0))


def gc_skew(seq: Column, n: tuple[Column, ...] | None = None) -> Column:
    _, c, g, _ = n or counts(seq)
    return F.coalesce(ratio(g - c, g + c), F.lit(0.0))


def entropy(seq: Column, n: tuple[Column, ...] | None = None) -> Column:
    n = n or counts(seq)
    total = sum(n[1:], n[0])
    terms = [F.when(x > 0, -(x / total) * F.log2(x / total)).otherwise(F.lit(0.0)) for x in n]
    return F.coalesce(sum(terms[1:], terms[0]), F.lit(0.0))


def ambiguous(seq: Column) -> Column:
    return F.coalesce(seq.rlike("[^ACGT]"), F.lit(False))


def reverse_complement(seq: Column, strand: Column) -> Column:
    """On the minus strand only; letters without complement pass through."""
    return F.when(strand == "<->", F.reverse(F.translate(seq, *COMPLEMENT))).otherwise(seq)


def gene_length(start: Column, end: Column) -> Column:
    return F.greatest(end - start, F.lit(0).cast("bigint"))


def coding(gene_type: Column) -> Column:
    return F.coalesce(gene_type == "<cds>", F.lit(False))


def qc_flag(seq: Column, begin: Column, end: Column, n: tuple[Column, ...] | None = None) -> Column:
    missing = (F.coalesce(F.length(seq), F.lit(0)) == 0) | ~begin.eqNullSafe(F.lit("<s>")) | ~end.eqNullSafe(F.lit("</s>"))
    return (
        F.when(missing, "missing_sequence_boundary_tokens").when(ambiguous(seq), "ambiguous_bases")
        .when(entropy(seq, n) < 1.0, "low_complexity").otherwise("clean")
    )


def homopolymer(seq: Column) -> Column:
    """Longest run of one canonical base; 0 without any."""
    runs = F.regexp_extract_all(seq, F.lit("(A+|C+|G+|T+)"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))


def purine_ratio(seq: Column, n: tuple[Column, ...] | None = None) -> Column:
    a, c, g, t = n or counts(seq)
    pu, py = a + g, c + t
    return F.when(py > 0, pu / py).otherwise(F.lit(float("inf")))


def cpg_odds(seq: Column, n: tuple[Column, ...] | None = None) -> Column:
    """p(CG) / (p(C) p(G)); a pair counts when a canonical base follows it, over valid - 1."""
    a, c, g, t = n or counts(seq)
    valid = a + c + g + t
    pairs = F.regexp_count(seq, F.lit("CG(?=[ACGT])")) / F.greatest(valid - 1, F.lit(1))
    return F.when((c > 0) & (g > 0), pairs / ((c / valid) * (g / valid))).otherwise(F.lit(0.0))


def melting(seq: Column, n: tuple[Column, ...] | None = None) -> Column:
    a, c, g, t = n or counts(seq)
    return F.when(a + c + g + t > 0, 64.9 + 41.0 * (c + g - 16.4) / (a + c + g + t)).otherwise(F.lit(0.0))


def valid_alphabet(seq: Column) -> Column:
    return seq.rlike("^[ACGTNRYSWKMBDHV-]*$")


def length_bucket(n: Column) -> Column:
    return F.when(n <= 512, 512).when(n <= 2048, 2048).when(n <= 8192, 8192).when(n <= 32768, 32768).otherwise(-1)


def token_bucket(n: Column) -> Column:
    """Seven padding buckets, doubling from 512; what is longer goes to the last."""
    return F.when(n <= 512, 512).otherwise(F.least(F.pow(2, F.ceil(F.log2(n.cast("double")))), F.lit(32768))).cast("int")


def hash_fraction(seed, key: Column) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967295.0)


_CODE = np.full(256, 4, np.uint8)
for _i, _b in enumerate(b"ACGT"):
    _CODE[_b] = _i


def _coded(s: pd.Series):
    raw = s.fillna("").str.encode("utf-8", errors="replace")
    sizes = raw.map(len).to_numpy(np.int64)
    return _CODE[np.frombuffer(b"".join(raw), np.uint8)], sizes


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def kmer_frequencies(s: pd.Series) -> pd.Series:
    """64 frequencies of overlapping canonical 3-mers, index 16a + 4b + c; zeros if none."""
    code, sizes = _coded(s)
    row = np.repeat(np.arange(len(s)), sizes)
    out = np.zeros((len(s), 64))
    if len(code) > 2:
        a, b, c = code[:-2], code[1:-1], code[2:]
        ok = (a < 4) & (b < 4) & (c < 4) & (row[:-2] == row[2:])
        k = 16 * a[ok].astype(np.int64) + 4 * b[ok] + c[ok]
        out = np.bincount(row[:-2][ok] * 64 + k, minlength=64 * len(s)).reshape(-1, 64).astype(float)
        out /= np.maximum(out.sum(1, keepdims=True), 1)
    return pd.Series(list(out))


_CODONS = T.StructType([T.StructField(f"stops{i}", T.IntegerType()) for i in range(3)] + [T.StructField("fickett", T.DoubleType())])


@F.pandas_udf(_CODONS)
def codon_statistics(s: pd.Series) -> pd.DataFrame:
    """Stop codons per frame (start position modulo 3), and the population variance of the 12 frequencies of
    (position modulo 3, base)."""
    code, sizes = _coded(s)
    n = len(s)
    row = np.repeat(np.arange(n), sizes)
    at = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    stops = np.zeros((n, 3), np.int64)
    if len(code) > 2:
        k = 16 * code[:-2].astype(np.int64) + 4 * code[1:-1] + code[2:]
        ok = (code[:-2] < 4) & (code[1:-1] < 4) & (code[2:] < 4) & (row[:-2] == row[2:]) & np.isin(k, (48, 50, 56))
        stops = np.bincount(row[:-2][ok] * 3 + at[:-2][ok] % 3, minlength=3 * n).reshape(-1, 3)
    ok = code < 4
    f = np.bincount(row[ok] * 12 + (at[ok] % 3) * 4 + code[ok], minlength=12 * n).reshape(-1, 12).astype(float)
    f /= np.maximum(f.sum(1, keepdims=True), 1)
    return pd.DataFrame({"stops0": stops[:, 0], "stops1": stops[:, 1], "stops2": stops[:, 2], "fickett": f.var(1)})


def identity(a: Column, b: Column) -> Column:
    """Share of equal bases over the length that both have; NaN where that is 0."""
    bases = lambda c: F.regexp_extract_all(c, F.lit("(?s)(.)"), F.lit(1))
    n = F.least(F.length(a), F.length(b))
    same = F.size(F.filter(F.zip_with(bases(a), bases(b), lambda x, y: F.coalesce(x == y, F.lit(False))), lambda x: x))
    return F.when(n > 0, same / n).otherwise(F.lit(float("nan")))
