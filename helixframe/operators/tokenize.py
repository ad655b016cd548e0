"""Six-mer tokenization and likelihood reduction.

The tokenizer here is a deterministic stand-in with the reference shape: ids [begin, k-mers, end], a k-mer's
id is its base-4 code plus ``OFFSET``. Real vocabularies and models plug in through ``mapInPandas``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import KEY

K, LONGEST, OFFSET, BEGIN, END, PAD = 6, 196_596, 8, 1, 2, 0
MOST_TOKENS = 32_768


def kept_length(seq: Column) -> Column:
    return (F.floor(F.least(F.length(seq), F.lit(LONGEST)) / K) * K).cast("int")


def truncated(seq: Column) -> Column:
    return F.substring(F.upper(seq), F.lit(1), kept_length(seq))


def tagged(seq: Column) -> Column:
    return F.concat(F.lit("<dna>"), seq, F.lit("</dna>"))


def ids(seq: Column) -> Column:
    """Token ids of a sequence of a multiple of six bases; digits 0-3 read in base 4."""
    digits = F.translate(seq, "ACGT", "0123")
    codes = F.transform(F.regexp_extract_all(digits, F.lit("([0-3]{6})"), F.lit(1)), lambda x: F.conv(x, 4, 10).cast("int") + OFFSET)
    return F.concat(F.array(F.lit(BEGIN)), codes, F.array(F.lit(END)))


def tokenize(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Key, token_ids, token_mask, token_length of clean rows of six bases or more."""
    clean = df.where((F.col("qc_flag") == "clean") & F.col("sequence").isNotNull()).where(kept_length(F.col("sequence")) >= K)
    t = clean.select(*extra, *[c for c in KEY if c in df.columns], ids(truncated(F.col("sequence"))).alias("token_ids"))
    mask = F.transform("token_ids", lambda x: F.when(x.isin(BEGIN, END), 0).otherwise(K).cast("tinyint"))
    t = t.withColumns({"token_mask": mask, "token_length": F.size("token_ids")})
    return t.withColumn("token_ids", F.when(F.col("token_length") <= MOST_TOKENS, F.col("token_ids")).otherwise(F.raise_error(F.lit("sequence of too many tokens"))))


def counters(df: DataFrame) -> DataFrame:
    clean, n = F.coalesce(F.col("qc_flag") == "clean", F.lit(False)), F.coalesce(F.length("sequence"), F.lit(0))
    ok = clean & (n >= K)
    m = F.when(ok, F.floor(F.least(n, F.lit(LONGEST)) / K) + 2)
    return df.agg(
        F.count(F.lit(1)).alias("read"), F.count_if(~clean).alias("qc_filtered"), F.count_if(clean & (n < K)).alias("short"), F.count_if(clean & (n > LONGEST)).alias("truncated"),
        F.count_if(ok).alias("tokenized"), F.coalesce(F.sum(m), F.lit(0)).alias("tokens"), F.min(m).alias("least_tokens"), F.max(m).alias("most_tokens"),
    )


def padded(token_ids: Column, size: Column, pad: int = PAD) -> Column:
    return F.slice(F.concat(token_ids, F.array_repeat(F.lit(pad), size.cast("int"))), F.lit(1), size)


def within_budget(per: DataFrame, order: str, tokens: str, budget: int) -> DataFrame:
    """Shards in order while their running sum stays within the budget; the first always."""
    w = Window.orderBy(order)  # a manifest: one row per shard
    return per.withColumn("within_budget", (F.sum(tokens).over(w.rowsBetween(Window.unboundedPreceding, 0)) <= budget) | (F.row_number().over(w) == 1))


def pending(manifest: DataFrame, completed: DataFrame, key: str) -> DataFrame:
    return manifest.join(completed.select(key), key, "left_anti")


def reduce_likelihood(df: DataFrame, log_probs: str, mask: str) -> DataFrame:
    """Shift by one, positions of positive mask: count, sum, mean, exp(-mean), population deviation, least value and
    its place in the shifted list (-1 and 0 without any; the count is 1 at least)."""
    cells = F.transform(F.slice(F.arrays_zip(F.col(log_probs).alias("x"), F.col(mask).alias("m")), F.lit(2), F.size(log_probs)), lambda z, i: F.struct(z["x"].alias("x"), z["m"].alias("m"), i.alias("i")))
    d = df.withColumn("_c", F.filter(cells, lambda z: z["m"] > 0)).withColumn("_n", F.size("_c"))
    add = lambda f: F.aggregate("_c", F.lit(0.0), lambda a, z: a + f(z["x"]))
    n = F.greatest("_n", F.lit(1))
    d = d.withColumns({"sum_log_prob": add(lambda x: x), "_sq": add(lambda x: x * x)})
    d = d.withColumns({
        "supervised_position_count": n.cast("bigint"), "mean_log_prob": F.col("sum_log_prob") / n, "perplexity": F.exp(-F.col("sum_log_prob") / n),
        "per_token_logprob_std": F.sqrt(F.greatest(F.col("_sq") / n - (F.col("sum_log_prob") / n) * (F.col("sum_log_prob") / n), F.lit(0.0))),
        "_low": F.array_min(F.transform("_c", lambda z: F.struct(z["x"].alias("x"), z["i"].alias("i")))),
    })
    return d.withColumns({"min_token_logprob": F.coalesce("_low.x", F.lit(0.0)), "argmin_position": F.coalesce("_low.i", F.lit(-1))}).drop("_c", "_n", "_sq", "_low")
