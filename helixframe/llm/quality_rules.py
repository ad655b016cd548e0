"""Quality rules with host verdicts, in DataFrame functions only.

Every whole text is measured once. Two base rules decide alone (too few words, too many
repeated words). Softer rules (symbols, duplicate lines, word length, repetition) are counted
per host; a host's failure rate is shrunk towards a beta prior fitted to all hosts by moments,
and the verdict on the host is joined back: in a strict host a document must pass the softer rules
too, elsewhere the base rules suffice. A host is strict where its shrunk rate lies above the mean
of the prior by more than ``SPREAD`` of the prior's standard deviation, that is, where it fails more
than hosts of this corpus usually do. A clean document is therefore kept whatever its host.

Scale: measuring is one scan without a shuffle; its few numbers per document are written once.
Host counts are pre-aggregated, the join back is an ordinary equi-join that Spark broadcasts
when the host table is small and splits when a host is hot.

Edge cases: null text measures as empty and fails the base rules; a null host is a host of its
own; repeated rows are judged one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, WORD, cut, table

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
SPREAD = 0.5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the five measures (bigint) in place of nothing else; text may be null.

    Three-word windows are compared by a 64-bit hash of the three words within one text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(WORD))
    d = docs.withColumns({
        "_words": F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)),
        "_lines": lines,
        "word_chars": F.length(F.translate(text, SPACES, "")).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
    })
    # both arrays are used more than once, so that Spark does not fold their making into the lambdas
    words = F.col("_words")
    windows = F.slice(
        F.transform(words, lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i"))),
        1, F.greatest(F.size(words) - 2, F.lit(0)),
    )
    d = d.withColumns({
        "n_words": F.size(words).cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "_win": F.sort_array(windows),
    })
    win = F.col("_win")
    twice = F.filter(
        F.transform(win, lambda s, j: F.when((F.get(win, j - 1)["h"] == s["h"]) | (F.get(win, j + 1)["h"] == s["h"]), s["i"])),
        lambda p: p.isNotNull(),
    )
    d = d.withColumns({"_n_win": F.size(win), "_at": F.sort_array(twice)})
    at = F.col("_at")
    gaps = F.transform(at, lambda p, j: F.least(F.coalesce(F.get(at, j + 1) - p, F.lit(3)), F.lit(3)))
    covered = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, g: a + g)
    d = d.withColumn("n_repeat_words", F.when(F.size(at) > 0, covered).otherwise(F.lit(0).cast("bigint")))
    return d.drop("_words", "_lines", "_win", "_n_win", "_at")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def soft_failed() -> Column:
    """Softer rules: over one symbol in ten words, over a third repeated words, a mean word
    length outside 2 to 15, or at least one duplicate line for 50 words."""
    n = F.col("n_words")
    return (
        (10 * F.col("n_symbols") > n)
        | (3 * F.col("n_repeat_words") > n)
        | (F.col("word_chars") < 2 * n)
        | (F.col("word_chars") > 15 * n)
        | (50 * F.col("n_dup_lines") > n)
    )


def host_counts(measured: DataFrame, host: str = "source") -> DataFrame:
    """One row per host: host, n, failures."""
    return measured.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("base_failed") | F.col("soft_failed")).cast("bigint")).alias("failures")
    )


def host_verdicts(counts: DataFrame, spread: float = SPREAD) -> DataFrame:
    """One row per host: host, n, failures, rate (posterior mean), strict.

    The prior is Beta(m * k, (1 - m) * k): m the mean rate of hosts, k from their variance v as
    m (1 - m) / v - 1, held within [1, 1e9]; without spread k is 1e9, and no host is strict.
    """
    per = counts.withColumn("raw", F.col("failures") / F.col("n"))
    prior = per.agg(F.avg("raw").alias("m"), F.var_pop("raw").alias("v"))
    k = F.when(F.col("v") > 0, F.least(F.greatest(F.col("m") * (1 - F.col("m")) / F.col("v") - 1, F.lit(1.0)), F.lit(1e9))).otherwise(F.lit(1e9))
    prior = prior.select("m", k.alias("k"))  # one row
    rate = (F.col("failures") + F.col("m") * F.col("k")) / (F.col("n") + F.col("k"))
    limit = F.col("m") + spread * F.sqrt(F.col("m") * (1 - F.col("m")) / (F.col("k") + 1))
    return per.crossJoin(F.broadcast(prior)).withColumn("rate", rate).select("host", "n", "failures", "rate", (F.col("rate") > limit).alias("strict"))


def judge(spark: SparkSession, docs: DataFrame, spread: float = SPREAD) -> DataFrame:
    """doc_id, host, the measures, base_failed, soft_failed, host_rate, strict, kept; a row per document."""
    m = measure(docs.select("doc_id", "source", "text")).drop("text")
    m = cut(spark, m.withColumn("base_failed", base_failed()).withColumn("soft_failed", soft_failed()), "rules")
    hosts = host_verdicts(cut(spark, host_counts(m), "host-counts"), spread)
    kept = ~F.col("base_failed") & ~(F.col("strict") & F.col("soft_failed"))
    return (
        m.join(hosts, F.col("source").eqNullSafe(F.col("host")))
        .select("doc_id", F.col("source").alias("host"), *MEASURES, "base_failed", "soft_failed", F.col("rate").alias("host_rate"), "strict", kept.alias("kept"))
    )


def keep_good(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents that the rules and their host's verdict keep, with their own columns.

    Texts are measured twice, once for the host table and once for the decision, so that no copy of
    them is written; the decision needs no id. It is one number made of both sides of the join, with
    no operand that must not be null: predicates on the measures alone, inferred null checks too,
    would be pushed below the arrays and make them again.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "source", "text")
    m = measure(packed).select("_row", "source", base_failed().alias("base_failed"), soft_failed().alias("soft_failed"))
    # written first, so that the join knows the host table's size and need not shuffle texts
    hosts = cut(spark, host_verdicts(cut(spark, host_counts(m), "host-counts")), "hosts")
    base, soft, strict = (F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in ("base_failed", "soft_failed", "strict"))
    rejected = base * 2 + strict * soft
    return m.join(hosts, F.col("source").eqNullSafe(F.col("host"))).where(rejected == 0).select("_row.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark, table(spark, sf_dir, "documents")).select("doc_id", *MEASURES, "base_failed", "kept")


JUDGE_SQL = rf"""
t AS (SELECT row_number() OVER () AS rid, * , regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
      list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '{WORD}')) AS lines FROM {{docs}}),
win AS (SELECT rid, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM t, unnest(range(1, len(words) - 1)) AS u(i)),
rep AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1),
cov AS (SELECT rid, count(DISTINCT i + o)::BIGINT AS n FROM rep, (VALUES (0), (1), (2)) AS v(o) GROUP BY rid),
m AS (SELECT t.*, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
      length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
      (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
      FROM t LEFT JOIN cov USING (rid)),
j AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
      10 * n_symbols > n_words OR 3 * n_repeat_words > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
      OR 50 * n_dup_lines > n_words AS soft_failed FROM m),
per AS (SELECT source AS host, count(*) AS n, count(*) FILTER (base_failed OR soft_failed) AS failures FROM j GROUP BY source),
mom AS (SELECT avg(failures / n) AS m, var_pop(failures / n) AS v FROM per),
prior AS (SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1.0), 1e9) ELSE 1e9 END AS k FROM mom),
host AS (SELECT host, (failures + m * k) / (n + k) > m + {SPREAD} * sqrt(m * (1 - m) / (k + 1)) AS strict FROM per, prior),
judged AS (SELECT j.*, NOT base_failed AND NOT (strict AND soft_failed) AS kept
           FROM j JOIN host ON j.source IS NOT DISTINCT FROM host.host)
"""
OP4_SQL = "WITH " + JUDGE_SQL.format(docs="documents") + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged
"""
