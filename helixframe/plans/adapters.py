"""The engine's inputs made from the driver's tables, alike in Spark and SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import table

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASES = "".join("N" if c == "Q" else "ACGT"[i % 4] for i, c in enumerate(LETTERS))


def sequences(spark: SparkSession, d: str) -> DataFrame:
    """record_id, start, end, strand, gene_type, boundary tokens and a sequence from each document."""
    seq = F.translate(F.upper(F.regexp_replace("text", "[^A-Za-z]", "")), LETTERS, BASES)
    i = F.col("doc_id")
    return table(spark, d, "documents").select(
        "doc_id", F.col("source").alias("record_id"), i.alias("start"), (i + F.col("n_chars")).alias("end"), "lang",
        seq.alias("sequence"), F.when(i % 2 == 0, "<+>").otherwise("<->").alias("strand"),
        F.when(i % 3 == 0, "<cds>").when(i % 3 == 1, "<trna>").alias("gene_type"),
        F.when(i % 17 != 0, "<s>").alias("begin_of_sequence"), F.when(i % 19 != 0, "</s>").otherwise("<x>").alias("end_of_sequence"),
    )


SEQ = f"""seq AS (
  SELECT doc_id, source AS record_id, doc_id AS start, doc_id + n_chars AS "end", lang,
    translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), '{LETTERS}', '{BASES}') AS sequence,
    CASE WHEN doc_id % 2 = 0 THEN '<+>' ELSE '<->' END AS strand,
    CASE WHEN doc_id % 3 = 0 THEN '<cds>' WHEN doc_id % 3 = 1 THEN '<trna>' END AS gene_type,
    CASE WHEN doc_id % 17 <> 0 THEN '<s>' END AS begin_of_sequence, CASE WHEN doc_id % 19 <> 0 THEN '</s>' ELSE '<x>' END AS end_of_sequence
  FROM documents),
cnt AS (SELECT *, length(sequence) AS n, length(sequence) - length(replace(sequence, 'A', '')) AS a, length(sequence) - length(replace(sequence, 'C', '')) AS c,
    length(sequence) - length(replace(sequence, 'G', '')) AS g, length(sequence) - length(replace(sequence, 'T', '')) AS t FROM seq),
feat AS (SELECT *, a + c + g + t AS valid, CASE WHEN a + c + g + t > 0 THEN (c + g) / (a + c + g + t) ELSE 0.0 END AS gc,
    CASE WHEN c + g > 0 THEN (g - c) / (c + g) ELSE 0.0 END AS skew,
    CASE WHEN a > 0 THEN -(a / (a + c + g + t)) * log2(a / (a + c + g + t)) ELSE 0.0 END + CASE WHEN c > 0 THEN -(c / (a + c + g + t)) * log2(c / (a + c + g + t)) ELSE 0.0 END
    + CASE WHEN g > 0 THEN -(g / (a + c + g + t)) * log2(g / (a + c + g + t)) ELSE 0.0 END + CASE WHEN t > 0 THEN -(t / (a + c + g + t)) * log2(t / (a + c + g + t)) ELSE 0.0 END AS entropy
  FROM cnt)"""


def lineages(spark: SparkSession, d: str) -> DataFrame:
    """custkey, lineage: Eukaryota;region;nation;segment, shorter for some, null for a few."""
    c, n, r = table(spark, d, "customer"), table(spark, d, "nation"), table(spark, d, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("c_custkey")
    lineage = (
        F.when(k % 29 == 0, F.lit(None).cast("string")).when(k % 7 == 0, F.concat_ws(";", F.lit("Bacteria"), "r_name"))
        .when(k % 5 == 0, F.concat_ws("; ", F.lit("Eukaryota"), "r_name", F.lit(""), "n_name")).otherwise(F.concat_ws(";", F.lit("Eukaryota"), "r_name", "n_name", "c_mktsegment"))
    )
    return j.select(k.alias("custkey"), "c_nationkey", "c_acctbal", "c_mktsegment", lineage.alias("lineage"))


LIN = """lin AS (
  SELECT c_custkey AS custkey, c_nationkey, c_acctbal, c_mktsegment,
    CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'Bacteria;' || r_name
      WHEN c_custkey % 5 = 0 THEN 'Eukaryota; ' || r_name || '; ; ' || n_name ELSE 'Eukaryota;' || r_name || ';' || n_name || ';' || c_mktsegment END AS lineage
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
par AS (SELECT *, coalesce(list_filter(list_transform(string_split(lineage, ';'), lambda x: trim(x)), lambda x: x <> ''), []) AS p FROM lin)"""


def likelihoods(spark: SparkSession, d: str) -> DataFrame:
    """Per line item: key (order, line), length, composition and a log-probability; keys repeat."""
    l = table(spark, d, "lineitem")
    return l.select(
        F.col("l_orderkey").alias("record_id"), F.col("l_linenumber").alias("start"), "l_partkey", "l_suppkey", "l_returnflag",
        F.col("l_quantity").alias("sequence_length"), F.col("l_discount").alias("gc_content"), F.col("l_tax").alias("entropy"),
        (-F.col("l_extendedprice") / 10000.0).alias("mean_log_prob"), (F.col("l_partkey") % 100).alias("argmin_position"),
    )


LIK = """lik AS (
  SELECT l_orderkey AS record_id, l_linenumber AS start, l_partkey, l_suppkey, l_returnflag, l_quantity AS sequence_length, l_discount AS gc_content, l_tax AS entropy,
    -l_extendedprice / 10000.0 AS mean_log_prob, l_partkey % 100 AS argmin_position FROM lineitem)"""
