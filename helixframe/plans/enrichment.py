"""Queries of the feature stage: sequences, lineages, validation, sampling, tokenization."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions import lineage as L
from ..functions import sequence as S
from ..functions import stats as St
from ..operators import sampling, tokenize, validate
from ..operators.enrich import enrich, phase2
from ..sources.shared import table
from .adapters import LIN, SEQ, lineages, sequences
from .registry import query

r6 = lambda c, name: F.round(c, 6).alias(name)


@query(f"""WITH {SEQ}
SELECT doc_id, n::INTEGER AS sequence_length, round(gc, 6) AS gc_content, round(skew, 6) AS gc_skew, round(entropy, 6) AS shannon_entropy,
  regexp_matches(sequence, '[^ACGT]') AS ambiguous, greatest("end" - start, 0) AS gene_length, gene_type IS NOT DISTINCT FROM '<cds>' AS is_coding_region,
  md5(CASE WHEN strand = '<->' THEN reverse(translate(sequence, 'ATCG', 'TAGC')) ELSE sequence END) AS strand_md5 FROM feat""")
def seq_features(spark: SparkSession, d: str) -> DataFrame:
    e = enrich(sequences(spark, d).withColumn("taxonomy", F.lit(None).cast("string")))
    return e.select(
        "doc_id", "sequence_length", r6(F.col("gc_content"), "gc_content"), r6(F.col("gc_skew"), "gc_skew"), r6(F.col("shannon_entropy"), "shannon_entropy"),
        S.ambiguous(F.col("sequence")).alias("ambiguous"), "gene_length", "is_coding_region", F.md5("strand_normalized_sequence").alias("strand_md5"),
    )


@query(f"""WITH {SEQ}
SELECT lang AS class, count(*) AS n, round(avg(gc), 6) AS mean_gc, round(coalesce(stddev_samp(skew), 0), 6) AS sd_skew FROM feat GROUP BY lang ORDER BY n DESC, class""")
def seq_features_by_class(spark: SparkSession, d: str) -> DataFrame:
    s, n = S.with_counts(sequences(spark, d), F.col("sequence"))
    s = s.select(F.col("lang").alias("class"), S.gc_content(F.col("sequence"), n).alias("gc"), S.gc_skew(F.col("sequence"), n).alias("skew"))
    return s.groupBy("class").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("gc"), "mean_gc"), r6(F.coalesce(F.stddev_samp("skew"), F.lit(0.0)), "sd_skew")).orderBy(F.desc("n"), "class")


@query(f"""WITH {SEQ},
w AS (SELECT doc_id, substr(sequence, i::INTEGER, 3) AS k FROM seq, unnest(range(1, length(sequence) - 1)) AS u(i)),
k AS (SELECT doc_id, k, count(*) AS m FROM w WHERE NOT contains(k, 'N') GROUP BY 1, 2)
SELECT doc_id, (16 * (instr('ACGT', k[1]) - 1) + 4 * (instr('ACGT', k[2]) - 1) + instr('ACGT', k[3]) - 1)::INTEGER AS kmer,
  round(m / sum(m) OVER (PARTITION BY doc_id), 6) AS frequency FROM k""")
def kmer3_vector(spark: SparkSession, d: str) -> DataFrame:
    v = sequences(spark, d).select("doc_id", S.kmer_frequencies("sequence").alias("v"))
    return v.select("doc_id", F.posexplode("v").alias("kmer", "f")).where("f > 0").select("doc_id", "kmer", r6(F.col("f"), "frequency"))


@query("""SELECT c_custkey, trim('  ' || c_mktsegment || '  ') AS token, upper(trim(' ' || c_name || ' ')) AS normalized,
  'Eukaryota;;' || c_mktsegment || ';' AS taxonomy FROM customer""")
def normalize_tokens(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select(
        "c_custkey", S.trim(F.concat(F.lit(" \t "), "c_mktsegment", F.lit("\n "))).alias("token"), S.normalize_sequence(F.concat(F.lit(" "), "c_name", F.lit(" "))).alias("normalized"),
        L.normalize(F.concat(F.lit(" Eukaryota; ;"), "c_mktsegment", F.lit(" ;"))).alias("taxonomy"),
    )


@query(f"""WITH {SEQ}
SELECT count(*) AS total_rows, count(*) FILTER (n = 0) AS empty_sequences, count(*) FILTER (n > 0 AND NOT regexp_matches(sequence, '[^ACGT]')) AS clean_sequences,
  count(*) FILTER (n > 0 AND regexp_matches(sequence, '[^ACGTNRYSWKMBDHV-]')) AS bad_alphabet, min(n) FILTER (n > 0)::BIGINT AS min_length, max(n) FILTER (n > 0)::BIGINT AS max_length,
  coalesce(sum(n), 0)::BIGINT AS total_bases, count(*) FILTER (start < 0 OR "end" < 0) AS negative_coordinates, count(*) FILTER (start >= "end") AS inverted_coordinates,
  count(*) FILTER (begin_of_sequence IS DISTINCT FROM '<s>') AS invalid_begin, count(*) FILTER (end_of_sequence IS DISTINCT FROM '</s>') AS invalid_end,
  count(*) FILTER (gene_type IS NULL) AS null_gene_type, round(avg(n) FILTER (n > 0), 1) AS mean_length,
  round(100.0 * count(*) FILTER (n > 0 AND NOT regexp_matches(sequence, '[^ACGT]')) / count(*) FILTER (n > 0), 2) AS clean_percent FROM cnt""")
def validation_summary(spark: SparkSession, d: str) -> DataFrame:
    return validate.summary(sequences(spark, d))


@query("""SELECT o_orderstatus || '/' || o_orderpriority AS pair, count(*) AS n, o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AS matched FROM orders GROUP BY 1, 3""")
def boundary_pairs(spark: SparkSession, d: str) -> DataFrame:
    return validate.boundary_pairs(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority", (("F", "1-URGENT"),))


@query(f"""WITH {SEQ}
SELECT CASE WHEN n = 0 OR begin_of_sequence IS DISTINCT FROM '<s>' OR end_of_sequence IS DISTINCT FROM '</s>' THEN 'missing_sequence_boundary_tokens'
  WHEN regexp_matches(sequence, '[^ACGT]') THEN 'ambiguous_bases' WHEN entropy < 1.0 THEN 'low_complexity' ELSE 'clean' END AS qc_flag, count(*) AS n FROM feat GROUP BY 1""")
def qc_flag_counts(spark: SparkSession, d: str) -> DataFrame:
    s, n = S.with_counts(sequences(spark, d), F.col("sequence"))
    return s.groupBy(S.qc_flag(F.col("sequence"), F.col("begin_of_sequence"), F.col("end_of_sequence"), n).alias("qc_flag")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {LIN} SELECT p[1] AS domain, len(p)::INTEGER AS depth, count(*) AS n, count(*) FILTER (len(p) < 2) AS thin,
  count(*) FILTER (p[1] IS NULL OR p[1] NOT IN ('Eukaryota', 'Bacteria', 'Archaea', 'Viruses')) AS unknown_root FROM par GROUP BY 1, 2""")
def lineage_domain_depth(spark: SparkSession, d: str) -> DataFrame:
    l = lineages(spark, d).select(L.domain(F.col("lineage")).alias("domain"), L.depth(F.col("lineage")).alias("depth"))
    unknown = ~F.coalesce(F.col("domain").isin(*C.ROOTS), F.lit(False))
    return l.groupBy("domain", "depth").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("depth") < C.MIN_DEPTH).alias("thin"), F.count_if(unknown).alias("unknown_root"))


@query(f"""WITH {LIN} SELECT {", ".join(f"count(DISTINCT coalesce(string_split(lineage, ';')[{i}], '')) AS rank{i}" for i in range(1, 7))} FROM lin""")
def rank_cardinality(spark: SparkSession, d: str) -> DataFrame:
    l = lineages(spark, d)
    # long form first: one distinct aggregation instead of an expansion per rank
    long = l.select(F.posexplode(F.array(*[L.rank(F.col("lineage"), i) for i in range(1, 7)])).alias("i", "v")).distinct()
    per = long.agg(*[F.count_if(F.col("i") == i - 1).alias(f"rank{i}") for i in range(1, 7)])
    return per


@query(f"""WITH {LIN} SELECT custkey, lineage FROM lin WHERE regexp_matches(lineage, '(?i)(^|;)\\s*asia\\s*(;|$)')""")
def lineage_regex_exact(spark: SparkSession, d: str) -> DataFrame:
    return lineages(spark, d).where(F.col("lineage").rlike(L.token_pattern(["asia"]))).select("custkey", "lineage")


@query(f"""WITH {LIN} SELECT custkey FROM lin WHERE regexp_matches(lineage, '(?i)(^|;)\\s*eukaryota\\s*;(.*;)?\\s*building\\s*(;|$)')""")
def lineage_regex_ordered(spark: SparkSession, d: str) -> DataFrame:
    return lineages(spark, d).where(F.col("lineage").rlike(L.token_pattern(["eukaryota", "building"], ordered=True))).select("custkey")


@query("""SELECT p_partkey, p_type FROM part WHERE regexp_matches(p_type, '(?i)(^|[^A-Za-z0-9])steel([^A-Za-z0-9]|$)')""")
def taxon_boundary_match(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").where(L.boundary_match(F.col("p_type"), "steel")).select("p_partkey", "p_type")


_F = "('0x' || substr(sha256('42:' || o_custkey::VARCHAR), 1, 8))::BIGINT / 4294967295.0"


@query(f"SELECT o_orderkey, o_custkey FROM orders WHERE {_F} < 0.3")
def hash_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.include(table(spark, d, "orders"), "o_custkey", 0.3, 42).select("o_orderkey", "o_custkey")


@query(f"""WITH f AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL), s AS (SELECT o_orderstatus, o_orderpriority, count(*) AS m FROM orders WHERE {_F} < 0.05 GROUP BY ALL),
x AS (SELECT f.o_orderstatus, f.o_orderpriority, n / (SELECT sum(n) FROM f) AS full_share, coalesce(m, 0) / (SELECT sum(m) FROM s) AS sample_share FROM f LEFT JOIN s USING (o_orderstatus, o_orderpriority))
SELECT o_orderstatus, o_orderpriority, round(100 * full_share, 3) AS full_percent, round(100 * sample_share, 3) AS sample_percent, round(abs(100 * (full_share - sample_share)), 3) AS drift
FROM x WHERE abs(100 * (full_share - sample_share)) > 0.2""")
def hash_sample_drift(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return sampling.drift(o, sampling.include(o, "o_custkey", 0.05, 42), ("o_orderstatus", "o_orderpriority"), over=0.2)


@query("""WITH u AS (SELECT 'flag' AS dimension, l_returnflag AS value FROM lineitem UNION ALL SELECT 'status', l_linestatus FROM lineitem UNION ALL SELECT 'line', l_linenumber::VARCHAR FROM lineitem),
c AS (SELECT dimension, value, count(*) AS n FROM u GROUP BY ALL)
SELECT dimension, value, n, round(n / sum(n) OVER (PARTITION BY dimension), 6) AS share FROM c""")
def stratum_proportions(spark: SparkSession, d: str) -> DataFrame:
    return sampling.proportions(table(spark, d, "lineitem"), {"flag": F.col("l_returnflag"), "status": F.col("l_linestatus"), "line": F.col("l_linenumber").cast("string")})


@query("""SELECT l_returnflag, l_linestatus, CASE WHEN l_quantity <= 512 THEN 512 ELSE 2048 END::INTEGER AS bucket, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL""")
def joint_strata(spark: SparkSession, d: str) -> DataFrame:
    return sampling.strata(table(spark, d, "lineitem").withColumn("bucket", S.length_bucket(F.col("l_quantity"))), "l_returnflag", "l_linestatus", "bucket", "l_linenumber")


_WB = "CASE WHEN {x} IS NULL OR {x} < {lo} THEN 0 WHEN {x} >= {hi} THEN {n} + 1 ELSE floor(({x} - {lo}) / ({hi} - {lo}) * {n}) + 1 END::INTEGER"


@query(f"""WITH {SEQ}, b AS (SELECT CASE WHEN n > 0 THEN log10(n) END AS ln, gc FROM feat)
SELECT {_WB.format(x="ln", lo="1.0", hi="5.0", n=16)} AS length_log_bucket, {_WB.format(x="gc", lo="0.0", hi="1.0", n=10)} AS gc_bucket, count(*) AS n FROM b GROUP BY 1, 2""")
def length_gc_histogram(spark: SparkSession, d: str) -> DataFrame:
    s, n = S.with_counts(sequences(spark, d), F.col("sequence"))
    s = s.select(F.length("sequence").alias("n"), S.gc_content(F.col("sequence"), n).alias("gc"))
    log = F.when(F.col("n") > 0, F.log10("n"))
    return s.groupBy(St.bucket(log, 1.0, 5.0, 16).alias("length_log_bucket"), St.bucket(F.col("gc"), 0.0, 1.0, 10).alias("gc_bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT coalesce(l_returnflag, '__NULL__') AS "group", round(avg(l_discount), 6) AS mean_x, round(coalesce(stddev_samp(l_discount), 0), 6) AS mean_x_stddev, count(*) AS n FROM lineitem GROUP BY 1""")
def grouped_moments(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem")
    return l.groupBy(F.coalesce("l_returnflag", F.lit("__NULL__")).alias("group")).agg(
        r6(F.avg("l_discount"), "mean_x"), r6(F.coalesce(F.stddev_samp("l_discount"), F.lit(0.0)), "mean_x_stddev"), F.count(F.lit(1)).alias("n")
    )


@query(f"""WITH {SEQ}, q AS (SELECT n, gc, CASE WHEN valid > 0 THEN 64.9 + 41.0 * (c + g - 16.4) / valid ELSE 0.0 END AS tm FROM feat)
SELECT count(*) AS total, count(*) FILTER (gc < 0 OR gc > 1) AS gc_out, count(*) FILTER (tm < 0 OR tm > 120) AS tm_out FROM q""")
def range_sanity(spark: SparkSession, d: str) -> DataFrame:
    s, n = S.with_counts(sequences(spark, d), F.col("sequence"))
    s = s.select(S.gc_content(F.col("sequence"), n).alias("gc"), S.melting(F.col("sequence"), n).alias("tm"))
    return s.agg(F.count(F.lit(1)).alias("total"), F.count_if((F.col("gc") < 0) | (F.col("gc") > 1)).alias("gc_out"), F.count_if((F.col("tm") < 0) | (F.col("tm") > 120)).alias("tm_out"))


@query(f"""WITH {SEQ},
runs AS (SELECT doc_id, max(length(r)) AS run FROM seq, unnest(regexp_extract_all(sequence, 'A+|C+|G+|T+')) AS u(r) GROUP BY doc_id),
tri AS (SELECT doc_id, i, substr(sequence, i::INTEGER, 3) AS w FROM seq, unnest(range(1, length(sequence) - 1)) AS u(i)),
agg AS (SELECT doc_id, count(*) FILTER (w IN ('CGA', 'CGC', 'CGG', 'CGT')) AS cg, count(*) FILTER (w IN ('TAA', 'TAG', 'TGA') AND (i - 1) % 3 = 0) AS s0,
  count(*) FILTER (w IN ('TAA', 'TAG', 'TGA') AND (i - 1) % 3 = 1) AS s1, count(*) FILTER (w IN ('TAA', 'TAG', 'TGA') AND (i - 1) % 3 = 2) AS s2 FROM tri GROUP BY doc_id)
SELECT doc_id, coalesce(run, 0)::INTEGER AS longest_run, round(CASE WHEN c + t > 0 THEN (a + g) / (c + t) ELSE 'inf'::DOUBLE END, 6) AS purine_ratio,
  round(CASE WHEN c > 0 AND g > 0 THEN (coalesce(cg, 0) / greatest(valid - 1, 1)) / ((c / valid) * (g / valid)) ELSE 0.0 END, 6) AS cpg_odds,
  round(CASE WHEN valid > 0 THEN 64.9 + 41.0 * (c + g - 16.4) / valid ELSE 0.0 END, 6) AS melting, coalesce(s0, 0)::INTEGER AS stops0, coalesce(s1, 0)::INTEGER AS stops1, coalesce(s2, 0)::INTEGER AS stops2
FROM feat LEFT JOIN runs USING (doc_id) LEFT JOIN agg USING (doc_id)""")
def sequence_statistics(spark: SparkSession, d: str) -> DataFrame:
    p = phase2(sequences(spark, d))
    return p.select("doc_id", "longest_run", *[r6(F.col(c), c) for c in ("purine_ratio", "cpg_odds", "melting")], "stops0", "stops1", "stops2")


@query(f"""WITH {SEQ},
tri AS (SELECT doc_id, i, substr(sequence, i::INTEGER, 3) AS w FROM seq, unnest(range(1, length(sequence) - 1)) AS u(i)),
agg AS (SELECT doc_id, count(*) FILTER ((i - 1) % 3 = 0) AS s0, count(*) FILTER ((i - 1) % 3 = 1) AS s1, count(*) FILTER ((i - 1) % 3 = 2) AS s2 FROM tri WHERE w IN ('TAA', 'TAG', 'TGA') GROUP BY doc_id)
SELECT gene_type IS NOT DISTINCT FROM '<cds>' AS coding, round(avg(coalesce(s0, 0)), 6) AS mean_stops_frame0, round(avg(coalesce(s1, 0)), 6) AS mean_stops_frame1,
  round(avg(coalesce(s2, 0)), 6) AS mean_stops_frame2, count(*) AS n FROM seq LEFT JOIN agg USING (doc_id) GROUP BY 1""")
def stop_codons_by_group(spark: SparkSession, d: str) -> DataFrame:
    p = sequences(spark, d).select(S.coding(F.col("gene_type")).alias("coding"), S.codon_statistics("sequence").alias("s"))
    return p.groupBy("coding").agg(*[r6(F.avg(f"s.stops{i}"), f"mean_stops_frame{i}") for i in range(3)], F.count(F.lit(1)).alias("n"))


@query(f"""WITH {LIN} SELECT custkey, string_split(lineage, ';')[-1] AS last, CASE WHEN lower(p[1]) = 'eukaryota' AND len(p) > 1 THEN p[2] ELSE p[1] END AS kingdom,
  array_to_string(list_filter(p, lambda x: lower(x) <> 'unknown')[1:2], '>') AS compact, CASE WHEN lineage IS NULL THEN 'Unknown' ELSE lineage END AS safe FROM par""")
def lineage_functions(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("lineage")
    return lineages(spark, d).select("custkey", L.last(x).alias("last"), L.kingdom(x).alias("kingdom"), F.array_join(L.compact(x, 2), ">").alias("compact"), L.safe_component(x).alias("safe"))


@query(f"""WITH {SEQ}, k AS (SELECT doc_id, length(sequence) AS n, least(length(sequence), 196596) // 6 * 6 AS kept FROM seq WHERE NOT regexp_matches(sequence, '[^ACGT]')),
p AS (SELECT k.doc_id, i, substr(sequence, (6 * i + 1)::INTEGER, 6) AS w FROM k JOIN seq USING (doc_id), unnest(range(0, kept // 6)) AS u(i) WHERE kept >= 6),
c AS (SELECT doc_id, i, (SELECT sum((instr('ACGT', w[j]) - 1) * (4 ** (6 - j))::BIGINT) FROM unnest(range(1, 7)) AS v(j)) + 8 AS id FROM p)
SELECT doc_id, (count(*) + 2)::INTEGER AS token_length, sum(id)::BIGINT AS id_sum, min(id)::BIGINT AS least_id, max(id)::BIGINT AS largest_id FROM c GROUP BY doc_id""")
def tokenize_6mer(spark: SparkSession, d: str) -> DataFrame:
    s = sequences(spark, d).withColumn("qc_flag", F.when(S.ambiguous(F.col("sequence")), "ambiguous_bases").otherwise("clean"))
    t = tokenize.tokenize(s, extra=("doc_id",))
    inner = F.slice("token_ids", F.lit(2), F.size("token_ids") - 2)
    return t.select("doc_id", "token_length", F.aggregate(inner, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("id_sum"), F.array_min(inner).cast("bigint").alias("least_id"), F.array_max(inner).cast("bigint").alias("largest_id"))


@query(f"""WITH {SEQ}, x AS (SELECT *, length(sequence) AS n, NOT regexp_matches(sequence, '[^ACGT]') AS clean FROM seq), y AS (SELECT *, least(n, 196596) // 6 + 2 AS m FROM x)
SELECT count(*) AS read, count(*) FILTER (NOT clean) AS qc_filtered, count(*) FILTER (clean AND n < 6) AS short, count(*) FILTER (clean AND n > 196596) AS truncated,
  count(*) FILTER (clean AND n >= 6) AS tokenized, coalesce(sum(m) FILTER (clean AND n >= 6), 0)::BIGINT AS tokens, min(m) FILTER (clean AND n >= 6)::BIGINT AS least_tokens, max(m) FILTER (clean AND n >= 6)::BIGINT AS most_tokens FROM y""")
def token_stats(spark: SparkSession, d: str) -> DataFrame:
    s = sequences(spark, d).withColumn("qc_flag", F.when(S.ambiguous(F.col("sequence")), "ambiguous_bases").otherwise("clean"))
    return tokenize.counters(s)


@query(f"""WITH {SEQ}, x AS (SELECT doc_id, length(sequence) // 6 + 2 AS m FROM seq), b AS (SELECT *, CASE WHEN m <= 512 THEN 512 WHEN m <= 1024 THEN 1024 WHEN m <= 2048 THEN 2048 WHEN m <= 4096 THEN 4096
  WHEN m <= 8192 THEN 8192 WHEN m <= 16384 THEN 16384 ELSE 32768 END AS bucket FROM x), g AS (SELECT bucket, count(*) AS n, sum(m)::BIGINT AS tokens FROM b GROUP BY bucket),
w AS (SELECT *, sum(tokens) OVER (ORDER BY bucket) AS running, row_number() OVER (ORDER BY bucket) AS k FROM g)
SELECT bucket::INTEGER AS bucket, n, tokens, running <= 200000 OR k = 1 AS within_budget FROM w""")
def bucket_budget(spark: SparkSession, d: str) -> DataFrame:
    m = sequences(spark, d).select((F.floor(F.length("sequence") / 6) + 2).alias("m"))
    per = m.groupBy(S.token_bucket(F.col("m")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.sum("m").alias("tokens"))
    return tokenize.within_budget(per, "bucket", "tokens", 200_000)


@query("""WITH e AS (SELECT vec_id, i, embedding[i]::DOUBLE AS x FROM embeddings, unnest(range(1, len(embedding) + 1)) AS u(i)), s AS (SELECT vec_id, count(*) FILTER (i > 1) AS n, sum(x) FILTER (i > 1) AS total, min(x) FILTER (i > 1) AS low,
  sum(x * x) FILTER (i > 1) AS squares, arg_min(i, (x, i)) FILTER (i > 1) AS place FROM e GROUP BY vec_id)
SELECT vec_id, n AS supervised_position_count, round(total, 6) AS sum_log_prob, round(total / n, 6) AS mean_log_prob, round(exp(-total / n), 6) AS perplexity, round(low, 6) AS min_token_logprob, (place - 2)::INTEGER AS argmin_position,
  round(sqrt(greatest(squares / n - (total / n) * (total / n), 0)), 6) AS per_token_logprob_std FROM s""")
def likelihood_reduction(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("lp"))
    mask = F.transform("lp", lambda x, i: F.lit(1))
    t = tokenize.reduce_likelihood(e.withColumn("mask", mask), "lp", "mask")
    return t.select("vec_id", "supervised_position_count", *[r6(F.col(c), c) for c in ("sum_log_prob", "mean_log_prob", "perplexity", "min_token_logprob", "per_token_logprob_std")], "argmin_position")
