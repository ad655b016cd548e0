"""Queries of the layered likelihood analysis and of the anomaly pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats as St
from ..operators import layers as Y
from ..sources.shared import cut, table
from .registry import query

r5 = lambda c: St.rounded(F.col(c), 5).alias(c)
KEY = ("record_id", "start", "part")
RECURRENT = (7, 13, 21)


def intervals(spark: SparkSession, d: str) -> DataFrame:
    """Scored intervals made of line items; features are missing for some."""
    q, p, s = F.col("l_quantity"), F.col("l_partkey"), F.col("l_suppkey")
    mean = -F.col("l_extendedprice") / 10000.0
    featured = s % 11 != 0
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("record_id"), F.col("l_linenumber").alias("start"), p.alias("part"), (q * 20).alias("sequence_length"), q.cast("bigint").alias("supervised_position_count"),
        mean.alias("mean_log_prob"), (mean * (1 + F.col("l_discount") * 10) - 0.5).alias("min_token_logprob"), (p % 100).alias("argmin_position"), F.col("l_tax").alias("per_token_logprob_std"),
        F.when(featured, F.col("l_discount") * 5 + 0.2).alias("gc_content"), F.when(featured, 2 - F.col("l_tax") * 8).alias("entropy"),
    )


_INT = """i AS (SELECT l_orderkey AS record_id, l_linenumber AS start, l_partkey AS part, l_quantity * 20 AS sequence_length, l_quantity::BIGINT AS positions, -l_extendedprice / 10000.0::DOUBLE AS mean_log_prob,
    -l_extendedprice / 10000.0::DOUBLE * (1 + l_discount * 10) - 0.5::DOUBLE AS least, l_partkey % 100 AS argmin_position, l_tax AS sd, CASE WHEN l_suppkey % 11 <> 0 THEN l_discount * 5 + 0.2::DOUBLE END AS gc,
    CASE WHEN l_suppkey % 11 <> 0 THEN 2 - l_tax * 8 END AS entropy FROM lineitem),
base AS (SELECT *, CASE WHEN sd > 0 THEN (mean_log_prob - least) / sd ELSE 0 END AS local_z, (argmin_position <= 50)::INTEGER AS burn_in,
    CASE WHEN positions > 1 THEN (mean_log_prob * positions - least) / (positions - 1) ELSE mean_log_prob END AS background, CASE WHEN mean_log_prob < 0 THEN least / mean_log_prob END AS depth FROM i)"""


@query(f"WITH {_INT} SELECT record_id, start, part, round(local_z, 5) AS local_anomaly_z, burn_in AS is_burn_in, round(background, 5) AS background_mean_log_prob, round(depth, 5) AS anomaly_depth_ratio FROM base")
def likelihood_base(spark: SparkSession, d: str) -> DataFrame:
    return Y.likelihood_base(intervals(spark, d)).select(*KEY, r5("local_anomaly_z"), "is_burn_in", r5("background_mean_log_prob"), r5("anomaly_depth_ratio"))


_MODEL = f"""{_INT}, v AS (SELECT *, ln(1 + sequence_length) AS x FROM base), l AS (SELECT regr_slope(mean_log_prob, x) AS b, regr_intercept(mean_log_prob, x) AS a FROM v),
k AS (SELECT x, gc AS g, entropy AS e, mean_log_prob AS y FROM v WHERE gc IS NOT NULL AND entropy IS NOT NULL),
m AS (SELECT avg(x) AS mx, avg(g) AS mg, avg(e) AS me, avg(y) AS my, covar_pop(x, x) AS xx, covar_pop(x, g) AS xg, covar_pop(x, e) AS xe, covar_pop(g, g) AS gg, covar_pop(g, e) AS ge, covar_pop(e, e) AS ee, covar_pop(x, y) AS xy,
  covar_pop(g, y) AS gy, covar_pop(e, y) AS ey FROM k),
f AS (SELECT *, xx * (gg * ee - ge * ge) - xg * (xg * ee - ge * xe) + xe * (xg * ge - gg * xe) AS dd FROM m),
c AS (SELECT *, (xy * (gg * ee - ge * ge) - xg * (gy * ee - ge * ey) + xe * (gy * ge - gg * ey)) / dd AS b1, (xx * (gy * ee - ge * ey) - xy * (xg * ee - ge * xe) + xe * (xg * ey - gy * xe)) / dd AS b2,
  (xx * (gg * ey - gy * ge) - xg * (xg * ey - gy * xe) + xy * (xg * ge - gg * xe)) / dd AS b3 FROM f),
s AS (SELECT v.*, mean_log_prob - a - b * x AS la, mean_log_prob - ((my - b1 * mx - b2 * mg - b3 * me) + b1 * x + b2 * gc + b3 * entropy) AS ca, -least AS ts, argmin_position / greatest(positions, 1) AS place FROM v, l, c)"""
_ELEMENT = "(SELECT list_sort(list({c}))[floor({p} * count({c}))::INTEGER + 1] FROM {t})"


@query(f"WITH {_MODEL} SELECT record_id, start, part, round(la, 4) AS length_adjusted, round(ca, 4) AS composition_adjusted FROM s")
def likelihood_composition(spark: SparkSession, d: str) -> DataFrame:
    """Residuals of both models, row by row."""
    s = Y.composition_model(Y.length_model(Y.likelihood_base(intervals(spark, d))))
    return s.select(*KEY, F.round("length_adjusted", 4).alias("length_adjusted"), F.round("composition_adjusted", 4).alias("composition_adjusted"))


@query(f"""WITH {_MODEL}, o AS (SELECT avg(la) AS lm, stddev_samp(la) AS ls, avg(ca) AS cm, stddev_samp(ca) AS cs, avg(ts) AS tm, stddev_samp(ts) AS tss, avg(sd) AS hm, stddev_samp(sd) AS hs FROM s),
q AS (SELECT {_ELEMENT.format(c="la", p=0.5, t="s")} AS med, {_ELEMENT.format(c="la", p=0.05, t="s")} AS ll, {_ELEMENT.format(c="la", p=0.95, t="s")} AS lh, {_ELEMENT.format(c="ca", p=0.05, t="s")} AS cl, {_ELEMENT.format(c="ca", p=0.95, t="s")} AS ch),
w AS (SELECT abs(la - med) AS away FROM s, q), mad AS (SELECT {_ELEMENT.format(c="away", p=0.5, t="w")} AS mad)
SELECT record_id, start, part, round((la - lm) / ls, 3) AS length_adjusted_z, round((la - med) / (mad * 1.4826), 3) AS length_adjusted_robust_z, round((ca - cm) / cs, 3) AS composition_adjusted_z, round((ts - tm) / tss, 3) AS token_surprise_z,
  round((sd - hm) / hs, 3) AS heterogeneity_z, round(place, 5) AS relative_position, coalesce(la >= lh, false)::INTEGER AS top_length, coalesce(la <= ll, false)::INTEGER AS bottom_length,
  coalesce(ca >= ch, false)::INTEGER AS top_composition, coalesce(ca <= cl, false)::INTEGER AS bottom_composition FROM s, o, q, mad""")
def record_metrics(spark: SparkSession, d: str) -> DataFrame:
    r = Y.record_metrics(spark, intervals(spark, d))
    z = [F.round(c, 3).alias(c) for c in ("length_adjusted_z", "length_adjusted_robust_z", "composition_adjusted_z", "token_surprise_z", "heterogeneity_z")]
    return r.select(*KEY, *z, r5("relative_position"), "top_length", "bottom_length", "top_composition", "bottom_composition")


@query(f"""WITH {_MODEL}, x AS (SELECT *, ntile(10) OVER (ORDER BY sequence_length, record_id, start, part, mean_log_prob)::INTEGER AS decile FROM s)
SELECT decile, count(*) AS n, min(sequence_length) AS low, max(sequence_length) AS high, round(list_sort(list(mean_log_prob))[floor(0.5 * count(*))::INTEGER + 1], 5) AS raw_median, round(list_sort(list(la))[floor(0.5 * count(*))::INTEGER + 1], 4) AS adjusted_median,
  round(list_sort(list(background))[floor(0.5 * count(*))::INTEGER + 1], 5) AS background_median, round(list_sort(list(local_z))[floor(0.5 * count(*))::INTEGER + 1], 5) AS local_median FROM x GROUP BY decile""")
def length_conditional(spark: SparkSession, d: str) -> DataFrame:
    """Medians of four columns by decile of length."""
    s = cut(spark, Y.length_model(Y.likelihood_base(intervals(spark, d))), "length-model")
    ranked = St.global_rank(spark, s, *[F.col(c) for c in ("sequence_length", *KEY, "mean_log_prob")])
    x = cut(spark, ranked.withColumn("decile", St.ntile(F.col("rn"), s.count(), 10)), "length-deciles")
    out = x.groupBy("decile").agg(F.count(F.lit(1)).alias("n"), F.min("sequence_length").alias("low"), F.max("sequence_length").alias("high"))
    for name, c, places in (("raw_median", "mean_log_prob", 5), ("adjusted_median", "length_adjusted", 4), ("background_median", "background_mean_log_prob", 5), ("local_median", "local_anomaly_z", 5)):
        q = St.quantiles(spark, x, c, {name: 0.5}, ("decile",), interpolated=False)
        out = out.join(q.withColumn(name, St.rounded(F.col(name), places)), "decile")
    return out


def anomaly_input(spark: SparkSession, d: str) -> DataFrame:
    """Complete rows with a group, perplexity, embedding norm and top dimensions."""
    p, s, price = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("record_id"), F.col("l_linenumber").alias("start"), p.alias("part"), F.when(s % 9 == 0, F.concat(F.lit("rare"), p % 700)).otherwise(F.concat(F.lit("t"), s % 23)).alias("taxon"),
        (F.col("l_quantity") * 20).alias("sequence_length"), (F.col("l_discount") * 5 + 0.2).alias("gc_content"), (2 - F.col("l_tax") * 8).alias("entropy"), (price / 20).alias("perplexity"),
        (1 + (p % 37) / 10.0).alias("embedding_norm"), (-price / 5000).alias("min_token_logprob"), F.col("l_tax").alias("per_token_logprob_std"), (p % 400).alias("argmin_position"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_coding"), F.array((p % 50).cast("int"), (s % 50).cast("int")).alias("top_dimensions"),
    )


_SCORED = f"""b AS (SELECT l_orderkey AS record_id, l_linenumber AS start, l_partkey AS part, CASE WHEN l_suppkey % 9 = 0 THEN 'rare' || (l_partkey % 700) ELSE 't' || (l_suppkey % 23) END AS taxon,
  l_quantity * 20 AS sequence_length, l_discount * 5 + 0.2::DOUBLE AS gc_content, 2 - l_tax * 8 AS entropy, l_extendedprice / 20 AS perplexity, 1 + (l_partkey % 37) / 10.0::DOUBLE AS norm, -l_extendedprice / 5000 AS min_token, l_tax AS token_std,
  l_partkey % 400 AS argmin_position, (l_returnflag = 'R')::INTEGER AS is_coding, [l_partkey % 50, l_suppkey % 50] AS dims FROM lineitem),
o AS (SELECT avg(gc_content) AS gm, stddev_pop(gc_content) AS gs, avg(sequence_length) AS lm, stddev_pop(sequence_length) AS ls, avg(perplexity) AS pm, stddev_pop(perplexity) AS ps, avg(norm) AS nm, stddev_pop(norm) AS ns, avg(entropy) AS em, stddev_pop(entropy) AS es,
  avg(min_token) AS mm, stddev_pop(min_token) AS ms, avg(token_std) AS tm, stddev_pop(token_std) AS ts, quantile_cont(sequence_length, 0.25) AS q1, quantile_cont(sequence_length, 0.5) AS q2, quantile_cont(sequence_length, 0.75) AS q3 FROM b),
g AS (SELECT taxon, count(*) AS taxon_n, avg(gc_content) AS tgm, stddev_pop(gc_content) AS tgs, avg(perplexity) AS tpm, stddev_pop(perplexity) AS tps, avg(norm) AS tnm, stddev_pop(norm) AS tns FROM b GROUP BY taxon),
z AS (SELECT b.*, taxon_n, (gc_content - gm) / gs AS gc_z, (sequence_length - lm) / ls AS length_z, (sequence_length - q2) / ((q3 - q1) / 1.349::DOUBLE) AS length_z_robust, (perplexity - pm) / ps AS perplexity_z, (norm - nm) / ns AS norm_z,
  (entropy - em) / es AS entropy_z, (min_token - mm) / ms AS min_token_z, (token_std - tm) / ts AS token_std_z, CASE WHEN taxon_n >= 20 AND tgs > 0 THEN (gc_content - tgm) / tgs ELSE 0 END AS taxon_gc_z,
  CASE WHEN taxon_n >= 20 AND tps > 0 THEN (perplexity - tpm) / tps ELSE 0 END AS taxon_perplexity_z, CASE WHEN taxon_n >= 20 AND tns > 0 THEN (norm - tnm) / tns ELSE 0 END AS taxon_norm_z,
  percent_rank() OVER (PARTITION BY b.taxon ORDER BY gc_content) AS r1, percent_rank() OVER (PARTITION BY b.taxon ORDER BY sequence_length) AS r2, percent_rank() OVER (PARTITION BY b.taxon ORDER BY perplexity) AS r3,
  percent_rank() OVER (PARTITION BY b.taxon ORDER BY norm) AS r4 FROM b JOIN g USING (taxon), o),
s0 AS (SELECT *, CASE WHEN taxon_n >= 20 THEN r1 END AS gc_percentile, CASE WHEN taxon_n >= 20 THEN r2 END AS length_percentile, CASE WHEN taxon_n >= 20 THEN r3 END AS perplexity_percentile, CASE WHEN taxon_n >= 20 THEN r4 END AS norm_percentile,
  (abs(gc_z) + abs(length_z) + abs(perplexity_z) + abs(norm_z)) / 4 AS multi_layer, (abs(gc_z) + abs(length_z_robust) + abs(perplexity_z) + abs(norm_z)) / 4 AS multi_layer_robust, (abs(gc_z) + abs(perplexity_z) + abs(norm_z)) / 3 AS content,
  (abs(taxon_gc_z) + abs(taxon_perplexity_z) + abs(taxon_norm_z)) / 3 AS taxon_aware, (abs(perplexity_z) + abs(min_token_z) + abs(token_std_z)) / 3 AS likelihood_signal, (abs(gc_z) + abs(length_z) + abs(perplexity_z)) / 3 AS non_embedding,
  (abs(gc_z) + abs(length_z) + abs(entropy_z) + abs(is_coding - 0.5::DOUBLE) * 2) / 4 AS cpu_signal, (abs(gc_z) >= 3)::INTEGER + (abs(length_z) >= 3)::INTEGER + (abs(perplexity_z) >= 3)::INTEGER + (abs(norm_z) >= 3)::INTEGER AS outlier_layers,
  least(abs(argmin_position::DOUBLE), abs(sequence_length - argmin_position)) AS edge_distance, argmin_position / sequence_length AS relative_position FROM z),
s AS (SELECT *, edge_distance < 50 AS edge_artifact, entropy < 1.5 AS low_entropy, gc_content NOT BETWEEN 0.25 AND 0.7 AS extreme_gc, perplexity NOT BETWEEN 50 AND 4000 AS perplexity_artifact, list_has_any(dims, [7, 13, 21]) AS recurrent_dimension,
  content * CASE WHEN edge_distance < 50 THEN 0.1::DOUBLE ELSE 1 END * CASE WHEN entropy < 1.5 THEN 0.2::DOUBLE ELSE 1 END AS bio_content FROM s0)"""


def _scored(spark, d):
    return Y.anomaly_layers(spark, anomaly_input(spark, d), RECURRENT)


_NUMBERS = (
    "gc_z", "length_z", "length_z_robust", "perplexity_z", "norm_z", "entropy_z", "min_token_z", "token_std_z", "taxon_gc_z", "taxon_perplexity_z", "taxon_norm_z", "gc_percentile", "length_percentile", "perplexity_percentile",
    "norm_percentile", "multi_layer", "multi_layer_robust", "content", "taxon_aware", "likelihood_signal", "non_embedding", "cpu_signal", "relative_position", "bio_content",
)
_FLAGS = ("outlier_layers", "edge_artifact", "low_entropy", "recurrent_dimension", "taxon_n")


@query(f"WITH {_SCORED} SELECT record_id, start, part, taxon, {', '.join(f'round({c}, 5) AS {c}' for c in _NUMBERS)}, {', '.join(_FLAGS)} FROM s")
def anomaly_layers(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select(*KEY, "taxon", *[r5(c) for c in _NUMBERS], *_FLAGS)


@query(f"WITH {_SCORED} SELECT count(*) AS n, round(avg(bio_content), 6) AS bio_mean, round(avg(taxon_aware), 6) AS taxon_mean, count(*) FILTER (edge_artifact) AS edge, count(*) FILTER (low_entropy) AS low, count(*) FILTER (recurrent_dimension) AS recurrent FROM s")
def anomaly_summary(spark: SparkSession, d: str) -> DataFrame:
    s = _scored(spark, d)
    mean = lambda c, name: F.round(F.avg(c), 6).alias(name)
    return s.agg(F.count(F.lit(1)).alias("n"), mean("bio_content", "bio_mean"), mean("taxon_aware", "taxon_mean"), F.count_if("edge_artifact").alias("edge"), F.count_if("low_entropy").alias("low"), F.count_if("recurrent_dimension").alias("recurrent"))


def _top(df: DataFrame, *scores: str) -> DataFrame:
    """The 1000 best by scores (rounded, so that ties are ties), then by key: a report of fixed size."""
    ranked = df.select(*KEY, *[F.round(c, 4).alias(c) for c in scores])
    return ranked.orderBy(*[F.desc(c) for c in scores], *KEY, *scores).limit(1000)


def _top_sql(where: str, *scores: str) -> str:
    cols = ", ".join(f"round({c}, 4) AS {c}" for c in scores)
    return f"WITH {_SCORED}, t AS (SELECT record_id, start, part, {cols} FROM s WHERE {where}) SELECT * FROM t ORDER BY {', '.join(f'{c} DESC' for c in scores)}, record_id, start, part LIMIT 1000"


@query(_top_sql("true", "multi_layer"))
def top_multi_layer(spark: SparkSession, d: str) -> DataFrame:
    return _top(_scored(spark, d), "multi_layer")


@query(_top_sql("sequence_length BETWEEN 100 AND 800 AND taxon_n >= 20", "content"))
def top_content(spark: SparkSession, d: str) -> DataFrame:
    return _top(_scored(spark, d).where("sequence_length between 100 and 800 and taxon_n >= 20"), "content")


@query(_top_sql("taxon_n >= 20 AND NOT edge_artifact AND NOT low_entropy AND NOT extreme_gc AND NOT perplexity_artifact AND NOT recurrent_dimension", "bio_content", "taxon_aware"))
def top_biological(spark: SparkSession, d: str) -> DataFrame:
    return _top(Y.biological(_scored(spark, d)), "bio_content", "taxon_aware")


@query(_top_sql("gc_content > 0.6 AND taxon_n >= 20 AND gc_percentile > 0.8", "gc_z"))
def top_high_gc(spark: SparkSession, d: str) -> DataFrame:
    return _top(_scored(spark, d).where("gc_content > 0.6 and gc_percentile > 0.8"), "gc_z")


@query(_top_sql("is_coding = 0 AND taxon_n >= 20 AND NOT edge_artifact AND NOT low_entropy", "bio_content"))
def top_non_coding(spark: SparkSession, d: str) -> DataFrame:
    return _top(_scored(spark, d).where("is_coding = 0 and taxon_n >= 20 and not edge_artifact and not low_entropy"), "bio_content")


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings) SELECT vec_id, len(v)::INTEGER AS profile_length, round(list_min(v), 6) AS profile_min, round(list_max(v), 6) AS profile_max, round(list_avg(v), 6) AS profile_mean FROM v""")
def token_profile(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    p = Y.token_profile(F.col("v"))
    return e.select("vec_id", p["profile_length"].alias("profile_length"), *[F.round(p[c], 6).alias(c) for c in ("profile_min", "profile_max", "profile_mean")])
