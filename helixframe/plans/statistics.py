"""Statistical queries and layered analyses; small solves run on one aggregated row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import stats as St
from ..operators import cluster as K
from ..operators import inference as I
from ..sources.shared import cut, table
from ..streaming.ingest import validate_stream
from .adapters import LIK, SEQ, likelihoods, sequences
from .registry import query
from .vector_queries import _edges

r6 = lambda c, name: F.round(c, 6).alias(name)
n_ = lambda name="n": F.count(F.lit(1)).alias(name)


@query(f"WITH {LIK} SELECT round(regr_slope(mean_log_prob, ln(1 + sequence_length)), 6) AS slope, round(regr_intercept(mean_log_prob, ln(1 + sequence_length)), 6) AS intercept, count(*) AS n FROM lik")
def ols_length(spark: SparkSession, d: str) -> DataFrame:
    x = F.log1p("sequence_length")
    return likelihoods(spark, d).agg(r6(F.regr_slope(F.col("mean_log_prob"), x), "slope"), r6(F.regr_intercept(F.col("mean_log_prob"), x), "intercept"), n_())


_COV = "covar_pop({a}, {b}) AS {a}{b}"
_OLS = f"""{LIK}, v AS (SELECT ln(1 + sequence_length) AS x, gc_content AS g, entropy AS e, mean_log_prob AS y FROM lik),
m AS (SELECT avg(x) AS mx, avg(g) AS mg, avg(e) AS me, avg(y) AS my, {", ".join(_COV.format(a=p[0], b=p[1]) for p in ("xx", "xg", "xe", "gg", "ge", "ee", "xy", "gy", "ey"))} FROM v),
det AS (SELECT *, xx * (gg * ee - ge * ge) - xg * (xg * ee - ge * xe) + xe * (xg * ge - gg * xe) AS dd FROM m),
b AS (SELECT *, (xy * (gg * ee - ge * ge) - xg * (gy * ee - ge * ey) + xe * (gy * ge - gg * ey)) / dd AS b1, (xx * (gy * ee - ge * ey) - xy * (xg * ee - ge * xe) + xe * (xg * ey - gy * xe)) / dd AS b2,
  (xx * (gg * ey - gy * ge) - xg * (xg * ey - gy * xe) + xy * (xg * ge - gg * xe)) / dd AS b3 FROM det)"""


@query(f"WITH {_OLS} SELECT round(b1, 4) AS length, round(b2, 4) AS gc, round(b3, 4) AS entropy, round(my - b1 * mx - b2 * mg - b3 * me, 4) AS intercept FROM b")
def ols_composition(spark: SparkSession, d: str) -> DataFrame:
    v = likelihoods(spark, d).select(F.log1p("sequence_length").alias("length"), F.col("gc_content").alias("gc"), "entropy", F.col("mean_log_prob").alias("y"))
    b = I.least_squares(v, ("length", "gc", "entropy"), "y")
    return spark.createDataFrame([tuple(round(float(b[c]), 4) for c in ("length", "gc", "entropy", "intercept"))], "length double, gc double, entropy double, intercept double")


@query("""WITH r AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2 AS a, rank() OVER (ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_discount) - 1) / 2 AS b,
  rank() OVER (ORDER BY l_tax) + (count(*) OVER (PARTITION BY l_tax) - 1) / 2 AS c FROM lineitem) SELECT 'quantity' AS x, 'discount' AS y, round(corr(a, b), 6) AS rho, count(*) AS n FROM r UNION ALL SELECT 'quantity', 'tax', round(corr(a, c), 6), count(*) FROM r UNION ALL SELECT 'discount', 'tax', round(corr(b, c), 6), count(*) FROM r""")
def spearman_matrix(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").select(F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))
    return I.spearman(spark, l, ("quantity", "discount", "tax"))


@query("""WITH x AS (SELECT l_extendedprice AS x, l_returnflag = 'R' AS c FROM lineitem WHERE l_returnflag IN ('R', 'A')), r AS (SELECT *, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2 AS mid FROM x),
s AS (SELECT count(*) FILTER (c) AS n1, count(*) FILTER (NOT c) AS n0, sum(mid) FILTER (c) AS r1, avg(x) FILTER (c) AS m1, avg(x) FILTER (NOT c) AS m0, var_samp(x) FILTER (c) AS v1, var_samp(x) FILTER (NOT c) AS v0 FROM r),
k AS (SELECT DISTINCT x, sum(c::INTEGER) OVER (ORDER BY x) AS c1, sum((NOT c)::INTEGER) OVER (ORDER BY x) AS c0 FROM x)
SELECT n1, n0, round((r1 - n1 * (n1 + 1) / 2) / (n1 * n0), 6) AS auc, round((m1 - m0) / sqrt((v1 + v0) / 2), 6) AS smd, (SELECT round(max(abs(c1 / n1 - c0 / n0)), 6) FROM k) AS ks FROM s""")
def auc_ks_smd(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").where(F.col("l_returnflag").isin("R", "A"))
    return I.separation(spark, l.select(F.col("l_extendedprice").alias("x"), (F.col("l_returnflag") == "R").alias("case")))


@query("""WITH e AS (SELECT list_transform(range(1, 10), lambda i: quantile_cont) AS z FROM (SELECT 0 AS quantile_cont)), q AS (SELECT quantile_cont(l_discount, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM lineitem),
s AS (SELECT l_returnflag = 'R' AS c, l_quantity AS y, len(list_filter(q, lambda t: l_discount > t)) AS s FROM lineitem, q), g AS (SELECT s, count(*) FILTER (c) AS w, avg(y) FILTER (c) AS y1, avg(y) FILTER (NOT c) AS y0 FROM s GROUP BY s)
SELECT round(sum(w * y1) FILTER (y0 IS NOT NULL) / sum(w) FILTER (y0 IS NOT NULL), 6) AS cases, round(sum(w * y0) / sum(w) FILTER (y0 IS NOT NULL), 6) AS standardized FROM g WHERE w > 0""".replace("""e AS (SELECT list_transform(range(1, 10), lambda i: quantile_cont) AS z FROM (SELECT 0 AS quantile_cont)), """, ""))
def gc_standardized(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").select((F.col("l_returnflag") == "R").alias("case"), F.col("l_quantity").alias("y"), F.col("l_discount").alias("by"))
    return I.standardized(spark, l, 10)


@query(f"""WITH {LIK}, x AS (SELECT *, ntile(10) OVER (ORDER BY sequence_length, record_id, start, l_partkey, l_suppkey, mean_log_prob)::INTEGER AS decile FROM lik), s AS (SELECT regr_slope(mean_log_prob, ln(1 + sequence_length)) AS b, regr_intercept(mean_log_prob, ln(1 + sequence_length)) AS a FROM lik)
SELECT decile, count(*) AS n, round(avg(mean_log_prob), 6) AS mean, round(avg(mean_log_prob - a - b * ln(1 + sequence_length)), 5) AS residual, count(*) FILTER (argmin_position <= 50) AS burn_in FROM x, s GROUP BY decile""")
def likelihood_layers(spark: SparkSession, d: str) -> DataFrame:
    """Length model over all rows, its residuals and burn-in share by decile of length."""
    x = cut(spark, likelihoods(spark, d).select("sequence_length", "record_id", "start", "l_partkey", "l_suppkey", "mean_log_prob", "argmin_position"), "likelihood")
    log = F.log1p("sequence_length")
    fit = x.agg(F.regr_slope(F.col("mean_log_prob"), log).alias("b"), F.regr_intercept(F.col("mean_log_prob"), log).alias("a"))
    ranked = St.global_rank(spark, x, *[F.col(c) for c in ("sequence_length", "record_id", "start", "l_partkey", "l_suppkey", "mean_log_prob")])
    r = ranked.crossJoin(F.broadcast(fit)).withColumn("residual", F.col("mean_log_prob") - F.col("a") - F.col("b") * log)
    return r.groupBy(St.ntile(F.col("rn"), x.count(), 10).alias("decile")).agg(n_(), r6(F.avg("mean_log_prob"), "mean"), F.round(F.avg("residual"), 5).alias("residual"), F.count_if(F.col("argmin_position") <= 50).alias("burn_in"))


@query(f"""WITH {LIK}, k AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS x, l_discount AS g, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey),
b AS (SELECT p_brand, avg(x) AS m, stddev_pop(x) AS sd FROM k GROUP BY 1 HAVING count(*) >= 30), o AS (SELECT quantile_cont(x, 0.5) AS q2, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr, avg(g) AS mg, stddev_pop(g) AS sg FROM k),
z AS (SELECT k.*, CASE WHEN sd > 0 THEN (x - m) / sd ELSE 0.0 END AS zt, (x - q2) / (iqr / 1.349::DOUBLE) AS zg, (g - mg) / sg AS zc FROM k LEFT JOIN b USING (p_brand), o)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(coalesce(zt, 0), 5) AS taxon_z, round(zg, 5) AS global_z, round(zc, 5) AS content_z, (abs(coalesce(zt, 0)) > 2)::INTEGER + (abs(zg) > 2)::INTEGER + (abs(zc) > 1.5)::INTEGER AS layers FROM z""")
def anomaly_scores(spark: SparkSession, d: str) -> DataFrame:
    l, p = table(spark, d, "lineitem"), table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    k = cut(spark, l.join(p, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("x"), F.col("l_discount").alias("g"), "p_brand"), "anomaly")
    b = k.groupBy("p_brand").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("sd"), n_()).where("n >= 30").drop("n")
    o = k.agg(F.avg("g").alias("mg"), F.stddev_pop("g").alias("sg")).crossJoin(St.quantiles(spark, k, "x", {"q1": 0.25, "q2": 0.5, "q3": 0.75}))
    z = k.join(b, "p_brand", "left").crossJoin(F.broadcast(o)).withColumns({
        "taxon_z": F.coalesce(St.zscore(F.col("x"), F.col("m"), F.col("sd")), F.lit(0.0)), "global_z": St.robust_iqr(F.col("x"), F.col("q2"), F.col("q1"), F.col("q3")), "content_z": St.zscore(F.col("g"), F.col("mg"), F.col("sg")),
    })
    over = lambda c, t: (F.abs(c) > t).cast("int")
    return z.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[F.round(c, 5).alias(c) for c in ("taxon_z", "global_z", "content_z")], (over("taxon_z", 2) + over("global_z", 2) + over("content_z", 1.5)).alias("layers"))


@query("""WITH s AS (SELECT count(*) FILTER (l_returnflag = 'R') AS n1, count(*) FILTER (l_returnflag = 'N') AS n0, avg(l_quantity) FILTER (l_returnflag = 'R') AS m1, avg(l_quantity) FILTER (l_returnflag = 'N') AS m0, var_samp(l_quantity) FILTER (l_returnflag = 'R') AS v1, var_samp(l_quantity) FILTER (l_returnflag = 'N') AS v0 FROM lineitem)
SELECT round((m1 - m0) / sqrt(v1 / n1 + v0 / n0), 6) AS t, round((v1 / n1 + v0 / n0) ** 2 / ((v1 / n1) ** 2 / (n1 - 1) + (v0 / n0) ** 2 / (n0 - 1)), 3) AS df, round((m1 - m0) / sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / (n1 + n0 - 2)), 6) AS cohens_d, round(1.96 * sqrt(v1) / sqrt(n1), 6) AS ci FROM s""")
def welch_test(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("group"), F.col("l_quantity").alias("x"))
    return I.welch(l, "R", "N").select(r6(F.col("t"), "t"), F.round("df", 3).alias("df"), r6(F.col("cohens_d"), "cohens_d"), r6(F.col("ci"), "ci"))


@query("""WITH m AS (SELECT median(c_acctbal) AS q FROM customer), x AS (SELECT c_custkey, coalesce(c_acctbal, q) AS a FROM customer, m), s AS (SELECT avg(a) AS m, stddev_pop(a) AS sd FROM x) SELECT c_custkey, round(CASE WHEN sd > 0 THEN (a - m) / sd ELSE 0.0 END, 6) AS z FROM x, s""")
def standardize_features(spark: SparkSession, d: str) -> DataFrame:
    return I.standardize(spark, table(spark, d, "customer").select("c_custkey", "c_acctbal"), ("c_acctbal",)).select("c_custkey", r6(F.col("c_acctbal"), "z"))


@query("""WITH t AS (SELECT count(*) AS total FROM events) SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, count(*) FILTER (props IS NULL) AS missing_props FROM events GROUP BY event_type""")
def stream_validate(spark: SparkSession, d: str) -> DataFrame:
    """Counters of the events table, ingested as a stream with trigger availableNow."""
    return validate_stream(spark, d)


@query("""WITH c AS (SELECT text, count(*) AS copies FROM documents GROUP BY text) SELECT copies, count(*) AS groups, (copies * count(*))::BIGINT AS rows FROM c GROUP BY copies""")
def copy_histogram(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "documents").groupBy(F.sha2("text", 256).alias("h")).agg(n_("copies"))
    return c.groupBy("copies").agg(n_("groups")).withColumn("rows", F.col("copies") * F.col("groups"))


@query("""WITH s AS (SELECT l_returnflag, l_suppkey, count(*) AS n, avg(l_quantity) AS m FROM lineitem GROUP BY ALL) SELECT l_returnflag, count(*) AS clusters, round(avg(m), 6) AS mean_of_means, round(quantile_cont(m, 0.05), 6) AS q05, round(quantile_cont(m, 0.95), 6) AS q95 FROM s GROUP BY 1""")
def cluster_means(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "lineitem").groupBy("l_returnflag", "l_suppkey").agg(F.avg("l_quantity").alias("m"))
    return s.groupBy("l_returnflag").agg(n_("clusters"), r6(F.avg("m"), "mean_of_means"), r6(F.percentile("m", 0.05), "q05"), r6(F.percentile("m", 0.95), "q95"))


@query()
def cluster_robust_ols(spark: SparkSession, d: str) -> DataFrame:
    """Slope of price on quantity with standard errors robust to suppliers as clusters."""
    l = table(spark, d, "lineitem").select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"), F.col("l_suppkey").alias("cluster"))
    return I.cluster_robust(spark, l)


@query()
def bootstrap_ci(spark: SparkSession, d: str) -> DataFrame:
    """Percentile interval of the mean order price from 200 Poisson-weighted replicates."""
    return I.bootstrap(table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("x")), 200)


@query()
def permutation_null(spark: SparkSession, d: str) -> DataFrame:
    """One-sided p of the difference in mean price of one order status, labels shuffled within priorities."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("x"), (F.col("o_orderstatus") == "F").cast("int").alias("case"), F.col("o_orderpriority").alias("stratum"))
    return I.permutation(spark, o, 50)


@query()
def cluster_bootstrap_ci(spark: SparkSession, d: str) -> DataFrame:
    """Interval of the mean line price where whole orders are drawn."""
    return I.cluster_bootstrap(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("cluster"), F.col("l_extendedprice").alias("x")), 200)


@query()
def graph_permutation(spark: SparkSession, d: str) -> DataFrame:
    """Share of neighbour edges between equal labels against labels shuffled within strata, on the fixed graph."""
    u, edges, _ = _edges(spark, d)
    labels = u.select("id", "label", (F.col("id") % 3).alias("stratum"))
    return I.graph_permutation(spark, edges.select(F.col("query").alias("u"), F.col("neighbour").alias("v")), labels, 100)


@query("""WITH x AS (SELECT l_quantity - avg(l_quantity) OVER (PARTITION BY l_suppkey) AS x, l_extendedprice - avg(l_extendedprice) OVER (PARTITION BY l_suppkey) AS y FROM lineitem) SELECT round(sum(x * y) / sum(x * x), 4) AS slope, count(*) AS n FROM x""")
def fixed_effects_slope(spark: SparkSession, d: str) -> DataFrame:
    """Slope of price on quantity with fixed effects of suppliers."""
    l = table(spark, d, "lineitem").select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"), "l_suppkey")
    w = I.within_groups(l, ("x", "y"), "l_suppkey")
    return w.agg(F.round(F.sum(F.col("x") * F.col("y")) / F.sum(F.col("x") * F.col("x")), 4).alias("slope"), n_())


@query("""WITH s AS (SELECT count(*) FILTER (l_returnflag = 'R') AS n1, count(*) FILTER (l_returnflag = 'N') AS n0, avg(l_quantity) FILTER (l_returnflag = 'R') AS m1, avg(l_quantity) FILTER (l_returnflag = 'N') AS m0, var_samp(l_quantity) FILTER (l_returnflag = 'R') AS v1,
  var_samp(l_quantity) FILTER (l_returnflag = 'N') AS v0 FROM lineitem), t AS (SELECT abs((m1 - m0) / sqrt(v1 / n1 + v0 / n0)) AS t FROM s),
-- degrees of freedom are in the thousands: Simpson's rule over the normal density, to three places
g AS (SELECT t, i, exp(-0.5 * (t * i / 2000.0) ** 2) / sqrt(2 * pi()) * CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS f FROM t, range(0, 2001) AS r(i))
SELECT round(1 - 2 * sum(f) * any_value(t) / 2000.0 / 3, 2) AS p FROM g""")
def welch_p(spark: SparkSession, d: str) -> DataFrame:
    """Two-sided p of Welch's test."""
    l = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("group"), F.col("l_quantity").alias("x"))
    t, df = I.welch(l, "R", "N").select("t", "df").first()  # one row
    return spark.createDataFrame([(round(I.two_sided_p(t, df), 2),)], "p double")


def _points(spark, d):
    s = sequences(spark, d)
    return s.select(F.col("doc_id").alias("id"), (F.log10(F.length("sequence") + 1.0) * 4).alias("x"), (F.length("sequence") % 97 / 24.0).alias("y"))


_POINTS = f"""{SEQ}, p AS (SELECT doc_id AS id, log10(length(sequence) + 1.0) * 4 AS x, length(sequence) % 97 / 24.0::DOUBLE AS y FROM seq),
near AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= {{r}} * {{r}}), core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= 20),
reach AS (SELECT id AS a, id AS b FROM core UNION SELECT reach.a, near.b FROM reach JOIN near ON reach.b = near.a JOIN core ON core.id = near.b)"""


@query("WITH RECURSIVE " + _POINTS.format(r=0.8) + " SELECT p.id, core.id IS NOT NULL AS core FROM p LEFT JOIN core ON p.id = core.id")
def grid_density(spark: SparkSession, d: str) -> DataFrame:
    """Core points of a density clustering in two dimensions, over a grid of cells."""
    return K.core_points(spark, _points(spark, d), 0.8, 20).select("id", "core")


@query("WITH RECURSIVE " + _POINTS.format(r=0.8) + " SELECT a AS id, min(b) AS cluster FROM reach GROUP BY a")
def density_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of the core points, named by their least id."""
    c = K.density_clusters(spark, _points(spark, d), 0.8, 20).where("core")
    names = c.groupBy("cluster").agg(F.min("id").alias("name"))
    return c.join(names, "cluster").select("id", F.col("name").alias("cluster"))


@query()
def cluster_stability(spark: SparkSession, d: str) -> DataFrame:
    """Clusters at radius 0.8 against those at 1.0 and 1.2: the best Jaccard share of each."""
    p = cut(spark, _points(spark, d), "points")
    base = cut(spark, K.density_clusters(spark, p, 0.8, 20), "clusters")
    parts = [K.stability(base, K.density_clusters(spark, p, r, 20)).withColumn("radius", F.lit(r)) for r in (1.0, 1.2)]
    return parts[0].unionByName(parts[1])
