"""Queries of the relational core: joins, duplicates, quantiles, windows, top-k, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import stats as St
from ..operators import duplicates as D
from ..sources.shared import table
from .adapters import LIK, likelihoods
from .registry import query

r6 = lambda c, name: F.round(c, 6).alias(name)
n_ = lambda name="n": F.count(F.lit(1)).alias(name)


@query("SELECT l_orderkey, l_linenumber, l_quantity, o_orderstatus FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_totalprice > 100000")
def left_join_features(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").where("o_totalprice > 100000").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    return table(spark, d, "lineitem").join(o, "l_orderkey", "left").select("l_orderkey", "l_linenumber", "l_quantity", "o_orderstatus")


@query("""SELECT c_mktsegment, p_brand, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def three_way_inner(spark: SparkSession, d: str) -> DataFrame:
    l, o, c, p = (table(spark, d, t) for t in ("lineitem", "orders", "customer", "part"))
    j = l.join(o, l.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(p, l.l_partkey == p.p_partkey)
    return j.groupBy("c_mktsegment", "p_brand").agg(n_(), F.round(F.sum("l_extendedprice"), 2).alias("total"))


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE (l_orderkey, l_linenumber) IN (SELECT o_orderkey, o_custkey % 4 + 1 FROM orders)")
def tuple_semi_join(spark: SparkSession, d: str) -> DataFrame:
    cohort = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 4 + 1).alias("l_linenumber"))
    return table(spark, d, "lineitem").join(cohort, ["l_orderkey", "l_linenumber"], "left_semi").select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000)")
def pending_anti(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").join(table(spark, d, "orders").where("o_totalprice > 250000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("""WITH s AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS sd FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN sd > 0 THEN (l_extendedprice - m) / sd ELSE 0.0 END, 6) AS z FROM lineitem, s""")
def crossjoin_stats_z(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem")
    s = l.agg(F.avg("l_extendedprice").alias("m"), F.stddev_pop("l_extendedprice").alias("sd"))
    return l.crossJoin(F.broadcast(s)).select("l_orderkey", "l_linenumber", "l_partkey", r6(St.zscore(F.col("l_extendedprice"), F.col("m"), F.col("sd")), "z"))


@query("""WITH s AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS q2, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, round((l_extendedprice - q2) / ((q3 - q1) / 1.349::DOUBLE), 5) AS z FROM lineitem JOIN s USING (l_returnflag)""")
def robust_z(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem")
    s = St.quantiles(spark, l, "l_extendedprice", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, ("l_returnflag",))
    z = St.robust_iqr(F.col("l_extendedprice"), F.col("q2"), F.col("q1"), F.col("q3"))
    return l.join(s, "l_returnflag").select("l_orderkey", "l_linenumber", "l_partkey", F.round(z, 5).alias("z"))


@query("""WITH g AS (SELECT p_brand, avg(p_retailprice) AS m, stddev_pop(p_retailprice) AS sd, count(*) AS n FROM part GROUP BY 1 HAVING count(*) >= 30)
SELECT p_partkey, p.p_brand, n AS group_n, round(CASE WHEN sd > 0 THEN (p_retailprice - m) / sd ELSE 0.0 END, 6) AS z FROM part p LEFT JOIN g ON p.p_brand = g.p_brand""")
def group_stats_left_join(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    g = p.groupBy("p_brand").agg(F.avg("p_retailprice").alias("m"), F.stddev_pop("p_retailprice").alias("sd"), n_("group_n")).where("group_n >= 30")
    return p.join(g, "p_brand", "left").select("p_partkey", "p_brand", "group_n", r6(St.zscore(F.col("p_retailprice"), F.col("m"), F.col("sd")), "z"))


@query(f"""WITH {LIK} SELECT record_id, start, round(avg(mean_log_prob), 8) AS mean_log_prob, count(*) AS copies, round(max(mean_log_prob) - min(mean_log_prob), 6) AS spread FROM lik GROUP BY ALL""")
def dup_collapse(spark: SparkSession, d: str) -> DataFrame:
    c = D.collapse(likelihoods(spark, d), ("record_id", "start"), "mean_log_prob")
    return c.select("record_id", "start", F.round("mean_log_prob", 8).alias("mean_log_prob"), "copies", r6(F.col("spread"), "spread"))


@query(f"""WITH {LIK}, k AS (SELECT count(*) AS c, max(mean_log_prob) - min(mean_log_prob) AS spread FROM lik GROUP BY record_id, start)
SELECT sum(c)::BIGINT AS raw_rows, count(*) AS unique_keys, count(*) FILTER (c > 1) AS duplicated, count(*) FILTER (spread > 0) AS disagreeing, round(max(spread), 6) AS max_spread FROM k""")
def dedupe_report(spark: SparkSession, d: str) -> DataFrame:
    return D.report(D.collapse(likelihoods(spark, d), ("record_id", "start"), "mean_log_prob"))


@query(f"""WITH {LIK} SELECT record_id, arg_min(argmin_position, (mean_log_prob, argmin_position)) AS position FROM lik GROUP BY record_id""")
def argmin_position(spark: SparkSession, d: str) -> DataFrame:
    return likelihoods(spark, d).groupBy("record_id").agg(F.min_by("argmin_position", F.struct("mean_log_prob", "argmin_position")).alias("position"))


@query("""WITH h AS (SELECT upper(sha256(text)) AS hash, count(*) AS n FROM documents GROUP BY 1) SELECT doc_id, hash AS sequence_hash, n AS copies FROM documents JOIN h ON upper(sha256(text)) = hash""")
def exact_dup_counts(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "documents").select("doc_id", F.upper(F.sha2("text", 256)).alias("sequence_hash"))
    return h.join(h.groupBy("sequence_hash").agg(n_("copies")), "sequence_hash").select("doc_id", "sequence_hash", "copies")


@query("""WITH h AS (SELECT count(*) AS c FROM documents GROUP BY text), k AS (SELECT CASE WHEN c >= 3 THEN '3+' ELSE c::VARCHAR END AS category, c FROM h), a(category) AS (VALUES ('1'), ('2'), ('3+'))
SELECT category, count(c) AS groups, coalesce(sum(c), 0)::BIGINT AS rows FROM a LEFT JOIN k USING (category) GROUP BY category""")
def copy_category(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "documents").groupBy(F.sha2("text", 256).alias("h")).agg(n_("c"))
    k = per.groupBy(F.when(F.col("c") >= 3, "3+").otherwise(F.col("c").cast("string")).alias("category")).agg(n_("groups"), F.sum("c").alias("rows"))
    every = spark.createDataFrame([("1",), ("2",), ("3+",)], "category string")
    return every.join(k, "category", "left").select("category", F.coalesce("groups", F.lit(0)).alias("groups"), F.coalesce("rows", F.lit(0)).alias("rows"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) AS k FROM lineitem) WHERE k = 1""")
def keep_first(spark: SparkSession, d: str) -> DataFrame:
    return D.keep_first(table(spark, d, "lineitem"), ("l_orderkey", "l_linenumber"), "l_partkey", "l_suppkey", "l_quantity").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("""WITH x AS (SELECT o_orderkey, o_totalprice, ntile(10) OVER (ORDER BY o_totalprice, o_orderkey)::INTEGER AS decile FROM orders)
SELECT decile, count(*) AS n, min(o_totalprice) AS low, max(o_totalprice) AS high, round(avg(o_totalprice), 4) AS mean FROM x GROUP BY decile""")
def length_deciles(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    r = St.global_rank(spark, o, F.col("o_totalprice"), F.col("o_orderkey"))
    return r.groupBy(St.ntile(F.col("rn"), o.count(), 10).alias("decile")).agg(n_(), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"), F.round(F.avg("o_totalprice"), 4).alias("mean"))


@query("""SELECT p_partkey, p_brand, round(percent_rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice), 6) AS pr, count(*) OVER (PARTITION BY p_brand) AS group_n FROM part""")
def percent_rank_within(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", "p_brand", F.col("p_retailprice").alias("value"))
    per = St.value_counts(spark, p, "value", ("p_brand",))
    below = F.when(F.col("n") > 1, (F.col("upto_c") - F.col("c")) / (F.col("n") - 1)).otherwise(0.0)
    per = per.select("p_brand", "value", r6(below, "pr"), F.col("n").alias("group_n"))
    return p.join(per, ["p_brand", "value"]).select("p_partkey", "p_brand", "pr", "group_n")


@query("""WITH r AS (SELECT l_returnflag, l_extendedprice AS x, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS i, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
SELECT l_returnflag, max(x) FILTER (i = floor(0.25 * n)::BIGINT) AS q25, max(x) FILTER (i = floor(0.5 * n)::BIGINT) AS q50, max(x) FILTER (i = floor(0.95 * n)::BIGINT) AS q95 FROM r GROUP BY 1""")
def quantile_exact_index(spark: SparkSession, d: str) -> DataFrame:
    """The element at 0-based place floor(p * n)."""
    return St.quantiles(spark, table(spark, d, "lineitem"), "l_extendedprice", {"q25": 0.25, "q50": 0.5, "q95": 0.95}, ("l_returnflag",), interpolated=False)


@query("""SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 6) AS q25, round(quantile_cont(l_extendedprice, 0.5), 6) AS q50, round(quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25), 6) AS iqr FROM lineitem GROUP BY 1""")
def quantile_interpolated(spark: SparkSession, d: str) -> DataFrame:
    q = St.quantiles(spark, table(spark, d, "lineitem"), "l_extendedprice", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ("l_returnflag",))
    return q.select("l_returnflag", r6(F.col("q25"), "q25"), r6(F.col("q50"), "q50"), r6(F.col("q75") - F.col("q25"), "iqr"))


@query("""WITH q AS (SELECT quantile_cont(p_retailprice, 0.2) AS a, quantile_cont(p_retailprice, 0.4) AS b, quantile_cont(p_retailprice, 0.6) AS c, quantile_cont(p_retailprice, 0.8) AS e FROM part)
SELECT CASE WHEN p_retailprice <= a THEN 'very low' WHEN p_retailprice <= b THEN 'low' WHEN p_retailprice <= c THEN 'middle' WHEN p_retailprice <= e THEN 'high' ELSE 'very high' END AS band, count(*) AS n FROM part, q GROUP BY 1""")
def quantile_bands(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    q = St.quantiles(spark, p, "p_retailprice", {f"q{i}": x for i, x in enumerate((0.2, 0.4, 0.6, 0.8))})
    q = q.select(F.array(*q.columns).alias("q"))
    x, band = F.col("p_retailprice"), F.when(F.lit(False), "")
    for i, name in enumerate(("very low", "low", "middle", "high")):
        band = band.when(x <= F.col("q")[i], name)
    return p.crossJoin(F.broadcast(q)).groupBy(band.otherwise("very high").alias("band")).agg(n_())


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem WHERE l_discount > 0.02 ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 1000""")
def top_anomalies(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").where("l_discount > 0.02")
    return l.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey").limit(1000).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("""SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY md5(event_id::VARCHAR), event_id) AS k FROM events) WHERE k <= 100""")
def limit_by_group(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("event_type").orderBy(F.md5(F.col("event_id").cast("string")), "event_id")
    return table(spark, d, "events").withColumn("k", F.row_number().over(w)).where("k <= 100").select("event_type", "event_id")


@query("SELECT o_orderkey FROM orders ORDER BY md5(o_orderkey::VARCHAR), o_orderkey LIMIT 500")
def hash_order_sample(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").orderBy(F.md5(F.col("o_orderkey").cast("string")), "o_orderkey").limit(500).select("o_orderkey")


@query("""SELECT l_orderkey AS record, count(*) AS intervals, round(avg(l_extendedprice), 7) AS mean, min(l_shipdate) AS first, count(*) FILTER (l_returnflag = 'R') AS returned, round(avg(l_discount) FILTER (l_returnflag = 'R'), 6) AS returned_discount FROM lineitem GROUP BY 1""")
def record_profile(spark: SparkSession, d: str) -> DataFrame:
    back = F.col("l_returnflag") == "R"
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("record")).agg(n_("intervals"), F.round(F.avg("l_extendedprice"), 7).alias("mean"), F.min("l_shipdate").alias("first"), F.count_if(back).alias("returned"), r6(F.avg(F.when(back, F.col("l_discount"))), "returned_discount"))


@query("""SELECT substr(c_name, 1, 11) AS prefix, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY 1""")
def accession_groups(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").groupBy(F.substring("c_name", 1, 11).alias("prefix")).agg(n_(), F.round(F.sum("c_acctbal"), 2).alias("total"))


@query("""SELECT floor(log10(l_extendedprice) * 4) / 4 AS bin, count(*) AS n, round(avg(l_discount), 6) AS mean FROM lineitem GROUP BY 1 HAVING count(*) >= 30""")
def binned_mean(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy((F.floor(F.log10("l_extendedprice") * 4) / 4).alias("bin")).agg(n_(), r6(F.avg("l_discount"), "mean")).where("n >= 30")


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) FILTER ({c} IS NULL OR trim({c}::VARCHAR) = '') AS missing, count(DISTINCT {c}) AS distinct_values, count(*) FILTER (try_cast({c} AS DOUBLE) IS NOT NULL) AS numeric_values FROM orders" for c in ("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")))
def column_audit(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    long = o.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in ("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")])).alias("x")).select("x.*")
    per = long.groupBy("column", "v").agg(n_("c"))  # distinct values first: one shuffle serves all counts
    missing = F.col("v").isNull() | (F.trim("v") == "")
    add = lambda cond, name: F.coalesce(F.sum(F.when(cond, F.col("c"))), F.lit(0)).alias(name)
    return per.groupBy("column").agg(F.sum("c").alias("rows"), add(missing, "missing"), F.count("v").alias("distinct_values"), add(F.col("v").try_cast("double").isNotNull(), "numeric_values"))


@query("""WITH c AS (SELECT coalesce(nullif(trim(event_type), ''), '<MISSING>') AS value, count(*) AS n FROM events GROUP BY 1) SELECT value, n, round(n / sum(n) OVER (), 6) AS fraction FROM c""")
def value_counts(spark: SparkSession, d: str) -> DataFrame:
    v = F.when(F.trim("event_type") != "", F.trim("event_type")).otherwise("<MISSING>")
    return table(spark, d, "events").groupBy(v.alias("value")).agg(n_()).withColumn("fraction", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


@query("""SELECT o_orderpriority, coalesce(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 0)::DECIMAL(18, 2)::DOUBLE AS f, coalesce(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 0)::DECIMAL(18, 2)::DOUBLE AS o,
  coalesce(sum(o_totalprice) FILTER (o_orderstatus = 'P'), 0)::DECIMAL(18, 2)::DOUBLE AS p FROM orders GROUP BY 1 ORDER BY 1""")
def pivot_matrix(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.round(F.sum("o_totalprice"), 2)).na.fill(0.0)
    return p.select("o_orderpriority", F.col("F").alias("f"), F.col("O").alias("o"), F.col("P").alias("p")).orderBy(F.regexp_extract("o_orderpriority", r"\d+", 0).try_cast("int"), "o_orderpriority")


@query("""WITH g AS (SELECT p_brand AS category, count(*) AS n FROM part GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, category) AS k FROM g)
SELECT CASE WHEN k <= 8 THEN category ELSE 'other' END AS category, sum(n)::BIGINT AS n, round(sum(n) / (SELECT sum(n) FROM g), 6) AS share FROM r GROUP BY 1""")
def top8_other(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "part").groupBy(F.col("p_brand").alias("category")).agg(n_())
    top = g.orderBy(F.desc("n"), "category").limit(8).select("category", F.lit(True).alias("kept"))
    out = g.join(F.broadcast(top), "category", "left").groupBy(F.when(F.col("kept"), F.col("category")).otherwise("other").alias("category")).agg(F.sum("n").alias("n"))
    return out.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


@query("""SELECT 'l_quantity' AS feature, count(*) FILTER (l_quantity IS NULL) AS nulls, min(l_quantity) AS low, max(l_quantity) AS high FROM lineitem UNION ALL SELECT 'l_discount', count(*) FILTER (l_discount IS NULL), min(l_discount), max(l_discount) FROM lineitem
UNION ALL SELECT 'l_tax', count(*) FILTER (l_tax IS NULL), min(l_tax), max(l_tax) FROM lineitem""")
def feature_quality(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem")
    long = l.unpivot([], ["l_quantity", "l_discount", "l_tax"], "feature", "x")
    return long.groupBy("feature").agg(F.count_if(F.col("x").isNull()).alias("nulls"), F.min("x").alias("low"), F.max("x").alias("high"))


@query("""WITH b AS (SELECT CASE WHEN l_linenumber <= 0 THEN '<=0' WHEN l_linenumber <= 2 THEN '1-2' WHEN l_linenumber <= 4 THEN '3-4' WHEN l_linenumber <= 7 THEN '5-7' ELSE '8+' END AS bin FROM lineitem), e(bin) AS (VALUES ('<=0'), ('1-2'), ('3-4'), ('5-7'), ('8+'))
SELECT e.bin, count(b.bin) AS n FROM e LEFT JOIN b ON e.bin = b.bin GROUP BY e.bin""")
def shape_bins(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("l_linenumber")
    b = table(spark, d, "lineitem").groupBy(F.when(x <= 0, "<=0").when(x <= 2, "1-2").when(x <= 4, "3-4").when(x <= 7, "5-7").otherwise("8+").alias("bin")).agg(n_())
    every = spark.createDataFrame([(v,) for v in ("<=0", "1-2", "3-4", "5-7", "8+")], "bin string")
    return every.join(b, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


@query("""WITH r AS (SELECT min(l_extendedprice) AS a, max(l_extendedprice) AS b, min(l_quantity) AS c, max(l_quantity) AS e FROM lineitem)
SELECT least(floor((l_extendedprice - a) / (b - a) * 60), 59)::INTEGER AS x, least(floor((l_quantity - c) / (e - c) * 40), 39)::INTEGER AS y, count(*) AS n FROM lineitem, r GROUP BY 1, 2""")
def count_grid(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").select("l_extendedprice", "l_quantity")
    r = l.agg(F.min("l_extendedprice").alias("a"), F.max("l_extendedprice").alias("b"), F.min("l_quantity").alias("c"), F.max("l_quantity").alias("e"))
    cell = lambda x, lo, hi, n: F.least(F.floor((x - lo) / (hi - lo) * n), F.lit(n - 1)).cast("int")
    j = l.crossJoin(F.broadcast(r))
    return j.groupBy(cell(F.col("l_extendedprice"), F.col("a"), F.col("b"), 60).alias("x"), cell(F.col("l_quantity"), F.col("c"), F.col("e"), 40).alias("y")).agg(n_())


@query("""SELECT DISTINCT k FROM (SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 45 UNION SELECT p_partkey FROM part WHERE p_size > 45)""")
def union_distinct_keys(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("k"))
    return a.union(table(spark, d, "part").where("p_size > 45").select("p_partkey")).distinct()


@query("""SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 45 INTERSECT SELECT p_partkey FROM part WHERE p_size > 25""")
def key_intersection(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("k"))
    return a.intersect(table(spark, d, "part").where("p_size > 25").select("p_partkey"))


@query("""SELECT s_suppkey, metric, value FROM supplier UNPIVOT (value FOR metric IN (s_acctbal, s_half)) """.replace("FROM supplier", "FROM (SELECT s_suppkey, s_acctbal, s_acctbal / 2 AS s_half FROM supplier)"))
def melt(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select("s_suppkey", "s_acctbal", (F.col("s_acctbal") / 2).alias("s_half"))
    return s.unpivot("s_suppkey", ["s_acctbal", "s_half"], "metric", "value").where("value is not null")


_RANKS = ("r_name", "n_name", "c_mktsegment")


@query("""WITH x AS (SELECT c_custkey, r_name, n_name, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey), t AS (SELECT * FROM x WHERE c_custkey = 42)
""" + " UNION ALL ".join(f"SELECT '{r}' AS rank, x.{r} AS value, x.c_custkey AS member FROM x, t WHERE x.{r} = t.{r}" for r in _RANKS))
def cohort_of_record(spark: SparkSession, d: str) -> DataFrame:
    """Everyone who shares the selected record's value at a chosen rank, for each rank that can be chosen."""
    c, n, r = table(spark, d, "customer"), table(spark, d, "nation"), table(spark, d, "region")
    x = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select("c_custkey", *_RANKS)
    long = x.unpivot("c_custkey", list(_RANKS), "rank", "value")
    mine = x.where("c_custkey = 42").unpivot([], list(_RANKS), "rank", "value")
    return long.join(mine, ["rank", "value"]).select("rank", "value", F.col("c_custkey").alias("member"))


@query("""SELECT c_custkey, round(coalesce(try_cast(replace(printf('%,d', (c_acctbal * 100)::BIGINT), ',', '') AS DOUBLE), 0), 2) AS parsed FROM customer""".replace("printf('%,d', (c_acctbal * 100)::BIGINT)", "(c_acctbal::DECIMAL(18, 2))::VARCHAR"))
def numeric_parse(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", F.round(F.coalesce(St.parse_number(F.format_number("c_acctbal", 2)), F.lit(0.0)), 2).alias("parsed"))
