"""Queries of group reports, checked joins, samples and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lineage as L
from ..functions import stats as St
from ..operators import groups as G
from ..operators import inference as I
from ..sources.shared import cut, table
from .adapters import LIN, SEQ, lineages, sequences
from .registry import query
from .vector_queries import _KNN, _attributed

r5 = lambda c, name: F.round(c, 5).alias(name)
n_ = lambda name="n": F.count(F.lit(1)).alias(name)
METRICS = ("quantity", "price", "discount", "tax")


def _members(spark, d):
    """Line items in overlapping groups: of large quantity, returned, of a brand."""
    l, p = table(spark, d, "lineitem"), table(spark, d, "part")
    j = l.join(p, l.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").alias("record_id"), F.col("l_partkey").alias("part"), "l_returnflag", "p_brand", F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("discount"), F.col("l_tax").alias("tax"), F.when(F.col("l_linenumber") < 5, (F.col("l_linenumber") % 2 == 0).cast("string")).alias("coding"),
    )
    return G.membership(j, {"large": F.col("quantity") > 40, "returned": F.col("l_returnflag") == "R", "brand": F.col("p_brand") == "Brand#7"})


_MEMBERS = """j AS (SELECT l_orderkey AS record_id, l_partkey AS part, l_returnflag, p_brand, l_quantity AS quantity, l_extendedprice AS price, CASE WHEN l_discount > 0 THEN l_discount END AS discount, l_tax AS tax,
  CASE WHEN l_linenumber < 5 THEN l_linenumber % 2 = 0 END AS coding FROM lineitem JOIN part ON l_partkey = p_partkey),
mem AS (SELECT *, 'large' AS taxon FROM j WHERE quantity > 40 UNION ALL SELECT *, 'returned' FROM j WHERE l_returnflag = 'R' UNION ALL SELECT *, 'brand' FROM j WHERE p_brand = 'Brand#7')"""


@query(f"WITH {_MEMBERS} SELECT taxon, record_id, part, quantity FROM mem")
def group_membership(spark: SparkSession, d: str) -> DataFrame:
    return _members(spark, d).select("taxon", "record_id", "part", "quantity")


@query(f"""WITH {_MEMBERS} SELECT taxon, count(*) AS rows, count(coding) AS coding_known, round(count(*) FILTER (coding) / count(coding), 5) AS coding_fraction, count(DISTINCT record_id) AS distinct_record_id, count(DISTINCT part) AS distinct_part, count(DISTINCT p_brand) AS distinct_p_brand,
  {", ".join(f"count({m}) AS {m}_n, round(avg({m}), 5) AS {m}_mean, round(quantile_cont({m}, 0.25), 5) AS {m}_q25, round(quantile_cont({m}, 0.5), 5) AS {m}_median, round(quantile_cont({m}, 0.75), 5) AS {m}_q75" for m in METRICS)} FROM mem GROUP BY taxon""")
def group_profile(spark: SparkSession, d: str) -> DataFrame:
    p = G.profile(spark, _members(spark, d), METRICS, ("record_id", "part", "p_brand"), "coding")
    rounded = {"coding_fraction"} | {f"{m}_{s}" for m in METRICS for s in ("mean", "q25", "median", "q75")}
    return p.select(*[r5(F.col(c), c) if c in rounded else F.col(c) for c in p.columns])


_EVIDENCE = ("record_id", "part", "discount", "coding")


@query(f"WITH {_MEMBERS} " + " UNION ALL ".join(f"SELECT taxon, '{c}' AS \"column\", count(*) AS rows, count({c}) AS present, count(DISTINCT {c}) AS \"distinct\", count({c}) - count(DISTINCT {c}) AS excess, {'round(sum(discount), 4)' if c == 'discount' else 'NULL::DOUBLE'} AS total FROM mem GROUP BY taxon" for c in _EVIDENCE))
def evidence_quality(spark: SparkSession, d: str) -> DataFrame:
    return G.evidence(_members(spark, d), _EVIDENCE, ("discount",)).withColumn("total", F.round("total", 4))


@query(f"""WITH {_MEMBERS}, g AS (SELECT taxon, count(*) AS rows, quantile_cont(price, 0.5) AS median FROM mem GROUP BY taxon), s AS (SELECT DISTINCT taxon, part FROM mem)
SELECT a.taxon AS taxon_a, b.taxon AS taxon_b, a.rows AS rows_a, b.rows AS rows_b, round(a.median, 5) AS median_a, round(b.median, 5) AS median_b, round(a.median - b.median, 5) AS difference,
  (SELECT count(*) FROM s x JOIN s y ON x.part = y.part WHERE x.taxon = a.taxon AND y.taxon = b.taxon) AS overlap FROM g a JOIN g b ON a.taxon < b.taxon""")
def group_comparison(spark: SparkSession, d: str) -> DataFrame:
    c = G.compare(spark, _members(spark, d), "price", "part")
    return c.select("taxon_a", "taxon_b", "rows_a", "rows_b", *[r5(F.col(x), x) for x in ("median_a", "median_b", "difference")], "overlap")


@query("""WITH v AS (SELECT 'o_orderstatus' AS "column", o_orderstatus AS v FROM orders UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders), u AS (SELECT DISTINCT "column", v FROM v WHERE trim(v) <> '')
SELECT "column", (SELECT count(*) FROM v x WHERE x."column" = u."column") AS rows, array_to_string(list_sort(list(v))[1:3], '|') AS samples FROM u GROUP BY "column\"""")
def sample_values(spark: SparkSession, d: str) -> DataFrame:
    """Three least values of each audited column."""
    long = table(spark, d, "orders").select("o_orderstatus", "o_orderpriority").unpivot([], ["o_orderstatus", "o_orderpriority"], "column", "v")
    per = long.groupBy("column", "v").agg(n_("c"))
    w = Window.partitionBy("column").orderBy("v")
    least = per.where(~G.missing(F.col("v"))).withColumn("k", F.row_number().over(w)).where("k <= 3").groupBy("column").agg(F.array_join(F.sort_array(F.collect_list("v")), "|").alias("samples"))
    return per.groupBy("column").agg(F.sum("c").alias("rows")).join(least, "column", "left")


# --- joins -----------------------------------------------------------------------------------


@query("""WITH a AS (SELECT l_orderkey, avg(l_quantity) AS quantity, count(*) AS lines FROM lineitem GROUP BY 1), b AS (SELECT e.user_id AS o_custkey, max(e.value) AS best, count(*) AS events FROM events e GROUP BY 1)
SELECT o_orderkey, round(quantity, 5) AS quantity, lines FROM orders LEFT JOIN a ON o_orderkey = l_orderkey""")
def join_deduplicated(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey")
    side = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return G.join_deduplicated(o, [(side, {"quantity": F.round(F.avg("l_quantity"), 5), "lines": F.count(F.lit(1))})], ("o_orderkey",))


@query("""WITH k AS (SELECT DISTINCT l_partkey AS p_partkey FROM lineitem WHERE l_quantity > 48) SELECT p_brand, count(*) AS n, round(avg(p_retailprice), 5) AS mean FROM part SEMI JOIN k USING (p_partkey) GROUP BY 1""")
def restricted_dimension(spark: SparkSession, d: str) -> DataFrame:
    """A dimension restricted to requested keys, then grouped: no fan-out."""
    wanted = table(spark, d, "lineitem").where("l_quantity > 48").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, d, "part").join(wanted, "p_partkey", "left_semi").groupBy("p_brand").agg(n_(), r5(F.avg("p_retailprice"), "mean"))


@query("""WITH m AS (SELECT doc_id::VARCHAR AS id, min(source) AS source FROM documents GROUP BY 1) SELECT vec_id, label, source FROM embeddings JOIN m ON vec_id::VARCHAR = id""")
def cast_key_join(spark: SparkSession, d: str) -> DataFrame:
    """Vectors with metadata whose key is text and may repeat."""
    meta = table(spark, d, "documents").groupBy(F.col("doc_id").cast("string").alias("id")).agg(F.min("source").alias("source"))
    e = table(spark, d, "embeddings").select("vec_id", "label")
    return e.join(meta.select(F.col("id").try_cast("bigint").alias("vec_id"), "source"), "vec_id")


@query("SELECT c_custkey, c_name, n_name FROM customer LEFT JOIN (SELECT c_custkey AS k, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal > 0) x ON k = c_custkey")
def one_to_one_join(spark: SparkSession, d: str) -> DataFrame:
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    right = c.where("c_acctbal > 0").join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")
    return G.join_one_to_one(c.select("c_custkey", "c_name"), right, ("c_custkey",))


@query("""WITH i AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS place FROM customer WHERE c_custkey % 3 <> 0) SELECT count(*) AS edges, count(place) AS found, count(*) - count(place) AS missing, sum(place)::BIGINT AS sum_of_places FROM orders LEFT JOIN i ON o_custkey = c_custkey""")
def key_positions(spark: SparkSession, d: str) -> DataFrame:
    """Key to position look-up, missing ones counted."""
    index = St.global_rank(spark, table(spark, d, "customer").where("c_custkey % 3 <> 0").select("c_custkey"), F.col("c_custkey"))
    index = index.select(F.col("c_custkey").alias("key"), (F.col("rn") - 1).alias("place"))
    e = G.positions(table(spark, d, "orders").select(F.col("o_custkey").alias("key")), index, "key", "place")
    return e.agg(n_("edges"), F.count("key_place").alias("found"), F.count_if(F.col("key_place").isNull()).alias("missing"), F.sum("key_place").alias("sum_of_places"))


_COHORT = "c AS (SELECT o_orderkey AS k, o_custkey % 4 + 1 AS s FROM orders)"


@query(f"""WITH {_COHORT}, l AS (SELECT * FROM lineitem SEMI JOIN c ON l_orderkey = k AND l_linenumber = s)
SELECT (SELECT count(*) FROM l) AS likelihood, (SELECT count(*) FROM l WHERE l_discount > 0.05) AS features, (SELECT count(*) FROM l WHERE l_quantity > 25) AS vectors""")
def cohort_inputs(spark: SparkSession, d: str) -> DataFrame:
    """Each of three inputs restricted to the cohort's keys before they are joined."""
    cohort = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 4 + 1).alias("l_linenumber"))
    l = table(spark, d, "lineitem")
    parts = {"likelihood": l, "features": l.where("l_discount > 0.05"), "vectors": l.where("l_quantity > 25")}
    out = None
    for name, df in parts.items():
        one = df.join(cohort, ["l_orderkey", "l_linenumber"], "left_semi").agg(n_(name))
        out = one if out is None else out.crossJoin(one)  # rows of one
    return out


# --- samples and limits ----------------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 250")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    return G.sample_rows(table(spark, d, "orders"), 250, "o_orderkey").select("o_orderkey", "o_totalprice")


@query("SELECT event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY md5('42:' || event_id), event_id) <= 60")
def category_reservoir(spark: SparkSession, d: str) -> DataFrame:
    return G.reservoir(table(spark, d, "events"), "event_type", 60, "event_id").select("event_type", "event_id")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 100")
def first_by_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").orderBy("o_orderkey").limit(100).select("o_orderkey", "o_custkey")


@query("SELECT least(count(*), 700) AS rows FROM events")
def row_ceiling(spark: SparkSession, d: str) -> DataFrame:
    """A ceiling on the rows that a run reads."""
    return table(spark, d, "events").limit(700).agg(n_("rows"))


@query("SELECT 'orders' AS name, count(*) AS rows FROM orders UNION ALL SELECT 'part', count(*) FROM part")
def table_rows(spark: SparkSession, d: str) -> DataFrame:
    count = lambda t: table(spark, d, t).agg(n_("rows")).select(F.lit(t).alias("name"), "rows")
    return count("orders").unionByName(count("part"))


# --- derived columns -------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN p > 1 THEN p / 100 ELSE p END AS fraction FROM (SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN l_discount * 1000 ELSE l_discount END AS p FROM lineitem)")
def percent_rescue(spark: SparkSession, d: str) -> DataFrame:
    p = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_discount") * 1000).otherwise(F.col("l_discount"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", G.fraction(p).alias("fraction"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round((l_linenumber - 2) / (l_quantity - 1), 6) AS place FROM lineitem WHERE l_quantity > 1 AND l_linenumber - 2 >= 0 AND l_linenumber - 2 < l_quantity")
def place_in_bounds(spark: SparkSession, d: str) -> DataFrame:
    place, size = F.col("l_linenumber") - 2, F.col("l_quantity")
    l = table(spark, d, "lineitem").where(G.in_bounds(place, size))
    return l.select("l_orderkey", "l_linenumber", "l_partkey", F.round(G.normalized_place(place, size), 6).alias("place"))


@query(f"WITH {SEQ}, x AS (SELECT CASE WHEN doc_id % 5 = 0 THEN ' ' WHEN doc_id % 7 = 0 THEN NULL ELSE strand END AS s FROM seq) SELECT coalesce(nullif(trim(replace(replace(s, '<', ''), '>', '')), ''), 'unknown') AS strand, count(*) AS n FROM x GROUP BY 1")
def strand_labels(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("doc_id") % 5 == 0, " ").when(F.col("doc_id") % 7 != 0, F.col("strand"))
    return sequences(spark, d).groupBy(G.strand_label(raw).alias("strand")).agg(n_())


_NUMBERS = ("12", "-3.5", " 1,234,567.25 ", "1,5", "-0,25", "1e3", "", "abc", "1,23,4", "NaN?")


@query("WITH r(raw, x) AS (VALUES " + ", ".join(f"('{s}', {v})" for s, v in zip(_NUMBERS, ("12.0", "-3.5", "1234567.25", "1.5", "-0.25", "1000.0", "NULL", "NULL", "NULL", "NULL"))) + ") SELECT raw, x::DOUBLE AS parsed, trim(raw) = '' AS missing FROM r")
def numeric_formats(spark: SparkSession, d: str) -> DataFrame:
    r = spark.createDataFrame([(s,) for s in _NUMBERS], "raw string")
    return r.select("raw", St.parse_number(F.col("raw")).alias("parsed"), G.missing(F.col("raw")).alias("missing"))


@query("""WITH x AS (SELECT CASE WHEN o_orderkey % 6 = 0 THEN '' WHEN o_orderkey % 6 = 1 THEN 'n/a' ELSE printf('%.2f', o_totalprice) END AS raw, o_orderstatus FROM orders)
SELECT o_orderstatus, count(*) FILTER (trim(raw) = '') AS missing, round(avg(try_cast(raw AS DOUBLE)), 4) AS mean, round(median(try_cast(raw AS DOUBLE)), 4) AS median FROM x GROUP BY 1""")
def safe_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Mean and median over what parses as a number."""
    raw = F.when(F.col("o_orderkey") % 6 == 0, "").when(F.col("o_orderkey") % 6 == 1, "n/a").otherwise(F.format_string("%.2f", "o_totalprice"))
    x = table(spark, d, "orders").select("o_orderstatus", raw.alias("raw")).withColumn("x", St.parse_number(F.col("raw")))
    q = St.quantiles(spark, x, "x", {"median": 0.5}, ("o_orderstatus",))
    s = x.groupBy("o_orderstatus").agg(F.count_if(G.missing(F.col("raw"))).alias("missing"), F.round(F.avg("x"), 4).alias("mean"))
    return s.join(q, "o_orderstatus").withColumn("median", F.round("median", 4))


@query("SELECT o_orderpriority, any_value(o_orderpriority) AS any, round(quantile_cont(o_totalprice, 0.5), 4) AS median FROM orders GROUP BY 1")
def arbitrary_and_median(spark: SparkSession, d: str) -> DataFrame:
    """An arbitrary value of a column that is one value per group, and the exact median."""
    o = table(spark, d, "orders").select("o_orderpriority", "o_totalprice")
    q = St.quantiles(spark, o, "o_totalprice", {"median": 0.5}, ("o_orderpriority",))
    return o.groupBy("o_orderpriority").agg(F.any_value("o_orderpriority").alias("any")).join(q.withColumn("median", F.round("median", 4)), "o_orderpriority")


@query("""WITH q AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1) SELECT l_returnflag, TRUE AS within FROM q""")
def approximate_quantile(spark: SparkSession, d: str) -> DataFrame:
    """Whether the approximate median's rank is within 1 % of the exact one: approximate quantiles have no exact oracle."""
    l = table(spark, d, "lineitem").select("l_returnflag", F.col("l_extendedprice").alias("x"))
    a = l.groupBy("l_returnflag").agg(F.approx_percentile("x", 0.5, 10_000).alias("a"), n_()).select(F.col("l_returnflag").alias("_flag"), "a", "n")
    below = l.join(a, F.col("l_returnflag") == F.col("_flag")).groupBy("l_returnflag").agg(F.count_if(F.col("x") <= F.col("a")).alias("below"), F.first("n").alias("n"))
    return below.select("l_returnflag", (F.abs(F.col("below") / F.col("n") - 0.5) < 0.01).alias("within"))


@query("""WITH b AS (SELECT l_linenumber AS bucket, count(*) AS rows, sum(l_quantity) AS tokens, sum(CASE WHEN l_linenumber > 5 THEN 0 ELSE l_tax END) AS seconds FROM lineitem GROUP BY 1)
SELECT bucket, rows, round(tokens, 2) AS tokens, round(CASE WHEN seconds > 0 THEN tokens / seconds ELSE 0 END, 4) AS tokens_per_second, round(CASE WHEN seconds > 0 THEN rows / seconds ELSE 0 END, 4) AS rows_per_second FROM b""")
def bucket_counters(spark: SparkSession, d: str) -> DataFrame:
    """Counters of a run by length bucket; ratios are 0 where no time was measured."""
    seconds = F.when(F.col("l_linenumber") > 5, 0.0).otherwise(F.col("l_tax"))
    b = table(spark, d, "lineitem").groupBy(F.col("l_linenumber").alias("bucket")).agg(n_("rows"), F.sum("l_quantity").alias("tokens"), F.sum(seconds).alias("seconds"))
    rate = lambda c: F.round(G.ratio(F.col(c), F.col("seconds")), 4).alias(f"{c}_per_second")
    return b.select("bucket", "rows", F.round("tokens", 2).alias("tokens"), rate("tokens"), rate("rows"))


# --- lineages --------------------------------------------------------------------------------


@query(f"""WITH {LIN}, x AS (SELECT custkey, CASE WHEN custkey % 4 <> 0 THEN lineage END AS taxonomy, c_mktsegment || ' asia-minor' AS note FROM lin)
SELECT custkey FROM x WHERE CASE WHEN trim(coalesce(taxonomy, '')) = '' THEN regexp_matches(note, '(?i)(^|[^A-Za-z0-9])asia([^A-Za-z0-9]|$)') ELSE regexp_matches(taxonomy, '(?i)(^|[^A-Za-z0-9])asia([^A-Za-z0-9]|$)') END""")
def taxon_with_fallback(spark: SparkSession, d: str) -> DataFrame:
    """A taxon as a whole word of the taxonomy, or of a fallback column where the taxonomy is missing."""
    x = lineages(spark, d).select("custkey", F.when(F.col("custkey") % 4 != 0, F.col("lineage")).alias("taxonomy"), F.concat("c_mktsegment", F.lit(" asia-minor")).alias("note"))
    hit = F.when(G.missing(F.col("taxonomy")), L.boundary_match(F.col("note"), "asia")).otherwise(L.boundary_match(F.col("taxonomy"), "asia"))
    return x.where(hit).select("custkey")


@query(f"WITH {LIN} SELECT custkey FROM lin WHERE regexp_matches(lineage, '(?i)(^|;)\\s*eukaryota\\s*(;|$)')")
def lineage_descendants(spark: SparkSession, d: str) -> DataFrame:
    """All that stand below a taxon: its token anywhere in the lineage."""
    return lineages(spark, d).where(F.col("lineage").rlike(L.token_pattern(["eukaryota"]))).select("custkey")


@query(f"""WITH {LIN}, x AS (SELECT lineage || ';a' || custkey % 3 || ';b' || custkey % 5 || ';c' || custkey % 7 || ';d' || custkey % 11 || ';e' || custkey % 13 || ';f;g' || custkey % 2 AS t FROM lin)
SELECT {", ".join(f"count(DISTINCT coalesce(string_split(t, ';')[{i}], '')) AS rank{i}" for i in range(1, 12))} FROM x""")
def rank_cardinality_all(spark: SparkSession, d: str) -> DataFrame:
    """Distinct values of eleven ranks in one pass."""
    k = F.col("custkey")
    t = F.concat(F.col("lineage"), *[F.concat(F.lit(f";{c}"), (k % m).cast("string")) for c, m in zip("abcde", (3, 5, 7, 11, 13))], F.lit(";f;g"), (k % 2).cast("string"))
    long = lineages(spark, d).select(F.posexplode(F.array(*[L.rank(t, i) for i in range(1, 12)])).alias("i", "v")).distinct()
    return long.agg(*[F.count_if(F.col("i") == i - 1).alias(f"rank{i}") for i in range(1, 12)])


@query(f"""WITH {LIN}, x AS (SELECT c_acctbal > 0 AS candidate, len(p) AS n, custkey FROM par), t AS (SELECT candidate, count(*) AS rows FROM par, (SELECT 1) u, LATERAL (SELECT c_acctbal > 0 AS candidate) c GROUP BY 1)
SELECT depth::INTEGER AS depth, candidate, count(*) FILTER (n >= depth) AS covered, round(count(*) FILTER (n >= depth) / count(*), 6) AS share, count(DISTINCT custkey % 100) FILTER (n >= depth) AS records FROM x, range(1, 6) AS r(depth) GROUP BY 1, 2""")
def coverage_by_depth(spark: SparkSession, d: str) -> DataFrame:
    """How many lineages reach each depth, and from how many records, for candidates and others."""
    x = lineages(spark, d).select((F.col("c_acctbal") > 0).alias("candidate"), L.depth(F.col("lineage")).alias("n"), (F.col("custkey") % 100).alias("record"))
    per = x.groupBy("candidate", "n", "record").agg(n_("c")).withColumn("depth", F.explode(F.sequence(F.lit(1), F.lit(5))))
    deep = F.col("n") >= F.col("depth")
    rows = per.groupBy("depth", "candidate", "record").agg(F.sum("c").alias("rows"), F.coalesce(F.sum(F.when(deep, F.col("c"))), F.lit(0)).alias("covered"))
    out = rows.groupBy("depth", "candidate").agg(F.sum("covered").alias("covered"), F.round(F.sum("covered") / F.sum("rows"), 6).alias("share"), F.count_if(F.col("covered") > 0).alias("records"))
    return out


# --- neighbours ------------------------------------------------------------------------------


@query(f"""WITH {_KNN}, x AS (SELECT least(ql, cl) AS depth, CASE WHEN ql = cl THEN 'same' ELSE 'different' END AS relationship, similarity FROM edges)
SELECT 'depth' AS kind, depth::VARCHAR AS value, count(*) AS n, round(avg(similarity), 5) AS mean, round(median(similarity), 5) AS median, round(stddev_samp(similarity), 5) AS sd FROM x GROUP BY depth
UNION ALL SELECT 'relationship', relationship, count(*), round(avg(similarity), 5), round(median(similarity), 5), round(stddev_samp(similarity), 5) FROM x GROUP BY relationship""")
def knn_similarity_by_kind(spark: SparkSession, d: str) -> DataFrame:
    """Similarity of neighbours by shared depth and by relationship."""
    e = _attributed(spark, d).select("similarity", F.least("ql", "cl").cast("string").alias("depth"), F.when(F.col("ql") == F.col("cl"), "same").otherwise("different").alias("relationship"))
    long = cut(spark, e.unpivot("similarity", ["depth", "relationship"], "kind", "which"), "knn-kinds")
    q = St.quantiles(spark, long, "similarity", {"median": 0.5}, ("kind", "which"))
    s = long.groupBy("kind", "which").agg(n_(), r5(F.avg("similarity"), "mean"), r5(F.stddev_samp("similarity"), "sd"))
    return s.join(q, ["kind", "which"]).withColumn("median", F.round("median", 5)).withColumnRenamed("which", "value")


@query(f"""WITH {_KNN}, ks(k) AS (VALUES (1), (5), (10)), ts(t) AS (VALUES (1), (3), (5), (8)), m AS (SELECT query, k, max(least(ql, cl)) AS best FROM edges JOIN ks ON rank <= k GROUP BY ALL)
SELECT k, t AS threshold, count(*) AS queries, round(avg((best >= t)::INTEGER), 6) AS share FROM m, ts GROUP BY ALL""")
def knn_depth_thresholds(spark: SparkSession, d: str) -> DataFrame:
    """Share of queries with a neighbour among the first k that shares at least so many levels."""
    e = _attributed(spark, d).withColumn("k", F.explode(F.filter(F.array(F.lit(1), F.lit(5), F.lit(10)), lambda k: k >= F.col("rank"))))
    per = e.groupBy("query", "k").agg(F.max(F.least("ql", "cl")).alias("best")).withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in (1, 3, 5, 8)])))
    return per.groupBy("k", "threshold").agg(n_("queries"), F.round(F.avg((F.col("best") >= F.col("threshold")).cast("int")), 6).alias("share"))


@query(f"""WITH {_KNN}, a AS (SELECT vec_id AS id, label, list_min(embedding)::DOUBLE AS low FROM embeddings)
SELECT query, neighbour, rank, similarity, round(1 - similarity, 6) AS distance, ql AS query_label, cl AS neighbour_label, round(x.low, 6) AS query_low, round(y.low, 6) AS neighbour_low, round(abs(x.low - y.low), 6) AS low_difference FROM edges JOIN a x ON x.id = query JOIN a y ON y.id = neighbour""")
def edge_report(spark: SparkSession, d: str) -> DataFrame:
    """Edges with the properties of both ends and their difference."""
    low = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.array_min("embedding").cast("double").alias("low"))
    side = lambda name: low.select(F.col("id").alias(name), F.col("low").alias(f"{name}_low"))
    e = _attributed(spark, d).join(side("query"), "query").join(side("neighbour"), "neighbour")
    r = lambda c, name: F.round(c, 6).alias(name)
    return e.select(
        "query", "neighbour", "rank", "similarity", r(1 - F.col("similarity"), "distance"), F.col("ql").alias("query_label"), F.col("cl").alias("neighbour_label"), r(F.col("query_low"), "query_low"),
        r(F.col("neighbour_low"), "neighbour_low"), r(F.abs(F.col("query_low") - F.col("neighbour_low")), "low_difference"),
    )


# --- distributions and tests -----------------------------------------------------------------


@query("""WITH r AS (SELECT min(l_extendedprice) AS a, max(l_extendedprice) AS b FROM lineitem), h AS (SELECT l_returnflag AS facet, least(floor((l_extendedprice - a) / (b - a) * 40), 39)::INTEGER AS x, least(floor(l_quantity / 50.0001 * 40), 39)::INTEGER AS y FROM lineitem, r)
SELECT facet, x, y, count(*) AS n FROM h GROUP BY ALL""")
def facet_grid(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("facet"), "l_extendedprice", "l_quantity")
    r = l.agg(F.min("l_extendedprice").alias("a"), F.max("l_extendedprice").alias("b"))  # one row
    x = F.least(F.floor((F.col("l_extendedprice") - F.col("a")) / (F.col("b") - F.col("a")) * 40), F.lit(39)).cast("int")
    y = F.least(F.floor(F.col("l_quantity") / 50.0001 * 40), F.lit(39)).cast("int")
    return l.crossJoin(F.broadcast(r)).groupBy("facet", x.alias("x"), y.alias("y")).agg(n_())


@query("""WITH v AS (SELECT log10(abs(c_acctbal)) AS x FROM customer WHERE c_acctbal <> 0), r AS (SELECT min(x) AS a, max(x) AS b FROM v) SELECT least(floor((x - a) / (b - a) * 100), 99)::INTEGER AS bin, count(*) AS n FROM v, r GROUP BY 1""")
def log_histogram(spark: SparkSession, d: str) -> DataFrame:
    """A hundred equal bins of log10 of the absolute value, zeros left out."""
    v = table(spark, d, "customer").where("c_acctbal <> 0").select(F.log10(F.abs("c_acctbal")).alias("x"))
    r = v.agg(F.min("x").alias("a"), F.max("x").alias("b"))  # one row
    return v.crossJoin(F.broadcast(r)).groupBy(F.least(F.floor((F.col("x") - F.col("a")) / (F.col("b") - F.col("a")) * 100), F.lit(99)).cast("int").alias("bin")).agg(n_())


@query("""WITH g AS (SELECT p_brand, quantile_cont(p_retailprice, 0.5) AS median, count(*) AS n FROM part GROUP BY 1) SELECT p_brand, n, round(median, 5) AS median, row_number() OVER (ORDER BY round(median, 5) DESC, p_brand)::INTEGER AS place FROM g""")
def order_by_median(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_brand", "p_retailprice")
    q = St.quantiles(spark, p, "p_retailprice", {"median": 0.5}, ("p_brand",)).withColumn("median", F.round("median", 5))
    g = p.groupBy("p_brand").agg(n_()).join(q, "p_brand")
    return g.withColumn("place", F.row_number().over(Window.orderBy(F.desc("median"), "p_brand")))  # a row per group


@query("""SELECT floor(l_quantity / 5)::INTEGER AS bin, count(*) AS n, round(quantile_cont(l_extendedprice, 0.5), 4) AS median FROM lineitem GROUP BY 1""")
def median_trend(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").select(F.floor(F.col("l_quantity") / 5).cast("int").alias("bin"), "l_extendedprice")
    q = St.quantiles(spark, l, "l_extendedprice", {"median": 0.5}, ("bin",)).withColumn("median", F.round("median", 4))
    return l.groupBy("bin").agg(n_()).join(q, "bin")


@query("""SELECT 'quantity' AS x, 'price' AS y, round(corr(l_quantity, l_extendedprice), 5) AS pearson FROM lineitem UNION ALL SELECT 'quantity', 'constant', NULL UNION ALL SELECT 'price', 'constant', NULL""")
def pearson_matrix(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").select(F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), F.lit(3.0).alias("constant"))
    return I.correlations(spark, l, ("quantity", "price", "constant")).select("x", "y", F.round("pearson", 5).alias("pearson"))


@query("""WITH e AS (SELECT vec_id, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm, length(text) AS n FROM embeddings JOIN documents ON doc_id = vec_id),
r AS (SELECT rank() OVER (ORDER BY norm) + (count(*) OVER (PARTITION BY norm) - 1) / 2 AS a, rank() OVER (ORDER BY n) + (count(*) OVER (PARTITION BY n) - 1) / 2 AS b FROM e) SELECT 'norm' AS x, 'length' AS y, round(corr(a, b), 4) AS rho, count(*) AS n FROM r""")
def norm_length_spearman(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x, F.sqrt).alias("norm"))
    j = e.join(table(spark, d, "documents").select("doc_id", F.length("text").alias("length")), "doc_id")
    return I.spearman(spark, j.select("norm", "length"), ("norm", "length")).withColumn("rho", F.round("rho", 4))


@query("""WITH x AS (SELECT l_linestatus AS stratum, l_extendedprice AS x, l_returnflag = 'R' AS c FROM lineitem), r AS (SELECT *, rank() OVER (PARTITION BY stratum ORDER BY x) + (count(*) OVER (PARTITION BY stratum, x) - 1) / 2 AS mid FROM x),
s AS (SELECT stratum, count(*) FILTER (c) AS n1, count(*) FILTER (NOT c) AS n0, sum(mid) FILTER (c) AS r1, avg(x) FILTER (c) AS m1, avg(x) FILTER (NOT c) AS m0, var_samp(x) FILTER (c) AS v1, var_samp(x) FILTER (NOT c) AS v0 FROM r GROUP BY stratum),
k AS (SELECT DISTINCT stratum, x, sum(c::INTEGER) OVER (PARTITION BY stratum ORDER BY x) AS c1, sum((NOT c)::INTEGER) OVER (PARTITION BY stratum ORDER BY x) AS c0 FROM x)
SELECT stratum, n1, n0, round((r1 - n1 * (n1 + 1) / 2) / (n1 * n0), 6) AS auc, round((m1 - m0) / sqrt((v1 + v0) / 2), 6) AS smd, (SELECT round(max(abs(c1 / n1 - c0 / n0)), 6) FROM k WHERE k.stratum = s.stratum) AS ks FROM s""")
def separation_by_stratum(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").select(F.col("l_linestatus").alias("stratum"), F.col("l_extendedprice").alias("x"), (F.col("l_returnflag") == "R").alias("case"))
    return I.separation(spark, l, ("stratum",))


@query("""WITH e AS (SELECT vec_id, embedding[i]::DOUBLE AS x, i AS dim, len(embedding) AS n FROM embeddings, unnest(range(1, len(embedding) + 1)) AS t(i)), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY abs(x), dim) - 1 AS k FROM e)
SELECT vec_id, dim::INTEGER AS dim, round(100.0 * k / (n - 1), 6) AS percentile FROM r WHERE k >= n - 3""")
def dimension_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentile rank of the largest dimensions of each vector by absolute value, ties by place."""
    v = F.col("embedding").cast("array<double>")
    ranked = F.sort_array(F.transform(v, lambda x, i: F.struct(F.abs(x).alias("a"), (i + 1).alias("dim"))))
    e = table(spark, d, "embeddings").select("vec_id", F.size(v).alias("n"), F.posexplode(ranked).alias("k", "s"))
    return e.where(F.col("k") >= F.col("n") - 3).select("vec_id", F.col("s.dim").alias("dim"), F.round(100.0 * F.col("k") / (F.col("n") - 1), 6).alias("percentile"))


@query("""WITH e AS (SELECT vec_id, embedding, row_number() OVER (ORDER BY vec_id) AS source_row_index FROM embeddings) SELECT vec_id, source_row_index FROM e WHERE vec_id IS NOT NULL AND vec_id % 7 <> 0 AND len(embedding) = 64""")
def ingest_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Vectors fit for the index: with a key and of the right length; the row index counts skipped rows too."""
    e = table(spark, d, "embeddings").select("vec_id", F.when(F.col("vec_id") % 7 != 0, F.col("embedding")).alias("embedding"))
    ranked = St.global_rank(spark, e, F.col("vec_id"), name="source_row_index")
    return ranked.where(F.col("vec_id").isNotNull() & (F.size("embedding") == 64)).select("vec_id", "source_row_index")
