"""Queries of the model stage, of vector search by metric, and of group profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lineage as L
from ..functions import sequence as S
from ..operators import model, tokenize
from ..operators import vectors as V
from ..sources.shared import table
from .adapters import LIN, SEQ, lineages, sequences
from .registry import query

r6 = lambda c, name: F.round(c, 6).alias(name)
n_ = lambda name="n": F.count(F.lit(1)).alias(name)
CONTEXT = (512, 1024, 2048)


@query(f"""WITH {SEQ}, k AS (SELECT doc_id, least(length(sequence), 196596) // 6 * 6 AS kept FROM seq WHERE NOT regexp_matches(sequence, '[^ACGT]')),
p AS (SELECT k.doc_id, i, substr(sequence, (6 * i + 1)::INTEGER, 6) AS w FROM k JOIN seq USING (doc_id), unnest(range(0, kept // 6)) AS u(i) WHERE kept >= 6),
c AS (SELECT doc_id, i, (SELECT sum((instr('ACGT', w[j]) - 1) * (4 ** (6 - j))::BIGINT) FROM unnest(range(1, 7)) AS v(j))::BIGINT + 8 AS id FROM p),
a AS (SELECT doc_id, id, TRUE AS real FROM c UNION ALL SELECT DISTINCT doc_id, 1, FALSE FROM c UNION ALL SELECT DISTINCT doc_id, 2, FALSE FROM c),
g AS (SELECT doc_id, count(*)::INTEGER AS token_length, avg(-(id % 13 + 1) / 4.0) FILTER (real) AS mean, stddev_pop(-(id % 13 + 1) / 4.0) FILTER (real) AS sd, min(-(id % 13 + 1) / 4.0) FILTER (real) AS low,
  avg((id * 3 % 97) / 97.0 - 0.5) AS h0, avg((id * 4 % 97) / 97.0 - 0.5) AS h1, avg((id * 5 % 97) / 97.0 - 0.5) AS h2, avg((id * 6 % 97) / 97.0 - 0.5) AS h3 FROM a GROUP BY doc_id),
m AS (SELECT doc_id, min(i)::INTEGER AS place FROM c JOIN g USING (doc_id) WHERE -(id % 13 + 1) / 4.0 = low GROUP BY doc_id)
SELECT doc_id, token_length, CASE WHEN token_length <= 2048 THEN 'ok' ELSE 'context' END AS status, CASE WHEN token_length <= 2048 THEN round(mean, 6) END AS mean_log_prob,
  CASE WHEN token_length <= 2048 THEN round(sd, 6) END AS per_token_logprob_std, CASE WHEN token_length <= 2048 THEN place END AS argmin_position,
  CASE WHEN token_length <= 2048 THEN round(sqrt(h0 * h0 + h1 * h1 + h2 * h2 + h3 * h3), 6) END AS embedding_norm FROM g JOIN m USING (doc_id)""")
def model_stage(spark: SparkSession, d: str) -> DataFrame:
    s = sequences(spark, d).withColumn("qc_flag", F.when(S.ambiguous(F.col("sequence")), "ambiguous_bases").otherwise("clean"))
    out = model.infer(tokenize.tokenize(s, extra=("doc_id",)), model.StandIn(), ("doc_id",), CONTEXT)
    return out.select("doc_id", "token_length", "status", *[r6(F.col(c), c) for c in ("mean_log_prob", "per_token_logprob_std")], "argmin_position", r6(F.col("embedding_norm"), "embedding_norm"))


def _vectors(spark, d):
    return V.usable(table(spark, d, "embeddings"), "embedding").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"), "label")


_PAIRS = "e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings), p AS (SELECT q.id AS query, c.id AS neighbour, q.v AS qv, c.v AS cv FROM e q JOIN e c ON q.id % 50 = 0 AND q.id <> c.id)"
_FIVE = "r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY s DESC, neighbour)::INTEGER AS rank FROM x)"


@query(f"""WITH {_PAIRS}, x AS (SELECT query, neighbour, list_inner_product(qv, qv) AS sq, round(list_inner_product(qv, cv) - list_inner_product(cv, cv) / 2, 6) AS s FROM p), {_FIVE}
SELECT query, rank, neighbour, round(sqrt(greatest(sq - 2 * s, 0)), 4) AS distance FROM r WHERE rank <= 5""")
def vector_search_l2(spark: SparkSession, d: str) -> DataFrame:
    e = _vectors(spark, d)
    return V.search(spark, e, e.where("id % 50 = 0"), 5, "l2").withColumns({"distance": F.round("distance", 4), "rank": F.col("rank").cast("int")})


@query(f"""WITH {_PAIRS}, x AS (SELECT query, neighbour, round(list_inner_product(qv, cv), 6) AS s FROM p), {_FIVE} SELECT query, rank, neighbour, -s AS distance FROM r WHERE rank <= 5""")
def vector_search_dot(spark: SparkSession, d: str) -> DataFrame:
    e = _vectors(spark, d)
    return V.search(spark, e, e.where("id % 50 = 0"), 5, "dot").withColumn("rank", F.col("rank").cast("int"))


@query(f"""WITH {_PAIRS}, x AS (SELECT query, neighbour, round(list_inner_product(qv, cv), 6) AS s FROM p JOIN e ON e.id = neighbour AND e.label = 3), {_FIVE} SELECT query, rank, neighbour, -s AS distance FROM r WHERE rank <= 5""")
def vector_search_filtered(spark: SparkSession, d: str) -> DataFrame:
    """Search among the rows that a metadata filter allows."""
    e = _vectors(spark, d)
    return V.search(spark, e, e.where("id % 50 = 0"), 5, "dot", F.col("label") == 3).withColumn("rank", F.col("rank").cast("int"))


@query("""SELECT i::INTEGER AS dim, round(cos(i * pi() * (3 - sqrt(5))) * sqrt(1 - (1 - 2 * (i + 0.5) / 64) ** 2), 6) AS x, round(1 - 2 * (i + 0.5) / 64, 6) AS y,
  round(sin(i * pi() * (3 - sqrt(5))) * sqrt(1 - (1 - 2 * (i + 0.5) / 64) ** 2), 6) AS z FROM range(64) AS t(i)""")
def sphere_layout(spark: SparkSession, d: str) -> DataFrame:
    at = V.sphere(F.col("id"), 64)
    return spark.range(64).select(F.col("id").cast("int").alias("dim"), *[r6(at[c], c) for c in "xyz"])


@query(f"""WITH {SEQ}, z AS (SELECT a.doc_id, least(length(a.sequence), length(b.sequence)) AS n, list_zip(string_split(a.sequence, ''), string_split(b.sequence, '')) AS z FROM seq a JOIN seq b ON b.doc_id = a.doc_id + 1)
SELECT doc_id, n AS shared_length, CASE WHEN n > 0 THEN round(len(list_filter(z, lambda t: t[1] = t[2])) / n, 6) END AS identity FROM z""")
def sequence_identity(spark: SparkSession, d: str) -> DataFrame:
    s = sequences(spark, d).select("doc_id", "sequence")
    j = s.join(s.select((F.col("doc_id") - 1).alias("doc_id"), F.col("sequence").alias("other")), "doc_id")
    n = F.least(F.length("sequence"), F.length("other"))
    return j.select("doc_id", n.cast("bigint").alias("shared_length"), F.when(n > 0, F.round(S.identity(F.col("sequence"), F.col("other")), 6)).alias("identity"))


@query(f"""WITH {LIN} SELECT coalesce(CASE WHEN lower(p[1]) = 'eukaryota' AND len(p) > 1 THEN p[2] ELSE p[1] END, 'Unknown') AS taxon, count(*) AS n, round(avg(c_acctbal), 5) AS mean, round(quantile_cont(c_acctbal, 0.25), 5) AS q25,
  round(quantile_cont(c_acctbal, 0.5), 5) AS median, round(quantile_cont(c_acctbal, 0.75), 5) AS q75, round(count(*) FILTER (c_acctbal > 0) / count(*), 6) AS positive, count(DISTINCT c_nationkey) AS nations FROM par GROUP BY 1""")
def taxon_profile(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("c_acctbal")
    r5 = lambda c, name: F.round(c, 5).alias(name)
    return lineages(spark, d).groupBy(F.coalesce(L.kingdom(F.col("lineage")), F.lit("Unknown")).alias("taxon")).agg(
        n_(), r5(F.avg(x), "mean"), r5(F.percentile(x, 0.25), "q25"), r5(F.percentile(x, 0.5), "median"), r5(F.percentile(x, 0.75), "q75"),
        r6(F.count_if(x > 0) / F.count(F.lit(1)), "positive"), F.count_distinct("c_nationkey").alias("nations"),
    )


@query("""WITH b(bin, lo, hi) AS (VALUES (0, 0.0, 0.02), (1, 0.02, 0.05), (2, 0.05, 0.08), (3, 0.08, 0.2), (4, 0.2, 1.0))
SELECT bin, count(l_orderkey) AS n, round(avg(l_extendedprice), 5) AS mean, round(quantile_cont(l_extendedprice, 0.5), 5) AS median FROM b LEFT JOIN lineitem ON l_discount >= lo::DOUBLE AND l_discount < hi::DOUBLE GROUP BY bin""")
def binned_property(spark: SparkSession, d: str) -> DataFrame:
    edges, x = (0.0, 0.02, 0.05, 0.08, 0.2, 1.0), F.col("l_discount")
    which = F.lit(None).cast("int")
    for i in range(len(edges) - 2, -1, -1):
        which = F.when((x >= edges[i]) & (x < edges[i + 1]), i).otherwise(which)
    got = table(spark, d, "lineitem").groupBy(which.alias("bin")).agg(n_(), F.round(F.avg("l_extendedprice"), 5).alias("mean"), F.round(F.percentile("l_extendedprice", 0.5), 5).alias("median"))
    bins = spark.range(len(edges) - 1).select(F.col("id").cast("int").alias("bin"))
    return bins.join(got, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), "mean", "median")


@query("""WITH u AS (SELECT 'o_orderpriority' AS kind, o_orderpriority AS name, o_totalprice AS x FROM orders UNION ALL SELECT 'o_orderstatus', o_orderstatus, o_totalprice FROM orders)
SELECT kind, name, count(*) AS n, round(quantile_cont(x, 0.25), 4) AS q25, round(quantile_cont(x, 0.5), 4) AS median, round(quantile_cont(x, 0.75), 4) AS q75 FROM u WHERE trim(coalesce(name, '')) <> '' GROUP BY ALL HAVING count(*) >= 20""")
def group_quartiles(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "orders").select("o_totalprice", "o_orderpriority", "o_orderstatus").unpivot("o_totalprice", ["o_orderpriority", "o_orderstatus"], "kind", "name")
    quart = [F.round(F.percentile("o_totalprice", q), 4).alias(name) for q, name in ((0.25, "q25"), (0.5, "median"), (0.75, "q75"))]
    return u.where(F.trim("name") != "").groupBy("kind", "name").agg(n_(), *quart).where("n >= 20")


@query(f"""WITH {SEQ}, k AS (SELECT CASE WHEN gene_type IS NULL THEN 'unknown' WHEN gene_type = '<cds>' THEN 'coding' ELSE 'non-coding' END AS kind FROM seq)
SELECT kind, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM k GROUP BY kind""")
def coding_composition(spark: SparkSession, d: str) -> DataFrame:
    g = F.col("gene_type")
    kind = F.when(g.isNull(), "unknown").when(S.coding(g), "coding").otherwise("non-coding")
    return sequences(spark, d).groupBy(kind.alias("kind")).agg(n_()).withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


@query(f"""WITH {LIN}, q AS (SELECT quantile_cont(c_acctbal, 0.3333) AS a, quantile_cont(c_acctbal, 0.6667) AS b FROM par),
x AS (SELECT coalesce(p[1], 'Unclassified') AS first, coalesce(p[2], 'Unclassified') AS second, CASE WHEN c_acctbal <= a THEN 'low' WHEN c_acctbal <= b THEN 'middle' ELSE 'high' END AS band, c_mktsegment AS segment, c_acctbal AS v FROM par, q)
SELECT first, second, band, segment, count(*) AS n, round(quantile_cont(v, 0.5), 4) AS median FROM x GROUP BY ALL""")
def path_bands(spark: SparkSession, d: str) -> DataFrame:
    l, v = lineages(spark, d), F.col("c_acctbal")
    cuts = l.agg(F.percentile(v, F.array(F.lit(0.3333), F.lit(0.6667))).alias("cuts"))  # one row
    p = L.parts(F.col("lineage"))
    ranks = [F.coalesce(F.get(p, F.lit(i)), F.lit("Unclassified")).alias(name) for i, name in enumerate(("first", "second"))]
    band = F.when(v <= F.col("cuts")[0], "low").when(v <= F.col("cuts")[1], "middle").otherwise("high").alias("band")
    x = l.crossJoin(F.broadcast(cuts)).select(*ranks, band, F.col("c_mktsegment").alias("segment"), v.alias("v"))
    return x.groupBy("first", "second", "band", "segment").agg(n_(), F.round(F.percentile("v", 0.5), 4).alias("median"))


@query(f"""WITH {LIN}, e AS (SELECT o_custkey AS q, o_orderkey % 200 AS c FROM orders),
j AS (SELECT q, c, a.custkey IS NULL OR b.custkey IS NULL AS missing, q = c AS self, a.lineage IS NULL OR b.lineage IS NULL AS bare FROM e LEFT JOIN lin a ON a.custkey = q LEFT JOIN lin b ON b.custkey = c)
SELECT count(*) AS read, count(*) FILTER (missing) AS missing_key, count(*) FILTER (NOT missing AND self) AS self_edges, count(*) FILTER (NOT missing AND NOT self AND bare) AS no_lineage,
  count(*) FILTER (NOT missing AND NOT self AND NOT bare) AS valid FROM j""")
def edge_accounting(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "orders").select(F.col("o_custkey").alias("q"), (F.col("o_orderkey") % 200).alias("c"))
    side = lambda name: lineages(spark, d).select(F.col("custkey").alias(name), F.lit(True).alias(f"{name}_known"), F.col("lineage").alias(f"{name}_lineage"))
    j = e.join(side("q"), "q", "left").join(side("c"), "c", "left")
    missing, own = F.col("q_known").isNull() | F.col("c_known").isNull(), F.col("q") == F.col("c")
    bare = F.col("q_lineage").isNull() | F.col("c_lineage").isNull()
    return j.agg(n_("read"), F.count_if(missing).alias("missing_key"), F.count_if(~missing & own).alias("self_edges"), F.count_if(~missing & ~own & bare).alias("no_lineage"), F.count_if(~missing & ~own & ~bare).alias("valid"))


@query(f"""WITH {LIN}, x AS (SELECT custkey, c_acctbal > 0 AS candidate, unnest(list_distinct(p)) AS part FROM par WHERE len(p) > 0), t AS (SELECT count(*) FILTER (c_acctbal > 0) AS a, count(*) FILTER (NOT c_acctbal > 0) AS b FROM par WHERE len(p) > 0)
SELECT part, count(*) FILTER (candidate) AS candidates, count(*) FILTER (NOT candidate) AS others, round(count(*) FILTER (candidate) / any_value(a) - count(*) FILTER (NOT candidate) / any_value(b), 6) AS contrast FROM x, t GROUP BY part""")
def lineage_contrast(spark: SparkSession, d: str) -> DataFrame:
    p = L.parts(F.col("lineage"))
    l = lineages(spark, d).where(F.size(p) > 0).select((F.col("c_acctbal") > 0).alias("candidate"), F.array_distinct(p).alias("p"))
    totals = l.agg(F.count_if("candidate").alias("a"), F.count_if(~F.col("candidate")).alias("b"))  # one row
    g = l.select("candidate", F.explode("p").alias("part")).groupBy("part").agg(F.count_if("candidate").alias("candidates"), F.count_if(~F.col("candidate")).alias("others"))
    return g.crossJoin(F.broadcast(totals)).select("part", "candidates", "others", r6(F.col("candidates") / F.col("a") - F.col("others") / F.col("b"), "contrast"))


@query("""SELECT n_nationkey, n_nationkey::BIGINT AS taxid, n_name AS name, 'domain:' || r_name || CASE WHEN n_nationkey % 2 = 0 THEN '>phylum:' || n_name ELSE '' END AS ranks FROM nation JOIN region ON n_regionkey = r_regionkey""")
def taxon_documents(spark: SparkSession, d: str) -> DataFrame:
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    pair = lambda rank, name: F.struct(rank.alias("rank"), F.col(name).alias("name"))
    line = F.array(pair(F.lit("domain"), "r_name"), pair(F.when(F.col("n_nationkey") % 2 == 0, "phylum"), "n_name"))
    doc = F.to_json(F.struct(F.col("n_nationkey").alias("taxid"), F.col("n_name").alias("name"), line.alias("lineage")))
    return j.select("n_nationkey", L.from_document(doc).alias("t")).select("n_nationkey", "t.taxid", "t.name", F.array_join("t.ranks", ">").alias("ranks"))


@query("""WITH b AS (SELECT DISTINCT p_brand AS label FROM part) SELECT label, row_number() OVER (ORDER BY regexp_extract(label, '^[^0-9]*'), try_cast(regexp_extract(label, '[0-9]+') AS BIGINT) NULLS FIRST, label)::INTEGER AS place FROM b""")
def natural_order(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("label")
    w = Window.orderBy(F.regexp_extract(x, "^[^0-9]*", 0), F.regexp_extract(x, "[0-9]+", 0).try_cast("bigint").asc_nulls_first(), x)  # labels of a category, few
    return table(spark, d, "part").select(F.col("p_brand").alias("label")).distinct().select("label", F.row_number().over(w).alias("place"))
