"""Queries over vectors, the neighbour graph and lineage trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lineage as L
from ..operators import vectors as V
from ..operators.ann import Index
from ..operators.hierarchy import prefix_tree, pruned_tree
from ..sources.shared import cut, table
from .adapters import LIN, lineages
from .registry import query

r6 = lambda c, name: F.round(c, 6).alias(name)
K = 10


def _units(spark, d):
    e = V.usable(table(spark, d, "embeddings"), "embedding")
    return cut(spark, e.select(F.col("vec_id").alias("id"), V.unit(F.col("embedding")).alias("v"), "label"), "units")


def _edges(spark, d, near=0.85):
    u = _units(spark, d)
    edges, close = V.neighbours(spark, u, u.where("id % 50 = 0"), K, near)
    return u, edges, close


_KNN = """e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings),
s AS (SELECT q.id AS query, c.id AS neighbour, q.label AS ql, c.label AS cl, round(list_cosine_similarity(q.v, c.v), 6) AS similarity FROM e q JOIN e c ON q.id % 50 = 0 AND q.id <> c.id),
edges AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, neighbour)::INTEGER AS rank FROM s) WHERE rank <= 10)"""


@query(f"WITH {_KNN} SELECT query, rank, neighbour, similarity FROM edges")
def knn_top10(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d)[1].select("query", "rank", "neighbour", "similarity")


@query(f"WITH {_KNN} SELECT query, count(*) FILTER (similarity >= 0.3) AS local_density FROM s GROUP BY query")
def local_density(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d, 0.3)[2].select("query", F.col("close").alias("local_density"))


def _attributed(spark, d):
    u, edges, _ = _edges(spark, d)
    label = u.select("id", "label")
    q = label.select(F.col("id").alias("query"), F.col("label").alias("ql"))
    c = label.select(F.col("id").alias("neighbour"), F.col("label").alias("cl"))
    return edges.join(q, "query", "left").join(c, "neighbour", "left")


@query(f"WITH {_KNN} SELECT query, neighbour, ql, cl, CASE WHEN ql = cl THEN 'same' WHEN ql IS NULL OR cl IS NULL THEN 'unknown' ELSE 'different' END AS relationship FROM edges")
def edge_attribute_join(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("ql") == F.col("cl"), "same").when(F.col("ql").isNull() | F.col("cl").isNull(), "unknown").otherwise("different")
    return _attributed(spark, d).select("query", "neighbour", "ql", "cl", kind.alias("relationship"))


@query(f"""WITH {_KNN}, ks(k) AS (VALUES (1), (5), (10)), m AS (SELECT query, k, max((ql = cl)::INTEGER) AS hit, avg((ql = cl)::INTEGER) AS share FROM edges JOIN ks ON rank <= k GROUP BY ALL)
SELECT k, count(*) AS queries, round(avg(hit), 6) AS any_agreement, round(avg(share), 6) AS mean_agreement FROM m GROUP BY k""")
def knn_label_agreement(spark: SparkSession, d: str) -> DataFrame:
    e = _attributed(spark, d).withColumn("k", F.explode(F.filter(F.array(F.lit(1), F.lit(5), F.lit(10)), lambda k: k >= F.col("rank"))))
    same = (F.col("ql") == F.col("cl")).cast("int")
    per = e.groupBy("query", "k").agg(F.max(same).alias("hit"), F.avg(same).alias("share"))
    return per.groupBy("k").agg(F.count(F.lit(1)).alias("queries"), r6(F.avg("hit"), "any_agreement"), r6(F.avg("share"), "mean_agreement"))


@query(f"""WITH {_KNN} SELECT rank, count(*) AS n, round(avg(similarity), 6) AS mean_similarity, round(quantile_cont(similarity, 0.5), 6) AS median_similarity, round(stddev_samp(similarity), 6) AS sd,
  min(similarity) AS low, max(similarity) AS high FROM edges GROUP BY rank""")
def knn_rank_summary(spark: SparkSession, d: str) -> DataFrame:
    e = _edges(spark, d)[1]
    return e.groupBy("rank").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("similarity"), "mean_similarity"), r6(F.percentile("similarity", 0.5), "median_similarity"), r6(F.stddev_samp("similarity"), "sd"), F.min("similarity").alias("low"), F.max("similarity").alias("high"))


_NEXT = f"""{LIN}, pairs AS (SELECT a.custkey AS a, a.p AS pa, b.p AS pb FROM par a JOIN par b ON b.custkey = a.custkey + 1),
m AS (SELECT *, list_transform(range(1, least(len(pa), len(pb)) + 1), lambda i: pa[i::INTEGER] = pb[i::INTEGER]) AS eq FROM pairs)"""


def _neighbour_pairs(spark, d):
    l = lineages(spark, d).select("custkey", L.parts(F.col("lineage")).alias("pa"))
    return l.join(l.select((F.col("custkey") - 1).alias("custkey"), F.col("pa").alias("pb")), "custkey")


@query(f"WITH {_NEXT} SELECT a AS custkey, coalesce(list_position(eq, false) - 1, len(eq))::INTEGER AS shared FROM m")
def shared_prefix(spark: SparkSession, d: str) -> DataFrame:
    return _neighbour_pairs(spark, d).select("custkey", L.shared_prefix(F.col("pa"), F.col("pb")).alias("shared"))


@query(f"WITH {_NEXT} SELECT a AS custkey, len(list_filter(eq, lambda x: x))::INTEGER AS shared FROM m")
def shared_positional(spark: SparkSession, d: str) -> DataFrame:
    return _neighbour_pairs(spark, d).select("custkey", L.shared_positions(F.col("pa"), F.col("pb")).alias("shared"))


@query(f"""WITH {_NEXT}, s AS (SELECT len(pa) AS la, len(pb) AS lb, coalesce(list_position(eq, false) - 1, len(eq)) AS shared FROM m)
SELECT depth::INTEGER AS depth, count(*) FILTER (la >= depth AND lb >= depth) AS eligible, count(*) FILTER (la >= depth AND lb >= depth AND shared >= depth) AS agreeing FROM s, range(1, 13) AS t(depth) GROUP BY depth""")
def prefix_agreement(spark: SparkSession, d: str) -> DataFrame:
    s = _neighbour_pairs(spark, d).select(F.least(F.size("pa"), F.size("pb")).alias("both"), L.shared_prefix(F.col("pa"), F.col("pb")).alias("shared"))
    per = s.groupBy("both", "shared").count().withColumn("depth", F.explode(F.sequence(F.lit(1), F.lit(12))))
    add = lambda c, name: F.coalesce(F.sum(F.when(c, F.col("count"))), F.lit(0)).alias(name)
    return per.groupBy("depth").agg(add(F.col("both") >= F.col("depth"), "eligible"), add(F.col("shared") >= F.col("depth"), "agreeing"))


@query(f"""WITH {_NEXT}, s AS (SELECT coalesce(list_position(eq, false) - 1, len(eq)) AS shared FROM m)
SELECT CASE WHEN shared = 0 THEN 0 ELSE least((shared + 1) // 2, 5) END::INTEGER AS category, count(*) AS n FROM s GROUP BY 1""")
def distance_categories(spark: SparkSession, d: str) -> DataFrame:
    s = _neighbour_pairs(spark, d).select(L.distance_category(L.shared_prefix(F.col("pa"), F.col("pb"))).alias("category"))
    return s.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


_TREE = f"""{LIN}, x AS (SELECT array_to_string(p[1:k::INTEGER], ';') AS node, k::INTEGER AS depth, c_acctbal AS v FROM par, unnest(range(1, least(len(p), 5) + 1)) AS u(k)),
t AS (SELECT node, depth, count(*) AS n, round(quantile_cont(v, 0.5), 6) AS median, round(coalesce(stddev_samp(v), 0), 6) AS sd FROM x GROUP BY ALL
  UNION ALL SELECT 'root', 0, count(*), round(quantile_cont(c_acctbal, 0.5), 6), round(coalesce(stddev_samp(c_acctbal), 0), 6) FROM par WHERE len(p) > 0)"""


@query(f"WITH {_TREE} SELECT * FROM t")
def prefix_tree_summary(spark: SparkSession, d: str) -> DataFrame:
    return prefix_tree(lineages(spark, d).select(L.parts(F.col("lineage")).alias("path"), F.col("c_acctbal").alias("v")), "v").select("node", "depth", "n", "median", "sd")


@query(f"WITH {_TREE} SELECT * FROM t WHERE depth <= 1 OR n >= 20")
def prefix_tree_pruned(spark: SparkSession, d: str) -> DataFrame:
    tree = prefix_tree(lineages(spark, d).select(L.parts(F.col("lineage")).alias("path"), F.col("c_acctbal").alias("v")), "v")
    return pruned_tree(tree, 20).select("node", "depth", "n", "median", "sd")


_UNIT = """u AS (SELECT vec_id AS id, label, i, embedding[i]::DOUBLE / sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS x FROM embeddings, unnest(range(1, len(embedding) + 1)) AS t(i))"""


@query(f"""WITH {_UNIT}, c AS (SELECT label, i, sum(x) AS s, count(*) AS n FROM u GROUP BY ALL HAVING count(*) >= 20), nn AS (SELECT label, sqrt(sum(s * s)) AS norm FROM c GROUP BY label)
SELECT u.id, u.label, round(1 - least(greatest(sum(u.x * c.s / nn.norm), -1), 1), 6) AS distance FROM u JOIN c ON u.label = c.label AND u.i = c.i JOIN nn ON nn.label = u.label GROUP BY u.id, u.label""")
def centroid_dispersion(spark: SparkSession, d: str) -> DataFrame:
    u = _units(spark, d)
    j = u.join(V.centroids(u, "label", "v", 20), "label")
    return j.select("id", "label", r6(1 - F.least(F.greatest(V.dot(F.col("v"), F.col("centroid")), F.lit(-1.0)), F.lit(1.0)), "distance"))


@query("""SELECT (i - 1)::INTEGER AS dim, count(*) AS n, round(avg(embedding[i]::DOUBLE), 6) AS mean, round(var_samp(embedding[i]::DOUBLE), 6) AS variance FROM embeddings, unnest(range(1, len(embedding) + 1)) AS t(i) GROUP BY i""")
def dimension_stats(spark: SparkSession, d: str) -> DataFrame:
    e = V.usable(table(spark, d, "embeddings"), "embedding")
    return V.dimension_moments(e, "embedding").select("dim", "n", r6(F.col("mean"), "mean"), r6(F.col("variance"), "variance"))


@query("""WITH e AS (SELECT vec_id, i::INTEGER AS dim, embedding[i]::DOUBLE AS x FROM embeddings, unnest(range(1, len(embedding) + 1)) AS t(i)), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY abs(x) DESC, dim DESC)::INTEGER AS rank FROM e)
SELECT vec_id, rank, dim, round(x, 6) AS value FROM r WHERE rank <= 5""")
def top_dimensions(spark: SparkSession, d: str) -> DataFrame:
    e = V.usable(table(spark, d, "embeddings"), "embedding")
    t = e.select("vec_id", F.posexplode(V.top_dimensions(F.col("embedding"), 5)).alias("p", "t"))
    return t.select("vec_id", (F.col("p") + 1).alias("rank"), F.col("t.dim").alias("dim"), r6(F.col("t.value"), "value"))


@query("""WITH e AS (SELECT vec_id, embedding[i]::DOUBLE AS x FROM embeddings, unnest(range(1, len(embedding) + 1)) AS t(i)), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY x * x DESC) AS k FROM e)
SELECT vec_id, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS sd, round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.75), 6) AS q75, round(sum(abs(x)), 6) AS l1, round(sqrt(sum(x * x)), 6) AS l2,
  count(*) FILTER (abs(x) > 0.1) AS large, round(sum(x * x) FILTER (k <= 10) / sum(x * x), 6) AS top10_energy FROM r GROUP BY vec_id""")
def vector_profile(spark: SparkSession, d: str) -> DataFrame:
    e = V.usable(table(spark, d, "embeddings"), "embedding").select("vec_id", F.explode("embedding").alias("x"), "embedding")
    top = F.aggregate(F.slice(F.sort_array(F.transform("embedding", lambda x: x * x), False), 1, 10), F.lit(0.0), lambda a, x: a + x)
    e = e.select("vec_id", "x", top.alias("top"))
    return e.groupBy("vec_id").agg(
        r6(F.avg("x"), "mean"), r6(F.stddev_pop("x"), "sd"), r6(F.percentile("x", 0.25), "q25"), r6(F.percentile("x", 0.75), "q75"), r6(F.sum(F.abs("x")), "l1"),
        r6(F.sqrt(F.sum(F.col("x") * F.col("x"))), "l2"), F.count_if(F.abs("x") > 0.1).alias("large"), r6(F.max("top") / F.sum(F.col("x") * F.col("x")), "top10_energy"),
    )


@query(f"""WITH {_UNIT}, g AS (SELECT label, i, sum(x) AS s FROM u GROUP BY ALL), n AS (SELECT label, count(DISTINCT id) AS n FROM u GROUP BY label), p AS (SELECT a.label AS a, b.label AS b, sum(a.s * b.s) AS total FROM g a JOIN g b USING (i) GROUP BY 1, 2)
SELECT a, b, CASE WHEN a = b THEN x.n * (x.n - 1) ELSE x.n * y.n END::BIGINT AS pairs, round(CASE WHEN a = b THEN (total - x.n) / (x.n * (x.n - 1)) ELSE total / (x.n * y.n) END, 6) AS mean_cosine
FROM p JOIN n x ON x.label = a JOIN n y ON y.label = b WHERE a <= b""")
def pairwise_group_cosine(spark: SparkSession, d: str) -> DataFrame:
    """Mean cosine over all pairs within and between groups, from group sums: the sum of all inner products of two
    groups is the inner product of their sums, so that no pair is made."""
    u = _units(spark, d)
    s = u.select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.sum("x").alias("s"), F.count("x").alias("n"))
    g = s.groupBy("label").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "s"))).alias("z")).select("label", "n", F.transform("z", lambda z: z["s"]).alias("s"))
    a, b = g.select(F.col("label").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa")), g.select(F.col("label").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"))
    p = a.join(b, F.col("a") <= F.col("b"))  # groups, not rows
    total, same = V.dot(F.col("sa"), F.col("sb")), F.col("a") == F.col("b")
    pairs = F.when(same, F.col("na") * (F.col("na") - 1)).otherwise(F.col("na") * F.col("nb"))
    return p.select("a", "b", pairs.alias("pairs"), r6(F.when(same, total - F.col("na")).otherwise(total) / F.when(pairs > 0, pairs), "mean_cosine"))


@query("""WITH e AS (SELECT vec_id, i AS dim, embedding[i]::DOUBLE AS x FROM embeddings, unnest(range(1, len(embedding) + 1)) AS t(i)), r AS (SELECT *, sum(x * x) OVER (PARTITION BY vec_id ORDER BY x * x DESC, dim ROWS UNBOUNDED PRECEDING) / sum(x * x) OVER (PARTITION BY vec_id) AS share,
  row_number() OVER (PARTITION BY vec_id ORDER BY x * x DESC, dim) AS k FROM e) SELECT vec_id, min(k) FILTER (share >= 0.5)::INTEGER AS half_energy FROM r GROUP BY vec_id""")
def cumulative_share(spark: SparkSession, d: str) -> DataFrame:
    e = V.usable(table(spark, d, "embeddings"), "embedding").select("vec_id", F.posexplode("embedding").alias("dim", "x")).withColumn("q", F.col("x") * F.col("x"))
    w = Window.partitionBy("vec_id").orderBy(F.desc("q"), "dim")
    e = e.withColumns({"share": F.sum("q").over(w.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("q").over(Window.partitionBy("vec_id")), "k": F.row_number().over(w)})
    return e.groupBy("vec_id").agg(F.min(F.when(F.col("share") >= 0.5, F.col("k"))).alias("half_energy"))


@query()
def ann_search(spark: SparkSession, d: str) -> DataFrame:
    """Approximate neighbours from an inverted index over all rows, for every query divisible by 50."""
    u = _units(spark, d)
    index = Index(spark, u)
    return index.search(u.where("id % 50 = 0"), K, index.probes_for(K))


@query("SELECT count(*) AS queries, TRUE AS reached FROM embeddings WHERE vec_id % 50 = 0")
def ann_recall(spark: SparkSession, d: str) -> DataFrame:
    """Whether the index finds nine of ten of the exact neighbours of all queries."""
    u = _units(spark, d)
    index, queries = Index(spark, u), u.where("id % 50 = 0")
    return queries.agg(F.count(F.lit(1)).alias("queries"), F.lit(index.recall(queries, K, index.probes_for(K)) >= 0.9).alias("reached"))


_PATHS = """u AS (SELECT vec_id AS id, i, embedding[i]::DOUBLE / sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS x, [label % 2, 10 + label, 1000 + vec_id % 97] AS p FROM embeddings, unnest(range(1, len(embedding) + 1)) AS t(i)),
e AS (SELECT id, i, x, d, array_to_string(p[1:d::INTEGER], ';') AS node FROM u, unnest(range(1, 4)) AS r(d)),
c AS (SELECT node, i, sum(x) AS s FROM e GROUP BY ALL HAVING count(*) >= 20), nn AS (SELECT node, sqrt(sum(s * s)) AS norm FROM c GROUP BY node),
w AS (SELECT id, max(d) AS d FROM e SEMI JOIN nn USING (node) GROUP BY id)"""


@query(f"""WITH {_PATHS} SELECT e.id, e.node, e.d::INTEGER AS depth, round(1 - least(greatest(sum(e.x * c.s / nn.norm), -1), 1), 6) AS distance
FROM e JOIN w ON w.id = e.id AND w.d = e.d JOIN c ON c.node = e.node AND c.i = e.i JOIN nn ON nn.node = e.node GROUP BY 1, 2, 3""")
def prefix_dispersion(spark: SparkSession, d: str) -> DataFrame:
    """Distance of each vector to the centroid of its deepest lineage prefix of 20 members or more."""
    u = _units(spark, d)
    path = F.array((F.col("label") % 2).cast("string"), (F.col("label") + 10).cast("string"), (F.col("id") % 97 + 1000).cast("string"))
    e = u.select("id", "v", F.explode(F.transform(F.sequence(F.lit(1), F.lit(3)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(path, F.lit(1), k), ";").alias("node")))).alias("s"))
    e = cut(spark, e.select("id", "v", "s.depth", "s.node"), "prefixes")
    c = V.centroids(e, "node", "v", 20)
    j = e.join(c, "node").select("id", F.struct("depth", "node", (1 - F.least(F.greatest(V.dot(F.col("v"), F.col("centroid")), F.lit(-1.0)), F.lit(1.0))).alias("distance")).alias("s"))
    return j.groupBy("id").agg(F.max("s").alias("s")).select("id", "s.node", "s.depth", r6(F.col("s.distance"), "distance"))


@query()
def pca_2d(spark: SparkSession, d: str) -> DataFrame:
    """Two principal components of centred vectors, raw and whitened."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    u = _units(spark, d).withColumn("f", array_to_vector("v"))
    u = StandardScaler(inputCol="f", outputCol="c", withMean=True, withStd=False).fit(u).transform(u)
    p = PCA(k=2, inputCol="c", outputCol="p").fit(u).transform(u).withColumn("p", vector_to_array("p"))
    s = p.agg(F.stddev_samp(F.col("p")[0]).alias("s0"), F.stddev_samp(F.col("p")[1]).alias("s1"))
    return p.crossJoin(F.broadcast(s)).select("id", r6(F.col("p")[0], "x"), r6(F.col("p")[1], "y"), r6(F.col("p")[0] / F.col("s0"), "wx"), r6(F.col("p")[1] / F.col("s1"), "wy"))
