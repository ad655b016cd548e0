"""Density clusters in two dimensions and how stable they are."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import cut

PARTS = 8


def _cells(points: DataFrame, radius: float) -> DataFrame:
    """Points with their cell; any two points of one cell lie within the radius."""
    side = radius / math.sqrt(2)
    return points.withColumns({"cx": F.floor(F.col("x") / side).cast("bigint"), "cy": F.floor(F.col("y") / side).cast("bigint")})


def _around(cells: DataFrame) -> DataFrame:
    """Each row once for each of the 5 x 5 cells around its own, which hold all points within the radius."""
    steps = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in range(-2, 3) for j in range(-2, 3)])
    return cells.withColumn("_s", F.explode(steps)).withColumns({"nx": F.col("cx") + F.col("_s.dx"), "ny": F.col("cy") + F.col("_s.dy")}).drop("_s")


def core_points(spark: SparkSession, points: DataFrame, radius: float, least: int) -> DataFrame:
    """id, x, y, cx, cy, core: whether ``least`` points, itself included, lie within the radius.

    A cell of ``least`` points or more makes all its points core without a comparison, so that only points of
    sparse cells are compared, with at most as many rows of a cell as it takes to decide.
    """
    p = cut(spark, _cells(points.select("id", "x", "y"), radius), "cluster-points")
    counts = cut(spark, p.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("m")), "cluster-cells")
    dense = counts.where(F.col("m") >= least).drop("m")
    # of each other cell all points, fewer than ``least``; of a dense one all are needed, but per point they only add up
    sparse = p.join(dense, ["cx", "cy"], "left_anti")
    others = p.select(F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("cx").alias("nx"), F.col("cy").alias("ny"))
    near = F.pow(F.col("x") - F.col("ox"), 2) + F.pow(F.col("y") - F.col("oy"), 2) <= radius * radius
    decided = _around(sparse).join(others, ["nx", "ny"]).where(near).groupBy("id").agg(F.count(F.lit(1)).alias("near")).where(F.col("near") >= least).select(F.col("id").alias("_id"))
    some = sparse.join(decided, F.col("id") == F.col("_id"), "left").withColumn("core", F.col("_id").isNotNull()).drop("_id")
    return p.join(dense, ["cx", "cy"], "left_semi").withColumn("core", F.lit(True)).unionByName(some.select("cx", "cy", "id", "x", "y", "core"))


def _components(spark: SparkSession, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, root: the least node reachable; labels jump to the labels of labels, so that long chains take few rounds."""
    labels = cut(spark, nodes.select("node", F.col("node").alias("root")), "cluster-labels")
    both = cut(spark, edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "cluster-edges")
    while True:
        offers = both.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(F.min("root").alias("offer"))
        # the label of a neighbour is offered to the node and to the node's own label
        own = labels.join(offers, F.col("node") == F.col("u"), "left").select("node", "root", F.least("root", F.coalesce("offer", "root")).alias("best"))
        jump = own.groupBy(F.col("root").alias("_r")).agg(F.min("best").alias("lower"))
        step = own.join(jump, F.col("root") == F.col("_r"), "left").select("node", F.least("best", F.coalesce("lower", "best")).alias("root"))
        after = cut(spark, step, "cluster-labels")
        moved = after.join(labels.select(F.col("node").alias("_n"), F.col("root").alias("_old")), F.col("node") == F.col("_n")).where("root <> _old")
        labels = after
        if moved.isEmpty():
            return labels


def _cell_links(spark: SparkSession, named: DataFrame, radius: float) -> DataFrame:
    """Pairs of cells (u, v: their nodes) with core points within the radius. Points are boxed in parts of their
    cells, and boxes decide: no point of two boxes is farther than the radius, or none is nearer. Points are
    compared only between boxes that leave it open, of cells that no other boxes link."""
    part = radius / math.sqrt(2) / PARTS
    named = named.withColumns({"sx": F.floor(F.col("x") / part), "sy": F.floor(F.col("y") / part)})
    box = named.groupBy("cx", "cy", "node", "sx", "sy").agg(*[f(c).alias(f"{n}_{c}") for c in "xy" for n, f in (("lo", F.min), ("hi", F.max))])
    box = cut(spark, box, "cluster-boxes")
    names = {"cx": "nx", "cy": "ny"}
    other = box.select(*[F.col(c).alias(names.get(c, f"o_{c}")) for c in box.columns])
    pairs = _around(box).join(other, ["nx", "ny"]).where(F.col("node") < F.col("o_node"))
    far = [F.greatest(F.col(f"hi_{c}") - F.col(f"o_lo_{c}"), F.col(f"o_hi_{c}") - F.col(f"lo_{c}")) for c in "xy"]
    near = [F.greatest(F.lit(0.0), F.col(f"lo_{c}") - F.col(f"o_hi_{c}"), F.col(f"o_lo_{c}") - F.col(f"hi_{c}")) for c in "xy"]
    square = lambda two: two[0] * two[0] + two[1] * two[1]
    pairs = pairs.where(square(near) <= radius * radius).withColumn("sure", square(far) <= radius * radius)
    pairs = cut(spark, pairs.select(F.col("node").alias("u"), F.col("o_node").alias("v"), "sx", "sy", "o_sx", "o_sy", "sure"), "cluster-pairs")
    sure = cut(spark, pairs.where("sure").select("u", "v").distinct(), "cluster-sure")
    left = pairs.where("not sure").join(sure, ["u", "v"], "left_anti").drop("sure")
    one = named.select(F.col("node").alias("u"), "sx", "sy", "x", "y")
    two = named.select(F.col("node").alias("v"), F.col("sx").alias("o_sx"), F.col("sy").alias("o_sy"), F.col("x").alias("ox"), F.col("y").alias("oy"))
    within = F.pow(F.col("x") - F.col("ox"), 2) + F.pow(F.col("y") - F.col("oy"), 2) <= radius * radius
    met = left.join(one, ["u", "sx", "sy"]).join(two, ["v", "o_sx", "o_sy"]).where(within).select("u", "v").distinct()
    return sure.unionByName(met)


def density_clusters(spark: SparkSession, points: DataFrame, radius: float, least: int) -> DataFrame:
    """id, core, cluster: the least id among the core points of its cluster, null for noise. ``points``: id, x, y.

    Core points of one cell are one cluster; two cells are linked where any two of their core points lie within
    the radius. A point that is no core takes the nearest core point's cluster, ties to the lesser cluster.
    """
    p = cut(spark, core_points(spark, points, radius, least), "cluster-core")
    core = p.where("core")
    cells = cut(spark, core.groupBy("cx", "cy").agg(F.min("id").alias("node")), "cluster-nodes")
    named = core.join(cells, ["cx", "cy"]).select("id", "x", "y", "cx", "cy", "node")
    gap = F.pow(F.col("x") - F.col("ox"), 2) + F.pow(F.col("y") - F.col("oy"), 2)
    edges = _cell_links(spark, cut(spark, named, "cluster-named"), radius)
    labels = _components(spark, cells, edges)
    inside = named.join(labels.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node")).select("id", F.lit(True).alias("core"), F.col("root").alias("cluster"), "x", "y", "cx", "cy")
    inside = cut(spark, inside, "cluster-inside")
    reach = inside.select(F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("cx").alias("nx"), F.col("cy").alias("ny"), "cluster")
    edge = _around(p.where("not core")).join(reach, ["nx", "ny"]).where(gap <= radius * radius).groupBy("id").agg(F.min(F.struct(gap.alias("gap"), "cluster")).alias("best"))
    border = p.where("not core").select("id", "core").join(edge, "id", "left").select("id", "core", F.col("best.cluster").alias("cluster"))
    return inside.select("id", "core", "cluster").unionByName(border)


def stability(one: DataFrame, two: DataFrame) -> DataFrame:
    """For each cluster of ``one`` (id, cluster) the cluster of ``two`` that shares most of it: cluster, size,
    best, jaccard. From counts of shared points per pair of clusters."""
    a = one.where("cluster is not null").select("id", F.col("cluster").alias("a"))
    b = two.where("cluster is not null").select("id", F.col("cluster").alias("b"))
    na, nb = a.groupBy("a").agg(F.count(F.lit(1)).alias("na")), b.groupBy("b").agg(F.count(F.lit(1)).alias("nb"))
    shared = a.join(b, "id").groupBy("a", "b").agg(F.count(F.lit(1)).alias("both")).join(na, "a").join(nb, "b")
    j = shared.withColumn("jaccard", F.col("both") / (F.col("na") + F.col("nb") - F.col("both")))
    best = j.groupBy("a").agg(F.max(F.struct("jaccard", (-F.col("b")).alias("b"))).alias("best"))
    out = na.join(best, "a", "left")
    return out.select(F.col("a").alias("cluster"), F.col("na").alias("size"), (-F.col("best.b")).alias("best"), F.coalesce("best.jaccard", F.lit(0.0)).alias("jaccard"))
