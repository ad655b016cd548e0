"""Connected components by alternating large-star and small-star steps.

Every step is a minimum per node (pre-aggregated) and an equi-join; the number of rounds grows
with the logarithm of the longest path. Edges are written to the shared folder after each round.
Nodes of very many edges are joined apart, see ``join_spread``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut

HOT = 1024


def join_spread(spark: SparkSession, rows: DataFrame, key: str, values: DataFrame, name: str) -> DataFrame:
    """rows with the columns of ``values``, which has one row per ``_key`` and the number ``m`` of rows of it.

    ``values`` is written, so that its size is known where the join is planned. Keys of more than ``HOT``
    rows do not meet in a task: there are at most rows / HOT of them, their own small table is sent to the
    rows where its size allows, and split as a skewed join where it does not; only the other keys are
    shuffled by key.
    """
    values = cut(spark, values, name)
    hot = values.where(F.col("m") > HOT)
    light = rows.join(values.where(F.col("m") <= HOT), F.col(key) == F.col("_key")).drop("_key", "m")
    if hot.isEmpty():
        return light
    hot = cut(spark, hot, f"{name}-hot")
    own = rows.join(hot.select(F.col("_key").alias("_hot")), F.col(key) == F.col("_hot"), "left_anti")
    light = own.join(values.where(F.col("m") <= HOT), F.col(key) == F.col("_key")).drop("_key", "m")
    return light.unionByName(rows.join(hot, F.col(key) == F.col("_key")).drop("_key", "m"))


def with_least(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """edges (u, v) with ``least``, the least v of each u."""
    least = edges.groupBy(F.col("u").alias("_key")).agg(F.min("v").alias("least"), F.count(F.lit(1)).alias("m"))
    return join_spread(spark, edges, "u", least, "cc-least")


def _summary(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """edges (u, v) to (node, root) for every node with an edge; root is the smallest node reachable."""
    e = cut(spark, edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "cc")
    before = _summary(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e = with_least(spark, both).where("v > u").select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct()
        small = with_least(spark, cut(spark, e, "cc-large"))
        e = small.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(small.select("u", F.col("least").alias("v")))
        e = cut(spark, e.distinct(), "cc")
        now = _summary(e)
        if now == before:
            break
        before = now
    leaves = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
