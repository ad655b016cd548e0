"""Aggregation at every prefix of a path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prefix_tree(df: DataFrame, value: str, path: str = "path", depth: int = 5) -> DataFrame:
    """node, parent, label, depth, n, median, q25, q75, sd for every prefix, and a root row. ``df`` has a path (array) and a
    value; rows without a path are left out."""
    some = df.where(F.size(path) > 0)
    ends = F.sequence(F.lit(1), F.least(F.size(path), F.lit(depth)))
    x = some.select(F.explode(ends).alias("depth"), F.col(path).alias("path"), F.col(value).alias("v"))
    x = x.select(F.array_join(F.slice("path", F.lit(1), F.col("depth")), ";").alias("node"), F.when(F.col("depth") > 1, F.array_join(F.slice("path", F.lit(1), F.col("depth") - 1), ";")).otherwise("root").alias("parent"),
                 F.get("path", F.col("depth") - 1).alias("label"), "depth", "v")
    stats = lambda: (
        F.count(F.lit(1)).alias("n"), F.round(F.percentile("v", 0.5), 6).alias("median"), F.round(F.percentile("v", 0.25), 6).alias("q25"), F.round(F.percentile("v", 0.75), 6).alias("q75"),
        F.round(F.coalesce(F.stddev_samp("v"), F.lit(0.0)), 6).alias("sd"),
    )
    root = some.select(F.col(value).alias("v")).agg(*stats()).select(F.lit("root").alias("node"), F.lit("").alias("parent"), F.lit("root").alias("label"), F.lit(0).alias("depth"), "n", "median", "q25", "q75", "sd")
    return x.groupBy("node", "parent", "label", "depth").agg(*stats()).unionByName(root)


def pruned_tree(tree: DataFrame, least: int) -> DataFrame:
    """Nodes of ``least`` members or more; the first level always stays. Sizes only fall with depth, so that a kept
    deeper node's parent is kept too."""
    return tree.where((F.col("depth") <= 1) | (F.col("n") >= least))
