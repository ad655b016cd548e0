"""Group reports and checked joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import assert_unique
from ..functions.stats import quantiles, truth


def missing(c: Column) -> Column:
    """Null or blank."""
    return c.isNull() | (F.trim(c.cast("string")) == "")


def membership(df: DataFrame, groups: dict[str, Column]) -> DataFrame:
    """A row for each group that a row belongs to, overlaps kept, with ``taxon``."""
    belongs = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in groups.items()]))
    return df.withColumn("taxon", F.explode(belongs))


def profile(spark: SparkSession, members: DataFrame, metrics: tuple[str, ...], distinct: tuple[str, ...], coding: str, group: str = "taxon") -> DataFrame:
    """One wide row per group: rows, then n, mean, q25, median and q75 of every metric, the share of coding rows
    among those that say, and counts of distinct values that are there. Quantiles take one pass over all metrics in long form."""
    said = truth(F.col(coding).cast("string"))
    out = members.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"), F.count(said).alias("coding_known"), (F.count_if(said) / F.nullif(F.count(said), F.lit(0))).alias("coding_fraction"),
        *[F.count(m).alias(f"{m}_n") for m in metrics], *[F.avg(m).alias(f"{m}_mean") for m in metrics],
    )
    long = members.select(group, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(group, list(metrics), "metric", "x")
    q = quantiles(spark, long, "x", {"q25": 0.25, "median": 0.5, "q75": 0.75}, (group, "metric"))
    wide = q.groupBy(group).agg(*[F.max(F.when(F.col("metric") == m, F.col(p))).alias(f"{m}_{p}") for m in metrics for p in ("q25", "median", "q75")])
    values = members.select(group, *[F.col(c).cast("string").alias(c) for c in distinct]).unpivot(group, list(distinct), "column", "v").where(~missing(F.col("v"))).distinct()
    counts = values.groupBy(group).agg(*[F.count_if(F.col("column") == c).alias(f"distinct_{c}") for c in distinct])
    return out.join(wide, group, "left").join(counts, group, "left")


def evidence(members: DataFrame, columns: tuple[str, ...], sums: tuple[str, ...], group: str = "taxon") -> DataFrame:
    """group, column, rows, present, distinct, excess (copies beyond the first), total (of ``sums`` only; null
    without a value), from counts per value."""
    long = members.select(group, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(group, list(columns), "column", "v")
    per = long.groupBy(group, "column", "v").agg(F.count(F.lit(1)).alias("c"))
    there = F.col("v").isNotNull()
    add = F.sum(F.when(F.col("column").isin(*sums), F.col("v").try_cast("double") * F.col("c")))
    out = per.groupBy(group, "column").agg(F.sum("c").alias("rows"), F.coalesce(F.sum(F.when(there, F.col("c"))), F.lit(0)).alias("present"), F.count("v").alias("distinct"), add.alias("total"))
    return out.withColumn("excess", F.col("present") - F.col("distinct"))


def compare(spark: SparkSession, members: DataFrame, score: str, content: str, group: str = "taxon") -> DataFrame:
    """All pairs of groups: sizes, medians of the score, their difference, and how many contents both have.
    Overlaps come from contents and the groups that have them, not from pairs of rows."""
    g = members.groupBy(group).agg(F.count(F.lit(1)).alias("rows")).join(quantiles(spark, members, score, {"median": 0.5}, (group,)), group, "left")
    a, b = (g.select(*[F.col(c).alias(f"{'taxon' if c == group else c}_{s}") for c in g.columns]) for s in "ab")
    pairs = a.join(b, F.col("taxon_a") < F.col("taxon_b"))  # groups, not rows
    has = members.where(F.col(content).isNotNull()).groupBy(content).agg(F.sort_array(F.collect_set(group)).alias("in"))
    two = F.flatten(F.transform("in", lambda x, i: F.transform(F.slice(F.col("in"), i + 2, F.size("in")), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    shared = has.where(F.size("in") > 1).select(F.explode(two).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("overlap"))
    out = pairs.join(shared, (F.col("taxon_a") == F.col("a")) & (F.col("taxon_b") == F.col("b")), "left").drop("a", "b")
    return out.withColumns({"difference": F.col("median_a") - F.col("median_b"), "overlap": F.coalesce("overlap", F.lit(0))})


def join_one_to_one(left: DataFrame, right: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Left join; raises if either side has a key twice."""
    assert_unique(left, key)
    assert_unique(right, key)
    return left.join(right, list(key), "left")


def join_deduplicated(facts: DataFrame, sides: list[tuple[DataFrame, dict[str, Column]]], key: tuple[str, ...]) -> DataFrame:
    """Facts with sides whose keys repeat: each side is brought to one row per key by its aggregates first, so that no
    row is multiplied; then one row per key of the facts' own."""
    out = facts
    for side, aggregates in sides:
        out = out.join(side.groupBy(*key).agg(*[c.alias(n) for n, c in aggregates.items()]), list(key), "left")
    return out


def positions(edges: DataFrame, index: DataFrame, key: str, place: str) -> DataFrame:
    """Edges with the place of their key, null where the index does not have it."""
    return edges.join(index.select(F.col(key).alias("_key"), F.col(place).alias(f"{key}_place")), F.col(key) == F.col("_key"), "left").drop("_key")


def sample_rows(df: DataFrame, n: int, *key: str, seed: int = 42) -> DataFrame:
    """n rows without replacement, those of least hash of seed and key; the same rows in every run and layout."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])), *key).limit(n)


def reservoir(df: DataFrame, category: str, cap: int, *key: str, seed: int = 42) -> DataFrame:
    """The ``cap`` rows of least hash of each category: a sampling operator. Candidates are cut per task before the shuffle."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    from pyspark.sql import Window

    w = Window.partitionBy(category).orderBy(h, *key)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= cap).drop("_n")


def in_bounds(place: Column, size: Column) -> Column:
    return (size > 1) & (place >= 0) & (place < size)


def normalized_place(place: Column, size: Column) -> Column:
    """Place over the last place, null out of bounds."""
    return F.when(in_bounds(place, size), place / (size - 1))


def strand_label(c: Column) -> Column:
    """``<+>`` to ``+``; blank or null to unknown."""
    label = F.regexp_replace(F.trim(c), "[<>]", "")
    return F.when(label != "", label).otherwise("unknown")


def fraction(c: Column) -> Column:
    """A percent above 1 as a fraction."""
    return F.when(c > 1, c / 100).otherwise(c)


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is not above 0."""
    return F.when(b > 0, a / b).otherwise(0.0)
