"""Deterministic sampling, strata and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import hash_fraction


def include(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Rows whose key's hash fraction is below ``fraction``: all rows of a key or none."""
    return df.where(hash_fraction(seed, F.col(key)) < F.lit(float(fraction)))


def strata(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def proportions(df: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    """Counts and shares within each dimension, in long form from one scan."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("dimension"), c.alias("value")) for n, c in dimensions.items()])).alias("x")).select("x.*")
    per = long.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n"))
    return per.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("dimension")), 6))


def drift(full: DataFrame, sample: DataFrame, by: tuple[str, ...], over: float = 2.0) -> DataFrame:
    """Strata whose share differs by more than ``over`` percentage points; empty if either side is empty."""
    one = Window.partitionBy()
    f = full.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).withColumn("all_n", F.sum("n").over(one))
    s = sample.groupBy(*by).agg(F.count(F.lit(1)).alias("m")).withColumn("all_m", F.sum("m").over(one))
    total = s.agg(F.max("all_m").alias("sample_total"))  # one row
    x = f.join(s.drop("all_m"), list(by), "left").crossJoin(F.broadcast(total)).where("sample_total > 0 and all_n > 0")
    a, b = F.col("n") / F.col("all_n"), F.coalesce("m", F.lit(0)) / F.col("sample_total")
    gap = F.abs(100 * (a - b))
    return x.where(gap > over).select(*by, F.round(100 * a, 3).alias("full_percent"), F.round(100 * b, 3).alias("sample_percent"), F.round(gap, 3).alias("drift"))
