"""Duplicate keys: collapse, report, keep first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collapse(df: DataFrame, key: tuple[str, ...], value: str) -> DataFrame:
    """One row per key: mean, copies, spread of ``value``."""
    return df.groupBy(*key).agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("copies"), (F.max(value) - F.min(value)).alias("spread"))


def report(collapsed: DataFrame) -> DataFrame:
    return collapsed.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_rows"), F.count(F.lit(1)).alias("unique_keys"), F.count_if(F.col("copies") > 1).alias("duplicated"),
        F.count_if(F.col("spread") > 0).alias("disagreeing"), F.round(F.max("spread"), 6).alias("max_spread"),
    )


def keep_first(df: DataFrame, key: tuple[str, ...], *order: str) -> DataFrame:
    """The row of each key that is first in ``order``, ties by the other columns that can be ordered; one aggregation
    before the shuffle, columns of any type."""
    plain = [f.name for f in df.schema if f.name not in (*key, *order) and not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    own = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    first = df.groupBy(*key).agg(F.min_by(own, F.struct(*[F.col(f"`{c}`") for c in (*order, *plain)])).alias("_r"))
    return first.select("_r.*")
