"""Statistical expressions and global ranks without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.shared import cut


def zscore(x: Column, mean: Column, sd: Column) -> Column:
    return F.when(sd > 0, (x - mean) / sd).otherwise(F.lit(0.0))


def robust_iqr(x: Column, median: Column, q25: Column, q75: Column) -> Column:
    return zscore(x, median, (q75 - q25) / F.lit(1.349))


def robust_mad(x: Column, median: Column, mad: Column) -> Column:
    return zscore(x, median, mad * F.lit(1.4826))


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def finite_or_null(x: Column) -> Column:
    return F.when(finite(x), x)


def rounded(x: Column, places: int) -> Column:
    """A double to so many places as the SQL has it: the binary product with a power of ten decides, halves go away from
    zero. ``F.round`` goes by the shortest decimal form of x and differs next to a half (0.128125 to 5 places)."""
    product = x * F.lit(10.0**places)
    return F.when(F.abs(product) < F.lit(float("inf")), F.round(product) / F.lit(10.0**places)).otherwise(x)


def bucket(x: Column, lo: float, hi: float, n: int) -> Column:
    """1..n inside, 0 below, n + 1 above; what is not finite goes to 0."""
    return F.when(finite(x), F.width_bucket(x, F.lit(lo), F.lit(hi), F.lit(n).cast("bigint"))).otherwise(0).cast("int")


def parse_number(c: Column) -> Column:
    """Plain, thousands-separated and decimal-comma numbers; null otherwise."""
    s = F.trim(c)
    return F.coalesce(
        s.try_cast("double"),
        F.when(s.rlike(r"^-?\d{1,3}(,\d{3})+(\.\d+)?$"), F.replace(s, F.lit(","), F.lit("")).try_cast("double")),
        F.when(s.rlike(r"^-?\d+,\d+$"), F.replace(s, F.lit(","), F.lit(".")).try_cast("double")),
    )


def truth(c: Column) -> Column:
    low = F.lower(F.trim(c))
    return F.when(low.isin("true", "1", "yes", "y"), True).when(low.isin("false", "0", "no", "n"), False)


def global_rank(spark: SparkSession, df: DataFrame, *order: Column, name: str = "rn") -> DataFrame:
    """Row numbers from 1 in a total order, by range partitions: sort once, number inside each partition, add the
    rows of the partitions before. No task sees more than its range."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(spark, df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ranked")
    sizes = ranged.groupBy("_part").count()
    before = sizes.select("_part", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    local = ranged.withColumn("_local", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return local.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_local")).drop("_part", "_before", "_local")


def ntile(rn: Column, total: int, n: int) -> Column:
    """The tile of a row number: the first ``total % n`` tiles hold one row more."""
    small, extra = divmod(total, n)
    edge = (small + 1) * extra
    big = F.floor((rn - 1) / (small + 1)) + 1
    if not small:
        return big.cast("int")
    return F.when(rn <= edge, big).otherwise(extra + F.floor((rn - 1 - edge) / small) + 1).cast("int")


def running_sum(spark: SparkSession, df: DataFrame, order: str, *values: str, by: tuple[str, ...] = ()) -> DataFrame:
    """df with ``upto_<value>``, the sum of a value up to and with its row in the order of a group ``by``.
    Rows go to ranges of (by, order); a range adds what the ranges before it hold of its group, so
    that no task sees a whole group. ``order`` holds no value twice in a group."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(spark, df.repartitionByRange(n, *by, order).withColumn("_part", F.spark_partition_id()), "running")
    parts = ranged.groupBy(*by, "_part").agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])  # n rows and one per group
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(
        F.col("_part").alias("_p"), *[F.col(b).alias(f"_by_{b}") for b in by], *[F.coalesce(F.sum(f"_sum_{v}").over(earlier), F.lit(0)).alias(f"_before_{v}") for v in values]
    )
    on = F.col("_part") == F.col("_p")
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    inside = Window.partitionBy(*by, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.join(before, on).withColumns({f"upto_{v}": F.col(f"_before_{v}") + F.sum(v).over(inside) for v in values})
    return out.select(*df.columns, *[f"upto_{v}" for v in values])


def value_counts(spark: SparkSession, df: DataFrame, column: str, by: tuple[str, ...] = ()) -> DataFrame:
    """by, value, c, upto_c, n: rows per distinct value that is not null, running within the group, and in all."""
    per = df.where(F.col(column).isNotNull()).groupBy(*by, F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("c"))
    per = running_sum(spark, per, "value", "c", by=by)
    total = per.groupBy(*by).agg(F.max("upto_c").alias("n"))
    if not by:
        return per.crossJoin(F.broadcast(total))  # one row
    on = F.lit(True)
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    return per.join(total.select(*[F.col(b).alias(f"_by_{b}") for b in by], "n"), on).drop(*[f"_by_{b}" for b in by])


def quantiles(spark: SparkSession, df: DataFrame, column: str, ps: dict[str, float], by: tuple[str, ...] = (), interpolated: bool = True) -> DataFrame:
    """Exact quantiles per group, named: interpolated between neighbours, or the element at place
    floor(p * n) from 0. Counts per value and range partitions; no task holds a group's values."""
    per = value_counts(spark, df, column, by)
    at = lambda place: F.min(F.when(F.col("upto_c") > place, F.col("value")))
    last = F.col("n") - 1
    if not interpolated:
        return per.groupBy(*by).agg(*[at(F.least(F.floor(F.lit(p) * F.col("n")), last)).alias(name) for name, p in ps.items()])
    aggregates = [c for i, p in enumerate(ps.values()) for c in (at(F.floor(F.lit(p) * last)).alias(f"_lo{i}"), at(F.ceil(F.lit(p) * last)).alias(f"_hi{i}"))]
    out = per.groupBy(*by).agg(F.max("n").alias("_n"), *aggregates)
    part = lambda p: F.lit(p) * (F.col("_n") - 1) - F.floor(F.lit(p) * (F.col("_n") - 1))
    return out.select(*by, *[(F.col(f"_lo{i}") + part(p) * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(name) for i, (name, p) in enumerate(ps.items())])


def mid_rank(spark: SparkSession, df: DataFrame, column: str, name: str, *by: str) -> DataFrame:
    """Average rank over ties, per group ``by``, from counts per value."""
    per = value_counts(spark, df, column, by).select(*by, F.col("value").alias(column), (F.col("upto_c") - F.col("c") + (F.col("c") + 1) / 2).alias(name))
    return df.join(per, [*by, column])
