"""Statistical operators over DataFrames; solves happen on one aggregated row."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import finite_or_null, quantiles, running_sum, zscore
from ..sources.shared import cut


def least_squares(df: DataFrame, xs: tuple[str, ...], y: str) -> dict[str, float]:
    """Coefficients from one aggregation of means and covariances; raises on a singular system."""
    names = [*xs, y]
    cells = [F.covar_pop(a, b).alias(f"{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i <= j]
    row = df.agg(*cells, *[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)]).first()
    k = len(xs)
    cov = np.array([[row[f"{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k + 1)] for i in range(k + 1)])
    b = np.linalg.solve(cov[:k, :k], cov[:k, k])
    return dict(zip(xs, b)) | {"intercept": row[f"m{k}"] - float(sum(b[i] * row[f"m{i}"] for i in range(k)))}


def correlations(spark: SparkSession, df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Pearson's and Spearman's coefficient of all pairs over rows complete in the pair: x, y, pearson, rho,
    n; null for fewer than three rows or where a column is constant. Ranks come from counts per value."""
    out = None
    for i, a in enumerate(columns):
        for b in columns[i + 1 :]:
            two = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("w"))
            # pairs of values carry their number of rows

            def ranks(c, two=two):
                per = running_sum(spark, two.groupBy(c).agg(F.sum("w").alias("m")), c, "m")
                return per.select(F.col(c), (F.col("upto_m") - F.col("m") + (F.col("m") + 1) / 2).alias(f"r_{c}"))

            j = two.join(ranks(a), a).join(ranks(b), b)
            w, four = F.col("w"), {"x": F.col(a).cast("double"), "y": F.col(b).cast("double"), "s": F.col(f"r_{a}"), "t": F.col(f"r_{b}")}
            sums = {k: v for k, v in four.items()} | {p + q: four[p] * four[q] for p, q in ("xx", "yy", "xy", "ss", "tt", "st")}
            total = j.agg(F.sum("w").alias("n"), *[F.sum(w * v).alias(k) for k, v in sums.items()])

            def about(p, q):
                return F.col(p + q) - F.col(p) * F.col(q) / F.col("n")

            def coefficient(p, q):
                return F.when((F.col("n") >= 3) & (about(p, p) > 1e-9 * F.col(p + p)) & (about(q, q) > 1e-9 * F.col(q + q)), about(p, q) / F.sqrt(about(p, p) * about(q, q)))

            row = total.select(F.lit(a).alias("x_name"), F.lit(b).alias("y_name"), F.round(coefficient("x", "y"), 6).alias("pearson"), F.round(coefficient("s", "t"), 6).alias("rho"), "n")
            row = row.select(F.col("x_name").alias("x"), F.col("y_name").alias("y"), "pearson", "rho", "n")
            out = row if out is None else out.unionByName(row)
    return out


def spearman(spark: SparkSession, df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rank correlations of all pairs."""
    return correlations(spark, df, columns).select("x", "y", "rho", "n")


def separation(spark: SparkSession, df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """AUC (ties half), standardized mean difference and KS distance of x between case and not, in all or per
    stratum ``by``, from counts per value."""
    per = df.groupBy(*by, "x").agg(F.count_if("case").alias("c1"), F.count_if(~F.col("case")).alias("c0"))
    per = running_sum(spark, per, "x", "c1", "c0", by=by)
    yes, no = F.when(F.col("case"), F.col("x")), F.when(~F.col("case"), F.col("x"))
    tot = df.groupBy(*by).agg(F.count(yes).alias("n1"), F.count(no).alias("n0"), F.avg(yes).alias("m1"), F.avg(no).alias("m0"), F.var_samp(yes).alias("v1"), F.var_samp(no).alias("v0"))
    j = per.join(tot, list(by)) if by else per.crossJoin(F.broadcast(tot))
    wins = F.sum(F.col("c1") * (F.col("upto_c0") - F.col("c0") + F.col("c0") / 2))
    one = lambda c: F.first(c)
    return j.groupBy(*by).agg(
        one("n1").alias("n1"), one("n0").alias("n0"), F.round(wins / (one("n1") * one("n0")), 6).alias("auc"),
        F.round((one("m1") - one("m0")) / F.sqrt((one("v1") + one("v0")) / 2), 6).alias("smd"), F.round(F.max(F.abs(F.col("upto_c1") / F.col("n1") - F.col("upto_c0") / F.col("n0"))), 6).alias("ks"),
    )


def standardized(spark: SparkSession, df: DataFrame, strata: int) -> DataFrame:
    """Means of y among cases, and among others weighted by cases, over quantile strata of ``by``."""
    q = quantiles(spark, df, "by", {f"q{i}": i / strata for i in range(1, strata)})
    q = q.select(F.array(*q.columns).alias("q"))
    s = df.crossJoin(F.broadcast(q)).withColumn("s", F.size(F.filter("q", lambda t: F.col("by") > t)))
    g = s.groupBy("s").agg(F.count_if("case").alias("w"), F.avg(F.when(F.col("case"), F.col("y"))).alias("y1"), F.avg(F.when(~F.col("case"), F.col("y"))).alias("y0")).where("w > 0 and y0 is not null")
    return g.agg(*[F.round(F.sum(F.col("w") * F.col(c)) / F.sum("w"), 6).alias(n) for c, n in (("y1", "cases"), ("y0", "standardized"))])


def beta_fraction(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta function by its continued fraction."""
    from math import exp, lgamma, log

    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_fraction(b, a, 1 - x)
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log(1 - x)) / a
    c, d, f = 1.0, 0.0, 1.0
    for m in range(300):
        for n in ((m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))) if m else 1.0, -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + n * d or 1e-30)
            c = (1 + n / c) or 1e-30
            f *= c * d
        if abs(1 - c * d) < 1e-12:
            break
    return front * (f - 1)


def welch(df: DataFrame, one: str, two: str) -> DataFrame:
    """Welch's t, Satterthwaite's degrees of freedom, pooled Cohen's d, half width of group one's 95 % interval."""
    per = lambda g: [F.count(F.when(F.col("group") == g, F.col("x"))), F.avg(F.when(F.col("group") == g, F.col("x"))), F.var_samp(F.when(F.col("group") == g, F.col("x")))]
    s = df.agg(*[c.alias(f"{n}{i}") for i, g in ((1, one), (0, two)) for n, c in zip("nmv", per(g))])
    c = F.col
    se1, se0 = c("v1") / c("n1"), c("v0") / c("n0")
    return s.select(
        ((c("m1") - c("m0")) / F.sqrt(se1 + se0)).alias("t"), (F.pow(se1 + se0, 2) / (F.pow(se1, 2) / (c("n1") - 1) + F.pow(se0, 2) / (c("n0") - 1))).alias("df"),
        ((c("m1") - c("m0")) / F.sqrt(((c("n1") - 1) * c("v1") + (c("n0") - 1) * c("v0")) / (c("n1") + c("n0") - 2))).alias("cohens_d"), (1.96 * F.sqrt("v1") / F.sqrt("n1")).alias("ci"),
    )


def two_sided_p(t: float, df: float) -> float:
    return beta_fraction(df / 2, 0.5, df / (df + t * t))


def standardize(spark: SparkSession, df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Not finite to null, null to the median, then population z; a constant column gives 0."""
    full = df.withColumns({c: finite_or_null(F.col(c).cast("double")) for c in columns})
    for c in columns:
        full = full.crossJoin(F.broadcast(quantiles(spark, full, c, {f"_m_{c}": 0.5})))  # one row
    full = full.withColumns({c: F.coalesce(c, f"_m_{c}") for c in columns})
    s = full.agg(*[F.avg(c).alias(f"_a_{c}") for c in columns], *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns])
    z = full.crossJoin(F.broadcast(s))
    return z.withColumns({c: zscore(F.col(c), F.col(f"_a_{c}"), F.col(f"_s_{c}")) for c in columns}).select(*df.columns)


def cluster_robust(spark: SparkSession, df: DataFrame) -> DataFrame:
    """y on x with an intercept; sandwich errors from score sums per cluster."""
    b = least_squares(df, ("x",), "y")
    e = F.col("y") - b["intercept"] - b["x"] * F.col("x")
    per = df.groupBy("cluster").agg(F.sum(e).alias("s0"), F.sum(e * F.col("x")).alias("s1"))
    m = per.agg(*[F.sum(F.col(a) * F.col(c)).alias(f"{a}{c}") for a, c in (("s0", "s0"), ("s0", "s1"), ("s1", "s1"))], F.count(F.lit(1)).alias("g")).first()
    t = df.agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum(F.col("x") * F.col("x")).alias("sxx")).first()
    bread = np.linalg.inv(np.array([[t["n"], t["sx"]], [t["sx"], t["sxx"]]], float))
    v = bread @ np.array([[m["s0s0"], m["s0s1"]], [m["s0s1"], m["s1s1"]]]) @ bread * (m["g"] / max(1, m["g"] - 1))
    rows = [(n, float(b[n]), float(np.sqrt(v[i, i])), int(m["g"])) for i, n in enumerate(("intercept", "x"))]
    return spark.createDataFrame(rows, "term string, estimate double, error double, clusters bigint")


def poisson_weight(*of: str) -> Column:
    """Poisson(1) from a hash of columns."""
    u = F.pmod(F.xxhash64(*of), F.lit(1 << 30)) / F.lit(float(1 << 30))
    weight, total, p = F.lit(0), 0.0, float(np.exp(-1.0))
    for k in range(8):
        total += p
        weight = weight + F.when(u > total, 1).otherwise(0)
        p /= k + 1
    return weight


def bootstrap(df: DataFrame, replicates: int, level: float = 0.95) -> DataFrame:
    """Interval of the mean of x; a row's weight in a replicate is Poisson(1) from a hash of both."""
    r = df.select("id", "x", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("r"))
    m = r.withColumn("w", poisson_weight("id", "r")).groupBy("r").agg((F.sum(F.col("w") * F.col("x")) / F.sum("w")).alias("m"))
    a = (1 - level) / 2
    return m.agg(F.percentile("m", a).alias("low"), F.percentile("m", 0.5).alias("middle"), F.percentile("m", 1 - a).alias("high"), F.count(F.lit(1)).alias("replicates"))


def permutation(spark: SparkSession, df: DataFrame, replicates: int) -> DataFrame:
    """p = (1 + exceedances) / (R + 1) of the case mean of x; each replicate gives the case labels to the rows of
    least hash within a stratum, found by the hash's rank."""
    cases = df.groupBy("stratum").agg(F.sum("case").alias("k"))
    r = df.select("id", "x", "stratum", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("r"))
    w = Window.partitionBy("r", "stratum").orderBy(F.xxhash64("id", "r"), "id")
    null = r.withColumn("n", F.row_number().over(w)).join(cases, "stratum").where("n <= k").groupBy("r").agg(F.avg("x").alias("m"))
    seen = df.where("case = 1").agg(F.avg("x").alias("seen"))
    return null.crossJoin(F.broadcast(seen)).agg(F.first("seen").alias("observed"), ((F.count_if(F.col("m") >= F.col("seen")) + 1) / (F.count(F.lit(1)) + 1)).alias("p"))


def holm(p: list[float]) -> list[float]:
    order, out, worst = np.argsort(p), [0.0] * len(p), 0.0
    for i, k in enumerate(order):
        worst = max(worst, min(1.0, (len(p) - i) * p[k]))
        out[k] = worst
    return out


def cluster_bootstrap(df: DataFrame, replicates: int, level: float = 0.95) -> DataFrame:
    """Interval of the mean of x where whole clusters are drawn: a cluster's weight in a replicate is Poisson(1)
    from a hash of both, and all its rows share it. Clusters are summed first."""
    per = df.groupBy(F.col("cluster").alias("id")).agg(F.sum("x").alias("s"), F.count("x").alias("n"))
    r = per.select("id", "s", "n", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("r"))
    m = r.withColumn("w", poisson_weight("id", "r")).groupBy("r").agg((F.sum(F.col("w") * F.col("s")) / F.sum(F.col("w") * F.col("n"))).alias("m"))
    a = (1 - level) / 2
    return m.agg(F.percentile("m", a).alias("low"), F.percentile("m", 0.5).alias("middle"), F.percentile("m", 1 - a).alias("high"), F.count(F.lit(1)).alias("replicates"))


def graph_permutation(spark: SparkSession, edges: DataFrame, labels: DataFrame, replicates: int) -> DataFrame:
    """One-sided p of the share of edges between equal labels, on the fixed graph, with labels shuffled within
    strata. edges: u, v; labels: id, label, stratum. A shuffle gives the labels in order of id to the ids in order
    of a hash of replicate and id; both orders are numbered per stratum by range partitions."""
    base = labels.select("id", "label", "stratum", F.lit(1).alias("one"))
    there = running_sum(spark, base, "id", "one", by=("stratum",)).select(F.col("stratum").alias("_s"), F.col("upto_one").alias("_n"), "label")
    r = base.select("id", "stratum", "one", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("r"))
    r = r.withColumn("place", F.struct(F.xxhash64("r", "id").alias("h"), "id"))
    given = running_sum(spark, r, "place", "one", by=("r", "stratum"))
    given = given.join(there, (F.col("stratum") == F.col("_s")) & (F.col("upto_one") == F.col("_n"))).select("r", "id", "label")
    given = cut(spark, given.unionByName(labels.select(F.lit(0).alias("r"), "id", "label")), "permuted")
    side = lambda name: given.select(F.col("r").alias(f"r_{name}"), F.col("id").alias(f"id_{name}"), F.col("label").alias(f"label_{name}"))
    j = edges.join(side("u"), F.col("u") == F.col("id_u")).join(side("v"), (F.col("v") == F.col("id_v")) & (F.col("r_u") == F.col("r_v")))
    share = j.groupBy(F.col("r_u").alias("r")).agg(F.avg((F.col("label_u") == F.col("label_v")).cast("int")).alias("share"))
    seen = share.where("r = 0").select(F.col("share").alias("seen"))  # one row
    null = share.where("r > 0").crossJoin(F.broadcast(seen))
    return null.agg(F.first("seen").alias("observed"), F.avg("share").alias("expected"), ((F.count_if(F.col("share") >= F.col("seen")) + 1) / (F.count(F.lit(1)) + 1)).alias("p"), F.count(F.lit(1)).alias("replicates"))


def within_groups(df: DataFrame, columns: tuple[str, ...], group: str) -> DataFrame:
    """Columns less their group's mean: what fixed effects of the group leave."""
    means = df.groupBy(group).agg(*[F.avg(c).alias(f"_m_{c}") for c in columns]).withColumnRenamed(group, "_g")
    out = df.join(means, F.col(group).eqNullSafe(F.col("_g")))
    return out.withColumns({c: F.col(c) - F.col(f"_m_{c}") for c in columns}).select(*df.columns)
