"""Vector operators. Nearest neighbours are blocked matrix products: a stated query set against all rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import cut

#: Vectors of a query group stay in a task while candidate groups stream past: few copies of the candidates.
QUERY_ROWS, GROUP_ROWS, FAN = 32_768, 8192, 16
STEP_CELLS = 1 << 22
DIGITS = 6


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))


def usable(df: DataFrame, column: str, dim: int | None = None) -> DataFrame:
    """Rows whose vector is there, finite, not all zero and (if asked) of ``dim`` components, as doubles."""
    v = F.col(column).cast("array<double>")
    ok = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.where(ok if dim is None else ok & (F.size(v) == dim)).withColumn(column, v)


def unit(v: Column) -> Column:
    n = norm(v)
    return F.transform(v, lambda x: x / n)


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"grp": [int(pdf["grp"].iloc[0])], "ids": [pdf["id"].to_numpy(np.int64).tobytes()], "v": [np.stack(pdf["v"].to_numpy()).astype(np.float64).tobytes()]})


def _tile(k: int, near: float):
    def run(key, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out: dict = {"query": [], "part": [], "best": [], "close": []}
        if len(q) and len(c):
            qi = np.frombuffer(q["q_ids"].iloc[0], np.int64)
            qv = np.frombuffer(q["q_v"].iloc[0]).reshape(len(qi), -1)
            ci = np.frombuffer(c["ids"].iloc[0], np.int64)
            cv = np.frombuffer(c["v"].iloc[0]).reshape(len(ci), -1).T
            step = max(1, STEP_CELLS // len(ci))
            for lo in range(0, len(qi), step):
                for me, row in zip(qi[lo : lo + step], np.round(qv[lo : lo + step] @ cv, DIGITS)):
                    use = np.flatnonzero(ci != me)
                    best = use[np.lexsort((ci[use], -row[use]))][:k] if len(use) <= 4 * k else None
                    if best is None:
                        least = np.partition(row[use], len(use) - k)[len(use) - k]
                        use2 = use[row[use] >= least]
                        best = use2[np.lexsort((ci[use2], -row[use2]))][:k]
                    out["query"].append(int(me))
                    out["part"].append(int(key[1]))
                    out["best"].append([{"s": -float(row[i]), "id": int(ci[i])} for i in best])
                    out["close"].append(int((row[use] >= near).sum()))
        return pd.DataFrame(out)

    return run


def neighbours(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 10, near: float = 0.85) -> tuple[DataFrame, DataFrame]:
    """Edges (query, rank, neighbour, similarity) and density (query, close) by cosine, self excluded by id. Both frames:
    id, v (unit vectors of one length). Similarities are rounded to DIGITS before ranking; ties go to the smaller id."""
    c, q = cut(spark, vectors.select("id", "v"), "knn-rows"), cut(spark, queries.select("id", "v"), "knn-queries")
    nc, nq = max(1, math.ceil(c.count() / GROUP_ROWS)), max(1, math.ceil(q.count() / QUERY_ROWS))
    pack = lambda d, n: d.withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).groupBy("grp").applyInPandas(_pack, "grp int, ids binary, v binary")
    left = pack(q, nq).select(F.col("grp").alias("qg"), F.explode(F.sequence(F.lit(0), F.lit(nc - 1))).alias("cg"), F.col("ids").alias("q_ids"), F.col("v").alias("q_v"))
    right = pack(c, nc).select(F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("c_qg"), F.col("grp").alias("c_cg"), "ids", "v")
    lists = cut(spark, left.groupBy("qg", "cg").cogroup(right.groupBy("c_qg", "c_cg")).applyInPandas(_tile(k, near), "query bigint, part int, best array<struct<s:double,id:bigint>>, close bigint"), "knn-lists")
    merged, width = lists, nc
    while True:
        merged = merged.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("query", "part").agg(F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best"), F.sum("close").alias("close"))
        width = math.ceil(width / FAN)
        if width <= 1:
            break
    edges = merged.select("query", F.posexplode("best").alias("pos", "b")).select("query", (F.col("pos") + 1).alias("rank"), F.col("b.id").alias("neighbour"), (-F.col("b.s")).alias("similarity"))
    return edges, merged.select("query", "close")


def dimension_moments(df: DataFrame, column: str) -> DataFrame:
    """Mean and sample variance per dimension; the exploded components are aggregated map-side."""
    return df.select(F.posexplode(column).alias("dim", "x")).groupBy("dim").agg(F.avg("x").alias("mean"), F.var_samp("x").alias("variance"), F.count("x").alias("n"))


def top_dimensions(v: Column, k: int) -> Column:
    """(1-based place, value) of the k largest components by absolute value, ties to the later place."""
    ranked = F.sort_array(F.transform(v, lambda x, i: F.struct(F.abs(x).alias("a"), (i + 1).alias("dim"), x.alias("x"))), False)
    return F.transform(F.slice(ranked, 1, k), lambda s: F.struct(s["dim"].alias("dim"), s["x"].alias("value")))


def centroids(df: DataFrame, group: str, column: str, least: int) -> DataFrame:
    """Unit centroid of the unit vectors of each group of ``least`` members or more: group, n, centroid."""
    long = df.select(group, F.posexplode(column).alias("i", "x")).groupBy(group, "i").agg(F.sum("x").alias("s"), F.count("x").alias("n")).where(F.col("n") >= least)
    c = long.groupBy(group).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "s"))).alias("c"))
    return c.select(group, "n", unit(F.transform("c", lambda z: z["s"])).alias("centroid"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def parse(c: Column) -> Column:
    """A vector from JSON or delimited text; null if any component is not a finite number."""
    json = F.from_json(c, "array<double>")
    words = F.transform(F.split(F.trim(F.regexp_replace(c, r"[\[\](),;|]+", " ")), r"\s+"), lambda x: x.try_cast("double"))
    v = F.coalesce(json, words)
    return F.when(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), v)


def sphere(dim: Column, n: int) -> Column:
    """Golden-angle place of a dimension on the unit sphere."""
    y = F.lit(1.0) - 2.0 * (dim + 0.5) / n
    r, a = F.sqrt(1 - y * y), dim * (math.pi * (3 - math.sqrt(5)))
    return F.struct((F.cos(a) * r).alias("x"), y.alias("y"), (F.sin(a) * r).alias("z"))


def search(spark: SparkSession, vectors: DataFrame, queries: DataFrame, limit: int = 10, metric: str = "cosine", where: Column | None = None) -> DataFrame:
    """query, rank, neighbour, distance by ``cosine``, ``l2`` or ``dot``, self excluded by id; ``where`` holds for candidates
    alone. Both frames: id, v. All metrics are inner products: of unit vectors, of the vectors, and for l2 of (q, 1) with
    (c, -|c|^2 / 2), which orders as the distance does."""
    if metric not in ("cosine", "l2", "dot"):
        raise ValueError(f"unknown metric {metric}")
    v, sq = F.col("v"), dot(F.col("v"), F.col("v"))
    as_query = {"cosine": unit(v), "dot": v, "l2": F.concat(v, F.array(F.lit(1.0)))}[metric]
    as_row = {"cosine": unit(v), "dot": v, "l2": F.concat(v, F.array(-sq / 2))}[metric]
    rows = vectors if where is None else vectors.where(where)
    edges, _ = neighbours(spark, rows.select("id", as_row.alias("v")), queries.select("id", as_query.alias("v")), limit)
    if metric == "l2":
        edges = edges.join(queries.select(F.col("id").alias("query"), sq.alias("sq")), "query")
    s = F.col("similarity")
    distance = {"cosine": 1 - s, "dot": -s, "l2": F.sqrt(F.greatest(F.col("sq") - 2 * s, F.lit(0.0))) if metric == "l2" else None}[metric]
    return edges.select("query", "rank", "neighbour", distance.alias("distance"))


def assert_rectangular(df: DataFrame, column: str) -> int:
    """The common length of all vectors; raises for nulls and unequal lengths."""
    low, high, n, m = df.agg(F.min(F.size(column)), F.max(F.size(column)), F.count(F.lit(1)), F.count(column)).first()
    if n != m or low != high:
        raise ValueError(f"{column}: {n - m} nulls, lengths from {low} to {high}")
    return low or 0
