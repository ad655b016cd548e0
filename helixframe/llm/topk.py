"""Exact top-k search by tiled matrix products.

Queries and candidates are cut into blocks of bounded size. A tile is one pair of a query
group and a candidate group; it is a series of matrix products, with partial selection of the k best
per query. Partial lists are merged in a tree: first within runs of ``FAN`` groups, then finally.

Scale: the tile grid is two-dimensional. Groups are bounded by bytes: a query group holds ``QUERY_BYTES``
of vectors (131,072 of 64 components), a candidate group ``GROUP_BYTES``. Candidates are copied once per
query group, so queries are gathered in as few groups as memory allows, and candidate blocks stream past them.
Work is (queries x rows), as the search asks for; a tile emits k rows a query at most, in
packed lists, and a merge task never sees more than ``FAN`` lists of one query.

Edge cases: vectors that are null or hold a null or non-finite component take no part; vectors
of unequal length have no inner product and never meet; fewer than k candidates give what there
is; rows with one id are one vector each, and a query's own id is never its candidate; a null id
takes no part; an empty table gives an empty result. Components beyond 2**62 / 64 in size are held there;
sums that 53 bits cannot hold exactly are computed in whole-number arithmetic and held within the range
of long.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

GROUP_BYTES = 1 << 22
QUERY_BYTES = 1 << 24
STEP_CELLS = 1 << 21
FAN = 16
BLOCK = "side int, grp int, dim int, ids binary, vectors binary"


def _pack(groups_c: int, groups_q: int, every: int):
    """Rows to blocks of int64 vectors, dealt to groups by hash."""

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            dims = pdf["v"].map(len).to_numpy()
            ids = pdf["vec_id"].to_numpy(np.int64)
            deal = pdf["h"].to_numpy(np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                v = np.vstack(pdf["v"].to_numpy()[at]).astype(np.float64) if dim else np.zeros((len(at), 0))
                v = np.clip(np.floor(v * 64.0), -(2.0**62), 2.0**62).astype(np.int64)
                small = np.int16 if np.abs(v).max(initial=0) < 2**15 else np.int64
                for side, n in ((0, groups_c), (1, groups_q)):
                    use = np.arange(len(at)) if side == 0 else np.flatnonzero(ids[at] % every == 0)
                    g = deal[at][use] % n
                    for k in np.unique(g):
                        i = use[g == k]
                        yield pd.DataFrame({"side": [side], "grp": [int(k)], "dim": [int(dim)], "ids": [ids[at][i].tobytes()], "vectors": [bytes([small().itemsize]) + v[i].astype(small).tobytes()]})

    return run


def _unpack(ids, vectors, dim: int):
    vs = [np.frombuffer(b, np.int16 if b[0] == 2 else np.int64, offset=1).reshape(-1, dim) if dim else np.zeros((len(i) // 8, 0), np.int64) for b, i in zip(vectors, ids)]
    ids = np.concatenate([np.frombuffer(b, np.int64) for b in ids])
    return ids, np.concatenate(vs)  # 16 bits as long as all blocks have 16


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if bound < 2**24:
        return (q.astype(np.float32) @ c.astype(np.float32).T).astype(np.int64)
    if bound < 2**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    exact = q.astype(object) @ c.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _best(scores: np.ndarray, out: np.ndarray, k: int) -> list[np.ndarray]:
    """Columns of the k best of each row, ties to the lesser column; columns where ``out`` are none."""
    n = scores.shape[1]
    top = int(np.abs(scores).max(initial=0))
    if top < 2**62 // max(1, n):
        # score and column in one number, so that one selection per row settles ties too
        key = scores * n + (n - 1 - np.arange(n))
        key[out] = -(2**63) + 1
        m = min(k, n)
        part = np.argpartition(key, n - m, axis=1)[:, n - m :] if m < n else np.broadcast_to(np.arange(n), key.shape)
        got = np.take_along_axis(key, part, 1)
        part = np.take_along_axis(part, np.argsort(-got, axis=1, kind="stable"), 1)
        used = (~np.take_along_axis(out, part, 1)).sum(1)
        return [p[:u] for p, u in zip(part, used)]
    cols = [np.flatnonzero(~o) for o in out]
    return [c[np.lexsort((c, -row[c].astype(object)))][:k] if len(c) else c for row, c in zip(scores, cols)]


def _tile(k: int):
    def run(key, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        found: dict = {"query_id": [], "part": [], "scores": [], "ids": []}
        if len(q) and len(c):
            dim = int(key[2])
            qi, qv = _unpack(q["ids"], q["vectors"], dim)
            ci, cv = _unpack(c["c_ids"], c["c_vectors"], dim)
            order = np.argsort(ci, kind="stable")
            ci, cv = ci[order], cv[order].astype(np.int64)
            step = max(1, STEP_CELLS // len(ci))
            for a in range(0, len(qi), step):
                scores = _scores(qv[a : a + step].astype(np.int64), cv)
                out = qi[a : a + step, None] == ci[None]
                for row, me, use in zip(scores, qi[a : a + step], _best(scores, out, k)):
                    found["query_id"].append(int(me))
                    found["part"].append(int(key[1]))
                    found["scores"].append(row[use])
                    found["ids"].append(ci[use])
        return pd.DataFrame(found)

    return run


def top_k(spark: SparkSession, vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score; queries are rows whose id is divisible by ``every``."""
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    n, dim = v.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = 2 * max(1, dim or 0)
    groups_c, groups_q = max(1, math.ceil(n * width / GROUP_BYTES)), max(1, math.ceil(n / every * width / QUERY_BYTES))
    # dealt by row, so that no id gathers in a group
    hashed = v.withColumn("h", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(2**31)))
    blocks = cut(spark, hashed.mapInPandas(_pack(groups_c, groups_q, every), BLOCK), "topk-blocks")
    q = blocks.where("side = 1").withColumn("qg", F.col("grp")).withColumn("cg", F.explode(F.sequence(F.lit(0), F.lit(groups_c - 1))))
    c = blocks.where("side = 0").withColumn("cg", F.col("grp")).withColumn("qg", F.explode(F.sequence(F.lit(0), F.lit(groups_q - 1))))
    cols = ("qg", "cg", "dim", "ids", "vectors")
    c = c.select(*[F.col(x).alias(f"c_{x}") for x in cols])  # names of its own: both sides come from one table
    lists = (
        q.select(*cols).groupBy("qg", "cg", "dim").cogroup(c.groupBy("c_qg", "c_cg", "c_dim"))
        .applyInPandas(_tile(k), "query_id bigint, part int, scores array<bigint>, ids array<bigint>")
    )
    pairs = F.transform(F.arrays_zip("scores", "ids"), lambda x: F.struct((-x["scores"]).alias("s"), x["ids"].alias("id")))
    merged = lists.select("query_id", "part", pairs.alias("best"))
    width = groups_c
    while True:  # a tree: FAN lists at a time
        best = F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k)
        merged = merged.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("query_id", "part").agg(best.alias("best"))
        width = math.ceil(width / FAN)
        if width <= 1:
            break
    return merged.select("query_id", F.posexplode("best").alias("pos", "b")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.id").alias("vec_id"), (-F.col("b.s")).alias("score")
    )


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark, table(spark, sf_dir, "embeddings"))


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
