"""Statistical operators against plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.functions import stats as St
from helixframe.operators import cluster as K
from helixframe.operators import inference as I


@pytest.mark.parametrize("interpolated", [True, False])
def test_quantiles_per_group(spark, interpolated):
    rng = np.random.default_rng(0)
    rows = [(g, float(x)) for g, n in (("a", 1), ("b", 2), (None, 57), ("d", 400)) for x in rng.integers(0, 60, n)] + [("d", None), ("e", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    ps = {"lo": 0.05, "mid": 0.5, "hi": 0.95, "end": 1.0}
    got = {r.g: tuple(r)[1:] for r in St.quantiles(spark, df, "x", ps, ("g",), interpolated).collect()}
    for g in ("a", "b", None, "d"):
        v = np.sort([x for h, x in rows if h == g and x is not None])
        want = [np.quantile(v, p) if interpolated else v[min(int(p * len(v)), len(v) - 1)] for p in ps.values()]
        assert np.allclose(got[g], want)
    assert len(got) == 4


def test_running_sums_and_ranks(spark):
    rng = np.random.default_rng(1)
    rows = sorted({(int(g), int(x)) for g, x in zip(rng.integers(0, 3, 500), rng.integers(0, 900, 500))})
    df = spark.createDataFrame([(g, x, 1) for g, x in rows], "g int, x int, one int")
    got = {(r.g, r.x): r.upto_one for r in St.running_sum(spark, df, "x", "one", by=("g",)).collect()}
    seen = {}
    for g, x in rows:
        seen[g] = seen.get(g, 0) + 1
        assert got[g, x] == seen[g]


def _brute_clusters(points, radius, least):
    near = {i: [j for j, x2, y2 in points if (x - x2) ** 2 + (y - y2) ** 2 <= radius * radius] for i, x, y in points}
    core = {i for i in near if len(near[i]) >= least}
    root = {}
    for i in sorted(core):
        if i in root:
            continue
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in root:
                root[j] = i
                todo += [k for k in near[j] if k in core]
    at = {i: (x, y) for i, x, y in points}
    for i in at:
        reach = [(math.dist(at[i], at[j]), root[j]) for j in near[i] if j in core]
        if i not in core:
            root[i] = min(reach)[1] if reach else None
    return core, root


@pytest.mark.parametrize("radius,least", [(0.5, 4), (1.0, 6)])
def test_density_clusters(spark, radius, least):
    rng = np.random.default_rng(2)
    blobs = [rng.normal(c, s, (n, 2)) for c, s, n in (((0, 0), 0.4, 80), ((3, 3), 0.3, 60), ((-4, 2), 1.5, 40), ((0, 6), 0.01, 50))]
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(np.concatenate([*blobs, rng.uniform(-8, 8, (40, 2))]))]
    core, root = _brute_clusters(points, radius, least)
    got = K.density_clusters(spark, spark.createDataFrame(points, "id int, x double, y double"), radius, least).collect()
    assert {r.id for r in got if r.core} == core and len(got) == len(points)
    name = {}  # a cluster is named by some of its points, here by the least
    for r in got:
        if r.core:
            name[r.cluster] = min(name.get(r.cluster, r.id), r.id)
    assert {r.id: name.get(r.cluster) for r in got} == root


def test_stability_of_clusters(spark):
    a = spark.createDataFrame([(i, 0 if i < 6 else 6) for i in range(10)] + [(10, None)], "id int, cluster int")
    b = spark.createDataFrame([(i, 0 if i < 5 else 5) for i in range(9)], "id int, cluster int")
    got = {r.cluster: (r.size, r.best, round(r.jaccard, 6)) for r in K.stability(a, b).collect()}
    assert got == {0: (6, 0, round(5 / 6, 6)), 6: (4, 5, round(3 / 5, 6))}


def test_graph_permutation_keeps_labels_per_stratum(spark):
    labels = spark.createDataFrame([(i, f"l{i % 4}", i % 2) for i in range(80)], "id bigint, label string, stratum bigint")
    same = spark.createDataFrame([(i, i + 4) for i in range(76)], "u bigint, v bigint")
    r = I.graph_permutation(spark, same, labels, 60).first()
    assert r.observed == 1.0 and r.replicates == 60 and r.p == pytest.approx(1 / 61) and 0.3 < r.expected < 0.7
    mixed = spark.createDataFrame([(i, (i * 7 + 3) % 80) for i in range(80)], "u bigint, v bigint")
    assert I.graph_permutation(spark, mixed, labels, 60).first().p > 0.05


def test_cluster_bootstrap_is_wider_than_of_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(c, float(m + e)) for c, m in enumerate(rng.normal(0, 5, 40)) for e in rng.normal(0, 1, 30)]
    df = spark.createDataFrame(rows, "cluster int, x double")
    one = I.cluster_bootstrap(df, 200).first()
    two = I.bootstrap(df.withColumn("id", F.monotonically_increasing_id()), 200).first()
    mean = np.mean([x for _, x in rows])
    assert one.low < mean < one.high and one.high - one.low > 2 * (two.high - two.low)


def test_correlations_of_short_and_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 4.0, 5.0), (4.0, 1.0, 5.0)], "a double, b double, c double")
    got = {(r.x, r.y): (r.pearson, r.rho, r.n) for r in I.correlations(spark, df, ("a", "b", "c")).collect()}
    assert got["a", "c"][:2] == (None, None) and got["a", "b"][2] == 3
    assert got["a", "b"][0] == pytest.approx(np.corrcoef([1, 3, 4], [2, 4, 1])[0, 1], abs=1e-6)
