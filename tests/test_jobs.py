"""The jobs end to end, the model stage's quarantine, and sinks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe import jobs
from helixframe.operators import model, vectors
from helixframe.sources import sinks

RAW = "record_id string, sequence string, taxonomy string, strand string, start bigint, end bigint, begin_of_sequence string, end_of_sequence string, gene_type string"


def raw(spark):
    rows = [(f"r{i}", "ACGTAC" * (i + 1), "Eukaryota; A", "<+>", i, i + 9, "<s>", "</s>", "<cds>") for i in range(40)]
    rows += [("n", None, None, None, None, None, None, None, None), ("x", "ACGNNN", "", "<->", 3, 1, "<s>", "</s>", None)]
    return spark.createDataFrame(rows, RAW)


def test_all_jobs(spark, tmp_path):
    raw(spark).write.parquet(f"{tmp_path}/raw")
    n = jobs.run_all(spark, f"{tmp_path}/raw", str(tmp_path))
    assert n["cpu_enriched"] == n["sampled_cpu"] == 42 and n["embeddings"] == n["tokenized"] <= 40 and n["quarantine"] == 0
    assert spark.read.parquet(f"{tmp_path}/likelihood_stats").count() == n["embeddings"]


def test_inference_within_a_budget_resumes(spark, tmp_path):
    raw(spark).write.parquet(f"{tmp_path}/raw")
    jobs.run_cpu(spark, f"{tmp_path}/raw", f"{tmp_path}/cpu")
    jobs.run_tokenize(spark, f"{tmp_path}/cpu", f"{tmp_path}/once")
    spark.read.parquet(f"{tmp_path}/once").repartition(5, "record_id").write.parquet(f"{tmp_path}/tok")
    tokens = spark.read.parquet(f"{tmp_path}/tok")
    files, root = sorted(tokens.inputFiles()), f"{tmp_path}/out"
    # a first run broke off: one output is there, the list of files is not
    sinks.append_input(spark, tokens.select("record_id", "start", "end"), f"{root}/embeddings", files[0].rpartition("/")[2].partition(".")[0], 100)
    done = 0
    for _ in files:  # a budget below any file: one file a run
        n, held = jobs.run_inference_within(spark, f"{tmp_path}/tok", root, 1)
        done += n
        assert n > 0 and held == 0
    assert jobs.run_inference_within(spark, f"{tmp_path}/tok", root, 1) == (0, 0)
    key = lambda df: sorted(r.record_id for r in df.select("record_id").collect())
    for name in ("embeddings", "likelihood_stats"):
        assert key(spark.read.parquet(f"{root}/{name}")) == key(tokens)
    assert done == tokens.count() and spark.read.parquet(f"{root}/done").count() == len(files)
    whole = f"{tmp_path}/whole"
    assert jobs.run_inference_within(spark, f"{tmp_path}/tok", whole, 10**9, model.Lazy(lambda revision: model.StandIn(), "0" * 40, 4, (16,))) == (done, 0)


def test_lazy_scorer_is_pinned_and_made_once(monkeypatch):
    monkeypatch.setattr(model, "_made", {})
    made = []

    def make(revision):
        made.append(revision)
        return model.StandIn()

    ids = np.arange(6)[None]
    lazy = model.Lazy(make, "0123abc", 4, (8,))
    assert not made and np.array_equal(lazy(ids, ids)[0], model.StandIn()(ids, ids)[0])
    lazy(ids, ids)
    assert made == ["0123abc"]
    with pytest.raises(ValueError):
        model.Lazy(make, "main", 4)


class Narrow(model.StandIn):
    """Has memory for one short row at a time."""

    def __call__(self, ids, mask):
        if len(ids) > 1 or (mask != -2).sum() > 20:
            raise MemoryError
        return super().__call__(ids, mask)


def test_scoring_halves_and_quarantines():
    ids = np.arange(8)[None] + np.arange(3)[:, None]
    mask = np.where(np.arange(8) > 5, -2, 6)[None].repeat(3, 0)
    assert model._score(Narrow(), ids, mask) == model._score(model.StandIn(), ids, mask)
    wide = np.full((1, 30), 6)
    assert model._score(Narrow(), wide, wide)[0][0] == "memory"
    empty = model._score(model.StandIn(), ids[:1], np.zeros((1, 8), int))[0]
    assert empty[6:9] == (1, 0.0, -1)


def test_append_input_and_rollback(spark, tmp_path):
    out = f"{tmp_path}/shards"
    sinks.append_input(spark, spark.range(10), out, "a", 4)
    sinks.append_input(spark, spark.range(5), out, "b", 4)
    with pytest.raises(Exception):
        sinks.append_input(spark, spark.range(5).select(F.raise_error(F.lit("broken")).alias("id")), out, "c", 4)
    sinks.append_input(spark, spark.range(10), out, "a", 4)
    assert spark.read.parquet(out).groupBy("input").count().orderBy("input").collect() == [("a", 10), ("b", 5)]


def test_small_things(spark):
    assert sinks.portable_uri("file:///x/catalog/a/b", "catalog") == "catalog/a/b" and sinks.portable_uri("s3://x/catalog/a", "catalog") == "s3://x/catalog/a"
    assert sinks.yaml_manifest({"a": (), "b": ("a",)}) == '"a":\n  upstream: []\n"b":\n  upstream:\n    - "a"\n'
    v = spark.createDataFrame([([1.0, 2.0],), ([3.0],)], "v array<double>")
    with pytest.raises(ValueError):
        vectors.assert_rectangular(v, "v")
    with pytest.raises(ValueError):
        vectors.search(spark, v, v, metric="hamming")
