"""Readers, sinks and catalog on small folders."""

import json
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from helixframe import contracts as C
from helixframe.operators import duplicates
from helixframe.operators import groups as G
from helixframe.sources import catalog, readers, shared, sinks


def test_replacement_survives_failures(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    sinks.replace_atomically(spark, spark.range(3), path)
    sinks.replace_atomically(spark, spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    bad = spark.range(4).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception):
        sinks.replace_atomically(spark, bad, path)
    assert spark.read.parquet(path).count() == 5 and os.listdir(tmp_path) == ["t"]
    # the rename of the new folder fails: the old one comes back
    with pytest.raises(OSError):
        sinks._swap(spark, f"{tmp_path}/none", path)
    assert spark.read.parquet(path).count() == 5 and os.listdir(tmp_path) == ["t"]


def test_failed_repeat_of_an_input_keeps_its_shards(spark, tmp_path):
    path = f"{tmp_path}/shards"
    sinks.append_input(spark, spark.range(6), path, "a", 4)
    sinks.append_input(spark, spark.range(2), path, "b", 4)
    with pytest.raises(Exception):
        sinks.append_input(spark, spark.range(4).select(F.raise_error(F.lit("no")).alias("id")), path, "a", 4)
    assert spark.read.parquet(f"{path}/input=a").count() == 6 and spark.read.parquet(path).count() == 8


def test_exact_shards_continue(spark, tmp_path):
    path = f"{tmp_path}/exact"
    assert sinks.write_exact_shards(spark, spark.range(25), path, 10, "id") == 3
    assert sinks.write_exact_shards(spark, spark.range(100, 107), path, 10, "id") == 1
    got = {r.shard: (r.n, r.lo) for r in spark.read.parquet(path).groupBy("shard").agg(F.count("*").alias("n"), F.min("id").alias("lo")).collect()}
    assert got == {0: (10, 0), 1: (10, 10), 2: (5, 20), 3: (7, 100)}


def test_vector_table_and_retry(spark, tmp_path):
    t = sinks.VectorTable(spark, f"{tmp_path}/v", 2)
    rows = lambda *v: spark.createDataFrame([(i, x) for i, x in enumerate(v)], "id bigint, vector array<float>")
    assert t.rows() == 0 and t.recreate(rows([1.0, 2.0], [1.0], None)) == 1
    assert t.append(rows([3.0, 1.0], [0.5, 1.0], [1.0, 2.0, 3.0])) == 2 and t.rows() == 3
    tries = []

    def flaky():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("busy")
        return "done"

    assert sinks.with_retry(flaky, wait=0.001) == "done" and len(tries) == 3
    with pytest.raises(OSError):
        sinks.with_retry(lambda: (_ for _ in ()).throw(OSError("x")), attempts=2, wait=0.001)


def test_arrow_stream(spark):
    df = spark.range(10).select("id", F.array(F.col("id")).alias("a"), F.struct(F.col("id").alias("x")).alias("s"))
    batches = list(sinks.stream_arrow(df, 4))
    assert sum(b.num_rows for b in batches) == 10 and max(b.num_rows for b in batches) <= 4
    assert sorted(r["s"]["x"] for b in batches for r in b.to_pylist()) == list(range(10))


def test_key_search_and_globs(spark, tmp_path):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    seen = Observation()
    assert readers.find_key(df, {"id": 7, "v": 14}, seen).first().v == 14 and seen.get["rows"] >= 1
    with pytest.raises(LookupError):
        readers.find_key(df, {"id": 7, "v": 15})
    spark.range(3).write.parquet(f"{tmp_path}/p")
    assert len(readers.list_glob(spark, f"file://{tmp_path}/p/*.parquet")) >= 1
    with pytest.raises(FileNotFoundError):
        readers.list_glob(spark, f"file://{tmp_path}/q/*.parquet")
    with pytest.raises(ValueError):
        readers.list_glob(spark, "ftp://x/*.csv")


def test_registered_sql_with_marks_in_literals(spark):
    r = readers.Registry(spark)
    r.register("some_rows", spark.range(5).withColumn("t", F.lit("why?")))
    assert r.query("SELECT count(*) AS n FROM some_rows WHERE t = 'why?' AND id > ?", [2]).first().n == 2
    assert r.registered() == ["some_rows"] and r.source("some_rows").count() == 5
    with pytest.raises(ValueError):
        r.register("no name", spark.range(1))
    with pytest.raises(KeyError):
        r.source("other")


@pytest.mark.parametrize("text", ["plain", "it's", "a`b", 'say "x"', "back\\slash", "é🙂"])
def test_quoting(spark, text):
    row = spark.sql(f"SELECT {readers.quote_string(text)} AS {readers.quote_identifier(text)}").first()
    assert row[0] == text and row.__fields__ == [text]


def test_tiers_folders_and_strata(spark, tmp_path):
    df = spark.range(2000).withColumn("g", F.col("id") % 3).withColumn("token_length", F.lit(2))
    df.repartition(4).write.parquet(f"{tmp_path}/d")
    assert readers.tier(spark, f"{tmp_path}/d", "dev").count() == 1000
    with pytest.raises(ValueError):
        readers.tier(spark, f"{tmp_path}/d", "none")
    assert readers.folder(spark, f"{tmp_path}/d", columns=["id"]).columns == ["id"]
    with pytest.raises(Exception):
        readers.folder(spark, f"{tmp_path}/d", "*.orc")
    with pytest.raises(ValueError):
        readers.folder(spark, f"{tmp_path}/d", columns=["id", "gone"])
    assert {k: v.count() for k, v in readers.strata(df, "g", [0, 1], ["id"]).items()} == {0: 667, 1: 667}
    assert sum(r.tokens for r in readers.shard_tokens(readers.folder(spark, f"{tmp_path}/d")).collect()) == 4000
    df.select("id", F.lit(" x ").alias("t")).limit(3).write.option("header", True).csv(f"{tmp_path}/c")
    assert readers.csv(spark, f"{tmp_path}/c", columns=["id"]).columns == ["id"]


def test_catalog_sync_describe_and_provenance(spark, tmp_path):
    c = catalog.Catalog(spark, {"tokenized": f"{tmp_path}/tok", "embeddings": f"{tmp_path}/emb"})
    assert c.sync() == [] and not c.exists("tokenized") and not c.exists("sampled_cpu")
    spark.range(4).write.parquet(f"{tmp_path}/tok")
    assert c.sync() == ["tokenized"] and spark.sql("SELECT count(*) AS n FROM tokenized").first().n == 4
    assert c.describe("tokenized")["columns"] == {"id": "bigint"}
    doc = json.loads(catalog.provenance([{"run": 1}], {"tokenized": "run_tokenize"}, {"report": ["embeddings"]}))
    by = {n["name"]: n for n in doc["nodes"]}
    assert by["tokenized"]["operation"] == "run_tokenize" and by["embeddings"]["ancestors"][0] == "tokenized" and doc["analyses"] == {"report": ["embeddings"]}
    with pytest.raises(KeyError):
        catalog.provenance(analyses={"x": ["gone"]})


def test_preflight_writes_a_status(spark, tmp_path):
    ok = C.preflight({"a": spark.range(1)}, {"a": ("id",)}, f"{tmp_path}/s.json")
    assert ok and json.load(open(f"{tmp_path}/s.json"))["status"] == "ready"
    assert not C.preflight({"a": spark.range(1)}, {"a": ("id", "x")}, f"{tmp_path}/s.json")
    assert json.load(open(f"{tmp_path}/s.json")) == {"status": "halted", "missing": {"a": ["x"]}}


def test_intermediate_tables_go(spark):
    assert shared.cut(spark, spark.range(5), "x").count() == 5
    root = shared.shared_root(spark).removeprefix("file:").replace("//", "/")
    assert any(n.startswith("x-") for n in os.listdir(root))
    shared.release(spark)
    assert not os.path.exists(root) and shared.cut(spark, spark.range(3), "y").count() == 3


def test_keep_first_of_any_columns(spark):
    df = spark.createDataFrame([(1, 3, {"a": 1}), (1, 2, {"b": 2}), (2, 5, None)], "k int, o int, m map<string,int>")
    assert sorted((r.k, r.o) for r in duplicates.keep_first(df, ("k",), "o").collect()) == [(1, 2), (2, 5)]


def test_one_to_one_join_raises_for_copies(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(ValueError):
        G.join_one_to_one(a, b, ("k",))
