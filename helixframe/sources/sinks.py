"""Sinks: bounded files, staged replacement, CSV-safe nested values, JSON documents."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import global_rank
from ..operators.vectors import usable
from .shared import cut


def write_shards(df: DataFrame, path: str, rows: int, mode: str = "errorifexists") -> None:
    """Parquet files of ``rows`` rows at most, zstd; ``append`` continues a folder."""
    df.write.mode(mode).option("maxRecordsPerFile", rows).option("compression", "zstd").parquet(path)


def write_exact_shards(spark: SparkSession, df: DataFrame, path: str, rows: int, *order: str) -> int:
    """Folders ``shard=00000`` and so on of exactly ``rows`` rows in the order (the last may hold fewer). Numbers
    continue those already there. Returns the number of new shards."""
    first = 0
    fs, at = _file_system(spark, path)
    if fs.exists(at):
        names = [f.getPath().getName() for f in fs.listStatus(at)]
        first = 1 + max((int(n[6:]) for n in names if n.startswith("shard=") and n[6:].isdigit()), default=-1)
    ranked = global_rank(spark, df, *[F.col(c) for c in order], name="_rn")
    shard = (first + F.floor((F.col("_rn") - 1) / rows)).cast("int")
    sharded = cut(spark, ranked.withColumn("_number", shard), "shards")
    made = sharded.agg(F.count_distinct("_number")).first()[0]
    out = sharded.withColumn("shard", F.lpad(F.col("_number").cast("string"), 5, "0")).drop("_rn", "_number")
    out.repartition("shard").write.mode("append").option("compression", "zstd").partitionBy("shard").parquet(path)
    return made


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def _swap(spark: SparkSession, stage: str, path: str) -> None:
    """The staged folder takes the target's place; the old one goes last, and comes back if the move fails."""
    fs, target = _file_system(spark, path)
    _, new = _file_system(spark, stage)
    _, old = _file_system(spark, f"{path}.before-{uuid.uuid4().hex}")
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"could not move {path} aside")
    fs.mkdirs(target.getParent())
    moved = fs.exists(new) and fs.rename(new, target)
    if not moved:
        if had:
            fs.rename(old, target)
        raise OSError(f"could not move {stage} to {path}")
    if had:
        fs.delete(old, True)


def replace_atomically(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Write beside the target, then rename. A failed write or rename leaves the old folder as it was."""
    stage = f"{path}.partial-{uuid.uuid4().hex}"
    try:
        df.write.parquet(stage)
        _swap(spark, stage, path)
    except Exception:
        fs, at = _file_system(spark, stage)
        fs.delete(at, True)
        raise


def csv_safe(df: DataFrame) -> DataFrame:
    """Nested columns as compact JSON."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema])


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    out = csv_safe(df)
    (out.coalesce(1) if single else out).write.mode("overwrite").option("header", "true").csv(path)


def split_outputs(df: DataFrame, status: str, good: str, paths: tuple[str, str]) -> None:
    """Two outputs from one computed frame: rows of status ``good``, and the quarantined rest."""
    kept = df.persist()
    try:
        kept.where(F.col(status) == good).drop(status).write.parquet(paths[0])
        kept.where(~F.col(status).eqNullSafe(F.lit(good))).drop(status).write.parquet(paths[1])
    finally:
        kept.unpersist()


def reconcile(read: int, *parts: int) -> None:
    if read != sum(parts):
        raise ValueError(f"{read} rows read, {' + '.join(map(str, parts))} written")


def write_json(document: dict, path: str) -> None:
    with open(path, "w") as f:
        json.dump(document, f, indent=2, sort_keys=True, default=str)


def append_input(spark: SparkSession, df: DataFrame, path: str, name: str, rows: int) -> None:
    """The shards of one input, in a folder of its own below ``path``: other inputs' shards stay, a repeated run replaces
    its own, a failed one leaves what was there."""
    stage = f"{path}/.partial-{uuid.uuid4().hex}"
    try:
        write_shards(df, stage, rows)
        _swap(spark, stage, f"{path}/input={name}")
    except Exception:
        fs, at = _file_system(spark, stage)
        fs.delete(at, True)
        raise


def with_retry(run: Callable, attempts: int = 5, wait: float = 0.5, errors: tuple = (OSError,)):
    """What ``run`` returns; failures of the given kinds are tried again after twice the wait each time."""
    for k in range(attempts):
        try:
            return run()
        except errors:
            if k == attempts - 1:
                raise
            time.sleep(wait * 2**k)


class VectorTable:
    """Vectors of one length in a folder: create, recreate, append, count."""

    def __init__(self, spark: SparkSession, path: str, dim: int):
        self.spark, self.path, self.dim = spark, path, dim

    def recreate(self, df: DataFrame) -> int:
        with_retry(lambda: replace_atomically(self.spark, usable(df, "vector", self.dim), self.path))
        return self.rows()

    def append(self, df: DataFrame) -> int:
        """Adds the rows that are fit for the table; returns how many."""
        before = self.rows()
        usable(df, "vector", self.dim).write.mode("append").parquet(self.path)
        return self.rows() - before

    def rows(self) -> int:
        return self.spark.read.parquet(self.path).count() if exists(self.spark, self.path) else 0


def stream_arrow(df: DataFrame, rows: int = 65_536) -> Iterator[pa.RecordBatch]:
    """The result as Arrow batches, a partition at a time."""
    schema, part = df.limit(0).toArrow().schema, []
    for row in df.toLocalIterator(prefetchPartitions=True):
        part.append(row.asDict(recursive=True))
        if len(part) == rows:
            yield pa.RecordBatch.from_pylist(part, schema)
            part = []
    if part:
        yield pa.RecordBatch.from_pylist(part, schema)


def yaml_manifest(nodes: dict[str, tuple[str, ...]]) -> str:
    """Tables with what each is made from, as YAML."""
    lines = []
    for name, upstream in nodes.items():
        lines += [f"{json.dumps(name)}:", *(["  upstream:", *[f"    - {json.dumps(u)}" for u in upstream]] if upstream else ["  upstream: []"])]
    return "\n".join(lines) + "\n"


def portable_uri(location: str, root: str) -> str:
    """A file location relative to ``root``; others as they are."""
    at = location.find(f"/{root}/")
    return location[at + 1 :] if location.startswith("file:") and at >= 0 else location
