"""Registry of pipeline tables, provenance, run configuration."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..contracts import TIERS
from .sinks import exists


@dataclass(frozen=True)
class Node:
    name: str
    upstream: tuple[str, ...] = ()
    streaming: bool = False


#: The tables of the pipeline and what each is made from.
NODES = {
    n.name: n
    for n in (
        Node("pretraining_corpus", (), True), Node("cpu_enriched", ("pretraining_corpus",)), Node("sampled_cpu", ("cpu_enriched",)),
        Node("tokenized", ("sampled_cpu",)), Node("likelihood_stats", ("tokenized",)), Node("embeddings", ("tokenized",)),
    )
}


class Catalog:
    """Tables of one database, by node name; the streaming node is no table and is left out."""

    def __init__(self, spark: SparkSession, paths: dict[str, str]):
        unknown = set(paths) - set(NODES)
        if unknown:
            raise KeyError(f"unknown nodes {sorted(unknown)}")
        self.spark, self.paths = spark, paths

    def tables(self) -> list[str]:
        return [n for n, node in NODES.items() if not node.streaming and n in self.paths]

    def exists(self, node: str) -> bool:
        return node in self.paths and exists(self.spark, self.paths[node])

    def sync(self) -> list[str]:
        """Attach the tables that exist now, drop the views of those that are gone; the attached ones."""
        there = [n for n in self.tables() if self.exists(n)]
        for n in self.tables():
            if n in there:
                self.load(n).createOrReplaceTempView(n)
            else:
                self.spark.catalog.dropTempView(n)
        return there

    def load(self, node: str) -> DataFrame:
        if NODES[node].streaming:
            raise ValueError(f"{node} is a stream, not a table")
        return self.spark.read.parquet(self.paths[node])

    def attach(self) -> None:
        for n in self.tables():
            self.load(n).createOrReplaceTempView(n)

    def sql(self, statement: str) -> DataFrame:
        self.attach()
        return self.spark.sql(statement)

    def describe(self, node: str) -> dict:
        df = self.load(node)
        return {"name": node, "upstream": NODES[node].upstream, "columns": {f.name: f.dataType.simpleString() for f in df.schema}, "files": len(df.inputFiles())}

    def describe_all(self) -> list[dict]:
        return [self.describe(n) for n in self.tables()]


def lineage_of(node: str) -> list[str]:
    """A node's ancestors, nearest first."""
    out: list[str] = []
    todo = list(NODES[node].upstream)
    while todo:
        n = todo.pop(0)
        if n not in out:
            out.append(n)
            todo += NODES[n].upstream
    return out


def provenance(executions: list[dict] | None = None, operations: dict[str, str] | None = None, analyses: dict[str, list[str]] | None = None) -> str:
    """Nodes with all their ancestors, the operation that makes each, analyses with the nodes they read, executions."""
    for name, reads in (analyses or {}).items():
        if gone := set(reads) - set(NODES):
            raise KeyError(f"analysis {name} reads unknown nodes {sorted(gone)}")
    nodes = [asdict(n) | {"ancestors": lineage_of(n.name), "operation": (operations or {}).get(n.name)} for n in NODES.values()]
    return json.dumps({"nodes": nodes, "analyses": analyses or {}, "executions": executions or []}, indent=2, default=str)


@dataclass(frozen=True)
class RunConfig:
    tier: str = "dev"
    batch_rows: int = 5_000
    shard_rows: int = 50_000
    seed: int = 42
    fraction: float = 0.1
    paths: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.tier not in TIERS:
            raise ValueError(f"unknown tier {self.tier!r}")
        if not 0 < self.fraction <= 1 or self.batch_rows < 1 or self.shard_rows < 1:
            raise ValueError("fraction must be within (0, 1], row counts positive")


def load_config(text: str) -> dict:
    """A JSON mapping that isn't empty."""
    got = json.loads(text)
    if not isinstance(got, dict) or not got:
        raise ValueError("the configuration must be a mapping that isn't empty")
    return got
