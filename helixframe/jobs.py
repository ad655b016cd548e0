"""The named jobs of the pipeline: each reads one table of the catalog and writes the next."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .contracts import EMBEDDING, LIKELIHOOD, REQUIRED, TOKENIZED, assert_columns
from .operators.enrich import enrich, normalize
from .operators.model import Scorer, StandIn, infer
from .operators.sampling import include
from .operators.tokenize import tokenize, within_budget
from .sources.readers import shard_tokens
from .sources.shared import cut
from .sources.sinks import append_input, exists, reconcile, write_shards


def _write(df: DataFrame, path: str, rows: int) -> int:
    seen = Observation()
    write_shards(df.observe(seen, F.count(F.lit(1)).alias("n")), path, rows)
    return seen.get["n"]


def run_cpu(spark: SparkSession, source: str, out: str, rows: int = 50_000) -> int:
    """Raw intervals to enriched ones; as many rows out as in."""
    raw, read = spark.read.parquet(source), Observation()
    assert_columns(raw, REQUIRED)
    written = _write(enrich(normalize(raw.observe(read, F.count(F.lit(1)).alias("n")))), out, rows)
    reconcile(read.get["n"], written)
    return written


def run_sample(spark: SparkSession, source: str, out: str, fraction: float, seed: int = 42, rows: int = 10_000) -> int:
    return _write(include(spark.read.parquet(source), "record_id", fraction, seed), out, rows)


def run_tokenize(spark: SparkSession, source: str, out: str, rows: int = 10_000) -> int:
    return _write(tokenize(spark.read.parquet(source)).select(*TOKENIZED), out, rows)


def _infer(spark: SparkSession, tokens: DataFrame, scorer: Scorer | None, write: Callable[[DataFrame, str], int]) -> tuple[int, int]:
    """Scores once and writes three outputs of it by ``write`` (frame, table name; returns rows written)."""
    scored = cut(spark, infer(tokens, scorer or StandIn()), "inference")
    good = scored.where("status = 'ok'")
    done = write(good.select(*EMBEDDING), "embeddings")
    reconcile(done, write(good.select(*LIKELIHOOD), "likelihood_stats"))
    held = write(scored.where("status <> 'ok'").select(*EMBEDDING[:3], "token_length", "status"), "quarantine")
    reconcile(tokens.count(), done, held)
    return done, held


def run_inference(spark: SparkSession, source: str, embeddings: str, likelihoods: str, quarantine: str, scorer: Scorer | None = None, rows: int = 10_000) -> tuple[int, int]:
    """Two outputs from one pass, and the quarantined rows; all rows are accounted for."""
    paths = {"embeddings": embeddings, "likelihood_stats": likelihoods, "quarantine": quarantine}
    return _infer(spark, spark.read.parquet(source), scorer, lambda df, name: _write(df, paths[name], rows))


def run_inference_within(spark: SparkSession, source: str, root: str, budget: int, scorer: Scorer | None = None, rows: int = 10_000) -> tuple[int, int]:
    """Inference over the files of ``source`` that no run before has done, in order of their names, while their
    tokens stay within ``budget``; the first of them always runs. Returns rows done and held, (0, 0) at the end.

    The chosen files are one job. Its outputs are folders named after the first file, below the tables in ``root``;
    ``root``/done lists the files once all outputs are there. A run that broke off before that is repeated from the
    same first file, and replaces what it left, whatever the budget is then.
    """
    files = shard_tokens(spark.read.parquet(source))
    if exists(spark, f"{root}/done"):
        files = files.join(spark.read.parquet(f"{root}/done").select("file"), "file", "left_anti")
    chosen = cut(spark, within_budget(files, "file", "tokens", budget).where("within_budget").select("file", "tokens"), "budget")
    paths = sorted(unquote(r.file) for r in chosen.select("file").collect())  # names of one run's files, which Spark gives as URLs
    if not paths:
        return 0, 0
    first = paths[0].rpartition("/")[2].partition(".")[0]

    def write(df: DataFrame, name: str) -> int:
        seen = Observation()
        append_input(spark, df.observe(seen, F.count(F.lit(1)).alias("n")), f"{root}/{name}", first, rows)
        return seen.get["n"]

    got = _infer(spark, spark.read.parquet(*paths), scorer, write)
    append_input(spark, chosen, f"{root}/done", first, rows)
    return got


def run_all(spark: SparkSession, source: str, root: str, fraction: float = 1.0, scorer: Scorer | None = None) -> dict[str, int]:
    """All jobs one after the other, in folders named after the tables; rows per table."""
    at = lambda name: f"{root}/{name}"
    n = {"cpu_enriched": run_cpu(spark, source, at("cpu_enriched")), "sampled_cpu": run_sample(spark, at("cpu_enriched"), at("sampled_cpu"), fraction)}
    n["tokenized"] = run_tokenize(spark, at("sampled_cpu"), at("tokenized"))
    n["embeddings"], n["quarantine"] = run_inference(spark, at("tokenized"), at("embeddings"), at("likelihood_stats"), at("quarantine"), scorer)
    return n
