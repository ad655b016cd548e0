"""Scans: bounded, pruned, checked, registered by name."""

from __future__ import annotations

import re
from urllib.parse import urlparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..contracts import KEY, TIERS, assert_columns

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
TOKENIZE_COLUMNS = (*KEY, "sequence", "qc_flag")


def tier(spark: SparkSession, path: str, name: str, schema=None) -> DataFrame:
    """The first rows of a split, as many as the tier has."""
    if name not in TIERS:
        raise ValueError(f"unknown tier {name!r}; one of {sorted(TIERS)}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).limit(TIERS[name])


def folder(spark: SparkSession, path: str, pattern: str = "*.parquet", columns=None) -> DataFrame:
    """Parquet files of a folder, each read once; columns are pruned at the scan. Raises where no file matches."""
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).parquet(path)
    if not df.inputFiles():
        raise FileNotFoundError(f"no file {pattern} under {path}")
    if columns:
        assert_columns(df, columns)
        return df.select(*columns)
    return df


def shards(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.parquet(*sorted(paths))


def shard_tokens(df: DataFrame) -> DataFrame:
    """Sum of token_length per file; no other column is read."""
    return df.groupBy(F.input_file_name().alias("file")).agg(F.sum("token_length").alias("tokens"))


def check_url_glob(url: str, suffix: str = ".parquet") -> str:
    """An https or file URL whose last part is a Parquet pattern; returns that part."""
    u = urlparse(url)
    last = u.path.rpartition("/")[2]
    if u.scheme not in ("https", "hf", "file", "s3", "s3a", "hdfs") or not last.endswith(suffix):
        raise ValueError(f"not a {suffix} pattern: {url}")
    return last


def list_glob(spark: SparkSession, url: str) -> list[str]:
    """Files that an URL pattern names, sorted; raises where there are none."""
    check_url_glob(url)
    at = spark._jvm.org.apache.hadoop.fs.Path(url)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    files = sorted(f.getPath().toString() for f in found or [])
    if not files:
        raise FileNotFoundError(f"no file matches {url}")
    return files


def quote_identifier(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quote_string(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Registry:
    """Relations by name, as temporary views."""

    def __init__(self, spark: SparkSession):
        self.spark, self.names = spark, {}

    def register(self, name: str, source: str | DataFrame) -> DataFrame:
        if not _NAME.fullmatch(name):
            raise ValueError(f"not a relation name: {name!r}")
        df = folder(self.spark, source) if isinstance(source, str) else source
        df.createOrReplaceTempView(name)
        self.names[name] = df
        return df

    def source(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(f"{name} is not registered; registered are {sorted(self.names)}")
        return self.names[name]

    def registered(self) -> list[str]:
        return sorted(self.names)

    def query(self, sql: str, args: list | None = None) -> DataFrame:
        """SQL with positional parameters; Spark raises where one is missing."""
        return self.spark.sql(sql, args=args or None)


def scan(df: DataFrame, columns=None, limit: int | None = None) -> DataFrame:
    out = df.select(*columns) if columns else df
    return out.limit(limit) if limit is not None else out


def stratum(df: DataFrame, field: str, value, columns=None) -> DataFrame:
    """Rows of one value; filtered before projecting, so that the field needn't be selected."""
    return scan(df.where(F.col(field) == F.lit(value)), columns)


def strata(df: DataFrame, field: str, values, columns=None) -> dict:
    return {v: stratum(df, field, v, columns) for v in values}


def find_key(df: DataFrame, key: dict, scanned: Observation | None = None) -> DataFrame:
    """The row of a full key; raises where there is none. ``scanned`` counts the rows (``rows``) that were read
    before the search stopped."""
    hit = df if scanned is None else df.observe(scanned, F.count(F.lit(1)).alias("rows"))
    for c, v in key.items():
        hit = hit.where(F.col(c) == F.lit(v))
    found = hit.limit(1).collect()
    if not found:
        raise LookupError(f"no row for {key}")
    return df.sparkSession.createDataFrame(found, df.schema)


def csv(spark: SparkSession, path: str, schema=None, columns=None) -> DataFrame:
    """CSV with a header; names are stripped. Without a schema every column is text."""
    reader = spark.read.option("header", "true")
    df = (reader if schema is None else reader.schema(schema)).csv(path)
    df = df.toDF(*[c.strip() for c in df.columns])
    if columns:
        assert_columns(df, columns)
        return df.select(*columns)
    return df
