"""Bounded incremental ingestion: the reference's streams are bounded batches, so availableNow."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.enrich import enrich, normalize
from ..sources.shared import shared_root


def enrich_stream(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, max_files: int = 100):
    """Normalize and enrich new files of a folder into Parquet; restarting with the checkpoint takes only new files."""
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    q = enrich(normalize(s)).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def validate_stream(spark: SparkSession, d: str) -> DataFrame:
    """Counters per event type. Every micro-batch writes its partial counters under its number (a repeated batch
    overwrites its own); the result merges them."""
    base = f"{shared_root(spark)}/events-{uuid.uuid4().hex}"
    file = f"{d}/events.parquet"
    schema = spark.read.parquet(file).schema
    folder, name = file.rsplit("/", 1)

    def batch(df: DataFrame, number: int) -> None:
        per = df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.count_if(F.col("props").isNull()).alias("missing_props"))
        per.write.mode("overwrite").parquet(f"{base}/counters/batch={number}")

    s = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder) if not _is_folder(spark, file) else spark.readStream.schema(schema).parquet(file)
    s.writeStream.foreachBatch(batch).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    parts = spark.read.parquet(f"{base}/counters")
    return parts.groupBy("event_type").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"), F.sum("missing_props").alias("missing_props"))


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()
