"""Written-out intermediate tables in the folder that all executors share.

Each session writes below a folder of its own, which goes when the session ends (or at ``release``).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_runs: dict[tuple[str, str], str] = {}


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def shared_root(spark: SparkSession) -> str:
    """A folder of this session below ``spark.checkpoint.dir``. Where that is unset, a temporary folder if all
    executors run on this machine; otherwise there is no place that they share, and it raises."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    key = (spark.sparkContext.applicationId, root or "")
    if key not in _runs:
        if not root:
            master = spark.sparkContext.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
            root = f"file://{tempfile.mkdtemp(prefix='helixframe-')}"
        path = f"{root.rstrip('/')}/helixframe-{uuid.uuid4().hex}"
        fs, at = _file_system(spark, path)
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        _runs[key] = path
    return _runs[key]


def release(spark: SparkSession) -> None:
    """Delete the session's intermediate tables now; frames that read them are void afterwards."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = _runs.pop((spark.sparkContext.applicationId, root or ""), None)
    if path:
        fs, at = _file_system(spark, path)
        fs.delete(at, True)


def cut(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, a lost executor costs a
    re-read, and nothing above is computed twice."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
