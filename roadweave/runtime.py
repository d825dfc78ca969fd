"""Session helpers shared by the library and its optional subpackages."""

from __future__ import annotations

import os
import uuid
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1024  # rows of an Arrow batch where the session sets no other number: rows may hold whole texts
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def attach(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package even if only the driver's ``sys.path`` names it, and bound their batches."""
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *have])
    if spark.conf.get(BATCH_KEY) == "10000":  # the default
        spark.conf.set(BATCH_KEY, BATCH_ROWS)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``. Only a local session may do without the setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file:///tmp/{os.environ.get('USER', 'spark')}-roadweave-checkpoints"
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back, which cuts its lineage durably."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes the files of tables that ``stored`` gave; nothing that is still to be computed may read them."""
    for df in tables:
        path = _PATHS.pop(df, None)
        if path:
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
