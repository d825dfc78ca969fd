"""Readers and writers of the pipeline's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DETECTIONS = "sequence_id string, frame_idx long, frame_ts double, class_name string, conf double, x1 double, y1 double, x2 double, y2 double, u double, v double, img_w long, img_h long, track_id long, model_version string"
OBSERVATIONS = "sequence_id string, frame_idx long, frame_ts double, edge_id string, class_name string, conf double, s_obs double, t_obs double, sigma_s double, sigma_t double, created_at timestamp"


def detections(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DETECTIONS).parquet(path)


def gps_log(spark: SparkSession, path: str) -> DataFrame:
    """A log as text columns, with the place of each row; one file is a sequence, so its order is its rows'."""
    raw = spark.read.csv(path, header=True)
    return raw.withColumns({"seq": F.input_file_name(), "row": F.monotonically_increasing_id()})


def ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def append_observations(rows: DataFrame, path: str) -> None:
    rows.select(*(c.split()[0] for c in OBSERVATIONS.split(", "))).write.mode("append").parquet(path)


def write_detections(rows: DataFrame, path: str) -> None:
    rows.select(*(c.split()[0] for c in DETECTIONS.split(", "))).write.option("compression", "snappy").parquet(path)


def manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, multiLine=True)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of files."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))
