"""The tables of a run on any file system that Spark reaches: graphs, scenario tables, ledger versions, drives."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.functions.geodesy import centroid_zone, from_utm, to_utm
from roadweave.operators import emit, gps, graph
from roadweave.operators.dedup import confirmed, upsert
from roadweave.sources.readers import gps_log

GPS_FILES = ("train.csv", "gps.csv", "val.csv", "test.csv")  # fixed values: a drive's log is the first of these


def _at(spark: SparkSession, path: str):
    """A path and its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, through a sibling that then takes its name, so that readers never see half of it."""
    part, fs = _at(spark, f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    at, _ = _at(spark, path)
    if not fs.rename(part, at):  # some file systems do not rename over a file
        fs.delete(at, False)
        if not fs.rename(part, at):
            raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, null if there is none."""
    at, fs = _at(spark, path)
    if not fs.exists(at):
        return None
    return spark.read.text(path, wholetext=True).first()[0]


def with_retries(fetch: Callable, fallback: Callable | None = None, attempts: int = 4, base: float = 1.5, sleep: Callable[[float], None] = time.sleep):
    """``fetch()``, again after growing pauses where it fails; then ``fallback()``, or the last failure."""
    for attempt in range(1, attempts + 1):
        try:
            return fetch()
        except Exception:
            if attempt == attempts and fallback is None:
                raise
            if attempt < attempts:
                sleep(base**attempt)
    return fallback()


def to_wkt(edges: DataFrame) -> DataFrame:
    """``geometry`` as text in ``geometry_wkt``."""
    return edges.withColumn("geometry_wkt", emit.wkt(F.col("geometry"))).drop("geometry")


def from_wkt(edges: DataFrame) -> DataFrame:
    """``geometry`` from its text, null where that is no line string."""
    return edges.withColumn("geometry", emit.points(F.col("geometry_wkt"))).drop("geometry_wkt")


def projected_nodes(nodes: DataFrame) -> DataFrame:
    """``x_utm``, ``y_utm`` of ``lon``, ``lat`` in the zone of the mean node, and that ``zone`` and ``north``."""
    met = nodes.crossJoin(F.broadcast(centroid_zone(nodes)))  # one row
    east, north = to_utm(F.col("lon"), F.col("lat"), F.col("zone"), F.col("north"))
    return met.withColumns({"x_utm": east, "y_utm": north})


def projected_edges(edges: DataFrame, zone: int, north: bool = True) -> DataFrame:
    """Lines of degrees as lines of metres, with their length."""
    point = lambda p: F.struct(*(v.alias(k) for k, v in zip("xy", to_utm(p["x"], p["y"], zone, north), strict=True)))
    out = edges.withColumn("geometry", F.transform("geometry", point))
    return out.withColumn("length_m", graph.polyline_length(F.col("geometry")))


def write_graph(nodes: DataFrame, edges: DataFrame, path: str, zone: int, north: bool = True, query: dict | None = None) -> dict:
    """Nodes (``node_id``, ``x``, ``y`` in metres and more; degrees are added), edges and ``snapshot.json``, which is returned.

    A null or absent node type is ``priority``. Tables of no rows keep their columns.
    """
    spark = nodes.sparkSession
    lon, lat = from_utm(F.col("x").cast("double"), F.col("y").cast("double"), zone, north)
    graph.with_node_defaults(nodes).withColumns({"lon": lon, "lat": lat}).write.mode("overwrite").parquet(f"{path}/nodes")
    to_wkt(edges).write.mode("overwrite").parquet(f"{path}/edges")
    size = graph.snapshot(spark.read.parquet(f"{path}/edges")).first().asDict()
    facts = {"query": query or {}, "utm_zone": zone, "is_northern": north, "utm_epsg": (32600 if north else 32700) + zone, "timestamp": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())} | size
    write_text(spark, f"{path}/snapshot.json", json.dumps(facts))
    return facts


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges as ``write_graph`` left them."""
    return spark.read.parquet(f"{path}/nodes"), from_wkt(spark.read.parquet(f"{path}/edges"))


def write_scenario_tables(edges: DataFrame, ledger: DataFrame, path: str) -> None:
    """Enriched edges with their lines as text, and the confirmed anomalies; either may have no rows."""
    to_wkt(edges).write.mode("overwrite").option("compression", "snappy").parquet(f"{path}/enriched_edges")
    confirmed(ledger).write.mode("overwrite").option("compression", "snappy").parquet(f"{path}/anomalies")


def read_scenario_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return from_wkt(spark.read.parquet(f"{path}/enriched_edges")), spark.read.parquet(f"{path}/anomalies")


def current_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger's current version, null before the first."""
    name = read_text(spark, f"{path}/CURRENT")
    return spark.read.parquet(f"{path}/{name.strip()}") if name else None


def commit_ledger(rows: DataFrame, path: str) -> DataFrame:
    """Takes rows (with ``created_at`` and ``updated_at``) into the ledger: a new version is written whole, then ``CURRENT`` names
    it, then the version before is deleted. A writer that fails leaves the old version in force; there may be one writer at a time."""
    spark = rows.sparkSession
    old = read_text(spark, f"{path}/CURRENT")
    merged = rows if old is None else upsert(spark.read.parquet(f"{path}/{old.strip()}"), rows)
    name = f"v-{uuid.uuid4().hex}"
    merged.write.parquet(f"{path}/{name}")
    write_text(spark, f"{path}/CURRENT", name)
    if old is not None:
        gone, fs = _at(spark, f"{path}/{old.strip()}")
        fs.delete(gone, True)
    return spark.read.parquet(f"{path}/{name}")


def sequences(spark: SparkSession, root: str) -> list[str]:
    """Names, in order, of the folders below ``root`` that hold a training log."""
    at, fs = _at(spark, f"{root}/*/{GPS_FILES[0]}")
    return sorted(f.getPath().getParent().getName() for f in (fs.globStatus(at) or []))


def gps_file(spark: SparkSession, folder: str) -> str:
    """The first log of a drive's folder."""
    for name in GPS_FILES:
        at, fs = _at(spark, f"{folder}/{name}")
        if fs.exists(at):
            return f"{folder}/{name}"
    raise FileNotFoundError(f"no GPS log ({', '.join(GPS_FILES)}) in {folder}")


def ingest_gps(spark: SparkSession, folder: str, out: str) -> DataFrame:
    """A drive's normalised log, written with a header and read back with its types."""
    log = gps.normalised(gps_log(spark, gps_file(spark, folder))).drop("seq", "row")
    log.orderBy("timestamp").coalesce(1).write.mode("overwrite").csv(out, header=True)
    return spark.read.schema(log.schema).csv(out, header=True)


def images(spark: SparkSession, folder: str) -> DataFrame:
    """A row a picture (``path``, ``name``), of the kinds that drives hold; contents are not read, and files of no bytes are left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{jpg,png}").load(folder).select("path")
    return files.withColumn("name", F.element_at(F.split("path", "/"), -1))
