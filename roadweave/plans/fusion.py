"""The analytic core: detections, GPS and a road graph to located observations and canonical anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadweave.functions.camera import Rig
from roadweave.functions.frenet import obstacle
from roadweave.operators import dedup, detections, gps, graph, matching
from roadweave.runtime import stored


def observations(found: DataFrame, log: DataFrame, edges: DataFrame, rig: Rig | None = None) -> DataFrame:
    """A row a located detection. ``found`` has ``seq``, ``obs`` (unique, ordered), ``frame_ts``, ``u``, ``v`` and more;
    ``log`` has ``seq``, ``timestamp``, ``x``, ``y``, ``speed``, ``heading``; ``edges`` as the graph operators give them.
    """
    rig = rig or Rig()
    seen = detections.projected(found, rig).where("valid")
    posed = stored(gps.poses(seen, log, offset=rig.time_offset_s).where("gps_valid"), "posed")
    at = posed.select("obs", F.col("seq").alias("pass_id"), F.col("ego_x").alias("x"), F.col("ego_y").alias("y"), F.col("ego_heading").alias("heading"))
    near = matching.candidates(at, graph.segments(edges))
    path = matching.matched(at, near).select("obs", "edge_id", F.col("s").alias("ego_s"), F.col("t").alias("ego_t"), "bearing")
    lengths = edges.select("edge_id", "length_m")
    met = posed.join(path.hint("merge"), "obs").join(lengths, "edge_id", "left").withColumn("length_m", F.coalesce("length_m", F.lit(100.0)))
    c = F.col
    placed = obstacle(c("ego_s"), c("ego_t"), c("ego_heading"), c("bearing"), c("X"), c("Y"), c("var_xx"), c("var_yy"), c("cov_xy"), c("length_m"))
    frame = [k for k in ("frame_idx",) if k in found.columns]
    out = met.select("seq", "obs", *frame, "frame_ts", "edge_id", "class_name", "conf", "track_id", *(v.alias(k) for k, v in placed.items()))
    return out.withColumns({"var_s": F.col("sigma_s") ** 2, "var_t": F.col("sigma_t") ** 2})


def run(found: DataFrame, log: DataFrame, edges: DataFrame, ledger: DataFrame | None = None, rig: Rig | None = None) -> tuple[DataFrame, DataFrame]:
    """Observations (stored) and the ledger after this pass."""
    placed = stored(observations(found, log, edges, rig), "observations")
    new = dedup.level1(placed, ["seq", "obs"]).drop("track_id")
    return placed, new if ledger is None else dedup.level2(ledger, new)
