"""Roads: usable width, traffic mix, recovery metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadweave.functions.scalar import half_even

MAP_VARIANCE, SATELLITE_VARIANCE = 1.0, 0.25


def fused_widths(edges: DataFrame, satellite: DataFrame | None = None) -> DataFrame:
    """``width_dir_m`` and ``lanes_effective``; ``satellite`` has ``edge_id`` and ``width_sat_m``."""
    known = edges.join(satellite, "edge_id", "left") if satellite is not None else edges.withColumn("width_sat_m", F.lit(None).cast("double"))
    mapped = F.coalesce("width_osm_m", F.lit(7.0))
    both = (mapped / MAP_VARIANCE + F.col("width_sat_m") / SATELLITE_VARIANCE) / (1 / MAP_VARIANCE + 1 / SATELLITE_VARIANCE)
    wide = F.coalesce(both, mapped)
    out = known.withColumn("width_dir_m", half_even(F.when(F.col("oneway"), wide).otherwise(wide / 2), 2))
    return out.withColumn("lanes_effective", F.greatest(half_even(F.col("width_dir_m") / 3.0).cast("int"), F.lit(1)))


def class_mix(observations: DataFrame) -> DataFrame:
    """The share of each class among an edge's observations; rows without an edge are left out."""
    n = observations.where("edge_id IS NOT NULL AND edge_id <> ''").groupBy("edge_id", "class_name").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", half_even(F.col("n") / F.sum("n").over(Window.partitionBy("edge_id")), 3))


def frame_class_mix(detections: DataFrame, matched: DataFrame) -> DataFrame:
    """``class_mix`` of detections by the edge that their frame (``seq``, ``frame_idx``) was matched to; ``matched`` has one row
    a frame, and frames without an edge are left out."""
    return class_mix(detections.select("seq", "frame_idx", "class_name").join(matched.select("seq", "frame_idx", "edge_id"), ["seq", "frame_idx"]))


def recovery(truth: DataFrame, recovered: DataFrame, tolerance: float = 3.0) -> DataFrame:
    """Precision, recall, F1 and duplicates; both tables have ``ord``, ``class_name``, ``s``, ``t``.

    Each recovered row takes the first truth of its class (by ``ord``) within the tolerance; the first to take one
    recovers it, later ones are duplicates, and rows that take none are false. Truth cells are one tolerance wide.
    """
    cell = F.floor(F.col("s") / tolerance).cast("long")
    g = truth.select("class_name", F.col("ord").alias("g"), F.col("s").alias("gs"), F.col("t").alias("gt"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    r = recovered.select("class_name", F.col("ord").alias("r"), "s", "t", cell.alias("cell"))
    near = r.join(g, ["class_name", "cell"]).where(F.hypot(F.col("s") - F.col("gs"), F.col("t") - F.col("gt")) <= tolerance)
    taken = near.groupBy("r").agg(F.min("g").alias("g"))
    counts = taken.agg(F.count_distinct("g").alias("tp"), F.count(F.lit(1)).alias("took"))
    sizes = truth.agg(F.count(F.lit(1)).alias("n_truth")).crossJoin(recovered.agg(F.count(F.lit(1)).alias("n_recovered"))).crossJoin(counts)  # one row each
    ratio = lambda a, b: half_even(F.coalesce(F.try_divide(a, b), F.lit(0.0)), 4)
    out = sizes.withColumns({"fp": F.col("n_recovered") - F.col("took"), "fn": F.col("n_truth") - F.col("tp"), "duplicates": F.col("took") - F.col("tp")})
    out = out.withColumns({"precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("n_truth")), "duplicate_rate": ratio(F.col("duplicates"), F.col("n_recovered"))})
    return out.withColumn("f1", half_even(2 * F.col("precision") * F.col("recall") / F.greatest(F.col("precision") + F.col("recall"), F.lit(1e-4)), 4)).drop("took")
