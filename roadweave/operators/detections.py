"""Detections: validation, rejects, contact points, class maps, synthetic drives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadweave.functions.camera import Rig, ground_steps

# The classes of detections, and the detector's names for them.
STATIC_CLASSES = ("pothole", "speed_breaker", "barrier", "barricade", "parked_vehicle_obstruction")
DYNAMIC_CLASSES = ("two_wheeler", "auto_rickshaw", "car", "bus", "truck", "bicycle", "cycle_rickshaw", "pedestrian", "stray_animal")
DETECTOR_CLASSES = {"motorcycle": "two_wheeler", "bicycle": "bicycle", "car": "car", "bus": "bus", "truck": "truck", "person": "pedestrian"}


def reject_reason() -> Column:
    """The first rule that a detection breaks, null if none; NaN and null break the rule that reads them."""
    rules = {
        "frame_idx": F.col("frame_idx") >= 0,
        "frame_ts": ~F.isnan("frame_ts") & (F.col("frame_ts") >= 0),
        "conf": ~F.isnan("conf") & F.col("conf").between(0.25, 1.0),
        "origin": ~F.isnan("x1") & ~F.isnan("y1") & (F.col("x1") >= 0) & (F.col("y1") >= 0),
        "corner": ~F.isnan("x2") & ~F.isnan("y2") & (F.col("x2") > 0) & (F.col("y2") > 0),
        "image": (F.col("img_w") > 0) & (F.col("img_h") > 0),
        "extent": (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")),
        "outside": (F.col("x2") <= F.col("img_w")) & (F.col("y2") <= F.col("img_h")),
    }
    broken = [F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items()]
    return F.coalesce(*broken)


def split(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected detections; one scan each, the plan decides whether to share it."""
    marked = raw.withColumn("reject_reason", reject_reason())
    return marked.where("reject_reason IS NULL").drop("reject_reason"), marked.where("reject_reason IS NOT NULL")


def with_defaults(raw: DataFrame, sequence_id: str, img_w: int = 1920, img_h: int = 1080) -> DataFrame:
    """Columns that are absent get the defaults; an untracked row has track -1."""
    for name, value in (("sequence_id", sequence_id), ("img_w", img_w), ("img_h", img_h), ("track_id", None)):
        if name not in raw.columns:
            raw = raw.withColumn(name, F.lit(value))
    return raw.withColumn("track_id", F.coalesce(F.col("track_id").cast("long"), F.lit(-1)))


def contact(detections: DataFrame) -> DataFrame:
    """The middle of a box's lower side."""
    return detections.withColumns({"u": (F.col("x1") + F.col("x2")) / 2, "v": F.col("y2")})


def projected(detections: DataFrame, rig: Rig | None = None) -> DataFrame:
    """Ground coordinates; filter on ``valid``.

    The row number keeps the optimiser from writing all steps out again, many times over, in a later filter.
    """
    steps = ground_steps(F.col("u"), F.col("v"), rig or Rig())
    for step in steps:
        if "valid" in step and not detections.isStreaming:
            step["valid"] = F.when(F.monotonically_increasing_id() >= 0, step["valid"])
        detections = detections.withColumns(step)
    return detections.drop(*(c for step in steps for c in step if c.startswith("__")))


def local_classes(found: DataFrame, column: str = "detector_class") -> DataFrame:
    """Detector classes as local ones; what the map lacks is dropped."""
    pairs = [F.lit(x) for kv in DETECTOR_CLASSES.items() for x in kv]
    return found.withColumn("class_name", F.try_element_at(F.create_map(*pairs), F.col(column))).where("class_name IS NOT NULL")


def every_kth(frames: DataFrame, order: str, step: int = 1, most: int | None = None) -> DataFrame:
    """Each ``step``-th image of a sequence by name, then the first ``most`` of them."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("sequence_id").orderBy(order)) - 1
    kept = frames.withColumn("place", place).where(F.pmod("place", F.lit(step)) == 0)
    return (kept.where(F.col("place") < step * most) if most is not None else kept).drop("place")


def image_times(images: DataFrame, log: DataFrame) -> DataFrame:
    """``frame_ts`` of images (``seq``, ``name``, ``frame_idx``): the time of the log's last row (``seq``, ``row``, ``image_idx``,
    ``timestamp``) of the number that the name starts as, else a tenth of a second a frame."""
    number = F.regexp_extract("name", r"^(\d+)\.[^.]*$", 1).try_cast("long")
    known = log.where("image_idx IS NOT NULL").groupBy("seq", F.col("image_idx").cast("long").alias("number")).agg(F.max_by("timestamp", "row").alias("known"))
    met = images.withColumn("number", number).join(known, ["seq", "number"], "left")
    return met.withColumn("frame_ts", F.coalesce("known", F.bround(F.col("frame_idx") * 0.1, 3))).drop("number", "known")


def synthetic_drive(spark, frames: int, fps: float, plants: DataFrame, seed: int = 42) -> DataFrame:
    """A detection of each plant (``start``, ``end``, ``class_name``, ``track_id``) in each of its frames, seen to grow."""
    ticks = spark.range(frames).withColumnRenamed("id", "frame_idx")
    met = ticks.join(F.broadcast(plants), F.col("frame_idx").between(F.col("start"), F.col("end")))
    p = (F.col("frame_idx") - F.col("start")) / F.greatest(F.col("end") - F.col("start"), F.lit(1))
    v, u = 620 + 320 * p + F.randn(seed), 960 + F.randn(seed + 1)
    wide, high = 120 + 100 * p, 60 + 50 * p
    return met.select("frame_idx", F.bround(F.col("frame_idx") / fps, 4).alias("frame_ts"), "class_name", "track_id", F.lit(0.92).alias("conf"), (u - wide / 2).alias("x1"), (v - high).alias("y1"), (u + wide / 2).alias("x2"), v.alias("y2"))
