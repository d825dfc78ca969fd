"""Map matching: candidate edges by a grid join, then the most likely path by a hidden Markov model."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadweave.functions.scalar import wrap_degrees
from roadweave.operators.graph import bearing_at
from roadweave.runtime import stored

RADIUS, SIGMA, BETA, MOST_TURN, BEST = 35.0, 5.0, 10.0, 100.0, 8
CHUNK = 4096  # poses that are decoded at once
SLICE = 8192  # poses of a pass that a window looks through at once
PIECE = 35.0  # metres of a segment that are put into cells at once


def candidates(poses: DataFrame, segments: DataFrame, gated: bool = True, radius: float = RADIUS) -> DataFrame:
    """Up to ``BEST`` edges of each pose (``obs``, ``x``, ``y``, ``heading``) within ``radius``, by emission, then edge.

    Segments are put into every cell of ``radius`` metres that their pieces' boxes, widened by it, meet; a pose looks in
    its own cell only, so the join is on equal cells and no pose is copied. With ``gated`` edges that turn away by more
    than ``MOST_TURN`` degrees go, but a pose that would have none keeps all.
    """
    cell = lambda c: F.floor(c / radius).cast("int")
    parts = F.greatest(F.ceil(F.col("len") / PIECE), F.lit(1)).cast("int")
    cut = segments.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    along = lambda a, b, k: F.col(a) + (F.col(b) - F.col(a)) * (F.col("part") + k) / F.col("parts")
    cut = cut.withColumns({"px": along("ax", "bx", 0), "py": along("ay", "by", 0), "qx": along("ax", "bx", 1), "qy": along("ay", "by", 1)})
    span = lambda p, q: F.sequence(cell(F.least(p, q) - radius), cell(F.greatest(p, q) + radius))
    cells = cut.withColumn("cx", F.explode(span("px", "qx"))).withColumn("cy", F.explode(span("py", "qy"))).drop("px", "py", "qx", "qy", "part", "parts").distinct()
    at = poses.select("obs", "x", "y", "heading", cell(F.col("x")).alias("cx"), cell(F.col("y")).alias("cy"))
    met = at.join(cells.hint("merge"), ["cx", "cy"])  # else poses are broadcast whose files are small only as they are compressed
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    f = F.least(F.greatest(((F.col("x") - F.col("ax")) * dx + (F.col("y") - F.col("ay")) * dy) / (F.col("len") * F.col("len")), F.lit(0.0)), F.lit(1.0))
    met = met.withColumn("f", f).withColumns({"fx": F.col("ax") + F.col("f") * dx, "fy": F.col("ay") + F.col("f") * dy})
    met = met.withColumn("d", F.hypot(F.col("x") - F.col("fx"), F.col("y") - F.col("fy"))).where(F.col("d") <= radius)
    met = met.withColumns({"s": F.col("s0") + F.col("f") * F.col("len"), "along": F.pmod(F.degrees(F.atan2(dx, dy)), F.lit(360.0))})
    near = F.when(F.col("around").isNull(), F.col("along")).otherwise(bearing_at(F.col("around"), F.col("s")))
    best = F.min(F.struct("d", "seg", "s", "fx", "fy", near.alias("bearing"))).alias("c")
    per_edge = met.groupBy("obs", "edge_id", "x", "y", "heading").agg(best).withColumn("bearing", F.col("c.bearing"))
    slope = F.radians("bearing")
    left = (F.col("y") - F.col("c.fy")) * F.sin(slope) - (F.col("x") - F.col("c.fx")) * F.cos(slope)
    away = F.abs(wrap_degrees(F.col("heading") - F.col("bearing"))) > MOST_TURN
    emission = F.lit(-0.5 * math.log(2 * math.pi * SIGMA * SIGMA)) - F.col("c.d") ** 2 / (2 * SIGMA * SIGMA)
    scored = per_edge.select("obs", "edge_id", "x", "y", "heading", F.col("c.s").alias("s"), left.alias("t"), F.col("c.d").alias("d"), "bearing", emission.alias("emission"), F.coalesce(away, F.lit(False)).alias("away"))
    if gated:
        facing = F.max(~F.col("away")).over(Window.partitionBy("obs"))
        scored = scored.withColumn("facing", facing).where("NOT away OR NOT facing").drop("facing")
    place = F.row_number().over(Window.partitionBy("obs").orderBy(F.desc(F.round("emission", 9)), "edge_id"))
    return scored.drop("away").withColumn("rank", place).where(F.col("rank") <= BEST)


def decode(steps: list[tuple[np.ndarray, np.ndarray, np.ndarray, float, float]]) -> list[int | None]:
    """The best candidate of each step: (edge codes, places, emissions, x, y), ``None`` without candidates so far.

    A step without candidates takes over the last one's, with their scores; a first step without any gives no path.
    """
    if not steps or not len(steps[0][0]):
        return [None] * len(steps)
    edges, places, score, x, y = steps[0]
    back: list[np.ndarray] = [np.zeros(len(edges), int)]
    alone = np.zeros(1, int)
    for e, s, emission, nx, ny in steps[1:]:
        if len(e) == 1 and len(edges) == 1:  # one path, whose score no longer tells anything
            back.append(alone)
            edges, places, score, x, y = e, s, emission, nx, ny
            continue
        if not len(e):
            back.append(np.arange(len(edges)))
            x, y = nx, ny
            continue
        straight = math.hypot(nx - x, ny - y)
        route = np.where(edges[:, None] == e[None], np.abs(s[None] - places[:, None]), straight)
        total = score[:, None] - math.log(BETA) - np.abs(straight - route) / BETA
        came = total.argmax(0)  # the first of equals
        back.append(came)
        score = total[came, np.arange(len(e))] + emission
        edges, places, x, y = e, s, nx, ny
    at, path = int(score.argmax()), []
    for came in reversed(back):
        path.append(at)
        at = int(came[at])
    return path[::-1]


def matched(poses: DataFrame, found: DataFrame) -> DataFrame:
    """The candidate that the most likely path of each ``pass_id`` takes at each pose, in order of ``obs``.

    Every path goes through a pose with a single candidate, and before a pose that shares no edge with the last one that had
    candidates all paths end alike, so a pass is cut there, into pieces of ``CHUNK`` poses or somewhat more, which are decoded
    apart; at a single candidate a piece ends with the pose that the next one starts with. Poses of steps that took over
    candidates get those of the last step that had its own. Cuts are sought in slices of ``SLICE`` poses, each of which starts
    with a row for the last cut before it; the poses are stored, as both read them.
    """
    held = found.groupBy("obs").agg(F.sort_array(F.collect_list(F.struct("rank", "edge_id", "s", "t", "bearing", "emission"))).alias("c"))
    ordered = poses.select("pass_id", "obs", "x", "y").repartitionByRange("pass_id", "obs").sortWithinPartitions("pass_id", "obs").withColumn("place", F.monotonically_increasing_id())
    slices = F.floor(F.col("place") / SLICE)  # a partition's numbers start at a multiple of 2 ** 33
    order = Window.partitionBy("pass_id", "slice").orderBy("place")
    edges = F.transform("c", lambda x: x["edge_id"])
    known = F.last(edges, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = ordered.withColumn("slice", slices).join(held, "obs", "left").withColumn("apart", F.coalesce(~F.arrays_overlap(edges, known), F.lit(False)))
    cut = F.when(F.col("apart") | (F.size("c") == 1), F.col("place"))
    rows = stored(rows.withColumn("cut", cut).withColumn("head", F.lit(False)), "steps")
    ends = rows.groupBy("pass_id", "slice").agg(F.max("cut").alias("cut"), F.min("place").alias("at"), F.min(F.when(F.col("c").isNotNull(), F.col("place"))).alias("met"))  # a row a slice
    earlier = Window.partitionBy("pass_id").orderBy("slice")
    last = F.coalesce(F.max("cut").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    pathless = ~F.first(F.col("at").eqNullSafe(F.col("met"))).over(earlier)
    heads = ends.select("pass_id", "slice", F.lit(-1).cast("long").alias("place"), last.alias("cut"), F.lit(True).alias("head"), pathless.alias("pathless"))
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.unionByName(heads, allowMissingColumns=True).withColumns({"own": F.floor(F.max("cut").over(so_far) / CHUNK), "pathless": F.max("pathless").over(so_far)})
    rows = rows.withColumn("before", F.lag("own").over(order)).where("NOT head AND NOT pathless")
    rows = rows.withColumn("chunk", F.explode(F.when((F.col("before") < F.col("own")) & ~F.col("apart"), F.array("own", "before")).otherwise(F.array("own"))))
    part = lambda c: F.coalesce(F.transform("c", lambda x: x[c]), F.array().cast(f"array<{'string' if c == 'edge_id' else 'double'}>")).alias(c)
    code = F.coalesce(F.transform("c", lambda x: F.xxhash64(x["edge_id"])), F.array().cast("array<long>")).alias("code")
    rows = rows.select("pass_id", "chunk", (F.col("own") == F.col("chunk")).alias("mine"), "obs", "x", "y", code, *(part(c) for c in ("edge_id", "s", "t", "bearing", "emission")))

    def whole(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("obs", ignore_index=True)
        path = decode(list(zip(group["code"], group["s"], group["emission"], group["x"], group["y"], strict=True)))
        out, last = [], 0  # the last step that had candidates of its own
        columns = [group[c].tolist() for c in ("pass_id", "obs", "mine", "edge_id", "s", "t", "bearing")]
        for i, k in enumerate(path):
            last = i if len(columns[3][i]) else last
            if k is not None and columns[2][i]:
                out.append((columns[0][i], columns[1][i], *(c[last][k] for c in columns[3:])))
        return pd.DataFrame(out, columns=["pass_id", "obs", "edge_id", "s", "t", "bearing"])

    schema = f"pass_id {poses.schema['pass_id'].dataType.simpleString()}, obs {poses.schema['obs'].dataType.simpleString()}, edge_id string, s double, t double, bearing double"
    return rows.groupBy("pass_id", "chunk").applyInPandas(whole, schema)
