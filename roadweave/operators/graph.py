"""Road graphs: synthetic grids, cleaning, the largest component, segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadweave.functions import scalar
from roadweave.runtime import stored


def grid_edges(nodes: DataFrame) -> DataFrame:
    """Both directions between neighbours of ``node_id``, ``i`` (row), ``j`` (column), ``x``, ``y``."""
    a, b = nodes.alias("a"), nodes.alias("b")
    point = lambda side: F.struct(F.col(f"{side}.x").alias("x"), F.col(f"{side}.y").alias("y"))
    ends = [F.col("a.node_id").alias("u"), F.col("b.node_id").alias("v")]
    along = a.join(b, (F.col("a.i") == F.col("b.i")) & (F.col("a.j") + 1 == F.col("b.j")))
    along = along.select(*ends, F.when(F.col("a.i") == 1, "primary").otherwise("secondary").alias("highway"), F.lit(50).alias("maxspeed_kph"), point("a").alias("p"), point("b").alias("q"))
    up = a.join(b, (F.col("a.j") == F.col("b.j")) & (F.col("a.i") + 1 == F.col("b.i")))
    up = up.select(*ends, F.when(F.col("a.j") == 1, "trunk").otherwise("residential").alias("highway"), F.lit(40).alias("maxspeed_kph"), point("a").alias("p"), point("b").alias("q"))
    there = along.unionByName(up)
    back = there.select(F.col("v").alias("u"), F.col("u").alias("v"), "highway", "maxspeed_kph", F.col("q").alias("p"), F.col("p").alias("q"))
    return there.unionByName(back).select(
        scalar.edge_id(F.col("u"), F.col("v"), F.lit(0)).alias("edge_id"), "u", "v", F.lit(0).alias("key"), "highway", "maxspeed_kph", F.lit(2).alias("lanes"), F.lit(7.5).alias("width_osm_m"), F.lit(False).alias("oneway"),
        F.array("p", "q").alias("geometry"),
    ).withColumn("length_m", polyline_length(F.col("geometry")))


def grid(spark: SparkSession, bbox: tuple[float, float, float, float], size: int = 3) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of a ``size`` x ``size`` grid over (west, south, east, north); ids from 1001, south to north."""
    west, south, east, north = bbox
    step = max(1, size - 1)
    i, j = F.floor(F.col("id") / size), F.pmod("id", F.lit(size))
    nodes = spark.range(size * size).select(
        (F.col("id") + 1001).alias("node_id"), i.alias("i"), j.alias("j"), (west + j * ((east - west) / step)).alias("x"), (south + i * ((north - south) / step)).alias("y"),
        F.when((i == 1) & (j == 1), "traffic_signals").alias("highway"),
    )
    return nodes, grid_edges(nodes)


def polyline_length(geometry: Column) -> Column:
    """Length of an array of points; null or one point has none."""
    steps = F.transform(geometry, lambda p, k: F.when(k > 0, F.hypot(p["x"] - F.get(geometry, k - 1)["x"], p["y"] - F.get(geometry, k - 1)["y"])).otherwise(0.0))
    return F.aggregate(steps, F.lit(0.0), lambda a, b: a + b)


def clean_tags(raw: DataFrame) -> DataFrame:
    """Typed tags from raw ones (``highway``, ``lanes``, ``maxspeed``, ``width``, ``oneway``, ``surface``)."""
    typed = raw.withColumn("highway", scalar.highway_type(F.col("highway")))
    typed = typed.withColumns({"lanes": scalar.lanes(F.col("lanes"), F.col("highway")), "maxspeed_kph": scalar.maxspeed(F.col("maxspeed"), F.col("highway")), "oneway": scalar.oneway(F.col("oneway")), "surface": scalar.surface(F.col("surface"))})
    return typed.withColumn("width_osm_m", scalar.width(F.col("width"), F.col("lanes")))


def with_node_defaults(nodes: DataFrame) -> DataFrame:
    """Nodes without a type are ``priority``."""
    given = F.col("highway") if "highway" in nodes.columns else F.lit(None).cast("string")
    return nodes.withColumn("highway", F.coalesce(given, F.lit("priority")))


def not_degenerate(length: str = "length_m", geometry_length: str = "geometry_length_m") -> Column:
    """False for edges of 1 cm or less, else of no geometry; without either fact an edge is degenerate."""
    return F.when(F.col(length).isNotNull(), F.col(length) > 0.01).when(F.col(geometry_length).isNotNull(), F.col(geometry_length) > 1e-7).otherwise(F.lit(False))


def clean_edges(edges: DataFrame) -> DataFrame:
    """Edges that stay, and their length filled from the geometry, else 1."""
    kept = edges.where(not_degenerate() & ((F.col("geometry_length_m").isNull()) | (F.col("geometry_length_m") > 1e-7)))
    return kept.withColumn("length_m", F.coalesce("length_m", "geometry_length_m", F.lit(1.0)))


def weak_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node), by least labels and pointer jumping, each round stored."""
    pairs = edges.select(F.col("u").alias("a"), F.col("v").alias("b"))
    both = stored(pairs.union(pairs.select("b", "a")).distinct(), "graph")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).select(F.col("a").alias("node"), "component", F.lit(True).alias("changed")), "components")
    while labels.where("changed").limit(1).count():
        old = labels.select("node", F.col("component").alias("old"))
        near = both.join(old, both["b"] == old["node"]).groupBy("a").agg(F.min("old").alias("near"))
        least = old.join(near, old["node"] == near["a"]).select("node", "old", F.least("old", "near").alias("least"))
        jump = old.select(F.col("node").alias("via"), F.col("old").alias("jump"))
        new = F.least("least", F.coalesce("jump", "least"))
        labels = stored(least.join(jump, least["least"] == jump["via"], "left").select("node", new.alias("component"), (new < F.col("old")).alias("changed")), "components")
    return labels.select("node", "component")


def largest_component(edges: DataFrame) -> DataFrame:
    """Edges of the component with the most nodes; among equals the one with the least node."""
    nodes = weak_components(edges)
    size = nodes.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    best = size.agg(F.max(F.struct("n", -F.col("component"))).alias("x")).select((-F.col("x.col2")).alias("component"))
    kept = nodes.join(F.broadcast(best), "component").select(F.col("node").alias("u"))
    return edges.join(kept, "u", "left_semi")


LEAST_LINE = 0.1  # metres; shorter lines are not matched
TANGENT = 1.0  # metres to either side of a place, between which its bearing is taken


def measured_line(geometry: Column) -> Column:
    """The points of a line with their place ``c`` along it."""
    empty = F.array().cast("array<struct<c:double,x:double,y:double>>")
    place = lambda done, p: F.coalesce(F.element_at(done, -1)["c"] + F.hypot(p["x"] - F.element_at(done, -1)["x"], p["y"] - F.element_at(done, -1)["y"]), F.lit(0.0))
    step = lambda done, p: F.when(F.size(done) == 0, F.array(F.struct(F.lit(0.0).alias("c"), p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")))).otherwise(
        F.concat(done, F.array(F.struct(place(done, p).alias("c"), p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y"))))
    )
    return F.aggregate(geometry, empty, step)


def point_at(line: Column, s: Column) -> Column:
    """The point at place ``s`` of a measured line."""
    before = F.greatest(F.least(F.size(F.filter(line, lambda p: p["c"] <= s)), F.size(line) - 1), F.lit(1))
    p, q = F.get(line, before - 1), F.get(line, before)
    f = F.least(F.greatest(F.coalesce((s - p["c"]) / F.nullif(q["c"] - p["c"], F.lit(0.0)), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    return F.struct((p["x"] + f * (q["x"] - p["x"])).alias("x"), (p["y"] + f * (q["y"] - p["y"])).alias("y"))


def bearing_at(line: Column, s: Column) -> Column:
    """Degrees from north between the points ``TANGENT`` metres before and after ``s``, the line's ends at most."""
    p = point_at(line, F.greatest(s - TANGENT, F.get(line, 0)["c"]))
    q = point_at(line, F.least(s + TANGENT, F.element_at(line, -1)["c"]))
    return F.pmod(F.degrees(F.atan2(q["x"] - p["x"], q["y"] - p["y"])), F.lit(360.0))


def gradient_bearings(samples: DataFrame) -> DataFrame:
    """``bearing`` of sampled points (``edge_id``, ``seq``, ``x``, ``y``) by central differences, one-sided at an edge's ends;
    an edge of one point has 0."""
    w = Window.partitionBy("edge_id").orderBy("seq")
    rise = lambda c: F.coalesce(F.lead(c).over(w), F.col(c)) - F.coalesce(F.lag(c).over(w), F.col(c))  # noqa: E731  (twice the step inside, which no angle minds)
    return samples.withColumn("bearing", F.pmod(F.degrees(F.atan2(rise("x"), rise("y"))), F.lit(360.0)))


def segments(edges: DataFrame) -> DataFrame:
    """A row a straight piece: ``edge_id``, ``seg``, ends, place of its start along the edge, length, and ``around``: the
    points of the line that a bearing within the piece may need, with their places (null where the line is this piece)."""
    lines = edges.select("edge_id", measured_line(F.col("geometry")).alias("line"))
    lines = lines.where((F.size("line") > 1) & (F.element_at("line", -1)["c"] >= LEAST_LINE))
    points = lines.select("edge_id", "line", F.posexplode("line").alias("seg", "a"))
    points = points.withColumn("b", F.get("line", F.col("seg") + 1)).where("b IS NOT NULL AND b.c > a.c")
    low = F.greatest(F.size(F.filter("line", lambda p: p["c"] <= F.col("a.c") - TANGENT)), F.lit(1))
    high = F.least(F.size("line") - F.size(F.filter("line", lambda p: p["c"] >= F.col("b.c") + TANGENT)) + 1, F.size("line"))
    return points.select(
        "edge_id", "seg", F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"), F.col("b.y").alias("by"), F.col("a.c").alias("s0"),
        (F.col("b.c") - F.col("a.c")).alias("len"), F.when(F.size("line") > 2, F.slice("line", low, high - low + 1)).alias("around"),
    )


def snapshot(edges: DataFrame) -> DataFrame:
    """One row: the nodes that edges start or end at, the edges and their length in kilometres."""
    ends = edges.select(F.explode(F.array("u", "v")).alias("node")).agg(F.count_distinct("node").alias("n_nodes"))
    size = edges.agg(F.count(F.lit(1)).alias("n_edges"), F.bround(F.sum("length_m") / 1000, 3).alias("total_length_km"))
    return ends.crossJoin(size)  # one row each
