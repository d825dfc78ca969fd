"""Registered queries of the fusion operators, and the SQL that each is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.functions import camera, frenet, geodesy, scalar
from roadweave.operators import dedup, detections, emit, gps, graph, matching, roads
from roadweave.plans import fusion
from roadweave.plans.adapters import adapted, sql
from roadweave.runtime import stored
from roadweave.sources import stores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def r6(c: str | Column, name: str | None = None) -> Column:
    """Six places: the last bits of transcendental functions differ between engines."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name or str(c))


_RAY = """ray AS (SELECT *, (u - 960) / 1380 AS rx, (v - 540) / 1380 AS ry, cos(radians(-2.5)) AS c, sin(radians(-2.5)) AS z FROM det),
scaled AS (SELECT *, -1.5 / CASE WHEN -z - c * ry < -1e-4 THEN -z - c * ry END AS k FROM ray),
xy AS (SELECT *, k * (c - z * ry) AS xf, k * -rx AS yl FROM scaled),
ground AS (SELECT *, sqrt(xf * xf + yl * yl) AS reach FROM xy WHERE sqrt(xf * xf + yl * yl) BETWEEN 4 AND 30 AND xf > 0)"""


@query(f"WITH {sql('det')}, {_RAY} SELECT class_name, count(*) AS n, round(avg(reach), 6) AS mean_range, round(max(xf), 6) AS farthest FROM ground GROUP BY class_name")
def ground_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections to the ground plane, those in range, by class."""
    seen = detections.projected(adapted(spark, sf_dir, "det")).where("valid")
    return seen.groupBy("class_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("range_m"), 6).alias("mean_range"), F.round(F.max("X"), 6).alias("farthest"))


@query(f"""WITH {sql('det')}, {_RAY} SELECT k1, k2, k3, k4, round(xf, 6) AS "X", CASE WHEN round(yl, 6) = 0 THEN 0.0 ELSE round(yl, 6) END AS "Y", round(reach, 6) AS range_m,
round(pow(xf * xf / (1.5 * 1380) * 2, 2) + pow(xf * xf / 1.5 * radians(0.5), 2), 6) AS var_xx, round(pow(xf / 1380 * 2, 2), 6) AS var_yy FROM ground""")
def project_ground(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = detections.projected(adapted(spark, sf_dir, "det")).where("valid")
    return seen.select("k1", "k2", "k3", "k4", *(r6(c) for c in ("X", "Y", "range_m", "var_xx", "var_yy")))


@query(f"WITH {sql('det')}, {_RAY} SELECT k1, k2, k3, k4, round(u, 6) AS u, round(v, 6) AS v FROM ground")
def ground_to_pixel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """There and back: the pixels are the ones that were projected."""
    seen = detections.projected(adapted(spark, sf_dir, "det")).where("valid")
    u, v = camera.pixel(F.col("X"), F.col("Y"), camera.Rig())
    return seen.select("k1", "k2", "k3", "k4", r6(u, "u"), r6(v, "v"))


_REASON = """CASE WHEN NOT frame_idx >= 0 THEN 'frame_idx' WHEN NOT frame_ts >= 0 THEN 'frame_ts' WHEN NOT conf BETWEEN 0.25 AND 1 THEN 'conf' WHEN NOT (x1 >= 0 AND y1 >= 0) THEN 'origin'
WHEN NOT (x2 > 0 AND y2 > 0) THEN 'corner' WHEN NOT (img_w > 0 AND img_h > 0) THEN 'image' WHEN NOT (x2 > x1 AND y2 > y1) THEN 'extent' WHEN NOT (x2 <= img_w AND y2 <= img_h) THEN 'outside' END"""


@query(f"WITH {sql('boxes')} SELECT k1, k2, k3, k4, (x1 + x2) / 2 AS u, y2 AS v FROM boxes WHERE {_REASON} IS NULL")
def detection_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = detections.split(adapted(spark, sf_dir, "boxes"))
    return detections.contact(valid).select("k1", "k2", "k3", "k4", "u", "v")


@query(f"WITH {sql('boxes')} SELECT {_REASON} AS reject_reason, count(*) AS n FROM boxes WHERE {_REASON} IS NOT NULL GROUP BY 1")
def detection_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = detections.split(adapted(spark, sf_dir, "boxes"))
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


_E2, _EP2 = geodesy.E2, geodesy.EP2
_FORWARD = f"""rad AS (SELECT *, radians(lat) AS p, radians(lon) - radians(81) AS l FROM lonlat),
parts AS (SELECT *, 6378137 / sqrt(1 - {_E2!r} * pow(sin(p), 2)) AS n, pow(tan(p), 2) AS t, {_EP2!r} * pow(cos(p), 2) AS c, cos(p) * l AS a,
6378137 * ((1 - {_E2!r} / 4 - 3 * pow({_E2!r}, 2) / 64 - 5 * pow({_E2!r}, 3) / 256) * p - (3 * {_E2!r} / 8 + 3 * pow({_E2!r}, 2) / 32 + 45 * pow({_E2!r}, 3) / 1024) * sin(2 * p)
+ (15 * pow({_E2!r}, 2) / 256 + 45 * pow({_E2!r}, 3) / 1024) * sin(4 * p) - 35 * pow({_E2!r}, 3) / 3072 * sin(6 * p)) AS m FROM rad),
utm AS (SELECT *, 0.9996 * n * (a + (1 - t + c) * pow(a, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * {_EP2!r}) * pow(a, 5) / 120) + 500000 AS e,
0.9996 * (m + n * tan(p) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * pow(a, 4) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * {_EP2!r}) * pow(a, 6) / 720)) AS nn FROM parts)"""


@query(f"WITH {sql('lonlat')}, {_FORWARD} SELECT event_id, round(e, 4) AS easting, round(nn, 4) AS northing FROM utm")
def utm_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    east, north = geodesy.to_utm(F.col("lon"), F.col("lat"), 44)
    return adapted(spark, sf_dir, "lonlat").select("event_id", F.round(east, 4).alias("easting"), F.round(north, 4).alias("northing"))


@query(f"WITH {sql('lonlat')} SELECT event_id, round(lon, 5) AS lon, round(lat, 5) AS lat FROM lonlat")
def utm_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """There and back, each row in its own zone."""
    rows = adapted(spark, sf_dir, "lonlat").withColumns({"zone": geodesy.utm_zone(F.col("lon")), "north": F.col("lat") >= 0})
    east, north = geodesy.to_utm(F.col("lon"), F.col("lat"), F.col("zone"), F.col("north"))
    lon, lat = geodesy.from_utm(F.col("e"), F.col("n"), F.col("zone"), F.col("north"))
    there = rows.select("event_id", "zone", "north", east.alias("e"), north.alias("n"))
    return there.select("event_id", F.round(lon, 5).alias("lon"), F.round(lat, 5).alias("lat"))


@query(f"WITH {sql('lonlat')} SELECT event_id, least(greatest(cast(floor((lon + 180) / 6) AS int) + 1, 1), 60) AS zone, least(greatest(cast(floor((lon + 180) / 6) AS int) + 1, 1), 60) + CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END AS epsg FROM lonlat")
def utm_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapted(spark, sf_dir, "lonlat").select("event_id", geodesy.utm_zone(F.col("lon")).alias("zone"), geodesy.utm_epsg(F.col("lon"), F.col("lat")).alias("epsg"))


def _default(table: dict[str, int], other: int) -> str:
    return "CASE hw " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in table.items()) + f" ELSE {other} END"


@query(f"""WITH {sql('tags')}, a AS (SELECT *, coalesce(lower(trim(highway)), 'unclassified') AS hw FROM tags),
b AS (SELECT *, CASE WHEN try_cast(split_part(lanes, ';', 1) AS double) >= 1 THEN cast(floor(cast(split_part(lanes, ';', 1) AS double)) AS int) ELSE {_default(scalar.LANES, 1)} END AS ln, try_cast(regexp_extract(maxspeed, '[0-9]+') AS int) AS sp FROM a),
c AS (SELECT *, CASE WHEN maxspeed LIKE '%mph%' THEN cast(floor(sp * 1.60934) AS int) ELSE sp END AS kph, CASE WHEN regexp_full_match(replace(width, 'm', ''), ' *[0-9.]+ *') THEN cast(trim(replace(width, 'm', '')) AS double) END AS w FROM b)
SELECT p_partkey, hw AS highway, ln AS lanes, CASE WHEN kph BETWEEN 10 AND 150 THEN kph ELSE {_default(scalar.MAXSPEED, 40)} END AS maxspeed_kph, CASE WHEN w BETWEEN 1.5 AND 60 THEN w ELSE cast(ln * 3.5 AS double) END AS width_osm_m,
coalesce(oneway IN ('yes', '-1'), false) AS oneway, CASE WHEN surface = 'paved' THEN 'paved' ELSE 'asphalt' END AS surface FROM c""")
def tag_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.clean_tags(adapted(spark, sf_dir, "tags")).select("p_partkey", "highway", "lanes", "maxspeed_kph", "width_osm_m", "oneway", "surface")


@query(f"""WITH {sql('roads')} SELECT edge_id, coalesce(length_m, geometry_length_m, 1) AS length_m FROM roads
WHERE NOT (length_m IS NULL AND geometry_length_m IS NULL) AND coalesce(length_m, 1) > 0.01 AND coalesce(geometry_length_m, 1) > 1e-7""")
def edge_degenerate_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.clean_edges(adapted(spark, sf_dir, "roads")).select("edge_id", "length_m")


@query(f"""WITH RECURSIVE {sql('links')}, ends AS (SELECT u AS a, v AS b FROM links UNION SELECT v, u FROM links),
reach AS (SELECT DISTINCT a AS root, a AS node FROM ends UNION SELECT root, b FROM reach JOIN ends ON node = a),
label AS (SELECT node, min(root) AS component FROM reach GROUP BY node), best AS (SELECT component FROM label GROUP BY component ORDER BY count(*) DESC, component LIMIT 1)
SELECT links.u, links.v FROM links JOIN label ON links.u = label.node WHERE component = (SELECT component FROM best)""")
def largest_component(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.largest_component(adapted(spark, sf_dir, "links")).select("u", "v")


_GRID = f"""{sql('grid')}, pairs AS (SELECT a.node_id AS u, b.node_id AS v, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_, a.i = b.i AS along,
CASE WHEN a.i = b.i THEN CASE WHEN a.i = 1 THEN 'primary' ELSE 'secondary' END ELSE CASE WHEN a.j = 1 THEN 'trunk' ELSE 'residential' END END AS highway
FROM grid a JOIN grid b ON abs(a.i - b.i) + abs(a.j - b.j) = 1),
edges AS (SELECT concat(u, '_', v, '_0') AS edge_id, *, sqrt(pow(bx - ax, 2) + pow(by_ - ay, 2)) AS len FROM pairs)"""


@query(f"WITH {_GRID} SELECT edge_id, u, v, highway, CASE WHEN along THEN 50 ELSE 40 END AS maxspeed_kph, len AS length_m FROM edges")
def grid_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.grid_edges(adapted(spark, sf_dir, "grid")).select("edge_id", "u", "v", "highway", "maxspeed_kph", "length_m")


@query(f"""WITH {sql('fixes')}, d AS (SELECT *, lead(lon, 1, lon) OVER w - lon AS dx, lead(lat, 1, lat) OVER w - lat AS dy, coalesce(lead(timestamp) OVER w - timestamp, 0.1) AS dt, avg(lat) OVER (PARTITION BY seq) AS ml FROM fixes WINDOW w AS (PARTITION BY seq ORDER BY timestamp))
SELECT seq, timestamp, round(degrees(atan2(dx, dy)) - 360 * floor(degrees(atan2(dx, dy)) / 360), 1) AS heading,
round(least(sqrt(pow(dx * 111139 * cos(radians(ml)), 2) + pow(dy * 111139, 2)) / CASE WHEN dt <= 0.01 THEN 0.1 ELSE dt END, 40), 1) AS speed FROM d""")
def gps_speed_heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = gps.estimated_speed(gps.estimated_heading(adapted(spark, sf_dir, "fixes")))
    return log.select("seq", "timestamp", F.round("heading", 1).alias("heading"), F.round("speed", 1).alias("speed"))


_UNWRAP = """d AS (SELECT *, heading - lag(heading) OVER (PARTITION BY seq ORDER BY timestamp) AS dh FROM fixes),
t AS (SELECT *, CASE WHEN dh IS NULL THEN 0 WHEN dh + 180 - 360 * floor((dh + 180) / 360) = 0 AND dh > 0 THEN 180 ELSE dh + 180 - 360 * floor((dh + 180) / 360) - 180 END AS turn FROM d),
un AS (SELECT *, first_value(heading) OVER w + sum(turn) OVER w AS hu FROM t WINDOW w AS (PARTITION BY seq ORDER BY timestamp ROWS UNBOUNDED PRECEDING))"""


@query(f"WITH {sql('fixes')}, {_UNWRAP} SELECT seq, timestamp, hu AS heading_unwrapped FROM un")
def gps_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gps.unwrapped(adapted(spark, sf_dir, "fixes")).select("seq", "timestamp", "heading_unwrapped")


@query(f"""WITH {sql('fixes')}, {_UNWRAP}, {sql('asked')}, near AS (SELECT q.*, p.timestamp AS pt, n.timestamp AS nt, coalesce(p.timestamp, n.timestamp) AS t0, coalesce(n.timestamp, p.timestamp) AS t1,
coalesce(p.x, n.x) AS x0, coalesce(n.x, p.x) AS x1, coalesce(p.y, n.y) AS y0, coalesce(n.y, p.y) AS y1, coalesce(p.speed, n.speed) AS s0, coalesce(n.speed, p.speed) AS s1, coalesce(p.hu, n.hu) AS h0, coalesce(n.hu, p.hu) AS h1
FROM asked q ASOF LEFT JOIN un p ON q.seq = p.seq AND q.frame_ts >= p.timestamp ASOF LEFT JOIN un n ON q.seq = n.seq AND q.frame_ts <= n.timestamp),
f AS (SELECT *, CASE WHEN t1 > t0 THEN (frame_ts - t0) / (t1 - t0) ELSE 0 END AS k FROM near), g AS (SELECT *, h0 + k * (h1 - h0) AS h, s0 + k * (s1 - s0) AS sp FROM f)
SELECT seq, ask, round(x0 + k * (x1 - x0), 6) AS ego_x, round(y0 + k * (y1 - y0), 6) AS ego_y, round(sp, 6) AS ego_speed, round(h - 360 * floor(h / 360), 4) AS ego_heading,
pt IS NOT NULL AND nt IS NOT NULL AND coalesce(least(abs(frame_ts - t0), abs(t1 - frame_ts)) <= 1, false) AND sp <= 45 AS gps_valid FROM g""")
def pose_interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = gps.poses(adapted(spark, sf_dir, "asked"), adapted(spark, sf_dir, "fixes"))
    return out.select("seq", "ask", r6("ego_x"), r6("ego_y"), r6("ego_speed"), F.round("ego_heading", 4).alias("ego_heading"), "gps_valid")


@query(f"WITH {sql('fixes')} SELECT round(min(lon) - 0.0015, 4) AS west, round(min(lat) - 0.0015, 4) AS south, round(max(lon) + 0.0015, 4) AS east, round(max(lat) + 0.0015, 4) AS north FROM fixes")
def trajectory_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gps.bbox(adapted(spark, sf_dir, "fixes"))


_FRENET = f"""WITH {sql('obs')}, e AS (SELECT *, k1 * 31 % 360 AS hd, k3 * 17 % 360 AS br, cast(5 + k2 AS double) AS xf, k2 - cast(3 AS double) AS yl FROM obs),
a AS (SELECT *, hd - br + 180 - 360 * floor((hd - br + 180) / 360) - 180 AS dp FROM e), b AS (SELECT *, cos(radians(dp)) AS c, sin(radians(dp)) AS z FROM a)"""


@query(f"""{_FRENET} SELECT k1, k2, k3, k4, round_even(least(greatest(s + xf * c - yl * z, 0), 100), 3) AS s, round_even(t + xf * z + yl * c, 3) + 0.0 AS t, round_even(sqrt(greatest(c * c * var_s + z * z * var_t, 1e-4)), 3) AS sigma_s,
round_even(sqrt(greatest(z * z * var_s + c * c * var_t, 1e-4)), 3) AS sigma_t, cast(dp AS double) AS heading_delta_deg FROM b""")
def frenet_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    rows = adapted(spark, sf_dir, "obs").withColumns({"hd": F.expr("k1 * 31 % 360"), "br": F.expr("k3 * 17 % 360"), "xf": F.expr("cast(5 + k2 AS double)"), "yl": F.expr("k2 - cast(3 AS double)")})
    out = frenet.obstacle(c("s"), c("t"), c("hd"), c("br"), c("xf"), c("yl"), c("var_s"), c("var_t"), F.lit(0.0), F.lit(100.0))
    return rows.select("k1", "k2", "k3", "k4", *(out[k].alias(k) for k in ("s", "t", "sigma_s", "sigma_t", "heading_delta_deg")))


@query(f"WITH {sql('obs')} SELECT k1, k2, k3, k4, CASE WHEN k2 % 2 = 0 THEN least(greatest(80 - s, 0), 80) ELSE s END AS s, CASE WHEN k2 % 2 = 0 THEN -t ELSE t END AS t FROM obs")
def canonicalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = frenet.forward_side(F.col("s"), F.col("t"), F.lit(80.0), F.expr("k2 % 2 = 0"))
    return adapted(spark, sf_dir, "obs").select("k1", "k2", "k3", "k4", s.alias("s"), t.alias("t"))


_D2 = "pow(a.s - b.s, 2) / greatest(a.var_s + b.var_s, 1e-4) + pow(a.t - b.t, 2) / greatest(a.var_t + b.var_t, 1e-4)"


@query(f"WITH {sql('ledger')}, {sql('news')} SELECT a.anomaly_id AS old_id, b.anomaly_id AS new_id, round({_D2}, 6) AS d2 FROM ledger a JOIN news b USING (edge_id, class_name) WHERE {_D2} <= 9.21")
def mahalanobis_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.gated_pairs(adapted(spark, sf_dir, "ledger"), adapted(spark, sf_dir, "news")).select("old_id", "new_id", r6("d2"))


_STEP = """{{'s': (a.s / greatest(a.vs, 1e-4) + x.s / greatest(x.vs, 1e-4)) / (1 / greatest(a.vs, 1e-4) + 1 / greatest(x.vs, 1e-4)), 't': (a.t / greatest(a.vt, 1e-4) + x.t / greatest(x.vt, 1e-4)) / (1 / greatest(a.vt, 1e-4) + 1 / greatest(x.vt, 1e-4)),
'vs': 1 / (1 / greatest(a.vs, 1e-4) + 1 / greatest(x.vs, 1e-4)), 'vt': 1 / (1 / greatest(a.vt, 1e-4) + 1 / greatest(x.vt, 1e-4)), 'c': least(greatest(a.c, x.c) + cast(0.05 AS double), cast(0.99 AS double)), 'n': a.n + 1,
'ok': a.ok OR a.n + 1 >= 5 OR (least(greatest(a.c, x.c) + cast(0.05 AS double), cast(0.99 AS double)) >= 0.5)}}"""


@query(f"""WITH {sql('obs')}, g AS (SELECT edge_id, class_name, CASE WHEN track_id >= 0 THEN track_id END AS track_id,
list({{'s': s, 't': t, 'vs': var_s, 'vt': var_t, 'c': conf, 'n': 1, 'ok': false}} ORDER BY k1, k2, k3, k4) AS o FROM obs GROUP BY edge_id, class_name, CASE WHEN track_id >= 0 THEN track_id END, CASE WHEN track_id < 0 THEN (k1, k2, k3, k4) END),
f AS (SELECT edge_id, class_name, track_id, len(o) AS n, list_reduce(o, lambda a, x: {_STEP.format()}) AS z FROM g)
SELECT edge_id, class_name, cast(track_id AS bigint) AS track_id, round(z.s, 9) AS s, round(z.t, 9) AS t, round(z.vs, 6) AS var_s, round(z.vt, 6) AS var_t, round(z.c, 6) AS confidence, n AS observation_count, CASE WHEN z.ok OR n >= 5 THEN 'CONFIRMED' ELSE 'CANDIDATE' END AS state FROM f""")
def dedup_level1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup.level1(adapted(spark, sf_dir, "obs"), ["k1", "k2", "k3", "k4"])
    return out.select("edge_id", "class_name", F.col("track_id").cast("long").alias("track_id"), F.round("s", 9).alias("s"), F.round("t", 9).alias("t"), r6("var_s"), r6("var_t"), r6("confidence"), "observation_count", "state")


_MERGE = f"""WITH {sql('ledger')}, {sql('news')}, p AS (SELECT a.anomaly_id AS o, b.anomaly_id AS w FROM ledger a JOIN news b USING (edge_id, class_name) WHERE {_D2} <= 9.21),
m AS (SELECT a.*, b.s AS bs, b.t AS bt, 1 / greatest(a.var_s, 1e-4) AS ws, 1 / greatest(b.var_s, 1e-4) AS us, 1 / greatest(a.var_t, 1e-4) AS wt, 1 / greatest(b.var_t, 1e-4) AS ut, least(greatest(a.confidence, b.confidence) + 0.05, 0.99) AS c2, b.anomaly_id IS NOT NULL AS hit
FROM ledger a LEFT JOIN p ON a.anomaly_id = p.o LEFT JOIN news b ON b.anomaly_id = p.w),
out AS (SELECT anomaly_id, edge_id, class_name, CASE WHEN hit THEN (s * ws + bs * us) / (ws + us) ELSE s END AS s, CASE WHEN hit THEN (t * wt + bt * ut) / (wt + ut) ELSE t END AS t, CASE WHEN hit THEN 1 / (ws + us) ELSE var_s END AS var_s, CASE WHEN hit THEN 1 / (wt + ut) ELSE var_t END AS var_t,
CASE WHEN hit THEN c2 ELSE confidence END AS confidence, CASE WHEN hit THEN observation_count + 1 ELSE observation_count END AS observation_count, CASE WHEN hit AND (c2 >= 0.5 OR observation_count + 1 >= 5) THEN 'CONFIRMED' ELSE state END AS state FROM m
UNION ALL SELECT anomaly_id, edge_id, class_name, s, t, var_s, var_t, confidence, observation_count, state FROM news WHERE anomaly_id NOT IN (SELECT w FROM p))"""


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.level2(adapted(spark, sf_dir, "ledger"), adapted(spark, sf_dir, "news"))


@query(f"{_MERGE} SELECT anomaly_id, edge_id, class_name, round(s, 6) AS s, round(t, 6) AS t, round(var_s, 6) AS var_s, round(var_t, 6) AS var_t, round(confidence, 6) AS confidence, observation_count, state FROM out")
def dedup_level2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir).select("anomaly_id", "edge_id", "class_name", *(r6(c) for c in ("s", "t", "var_s", "var_t", "confidence")), "observation_count", "state")


@query(f"{_MERGE} SELECT anomaly_id, edge_id, class_name, round(s, 6) AS s, round(t, 6) AS t, round(sqrt(greatest(var_s, 1e-4)), 6) AS sigma_s, round(sqrt(greatest(var_t, 1e-4)), 6) AS sigma_t, round(confidence, 6) AS confidence, observation_count, state FROM out WHERE state = 'CONFIRMED'")
def confirmed_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup.confirmed(_merged(spark, sf_dir))
    return out.select("anomaly_id", "edge_id", "class_name", *(r6(c) for c in ("s", "t", "sigma_s", "sigma_t", "confidence")), "observation_count", "state")


@query(f"""WITH {sql('ledger')}, {sql('news')}, up AS (SELECT replace(anomaly_id, 'n', 'a') AS anomaly_id, 'other' AS edge_id, s, confidence FROM news WHERE cast(substr(anomaly_id, 2) AS int) % 3 <> 1 UNION ALL SELECT anomaly_id, 'other', s, confidence FROM news WHERE cast(substr(anomaly_id, 2) AS int) % 3 = 1)
SELECT coalesce(a.anomaly_id, b.anomaly_id) AS anomaly_id, CASE WHEN a.anomaly_id IS NULL THEN b.edge_id ELSE a.edge_id END AS edge_id, coalesce(b.s, a.s) AS s, coalesce(b.confidence, a.confidence) AS confidence, CASE WHEN a.anomaly_id IS NULL THEN 2 ELSE 1 END AS created_at, CASE WHEN b.anomaly_id IS NULL THEN 1 ELSE 2 END AS updated_at
FROM ledger a FULL OUTER JOIN up b ON a.anomaly_id = b.anomaly_id""")
def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = lambda df, t: df.withColumns({"created_at": F.lit(t), "updated_at": F.lit(t)})
    news, rest = adapted(spark, sf_dir, "news").withColumn("edge_id", F.lit("other")), F.expr("cast(substr(anomaly_id, 2) AS int) % 3")
    rows = news.where(rest != 1).withColumn("anomaly_id", F.replace("anomaly_id", F.lit("n"), F.lit("a"))).unionByName(news.where(rest == 1))
    out = dedup.upsert(stamped(adapted(spark, sf_dir, "ledger"), 1), stamped(rows, 2))
    return out.select("anomaly_id", "edge_id", "s", "confidence", "created_at", "updated_at")


_NEAR = f"""WITH {sql('drive')}, {_GRID}, k AS (SELECT *, least(greatest(((x - ax) * (bx - ax) + (y - ay) * (by_ - ay)) / (len * len), 0), 1) AS f FROM drive, edges),
d AS (SELECT *, sqrt(pow(x - ax - f * (bx - ax), 2) + pow(y - ay - f * (by_ - ay), 2)) AS d, degrees(atan2(bx - ax, by_ - ay)) AS br FROM k),
n AS (SELECT *, abs(heading - br + 180 - 360 * floor((heading - br + 180) / 360) - 180) > 100 AS away FROM d WHERE d <= 35),
g AS (SELECT *, bool_or(NOT away) OVER (PARTITION BY obs) AS facing FROM n),
c AS (SELECT obs, edge_id, f * len AS s, d, -0.5 * ln(2 * pi() * 25) - d * d / 50 AS emission FROM g WHERE NOT away OR NOT facing)"""


@query(f"{_NEAR} SELECT * FROM (SELECT obs, edge_id, round(s, 6) AS s, round(d, 6) AS d, round(emission, 6) AS emission, cast(row_number() OVER (PARTITION BY obs ORDER BY round(emission, 9) DESC, edge_id) AS int) AS rank FROM c) WHERE rank <= 8")
def candidate_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matching.candidates(adapted(spark, sf_dir, "drive"), graph.segments(graph.grid_edges(adapted(spark, sf_dir, "grid"))))
    return found.select("obs", "edge_id", r6("s"), r6("d"), r6("emission"), "rank")


@query()
def viterbi_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held against a plain decoder in the tests."""
    drive = stored(adapted(spark, sf_dir, "drive"), "drive")
    found = matching.candidates(drive, graph.segments(graph.grid_edges(adapted(spark, sf_dir, "grid"))))
    return matching.matched(drive, found)


@query(f"""WITH {sql('roads')}, a AS (SELECT *, coalesce(width_osm_m, 7) AS m, CASE WHEN u % 3 = 0 THEN u % 9 + cast(2 AS double) END AS sat FROM roads),
b AS (SELECT *, CASE WHEN sat IS NULL THEN m ELSE (m + sat * 4) / 5 END AS w FROM a), c AS (SELECT *, round_even(CASE WHEN oneway THEN w ELSE w / 2 END, 2) AS d FROM b)
SELECT edge_id, d AS width_dir_m, greatest(cast(round_even(d / 3, 0) AS int), 1) AS lanes_effective FROM c""")
def width_fuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = adapted(spark, sf_dir, "roads")
    satellite = edges.where("u % 3 = 0").select("edge_id", F.expr("u % 9 + cast(2 AS double)").alias("width_sat_m"))
    return roads.fused_widths(edges, satellite).select("edge_id", "width_dir_m", "lanes_effective")


@query(f"WITH {sql('obs')} SELECT edge_id, class_name, count(*) AS n, round_even(count(*) / sum(count(*)) OVER (PARTITION BY edge_id), 3) AS share FROM obs GROUP BY edge_id, class_name")
def class_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roads.class_mix(adapted(spark, sf_dir, "obs"))


@query(f"""WITH {sql('truth')}, {sql('recovered')}, x AS (SELECT r.ord AS r, min(g.ord) AS g FROM recovered r JOIN truth g ON r.class_name = g.class_name AND sqrt(pow(r.s - g.s, 2) + pow(r.t - g.t, 2)) <= 3 GROUP BY r.ord),
n AS (SELECT (SELECT count(*) FROM truth) AS n_truth, (SELECT count(*) FROM recovered) AS n_recovered, count(DISTINCT g) AS tp, count(*) AS took FROM x)
SELECT n_truth, n_recovered, tp, n_recovered - took AS fp, n_truth - tp AS fn, took - tp AS duplicates, round(tp / (tp + n_recovered - took), 4) AS precision, round(tp / n_truth, 4) AS recall, round((took - tp) / n_recovered, 4) AS duplicate_rate,
round(2 * round(tp / (tp + n_recovered - took), 4) * round(tp / n_truth, 4) / (round(tp / (tp + n_recovered - took), 4) + round(tp / n_truth, 4)), 4) AS f1 FROM n""")
def anomaly_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roads.recovery(adapted(spark, sf_dir, "truth"), adapted(spark, sf_dir, "recovered"))


def _emitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = "array(named_struct('x', cast(500000 + u % 900 AS double), 'y', cast(2000000 + v % 700 AS double)), named_struct('x', cast(500000 + u % 900 + 30 AS double), 'y', cast(2000000 + v % 700 + 40 AS double)))"
    return roads.fused_widths(adapted(spark, sf_dir, "roads")).withColumn("geometry", F.expr(line))


_WIDE = f"WITH {sql('roads')}, e AS (SELECT *, round_even(CASE WHEN oneway THEN coalesce(width_osm_m, 7) ELSE coalesce(width_osm_m, 7) / 2 END, 2) AS w FROM roads), f AS (SELECT *, greatest(cast(round_even(w / 3, 0) AS int), 1) AS lanes FROM e)"


@query(f"{_WIDE} SELECT edge_id, lanes AS num_lanes, round_even(maxspeed_kph / 3.6, 2) AS speed, round(w / lanes, 2) AS lane_width FROM f")
def edge_emit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emit.edge_rows(_emitted(spark, sf_dir), "lanes").select("edge_id", "num_lanes", "speed", "lane_width")


@query(f"""WITH {sql('ledger')} SELECT concat('hazard_', substr(anomaly_id, 1, 8)) AS id, class_name AS type, CASE class_name WHEN 'pothole' THEN 'red' WHEN 'speed_breaker' THEN 'orange' ELSE 'magenta' END AS color, concat(edge_id, '_0') AS lane, s AS pos, t AS pos_lat,
cast(CASE WHEN class_name = 'pothole' THEN 1 ELSE 3 END AS double) AS width, cast(CASE WHEN class_name = 'pothole' THEN 0.8 ELSE 1 END AS double) AS height FROM ledger""")
def hazard_emit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emit.hazard_rows(adapted(spark, sf_dir, "ledger"))


@query(f"""{_WIDE}, {sql('ledger')}, o AS (SELECT replace(edge_id, 'e', 'r') AS edge_id, count(*) AS n FROM ledger GROUP BY 1) SELECT edge_id, coalesce(length_m, 50) AS length_m, w AS width_m, cast(500000 + u % 900 AS double) AS x, cast(2000000 + v % 700 AS double) AS y,
round(atan2(30, 40), 6) AS hdg, cast(coalesce(n, 0) AS int) AS n_objects FROM f LEFT JOIN o USING (edge_id)""")
def road_emit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = adapted(spark, sf_dir, "ledger").withColumn("edge_id", F.replace("edge_id", F.lit("e"), F.lit("r")))
    return emit.road_rows(_emitted(spark, sf_dir), found).select("edge_id", "length_m", "width_m", "x", "y", r6("hdg"), "n_objects")


@query(f"""WITH {sql('fixes')}, d AS (SELECT *, x - lag(x) OVER w AS bx, y - lag(y) OVER w AS by_, timestamp - lag(timestamp) OVER w AS dt, lead(x, 1, x) OVER w - x AS ax, lead(y, 1, y) OVER w - y AS ay FROM fixes WINDOW w AS (PARTITION BY seq ORDER BY timestamp))
SELECT seq, timestamp, round(coalesce(sqrt(bx * bx + by_ * by_) / CASE WHEN dt <= 1e-4 THEN 0.1 ELSE dt END, 0), 6) AS speed, round(degrees(atan2(ax, ay)) - 360 * floor(degrees(atan2(ax, ay)) / 360), 6) AS heading FROM d""")
def gps_planar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speed by backward, heading by forward difference of planar places."""
    return gps.planar_speed_heading(adapted(spark, sf_dir, "fixes").drop("speed", "heading")).select("seq", "timestamp", r6("speed"), r6("heading"))


@query(f"WITH {sql('drive')} SELECT pass_id, obs FROM (SELECT pass_id, obs, row_number() OVER (PARTITION BY pass_id ORDER BY obs) - 1 AS place FROM drive) WHERE place % 3 = 0 AND place < 60")
def image_subsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each third image of a sequence, the first twenty of them (the operator is a limit)."""
    frames = adapted(spark, sf_dir, "drive").select(F.col("pass_id").alias("sequence_id"), "obs")
    return detections.every_kth(frames, "obs", 3, 20).select(F.col("sequence_id").alias("pass_id"), "obs")


_SEEN = "CASE p_partkey % 4 WHEN 0 THEN 'motorcycle' WHEN 1 THEN 'person' WHEN 2 THEN 'kite' ELSE 'car' END"


@query(f"WITH {sql('tags')}, seen AS (SELECT p_partkey, {_SEEN} AS detector_class FROM tags) SELECT p_partkey, CASE detector_class WHEN 'motorcycle' THEN 'two_wheeler' WHEN 'person' THEN 'pedestrian' ELSE 'car' END AS class_name FROM seen WHERE detector_class <> 'kite'")
def class_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detector classes as local ones, others dropped."""
    return detections.local_classes(adapted(spark, sf_dir, "tags").withColumn("detector_class", F.expr(_SEEN))).select("p_partkey", "class_name")


@query(f"""WITH {sql('grid')}, n AS (SELECT *, CASE WHEN i = 1 AND j = 1 THEN 'traffic_light' ELSE 'priority' END AS type FROM grid)
SELECT node_id, type, printf('    <node id="%d" x="%.3f" y="%.3f" type="%s"/>', node_id, x, y, type) AS xml FROM n""")
def node_emit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emit.node_xml(adapted(spark, sf_dir, "grid").withColumn("highway", F.expr("CASE WHEN i = 1 AND j = 1 THEN 'traffic_signals' END"))).select("node_id", "type", "xml")


@query(f"WITH {_GRID} SELECT count(DISTINCT u) AS n_nodes, count(*) AS n_edges, round(sum(len) / 1000, 3) AS total_length_km FROM edges")
def graph_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.snapshot(graph.grid_edges(adapted(spark, sf_dir, "grid")))


@query(f"WITH {sql('tags')} SELECT p_partkey, coalesce(highway, 'priority') AS highway FROM tags")
def node_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.with_node_defaults(adapted(spark, sf_dir, "tags")).select("p_partkey", "highway")


@query(f"""WITH {sql('lonlat')}, m AS (SELECT avg(lon) AS lon, avg(lat) AS lat FROM lonlat), z AS (SELECT least(greatest(cast(floor((lon + 180) / 6) AS int) + 1, 1), 60) AS zone, lat >= 0 AS north FROM m)
SELECT zone, north, CASE WHEN north THEN 32600 ELSE 32700 END + zone AS epsg FROM z""")
def centroid_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone of the mean node."""
    return geodesy.centroid_zone(adapted(spark, sf_dir, "lonlat"))


_FRAMES = "CASE WHEN ask % 5 <> 0 THEN concat('e', cast(ask % 40 AS string)) END"


@query(f"""WITH {sql('obs')}, {sql('asked')}, m AS (SELECT seq, ask, {_FRAMES} AS edge_id FROM asked), j AS (SELECT m.edge_id, class_name FROM obs JOIN m ON k1 % 8 = seq AND k1 = ask WHERE m.edge_id IS NOT NULL)
SELECT edge_id, class_name, count(*) AS n, round_even(count(*) / sum(count(*)) OVER (PARTITION BY edge_id), 3) AS share FROM j GROUP BY edge_id, class_name""")
def frame_class_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections by the edge of their frame."""
    found = adapted(spark, sf_dir, "obs").select(F.expr("k1 % 8").alias("seq"), F.col("k1").alias("frame_idx"), "class_name")
    matched = adapted(spark, sf_dir, "asked").select("seq", F.col("ask").alias("frame_idx"), F.expr(_FRAMES).alias("edge_id"))
    return roads.frame_class_mix(found, matched)


_NAME = "CASE WHEN ask % 7 = 0 THEN 'left.jpg' ELSE concat(lpad(cast(ask * 3 % 150 AS string), 7, '0'), '.png') END"


@query(f"""WITH {sql('asked')}, {sql('fixes')}, k AS (SELECT seq, cast(timestamp * 2 AS bigint) % 100 AS number, arg_max(timestamp, timestamp) AS known FROM fixes GROUP BY 1, 2)
SELECT a.seq, ask AS frame_idx, coalesce(known, round_even(ask * cast(0.1 AS double), 3)) AS frame_ts FROM asked a LEFT JOIN k ON a.seq = k.seq AND ask % 7 <> 0 AND ask * 3 % 150 = number""")
def image_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images at the log's times by their number, the last of a number's; others by their place."""
    pictures = adapted(spark, sf_dir, "asked").select("seq", F.col("ask").alias("frame_idx"), F.expr(_NAME).alias("name"))
    log = adapted(spark, sf_dir, "fixes").select("seq", F.col("timestamp").alias("row"), F.expr("cast(timestamp * 2 AS bigint) % 100").alias("image_idx"), "timestamp")
    return detections.image_times(pictures, log).select("seq", "frame_idx", "frame_ts")


@query(f"""WITH {sql('fixes')}, d AS (SELECT seq, timestamp, lead(x, 1, x) OVER w - lag(x, 1, x) OVER w AS dx, lead(y, 1, y) OVER w - lag(y, 1, y) OVER w AS dy FROM fixes WINDOW w AS (PARTITION BY seq ORDER BY timestamp))
SELECT seq, timestamp, round(degrees(atan2(dx, dy)) - 360 * floor(degrees(atan2(dx, dy)) / 360), 6) AS bearing FROM d""")
def gradient_bearings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bearings by central differences."""
    points = adapted(spark, sf_dir, "fixes").select(F.col("seq").alias("edge_id"), F.col("timestamp").alias("seq"), "x", "y")
    return graph.gradient_bearings(points).select(F.col("edge_id").alias("seq"), F.col("seq").alias("timestamp"), r6("bearing"))


@query(f"""WITH {sql('roads')} SELECT edge_id, concat('LINESTRING (', cast(cast(500000 + u % 900 AS double) AS string), ' ', cast(cast(2000000 + v % 700 AS double) AS string), ', ', cast(cast(500030 + u % 900 AS double) AS string), ' ', cast(cast(2000040 + v % 700 AS double) AS string), ')') AS geometry_wkt,
2 AS n_points, cast(500030 + u % 900 AS double) AS last_x, cast(50 AS double) AS length FROM roads""")
def edge_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines to text and back."""
    layer = stores.to_wkt(_emitted(spark, sf_dir))
    back = stores.from_wkt(layer.withColumn("text", F.col("geometry_wkt")))
    return back.select("edge_id", F.col("text").alias("geometry_wkt"), F.size("geometry").alias("n_points"), F.element_at("geometry", -1)["x"].alias("last_x"), graph.polyline_length(F.col("geometry")).alias("length"))


@query()
def fusion_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole core: detections of eight drives over a grid to a ledger of canonical anomalies."""
    drive = adapted(spark, sf_dir, "drive").withColumn("frame_ts", F.floor(F.col("obs") / 8) / 2)
    log = drive.select(F.col("pass_id").alias("seq"), F.col("frame_ts").alias("timestamp"), "x", "y", F.lit(12.0).alias("speed"), "heading")
    found = drive.select(F.col("pass_id").alias("seq"), "obs", (F.col("frame_ts") + 0.1).alias("frame_ts"), F.expr("cast(600 + obs * 37 % 700 AS double)").alias("u"), F.expr("cast(600 + obs * 13 % 300 AS double)").alias("v"), F.expr("CASE obs % 3 WHEN 0 THEN 'pothole' WHEN 1 THEN 'speed_breaker' ELSE 'car' END").alias("class_name"), F.lit(0.8).alias("conf"), F.expr("CASE WHEN obs % 4 = 0 THEN -1 ELSE obs % 40 END").alias("track_id"))
    return fusion.run(found, log, graph.grid_edges(adapted(spark, sf_dir, "grid")))[1]


flagship = fusion_ledger
