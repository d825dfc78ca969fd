"""Simulator files: rows as text columns (distributed), whole files on the driver, validation."""

from __future__ import annotations

import hashlib
import json
import math
import xml.etree.ElementTree as ET
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadweave.functions.geodesy import from_utm

DEFAULT_SPEED, DEFAULT_WIDTH = 40.0, 7.0
SCHEMA_URL = "http://sumo.dlr.de/xsd/"

# The vehicle types of the scenario.
VEHICLE_TYPES = (
    {"id": "two_wheeler", "vClass": "motorcycle", "length": "1.9", "width": "0.7", "height": "1.2", "minGap": "1.0", "minGapLat": "0.2", "latAlignment": "arbitrary", "maxSpeed": "22.2", "accel": "3.5", "decel": "4.5", "color": "red"},
    {"id": "auto_rickshaw", "vClass": "passenger", "length": "2.7", "width": "1.4", "height": "1.8", "minGap": "1.2", "minGapLat": "0.3", "latAlignment": "arbitrary", "maxSpeed": "13.9", "accel": "2.2", "decel": "3.5", "color": "yellow"},
    {"id": "car", "vClass": "passenger", "length": "4.2", "width": "1.7", "height": "1.5", "minGap": "2.0", "minGapLat": "0.4", "latAlignment": "center", "maxSpeed": "27.8", "accel": "2.6", "decel": "4.5", "color": "white"},
    {"id": "bus", "vClass": "bus", "length": "10.5", "width": "2.5", "height": "3.2", "minGap": "2.5", "minGapLat": "0.6", "latAlignment": "center", "maxSpeed": "16.7", "accel": "1.2", "decel": "3.0", "color": "blue"},
    {"id": "truck", "vClass": "truck", "length": "9.0", "width": "2.5", "height": "3.5", "minGap": "2.5", "minGapLat": "0.6", "latAlignment": "center", "maxSpeed": "16.7", "accel": "1.0", "decel": "2.8", "color": "cyan"},
    {"id": "bicycle", "vClass": "bicycle", "length": "1.8", "width": "0.6", "height": "1.1", "minGap": "0.8", "minGapLat": "0.2", "latAlignment": "arbitrary", "maxSpeed": "5.5", "accel": "1.5", "decel": "3.0", "color": "green"},
)


def escaped(text: Column) -> Column:
    """For an attribute's value."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def wkt(geometry: Column) -> Column:
    return F.concat(F.lit("LINESTRING ("), F.concat_ws(", ", F.transform(geometry, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))), F.lit(")"))


def points(text: Column) -> Column:
    """The points of a line string, null for any other text."""
    pairs = F.split(F.regexp_extract(text, r"^\s*LINESTRING\s*\(([^()]+)\)\s*$", 1), r"\s*,\s*")
    xy = lambda p: F.split(F.trim(p), r"\s+")
    return F.when(text.rlike(r"^\s*LINESTRING\s*\([^()]+\)\s*$"), F.transform(pairs, lambda p: F.struct(F.get(xy(p), 0).try_cast("double").alias("x"), F.get(xy(p), 1).try_cast("double").alias("y"))))


def edge_rows(edges: DataFrame, mode: str = "collapse") -> DataFrame:
    """``edge_id``, lanes, speed and lane width; ``mode`` collapse makes one wide lane, lanes splits the width."""
    wide = F.coalesce("width_dir_m", "width_osm_m", F.lit(DEFAULT_WIDTH))
    n = F.greatest(F.coalesce(F.col("lanes_effective").cast("int"), F.lit(1)), F.lit(1))
    num, lane = (F.lit(1), F.greatest(wide, F.lit(3.5))) if mode == "collapse" else (n, F.bround(wide / n, 2))
    kept = edges.where("u IS NOT NULL AND v IS NOT NULL AND cast(u AS string) <> '' AND cast(v AS string) <> ''")
    return kept.select("edge_id", "u", "v", num.alias("num_lanes"), F.bround(F.coalesce("maxspeed_kph", F.lit(DEFAULT_SPEED)) / 3.6, 2).alias("speed"), lane.alias("lane_width"), "geometry")


def edge_xml(edges: DataFrame, mode: str = "collapse") -> DataFrame:
    shape = F.concat_ws(" ", F.transform("geometry", lambda p: F.format_string("%.2f,%.2f", p["x"], p["y"])))
    a = lambda c: escaped(F.col(c).cast("string"))
    tag = F.concat(F.lit('    <edge id="'), a("edge_id"), F.lit('" from="'), a("u"), F.lit('" to="'), a("v"), F.format_string('" numLanes="%d" speed="%s" width="%.2f"', "num_lanes", F.col("speed").cast("string"), "lane_width"), F.when(shape != "", F.concat(F.lit(' shape="'), shape, F.lit('"'))).otherwise(""), F.lit("/>"))
    return edge_rows(edges, mode).select("edge_id", tag.alias("xml"))


def node_xml(nodes: DataFrame) -> DataFrame:
    light = F.when(F.lower(F.coalesce("highway", F.lit(""))).contains("traffic_signals"), "traffic_light").otherwise("priority")
    return nodes.select("node_id", light.alias("type"), F.concat(F.lit('    <node id="'), F.col("node_id").cast("string"), F.format_string('" x="%.3f" y="%.3f" type="', F.col("x"), F.col("y")), light, F.lit('"/>')).alias("xml"))


def hazard_rows(anomalies: DataFrame) -> DataFrame:
    """One point of interest an anomaly."""
    cls = F.lower(F.coalesce("class_name", F.lit("pothole")))
    hole = cls.contains("pothole")
    colour = F.when(hole, "red").when(cls.contains("speed_breaker"), "orange").otherwise("magenta")
    return anomalies.select(F.concat(F.lit("hazard_"), F.substring("anomaly_id", 1, 8)).alias("id"), cls.alias("type"), colour.alias("color"), F.concat(F.col("edge_id"), F.lit("_0")).alias("lane"), F.col("s").alias("pos"), F.col("t").alias("pos_lat"), F.when(hole, 1.0).otherwise(3.0).alias("width"), F.when(hole, 0.8).otherwise(1.0).alias("height"))


def hazard_xml(anomalies: DataFrame) -> DataFrame:
    row = F.format_string('    <poi id="%s" type="%s" color="%s" lane="%s" pos="%.2f" posLat="%.2f" width="%.2f" height="%.2f" layer="2"/>', escaped(F.col("id")), escaped(F.col("type")), "color", escaped(F.col("lane")), "pos", "pos_lat", "width", "height")
    return hazard_rows(anomalies).select("id", row.alias("xml"))


def road_rows(edges: DataFrame, anomalies: DataFrame) -> DataFrame:
    """One straight road an edge, numbered by ``edge_id``, with its obstacles in order of ``s``."""
    objects = anomalies.groupBy("edge_id").agg(F.sort_array(F.collect_list(F.struct("s", "t", "class_name"))).alias("objects"))
    p, q = F.get("geometry", 0), F.get("geometry", 1)
    known = q.isNotNull()
    heading = F.when(known, F.pmod(F.atan2(q["x"] - p["x"], q["y"] - p["y"]), F.lit(2 * math.pi))).otherwise(0.0)
    rows = edges.join(objects, "edge_id", "left")
    return rows.select("edge_id", F.coalesce("length_m", F.lit(50.0)).alias("length_m"), F.coalesce("width_dir_m", F.lit(DEFAULT_WIDTH)).alias("width_m"), F.when(known, p["x"]).otherwise(500000.0).alias("x"), F.when(known, p["y"]).otherwise(2000000.0).alias("y"), heading.alias("hdg"), F.coalesce(F.size("objects"), F.lit(0)).alias("n_objects"), "objects")


def road_xml(edges: DataFrame, anomalies: DataFrame) -> DataFrame:
    """``road_id`` and the element; ids need one global order, so edges (not observations) pass through one window."""
    one = lambda o, k: F.format_string('            <object id="%d" type="obstacle" name="%s" s="%.3f" t="%.3f" zOffset="0.000" validLength="0.800" width="1.000" length="0.800" hdg="0.000" pitch="0.000" roll="0.000"/>', k + 1, escaped(o["class_name"]), o["s"], o["t"])
    rows = road_rows(edges, anomalies).withColumn("road_id", F.row_number().over(Window.orderBy("edge_id")))
    body = F.when(F.col("n_objects") > 0, F.concat(F.lit("        <objects>\n"), F.concat_ws("\n", F.transform("objects", one)), F.lit("\n        </objects>"))).otherwise("        <objects/>")
    head = F.format_string('    <road name="%s" length="%.3f" id="%d" junction="-1" rule="LHT">\n        <link/>\n        <planView><geometry s="0.000" x="%.3f" y="%.3f" hdg="%.4f" length="%.3f"><line/></geometry></planView>\n        <lanes><laneSection s="0.000"><center><lane id="0" type="none" level="false"/></center><left><lane id="1" type="driving" level="false"><width sOffset="0.000" a="%.3f" b="0.0" c="0.0" d="0.0"/></lane></left></laneSection></lanes>\n', escaped(F.col("edge_id")), "length_m", "road_id", "x", "y", "hdg", "length_m", "width_m")
    return rows.select("road_id", F.concat(head, body, F.lit("\n    </road>")).alias("xml"))


def anomaly_points(edges: DataFrame, anomalies: DataFrame, zone: int, north: bool = True) -> DataFrame:
    """``lon``, ``lat`` of each anomaly on its edge's line at the fraction ``s`` of its length; ``t`` plays no part."""
    from roadweave.operators.graph import segments

    pieces = segments(edges)
    total = pieces.groupBy("edge_id").agg(F.max(F.col("s0") + F.col("len")).alias("total"))
    at = anomalies.join(edges.select("edge_id", "length_m"), "edge_id").join(total, "edge_id")
    at = at.withColumn("place", F.least(F.greatest(F.col("s") / F.greatest(F.col("length_m"), F.lit(1.0)), F.lit(0.0)), F.lit(1.0)) * F.col("total"))
    met = at.join(pieces, "edge_id").where((F.col("place") >= F.col("s0")) & (F.col("place") <= F.col("s0") + F.col("len")))
    f = (F.col("place") - F.col("s0")) / F.col("len")
    spot = F.min(F.struct("seg", (F.col("ax") + f * (F.col("bx") - F.col("ax"))).alias("x"), (F.col("ay") + f * (F.col("by") - F.col("ay"))).alias("y"))).alias("p")
    lon, lat = from_utm(F.col("p.x"), F.col("p.y"), zone, north)
    return met.groupBy("anomaly_id", "edge_id", "class_name").agg(spot).select("anomaly_id", "edge_id", "class_name", lon.alias("lon"), lat.alias("lat"))


def preview(edges: DataFrame, anomalies: DataFrame, zone: int, north: bool = True) -> DataFrame:
    """GeoJSON features, edges first, in geographic coordinates."""
    pair = lambda p: F.array(*from_utm(p["x"], p["y"], zone, north))
    line = F.struct(F.lit("Feature").alias("type"), F.struct("edge_id", "width_dir_m", "lanes_effective").alias("properties"), F.struct(F.lit("LineString").alias("type"), F.transform("geometry", pair).alias("coordinates")).alias("geometry"))
    dot = F.struct(F.lit("Feature").alias("type"), F.struct("anomaly_id", "edge_id", "class_name").alias("properties"), F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"))
    first = edges.select(F.lit(0).alias("part"), F.col("edge_id").alias("id"), F.to_json(line).alias("feature"))
    return first.unionByName(anomaly_points(edges, anomalies, zone, north).select(F.lit(1).alias("part"), F.col("anomaly_id").alias("id"), F.to_json(dot).alias("feature")))


def write_atomic(path: str | Path, text: str) -> Path:
    """Through a sibling file, so that readers never see half of it."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f".{path.name}.part")
    part.write_text(text, encoding="utf-8")
    part.replace(path)
    return path


def wrapped(rows: DataFrame, order: list[str], column: str, head: str, tail: str, glue: str = "\n") -> str:
    """A whole file's text. A simulator's file is one file, so its rows come to the driver, one at a time."""
    return head + glue.join(r[0] for r in rows.orderBy(*order).select(column).toLocalIterator()) + tail


def vehicle_types_xml(types: tuple[dict, ...] = VEHICLE_TYPES) -> str:
    rows = "\n".join("    <vType " + " ".join(f'{k}="{v}"' for k, v in t.items()) + "/>" for t in types)
    return f'<?xml version="1.0" encoding="UTF-8"?>\n<additional>\n{rows}\n</additional>'


def scenario_config(routes: str | None = None, lateral: float = 0.6, step: float = 0.1) -> str:
    route = f'<route-files value="{routes}"/>' if routes else ""
    return (
        f'<?xml version="1.0" encoding="UTF-8"?>\n<configuration>\n    <input><net-file value="network.net.xml"/>{route}<additional-files value="vtypes.add.xml,anomalies.add.xml"/></input>\n'
        f'    <processing><lateral-resolution value="{lateral:.2f}"/><step-length value="{step:.2f}"/><collision.action value="warn"/><collision.stoptime value="2"/></processing>\n    <time><begin value="0"/></time>\n</configuration>'
    )


def scenario(directory: str | Path, nodes: DataFrame, edges: DataFrame, anomalies: DataFrame, zone: int, north: bool = True, mode: str = "collapse") -> dict[str, str]:
    """Writes the bundle and its manifest; returns name to SHA-256."""
    top, xml = Path(directory), '<?xml version="1.0" encoding="UTF-8"?>\n'
    proj = f"+proj=utm +zone={zone} +{'north' if north else 'south'} +datum=WGS84 +units=m +no_defs"
    texts = {
        "plain.nod.xml": wrapped(node_xml(nodes), ["node_id"], "xml", f"{xml}<nodes>\n", "\n</nodes>"),
        "plain.edg.xml": wrapped(edge_xml(edges, mode), ["edge_id"], "xml", f"{xml}<edges>\n", "\n</edges>"),
        "anomalies.add.xml": wrapped(hazard_xml(anomalies), ["id", "xml"], "xml", f"{xml}<additional>\n", "\n</additional>"),
        "vtypes.add.xml": vehicle_types_xml(),
        "network.net.xml": f"{xml}<net/>",  # a stand-in where the network compiler is not installed
        "network.xodr": wrapped(road_xml(edges, anomalies), ["road_id"], "xml", f'{xml}<OpenDRIVE>\n    <header revMajor="1" revMinor="6" name="network" version="1.0"><geoReference><![CDATA[{proj}]]></geoReference></header>\n', "\n</OpenDRIVE>"),
        "preview.geojson": wrapped(preview(edges, anomalies, zone, north), ["part", "id"], "feature", '{"type":"FeatureCollection","features":[', "]}", ","),
        "scenario.sumocfg": scenario_config("routes.rou.xml" if (top / "routes.rou.xml").exists() else None),
        "ATTRIBUTION.md": "Road data: OpenStreetMap contributors, Open Database License.\n",
    }
    sums = {name: hashlib.sha256(write_atomic(top / name, text).read_bytes()).hexdigest() for name, text in texts.items()}
    write_atomic(top / "MANIFEST.json", json.dumps({"files": sums, "utm_zone": zone}, indent=2))
    return sums


def add_facts(directory: str | Path, facts: dict) -> dict:
    """The manifest with more facts in it, which is returned."""
    path = Path(directory) / "MANIFEST.json"
    manifest = json.loads(path.read_text()) | facts
    write_atomic(path, json.dumps(manifest, indent=2))
    return manifest


def report(directory: str | Path) -> str:
    """What the manifest names and whether it is there unchanged, and its counts."""
    top = Path(directory)
    manifest = json.loads((top / "MANIFEST.json").read_text())
    files = manifest["files"]
    state = lambda n, h: "missing" if not (top / n).exists() else "ok" if hashlib.sha256((top / n).read_bytes()).hexdigest() == h else "changed"
    return "\n".join([*(f"{n}: {state(n, h)}" for n, h in files.items()), *(f"{k} = {v}" for k, v in manifest.get("statistics", {}).items())])


def validate_roads(path: str | Path) -> tuple[bool, list[str], list[str]]:
    """Verdict, errors and warnings on an OpenDRIVE file."""
    errors, warnings = [], []
    try:
        root = ET.parse(path).getroot()
    except (ET.ParseError, OSError) as e:
        return False, [str(e)], []
    if root.tag != "OpenDRIVE":
        errors.append(f"root is {root.tag}")
    header = root.find("header")
    if header is None:
        errors.append("no header")
    elif not (header.findtext("geoReference") or "").strip():
        warnings.append("no geoReference")
    roads = root.findall("road")
    if not roads:
        warnings.append("no roads")
    for road in roads:
        if road.get("rule") != "LHT":
            errors.append(f"road {road.get('id')}: rule is not LHT")
        if road.find("planView/geometry") is None:
            errors.append(f"road {road.get('id')}: no geometry")
    return not errors, errors, warnings


def validate_scenario(path: str | Path) -> tuple[bool, list[str], list[str]]:
    """Verdict, errors and warnings on a scenario's configuration."""
    errors, warnings = [], []
    try:
        root = ET.parse(path).getroot()
    except (ET.ParseError, OSError) as e:
        return False, [str(e)], []
    lateral = root.find(".//lateral-resolution")
    if lateral is None or float(lateral.get("value", 0)) <= 0:
        errors.append("no lateral resolution")
    net = root.find(".//net-file")
    if net is None:
        errors.append("no net file")
    elif not (Path(path).parent / net.get("value", "")).exists():
        warnings.append("the net file is missing")
    return not errors, errors, warnings
