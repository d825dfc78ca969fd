"""Stand-ins for detections, logs and graphs, made from the driver's tables by integer rules.

Each is one table and an expression a column, in SQL that Spark and DuckDB read alike, so that a query and the SQL it is
held against start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadweave.runtime import attach

_CLASS = "CASE {} % 5 WHEN 0 THEN 'pothole' WHEN 1 THEN 'speed_breaker' WHEN 2 THEN 'car' WHEN 3 THEN 'barrier' ELSE 'bus' END"
_KEY = {"k1": "l_orderkey", "k2": "l_linenumber", "k3": "l_partkey", "k4": "l_extendedprice"}

ADAPTERS: dict[str, tuple[str, dict[str, str]]] = {
    "det": ("lineitem", _KEY | {
        "u": "cast(360 + (l_partkey * 37 + l_linenumber * 11) % 1200 AS double)", "v": "cast(560 + (l_orderkey * 13 + l_linenumber * 7) % 900 AS double)",
        "class_name": _CLASS.format("l_partkey"), "conf": "(25 + l_quantity) / 100", "track_id": "CASE WHEN l_linenumber > 4 THEN -1 ELSE l_orderkey % 50 END",
    }),
    "boxes": ("lineitem", _KEY | {
        "frame_idx": "l_orderkey - 3", "frame_ts": "(l_orderkey * 3 + l_linenumber) % 500 / 10", "conf": "(15 + l_quantity * 2) / 100",
        "x1": "cast(l_partkey % 1900 - 10 AS double)", "y1": "cast(l_suppkey * 7 % 1000 AS double)", "x2": "cast(l_partkey % 1900 + l_linenumber * 20 - 30 AS double)", "y2": "cast(l_suppkey * 7 % 1000 + 60 AS double)",
        "img_w": "1920", "img_h": "1080",
    }),
    "obs": ("lineitem", _KEY | {
        "edge_id": "concat('e', cast(l_orderkey % 40 AS string))", "class_name": _CLASS.format("l_partkey"), "track_id": "CASE WHEN l_linenumber > 4 THEN -1 ELSE l_orderkey % 50 END",
        "s": "(l_orderkey * 17 + l_linenumber * 29) % 1000 / 10", "t": "l_partkey % 60 / 10 - 3", "var_s": "(l_linenumber * 7 + l_partkey) % 20 / 100", "var_t": "(l_linenumber + l_partkey * 3) % 9 / 1000", "conf": "(25 + l_quantity) / 100",
    }),
    "fixes": ("events", {
        "seq": "event_id % 8", "timestamp": "floor(event_id / 8) / 2", "x": "cast(500000 + event_id * 6 % 800 AS double)", "y": "cast(2000000 + event_id * 11 % 800 AS double)",
        "lon": "78 + event_id * 7 % 100 / 1000", "lat": "17 + event_id * 3 % 90 / 1000", "speed": "cast(event_id % 50 AS double)", "heading": "cast(event_id * 53 % 360 AS double)",
    }),
    "asked": ("orders", {"seq": "o_orderkey % 8", "ask": "o_orderkey", "frame_ts": "o_orderkey * 7 % 7000 / 10 - 5"}),
    "lonlat": ("events", {"event_id": "event_id", "lon": "72 + event_id * 13 % 1800 / 100", "lat": "event_id * 29 % 1200 / 100 - 40"}),
    "grid": ("nation", {"node_id": "1001 + n_nationkey", "i": "cast(floor(n_nationkey / 5) AS int)", "j": "n_nationkey % 5", "x": "cast(500000 + 200 * (n_nationkey % 5) AS double)", "y": "cast(2000000 + 200 * floor(n_nationkey / 5) AS double)"}),
    "tags": ("part", {
        "p_partkey": "p_partkey", "highway": "CASE p_size % 6 WHEN 0 THEN ' Primary' WHEN 1 THEN 'residential' WHEN 2 THEN 'trunk_link' WHEN 3 THEN 'service' WHEN 4 THEN NULL ELSE 'motorway' END",
        "lanes": "CASE p_size % 7 WHEN 0 THEN '2' WHEN 1 THEN '3;2' WHEN 2 THEN '2.5' WHEN 3 THEN 'two' WHEN 4 THEN '0' WHEN 5 THEN NULL ELSE '4' END",
        "maxspeed": "CASE p_size % 8 WHEN 0 THEN '50 km/h' WHEN 1 THEN '60' WHEN 2 THEN '30 mph' WHEN 3 THEN 'walk' WHEN 4 THEN '5' WHEN 5 THEN NULL WHEN 6 THEN '200' ELSE '25mph' END",
        "width": "CASE p_size % 6 WHEN 0 THEN '7.5 m' WHEN 1 THEN '7.5 meters' WHEN 2 THEN '6' WHEN 3 THEN '7.5d' WHEN 4 THEN NULL ELSE '90' END",
        "oneway": "CASE p_size % 4 WHEN 0 THEN 'yes' WHEN 1 THEN '-1' WHEN 2 THEN 'no' ELSE NULL END", "surface": "CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN 'paved' ELSE NULL END",
    }),
    "roads": ("part", {"edge_id": "concat('r', cast(p_partkey AS string))", "u": "p_partkey", "v": "p_partkey + 1", "length_m": "CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 10 = 1 THEN cast(0 AS double) ELSE p_size / 2 END", "geometry_length_m": "CASE WHEN p_size % 20 = 0 THEN NULL ELSE p_size / 2 END", "width_osm_m": "CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_size % 12 + cast(3 AS double) END", "oneway": "p_size % 2 = 0", "maxspeed_kph": "p_size + 10"}),
    "links": ("part", {"u": "p_partkey - p_partkey % 7", "v": "p_partkey + CASE WHEN p_partkey % 50 = 0 THEN 7 ELSE 0 END"}),
    "ledger": ("part", {
        "anomaly_id": "concat('a', cast(p_partkey AS string))", "edge_id": "concat('e', cast(p_partkey % 20 AS string))", "class_name": _CLASS.format("p_partkey"), "s": "cast(p_partkey * 20 AS double)", "t": "p_size % 5 - cast(2 AS double)",
        "var_s": "p_size % 4 / 5", "var_t": "p_size % 3 / 10", "confidence": "(30 + p_size) / 100", "observation_count": "cast(p_size % 6 + 1 AS bigint)", "state": "CASE WHEN p_size % 6 >= 4 THEN 'CONFIRMED' ELSE 'CANDIDATE' END",
    }),
    "news": ("part", {
        "anomaly_id": "concat('n', cast(p_partkey AS string))", "edge_id": "concat('e', cast(p_partkey % 20 AS string))", "class_name": _CLASS.format("p_partkey"), "s": "p_partkey * 20 + p_size % 7 / 4", "t": "p_size % 5 - cast(2 AS double) + p_size % 3 / 5",
        "var_s": "(p_size % 5 + 1) / 5", "var_t": "(p_size % 2 + 1) / 10", "confidence": "(40 + p_size) / 100", "observation_count": "cast(1 AS bigint)", "state": "'CANDIDATE'",
    }),
    "drive": ("events", {"pass_id": "event_id % 8", "obs": "event_id", "x": "cast(500000 + floor(event_id / 8) * 6 % 800 AS double)", "y": "2000000 + 200 * (event_id % 5) + floor(event_id / 8) * 7 % 50 - cast(8 AS double)", "heading": "cast(90 + floor(event_id / 8) * 13 % 9 - 4 AS double)"}),
    "truth": ("supplier", {"ord": "s_suppkey", "class_name": _CLASS.format("s_suppkey"), "s": "cast(s_suppkey * 10 AS double)", "t": "cast(0 AS double)"}),
    "recovered": ("part", {"ord": "p_partkey", "class_name": _CLASS.format("p_partkey"), "s": "p_partkey * 10 + p_size % 5 - cast(1 AS double)", "t": "p_size % 3 / 2"}),
}


def adapted(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns = ADAPTERS[name]
    return attach(spark).read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet").selectExpr(*(f"{e} AS {c}" for c, e in columns.items()))


def sql(name: str) -> str:
    """The same rows, as the body of a common table expression."""
    table, columns = ADAPTERS[name]
    return f"{name} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {table})"
