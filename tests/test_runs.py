import io
import json
import logging
import math

import pytest
from pyspark.sql import functions as F

from roadweave import log as events
from roadweave.functions import camera, geodesy
from roadweave.operators import detections, emit, graph, roads
from roadweave.plans import runs
from roadweave.sources import readers, stores

LEDGER = "anomaly_id string, edge_id string, class_name string, s double, t double, var_s double, var_t double, confidence double, observation_count long, state string, created_at int, updated_at int"


@pytest.fixture
def shared(tmp_path):
    return f"file://{tmp_path}/data"


def test_retries_then_fallback():
    pauses, tries = [], []

    def fails():
        tries.append(1)
        raise OSError("no network")

    assert stores.with_retries(fails, lambda: "grid", sleep=pauses.append) == "grid"
    assert len(tries) == 4 and pauses == [1.5, 2.25, 3.375]
    with pytest.raises(OSError):
        stores.with_retries(fails, attempts=1)
    assert stores.with_retries(lambda: 5, fails) == 5


def test_graph_round_trip(spark, shared):
    nodes, edges = graph.grid(spark, (500000.0, 2000000.0, 500200.0, 2000200.0))
    facts = stores.write_graph(nodes, edges, f"{shared}/graph", 44)
    n, e = stores.read_graph(spark, f"{shared}/graph")
    assert (facts["n_nodes"], facts["n_edges"], facts["utm_epsg"]) == (9, 24, 32644)
    assert json.loads(stores.read_text(spark, f"{shared}/graph/snapshot.json")) == facts
    assert n.where("highway = 'priority'").count() == 8 and n.where("lon BETWEEN 80.9 AND 81.1 AND lat BETWEEN 18 AND 18.2").count() == 9
    key = lambda df: sorted((r.edge_id, tuple((p.x, p.y) for p in r.geometry), r.length_m) for r in df.collect())
    assert key(e) == key(edges)


def test_empty_tables_keep_their_columns(spark, shared):
    nodes, edges = graph.grid(spark, (0.0, 0.0, 1.0, 1.0))
    facts = stores.write_graph(nodes.limit(0), edges.limit(0), f"{shared}/graph", 44)
    n, e = stores.read_graph(spark, f"{shared}/graph")
    assert facts["n_edges"] == 0 and n.count() == e.count() == 0 and "geometry" in e.columns
    stores.write_scenario_tables(roads.fused_widths(e), spark.createDataFrame([], LEDGER), f"{shared}/tables")
    wide, anomalies = stores.read_scenario_tables(spark, f"{shared}/tables")
    assert wide.count() == anomalies.count() == 0 and "width_dir_m" in wide.columns and "sigma_s" in anomalies.columns


def test_projection_of_a_graph(spark):
    nodes = spark.createDataFrame([(1, 78.0, 17.0), (2, 78.01, 17.0), (3, 77.99, -1.0)], "node_id long, lon double, lat double")
    out = stores.projected_nodes(nodes).collect()
    assert {(r.zone, r.north) for r in out} == {(44, True)}
    edges = spark.range(1).select(F.array(*(F.struct(F.lit(x).alias("x"), F.lit(17.0).alias("y")) for x in (78.0, 78.01))).alias("geometry"))
    line = stores.projected_edges(edges, 44).first()
    at = {r.node_id: (r.x_utm, r.y_utm) for r in out}
    assert [(p.x, p.y) for p in line.geometry] == [at[1], at[2]] and line.length_m == pytest.approx(math.dist(at[1], at[2]))
    back = spark.range(1).select(*(c.alias(k) for k, c in zip(("lon", "lat"), geodesy.from_utm(F.lit(at[1][0]), F.lit(at[1][1]), 44), strict=True))).first()
    assert (back.lon, back.lat) == (pytest.approx(78.0, abs=1e-8), pytest.approx(17.0, abs=1e-8))


def test_ledger_versions(spark, shared):
    row = lambda i, s, at: (i, "e", "pothole", s, 0.0, 1.0, 1.0, 0.7, 1, "CANDIDATE", at, at)
    assert stores.current_ledger(spark, f"{shared}/ledger") is None
    stores.commit_ledger(spark.createDataFrame([row("a", 1.0, 1), row("b", 2.0, 1)], LEDGER), f"{shared}/ledger")
    moved = spark.createDataFrame([row("b", 5.0, 2), row("c", 3.0, 2)], LEDGER).withColumn("edge_id", F.lit("other"))
    stores.commit_ledger(moved, f"{shared}/ledger")
    got = sorted((r.anomaly_id, r.edge_id, r.s, r.created_at, r.updated_at) for r in stores.current_ledger(spark, f"{shared}/ledger").collect())
    assert got == [("a", "e", 1.0, 1, 1), ("b", "e", 5.0, 1, 2), ("c", "other", 3.0, 2, 2)]

    class Broken(Exception):
        pass

    old = stores.write_text
    stores.write_text = lambda *a: (_ for _ in ()).throw(Broken())
    try:
        with pytest.raises(Broken):
            stores.commit_ledger(moved.limit(0), f"{shared}/ledger")
    finally:
        stores.write_text = old
    assert stores.current_ledger(spark, f"{shared}/ledger").count() == 3


def test_detections_and_observations_round_trip(spark, shared):
    one = spark.createDataFrame([("d", 1, 0.1, "car", 0.9, 1.0, 1.0, 5.0, 5.0, 3.0, 5.0, 1920, 1080, -1, "m", 7)], readers.DETECTIONS + ", extra int")
    readers.write_detections(one, f"{shared}/found")
    assert readers.detections(spark, f"{shared}/found").collect() == one.drop("extra").collect()
    readers.write_detections(one.limit(0), f"{shared}/none")
    assert readers.detections(spark, f"{shared}/none").count() == 0
    placed = spark.createDataFrame([("d", 5, 0.1, "e", "car", 0.9, 1.0, 2.0, 0.1, 0.2)], "seq string, obs long, frame_ts double, edge_id string, class_name string, conf double, s double, t double, sigma_s double, sigma_t double")
    for _ in range(2):
        readers.append_observations(runs.observation_rows(placed), f"{shared}/observations")
    kept = spark.read.parquet(f"{shared}/observations")
    assert kept.count() == 2 and kept.columns == [c.split()[0] for c in readers.OBSERVATIONS.split(", ")] and kept.first().frame_idx == 5


def test_drives_and_their_logs(spark, tmp_path, shared):
    for name, file in (("d1", "train.csv"), ("d0", "train.csv"), ("d2", "gps.csv")):
        (tmp_path / name).mkdir()
        (tmp_path / name / file).write_text("Time,Latitude,Longitude\n5.0,17.0,78.0\n7.0,17.0002,78.0\n6.0,17.0001,78.0\n")
    (tmp_path / "empty").mkdir()
    root = f"file://{tmp_path}"
    assert stores.sequences(spark, root) == ["d0", "d1"] and stores.gps_file(spark, f"{root}/d2").endswith("gps.csv")
    with pytest.raises(FileNotFoundError):
        stores.gps_file(spark, f"{root}/empty")
    log = stores.ingest_gps(spark, f"{root}/d0", f"{shared}/gps")
    assert [(r.timestamp, r.lat, r.heading) for r in log.orderBy("timestamp").collect()] == [(0.0, 17.0, 0.0), (1.0, 17.0001, 0.0), (2.0, 17.0002, 0.0)]


def test_image_names(spark, tmp_path):
    for name in ("0000010.jpg", "0000020.png", "x.jpg", "notes.txt"):
        (tmp_path / name).write_bytes(b"x")
    found = stores.images(spark, f"file://{tmp_path}")
    assert sorted(r.name for r in found.collect()) == ["0000010.jpg", "0000020.png", "x.jpg"]
    log = spark.createDataFrame([("d", 0, 10, 1.0), ("d", 1, 10, 2.0), ("d", 2, None, 9.0)], "seq string, row int, image_idx int, timestamp double")
    times = detections.image_times(found.select(F.lit("d").alias("seq"), "name", F.lit(3).alias("frame_idx")), log)
    assert {r.name: r.frame_ts for r in times.collect()} == {"0000010.jpg": 2.0, "0000020.png": 0.3, "x.jpg": 0.3}


def test_rig_files(tmp_path):
    nested = {"camera": {"fx": 1000, "image_width": 1280}, "mounting": {"height_m": 2, "yaw_deg": 3}, "processing_gates": {"pixel_sigma_v": 4, "max_range_m": 25}}
    rig = camera.Rig.from_config(nested)
    assert (rig.fx, rig.height_m, rig.yaw_deg, rig.sigma_v_px, rig.max_range_m, rig.fy) == (1000.0, 2.0, 3.0, 4.0, 25.0, 1380.0)
    assert camera.Rig.from_config({"fx": 7}).fx == 7.0 and camera.Rig.from_config({}) == camera.Rig()
    pytest.importorskip("yaml")
    (tmp_path / "rig.yaml").write_text("mounting:\n  pitch_deg: -3.5\n")
    assert camera.Rig.from_yaml(tmp_path / "rig.yaml").pitch_deg == -3.5


@pytest.mark.parametrize("yaw,roll", [(0.0, 0.0), (4.0, 0.0), (0.0, 3.0), (-5.0, 2.0)])
def test_pixels_of_turned_rigs_come_back(spark, yaw, roll):
    rig = camera.Rig(yaw_deg=yaw, roll_deg=roll)
    ground = spark.createDataFrame([(6.0, -1.0), (12.0, 2.0), (25.0, 0.0)], "ahead double, beside double")
    u, v = camera.pixel(F.col("ahead"), F.col("beside"), rig)
    for r in detections.projected(ground.withColumns({"u": u, "v": v}), rig).collect():
        assert (r.X, r.Y) == (pytest.approx(r.ahead, abs=1e-6), pytest.approx(r.beside, abs=1e-6)) and r.valid


def test_events_have_codes():
    out, handlers = io.StringIO(), events.LOG.handlers[:]
    events.LOG.handlers[:] = []
    try:
        events.configure(stream=out)
        events.configure(stream=out)
        events.event("told", "X-1", n=2)
        events.event("quiet", "X-2", logging.DEBUG)
    finally:
        events.LOG.handlers[:] = handlers
    lines = [json.loads(x) for x in out.getvalue().splitlines()]
    assert [(x["reason_code"], x["message"], x["n"]) for x in lines] == [("X-1", "told", 2)]


def test_throughput():
    assert runs.throughput(1000, 0.02) == 50000.0 and runs.throughput(7, 0.0) == 7.0


def test_a_corridor_of_two_drives(spark, tmp_path, shared):
    """Two drives up one road see the same pothole; the second meets the ledger of the first."""
    x0, y0, zone = 600000.0, 2000000.0, 44
    spot = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    nodes = spark.createDataFrame([(1, x0, y0, "traffic_signals"), (2, x0, y0 + 200, None)], "node_id long, x double, y double, highway string")
    edges = spark.range(1).select(F.lit("1_2_0").alias("edge_id"), F.lit(1).alias("u"), F.lit(2).alias("v"), F.lit(50).alias("maxspeed_kph"), F.lit(7.5).alias("width_osm_m"), F.lit(False).alias("oneway"), F.array(spot(x0, y0), spot(x0, y0 + 200)).alias("geometry"), F.lit(200.0).alias("length_m"))
    way = spark.range(21).select("id", *(c.alias(k) for k, c in zip(("lon", "lat"), geodesy.from_utm(F.lit(x0), y0 + F.col("id") * 10.0, zone), strict=True)))
    places = [(r.id, r.lat, r.lon) for r in way.orderBy("id").collect()]
    found = {}
    for name in ("d0", "d1"):
        (tmp_path / "drives" / name).mkdir(parents=True)
        (tmp_path / "drives" / name / "train.csv").write_text("timestamp,lat,lon,speed,heading\n" + "".join(f"{k},{a!r},{b!r},10.0,0.0\n" for k, a, b in places))
        u, v = camera.pixel(F.col("ahead"), F.lit(0.5), camera.Rig())
        seen = spark.createDataFrame([(k, k / 10, 100.0 - k) for k in range(80, 95)], "frame_idx long, frame_ts double, ahead double").withColumns({"u": u, "v": v})
        seen = seen.select("frame_idx", "frame_ts", F.lit("pothole").alias("class_name"), F.lit(0.9).alias("conf"), (F.col("u") - 20).alias("x1"), (F.col("v") - 20).alias("y1"), (F.col("u") + 20).alias("x2"), F.col("v").alias("y2"), F.lit(4).alias("track_id"), F.col("frame_idx").alias("obs"))
        found[name] = seen.where("v <= 1080")
    (tmp_path / "drives" / "d2").mkdir()
    (tmp_path / "drives" / "d2" / "train.csv").write_text("timestamp,lat,lon\n0,17,78\n")
    facts = runs.run_corridor(spark, f"file://{tmp_path}/drives", found, nodes, edges, tmp_path / "out", shared, zone)
    n = sum(f.count() for f in found.values())
    assert n and facts["multi_pass_sequences"] == ["d0", "d1"]
    assert facts["statistics"] == {"num_gps_fixes": 42, "num_detections_ingested": n, "num_canonical_anomalies": 1, "num_confirmed_anomalies": 1}
    hole = stores.current_ledger(spark, f"{shared}/ledger").first()
    assert hole.edge_id == "1_2_0" and abs(hole.s - 100) < 0.5 and abs(hole.t - 0.5) < 0.2
    assert spark.read.parquet(f"{shared}/observations").groupBy("sequence_id").count().count() == 2
    for name in ("d0", "d1"):
        manifest = json.loads((tmp_path / "out" / f"scenario_{name}" / "MANIFEST.json").read_text())
        assert manifest["validation"] == {"opendrive_valid": True, "sumo_scenario_valid": True} and manifest["fusion_throughput_dets_per_sec"] > 0
        assert emit.report(tmp_path / "out" / f"scenario_{name}").count(": ok") == 9
    assert json.loads((tmp_path / "out" / "MANIFEST.json").read_text()) == facts
    assert readers.manifests(spark, f"file://{tmp_path}/out/scenario_d1/MANIFEST.json").first().sequence_id == "d1"
