import itertools
import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from roadweave.functions import camera, frenet, geodesy, scalar
from roadweave.operators import dedup, detections, emit, gps, graph, matching, roads
from roadweave.plans import fusion


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(k) for k, c in columns.items())).first()


def test_zones(spark):
    r = one(spark, a=geodesy.utm_zone(F.lit(78.4)), b=geodesy.utm_zone(F.lit(72.9)), c=geodesy.utm_epsg(F.lit(78.4), F.lit(-1.0)))
    assert (r.a, r.b, r.c) == (44, 43, 32744)


def test_utm_round_trip(spark):
    e, n = geodesy.to_utm(F.lit(78.35), F.lit(17.44), 44)
    lon, lat = geodesy.from_utm(e, n, 44)
    r = one(spark, lon=lon, lat=lat)
    assert abs(r.lon - 78.35) < 1e-8 and abs(r.lat - 17.44) < 1e-8


def test_projection_round_trip_and_gates(spark):
    rig = camera.Rig()
    ahead, left = [5, 8, 12, 15, 20, 25, 45, 2.5], [-2.5, -1, 0, 1.2, 2, -1.8, 0, 0]
    df = spark.createDataFrame(list(zip(map(float, ahead), map(float, left), strict=True)), "ahead double, beside double")
    u, v = camera.pixel(F.col("ahead"), F.col("beside"), rig)
    rows = detections.projected(df.select("ahead", "beside", u.alias("u"), v.alias("v")), rig).orderBy("ahead").collect()
    for r in rows:
        assert r.valid == (4 <= math.hypot(r.ahead, r.beside) <= 30)
        if r.valid:
            assert abs(r.X - r.ahead) < 0.01 and abs(r.Y - r.beside) < 0.01
    by = {r.ahead: r for r in rows}
    assert math.sqrt(by[12].var_xx) > 2 * math.sqrt(by[5].var_xx) and by[45].X is None
    assert not detections.projected(spark.createDataFrame([(960.0, 100.0)], "u double, v double"), rig).first().valid


def test_tags(spark):
    r = one(
        spark, a=scalar.lanes(F.lit("2"), F.lit("primary")), b=scalar.lanes(F.lit(None).cast("string"), F.lit("primary")), c=scalar.maxspeed(F.lit("50 km/h"), F.lit("x")), d=scalar.maxspeed(F.lit(None).cast("string"), F.lit("residential")),
        e=scalar.width(F.lit("7.5 m"), F.lit(2)), f=scalar.width(F.lit(None).cast("string"), F.lit(2)), g=scalar.width(F.lit("7.5 meters"), F.lit(2)), h=scalar.maxspeed(F.lit("30 mph"), F.lit("x")), i=scalar.maxspeed(F.lit("5"), F.lit("trunk_link")),
        j=scalar.first_scalar(F.array(F.lit("3"), F.lit("2"))), k=scalar.wrap_degrees(F.lit(-190.0)),
    )
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g, r.h, r.i, r.j, r.k) == (2, 2, 50, 30, 7.5, 7.0, 7.0, 48, 40, "3", 170.0)


def test_frenet(spark):
    out = frenet.obstacle(*(F.lit(float(x)) for x in (20, 0, 0, 0, 10, -1.5, 1, 0.2, 0)), F.lit(None).cast("double"))
    r = one(spark, **out)
    assert (r.s, r.t, r.sigma_s) == (30.0, -1.5, 1.0)
    s, t = frenet.forward_side(F.lit(70.0), F.lit(1.5), F.lit(100.0), F.lit(True))
    assert tuple(one(spark, s=s, t=t)) == (30.0, -1.5)


def test_poses(spark):
    log = spark.createDataFrame([(0, k / 2, 100.0 * k, 50.0 * k, 10.0, (350 + 10.0 * k) % 360) for k in range(21)], "seq int, timestamp double, x double, y double, speed double, heading double")
    asked = spark.createDataFrame([(0, 1.25), (0, 3.0), (0, 15.0), (0, 0.25), (1, 2.0)], "seq int, frame_ts double")
    rows = {(r.seq, r.frame_ts): r for r in gps.poses(asked, log).collect()}
    assert rows[0, 1.25].ego_x == 250.0 and rows[0, 1.25].gps_valid and rows[0, 3.0].ego_y == 300.0
    assert not rows[0, 15.0].gps_valid and rows[0, 15.0].ego_x == 2000.0 and not rows[1, 2.0].gps_valid
    assert abs(rows[0, 0.25].ego_heading - 355.0) < 1e-9  # over north


def test_matching_two_roads(spark):
    point = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    edges = spark.range(2).select(F.concat(F.lit("e"), "id").alias("edge_id"), F.when(F.col("id") == 0, F.array(point(0, 0), point(0, 100))).otherwise(F.array(point(15, 0), point(15, 100))).alias("geometry"))
    rng = np.random.default_rng(42)
    poses = spark.createDataFrame([(0, k, float(rng.normal(1.0, 2.5)), 5.0 + k * 90 / 19, 0.0) for k in range(20)] + [(1, 20, 500.0, 0.0, 0.0), (1, 21, 0.0, 10.0, 0.0)], "pass_id int, obs int, x double, y double, heading double")
    rows = matching.matched(poses, matching.candidates(poses, graph.segments(edges))).collect()
    assert sum(r.edge_id == "e0" for r in rows) >= 19 and all(r.pass_id == 0 for r in rows)  # a first step without candidates: no path


def test_decode_is_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(40):
        steps = [(rng.integers(0, 3, k), rng.random(k) * 40, -rng.random(k) * 5, *(rng.random(2) * 30)) for k in rng.integers(1, 4, 5)]
        # Each path's score by the definition.
        def score(path):
            total = steps[0][2][path[0]]
            for (e, s, _, x, y), (f, t, m, nx, ny), i, j in zip(steps, steps[1:], path, path[1:], strict=False):
                straight = math.hypot(nx - x, ny - y)
                route = abs(t[j] - s[i]) if e[i] == f[j] else straight
                total += m[j] - math.log(matching.BETA) - abs(straight - route) / matching.BETA
            return total

        best = max(score(p) for p in itertools.product(*(range(len(s[0])) for s in steps)))
        assert abs(score(matching.decode(steps)) - best) < 1e-9
    empty = (np.array([], int), np.array([]), np.array([]), 0.0, 0.0)
    assert matching.decode([empty, steps[0]]) == [None, None]
    assert len(matching.decode([steps[0], empty, steps[1]])) == 3


def test_assignment_against_all_permutations():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n, m = rng.integers(1, 5, 2)
        cost = np.where(rng.random((n, m)) < 0.4, np.inf, rng.random((n, m)) * 9)
        got = dedup.assign(cost)
        best = (0, 0.0)
        for k in range(1, min(n, m) + 1):
            for rows in itertools.combinations(range(n), k):
                for columns in itertools.permutations(range(m), k):
                    c = sum(cost[a, b] for a, b in zip(rows, columns, strict=True))
                    if np.isfinite(c) and (k > best[0] or c < best[1]):
                        best = (k, c)
        assert len(got) == best[0] and abs(sum(cost[p] for p in got) - best[1]) < 1e-9


def test_level1_fold_clamps_and_confirms(spark):
    rows = [(k, "e", "pothole", 1, 10.0, 0.8 + k / 10, 1e-4, 1e-4, 0.4) for k in range(4)] + [(9, "e", "pothole", None, 10.0, 0.0, 1.0, 1.0, None)]
    obs = spark.createDataFrame(rows, "k int, edge_id string, class_name string, track_id int, s double, t double, var_s double, var_t double, conf double")
    out = {r.observation_count: r for r in dedup.level1(obs, ["k"]).collect()}
    assert abs(out[4].t - 1.0125) < 1e-9 and abs(out[4].var_t - 5e-5) < 1e-12 and out[4].state == "CONFIRMED"
    assert out[1].confidence == 0.6 and out[1].state == "CANDIDATE"


def test_level2_merges_and_keeps(spark):
    columns = "anomaly_id string, edge_id string, class_name string, s double, t double, var_s double, var_t double, confidence double, observation_count long, state string"
    old = spark.createDataFrame([("a", "e", "pothole", 25.0, -1.2, 0.5, 0.2, 0.8, 1, "CANDIDATE")], columns)
    new = spark.createDataFrame([("b", "e", "pothole", 25.2, -1.15, 0.5, 0.2, 0.85, 1, "CANDIDATE"), ("c", "e", "pothole", 50.0, -1.2, 0.5, 0.2, 0.8, 1, "CANDIDATE"), ("d", "e", "speed_breaker", 25.0, -1.2, 0.5, 0.2, 0.8, 1, "CANDIDATE")], columns)
    out = {r.anomaly_id: r for r in dedup.level2(old, new).collect()}
    assert set(out) == {"a", "c", "d"} and out["a"].observation_count == 2 and out["a"].state == "CONFIRMED"
    assert abs(out["a"].s - 25.1) < 1e-9 and abs(out["a"].t + 1.175) < 1e-9 and abs(out["a"].var_s - 0.25) < 1e-12
    assert dedup.level2(old.limit(0), new).count() == 3 and dedup.level2(old, new.limit(0)).count() == 1


def test_widths_round_half_to_even(spark):
    edges = spark.createDataFrame([("a", 7.5, True), ("b", 7.5, False), ("c", None, False)], "edge_id string, width_osm_m double, oneway boolean")
    assert {r.edge_id: (r.width_dir_m, r.lanes_effective) for r in roads.fused_widths(edges).collect()} == {"a": (7.5, 2), "b": (3.75, 1), "c": (3.5, 1)}


def test_recovery(spark):
    truth = spark.createDataFrame([(1, "pothole", 25.0, -1.2), (2, "speed_breaker", 50.0, 0.8), (3, "pothole", 75.0, -0.5)], "ord int, class_name string, s double, t double")
    found = spark.createDataFrame([(1, "pothole", 25.1, -1.18), (2, "speed_breaker", 50.05, 0.82), (3, "pothole", 75.12, -0.48), (4, "pothole", 75.0, 0.0), (5, "pothole", 99.0, 0.0)], "ord int, class_name string, s double, t double")
    r = roads.recovery(truth, found).first()
    assert (r.tp, r.fp, r.fn, r.duplicates, r.recall, r.precision) == (3, 1, 0, 1, 1.0, 0.75)


def test_rejects(spark):
    row = (0, 0.0, 0.9, 1.0, 1.0, 5.0, 5.0, 10, 10)
    bad = [(*row[:2], float("nan"), *row[3:]), (*row[:5], 0.5, *row[6:]), (*row[:6], 11.0, 10, 10), (None, *row[1:])]
    df = spark.createDataFrame([row, *bad], "frame_idx int, frame_ts double, conf double, x1 double, y1 double, x2 double, y2 double, img_w int, img_h int")
    valid, rejected = detections.split(df)
    assert valid.count() == 1 and sorted(r.reject_reason for r in rejected.collect()) == ["conf", "extent", "frame_idx", "outside"]


def test_scenario_files(spark, tmp_path):
    nodes, edges = graph.grid(spark, (500000.0, 2000000.0, 500200.0, 2000200.0))
    assert nodes.count() == 9 and edges.count() == 24
    edges = roads.fused_widths(edges)
    anomalies = spark.createDataFrame([("abcdefghij", "1001_1002_0", "pothole", 20.0, 0.5)], "anomaly_id string, edge_id string, class_name string, s double, t double")
    emit.scenario(tmp_path, nodes, edges, anomalies, 44)
    assert emit.validate_roads(tmp_path / "network.xodr") == (True, [], []) and emit.validate_scenario(tmp_path / "scenario.sumocfg")[0]
    assert 'id="hazard_abcdefgh"' in (tmp_path / "anomalies.add.xml").read_text() and (tmp_path / "plain.nod.xml").read_text().count("traffic_light") == 1
    assert emit.report(tmp_path).count(": ok") == 9


def test_wkt(spark):
    r = one(spark, a=emit.points(F.lit("LINESTRING (1 2, 3.5 4)")), b=emit.points(F.lit("POINT (1 2)")))
    assert [(p.x, p.y) for p in r.a] == [(1.0, 2.0), (3.5, 4.0)] and r.b is None


def test_streamed_passes_equal_batches(spark, tmp_path):
    from roadweave.streaming.ledger import follow

    schema = "k int, edge_id string, class_name string, track_id int, s double, t double, var_s double, var_t double, conf double"
    spark.createDataFrame([(k, "e", "pothole", 1, 25.0 + k / 10, 0.0, 0.5, 0.2, 0.8) for k in range(3)], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    follow(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "ledger"), str(tmp_path / "check"), ["k"]).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "ledger/v=0")).first().observation_count == 3


def test_streamed_passes_after_the_first_are_merged(spark, tmp_path):
    """Three files, one a batch: the ledger after them is the one that merging pass by pass gives."""
    from roadweave.streaming.ledger import follow

    schema = "k int, edge_id string, class_name string, track_id int, s double, t double, var_s double, var_t double, conf double"
    passes = [[(10 * p + k, "e", "pothole", 1, 25.0 + p / 10, 0.0, 0.5, 0.2, 0.6) for k in range(2)] + [(10 * p + 5, "e", "pothole", 2, 60.0 + 20 * p, 0.0, 0.5, 0.2, 0.6)] for p in range(3)]
    want = None
    for p, rows in enumerate(passes):
        df = spark.createDataFrame(rows, schema).coalesce(1)
        df.write.mode("append").parquet(str(tmp_path / "in"))
        follow(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "ledger"), str(tmp_path / "check"), ["k"]).awaitTermination()
        new = dedup.level1(df, ["k"]).drop("track_id")
        want = new.collect() if want is None else dedup.level2(spark.createDataFrame(want, new.schema), new).collect()
    got = spark.read.parquet(str(tmp_path / "ledger/v=2")).collect()
    key = lambda r: (r.anomaly_id, round(r.s, 9), r.observation_count, r.state)
    assert sorted(map(key, got)) == sorted(map(key, want)) and len(got) == 4
    assert max(r.observation_count for r in got) == 4


def _bent(x):
    return F.array(*(F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y")) for a, b in x))


def test_bearings_near_a_bend(spark):
    """Within a metre of a vertex the bearing is that of the chord between the places a metre before and after."""
    edges = spark.range(1).select(F.lit("e").alias("edge_id"), _bent([(0, 0), (0, 50), (50, 50)]).alias("geometry")).unionByName(
        spark.range(1).select(F.lit("tiny").alias("edge_id"), _bent([(0, 40), (0, 40.05)]).alias("geometry")))
    poses = spark.createDataFrame([(0, 2.0, 20.0), (1, -1.0, 49.5), (2, 0.25, 51.0), (3, 20.0, 48.0), (4, -1.0, 0.2)], "obs int, x double, y double").withColumn("heading", F.lit(40.0))
    rows = {r.obs: r for r in matching.candidates(poses, graph.segments(edges)).collect()}
    line = [(0.0, 0.0, 0.0), (50.0, 0.0, 50.0), (100.0, 50.0, 50.0)]

    def at(s):
        (c, x, y), (d, u, v) = next((p, q) for p, q in zip(line, line[1:], strict=False) if s <= q[0])
        return x + (s - c) / (d - c) * (u - x), y + (s - c) / (d - c) * (v - y)

    for o, x, y in ((0, 2.0, 20.0), (1, -1.0, 49.5), (2, 0.25, 51.0), (3, 20.0, 48.0), (4, -1.0, 0.2)):
        (px, py), (qx, qy) = at(max(0.0, rows[o].s - 1)), at(min(100.0, rows[o].s + 1))
        bearing = math.degrees(math.atan2(qx - px, qy - py)) % 360
        fx, fy = at(rows[o].s)
        assert rows[o].edge_id == "e" and abs(rows[o].bearing - bearing) < 1e-9
        assert abs(rows[o].t - ((y - fy) * math.sin(math.radians(bearing)) - (x - fx) * math.cos(math.radians(bearing)))) < 1e-9
    assert 0 < rows[1].bearing < 45 and 45 < rows[2].bearing < 90


def test_pieces_of_a_pass_decode_like_the_whole(spark, monkeypatch):
    nodes, edges = graph.grid(spark, (0.0, 0.0, 200.0, 200.0))
    rng = np.random.default_rng(5)
    rows = [(p, 1000 * p + k, float(6 * k % 200 + rng.normal(0, 4)), float(100 * (k // 34 % 3) + rng.normal(0, 6)), float(rng.choice([80.0, 95.0, 270.0]))) for p in range(2) for k in range(150)]
    poses = spark.createDataFrame(rows, "pass_id int, obs int, x double, y double, heading double")
    found = matching.candidates(poses, graph.segments(edges)).cache()
    path = lambda: sorted(map(tuple, matching.matched(poses, found).collect()))
    whole = path()
    assert len(whole) == 300 and found.groupBy("obs").count().where("count = 1").count() > 20
    monkeypatch.setattr(matching, "CHUNK", 8)
    assert path() == whole


def test_rivals_are_assigned_one_to_one(spark):
    """Two old and two new anomalies in each other's gates, far from others of the edge."""
    columns = "anomaly_id string, edge_id string, class_name string, s double, t double, var_s double, var_t double, confidence double, observation_count long, state string"
    row = lambda name, s: (name, "e", "pothole", s, 0.0, 0.5, 0.2, 0.8, 1, "CANDIDATE")
    old = spark.createDataFrame([row("a", 10.0), row("b", 11.0), *(row(f"o{k}", 100.0 + 20 * k) for k in range(30))], columns)
    new = spark.createDataFrame([row("x", 10.4), row("y", 9.0), *(row(f"n{k}", 100.5 + 20 * k) for k in range(30))], columns)
    out = {r.anomaly_id: r for r in dedup.level2(old, new).collect()}
    assert len(out) == 32 and abs(out["a"].s - 9.5) < 1e-9 and abs(out["b"].s - 10.7) < 1e-9 and abs(out["o7"].s - 240.25) < 1e-9


def test_gps_log_is_normalised(spark):
    raw = spark.createDataFrame([("a", 0, "09-00-31-500000", "17.0", "78.0", "12", None), ("a", 1, "09-00-32-500000", "17.0001", "78.0", "13", None), ("b", 0, "5.0", "17.0", "78.0", None, "90"), ("b", 1, "6.0", "17.0", "78.0001", None, "91")], "seq string, row int, `Time` string, Latitude string, longitude string, velocity string, yaw string")
    rows = {(r.seq, r.row): r for r in gps.normalised(raw).collect()}
    assert (rows["a", 1].timestamp, rows["a", 0].speed, rows["a", 0].heading, rows["b", 1].heading) == (1.0, 12.0, 0.0, 91.0)
    assert abs(rows["b", 0].speed - 111139 * 1e-4 * math.cos(math.radians(17))) < 0.01 and rows["b", 1].speed == 0.0
    planar = spark.createDataFrame([("a", 0.0, 0.0, 0.0, 7.0), ("a", 1.0, 3.0, 4.0, 8.0)], "seq string, timestamp double, x double, y double, speed_mps double")
    assert [(r.speed, round(r.heading, 6)) for r in gps.planar_speed_heading(planar).orderBy("timestamp").collect()] == [(7.0, round(math.degrees(math.atan2(3, 4)), 6)), (8.0, 0.0)]


def _world(spark, drive, seed):
    """A straight road of 100 m due north, driven at 10 m/s with GPS noise of 1.5 m, and three planted anomalies."""
    rng = np.random.default_rng(seed)
    planted = [(1, "pothole", 25.0, -1.2), (2, "speed_breaker", 50.0, 0.8), (3, "pothole", 75.0, -0.5)]
    edges = spark.range(1).select(F.lit("1001_1002_0").alias("edge_id"), _bent([(500000, 2000000), (500000, 2000100)]).alias("geometry"), F.lit(100.0).alias("length_m"))
    log = spark.createDataFrame([(drive, k / 10, 500000.0 + rng.normal(0, 1.5), 2000000.0 + k + rng.normal(0, 1.5), 10.0, 0.0) for k in range(100)], "seq string, timestamp double, x double, y double, speed double, heading double")
    seen = [(drive, 1000 * k + i, k / 10, s - k, t, name, 0.92, i) for k in range(100) for i, name, s, t in planted if s - k >= 4 and math.hypot(s - k, t) <= 30]
    seen = spark.createDataFrame(seen, "seq string, obs long, frame_ts double, ahead double, beside double, class_name string, conf double, track_id long")
    u, v = camera.pixel(F.col("ahead"), F.col("beside"), camera.Rig())
    return planted, edges, log, seen.withColumns({"u": u, "v": v}).where("v <= 1080").drop("ahead", "beside")


def test_planted_anomalies_are_recovered_over_two_passes(spark):
    planted, edges, log, seen = _world(spark, "first", 42)
    placed, ledger = fusion.run(seen, log, edges)
    assert placed.count() == seen.count() and placed.where("edge_id = '1001_1002_0'").count() == placed.count()
    truth = spark.createDataFrame([(i, c, s, t) for i, c, s, t in planted], "ord int, class_name string, s double, t double")
    for number in (1, 2):
        found = ledger.withColumn("ord", F.row_number().over(Window.orderBy("s"))).where("state = 'CONFIRMED'")
        r = roads.recovery(truth, found).first()
        assert (r.tp, r.fp, r.fn, r.duplicates) == (3, 0, 0, 0) and ledger.count() == 3
        if number == 1:
            _, edges, log, seen = _world(spark, "second", 43)
            ledger = fusion.run(seen, log, edges, widened(ledger))[1]


def widened(ledger):
    """The places' GPS noise is in no variance of a single pass."""
    return ledger.select("anomaly_id", "edge_id", "class_name", "s", "t", F.lit(1.0).alias("var_s"), F.lit(1.0).alias("var_t"), "confidence", "observation_count", "state")


@pytest.mark.parametrize("raw,seconds", [("12.5", 12.5), ("01-02-03-500000", 3723.5), ("x", 0.0)])
def test_clock(spark, raw, seconds):
    assert one(spark, c=gps.clock(F.lit(raw))).c == seconds


def test_poses_by_slices(spark, monkeypatch):
    """A drive is dealt over tasks in slices, and gaps of many slices, both ends, equal instants and a drive without a name stay right."""
    times = sorted({*(k / 2 for k in range(60)), *(200 + k / 4 for k in range(40)), 400.0})
    rng = np.random.default_rng(7)
    fixes = [(seq, float(t), float(rng.normal()), float(rng.normal()), 9.0, float(20 * k % 360)) for seq in ("a", None) for k, t in enumerate(times)]
    log = spark.createDataFrame(fixes, "seq string, timestamp double, x double, y double, speed double, heading double")
    asked = [(seq, i, float(t)) for seq in ("a", None, "b") for i, t in enumerate([-90.0, -0.5, 0.0, 3.9, 4.0, 4.1, 29.5, 30.0, 100.0, 199.5, 203.3, 209.75, 300.0, 399.5, 400.0, 400.5, 999.0])]
    asked = spark.createDataFrame(asked, "seq string, i int, frame_ts double")
    monkeypatch.setattr(gps, "SLICE_S", 4.0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = gps.poses(asked, log).select("*", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(rows) == 51 and len({r.task for r in rows if r.seq == "a"}) > 1
    for r in rows:
        own = [f for f in fixes if f[0] == r.seq and r.seq != "b"]
        assert r.gps_valid == (bool(own) and min((abs(f[1] - r.frame_ts) for f in own)) <= 1 and 0 <= r.frame_ts <= 400)
        if own:
            at, heading = [f[1] for f in own], np.unwrap([f[5] for f in own], period=360)
            assert abs(r.ego_x - np.interp(r.frame_ts, at, [f[2] for f in own])) < 1e-9 and abs(r.ego_y - np.interp(r.frame_ts, at, [f[3] for f in own])) < 1e-9
            assert abs((r.ego_heading - np.interp(r.frame_ts, at, heading) + 180) % 360 - 180) < 1e-9
        else:
            assert r.ego_x is None


def test_cuts_are_found_over_slices(spark, monkeypatch):
    nodes, edges = graph.grid(spark, (0.0, 0.0, 200.0, 200.0))
    rng = np.random.default_rng(5)
    rows = [(p, f"{1000 * p + k:06d}", float(6 * k % 200 + rng.normal(0, 4)), float(100 * (k // 34 % 3) + rng.normal(0, 6)), float(rng.choice([80.0, 95.0, 270.0]))) for p in range(2) for k in range(150)]
    poses = spark.createDataFrame(rows, "pass_id int, obs string, x double, y double, heading double")
    found = matching.candidates(poses, graph.segments(edges)).cache()
    path = lambda: sorted(map(tuple, matching.matched(poses, found).collect()))
    whole = path()
    monkeypatch.setattr(matching, "CHUNK", 8)
    monkeypatch.setattr(matching, "SLICE", 3)
    assert path() == whole and len(whole) == 300


def test_poses_are_not_broadcast(spark):
    """Stored poses compress well, so that their files look small enough to be sent to all tasks, by the driver's memory."""
    _, edges, log, seen = _world(spark, "first", 42)
    poses = log.select(F.monotonically_increasing_id().alias("obs"), "x", "y", "heading")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan(matching.candidates(poses, graph.segments(edges)))
    joins = [line for line in plan(fusion.observations(seen, log, edges)).splitlines() if "Join" in line and "[obs#" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_passes_without_a_single_candidate_are_cut(spark, monkeypatch):
    """Both directions of a road are candidates of each pose, and poses far apart share none: pieces, not a whole pass, go to a task."""
    nodes, edges = graph.grid(spark, (0.0, 0.0, 400.0, 400.0), 5)
    rng = np.random.default_rng(9)
    rows = [(p, 1000 * p + k, float(30 + 40 * (k % 4) / 4 + rng.normal(0, 3)), float(100 * (k // 4 % 5) + (50 if k % 11 == 5 else rng.normal(0, 6))), 0.0) for p in range(3) for k in range(120)]
    rows[240] = (2, 2000, 50.0, 50.0, 0.0)  # a first step without candidates: no path
    poses = spark.createDataFrame(rows, "pass_id int, obs int, x double, y double, heading double")
    found = matching.candidates(poses, graph.segments(edges), gated=False).cache()
    sizes = found.groupBy("obs").count()
    assert not sizes.where("count = 1").count() and 300 < sizes.count() < 359
    sent = []
    by = {}
    for r in found.collect():
        by.setdefault(r.obs, []).append((r["rank"], r.edge_id, r.s))
    want = []
    for p in range(2):
        own = [r for r in rows if r[0] == p]
        held = [sorted(by.get(r[1], [])) for r in own]
        emissions = {(r.obs, r.edge_id): r.emission for r in found.collect()}
        steps = [(np.array([e for _, e, _ in c], object), np.array([s for *_, s in c]), np.array([emissions[r[1], e] for _, e, _ in c]), r[2], r[3]) for r, c in zip(own, held, strict=True)]
        last = None
        for r, c, k in zip(own, held, matching.decode(steps), strict=True):
            last = c or last
            want.append((p, r[1], last[k][1]))
    apply = type(poses.groupBy("obs")).applyInPandas
    monkeypatch.setattr(type(poses.groupBy("obs")), "applyInPandas", lambda self, f, schema: sent.append(self.count()) or apply(self, f, schema))
    path = lambda: sorted(map(tuple, matching.matched(poses, found).collect()))
    first = path()
    assert [r[:3] for r in first] == want
    monkeypatch.setattr(matching, "CHUNK", 8)
    for size in (8192, 50):
        monkeypatch.setattr(matching, "SLICE", size)
        assert path() == first
    assert len(first) == 240
    assert sent[1].agg(F.max("count")).first()[0] <= 24
