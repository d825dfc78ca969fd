"""Whole runs: a drive to observations, ledger, scenario tables and files with their manifest; drives over one ledger."""

from __future__ import annotations

import json
import time
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.functions.camera import Rig
from roadweave.functions.geodesy import to_utm
from roadweave.log import event
from roadweave.operators import detections, emit, roads
from roadweave.plans import fusion
from roadweave.sources import readers, stores


def throughput(n: int, seconds: float) -> float:
    """Detections a second to one place; all of them where no time passed."""
    return round(n / seconds, 1) if seconds > 0 else float(n)


def observation_rows(placed: DataFrame, at: Column | None = None) -> DataFrame:
    """Observations of ``fusion`` as they are kept."""
    frame = F.col("frame_idx") if "frame_idx" in placed.columns else F.col("obs")
    return placed.select(
        F.col("seq").cast("string").alias("sequence_id"), frame.cast("long").alias("frame_idx"), "frame_ts", "edge_id", "class_name", "conf",
        F.col("s").alias("s_obs"), F.col("t").alias("t_obs"), "sigma_s", "sigma_t", (F.current_timestamp() if at is None else at).alias("created_at"),
    )


def planar(log: DataFrame, zone: int, north: bool = True) -> DataFrame:
    """A log of degrees with ``x``, ``y`` in metres."""
    x, y = to_utm(F.col("lon"), F.col("lat"), zone, north)
    return log.withColumns({"x": x, "y": y})


def run_pass(found: DataFrame, log: DataFrame, nodes: DataFrame, edges: DataFrame, out: str | Path, data: str, zone: int, north: bool = True, satellite: DataFrame | None = None, rig: Rig | None = None, mode: str = "collapse", sequence: str = "") -> dict:
    """Fuses a drive and writes all that a run leaves; returns its manifest.

    ``found`` and ``log`` as in ``fusion.observations``; ``data`` is a folder that all executors share, for observations
    (appended), ledger (a new version) and scenario tables; ``out`` is the driver's folder of the simulator's files.
    Detections that break a rule are counted and left out.
    """
    spark, began = found.sparkSession, time.monotonic()
    event("fusion starts", "FUSE-START", sequence=sequence)
    old = stores.current_ledger(spark, f"{data}/ledger")
    placed, ledger = fusion.run(found, log, edges, old, rig)
    now = F.lit(time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime())).cast("timestamp")
    ledger = stores.commit_ledger(ledger.withColumns({"created_at": now, "updated_at": now}), f"{data}/ledger")
    readers.append_observations(observation_rows(placed, now), f"{data}/observations")
    n_found, n_fixes, n_fused = found.count(), log.count(), placed.count()
    took = time.monotonic() - began
    sizes = ledger.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("state") == "CONFIRMED").alias("confirmed")).first()
    event("fusion ends", "FUSE-END", sequence=sequence, seconds=round(took, 2), fused=n_fused)
    wide = roads.fused_widths(edges, satellite)
    stores.write_scenario_tables(wide, ledger, f"{data}/tables")
    kept, anomalies = stores.read_scenario_tables(spark, f"{data}/tables")
    emit.scenario(out, nodes, kept, anomalies, zone, north, mode)
    facts = {
        "sequence_id": sequence, "execution_timestamp": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), "fusion_throughput_dets_per_sec": throughput(n_found, took), "traffic_rule": "LHT",
        "statistics": {"num_gps_fixes": n_fixes, "num_detections_ingested": n_found, "num_raw_observations_fused": n_fused, "num_canonical_anomalies": sizes.n, "num_confirmed_anomalies": sizes.confirmed},
        "validation": {"opendrive_valid": emit.validate_roads(Path(out) / "network.xodr")[0], "sumo_scenario_valid": emit.validate_scenario(Path(out) / "scenario.sumocfg")[0]},
        "total_elapsed_sec": round(time.monotonic() - began, 2),
    }
    manifest = emit.add_facts(out, facts)
    event("run ends", "RUN-END", sequence=sequence, **facts["statistics"])
    return manifest


def run_corridor(spark: SparkSession, root: str, found: dict[str, DataFrame], nodes: DataFrame, edges: DataFrame, out: str | Path, data: str, zone: int, north: bool = True, rig: Rig | None = None) -> dict:
    """Every drive below ``root`` that has a log, in order of name, over one ledger; returns the corridor's manifest, which also
    lies in ``out``. ``found`` has the boxes of each drive (an absent one has no detections and is skipped)."""
    names, manifests = stores.sequences(spark, root), {}
    event("corridor starts", "CORRIDOR-START", sequences=names)
    for name in names:
        if name not in found:
            event("no detections", "CORRIDOR-SKIP", sequence=name)
            continue
        log = planar(stores.ingest_gps(spark, f"{root}/{name}", f"{data}/gps/{name}"), zone, north).withColumn("seq", F.lit(name))
        valid, _ = detections.split(detections.with_defaults(found[name], name))
        boxes = detections.contact(valid).withColumn("seq", F.lit(name))
        manifests[name] = run_pass(boxes, log, nodes, edges, Path(out) / f"scenario_{name}", data, zone, north, rig=rig, sequence=name)
    last = next(reversed(manifests.values()), {"statistics": {"num_canonical_anomalies": 0, "num_confirmed_anomalies": 0}})["statistics"]
    total = lambda k: sum(m["statistics"][k] for m in manifests.values())
    facts = {
        "scenario": "corridor_multi_pass", "multi_pass_sequences": list(manifests), "utm_zone": zone, "traffic_rule": "LHT",
        "statistics": {"num_gps_fixes": total("num_gps_fixes"), "num_detections_ingested": total("num_detections_ingested"), "num_canonical_anomalies": last["num_canonical_anomalies"], "num_confirmed_anomalies": last["num_confirmed_anomalies"]},
    }
    emit.write_atomic(Path(out) / "MANIFEST.json", json.dumps(facts, indent=2))
    return facts
