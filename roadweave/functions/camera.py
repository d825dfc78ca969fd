"""A rig's camera: pixels to the ground plane and back, with propagated uncertainty, as column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass
from pathlib import Path

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Names that rig files give to two of the figures.
FILE_NAMES = {"pixel_sigma_v": "sigma_v_px", "pitch_sigma_deg": "sigma_pitch_deg"}


@dataclass(frozen=True)
class Rig:
    fx: float = 1380.0
    fy: float = 1380.0
    cx: float = 960.0
    cy: float = 540.0
    height_m: float = 1.5
    yaw_deg: float = 0.0
    pitch_deg: float = -2.5
    roll_deg: float = 0.0
    min_range_m: float = 4.0
    max_range_m: float = 30.0
    sigma_v_px: float = 2.0
    sigma_pitch_deg: float = 0.5
    time_offset_s: float = 0.0

    @classmethod
    def from_config(cls, config: dict) -> Rig:
        """From a mapping of these names or of the rig file's groups; what is missing keeps its default."""
        flat = {k: v for k, v in config.items() if not isinstance(v, dict)}
        for group in ("camera", "mounting", "processing_gates"):
            flat |= config.get(group) or {}
        named = flat | {k: flat[old] for old, k in FILE_NAMES.items() if old in flat}
        return cls(**{k: float(named[k]) for k in cls.__dataclass_fields__ if k in named})

    @classmethod
    def from_yaml(cls, path: str | Path) -> Rig:
        """From a rig file; needs a YAML reader."""
        import yaml

        return cls.from_config(yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {})

    @property
    def rotation(self) -> np.ndarray:
        """Camera axes (right, down, forward) to vehicle axes (forward, left, up)."""
        y, p, r = (math.radians(a) for a in (self.yaw_deg, self.pitch_deg, self.roll_deg))
        yaw = np.array([[math.cos(y), -math.sin(y), 0], [math.sin(y), math.cos(y), 0], [0, 0, 1]])
        pitch = np.array([[math.cos(p), 0, math.sin(p)], [0, 1, 0], [-math.sin(p), 0, math.cos(p)]])
        roll = np.array([[1, 0, 0], [0, math.cos(r), -math.sin(r)], [0, math.sin(r), math.cos(r)]])
        axes = np.array([[0, 0, 1], [-1, 0, 0], [0, -1, 0]])
        return yaw @ pitch @ roll @ axes


def ground_steps(u: Column, v: Column, rig: Rig) -> list[dict[str, Column]]:
    """``X``, ``Y``, ``range_m``, variances and ``valid`` in steps, each of names that the next ones read, so that nothing is
    written out twice; all but ``valid`` are null where the ray is not valid. Names with ``__`` are for the steps only."""
    c = F.col
    m = rig.rotation.tolist()
    ray = {f"__d{k}": (u - rig.cx) / rig.fx * row[0] + (v - rig.cy) / rig.fy * row[1] + row[2] for k, row in zip("xyz", m, strict=True)}
    scale = {"__k": -rig.height_m / F.when(c("__dz") < -1e-4, c("__dz"))}
    place = {"__x": c("__k") * c("__dx"), "__y": c("__k") * c("__dy")}
    reach = {"__r": F.sqrt(c("__x") * c("__x") + c("__y") * c("__y"))}
    valid = {"valid": F.coalesce((c("__r") >= rig.min_range_m) & (c("__r") <= rig.max_range_m) & (c("__x") > 0), F.lit(False))}
    x = c("__x")
    pixel, tilt = x * x / (rig.height_m * rig.fy) * rig.sigma_v_px, x * x / rig.height_m * math.radians(rig.sigma_pitch_deg)
    side = x / rig.fx * rig.sigma_v_px
    out = {"X": x, "Y": c("__y"), "range_m": c("__r"), "var_xx": pixel * pixel + tilt * tilt, "var_yy": side * side, "cov_xy": F.lit(0.0)}
    return [ray, scale, place, reach, valid, {k: F.when(c("valid"), e) for k, e in out.items()}]


def pixel(x: Column, y: Column, rig: Rig) -> tuple[Column, Column]:
    """Where a ground point is seen; null behind the camera."""
    back = rig.rotation.T.tolist()
    right, down, ahead = (x * row[0] + y * row[1] - rig.height_m * row[2] for row in back)
    ahead = F.when(ahead > 0, ahead)
    return rig.fx * right / ahead + rig.cx, rig.fy * down / ahead + rig.cy
