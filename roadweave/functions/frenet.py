"""Along-road and lateral coordinates, and the distance between two of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadweave.functions.scalar import half_even, wrap_degrees

LEAST_VARIANCE = 1e-4


def obstacle(s: Column, t: Column, heading: Column, bearing: Column, x: Column, y: Column, var_xx: Column, var_yy: Column, cov_xy: Column, length: Column) -> dict[str, Column]:
    """An obstacle at (``x`` ahead, ``y`` left) of a vehicle at (``s``, ``t``) on an edge; a null ``length`` sets no end."""
    delta = wrap_degrees(heading - bearing)
    sin, cos = F.sin(F.radians(delta)), F.cos(F.radians(delta))
    along, across = s + x * cos - y * sin, t + x * sin + y * cos
    along = F.when(length.isNull(), along).otherwise(F.least(F.greatest(along, F.lit(0.0)), length))
    var_s = cos * cos * var_xx - 2 * cos * sin * cov_xy + sin * sin * var_yy
    var_t = sin * sin * var_xx + 2 * cos * sin * cov_xy + cos * cos * var_yy
    cov_st = cos * sin * (var_xx - var_yy) + (cos * cos - sin * sin) * cov_xy
    sd = lambda v: half_even(F.sqrt(F.greatest(v, F.lit(LEAST_VARIANCE))), 3)
    return {"s": half_even(along, 3), "t": half_even(across, 3), "sigma_s": sd(var_s), "sigma_t": sd(var_t), "cov_st": half_even(cov_st, 4), "heading_delta_deg": half_even(delta, 2)}


def forward_side(s: Column, t: Column, length: Column, reverse: Column) -> tuple[Column, Column]:
    """Coordinates of a twin edge as those of the forward one."""
    turned = F.least(F.greatest(length - s, F.lit(0.0)), length)
    return F.when(reverse, turned).otherwise(s), F.when(reverse, -t).otherwise(t)


def mahalanobis2(s1: Column, t1: Column, vs1: Column, vt1: Column, s2: Column, t2: Column, vs2: Column, vt2: Column) -> Column:
    least = F.lit(LEAST_VARIANCE)
    return (s1 - s2) ** 2 / F.greatest(vs1 + vs2, least) + (t1 - t2) ** 2 / F.greatest(vt1 + vt2, least)
