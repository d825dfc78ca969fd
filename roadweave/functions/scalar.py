"""Scalar rules shared by the operators: angles, rounding, raw road tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Defaults by road type.
LANES = {
    "motorway": 4, "motorway_link": 2, "trunk": 3, "trunk_link": 2, "primary": 2, "primary_link": 1, "secondary": 2,
    "secondary_link": 1, "tertiary": 2, "tertiary_link": 1, "residential": 1, "living_street": 1, "unclassified": 1, "service": 1,
}
MAXSPEED = {
    "motorway": 80, "trunk": 60, "primary": 50, "secondary": 40, "tertiary": 35, "residential": 30, "living_street": 20,
    "unclassified": 30, "service": 20,
}


def _default(highway: Column, table: dict[str, int], other: int) -> Column:
    pairs = [x for k, v in table.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), highway), F.lit(other))


def wrap_degrees(angle: Column) -> Column:
    """Into [-180, 180), with a remainder that is never negative."""
    return F.pmod(angle + 180.0, F.lit(360.0)) - 180.0


def half_even(x: Column, places: int = 0) -> Column:
    return F.bround(x, places)


def first_scalar(tag: Column) -> Column:
    """The first of a list-valued tag."""
    return F.try_element_at(tag, F.lit(1))


def highway_type(tag: Column) -> Column:
    return F.coalesce(F.lower(F.trim(tag)), F.lit("unclassified"))


def lanes(tag: Column, highway: Column) -> Column:
    """The whole number before the first semicolon if positive, else the road type's default."""
    head = F.trim(F.split_part(tag, F.lit(";"), F.lit(1)))
    n = F.when(head.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), head.try_cast("double")).try_cast("int")
    return F.when(n > 0, n).otherwise(_default(highway, LANES, 1))


def maxspeed(tag: Column, highway: Column) -> Column:
    """Km/h: the first number, miles converted, if it lies in 10 to 150, else the road type's default."""
    low = F.lower(F.trim(tag))
    n = F.regexp_extract(low, r"(\d+)", 1).try_cast("int")
    kph = F.when(low.contains("mph"), (n * 1.60934).cast("int")).otherwise(n)
    return F.when(kph.between(10, 150), kph).otherwise(_default(highway, MAXSPEED, 40))


def width(tag: Column, lane_count: Column) -> Column:
    """Metres, after every letter m is dropped; 1.5 to 60, else 3.5 a lane."""
    text = F.trim(F.replace(F.lower(tag), F.lit("m"), F.lit("")))
    w = F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))
    return F.when(w.between(1.5, 60.0), half_even(w, 2)).otherwise(half_even(lane_count * 3.5, 2))


def oneway(tag: Column) -> Column:
    return F.coalesce(F.lower(F.trim(tag)).isin("yes", "true", "1", "-1"), F.lit(False))


def surface(tag: Column) -> Column:
    return F.coalesce(F.nullif(tag, F.lit("")), F.lit("asphalt"))


def edge_id(u: Column, v: Column, key: Column) -> Column:
    return F.concat_ws("_", u.cast("string"), v.cast("string"), key.cast("string"))
