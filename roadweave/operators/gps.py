"""GPS logs: aliases, clocks, speed, heading, and the pose at any instant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadweave.functions.scalar import half_even

# Names that logs give to the columns.
ALIASES = {
    "time": "timestamp", "t": "timestamp", "timestamp_s": "timestamp", "epoch": "timestamp", "latitude": "lat", "y": "lat", "longitude": "lon", "x": "lon",
    "bearing": "heading", "yaw": "heading", "velocity": "speed", "speed_kph": "speed",
}
METRES_A_DEGREE = 111139.0
MOST_GAP_S, MOST_SPEED = 1.0, 45.0
SLICE_S = 256.0  # seconds of a drive that a window looks through at once


def renamed(raw: DataFrame) -> DataFrame:
    """Known names for aliased columns; speeds keep their unit."""
    low = raw.toDF(*(c.strip().lower() for c in raw.columns))
    out = low.toDF(*(c if ALIASES.get(c, c) == c or ALIASES[c] in low.columns else ALIASES[c] for c in low.columns))
    missing = {"timestamp", "lat", "lon"} - set(out.columns)
    if missing:
        raise ValueError(f"GPS log without {sorted(missing)}")
    return out


def clock(raw: Column) -> Column:
    """Seconds from a number or hours-minutes-seconds-microseconds; 0 if neither."""
    part = lambda k: F.try_element_at(F.split(raw, "-"), F.lit(k)).try_cast("double")
    dashed = part(1) * 3600 + part(2) * 60 + part(3) + F.coalesce(part(4), F.lit(0.0)) / 1e6
    return F.coalesce(F.when(raw.rlike(r"^\d+(-\d+){2,3}$"), dashed).otherwise(raw.try_cast("double")), F.lit(0.0))


def rebased(log: DataFrame, order: str = "row") -> DataFrame:
    """Seconds since the first row of each sequence's file."""
    first = F.first_value("timestamp").over(Window.partitionBy("seq").orderBy(order))
    return log.withColumn("timestamp", half_even(F.col("timestamp") - first, 4))


def estimated_heading(log: DataFrame) -> DataFrame:
    """Forward difference in degrees; the last row keeps itself and so has 0."""
    w = Window.partitionBy("seq").orderBy("timestamp")
    step = lambda c: F.lead(c).over(w) - F.col(c)
    east, north = F.coalesce(step("lon"), F.lit(0.0)), F.coalesce(step("lat"), F.lit(0.0))
    return log.withColumn("heading", half_even(F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0)), 2))


def estimated_speed(log: DataFrame) -> DataFrame:
    """Forward difference in metres a second, one cosine for a whole sequence, 0 to 40."""
    w, whole = Window.partitionBy("seq").orderBy("timestamp"), Window.partitionBy("seq")
    step = lambda c: F.coalesce(F.lead(c).over(w) - F.col(c), F.lit(0.0))
    dt = F.coalesce(F.lead("timestamp").over(w) - F.col("timestamp"), F.lit(0.1))
    narrow = F.cos(F.radians(F.avg("lat").over(whole)))
    metres = F.hypot(step("lon") * METRES_A_DEGREE * narrow, step("lat") * METRES_A_DEGREE)
    return log.withColumn("speed", half_even(F.least(F.greatest(metres / F.when(dt <= 0.01, 0.1).otherwise(dt), F.lit(0.0)), F.lit(40.0)), 2))


def _filled(log: DataFrame, column: str, estimate) -> DataFrame:
    """``column`` as it is where a sequence has any value of it, else estimated for the whole sequence."""
    if column not in log.columns:
        return estimate(log)
    known = F.max(F.col(column).cast("double").isNotNull() & ~F.isnan(F.col(column).cast("double"))).over(Window.partitionBy("seq"))
    kept = log.withColumns({"__own": F.col(column).cast("double"), "__known": known})
    return estimate(kept).withColumn(column, F.when(F.col("__known"), F.col("__own")).otherwise(F.col(column))).drop("__own", "__known")


def normalised(raw: DataFrame, order: str = "row") -> DataFrame:
    """A drive's log as the engine reads it: known names, seconds since the first row, places as numbers, and heading and speed,
    estimated for a sequence only where it lacks them. ``raw`` has ``seq`` and ``order`` (a row's place in its file)."""
    log = renamed(raw)
    log = rebased(log.withColumn("timestamp", clock(F.col("timestamp").cast("string"))), order)
    log = log.withColumns({"lat": F.col("lat").cast("double"), "lon": F.col("lon").cast("double")})
    return _filled(_filled(log, "heading", estimated_heading), "speed", estimated_speed)


def planar_speed_heading(log: DataFrame) -> DataFrame:
    """A log of ``x``, ``y`` in metres with ``speed`` and ``heading``: those it has, else ``speed_mps`` and ``heading_deg``, else
    speed by backward and heading by forward difference."""
    w = Window.partitionBy("seq").orderBy("timestamp")
    back = lambda c: F.col(c) - F.lag(c).over(w)
    ahead = lambda c: F.coalesce(F.lead(c).over(w) - F.col(c), F.lit(0.0))
    dt = F.when(back("timestamp") <= 1e-4, 0.1).otherwise(back("timestamp"))
    speed = F.coalesce(F.hypot(back("x"), back("y")) / dt, F.lit(0.0))
    heading = F.pmod(F.degrees(F.atan2(ahead("x"), ahead("y"))), F.lit(360.0))
    choose = lambda names, other: next((F.col(c).cast("double") for c in names if c in log.columns), other)
    return log.withColumns({"speed": choose(("speed", "speed_mps"), speed), "heading": choose(("heading", "heading_deg"), heading)})


def _turn(raw: Column) -> Column:
    """The short way round of a difference of headings; half a turn keeps its sign."""
    turn = F.pmod(raw + 180.0, F.lit(360.0)) - 180.0
    return F.when((turn == -180.0) & (raw > 0), 180.0).otherwise(turn)


def unwrapped(log: DataFrame) -> DataFrame:
    """``heading_unwrapped``: no jump of more than half a turn between rows of a sequence."""
    w = Window.partitionBy("seq").orderBy("timestamp")
    turn = _turn(F.col("heading") - F.lag("heading").over(w))
    first = F.first_value("heading").over(w)
    return log.withColumn("turn", F.coalesce(turn, F.lit(0.0))).withColumn("heading_unwrapped", first + F.sum("turn").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("turn")


def poses(queries: DataFrame, log: DataFrame, columns: tuple[str, ...] = ("x", "y", "speed"), offset: float = 0.0) -> DataFrame:
    """``queries`` (``seq``, ``frame_ts`` and more) with interpolated ``columns``, ``heading`` and ``gps_valid``.

    An as-of join to both sides: log and queries are one table in time order, and each query carries the last fix at or
    before it and the first at or after it. Outside the log the nearest end holds. A drive of any length is gone through in
    slices of ``SLICE_S``, each with the nearest fixes of the slices before and after it.
    """
    parts = {"t": "timestamp", **{c: c for c in columns}, "heading": "heading"}
    fixes = log.select("seq", F.col("timestamp").alias("at"), F.struct(*(F.col(c).alias(k) for k, c in parts.items())).alias("fix"))
    asked = queries.select("seq", (F.col("frame_ts") + offset).alias("at"), F.struct(*queries.columns).alias("row"))
    both = fixes.withColumn("row", F.lit(None).cast(asked.schema["row"].dataType)).unionByName(asked.withColumn("fix", F.lit(None).cast(fixes.schema["fix"].dataType)))
    at = F.col("at").cast("double")
    most = F.lit(2**62)  # in the order of ``at``: null before, NaN after all else
    both = both.withColumn("slice", F.when(at.isNull(), -most).when(F.isnan(at), most).otherwise(F.least(F.greatest(F.floor(at / SLICE_S), -most), most)))
    end = lambda f, by: F.when(f("fix.t").isNotNull(), F.struct(*(by(f"fix.{k}", "fix.t").alias(k) for k in parts)))
    ends = both.groupBy("seq", "slice").agg(end(F.min, F.min_by).alias("first"), end(F.max, F.max_by).alias("last"))  # a row a slice
    earlier, later = (Window.partitionBy("seq").orderBy(k).rowsBetween(Window.unboundedPreceding, -1) for k in ("slice", F.desc("slice")))
    near = ends.select("seq", "slice", F.last("last", ignorenulls=True).over(earlier).alias("p"), F.last("first", ignorenulls=True).over(later).alias("q"))
    near = near.select("seq", "slice", F.explode(F.array("p", "q")).alias("fix")).where("fix IS NOT NULL")
    both = both.unionByName(near.select("seq", F.col("fix.t").alias("at"), "slice", "fix"), allowMissingColumns=True)
    w = Window.partitionBy("seq", "slice").orderBy("at")  # equal instants are one range: a query meets a fix of its own instant
    before = F.last("fix", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0))
    back = Window.partitionBy("seq", "slice").orderBy(F.desc("at"))  # backwards, as a frame to the end would be gone through for each row
    after = F.last("fix", ignorenulls=True).over(back.rangeBetween(Window.unboundedPreceding, 0))
    met = both.withColumns({"p": before, "q": after}).where("row IS NOT NULL")
    p, q = F.coalesce("p", "q"), F.coalesce("q", "p")
    share = F.when(q["t"] > p["t"], (F.col("at") - p["t"]) / (q["t"] - p["t"])).otherwise(0.0)
    mid = lambda c: p[c] + share * (q[c] - p[c])
    heading = F.coalesce(p["heading"], q["heading"]) + share * F.coalesce(_turn(q["heading"] - p["heading"]), F.lit(0.0))
    near = F.least(F.abs(F.col("at") - p["t"]), F.abs(q["t"] - F.col("at")))
    valid = F.col("p").isNotNull() & F.col("q").isNotNull() & (near <= MOST_GAP_S)
    out = met.select("row.*", *(mid(c).alias(f"ego_{c}") for c in columns), F.pmod(heading, F.lit(360.0)).alias("ego_heading"), F.coalesce(valid, F.lit(False)).alias("gps_valid"))
    return out.withColumn("gps_valid", F.col("gps_valid") & (F.col("ego_speed") <= MOST_SPEED)) if "speed" in columns else out


def bbox(log: DataFrame, margin: float = 0.0015) -> DataFrame:
    edge = lambda f, c, d: half_even(f(c) + d, 4)
    return log.agg(edge(F.min, "lon", -margin).alias("west"), edge(F.min, "lat", -margin).alias("south"), edge(F.max, "lon", margin).alias("east"), edge(F.max, "lat", margin).alias("north"))
