"""Track operators: distance, headings, speed limits and arrival times along ordered samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _w(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def travelled(rows: DataFrame, keys: list[str], order: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """Add step (from the sample before) and along (running length)."""
    w = _w(keys, order)
    step = F.coalesce(F.sqrt(F.pow(F.col(x) - F.lag(x).over(w), 2) + F.pow(F.col(y) - F.lag(y).over(w), 2)), F.lit(0.0))
    return rows.withColumn("step", step).withColumn("along", F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def headings(rows: DataFrame, keys: list[str], order: list[str], x: str = "x", y: str = "y", least: float = 1e-3) -> DataFrame:
    """Add heading: steps under 1 mm keep the last one that moved, leading ones take the first."""
    w = _w(keys, order)
    dx, dy = F.lead(x).over(w) - F.col(x), F.lead(y).over(w) - F.col(y)
    own = rows.withColumn("_h", F.when(F.sqrt(dx * dx + dy * dy) >= least, F.atan2(dy, dx)))
    before = F.last("_h", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first("_h", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return own.withColumn("heading", F.coalesce(before, after)).drop("_h")


def bounded_speed(rows: DataFrame, keys: list[str], order: list[str], along: str, limit: str, accelerate: float, brake: float) -> DataFrame:
    """Add speed: the limit, held to what acceleration from behind and braking ahead allow.

    v(i)^2 <= v(j)^2 + 2 a (s(i) - s(j)) for all j before i is a running minimum of limit^2 - 2 a s.
    """
    w = _w(keys, order)
    ahead = F.min(F.pow(F.col(limit), 2) - 2 * accelerate * F.col(along)).over(w.rowsBetween(Window.unboundedPreceding, 0)) + 2 * accelerate * F.col(along)
    out = rows.withColumn("_f", ahead)
    back = F.min(F.col("_f") + 2 * brake * F.col(along)).over(w.rowsBetween(0, Window.unboundedFollowing)) - 2 * brake * F.col(along)
    return out.withColumn("speed", F.sqrt(F.greatest(F.lit(0.0), back))).drop("_f")


def arrivals(rows: DataFrame, keys: list[str], order: list[str], along: str, speed: str) -> DataFrame:
    """Add arrival seconds: each step at the mean of its two speeds."""
    w = _w(keys, order)
    mean = (F.col(speed) + F.lag(speed).over(w)) / 2
    dt = F.coalesce(F.when(mean > 0, (F.col(along) - F.lag(along).over(w)) / mean), F.lit(0.0))
    return rows.withColumn("_dt", dt).withColumn("arrival", F.sum("_dt").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_dt")


def circumradius(rows: DataFrame, keys: list[str], order: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """Add radius of the circle through a sample and its neighbours; null on a straight line."""
    w = _w(keys, order)
    px, py, nx, ny = F.lag(x).over(w), F.lag(y).over(w), F.lead(x).over(w), F.lead(y).over(w)
    side = lambda ax, ay, bx, by: F.sqrt(F.pow(ax - bx, 2) + F.pow(ay - by, 2))
    area2 = F.abs((F.col(x) - px) * (ny - py) - (nx - px) * (F.col(y) - py))
    product = side(px, py, F.col(x), F.col(y)) * side(F.col(x), F.col(y), nx, ny) * side(px, py, nx, ny)
    return rows.withColumn("radius", F.when(area2 > 1e-12, product / (2 * area2)))


def min_pool(rows: DataFrame, keys: list[str], along: str, value: str, size: float) -> DataFrame:
    """The least value of each stretch of ``size`` along a track."""
    return rows.groupBy(*keys, F.floor(F.col(along) / size).alias("pool")).agg(F.min(value).alias("least"))


def velocity(rows: DataFrame, keys: list[str], order: list[str], value: str, dt: float) -> DataFrame:
    """Add the forward difference over dt; the last row repeats the one before."""
    w = _w(keys, order)
    ahead = (F.lead(value).over(w) - F.col(value)) / dt
    return rows.withColumn("_v", ahead).withColumn("velocity", F.coalesce("_v", F.lag("_v").over(w))).drop("_v")


def resample(rows: DataFrame, keys: list[str], order: list[str], at: str, value: str, step: float) -> DataFrame:
    """An even grid of ``at``, both ends included, with linear interpolation between bracketing samples; equal ones count once."""
    w = _w(keys, order)
    last = F.max(at).over(Window.partitionBy(*keys))
    ends = rows.withColumn("_last", last).withColumn("_t", F.lead(at).over(w)).withColumn("_v", F.lead(value).over(w)).filter(F.col("_t") > F.col(at))
    low, high = F.ceil(F.col(at) / step), F.ceil(F.col("_t") / step) - F.when((F.col("_t") == F.col("_last")) & (F.pmod(F.col("_t"), F.lit(step)) == 0), 0).otherwise(1)
    grid = ends.withColumn("k", F.explode(F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))))
    share: Column = (F.col("k") * step - F.col(at)) / (F.col("_t") - F.col(at))
    return grid.select(*keys, "k", (F.col(value) + share * (F.col("_v") - F.col(value))).alias(value))
