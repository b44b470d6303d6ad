"""Fewer vertices of a line: thinning within a tolerance, and removal of repeats."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from roadlens.operators.directed import numbered
from roadlens.session import discard, materialize

TOLERANCE_M = 0.005
COINCIDENT_M = 1e-6
#: Rows of one scan of ``without_repeats``.
CHUNK = 65_536
MAX_ROUNDS = 100_000


def thinned(points: DataFrame, tolerance: float = TOLERANCE_M, name: str = "thinned") -> DataFrame:
    """points (line, pos, x, y) without those within ``tolerance`` of the chord of what is kept.

    Both ends stay. In each round every open span is split at its farthest point (ties: the first), if that is over the
    tolerance off; a span without one is done. Rows carry the ends of their span, so a round is one
    aggregate, combined before its shuffle, and one join; no line has to fit a task. pos is unique in a line,
    gaps are fine. A point without coordinates is never the farthest; a span between such ends has no chord.
    """
    ends = points.groupBy("line").agg(F.min_by(F.struct("pos", "x", "y"), "pos").alias("a"), F.max_by(F.struct("pos", "x", "y"), "pos").alias("b"))
    kept = [ends.select("line", F.explode(F.array("a", "b")).alias("p")).select("line", "p.*").distinct()]
    open_ = points.select("line", "pos", "x", "y").join(ends, "line").filter((F.col("pos") > F.col("a.pos")) & (F.col("pos") < F.col("b.pos")))
    held = materialize(open_, name)
    for _ in range(MAX_ROUNDS):
        dx, dy = F.col("b.x") - F.col("a.x"), F.col("b.y") - F.col("a.y")
        size = F.sqrt(dx * dx + dy * dy)
        px, py = F.col("x") - F.col("a.x"), F.col("y") - F.col("a.y")
        off = F.when(size < 1e-12, F.sqrt(px * px + py * py)).otherwise(F.abs(px * (-dy / size) + py * (dx / size)))
        far = held.select("line", F.col("a.pos").alias("span"), F.struct("pos", "x", "y").alias("m"), off.alias("off")).filter(F.col("off") > tolerance).filter(~F.isnan("off"))
        far = materialize(far.groupBy("line", "span").agg(F.max_by("m", F.struct("off", (-F.col("m.pos")).alias("first"))).alias("m")), f"{name}-kept")
        if far.isEmpty():
            break
        kept.append(far.select("line", "m.*"))
        both = held.join(far, (held["line"] == far["line"]) & (held["a.pos"] == far["span"])).filter(held["pos"] != far["m.pos"])
        below = held["pos"] < far["m.pos"]
        new = both.select(held["line"], held["pos"], held["x"], held["y"], F.when(below, held["a"]).otherwise(far["m"]).alias("a"), F.when(below, far["m"]).otherwise(held["b"]).alias("b"))
        new = materialize(new, name)
        discard(held)
        held = new
    return reduce(DataFrame.unionByName, kept)


def _scan(tolerance: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("number")
        line, last = rows["entry_line"].iloc[0], (rows["entry_x"].iloc[0], rows["entry_y"].iloc[0])
        started = bool(rows["entered"].iloc[0])
        keep = []
        for own, x, y in zip(rows["line"], rows["x"], rows["y"], strict=True):
            kept = not started or own != line or not (((x - last[0]) ** 2 + (y - last[1]) ** 2) ** 0.5 <= tolerance)
            keep.append(kept)
            if kept:
                line, last, started = own, (x, y), True
        return rows.assign(keep=keep)[["chunk", "number", "line", "pos", "x", "y", "keep"]]

    return run


def without_repeats(points: DataFrame, tolerance: float = COINCIDENT_M, chunk: int = CHUNK, name: str = "repeats") -> DataFrame:
    """points (line, pos, x, y) without those within ``tolerance`` of the last point *kept* before them.

    Creeping points are so kept once the sum of their steps is over the tolerance. Lines are laid end to end and
    scanned in chunks of so many rows, at first each as if nothing were kept before it; then those chunks again whose
    entry, the last point kept in the chunk before, is of their line and new, until none is. As a rule
    that takes two rounds, as scans agree after their first common point. Rows without coordinates are kept.
    """
    spot = "chunk long, number long, line {0}, pos {1}, x double, y double"
    kinds = dict(points.dtypes)
    schema = spot.format(kinds["line"], kinds["pos"])
    rows = numbered(points.select("line", "pos", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).filter("line is not null"), ["line", "pos"], name=f"{name}-numbers")
    rows = materialize(rows.select(F.floor(F.col("number") / chunk).alias("chunk"), "number", "line", "pos", "x", "y"), f"{name}-rows")
    first = rows.groupBy("chunk").agg(F.min_by("line", "number").alias("starts"))
    entry = rows.select("chunk").distinct().select("chunk", F.lit(False).alias("entered"), F.lit(None).cast(kinds["line"]).alias("entry_line"), F.lit(None).cast("double").alias("entry_x"), F.lit(None).cast("double").alias("entry_y"))
    entry, again = materialize(entry, f"{name}-entries"), None
    held = None
    for _ in range(MAX_ROUNDS):
        todo = entry if again is None else again
        new = rows.join(todo, "chunk").groupBy("chunk").applyInPandas(_scan(tolerance), f"{schema}, keep boolean")
        new = materialize(new if held is None else held.join(todo, "chunk", "left_anti").unionByName(new), f"{name}-scanned")
        if held is not None:
            discard(held)
        held = new
        # A row a chunk.
        exits = held.filter("keep").groupBy((F.col("chunk") + 1).alias("chunk")).agg(F.max_by(F.struct("line", "x", "y"), "number").alias("e"))
        # A chunk in which nothing is kept hands its own entry on.
        came = entry.filter("entered").select((F.col("chunk") + 1).alias("chunk"), F.struct(F.col("entry_line").alias("line"), F.col("entry_x").alias("x"), F.col("entry_y").alias("y")).alias("e"))
        exits = exits.unionByName(came.join(exits, "chunk", "left_anti"))
        met = first.join(exits, "chunk").filter(F.col("starts") == F.col("e.line")).select("chunk", F.lit(True).alias("entered"), F.col("e.line").alias("entry_line"), F.col("e.x").alias("entry_x"), F.col("e.y").alias("entry_y"))
        same = entry.select(*met.columns).withColumn("_k", F.struct("entered", "entry_line", "entry_x", "entry_y"))
        fresh = met.withColumn("_n", F.struct("entered", "entry_line", "entry_x", "entry_y")).join(same.select("chunk", "_k"), "chunk").filter(~F.col("_n").eqNullSafe(F.col("_k")))
        again = materialize(fresh.drop("_n", "_k"), f"{name}-again")
        if again.isEmpty():
            return held.filter("keep").select("line", "pos", "x", "y")
        entry = materialize(entry.join(again, "chunk", "left_anti").unionByName(again), f"{name}-entries")
    raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
