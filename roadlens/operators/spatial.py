"""Lines as segment rows, grid joins and geometry checks.

Segments are (key, seg, x1, y1, x2, y2) with ``size`` (their length) and ``start`` (length before them).
Pairs that can touch are found by the grid cells that their boxes cover; a pair is judged in the first
cell that both have, so it comes once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def segments(points: DataFrame, key: str, order: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """Ordered points of lines to their segments."""
    w = Window.partitionBy(key).orderBy(*order)
    out = points.select(key, (F.row_number().over(w) - 1).alias("seg"), F.col(x).alias("x1"), F.col(y).alias("y1"), F.lead(x).over(w).alias("x2"), F.lead(y).over(w).alias("y2")).filter("x2 is not null")
    out = out.withColumn("size", F.sqrt(F.pow(F.col("x2") - F.col("x1"), 2) + F.pow(F.col("y2") - F.col("y1"), 2)))
    return out.withColumn("start", F.sum("size").over(Window.partitionBy(key).orderBy("seg").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))


def trimmed(lines: DataFrame, key: str, head: Column, tail: Column) -> DataFrame:
    """Segments without ``head`` metres at the start and ``tail`` at the end; cut ends are interpolated."""
    total = F.sum("size").over(Window.partitionBy(key))
    out = lines.withColumn("_from", F.greatest(F.col("start"), head)).withColumn("_to", F.least(F.col("start") + F.col("size"), total - tail)).filter("_to > _from")
    at = lambda c, d: F.col(f"{c}1") + (F.col(f"{c}2") - F.col(f"{c}1")) * (d - F.col("start")) / F.col("size")
    cut = out.select(key, "seg", at("x", F.col("_from")).alias("a"), at("y", F.col("_from")).alias("b"), at("x", F.col("_to")).alias("c"), at("y", F.col("_to")).alias("d"), (F.col("_to") - F.col("_from")).alias("size"))
    return cut.withColumnsRenamed({"a": "x1", "b": "y1", "c": "x2", "d": "y2"})


def along_line(lines: DataFrame, key: str, points: DataFrame, point: str) -> DataFrame:
    """points (key, point, px, py) to (key, point, distance, along): the nearest place of the point's own line."""
    both = points.join(lines, key)
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    share = F.when(F.col("size") > 0, ((F.col("px") - F.col("x1")) * dx + (F.col("py") - F.col("y1")) * dy) / (F.col("size") * F.col("size"))).otherwise(0.0)
    both = both.withColumn("_t", F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)))
    far = F.sqrt(F.pow(F.col("px") - F.col("x1") - F.col("_t") * dx, 2) + F.pow(F.col("py") - F.col("y1") - F.col("_t") * dy, 2))
    near = both.groupBy(key, point).agg(F.min(F.struct(far.alias("distance"), (F.col("start") + F.col("_t") * F.col("size")).alias("along"))).alias("m"))
    return near.select(key, point, "m.distance", "m.along")


def pose_at(lines: DataFrame, key: str, asked: DataFrame) -> DataFrame:
    """asked (key, at) to (key, at, x, y, heading): clamped to the ends; the earlier segment at a joint."""
    ends = lines.groupBy(key).agg(F.max(F.col("start") + F.col("size")).alias("_total"))
    want = asked.join(ends, key).withColumn("_d", F.least(F.greatest(F.col("at"), F.lit(0.0)), F.col("_total")))
    both = want.join(lines, key).filter((F.col("size") > 0) & (F.col("_d") >= F.col("start")) & (F.col("_d") <= F.col("start") + F.col("size")))
    t = (F.col("_d") - F.col("start")) / F.col("size")
    pose = F.struct("seg", (F.col("x1") + t * (F.col("x2") - F.col("x1"))).alias("x"), (F.col("y1") + t * (F.col("y2") - F.col("y1"))).alias("y"), F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")).alias("heading"))
    return both.groupBy(key, "at").agg(F.min(pose).alias("p")).select(key, "at", "p.x", "p.y", "p.heading")


def same_lines(ends: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Lines (line, a, b, x1, y1, x2, y2, size) between nodes a and b that are equal from either end: (kept, dropped).

    The larger id is dropped. Lines are compared that join the same two nodes.
    """
    own = ends.withColumn("_lo", F.least("a", "b")).withColumn("_hi", F.greatest("a", "b"))
    other = own.select("_lo", "_hi", *(F.col(c).alias(f"o_{c}") for c in ("line", "x1", "y1", "x2", "y2", "size")))
    near = lambda p, q: (F.abs(F.col(f"x{p}") - F.col(f"o_x{q}")) <= tolerance) & (F.abs(F.col(f"y{p}") - F.col(f"o_y{q}")) <= tolerance)
    same = ((near(1, 1) & near(2, 2)) | (near(1, 2) & near(2, 1))) & (F.abs(F.col("size") - F.col("o_size")) <= tolerance)
    return own.join(other, ["_lo", "_hi"]).filter((F.col("line") < F.col("o_line")) & same).select(F.col("line").alias("kept"), F.col("o_line").alias("dropped"))


def cells(x1: Column, y1: Column, x2: Column, y2: Column, cell: float, margin: float = 0.0) -> Column:
    """Grid cells that a box covers, with a margin around it."""
    side = lambda a, b: F.sequence(F.floor((F.least(a, b) - margin) / cell).cast("long"), F.floor((F.greatest(a, b) + margin) / cell).cast("long"))
    return F.flatten(F.transform(side(x1, x2), lambda i: F.transform(side(y1, y2), lambda j: F.struct(i.alias("i"), j.alias("j")))))


def _box(prefix: str, cell: float, margin: float = 0.0) -> Column:
    c = lambda n: F.col(f"{prefix}{n}")
    return cells(c("x1"), c("y1"), c("x2"), c("y2"), cell, margin)


def crossings(lines: DataFrame, cell: float) -> DataFrame:
    """Pairs of lines (line, a, b, x1, y1, x2, y2: ends and their nodes) that cross or touch without a shared node: (line, other)."""
    own = lines.withColumn("c", F.explode(_box("", cell)))
    other = lines.select(*(F.col(n).alias(f"o_{n}") for n in ("line", "a", "b", "x1", "y1", "x2", "y2"))).withColumn("c", F.explode(_box("o_", cell)))
    side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    p, q, r, s = ((F.col(f"{o}x{i}"), F.col(f"{o}y{i}")) for o in ("", "o_") for i in (1, 2))
    apart = lambda a, b: (F.signum(a) * F.signum(b)) <= 0
    meet = apart(side(p, q, r), side(p, q, s)) & apart(side(r, s, p), side(r, s, q))
    box = (F.least("x1", "x2") <= F.greatest("o_x1", "o_x2")) & (F.least("o_x1", "o_x2") <= F.greatest("x1", "x2")) & (F.least("y1", "y2") <= F.greatest("o_y1", "o_y2")) & (F.least("o_y1", "o_y2") <= F.greatest("y1", "y2"))
    fresh = ~(F.col("a").isin(F.col("o_a"), F.col("o_b")) | F.col("b").isin(F.col("o_a"), F.col("o_b")))
    # The first common cell of two boxes has the larger of their least cells.
    first = lambda a, b, o_a, o_b: F.greatest(F.floor(F.least(a, b) / cell), F.floor(F.least(o_a, o_b) / cell))
    once = (F.col("c.i") == first("x1", "x2", "o_x1", "o_x2")) & (F.col("c.j") == first("y1", "y2", "o_y1", "o_y2"))
    return own.join(other, "c").filter((F.col("line") < F.col("o_line")) & once & box & fresh & meet).select("line", F.col("o_line").alias("other"))


def nearest_line(points: DataFrame, lines: DataFrame, reach: float) -> DataFrame:
    """points (point, px, py, heading) to the nearest line within reach: (point, line, distance, wrong_way).

    Wrong way is a heading of over 120 degrees from the line's; points without a line aren't returned.
    """
    own = points.withColumn("c", F.struct(F.floor(F.col("px") / reach).cast("long").alias("i"), F.floor(F.col("py") / reach).cast("long").alias("j")))
    near = own.join(lines.withColumn("c", F.explode(_box("", reach, reach))), "c")
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    size2 = dx * dx + dy * dy
    t = F.when(size2 > 0, F.least(F.greatest(((F.col("px") - F.col("x1")) * dx + (F.col("py") - F.col("y1")) * dy) / size2, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    near = near.withColumn("_t", t).withColumn("distance", F.sqrt(F.pow(F.col("px") - F.col("x1") - F.col("_t") * dx, 2) + F.pow(F.col("py") - F.col("y1") - F.col("_t") * dy, 2)))
    near = near.filter(F.col("distance") <= reach).withColumn("_w", F.cos(F.col("heading") - F.atan2(dy, dx)) < -0.5)
    return near.groupBy("point").agg(F.min(F.struct("distance", "line", F.col("_w").alias("wrong_way"))).alias("m")).select("point", "m.line", "m.distance", "m.wrong_way")


def geometry_faults(points: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """(key, fault) of lines: not_finite, too_few, no_length, not_simple.

    A line isn't simple if segments of it that aren't neighbours cross or touch, or one turns straight back on the one
    before it. Repeated points are no fault, and a ring may close.
    """
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    own = points.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.bool_and(finite("x") & finite("y")).alias("finite"))
    length = lines.groupBy(key).agg(F.sum("size").alias("length"))
    basic = own.join(length, key, "left")
    fault = F.when(~F.col("finite"), "not_finite").when(F.col("n") < 2, "too_few").when(F.coalesce("length", F.lit(0.0)) <= 0, "no_length")
    w = Window.partitionBy(key).orderBy("seg")
    long = lines.filter("size > 0").withColumn("n", F.row_number().over(w)).withColumn("end", F.count(F.lit(1)).over(Window.partitionBy(key)))
    other = long.select(key, *(F.col(c).alias(f"o_{c}") for c in ("n", "x1", "y1", "x2", "y2")))
    box = " and ".join(f"least({p}{c}1, {p}{c}2) <= greatest({q}{c}1, {q}{c}2)" for c in "xy" for p, q in (("", "o_"), ("o_", "")))
    pairs = long.join(other, key).filter(f"o_n > n and {box}")  # within one line only
    cross = lambda x1, y1, x2, y2, x, y: (F.col(x2) - F.col(x1)) * (F.col(y) - F.col(y1)) - (F.col(y2) - F.col(y1)) * (F.col(x) - F.col(x1))
    a, b = cross("x1", "y1", "x2", "y2", "o_x1", "o_y1"), cross("x1", "y1", "x2", "y2", "o_x2", "o_y2")
    c, d = cross("o_x1", "o_y1", "o_x2", "o_y2", "x1", "y1"), cross("o_x1", "o_y1", "o_x2", "o_y2", "x2", "y2")
    meet = (F.signum(a) * F.signum(b) <= 0) & (F.signum(c) * F.signum(d) <= 0)
    closes = (F.col("n") == 1) & (F.col("o_n") == F.col("end")) & (F.col("x1") == F.col("o_x2")) & (F.col("y1") == F.col("o_y2"))
    ahead = (F.col("x2") - F.col("x1")) * (F.col("o_x2") - F.col("o_x1")) + (F.col("y2") - F.col("y1")) * (F.col("o_y2") - F.col("o_y1"))
    joined = (F.col("o_n") == F.col("n") + 1) | closes
    # The end that neighbours share aside: the far end of the one is on the line of the other, and it leads back.
    back = F.when(F.col("o_n") == F.col("n") + 1, b == 0).otherwise(a == 0) & (ahead < 0)
    bad = F.when(joined, back).otherwise(meet)
    crossed = pairs.filter(bad).select(key).distinct().withColumn("fault", F.lit("not_simple"))
    return basic.select(key, fault.alias("fault")).filter("fault is not null").unionByName(crossed)


def inside(fixes: DataFrame, box: DataFrame, x: str, y: str, pad: float) -> DataFrame:
    """Fixes with whether they lie in the padded box (one row: min_x, min_y, max_x, max_y)."""
    both = fixes.crossJoin(F.broadcast(box.select("min_x", "min_y", "max_x", "max_y")))  # the box is one row
    return both.withColumn("inside", F.col(x).between(F.col("min_x") - pad, F.col("max_x") + pad) & F.col(y).between(F.col("min_y") - pad, F.col("max_y") + pad)).drop("min_x", "min_y", "max_x", "max_y")


def source_audit(source: DataFrame, graph: DataFrame, key: str, tags: list[str], x: str, y: str, tolerance: float = 1e-12, directions: str | None = None) -> DataFrame:
    """Ids that differ between a source and its graph: (key, fault): missing, extra, tag, coordinate or direction mismatch.

    A coordinate that one side lacks is a mismatch. ``directions`` is a column of the ways of travel, if there is one.
    """
    way = F.col(directions) if directions else F.lit(None).cast("string")
    side = lambda df, n: df.select(key, F.struct(*tags).alias(f"{n}_tags"), F.col(x).alias(f"{n}_x"), F.col(y).alias(f"{n}_y"), way.alias(f"{n}_way"), F.lit(True).alias(n))
    both = side(source, "s").join(side(graph, "g"), key, "full_outer")
    there = F.col("s").isNotNull() & F.col("g").isNotNull()
    off = lambda c: ~F.col(f"s_{c}").eqNullSafe(F.col(f"g_{c}")) & F.coalesce(F.abs(F.col(f"s_{c}") - F.col(f"g_{c}")) > tolerance, F.lit(True))
    far = off("x") | off("y")
    faults = [F.when(F.col("g").isNull(), "missing"), F.when(F.col("s").isNull(), "extra"), F.when(there & ~F.col("s_tags").eqNullSafe(F.col("g_tags")), "tag_mismatch"), F.when(there & far, "coordinate_mismatch"), F.when(there & ~F.col("s_way").eqNullSafe(F.col("g_way")), "direction_mismatch")]
    return both.select(key, F.explode(F.array_compact(F.array(*faults))).alias("fault"))


def tagged_edges(edges: DataFrame, warnings: DataFrame, way: str) -> DataFrame:
    """Edges with the sorted warning codes (way, code) of their way; none is an empty array."""
    codes = warnings.groupBy(way).agg(F.sort_array(F.collect_set("code")).alias("codes"))
    return edges.join(codes, way, "left").withColumn("codes", F.coalesce("codes", F.array().cast("array<string>")))


def preflight(edges: DataFrame, components: DataFrame) -> DataFrame:
    """Issues (code, id, reason) of a network's edges (edge, u, x, y, lanes, oneway, reversed), each once.

    components (id, component) of the nodes: one issue for each beyond the largest. A network without edges has
    one issue, empty, without an id.
    """
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    bad = {
        "bad_coordinate": ~finite("x") | ~finite("y"), "missing_lanes": F.col("lanes").isNull(),
        "conflicting_direction": F.col("oneway") & F.col("reversed"),
    }
    own = edges.select(F.explode(F.array_compact(F.array(*[F.when(c, n) for n, c in bad.items()]))).alias("code"), F.col("edge").alias("id"))
    sizes = components.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max(F.struct("n", (-F.col("component")).alias("c"))).alias("m"))
    apart = sizes.crossJoin(F.broadcast(largest)).filter(F.col("component") != -F.col("m.c")).select(F.lit("disconnected").alias("code"), F.col("component").alias("id"))  # one row
    empty = edges.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(F.lit("empty").alias("code"), F.lit(None).cast(dict(edges.dtypes)["edge"]).alias("id"))
    return own.unionByName(apart).unionByName(empty).distinct()
