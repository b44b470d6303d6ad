"""Queries on geometry: a way is an order's parts at (size, price); customers are short lines, suppliers points."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlens.functions import lines as scalars
from roadlens.operators import lanes, roads, spatial
from roadlens.plans.roads import pairs_of
from roadlens.plans.tables import NODES_SQL, table, way_nodes


def _points(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"))
    return way_nodes(spark, sf_dir).join(part, "l_partkey")


def _segments(spark, sf_dir):
    return spatial.segments(_points(spark, sf_dir), "l_orderkey", ["pos"])


def _lines(spark, sf_dir):
    """Customers as lines of a few metres."""
    x, y, k = F.col("c_nationkey") * 10.0 + F.col("c_custkey") % 10, F.col("c_acctbal") / 50, F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("line"), (k % 40).alias("a"), (k % 40 + 50).alias("b"), x.alias("x1"), y.alias("y1"), (x + k % 7 / 2.0 - 1.5).alias("x2"), (y + k % 5 / 2.0 - 1).alias("y2"))


def trimmed_lines(spark, sf_dir):
    """SC-02: ways without a metre at the start and two at the end."""
    out = spatial.trimmed(_segments(spark, sf_dir), "l_orderkey", F.lit(1.0), F.lit(2.0))
    return out.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("size"), 3).alias("length"), F.round(F.min_by("x1", "seg"), 4).alias("first_x"))


def points_on_lines(spark, sf_dir):
    """SC-03: a point for each way."""
    p = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(0).alias("point"), (F.col("o_custkey") % 50).cast("double").alias("px"), (F.lit(900.0) + F.col("o_custkey") % 1000).alias("py"))
    return spatial.along_line(_segments(spark, sf_dir), "l_orderkey", p, "point").select("l_orderkey", F.round("distance", 4).alias("distance"))


def poses(spark, sf_dir):
    """SC-04: where each way is after 100 metres."""
    asked = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(100.0).alias("at"))
    out = spatial.pose_at(_segments(spark, sf_dir), "l_orderkey", asked)
    return out.select("l_orderkey", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), F.round("heading", 5).alias("heading"))


def same_lines(spark, sf_dir):
    """SC-05: customers as lines between their nations, drawn by segment and balance class."""
    k = table(spark, sf_dir, "customer")
    place, size = F.col("c_nationkey").cast("double"), F.floor(F.col("c_acctbal") / 2000) * 1.0
    lines = k.select(F.col("c_custkey").alias("line"), "c_nationkey", F.col("c_nationkey").alias("a"), F.length("c_mktsegment").alias("b"), place.alias("x1"), size.alias("y1"), size.alias("x2"), place.alias("y2"), size.alias("size"))
    return spatial.same_lines(lines.drop("c_nationkey"))


def line_crossings(spark, sf_dir):
    """JN-23."""
    return spatial.crossings(_lines(spark, sf_dir), 2.0)


def nearest_lines(spark, sf_dir):
    """JN-25: suppliers as vehicles."""
    s = table(spark, sf_dir, "supplier")
    p = s.select(F.col("s_suppkey").alias("point"), (F.col("s_nationkey") * 10.0 + F.col("s_suppkey") % 10).alias("px"), (F.col("s_acctbal") / 50).alias("py"), (F.col("s_suppkey") % 6).cast("double").alias("heading"))
    return spatial.nearest_line(p, _lines(spark, sf_dir), 5.0).select("point", F.round("distance", 5).alias("distance"))


def geometry_faults(spark, sf_dir):
    """SC-07."""
    return spatial.geometry_faults(_points(spark, sf_dir), _segments(spark, sf_dir), "l_orderkey").groupBy("fault").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("ids"))


def fixes_inside(spark, sf_dir):
    """JN-31: suppliers' fixes in the customers' box."""
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    box = lanes.bounds(c.filter("c_acctbal between 0 and 5000"), F.col("c_nationkey"), F.col("c_acctbal"))
    return spatial.inside(s.select("s_suppkey", "s_nationkey", "s_acctbal"), box, "s_nationkey", "s_acctbal", 50.0).select("s_suppkey", "inside")


def source_audit(spark, sf_dir):
    """JN-03: parts as source and, changed, as graph."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"))
    g = p.filter("x < 45").withColumn("p_brand", F.when(F.col("x") == 7, "other").otherwise(F.col("p_brand"))).withColumn("y", F.when(F.col("x") % 9 == 7, F.col("y") + 1).otherwise(F.col("y")))
    g = g.unionByName(p.filter("x = 1").withColumn("p_partkey", -F.col("p_partkey")))
    return spatial.source_audit(p, g, "p_partkey", ["p_brand"], "x", "y")


def warned_edges(spark, sf_dir):
    """JN-05: return flags of quick lines as codes of their order's edges."""
    i = table(spark, sf_dir, "lineitem")
    out = spatial.tagged_edges(i.select("l_orderkey", "l_partkey"), i.filter("l_quantity > 30").select("l_orderkey", F.col("l_returnflag").alias("code")), "l_orderkey")
    return out.groupBy(F.array_join("codes", ",").alias("codes")).agg(F.count(F.lit(1)).alias("n"))


def network_preflight(spark, sf_dir):
    """AG-04; no SQL, as it needs components."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("edge"), F.col("o_custkey").alias("u"), F.when(F.col("o_custkey") % 13 > 0, 1.0).alias("x"), F.lit(0.0).alias("y"), F.when(F.col("o_custkey") % 4 > 0, 2).alias("lanes"), (F.col("o_orderstatus") == "F").alias("oneway"), (F.col("o_custkey") % 5 == 0).alias("reversed"))
    return spatial.preflight(o, roads.weak_components(pairs_of(spark, sf_dir))).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def line_scalars(spark, sf_dir):
    """SC-06, SC-09, SC-10, PRJ-12, PRJ-15, PRJ-26: rules of one row each, over lineitems."""
    i = table(spark, sf_dir, "lineitem")
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    side = scalars.movement_side(F.when(q > 40, "left;through").when(q > 30, "right"), F.when(q > 20, "left"), q - 15, F.when(F.col("l_linenumber") % 2 == 0, "left").otherwise("right"))
    return i.groupBy(side.alias("side"), scalars.is_stub(q, F.lit(5.0)).alias("stub")).agg(
        F.sum(scalars.count_from_density(q, p)).alias("cars"), F.round(F.sum(scalars.arrival_s(p, F.when(q > 10, q))), 2).alias("seconds"),
        F.round(F.sum(scalars.step_s(F.when(q > 45, q), F.when(q > 25, F.lit(0.05)))), 4).alias("steps"), F.count_if(scalars.is_signal_node(F.create_map(F.col("l_returnflag"), F.lit("traffic_signals")), "R")).alias("signals"),
    )


QUERIES = {
    f.__name__: f
    for f in (trimmed_lines, points_on_lines, poses, same_lines, line_crossings, nearest_lines, geometry_faults, fixes_inside, source_audit, warned_edges, network_preflight, line_scalars)
}

_S = f"""WITH {NODES_SQL}, p AS (SELECT l_orderkey, pos, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y FROM nodes JOIN part ON l_partkey = p_partkey),
q AS (SELECT l_orderkey, row_number() OVER w - 1 AS seg, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM p WINDOW w AS (PARTITION BY l_orderkey ORDER BY pos)),
z AS (SELECT *, sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) AS size FROM q WHERE x2 IS NOT NULL),
s AS (SELECT *, sum(size) OVER (PARTITION BY l_orderkey ORDER BY seg) - size AS start, sum(size) OVER (PARTITION BY l_orderkey) AS total FROM z)"""
_C = """WITH k AS (SELECT c_custkey AS line, c_custkey % 40 AS a, c_custkey % 40 + 50 AS b, c_nationkey * 10.0::DOUBLE + c_custkey % 10 AS x1, c_acctbal / 50 AS y1 FROM customer),
c AS (SELECT *, x1 + line % 7 / 2.0::DOUBLE - 1.5 AS x2, y1 + line % 5 / 2.0::DOUBLE - 1 AS y2 FROM k)"""
SQL = {
    "trimmed_lines": f"""{_S}, t AS (SELECT *, greatest(start, 1.0) AS f, least(start + size, total - 2.0) AS e FROM s), u AS (SELECT *, x1 + (x2 - x1) * (f - start) / size AS a FROM t WHERE e > f)
      SELECT l_orderkey, count(*) AS n, round(sum(e - f), 3) AS length, round(min_by(a, seg), 4) AS first_x FROM u GROUP BY 1""",
    "points_on_lines": f"""{_S}, p2 AS (SELECT o_orderkey, CAST(o_custkey % 50 AS DOUBLE) AS px, 900.0 + o_custkey % 1000 AS py FROM orders),
      t AS (SELECT s.*, px, py, CASE WHEN size > 0 THEN least(greatest(((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / (size * size), 0), 1) ELSE 0 END AS t FROM s JOIN p2 ON l_orderkey = o_orderkey)
      SELECT l_orderkey, round(min(sqrt((px - x1 - t * (x2 - x1)) ** 2 + (py - y1 - t * (y2 - y1)) ** 2)), 4) AS distance FROM t GROUP BY 1""",
    "poses": f"""{_S}, d AS (SELECT *, least(100.0::DOUBLE, max(start + size) OVER (PARTITION BY l_orderkey)) AS d FROM s), h AS (SELECT * FROM d WHERE l_orderkey IN (SELECT o_orderkey FROM orders) AND size > 0 AND d >= start AND d <= start + size QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY seg) = 1)
      SELECT l_orderkey, round(x1 + (d - start) / size * (x2 - x1), 4) AS x, round(y1 + (d - start) / size * (y2 - y1), 4) AS y, round(atan2(y2 - y1, x2 - x1), 5) AS heading FROM h""",
    "same_lines": """WITH k AS (SELECT c_custkey AS line, c_nationkey AS a, length(c_mktsegment) AS b, floor(c_acctbal / 2000) AS z FROM customer)
      SELECT p.line AS kept, q.line AS dropped FROM k p JOIN k q ON p.line < q.line AND p.z = q.z AND least(p.a, p.b) = least(q.a, q.b) AND greatest(p.a, p.b) = greatest(q.a, q.b)
      WHERE p.a = q.a OR (p.a = q.z AND p.z = q.a)""",
    "line_crossings": f"""{_C}, o AS (SELECT p.line, q.line AS other, (p.x2 - p.x1) * (q.y1 - p.y1) - (p.y2 - p.y1) * (q.x1 - p.x1) AS a, (p.x2 - p.x1) * (q.y2 - p.y1) - (p.y2 - p.y1) * (q.x2 - p.x1) AS b,
        (q.x2 - q.x1) * (p.y1 - q.y1) - (q.y2 - q.y1) * (p.x1 - q.x1) AS c, (q.x2 - q.x1) * (p.y2 - q.y1) - (q.y2 - q.y1) * (p.x2 - q.x1) AS d
        FROM c p JOIN c q ON p.line < q.line AND least(p.x1, p.x2) <= greatest(q.x1, q.x2) AND least(q.x1, q.x2) <= greatest(p.x1, p.x2) AND least(p.y1, p.y2) <= greatest(q.y1, q.y2) AND least(q.y1, q.y2) <= greatest(p.y1, p.y2) WHERE p.a <> q.a)
      SELECT line, other FROM o WHERE sign(a) * sign(b) <= 0 AND sign(c) * sign(d) <= 0""",
    "nearest_lines": f"""{_C}, v AS (SELECT s_suppkey AS point, s_nationkey * 10.0::DOUBLE + s_suppkey % 10 AS px, s_acctbal / 50 AS py FROM supplier),
      t AS (SELECT point, px, py, c.*, (x2 - x1) ** 2 + (y2 - y1) ** 2 AS z FROM v, c), u AS (SELECT *, CASE WHEN z > 0 THEN least(greatest(((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / z, 0), 1) ELSE 0 END AS t FROM t),
      d AS (SELECT point, min(sqrt((px - x1 - t * (x2 - x1)) ** 2 + (py - y1 - t * (y2 - y1)) ** 2)) AS distance FROM u GROUP BY 1) SELECT point, round(distance, 5) AS distance FROM d WHERE distance <= 5""",
    "geometry_faults": f"""{_S}, n AS (SELECT l_orderkey, count(*) AS n FROM p GROUP BY 1), l AS (SELECT l_orderkey, sum(size) AS length FROM s GROUP BY 1),
      g AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY seg) AS i, count(*) OVER (PARTITION BY l_orderkey) AS e FROM s WHERE size > 0),
      m AS (SELECT a.l_orderkey, a.i AS i, b.i AS j, a.e AS e, a.x1 = b.x2 AND a.y1 = b.y2 AS ring, (a.x2 - a.x1) * (b.x2 - b.x1) + (a.y2 - a.y1) * (b.y2 - b.y1) AS ahead, (a.x2 - a.x1) * (b.y1 - a.y1) - (a.y2 - a.y1) * (b.x1 - a.x1) AS a, (a.x2 - a.x1) * (b.y2 - a.y1) - (a.y2 - a.y1) * (b.x2 - a.x1) AS b,
        (b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1) AS c, (b.x2 - b.x1) * (a.y2 - b.y1) - (b.y2 - b.y1) * (a.x2 - b.x1) AS d FROM g a JOIN g b ON a.l_orderkey = b.l_orderkey AND b.i > a.i
        AND least(a.x1, a.x2) <= greatest(b.x1, b.x2) AND least(b.x1, b.x2) <= greatest(a.x1, a.x2) AND least(a.y1, a.y2) <= greatest(b.y1, b.y2) AND least(b.y1, b.y2) <= greatest(a.y1, a.y2)),
      f AS (SELECT n.l_orderkey, CASE WHEN n < 2 THEN 'too_few' ELSE 'no_length' END AS fault FROM n LEFT JOIN l ON n.l_orderkey = l.l_orderkey WHERE n < 2 OR coalesce(length, 0) <= 0 UNION ALL SELECT DISTINCT l_orderkey, 'not_simple' FROM m WHERE CASE WHEN j = i + 1 THEN b = 0 AND ahead < 0 WHEN i = 1 AND j = e AND ring THEN a = 0 AND ahead < 0 ELSE sign(a) * sign(b) <= 0 AND sign(c) * sign(d) <= 0 END)
      SELECT fault, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS ids FROM f GROUP BY 1""",
    "fixes_inside": """WITH b AS (SELECT min(c_nationkey) AS a, min(c_acctbal) AS b, max(c_nationkey) AS c, max(c_acctbal) AS d FROM customer WHERE c_acctbal BETWEEN 0 AND 5000)
      SELECT s_suppkey, s_nationkey BETWEEN a - 50 AND c + 50 AND s_acctbal BETWEEN b - 50 AND d + 50 AS inside FROM supplier, b""",
    "source_audit": """SELECT p_partkey, 'missing' AS fault FROM part WHERE p_size >= 45 UNION ALL SELECT -p_partkey, 'extra' FROM part WHERE p_size = 1
      UNION ALL SELECT p_partkey, 'tag_mismatch' FROM part WHERE p_size = 7 UNION ALL SELECT p_partkey, 'coordinate_mismatch' FROM part WHERE p_size < 45 AND p_size % 9 = 7""",
    "warned_edges": """WITH w AS (SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS codes FROM lineitem WHERE l_quantity > 30 GROUP BY 1)
      SELECT coalesce(codes, '') AS codes, count(*) AS n FROM lineitem LEFT JOIN w ON lineitem.l_orderkey = w.l_orderkey GROUP BY 1""",
    "line_scalars": """WITH j AS (SELECT *, CASE WHEN l_quantity > 40 THEN 'left' WHEN l_quantity > 30 THEN 'right' WHEN l_quantity > 20 THEN 'left' WHEN abs(l_quantity - 15) >= 10 THEN CASE WHEN l_quantity > 15 THEN 'left' ELSE 'right' END END AS turn FROM lineitem),
      k AS (SELECT *, CASE WHEN (turn = 'left') = (l_linenumber % 2 = 0) THEN 'nearside' WHEN turn IS NOT NULL THEN 'offside' END AS side, l_quantity <= 5.01 AS stub FROM j)
      SELECT side, stub, CAST(sum(CASE WHEN l_quantity > 0 THEN greatest(1, round(l_quantity * l_extendedprice / 1000)) ELSE 0 END) AS BIGINT) AS cars, round(sum(CASE WHEN l_quantity > 10 THEN l_extendedprice / l_quantity END), 2) AS seconds,
        round(sum(CASE WHEN l_quantity > 45 THEN l_quantity WHEN l_quantity > 25 THEN 0.05 ELSE 0.1 END), 4) AS steps, count(*) FILTER (l_returnflag = 'R') AS signals FROM k GROUP BY ALL""",
}
