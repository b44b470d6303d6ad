"""Queries on roads: selection, directions, terminus nodes, lane counts, turn angles, projections."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from roadlens.functions import geo, tags
from roadlens.operators import roads
from roadlens.plans.tables import NODES_SQL, TAGS_SQL, table, way_nodes, way_tags

PAIRS_SQL = f"""
WITH {NODES_SQL}, {TAGS_SQL},
step AS (SELECT l_orderkey, l_partkey AS a, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY pos) AS b FROM nodes),
pair AS (
  SELECT l_orderkey, a AS u, b AS v FROM step JOIN tags ON l_orderkey = o_orderkey WHERE b IS NOT NULL AND (oneway IS NULL OR oneway <> '-1')
  UNION SELECT l_orderkey, b, a FROM step JOIN tags ON l_orderkey = o_orderkey WHERE b IS NOT NULL AND (oneway IS NULL OR oneway = '-1')
)"""


def pairs_of(spark, sf_dir):
    nodes = way_nodes(spark, sf_dir).join(way_tags(spark, sf_dir).withColumnRenamed("o_orderkey", "l_orderkey").select("l_orderkey", tags.tag(F.col("tags"), "oneway").alias("oneway")), "l_orderkey")
    return roads.directed_pairs(nodes, "l_orderkey", "l_partkey", F.col("oneway").isin(tags.ONEWAY), F.col("oneway").isin(tags.REVERSED))


def road_selection(spark, sf_dir):
    """PRJ-01, AG-01: ways per exclusion reason."""
    ways = way_tags(spark, sf_dir).withColumn("reason", F.coalesce(tags.exclusion_reason(F.col("tags")), F.lit("selected")))
    return ways.groupBy("reason").agg(F.count(F.lit(1)).alias("n_ways"))


def single_lane_oneway(spark, sf_dir):
    """PRJ-02."""
    return way_tags(spark, sf_dir).select("o_orderkey", tags.single_lane_oneway(F.col("tags")).alias("implied"))


def directed_pairs(spark, sf_dir):
    """PRJ-03: edges and distinct ends per way."""
    return pairs_of(spark, sf_dir).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_edges"), F.count_distinct("u").alias("n_from"))


def terminus_nodes(spark, sf_dir):
    """AG-05: customers as nodes of ways that are days of orders."""
    o = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"), "o_custkey", "o_orderkey")
    return roads.terminus_nodes(roads.ordered_nodes(o, "day", "o_custkey", ["o_orderkey"]), "o_custkey")


def lane_count(spark, sf_dir):
    """PRJ-04, PRJ-05: lane counts with confidence and reason."""
    t = F.col("tags")
    n = tags.lane_count(tags.tag(t, "lanes:forward"), tags.tag(t, "lanes"), tags.tag(t, "lanes:backward"), F.coalesce(tags.tag(t, "oneway").isin(tags.ONEWAY), F.lit(False)))
    return way_tags(spark, sf_dir).withColumn("n", n).groupBy(F.col("n.lanes").alias("lanes"), F.col("n.confidence").alias("confidence"), F.col("n.reason").alias("reason")).agg(F.count(F.lit(1)).alias("n_ways"))


def content_ids(spark, sf_dir):
    """PRJ-16."""
    return table(spark, sf_dir, "part").select("p_partkey", tags.content_id(F.lit("node"), F.col("p_partkey").cast("string"), F.when(F.col("p_size") > 5, F.col("p_brand")), F.col("p_type")).alias("id"))


def way_geometry(spark, sf_dir):
    """JN-01: way node ids to coordinates in order; length of the line."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"))
    line = way_nodes(spark, sf_dir).join(part, "l_partkey").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("pos", "x", "y"))).alias("line"))
    return line.filter(F.size("line") >= 2).select("l_orderkey", F.size("line").cast("long").alias("n_points"), F.round(geo.polyline_length(F.col("line")), 3).alias("length"))


def turn_angles(spark, sf_dir):
    """PRJ-09..11: movement families at the inner nodes of ways."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"))
    w = Window.partitionBy("l_orderkey").orderBy("pos")
    at = way_nodes(spark, sf_dir).join(part, "l_partkey")
    h_in = F.atan2(F.col("y") - F.lag("y").over(w), F.col("x") - F.lag("x").over(w))
    h_out = F.atan2(F.lead("y").over(w) - F.col("y"), F.lead("x").over(w) - F.col("x"))
    turns = at.withColumn("angle", F.round(geo.turn_degrees(h_in, h_out), 6)).filter("angle is not null").withColumn("movement", tags.movement_class(F.col("angle")))
    return turns.groupBy("movement", tags.movement_family(F.col("movement")).alias("family")).agg(F.count(F.lit(1)).alias("n_turns"))


def projection(spark, sf_dir):
    """PRJ-17, PRJ-21: local metres around an origin, and what is lost on the way back."""
    c = table(spark, sf_dir, "customer").select("c_custkey", (F.lit(24.0) + F.col("c_custkey") % 97 / 1000).alias("lat"), (F.lit(54.0) + F.col("c_custkey") % 89 / 1000).alias("lon"))
    xy = c.withColumn("p", geo.project(F.col("lat"), F.col("lon"), F.lit(24.05), F.lit(54.05)))
    back = xy.withColumn("b", geo.unproject(F.col("p.x"), F.col("p.y"), F.lit(24.05), F.lit(54.05)))
    away = geo.great_circle_m(F.col("lat"), F.col("lon"), F.lit(24.05), F.lit(54.05))
    lost = geo.great_circle_m(F.col("lat"), F.col("lon"), F.col("b.lat"), F.col("b.lon"))
    return back.select("c_custkey", F.round("p.x", 2).alias("x"), F.round("p.y", 2).alias("y"), F.round(away, 2).alias("metres"), (lost < 0.001).alias("round_trip"))


def light_phases(spark, sf_dir):
    """PRJ-23, PRJ-24: colour shown and seconds to green at each event."""
    e = table(spark, sf_dir, "events").withColumn("t", F.col("value"))
    args = (F.col("t"), (F.col("user_id") % 10).cast("double"), F.lit(60.0))
    return e.groupBy(geo.light_colour(*args, F.lit(25.0), F.lit(4.0)).alias("colour")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(geo.seconds_to_green(*args, F.lit(25.0))), 2).alias("wait_s"))


def way_adjacency(spark, sf_dir):
    """JN-15: how many suppliers follow each supplier within an order."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", "l_extendedprice")
    moves = items.withColumn("to", F.lead("l_suppkey").over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))).filter("to is not null")
    return roads.way_adjacency(moves, "l_suppkey", "to").select("way", F.coalesce(F.size("feeds"), F.lit(0)).cast("long").alias("n_feeds"), F.coalesce(F.size("fed_by"), F.lit(0)).cast("long").alias("n_fed_by"))


QUERIES = {f.__name__: f for f in (road_selection, single_lane_oneway, directed_pairs, terminus_nodes, lane_count, content_ids, way_geometry, turn_angles, projection, light_phases, way_adjacency)}

SQL = {
    "road_selection": f"""WITH {TAGS_SQL} SELECT CASE WHEN highway IN ('footway', 'service') THEN 'highway=' || highway WHEN access = 'private' THEN 'access=private' ELSE 'selected' END AS reason, count(*) AS n_ways FROM tags GROUP BY 1""",
    "single_lane_oneway": f"WITH {TAGS_SQL} SELECT o_orderkey, lanes = 1 AND forward IS NULL AND oneway IS NULL AS implied FROM tags",
    "directed_pairs": f"{PAIRS_SQL} SELECT l_orderkey, count(*) AS n_edges, count(DISTINCT u) AS n_from FROM pair GROUP BY 1",
    "terminus_nodes": """WITH n AS (SELECT o_custkey, row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey, o_custkey) AS pos, count(*) OVER (PARTITION BY CAST(o_orderdate AS DATE)) AS n FROM orders)
      SELECT o_custkey FROM n GROUP BY 1 HAVING bool_and(pos = 1 OR pos = n)""",
    "lane_count": f"""WITH {TAGS_SQL}, c AS (SELECT CASE WHEN forward IS NOT NULL THEN {{'l': 2, 'c': 'high', 'r': 'directional'}} WHEN oneway IS NOT NULL AND lanes > 0 THEN {{'l': lanes, 'c': 'high', 'r': 'oneway_total'}}
      WHEN lanes > 0 AND lanes % 2 = 0 THEN {{'l': lanes // 2, 'c': 'medium', 'r': 'even_split'}} WHEN lanes > 0 THEN {{'l': greatest(1, lanes // 2), 'c': 'low', 'r': 'odd_split'}} ELSE {{'l': 1, 'c': 'low', 'r': 'missing'}} END AS s FROM tags)
      SELECT CAST(s.l AS INT) AS lanes, s.c AS confidence, s.r AS reason, count(*) AS n_ways FROM c GROUP BY ALL""",
    "content_ids": "SELECT p_partkey, substr(sha256('node' || chr(31) || CAST(p_partkey AS VARCHAR) || chr(31) || CASE WHEN p_size > 5 THEN p_brand ELSE chr(0) END || chr(31) || p_type), 1, 16) AS id FROM part",
    "way_geometry": f"""WITH {NODES_SQL}, p AS (SELECT l_orderkey, pos, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y FROM nodes JOIN part ON l_partkey = p_partkey),
      s AS (SELECT l_orderkey, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS d FROM p WINDOW w AS (PARTITION BY l_orderkey ORDER BY pos))
      SELECT l_orderkey, count(*) AS n_points, round(sum(d), 3) AS length FROM s GROUP BY 1 HAVING count(*) >= 2""",
    "turn_angles": f"""WITH {NODES_SQL}, p AS (SELECT l_orderkey, pos, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y FROM nodes JOIN part ON l_partkey = p_partkey),
      h AS (SELECT atan2(y - lag(y) OVER w, x - lag(x) OVER w) AS i, atan2(lead(y) OVER w - y, lead(x) OVER w - x) AS o FROM p WINDOW w AS (PARTITION BY l_orderkey ORDER BY pos)),
      a AS (SELECT round(degrees(atan2(sin(o - i), cos(o - i))), 6) AS a FROM h WHERE i IS NOT NULL AND o IS NOT NULL),
      m AS (SELECT CASE WHEN abs(a) >= 145 THEN 'reverse' WHEN abs(a) <= 35 THEN 'through' WHEN abs(a) < 70 THEN 'slight_' ELSE '' END || CASE WHEN abs(a) >= 145 OR abs(a) <= 35 THEN '' WHEN a > 0 THEN 'left' ELSE 'right' END AS movement FROM a)
      SELECT movement, replace(movement, 'slight_', '') AS family, count(*) AS n_turns FROM m GROUP BY ALL""",
    "projection": """WITH c AS (SELECT c_custkey, radians(24.0 + c_custkey % 97 / 1000.0) AS p, radians(54.0 + c_custkey % 89 / 1000.0 - 54.05) AS d, radians(24.05) AS p0 FROM customer),
      k AS (SELECT *, acos(least(1, sin(p0) * sin(p) + cos(p0) * cos(p) * cos(d))) AS c FROM c), m AS (SELECT *, CASE WHEN c < 1e-12 THEN 1 ELSE c / sin(c) END * 6371008.8 AS k FROM k)
      SELECT c_custkey, round(k * cos(p) * sin(d), 2) AS x, round(k * (cos(p0) * sin(p) - sin(p0) * cos(p) * cos(d)), 2) AS y,
      round(2 * 6371008.8 * asin(sqrt(sin((p0 - p) / 2) ** 2 + cos(p) * cos(p0) * sin(d / 2) ** 2)), 2) AS metres, true AS round_trip FROM m""",
    "light_phases": """WITH e AS (SELECT ((value - user_id % 10) % 60 + 60) % 60 AS p FROM events)
      SELECT CASE WHEN p < 25 THEN 'green' WHEN p < 29 THEN 'yellow' ELSE 'red' END AS colour, count(*) AS n, round(sum(CASE WHEN p < 25 THEN 0 ELSE 60 - p END), 2) AS wait_s FROM e GROUP BY 1""",
    "way_adjacency": """WITH m AS (SELECT l_suppkey AS a, lead(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS b FROM lineitem),
      o AS (SELECT a AS way, count(DISTINCT b) AS n FROM m WHERE b IS NOT NULL AND a <> b GROUP BY 1), i AS (SELECT b AS way, count(DISTINCT a) AS n FROM m WHERE b IS NOT NULL AND a <> b GROUP BY 1)
      SELECT coalesce(o.way, i.way) AS way, coalesce(o.n, 0) AS n_feeds, coalesce(i.n, 0) AS n_fed_by FROM o FULL JOIN i ON o.way = i.way""",
}
