"""Queries on road graphs: components, flood fill, readiness, reach of lanes and shortest drives."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from roadlens.functions import tags
from roadlens.operators import directed, roads
from roadlens.plans.roads import pairs_of
from roadlens.plans.tables import NODES_SQL, table, way_nodes, way_tags


def road_network_audit(spark, sf_dir):
    """PRJ-03, GR-01, AG-02, AG-03: components of the road graph with size and readiness."""
    highways = way_tags(spark, sf_dir).select(F.col("o_orderkey").alias("l_orderkey"), tags.tag(F.col("tags"), "highway").alias("highway"))
    summary = roads.component_summary(pairs_of(spark, sf_dir), "l_orderkey", highways)
    return summary.select("component", "number", "n_nodes", "n_edges", "n_ways", "highways", roads.readiness(F.when(F.col("n_edges") < F.col("n_nodes"), 1).otherwise(0), F.when(F.col("n_ways") < 2, 1).otherwise(0)).alias("verdict"))


def customer_network(spark, sf_dir):
    """GR-01 with keys: components of customers that share a class of order total, within a nation; n counts customers."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    hub = -1 - F.floor(F.col("o_totalprice") / 500)
    links = o.select(F.col("c_nationkey"), F.col("o_custkey").alias("u"), hub.cast("long").alias("v"))
    return roads.weak_components(links, ("c_nationkey",)).filter("id >= 0").groupBy("c_nationkey", "component").agg(F.count(F.lit(1)).alias("n"))


def reach_hops(spark, sf_dir):
    """GR-02, GR-06: hops from the first node along the road graph."""
    start = table(spark, sf_dir, "part").agg(F.min("p_partkey").alias("id"))
    return roads.flood(pairs_of(spark, sf_dir), start).groupBy("hops").agg(F.count(F.lit(1)).alias("n"))


def _steps(spark, sf_dir):
    """(a, b, l_quantity): steps from a part to the next of its order; many units make an exit, fewer a lane change."""
    w = Window.partitionBy("l_orderkey").orderBy("pos")
    nodes = way_nodes(spark, sf_dir)
    return nodes.select(F.col("l_partkey").alias("a"), F.lead("l_partkey").over(w).alias("b"), "l_quantity").filter("b is not null and a <> b")


def _parts(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("length"))


def lane_reach(spark, sf_dir):
    """GR-03, GR-04: the strong component of each part, its size, and how many parts it reaches by exits."""
    return directed.reach_counts(_parts(spark, sf_dir), _steps(spark, sf_dir).filter("l_quantity > 45"))


def reach_facts(spark, sf_dir):
    """AG-11: best start, median reach and components in one row."""
    return directed.reach_facts(lane_reach(spark, sf_dir))


def shortest_drives(spark, sf_dir):
    """GR-05: for each nation the cheapest drive from the least to the largest part that its suppliers deliver."""
    lanes, steps = _parts(spark, sf_dir), _steps(spark, sf_dir)
    edges = directed.drive_edges(lanes, steps.filter("l_quantity > 45"), steps.filter("l_quantity > 43 and l_quantity <= 45"))
    sold = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("route")), "l_suppkey")
    routes = sold.groupBy("route").agg(F.min("l_partkey").alias("start"), F.max("l_partkey").alias("end"))
    out = directed.shortest_drives(routes, edges, lanes, 100.0)
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return out.select("route", "start", "end", "fault", "cost", joined("lanes"), joined("changes"))


QUERIES = {f.__name__: f for f in (road_network_audit, customer_network, reach_hops, lane_reach, reach_facts, shortest_drives)}

_STEPS = f"""{NODES_SQL.replace("FROM lineitem", ", l_quantity FROM lineitem")},
steps AS (SELECT * FROM (SELECT l_partkey AS a, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY pos) AS b, l_quantity FROM nodes) WHERE b IS NOT NULL AND a <> b)"""
_REACH = f"""WITH RECURSIVE {_STEPS}, e AS (SELECT DISTINCT a, b FROM steps WHERE l_quantity > 45),
t(a, b) AS (SELECT p_partkey, p_partkey FROM part UNION SELECT t.a, e.b FROM t JOIN e ON t.b = e.a),
c AS (SELECT x.a AS id, max(x.b) AS component, count(*) AS size FROM t x JOIN t y ON x.a = y.b AND x.b = y.a GROUP BY 1),
r AS (SELECT c.*, n - 1 AS reach FROM c JOIN (SELECT a, count(*) AS n FROM t GROUP BY 1) ON id = a)"""
# The other three are transitive closures that are slow in SQL on whole tables; tests hold them against brute force.
SQL: dict[str, str] = {
    "lane_reach": f"{_REACH} SELECT id, component, size, reach FROM r",
    "reach_facts": f"""{_REACH}, n AS (SELECT count(*) AS n FROM r)
      SELECT (SELECT id FROM r ORDER BY reach DESC, id DESC LIMIT 1) AS best_start, max(reach) AS best_start_reaches, median(reach) AS median_reach, count(*) FILTER (reach = 0) AS reaching_nothing,
        CAST(sum(reach) AS BIGINT) AS reachable_pairs, any_value(n * (n - 1)) AS possible_pairs, count(DISTINCT component) AS components, max(size) AS largest FROM r, n""",
    "shortest_drives": f"""WITH RECURSIVE {_STEPS}, x AS (SELECT a, b, bool_and(l_quantity <= 45) AS change FROM steps WHERE l_quantity > 43 GROUP BY ALL),
      e AS (SELECT a, b, change, CASE WHEN change THEN p_size / 2 + 5 ELSE p_size END AS cost FROM x JOIN part ON b = p_partkey),
      r AS (SELECT s_nationkey AS route, min(l_partkey) AS start, max(l_partkey) AS "end" FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
      d(route, lane, cost) USING KEY (route, lane) AS (SELECT route, start, CAST(0 AS DOUBLE) FROM r WHERE start <> "end" UNION
        SELECT d.route, e.b, CAST(min(d.cost + e.cost) AS DOUBLE) FROM d JOIN e ON d.lane = e.a LEFT JOIN recurring.d k ON k.route = d.route AND k.lane = e.b WHERE k.cost IS NULL OR d.cost + e.cost < k.cost GROUP BY ALL),
      p AS (SELECT d.route, d.lane, min(q.lane) AS prev, arg_min(e.change, q.lane) AS change FROM d JOIN e ON e.b = d.lane JOIN d q ON q.route = d.route AND q.lane = e.a WHERE q.cost + e.cost = d.cost GROUP BY ALL),
      w(route, here, lanes, moves) AS (SELECT r.route, "end", ["end"], CAST([] AS BOOLEAN[]) FROM r JOIN d ON d.route = r.route AND d.lane = r."end" UNION ALL
        SELECT w.route, p.prev, [p.prev] || lanes, [p.change] || moves FROM w JOIN p ON p.route = w.route AND p.lane = w.here)
      SELECT r.route, r.start, r."end", CASE WHEN r.start = r."end" THEN 'same_lane' WHEN d.cost IS NULL THEN 'no_drive' END AS fault, d.cost, array_to_string(lanes, ',') AS lanes,
        array_to_string(list_filter(range(1, len(moves) + 1), lambda i: moves[i]), ',') AS changes
      FROM r LEFT JOIN d ON d.route = r.route AND d.lane = r."end" LEFT JOIN w ON w.route = r.route AND w.here = r.start""",
}
