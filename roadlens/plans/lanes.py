"""Queries on lane models: lanes are steps between successive nodes of ways, connectors lead to the next lane of a node."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from roadlens.operators import lanes as ops
from roadlens.plans.tables import NODES_SQL, table, way_nodes


def lane_table(spark, sf_dir):
    """(lane, way, u, v, pos, direction): direction is the supplier's parity."""
    w = Window.partitionBy("l_orderkey").orderBy("pos")
    nodes = way_nodes(spark, sf_dir).withColumn("v", F.lead("l_partkey").over(w)).filter("v is not null")
    return nodes.select((F.col("l_orderkey") * 64 + F.col("pos")).alias("lane"), F.col("l_orderkey").alias("way"), F.col("l_partkey").alias("u"), "v", "pos", (F.col("l_suppkey") % 2).alias("direction"), "l_quantity")


def connector_table(lanes):
    """(connector, from_lane, to_lane, status): to the next lane that starts at the lane's start; a third is forbidden."""
    nxt = F.lead("lane").over(Window.partitionBy("u").orderBy("lane"))
    status = F.when(F.col("l_quantity") > 35, "forbidden").when(F.col("l_quantity") > 30, "draft").otherwise("active")
    return lanes.withColumn("to_lane", nxt).filter("to_lane is not null").select((-F.col("lane") - 1).alias("connector"), F.col("lane").alias("from_lane"), "to_lane", status.alias("status"), "l_quantity")


def _links(lanes):
    """Each lane's next one in its way."""
    return lanes.select("lane", F.lead("lane").over(Window.partitionBy("way").orderBy("pos")).alias("target")).filter("target is not null")


def _listed(connectors):
    return connectors.filter("l_quantity < 33").select("connector")


def lane_links(spark, sf_dir):
    """SRC-04, JN-07: what each lane's exits lead to, by kind of fault."""
    lanes = lane_table(spark, sf_dir)
    exits = lanes.select("lane", F.when(F.col("direction") == 0, F.col("lane") + 1).otherwise(-F.col("lane") - 1).alias("ref"))
    out = ops.lane_links(exits, lanes, connector_table(lanes))
    return out.groupBy("fault").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("target"), F.lit(0)).alias("targets"))


def lane_changes(spark, sf_dir):
    """JN-08."""
    w = Window.partitionBy("way").orderBy("pos")
    lanes = lane_table(spark, sf_dir)
    return ops.lane_changes(lanes.withColumn("left", F.lag("lane").over(w)).withColumn("right", F.lead("lane").over(w))).groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("target").alias("targets"))


def connector_faults(spark, sf_dir):
    """JN-10: a lane ends at (node, 0); connectors of a small quantity end a metre off."""
    lanes = lane_table(spark, sf_dir)
    c = connector_table(lanes)
    placed = lanes.select("lane", F.col("u").cast("double").alias("start_x"), F.lit(0.0).alias("start_y"), F.col("v").cast("double").alias("end_x"), F.lit(0.0).alias("end_y"))
    ends = lanes.select(F.col("lane").alias("from_lane"), F.col("v").cast("double").alias("start_x"))
    starts = lanes.select(F.col("lane").alias("to_lane"), F.col("u").cast("double").alias("end_x"))
    off = F.when(F.col("l_quantity") < 5, 1.0).otherwise(0.0)
    drawn = c.join(ends, "from_lane").join(starts, "to_lane").select("connector", "from_lane", F.when(F.col("l_quantity") == 7, -1).otherwise(F.col("to_lane")).alias("to_lane"), "status", "start_x", off.alias("start_y"), "end_x", F.lit(0.0).alias("end_y"))
    return ops.connector_faults(drawn, placed, _listed(c)).groupBy("fault").agg(F.count(F.lit(1)).alias("n"), F.sum("connector").alias("ids"))


def restriction_faults(spark, sf_dir):
    """JN-11: connectors of a quantity over 33 should be forbidden."""
    c = connector_table(lane_table(spark, sf_dir))
    asked = c.filter("l_quantity > 33 or l_quantity < 3").select(F.when(F.col("l_quantity") == 34, -F.col("connector")).otherwise(F.col("connector")).alias("connector"))
    return ops.restriction_faults(asked, c, _listed(c)).groupBy("fault").agg(F.count(F.lit(1)).alias("n"), F.sum("connector").alias("ids"))


def control_faults(spark, sf_dir):
    """JN-12: ways as controls of their first lanes."""
    ways = lane_table(spark, sf_dir).groupBy("way").agg(F.collect_list(F.when(F.col("direction") == 0, F.when(F.col("l_quantity") == 9, -1).otherwise(F.col("lane")))).alias("lanes"))
    controls = ways.select(F.col("way").alias("control"), F.lit("mapped").alias("status"), "lanes")
    return ops.control_faults(controls, lane_table(spark, sf_dir))


def node_restrictions(spark, sf_dir):
    """JN-13: a way's move from supplier to supplier at a part; returned lines forbid, late ones are the only way."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    items = table(spark, sf_dir, "lineitem")
    moves = items.withColumn("to", F.lead("l_suppkey").over(w)).filter("to is not null").select(F.col("l_suppkey").alias("frm"), F.col("l_partkey").alias("node"), "to", "l_returnflag", "l_quantity")
    rules = moves.filter("l_returnflag = 'R'").select("frm", "node", "to", F.when(F.col("l_quantity") > 45, "only_straight_on").otherwise("no_left_turn").alias("kind"))
    return ops.forbidden_movements(moves, rules)


def signal_lanes(spark, sf_dir):
    """JN-16: small parts as signals."""
    lanes = lane_table(spark, sf_dir)
    signals = table(spark, sf_dir, "part").filter("p_size < 10").select(F.col("p_partkey").alias("node"))
    starts_only = lanes.select(F.col("u").alias("node")).distinct()
    return ops.signal_lanes(signals, lanes.filter("l_quantity > 40"), starts_only).select("node", F.size("lanes").cast("long").alias("n_lanes"), "severity")


def movement_candidates(spark, sf_dir):
    """JN-17: candidates at each node."""
    return ops.movement_candidates(lane_table(spark, sf_dir)).groupBy("node", "kind").agg(F.count(F.lit(1)).alias("n"))


def disposed_issues(spark, sf_dir):
    """JN-19: documents as issues, toxic labels as not applicable."""
    issues = table(spark, sf_dir, "documents").select("doc_id", F.lit("error").alias("severity"))
    judged = table(spark, sf_dir, "labels").select("doc_id", F.col("doc_id").alias("finding"), F.when(F.col("toxic") == 1, "not_applicable").otherwise("accepted").alias("status"))
    return ops.with_dispositions(issues, judged, "doc_id").select("doc_id", "severity", F.coalesce("finding", F.lit(-1)).alias("finding"))


def feature_classes(spark, sf_dir):
    """JN-20: the class of an order is that of the first of its parts, then suppliers, that has one."""
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_partkey")).alias("affected"), F.sort_array(F.collect_set(-F.col("l_suppkey") - 1)).alias("sources"))
    parts = table(spark, sf_dir, "part").filter("p_size < 8").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("road_class"))
    sup = table(spark, sf_dir, "supplier").filter("s_acctbal > 5000").select((-F.col("s_suppkey") - 1).alias("id"), F.lit("supplier").alias("road_class"))
    return ops.road_class(items.withColumnRenamed("l_orderkey", "feature"), parts.unionByName(sup))


def lane_starvation(spark, sf_dir):
    """AG-09: suppliers as lanes that land on nations, by part."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("target"))
    moves = table(spark, sf_dir, "lineitem").join(s, "l_suppkey").select(F.col("l_partkey").alias("node"), F.col("l_returnflag").alias("approach"), F.col("l_linestatus").alias("dest"), F.col("l_suppkey").alias("lane"), "target")
    return ops.starved(moves)


def kerb_allocation(spark, sf_dir):
    """WN-16, WN-17: seven approach lanes dealt to an order's lines."""
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("lanes")).withColumn("n", F.lit(4))
    return ops.kerb_first(items, ["l_orderkey"], "l_linenumber", "lanes", "n")


def dead_ends(spark, sf_dir):
    """GR-07: nodes of one way only are the boundary."""
    lanes = lane_table(spark, sf_dir)
    ends = lanes.select("way", F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count_distinct("way").alias("n")).filter("n <= 25").select("node")
    return ops.dead_ends(lanes, _links(lanes), ends).groupBy("end", "fault").agg(F.count(F.lit(1)).alias("n"), F.sum("lane").alias("lanes"))


def entries_and_exits(spark, sf_dir):
    """GR-09: lanes of large quantities."""
    lanes = lane_table(spark, sf_dir).filter("l_quantity > 40")
    return ops.entries_and_exits(lanes, _links(lanes)).groupBy("role", "reason").agg(F.count(F.lit(1)).alias("n"), F.sum("lane").alias("lanes"))


def exit_changes(spark, sf_dir):
    """ST-03: exits before and after connectors that aren't active go."""
    lanes = lane_table(spark, sf_dir)
    c = connector_table(lanes).withColumnRenamed("from_lane", "lane")
    return ops.exit_changes(c.filter("l_quantity > 20"), c.filter("status = 'active'"), lanes).groupBy("change").agg(F.count(F.lit(1)).alias("n"))


def lane_checks(spark, sf_dir):
    """ST-04, UD-01, UD-03: registered checks with what they judged."""
    lanes = lane_table(spark, sf_dir)
    c = connector_table(lanes)
    return ops.run_checks({"restrictions": (ops.restriction_faults(c.filter("l_quantity > 35").select("connector"), c, _listed(c)), c), "loops": (lanes.filter("u = v"), lanes), "unknown": (lanes.filter("u is null"), lanes)})


def lanes_per_way(spark, sf_dir):
    """AG-23: ways by lanes, and the box of the nodes."""
    lanes = lane_table(spark, sf_dir)
    box = ops.bounds(table(spark, sf_dir, "part"), F.col("p_size"), F.col("p_retailprice"))
    n = lanes.groupBy("way").agg(F.count(F.lit(1)).alias("n_lanes"))
    return n.groupBy("n_lanes").agg(F.count(F.lit(1)).alias("n_ways")).crossJoin(F.broadcast(box))  # one row


QUERIES = {
    f.__name__: f
    for f in (lane_links, lane_changes, connector_faults, restriction_faults, control_faults, node_restrictions, signal_lanes, movement_candidates, disposed_issues, feature_classes,
              lane_starvation, kerb_allocation, dead_ends, entries_and_exits, exit_changes, lane_checks, lanes_per_way)
}

_NODES = NODES_SQL.replace("FROM lineitem", ", l_suppkey, l_quantity FROM lineitem")
_L = f"""WITH {_NODES},
s AS (SELECT *, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY pos) AS v FROM nodes),
lanes AS (SELECT l_orderkey * 64 + pos AS lane, l_orderkey AS way, l_partkey AS u, v, pos, l_suppkey % 2 AS direction, l_quantity FROM s WHERE v IS NOT NULL),
cs AS (SELECT -lane - 1 AS connector, lane AS from_lane, lead(lane) OVER (PARTITION BY u ORDER BY lane) AS to_lane, v,
  CASE WHEN l_quantity > 35 THEN 'forbidden' WHEN l_quantity > 30 THEN 'draft' ELSE 'active' END AS status, l_quantity FROM lanes),
c AS (SELECT * FROM cs WHERE to_lane IS NOT NULL),
links AS (SELECT * FROM (SELECT lane, lead(lane) OVER (PARTITION BY way ORDER BY pos) AS target FROM lanes) WHERE target IS NOT NULL)"""
SQL = {
    "lane_links": f"""{_L}, x AS (SELECT lane, CASE WHEN direction = 0 THEN lane + 1 ELSE -lane - 1 END AS ref FROM lanes),
      y AS (SELECT x.lane, CASE WHEN l.lane IS NOT NULL THEN l.lane WHEN c.status = 'active' THEN c.to_lane END AS target, CASE WHEN l.lane IS NULL AND c.connector IS NULL THEN 'unknown' END AS fault
        FROM x LEFT JOIN lanes l ON x.ref = l.lane LEFT JOIN c ON x.ref = c.connector)
      SELECT fault, count(*) AS n, CAST(coalesce(sum(target), 0) AS BIGINT) AS targets FROM y WHERE target IS NOT NULL OR fault IS NOT NULL GROUP BY 1""",
    "lane_changes": f"""{_L}, p AS (SELECT a.lane, b.lane AS target, CASE WHEN b.pos < a.pos THEN 'left' ELSE 'right' END AS side FROM lanes a JOIN lanes b ON a.way = b.way AND abs(a.pos - b.pos) = 1 AND a.direction = b.direction)
      SELECT side, count(*) AS n, CAST(sum(target) AS BIGINT) AS targets FROM p GROUP BY 1""",
    "connector_faults": f"""{_L}, f AS (
        SELECT connector, 'unlisted' AS fault FROM c WHERE status = 'active' AND NOT l_quantity < 33 UNION ALL SELECT connector, 'listed_inactive' FROM c WHERE status <> 'active' AND l_quantity < 33
        UNION ALL SELECT connector, 'unknown_lane' FROM c WHERE status = 'active' AND l_quantity = 7 UNION ALL SELECT connector, 'gap' FROM c WHERE status = 'active' AND l_quantity < 5)
      SELECT fault, count(*) AS n, CAST(sum(connector) AS BIGINT) AS ids FROM f GROUP BY 1""",
    "restriction_faults": f"""{_L}, f AS (SELECT CASE WHEN l_quantity = 34 THEN -connector ELSE connector END AS connector,
        CASE WHEN l_quantity = 34 THEN 'missing' WHEN l_quantity > 35 THEN NULL ELSE 'not_forbidden' END AS fault FROM c WHERE l_quantity > 33 OR l_quantity < 3)
      SELECT fault, count(*) AS n, CAST(sum(connector) AS BIGINT) AS ids FROM f WHERE fault IS NOT NULL GROUP BY 1""",
    "control_faults": f"""{_L}, w AS (SELECT way AS control, count(*) FILTER (direction = 0) AS n, count(*) FILTER (direction = 0 AND l_quantity = 9) AS bad FROM lanes GROUP BY 1)
      SELECT control, CASE WHEN n = 0 THEN 'no_lanes' ELSE 'unknown_lane' END AS fault FROM w WHERE n = 0 OR bad > 0""",
    "node_restrictions": """WITH m AS (SELECT l_suppkey AS frm, l_partkey AS node, lead(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS "to", l_returnflag, l_quantity FROM lineitem),
      k AS (SELECT * FROM m WHERE "to" IS NOT NULL), r AS (SELECT *, l_quantity > 45 AS o FROM k WHERE l_returnflag = 'R')
      SELECT DISTINCT k.frm, k.node, k."to" FROM k JOIN r ON k.frm = r.frm AND k.node = r.node WHERE (r.o AND k."to" <> r."to") OR (NOT r.o AND k."to" = r."to")""",
    "signal_lanes": f"""{_L}, q AS (SELECT * FROM lanes WHERE l_quantity > 40), i AS (SELECT v AS node, count(*) AS n FROM q GROUP BY 1), o AS (SELECT u AS node, count(*) AS n FROM q GROUP BY 1), t AS (SELECT DISTINCT u AS node FROM lanes)
      SELECT p_partkey AS node, CASE WHEN i.n > 0 THEN i.n WHEN t.node IS NOT NULL THEN coalesce(o.n, 0) ELSE 0 END AS n_lanes, CASE WHEN i.n > 0 THEN 'ok' WHEN t.node IS NOT NULL AND o.n > 0 THEN 'warning' ELSE 'blocker' END AS severity
      FROM part LEFT JOIN i ON p_partkey = i.node LEFT JOIN o ON p_partkey = o.node LEFT JOIN t ON p_partkey = t.node WHERE p_size < 10""",
    "movement_candidates": f"""{_L}, e AS (SELECT way, u AS node FROM lanes UNION SELECT way, v FROM lanes), n AS (SELECT node, count(*) AS ways FROM e GROUP BY 1), o AS (SELECT DISTINCT u AS node, way FROM lanes)
      SELECT n.node, CASE WHEN ways >= 3 THEN 'connector' ELSE 'continuation' END AS kind, count(*) AS n FROM lanes l JOIN o ON l.v = o.node AND l.way <> o.way JOIN n ON n.node = l.v GROUP BY ALL""",
    "disposed_issues": "SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'error' ELSE 'warning' END AS severity, coalesce(l.doc_id, -1) AS finding FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1) l ON d.doc_id = l.doc_id",
    "feature_classes": """WITH c AS (SELECT l_orderkey, 0 AS k, p_partkey AS id, p_brand AS road_class FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size < 8
        UNION SELECT l_orderkey, 1, -s_suppkey - 1, 'supplier' FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal > 5000),
      f AS (SELECT l_orderkey, first(road_class ORDER BY k, id) AS road_class FROM c GROUP BY 1) SELECT o.l_orderkey AS feature, road_class FROM (SELECT DISTINCT l_orderkey FROM lineitem) o LEFT JOIN f ON o.l_orderkey = f.l_orderkey""",
    "lane_starvation": """SELECT l_partkey AS node, l_returnflag AS approach, l_linestatus AS dest, count(DISTINCT l_suppkey) AS n_feeders, count(DISTINCT s_nationkey) AS n_landed
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL HAVING count(DISTINCT l_suppkey) > count(DISTINCT s_nationkey)""",
    "kerb_allocation": """WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS k FROM lineitem GROUP BY ALL), w AS (SELECT *, sum(k) OVER (PARTITION BY l_orderkey) AS t, sum(k) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - k AS b FROM g),
      e AS (SELECT *, CASE WHEN t = 4 THEN lane ELSE ((2 * lane + 1) * t) // 8 END - b AS target FROM w, (SELECT unnest(range(4)) AS lane))
      SELECT l_orderkey, l_linenumber, CAST(lane AS INT) AS lane, CAST(target AS BIGINT) AS target FROM e WHERE target >= 0 AND target < k""",
    "dead_ends": f"""{_L}, e AS (SELECT way, u AS node FROM lanes UNION SELECT way, v FROM lanes), t AS (SELECT node FROM e GROUP BY 1 HAVING count(*) <= 25),
      d AS (SELECT lane, 'exit' AS "end", v AS node FROM lanes WHERE lane NOT IN (SELECT lane FROM links) UNION ALL SELECT lane, 'entry', u FROM lanes WHERE lane NOT IN (SELECT target FROM links))
      SELECT "end", CASE WHEN t.node IS NULL THEN 'interior_dead_end' ELSE 'boundary' END AS fault, count(*) AS n, CAST(sum(lane) AS BIGINT) AS lanes FROM d LEFT JOIN t ON d.node = t.node GROUP BY ALL""",
    "entries_and_exits": f"""{_L}, q AS (SELECT * FROM lanes WHERE l_quantity > 40), k AS (SELECT * FROM (SELECT lane, lead(lane) OVER (PARTITION BY way ORDER BY pos) AS target FROM q) WHERE target IS NOT NULL),
      d AS (SELECT lane, CASE WHEN u IN (SELECT v FROM q) THEN 'rejected' ELSE 'entry' END AS role FROM q WHERE lane NOT IN (SELECT target FROM k) UNION ALL SELECT lane, 'exit' FROM q WHERE lane NOT IN (SELECT lane FROM k))
      SELECT role, CASE WHEN role = 'rejected' THEN 'node_is_reached' END AS reason, count(*) AS n, CAST(sum(lane) AS BIGINT) AS lanes FROM d GROUP BY ALL""",
    "exit_changes": f"""{_L}, x AS (SELECT lane, EXISTS (SELECT 1 FROM c WHERE from_lane = lane AND c.l_quantity > 20) AS b, EXISTS (SELECT 1 FROM c WHERE from_lane = lane AND status = 'active') AS a FROM lanes)
      SELECT CASE WHEN b AND NOT a THEN 'lost' WHEN a AND NOT b THEN 'gained' ELSE 'without' END AS change, count(*) AS n FROM x WHERE NOT (a AND b) GROUP BY 1""",
    "lane_checks": f"""{_L} SELECT 'restrictions' AS "check", count(*) AS n_rows, 0 AS n_issues, true AS ok FROM c UNION ALL SELECT 'loops', count(*), count(*) FILTER (u = v), count(*) FILTER (u = v) = 0 FROM lanes UNION ALL SELECT 'unknown', count(*), 0, true FROM lanes""",
    "lanes_per_way": f"""{_L}, n AS (SELECT way, count(*) AS n_lanes FROM lanes GROUP BY 1), b AS (SELECT min(p_size) AS min_x, min(p_retailprice) AS min_y, max(p_size) AS max_x, max(p_retailprice) AS max_y FROM part)
      SELECT n_lanes, count(*) AS n_ways, min_x, min_y, max_x, max_y, (min_x + max_x) / 2 AS centre_x, (min_y + max_y) / 2 AS centre_y FROM n, b GROUP BY ALL""",
}
