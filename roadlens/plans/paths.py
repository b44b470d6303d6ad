"""Queries on restriction chains through ways, signal phases and the vertices of tracks."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from roadlens.operators import phases, restrictions, vertices
from roadlens.plans.lanes import lane_table
from roadlens.plans.tables import NODES_SQL, events, table, way_nodes


def _chain_tables(spark, sf_dir):
    """Restrictions and moves: a move leads from a lane to the next one that starts at its start; each way has one restriction.

    It leads from the least way that feeds the way to the least that it feeds, for even ways through that one as well.
    """
    nxt = lambda c: F.lead(c).over(Window.partitionBy("u").orderBy("lane"))
    moves = lane_table(spark, sf_dir).select(F.col("lane").alias("move"), F.col("way").alias("from_way"), nxt("way").alias("to_way"), F.col("u").alias("node")).filter("to_way is not null")
    fed = moves.filter("from_way <> to_way")
    into = fed.groupBy(F.col("to_way").alias("way")).agg(F.min("from_way").alias("a"))
    away = fed.groupBy(F.col("from_way").alias("way")).agg(F.min("to_way").alias("c"))
    both = into.join(away, "way").join(away.select(F.col("way").alias("c"), F.col("c").alias("d")), "c", "left")
    long = (F.col("way") % 2 == 0) & F.col("d").isNotNull()
    kind = F.when(F.col("way") % 5 == 0, "only_straight_on").when(F.col("way") % 11 == 0, "give_way").otherwise("no_straight_on")
    vias = F.when(long, F.array("way", "c")).otherwise(F.array("way"))
    return both.select(F.col("way").alias("relation"), kind.alias("kind"), F.array("a").alias("froms"), vias.alias("vias"), F.array(F.when(long, F.col("d")).otherwise(F.col("c"))).alias("tos")), moves


def via_way_chains(spark, sf_dir):
    """JN-14: what becomes of each restriction through ways, and the ways that stand in the way."""
    decisions, _ = restrictions.via_way_chains(*_chain_tables(spark, sf_dir))
    return decisions.select("relation", "status", "reason", F.concat_ws(",", F.transform("ways", lambda w: w.cast("string"))).alias("ways"))


def via_way_moves(spark, sf_dir):
    """JN-14: the moves that go or are held."""
    return restrictions.via_way_chains(*_chain_tables(spark, sf_dir))[1]


def phase_stages(spark, sf_dir):
    """GR-11: a brand is a plan, its parts are phase groups, and parts of one order meet."""
    parts = table(spark, sf_dir, "part")
    groups = parts.select(F.col("p_brand").alias("plan"), F.col("p_partkey").alias("name"), (F.col("p_size") % 4 + 1).alias("lanes"), (F.col("p_size") + 4).cast("double").alias("green"), F.lit(3.0).alias("yellow"))
    sold = way_nodes(spark, sf_dir).select("l_orderkey", "l_partkey").join(parts.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("plan")), "l_partkey")
    conflicts = sold.select("plan", "l_orderkey", F.col("l_partkey").alias("a")).join(sold.select("plan", "l_orderkey", F.col("l_partkey").alias("b")), ["plan", "l_orderkey"]).filter("a < b")
    out = phases.staged(groups, conflicts, 90.0)
    return out.select("plan", "name", F.col("stage").cast("long").alias("stage"), "offset", "green", (F.col("green") < F.col("was")).alias("shortened"), "fault")


def _points(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("us", "event_id")
    e = events(spark, sf_dir).withColumn("pos", F.row_number().over(w) - 1)
    return e.select(F.col("user_id").alias("line"), "pos", (F.col("pos") * 5).cast("double").alias("x"), F.floor("value").cast("double").alias("y"))


def thinned_tracks(spark, sf_dir):
    """WN-20: the vertices of each track that thinning to 20 m leaves."""
    return vertices.thinned(_points(spark, sf_dir), 20.0).select("line", F.col("pos").cast("long").alias("pos"))


def tracks_without_repeats(spark, sf_dir):
    """WN-21: the vertices of each track that are over 25 m from the one kept before."""
    return vertices.without_repeats(_points(spark, sf_dir), 25.0).select("line", F.col("pos").cast("long").alias("pos"))


QUERIES = {f.__name__: f for f in (via_way_chains, via_way_moves, phase_stages, thinned_tracks, tracks_without_repeats)}

# Every leg is judged by itself here: all that would lose a move if it went.
_CHAINS = f"""WITH {NODES_SQL},
lanes AS (SELECT * FROM (SELECT l_orderkey * 64 + pos AS lane, l_orderkey AS way, l_partkey AS u, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY pos) AS v FROM nodes) WHERE v IS NOT NULL),
moves AS (SELECT * FROM (SELECT lane AS move, way AS from_way, lead(way) OVER (PARTITION BY u ORDER BY lane) AS to_way, u AS node FROM lanes) WHERE to_way IS NOT NULL),
links AS (SELECT DISTINCT from_way AS a, to_way AS b FROM moves WHERE from_way <> to_way),
into_ AS (SELECT b AS way, min(a) AS a FROM links GROUP BY 1), away AS (SELECT a AS way, min(b) AS c FROM links GROUP BY 1),
r AS (SELECT i.way AS relation, CASE WHEN i.way % 5 = 0 THEN 'only' WHEN i.way % 11 = 0 THEN 'other' ELSE 'no' END AS kind,
  CASE WHEN i.way % 2 = 0 AND n.c IS NOT NULL THEN [i.a, i.way, w.c, n.c] ELSE [i.a, i.way, w.c] END AS chain FROM into_ i JOIN away w USING (way) LEFT JOIN away n ON n.way = w.c),
legs AS (SELECT relation, kind, chain, len(chain) - 1 AS n, unnest(range(1, len(chain))) AS leg FROM r),
steps AS (SELECT relation, kind, n, leg, chain[leg] AS src, chain[leg + 1] AS dst FROM legs),
met AS (SELECT s.relation, s.leg, count(DISTINCT m.node) AS nodes, min(m.node) AS node FROM steps s LEFT JOIN moves m ON m.from_way = s.src AND m.to_way = s.dst GROUP BY 1, 2),
lost AS (SELECT s.relation, s.leg AS leg, k.a AS way FROM steps s JOIN steps t ON t.relation = s.relation AND t.leg < s.leg JOIN links k ON k.b = t.dst AND k.a <> t.src
  UNION SELECT s.relation, s.leg, k.b FROM steps s JOIN steps t ON t.relation = s.relation AND t.leg > s.leg JOIN links k ON k.a = t.src AND k.b <> t.dst),
exact AS (SELECT relation, max(leg) AS leg FROM steps WHERE (relation, leg) NOT IN (SELECT (relation, leg) FROM lost) GROUP BY 1),
bad AS (SELECT relation, min(leg) AS leg, arg_min(nodes, leg) AS nodes FROM met WHERE nodes <> 1 GROUP BY 1),
judged AS (SELECT r.relation, r.kind, len(r.chain) - 1 AS n, e.leg, CASE WHEN b.nodes = 0 THEN 'missing' WHEN b.nodes > 1 THEN 'branching' WHEN r.kind = 'only' THEN 'exit_kept' WHEN r.kind = 'other' THEN 'unsupported'
  WHEN e.leg IS NULL THEN 'blocked' WHEN e.leg < len(r.chain) - 1 THEN 'prefix_removed' ELSE 'suffix_removed' END AS reason FROM r LEFT JOIN bad b USING (relation) LEFT JOIN exact e USING (relation))
"""
_POINTS = """p AS (SELECT user_id AS line, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, value FROM events),
q AS (SELECT line, pos, CAST(pos * 5 AS DOUBLE) AS x, CAST(floor(value) AS DOUBLE) AS y FROM p)"""
SQL = {
    "via_way_chains": _CHAINS
    + """SELECT j.relation, CASE WHEN reason IN ('suffix_removed', 'prefix_removed', 'exit_kept') THEN 'enforced' ELSE 'review_required' END AS status, reason,
  coalesce((SELECT string_agg(CAST(way AS VARCHAR), ',' ORDER BY way) FROM (SELECT DISTINCT way FROM lost l WHERE l.relation = j.relation AND ((reason = 'prefix_removed' AND l.leg = j.n) OR reason = 'blocked'))), '') AS ways FROM judged j""",
    "via_way_moves": _CHAINS
    + """SELECT j.relation, m.move, CASE WHEN reason = 'blocked' THEN 'hold' ELSE 'remove' END AS action FROM judged j JOIN steps s ON s.relation = j.relation AND s.leg = CASE WHEN reason = 'prefix_removed' THEN j.leg ELSE j.n END
JOIN moves m ON m.from_way = s.src AND m.to_way = s.dst WHERE reason IN ('suffix_removed', 'prefix_removed', 'blocked')
UNION ALL SELECT j.relation, m.move, 'remove' FROM judged j JOIN steps s ON s.relation = j.relation AND s.leg = j.n JOIN met t ON t.relation = j.relation AND t.leg = j.n
JOIN moves m ON m.from_way = s.src AND m.node = t.node AND m.to_way <> s.dst WHERE reason = 'exit_kept'""",
    # One group after another.
    "phase_stages": f"""WITH RECURSIVE {NODES_SQL},
sold AS (SELECT DISTINCT p_brand AS plan, l_orderkey, l_partkey FROM nodes JOIN part ON p_partkey = l_partkey),
e AS (SELECT DISTINCT s.plan, s.l_partkey AS a, t.l_partkey AS b FROM sold s JOIN sold t ON s.plan = t.plan AND s.l_orderkey = t.l_orderkey AND s.l_partkey <> t.l_partkey),
g AS (SELECT p_brand AS plan, p_partkey AS name, p_size % 4 + 1 AS lanes, CAST(p_size + 4 AS DOUBLE) AS green, 3.0 AS yellow, coalesce(d, 0) AS d FROM part LEFT JOIN (SELECT plan, a, count(*) AS d FROM e GROUP BY 1, 2) x ON x.plan = p_brand AND x.a = p_partkey),
o AS (SELECT *, row_number() OVER (PARTITION BY plan ORDER BY d DESC, name) AS k FROM g),
v AS (SELECT o.plan, o.k, coalesce(list(h.k) FILTER (h.k < o.k), []) AS before FROM o LEFT JOIN e ON e.plan = o.plan AND e.a = o.name LEFT JOIN o h ON h.plan = e.plan AND h.name = e.b GROUP BY 1, 2),
c AS (SELECT DISTINCT plan, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS cols FROM o UNION ALL
  SELECT c.plan, v.k, list_append(c.cols, list_min([x FOR x IN range(0, len(c.cols) + 1) IF NOT list_contains([c.cols[i] FOR i IN v.before], x)])) FROM c JOIN v ON v.plan = c.plan AND v.k = c.k + 1),
f AS (SELECT plan, arg_max(cols, k) AS cols FROM c GROUP BY 1),
s AS (SELECT o.*, f.cols[o.k] AS colour FROM o JOIN f USING (plan)),
t AS (SELECT plan, colour, row_number() OVER (PARTITION BY plan ORDER BY sum(lanes) DESC, colour) - 1 AS stage, count(*) OVER (PARTITION BY plan) AS n FROM s GROUP BY plan, colour),
u AS (SELECT plan, colour, stage, floor(stage * 90.0::DOUBLE / n * 10 + 0.5) / 10 AS "offset", CASE WHEN stage + 1 < n THEN floor((stage + 1) * 90.0::DOUBLE / n * 10 + 0.5) / 10 ELSE 90.0::DOUBLE END AS until FROM t),
m AS (SELECT s.*, u.stage, u."offset", floor((u.until - u."offset" - 3.0::DOUBLE) * 10 + 0.5) / 10 AS room FROM s JOIN u USING (plan, colour)),
z AS (SELECT *, CASE WHEN count(*) OVER w < 2 THEN 'nothing_to_do' WHEN max(d) OVER w = 0 THEN 'no_conflict' WHEN min(room) OVER w <= 0 THEN 'full_yellow' END AS fault FROM m WINDOW w AS (PARTITION BY plan))
SELECT plan, name, CASE WHEN fault IS NULL THEN stage END AS stage, CASE WHEN fault IS NULL THEN "offset" END AS "offset", CASE WHEN fault IS NULL THEN least(green, room) ELSE green END AS green, fault IS NULL AND room < green AS shortened, fault FROM z""",
    "thinned_tracks": f"""WITH RECURSIVE {_POINTS},
s AS (SELECT line, min(pos) AS a, max(pos) AS b FROM q GROUP BY 1 UNION ALL
  SELECT line, unnest([a, m]), unnest([m, b]) FROM (
    SELECT line, a, b, arg_max(pos, (off, -pos)) AS m, max(off) AS far FROM (
      SELECT s.line, s.a, s.b, p.pos, sqrt((g.x - f.x) ** 2 + (g.y - f.y) ** 2) AS size, abs((p.x - f.x) * (-(g.y - f.y) / size) + (p.y - f.y) * ((g.x - f.x) / size)) AS off
      FROM s JOIN q f ON f.line = s.line AND f.pos = s.a JOIN q g ON g.line = s.line AND g.pos = s.b JOIN q p ON p.line = s.line AND p.pos > s.a AND p.pos < s.b)
    GROUP BY 1, 2, 3) WHERE far > 20.0)
SELECT DISTINCT line, pos FROM (SELECT line, a AS pos FROM s UNION ALL SELECT line, b FROM s)""",
    "tracks_without_repeats": f"""WITH RECURSIVE {_POINTS},
k AS (SELECT line, min(pos) AS pos FROM q GROUP BY 1 UNION ALL
  SELECT k.line, min(n.pos) FROM k JOIN q p ON p.line = k.line AND p.pos = k.pos JOIN q n ON n.line = k.line AND n.pos > k.pos AND sqrt((n.x - p.x) ** 2 + (n.y - p.y) ** 2) > 25.0 GROUP BY k.line, k.pos)
SELECT line, pos FROM k""",
}
