"""Queries on gates and decisions: documents are findings, labels decisions, orders map rows, suppliers plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlens.operators import gates
from roadlens.plans.tables import TAGS_SQL, table, way_tags


def _findings(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    severity = F.when(F.col("lang") == "en", "blocker").otherwise("warning")
    return d.select(F.col("doc_id").alias("finding"), F.col("lang").alias("rule"), F.col("source").alias("road_class"), (F.col("doc_id") % 5).alias("evidence"), (F.col("doc_id") % 7).alias("workspace"), severity.alias("severity"), F.col("doc_id").alias("question"), F.lit("found").alias("reason"))


def _decisions(spark, sf_dir):
    status = F.when(F.col("toxic") == 1, "not_applicable").when(F.col("quality") == 1, "accepted").otherwise("overridden")
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("finding"), (F.col("doc_id") % 10 - F.col("quality")).alias("evidence"), F.col("doc_id").alias("question"), (F.col("doc_id") % 14).alias("workspace"), status.alias("status"))


def checksum_gate(spark, sf_dir):
    """GATE-01: orders' priorities as inputs, those of a day's checks as records."""
    o = table(spark, sf_dir, "orders")
    recorded = o.filter("o_orderstatus <> 'P'").select("o_orderkey", F.sha2(F.when(F.col("o_totalprice") > 200_000, "x").otherwise(F.col("o_orderpriority")), 256).alias("sum"))
    return gates.checksum_gate(o.select("o_orderkey", F.sha2("o_orderpriority", 256).alias("sum")), recorded, "o_orderkey", "sum")


def plan_identity(spark, sf_dir):
    """GATE-02."""
    plans = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("plan"), (F.col("s_nationkey") % 3).cast("string").alias("fingerprint"), (F.col("s_suppkey") % 2).cast("string").alias("model"))
    return gates.plan_identity_gate(plans, F.lit("1"), F.lit("1"))


def _rule(c):
    """A language as a rule."""
    names = {"en": gates.SIGNAL_RULE, "de": gates.TURN_RULE, "fr": "lane_count_inference", "es": "ambiguous_connector"}
    out = F.lit("speed_default")
    for lang, rule in names.items():
        out = F.when(c == lang, rule).otherwise(out)
    return out


def review_gates(spark, sf_dir):
    """GATE-03; decisions on findings that aren't there come from shifted ids, lanes are parts."""
    value = F.when(F.col("quality") == 0, F.format_string('{"lane_ids": ["%d"], "lane_count": %d, "movement": "left", "accepted": true}', "doc_id", F.col("doc_id") % 20))
    d = table(spark, sf_dir, "labels").withColumn("value", value).withColumn("at", F.col("doc_id") % 10 - F.col("quality"))
    status = F.when(F.col("doc_id") % 9 == 0, "ignored").when(F.col("toxic") == 1, "not_applicable").when(F.col("quality") == 1, "accepted").otherwise("overridden")
    d = d.select((F.col("doc_id") * 2).alias("finding"), F.when(F.col("doc_id") % 14 > 0, "home").alias("workspace"), F.when(F.col("doc_id") % 13 > 0, "now").alias("fingerprint"), F.col("at").alias("evidence"), status.alias("status"), "value")
    f = _findings(spark, sf_dir).withColumn("rule", _rule(F.col("rule")))
    return gates.review_gates(d, f, F.lit("home"), F.lit("now"), table(spark, sf_dir, "part").select(F.col("p_partkey").alias("lane")), ("speed_default",))

def override_faults(spark, sf_dir):
    """PRJ-31."""
    i = table(spark, sf_dir, "lineitem")
    rule = F.when(F.col("l_returnflag") == "R", "lane_count_inference").when(F.col("l_returnflag") == "A", gates.TURN_RULE).otherwise("speed_default")
    value = F.when(F.col("l_returnflag") == "R", F.format_string('{"lane_count": %d}', F.col("l_quantity").cast("int"))).when(F.col("l_linestatus") == "O", '{"movement": "left"}').otherwise('{"movement": "upwards"}')
    return i.groupBy(F.coalesce(gates.override_fault(rule, value), F.lit("none")).alias("fault")).agg(F.count(F.lit(1)).alias("n"))

def turn_rewrites(spark, sf_dir):
    """PRJ-32: slot of a three-lane tag by the line number."""
    i = table(spark, sf_dir, "lineitem")
    tag = F.when(F.col("l_linestatus") == "O", "left|through|right").otherwise("left|right")
    return i.groupBy(F.coalesce(gates.rewrite_turn(tag, F.col("l_linenumber") - 1, F.lit("reverse"), F.lit(3)), F.lit("refused")).alias("tag")).agg(F.count(F.lit(1)).alias("n"))


def review_queue(spark, sf_dir):
    """PRJ-27."""
    f = _findings(spark, sf_dir).join(_decisions(spark, sf_dir).select("finding", F.when(F.col("status") == "not_applicable", "ignored").otherwise(F.col("status")).alias("status")), "finding")
    return gates.queue(f, rule="en", text="1").select("finding", "status")


def plan_faults(spark, sf_dir):
    """PRJ-29: suppliers of a nation as a plan's rows."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("plan"), F.when(F.col("s_suppkey") % 10 == 0, "-bad").otherwise(F.col("s_name")).alias("name"), (F.col("s_suppkey") % 4).alias("lane"), (F.col("s_acctbal") / 100).alias("green"), F.lit(4.0).alias("yellow"), F.lit(60.0).alias("cycle"))
    s = s.withColumn("name", F.regexp_replace("name", "[^A-Za-z0-9-]", "-"))
    return gates.plan_faults(s).groupBy("plan", "fault").agg(F.count(F.lit(1)).alias("n"))


def decision_effects(spark, sf_dir):
    """GATE-06: decisions on targets that findings share."""
    f = _findings(spark, sf_dir).select("finding", F.col("rule").alias("kind"), F.expr("finding div 4").alias("target"), F.when(F.col("evidence") < 2, "forbid").otherwise("allow").alias("proposed"))
    return gates.effects(_decisions(spark, sf_dir), f).select("kind", "target", F.coalesce("effect", F.lit("none")).alias("effect"), "contradicted")


def _states(spark, sf_dir):
    """Decisions over documents of the reviewed model: those whose evidence is under 3, with two parts as nodes."""
    after = _reviewed(spark, sf_dir)
    unmapped = table(spark, sf_dir, "part").filter("p_size < 10").select(F.col("p_partkey").alias("node"))
    return gates.decision_states(_decisions(spark, sf_dir), _findings(spark, sf_dir).filter("evidence <> 1"), after, unmapped)


def _reviewed(spark, sf_dir):
    f = _findings(spark, sf_dir).filter("evidence < 3").withColumn("rule", _rule(F.col("rule")))
    return f.withColumn("nodes", F.array("finding", F.col("finding") + 1))


def unsatisfied_decisions(spark, sf_dir):
    """GATE-07."""
    return _states(spark, sf_dir).filter("not satisfied").select("finding", "status")

def bulk_decisions(spark, sf_dir):
    """GATE-08."""
    return gates.fan_out(_findings(spark, sf_dir), "de", "accepted")


def rewritten_maps(spark, sf_dir):
    """GATE-09, PRJ-32: approved lane counts on ways."""
    ways = way_tags(spark, sf_dir).select(F.col("o_orderkey").alias("way"), "tags")
    approved = table(spark, sf_dir, "orders").filter("o_totalprice > 100000").select(F.col("o_orderkey").alias("way"), F.lit("lanes").alias("key"), F.lit("2").alias("value"))
    out = gates.rewritten_tags(ways, approved)
    return out.select("way", F.array_join("changed", ",").alias("changed"), F.element_at("tags", "lanes").alias("lanes"), F.size("tags").cast("long").alias("n_tags"))


def question_changes(spark, sf_dir):
    """ST-02: findings before and after, with repeats."""
    f = _findings(spark, sf_dir)
    return gates.question_changes(f.filter("evidence <> 1").unionByName(f.filter("evidence = 3")), f.filter("evidence <> 2"))


def open_blockers(spark, sf_dir):
    """ST-05."""
    return gates.open_blockers(_reviewed(spark, sf_dir), _states(spark, sf_dir))

def queue_head(spark, sf_dir):
    """SO-01: the first hundred of the queue."""
    return gates.first_by(_findings(spark, sf_dir), 100, *gates.queue_order({"fr": 0, "de": 1, "en": 1})).select("place", "finding")


def issue_head(spark, sf_dir):
    """SO-02."""
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("code"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_custkey")).alias("id"), F.col("c_name").alias("reason"))
    return gates.first_by(c, 50, *gates.issue_order()).select("place", "code", "reason")


def conflict_head(spark, sf_dir):
    """SO-03: overlap, distance sum, names."""
    s = table(spark, sf_dir, "supplier")
    return gates.first_by(s, 40, F.desc("s_acctbal"), F.asc(F.col("s_nationkey") + F.col("s_suppkey") % 5), F.asc("s_name")).select("place", "s_suppkey")


def id_head(spark, sf_dir):
    """SO-04: customer keys as text by length, then value."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    return gates.first_by(c, 60, *gates.id_order(F.col("id")))


def seeded_routes(spark, sf_dir):
    """SO-05."""
    return gates.seeded(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey", 25, 7)


def worst_offenders(spark, sf_dir):
    """SO-06: the dearest order of each customer."""
    return gates.worst(table(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice", "o_orderkey")


QUERIES = {
    f.__name__: f
    for f in (checksum_gate, plan_identity, review_gates, override_faults, turn_rewrites, review_queue, plan_faults, decision_effects, unsatisfied_decisions, bulk_decisions, rewritten_maps,
              question_changes, open_blockers, queue_head, issue_head, conflict_head, id_head, seeded_routes, worst_offenders)
}

_F = "f AS (SELECT doc_id AS finding, lang AS rule, doc_id % 5 AS evidence, doc_id % 7 AS workspace, CASE WHEN lang = 'en' THEN 'blocker' ELSE 'warning' END AS severity FROM documents)"
_D = "d AS (SELECT doc_id AS finding, doc_id % 10 - quality AS evidence, doc_id % 14 AS workspace, CASE WHEN toxic = 1 THEN 'not_applicable' WHEN quality = 1 THEN 'accepted' ELSE 'overridden' END AS status FROM labels)"
_ST = """st AS (SELECT f.finding, d.status, lang, severity, d.finding IS NOT NULL AS decided, CASE WHEN lang = 'de' THEN status <> 'overridden' WHEN lang = 'en' THEN NOT EXISTS (SELECT 1 FROM part WHERE p_size < 10 AND p_partkey IN (f.finding, f.finding + 1)) ELSE true END AS satisfied
      FROM (SELECT *, rule AS lang FROM f WHERE evidence < 3) f LEFT JOIN (SELECT * FROM d WHERE finding IN (SELECT finding FROM f WHERE evidence <> 1)) d ON f.finding = d.finding)"""
SQL = {
    "checksum_gate": """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'unrecorded' ELSE 'changed' END AS fault FROM orders WHERE o_orderstatus = 'P' OR o_totalprice > 200000""",
    "plan_identity": "SELECT s_suppkey AS plan, CASE WHEN s_nationkey % 3 <> 1 THEN 'fingerprint' WHEN s_suppkey % 2 <> 1 THEN 'model' END AS refused FROM supplier",
    "review_gates": """WITH f AS (SELECT doc_id AS finding, doc_id % 5 AS evidence, lang FROM documents),
      d AS (SELECT doc_id * 2 AS finding, doc_id, doc_id % 10 - quality AS evidence, CASE WHEN doc_id % 9 = 0 THEN 'ignored' WHEN toxic = 1 THEN 'not_applicable' WHEN quality = 1 THEN 'accepted' ELSE 'overridden' END AS status, quality FROM labels),
      g AS (SELECT coalesce(d.finding, f.finding) AS finding, CASE WHEN doc_id % 14 = 0 THEN 'workspace' WHEN doc_id % 13 = 0 THEN 'fingerprint' WHEN f.finding IS NULL THEN 'unknown_finding' WHEN d.evidence <> f.evidence THEN 'evidence'
          WHEN lang = 'en' AND (doc_id IS NULL OR status = 'ignored') THEN 'open_blocker' WHEN status <> 'overridden' OR doc_id IS NULL THEN NULL WHEN lang NOT IN ('en', 'de', 'fr', 'es') THEN 'tag_rule'
          WHEN quality <> 0 OR (lang = 'fr' AND doc_id % 20 NOT BETWEEN 1 AND 12) THEN 'value' WHEN lang = 'en' AND doc_id NOT IN (SELECT p_partkey FROM part) THEN 'unknown_lane' END AS gate FROM d FULL JOIN f ON d.finding = f.finding)
      SELECT * FROM g WHERE gate IS NOT NULL""",
    "override_faults": """WITH k AS (SELECT CASE l_returnflag WHEN 'R' THEN CASE WHEN CAST(l_quantity AS INT) BETWEEN 1 AND 12 THEN 'none' ELSE 'value' END WHEN 'A' THEN CASE WHEN l_linestatus = 'O' THEN 'none' ELSE 'value' END ELSE 'rule' END AS fault FROM lineitem)
      SELECT fault, count(*) AS n FROM k GROUP BY 1""",
    "turn_rewrites": """WITH k AS (SELECT CASE WHEN l_linestatus <> 'O' THEN 'refused' WHEN l_linenumber = 1 THEN 'reverse|through|right' WHEN l_linenumber = 2 THEN 'left|reverse|right' WHEN l_linenumber = 3 THEN 'left|through|reverse' ELSE 'refused' END AS tag FROM lineitem)
      SELECT tag, count(*) AS n FROM k GROUP BY 1""",
    "review_queue": f"WITH {_F}, {_D} SELECT f.finding, status FROM f JOIN d ON f.finding = d.finding WHERE rule = 'en' AND status <> 'not_applicable' AND contains(CAST(f.finding AS VARCHAR), '1')",
    "plan_faults": r"""WITH s AS (SELECT s_nationkey AS plan, CASE WHEN s_suppkey % 10 = 0 THEN '-bad' ELSE regexp_replace(s_name, '[^A-Za-z0-9-]', '-', 'g') END AS name, s_suppkey % 4 AS lane, s_acctbal / 100 AS green FROM supplier),
      c AS (SELECT *, count(*) OVER (PARTITION BY plan, name) AS ns, count(*) OVER (PARTITION BY plan, lane) AS ls FROM s),
      f AS (SELECT plan, name, 'name' AS fault FROM c WHERE NOT regexp_matches(name, '^[A-Za-z0-9][A-Za-z0-9-]{0,39}$') UNION SELECT plan, name, 'too_long' FROM c WHERE green + 4.0 > 60.0
        UNION SELECT plan, name, 'repeated_name' FROM c WHERE ns > 1 UNION SELECT plan, name, 'repeated_lane' FROM c WHERE ls > 1) SELECT plan, fault, count(*) AS n FROM f GROUP BY ALL""",
    "decision_effects": f"""WITH {_F}, {_D}, k AS (SELECT rule AS kind, f.finding // 4 AS target, CASE WHEN (status = 'accepted') = (f.evidence < 2) THEN 'forbid' ELSE 'allow' END AS w FROM d JOIN f ON d.finding = f.finding WHERE status <> 'not_applicable')
      SELECT kind, target, CASE WHEN min(w) < max(w) THEN 'none' ELSE min(w) END AS effect, min(w) < max(w) AS contradicted FROM k GROUP BY ALL""",
    "unsatisfied_decisions": f"WITH {_F}, {_D}, {_ST} SELECT finding, status FROM st WHERE decided AND NOT satisfied",
    "bulk_decisions": "SELECT doc_id AS finding, 'accepted' AS status FROM documents WHERE lang = 'de'",
    "rewritten_maps": f"""WITH {TAGS_SQL}, p AS (SELECT o_orderkey FROM orders WHERE o_totalprice > 100000)
      SELECT t.o_orderkey AS way, 'lanes' AS changed, '2' AS lanes, 2 + CAST(oneway IS NOT NULL AS BIGINT) + CAST(access IS NOT NULL AS BIGINT) + CAST(forward IS NOT NULL AS BIGINT) AS n_tags FROM tags t JOIN p ON t.o_orderkey = p.o_orderkey WHERE lanes <> 2""",
    "question_changes": "SELECT doc_id AS question, 'created' AS change FROM documents WHERE doc_id % 5 = 1 UNION ALL SELECT doc_id, 'resolved' FROM documents WHERE doc_id % 5 = 2",
    "open_blockers": f"WITH {_F}, {_D}, {_ST} SELECT finding FROM st WHERE severity = 'blocker' AND (NOT decided OR (NOT satisfied AND status <> 'not_applicable'))",
    "queue_head": "SELECT row_number() OVER (ORDER BY CASE lang WHEN 'fr' THEN 0 WHEN 'de' THEN 1 WHEN 'en' THEN 1 ELSE 10 END, lang, doc_id) AS place, doc_id AS finding FROM documents QUALIFY place <= 100",
    "issue_head": "WITH c AS (SELECT c_mktsegment AS code, coalesce(CASE WHEN c_custkey % 3 > 0 THEN CAST(c_custkey AS VARCHAR) END, '') AS id, c_name AS reason FROM customer) SELECT row_number() OVER (ORDER BY code, id, reason) AS place, code, reason FROM c QUALIFY place <= 50",
    "conflict_head": "SELECT row_number() OVER (ORDER BY s_acctbal DESC, s_nationkey + s_suppkey % 5, s_name) AS place, s_suppkey FROM supplier QUALIFY place <= 40",
    "id_head": "SELECT CAST(c_custkey AS VARCHAR) AS id, row_number() OVER (ORDER BY length(CAST(c_custkey AS VARCHAR)), CAST(c_custkey AS VARCHAR)) AS place FROM customer QUALIFY place <= 60",
    "seeded_routes": "SELECT p_partkey, row_number() OVER (ORDER BY md5('7:' || CAST(p_partkey AS VARCHAR)), p_partkey) AS place FROM part QUALIFY place <= 25",
    "worst_offenders": "SELECT o_custkey, max(o_totalprice) AS o_totalprice, min(o_orderkey) FILTER (o_totalprice = m) AS o_orderkey FROM (SELECT *, max(o_totalprice) OVER (PARTITION BY o_custkey) AS m FROM orders) GROUP BY 1",
}
