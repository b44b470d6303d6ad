"""Queries on reviews: findings are documents, decisions are labels; versions are lineitems by return flag."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlens.operators import review
from roadlens.plans.tables import table


def decided_findings(spark, sf_dir):
    """JN-18, AG-08: findings of each rule by decision."""
    f = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("rule"))
    d = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, "ignored").when(F.col("quality") == 1, "accepted").otherwise("rejected").alias("state"))
    twice = d.withColumn("at", F.lit(1)).unionByName(d.withColumn("state", F.lit("ignored")).withColumn("at", F.lit(0)))
    out = review.decided(f, twice, "doc_id", "state", "at")
    return out.groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status").isin("accepted", "rejected")).alias("n_resolved"), F.count_if(F.col("status") == "undecided").alias("n_open"))


def version_changes(spark, sf_dir):
    """ST-01: suppliers of parts before and after."""
    items = table(spark, sf_dir, "lineitem")
    side = lambda flag: items.filter(F.col("l_returnflag") == flag).select("l_orderkey")
    return review.version_diff(side("R"), side("N"), "l_orderkey")


def findings_by_rule(spark, sf_dir):
    """AG-06."""
    return review.by_rule(table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


def version_counts(spark, sf_dir):
    """AG-07: rows per entity and version, with totals."""
    items = table(spark, sf_dir, "lineitem")
    return items.rollup("l_linestatus", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("int").alias("level"))


def migrated_decisions(spark, sf_dir):
    """GATE-04: decisions carried, invalidated or unknown."""
    d = table(spark, sf_dir, "labels").select((F.col("doc_id") * 2).alias("doc_id"), (F.col("doc_id") % 3).alias("sum"))
    f = table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 3).alias("sum"))
    return review.migrated(d, f, "doc_id", "sum").groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def migrated_review(spark, sf_dir):
    """GATE-04: as above, with ignored blockers."""
    d = table(spark, sf_dir, "labels").select((F.col("doc_id") * 2).alias("doc_id"), (F.col("doc_id") % 2 * 3).alias("sum"), F.when(F.col("toxic") == 1, "ignored").otherwise("accepted").alias("status"))
    f = table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 4 / 2 * 3).cast("long").alias("sum"), F.when(F.col("lang") == "en", "blocker").otherwise("warning").alias("severity"))
    return review.migrated(d, f, "doc_id", "sum", "status", "severity").groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def reviewed_findings(spark, sf_dir):
    """JN-18: decisions on findings whose ids have changed since."""
    before = table(spark, sf_dir, "documents").select("doc_id", review.question_key(F.col("lang"), F.col("source"), F.col("doc_id")).alias("question"))
    d = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, "ignored").otherwise("accepted").alias("state"))
    reviewed = before.withColumn("doc_id", F.col("doc_id") + 1_000_000)
    return review.decided_by_question(reviewed, before, d, "doc_id", "question", "state").select("doc_id", "status")


def dangling_links(spark, sf_dir):
    """JN-09: orders' customers that have no row, and parts not named by any line."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") * 2).alias("o_custkey"))
    return review.dangling(orders, table(spark, sf_dir, "customer"), "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


def not_mirrored(spark, sf_dir):
    """JN-09: exits that the other side doesn't name as an entry."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    exits = l.select(F.col("l_suppkey").alias("id"), F.col("l_partkey").alias("to")).distinct()
    entries = l.filter("l_quantity > 25").select(F.col("l_partkey").alias("id"), F.col("l_suppkey").alias("frm"))
    return review.not_mirrored(exits, entries)


QUERIES = {f.__name__: f for f in (decided_findings, version_changes, findings_by_rule, version_counts, migrated_decisions, migrated_review, reviewed_findings, dangling_links, not_mirrored)}
SQL = {
    "decided_findings": """SELECT lang AS rule, count(*) AS n, count(*) FILTER (quality IS NOT NULL AND toxic <> 1) AS n_resolved, count(*) FILTER (l.doc_id IS NULL) AS n_open
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""",
    "version_changes": """WITH b AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'), a AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'N')
      SELECT l_orderkey, 'added' AS change FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT l_orderkey, 'removed' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    "findings_by_rule": "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS \"F\", count(*) FILTER (o_orderstatus = 'O') AS \"O\", count(*) FILTER (o_orderstatus = 'P') AS \"P\" FROM orders GROUP BY 1",
    "version_counts": "SELECT l_linestatus, l_returnflag, count(*) AS n, CAST(grouping(l_linestatus, l_returnflag) AS INT) AS level FROM lineitem GROUP BY ROLLUP (l_linestatus, l_returnflag)",
    "migrated_decisions": """SELECT CASE WHEN d.doc_id IS NULL THEN 'unknown' WHEN d.doc_id % 3 = l.doc_id % 3 THEN 'carried' ELSE 'invalidated' END AS state, count(*) AS n
      FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id * 2 GROUP BY 1""",
    "migrated_review": """SELECT CASE WHEN d.doc_id IS NULL THEN 'unknown' WHEN (l.doc_id % 2 * 3) <> (d.doc_id % 4 // 2 * 3) OR (l.toxic = 1 AND d.lang = 'en') THEN 'invalidated' ELSE 'carried' END AS state, count(*) AS n
      FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id * 2 GROUP BY 1""",
    "reviewed_findings": """SELECT d.doc_id + 1000000 AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'undecided' WHEN l.toxic = 1 THEN 'ignored' ELSE 'accepted' END AS status
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "dangling_links": "SELECT o_orderkey, o_custkey * 2 AS o_custkey FROM orders WHERE o_custkey * 2 NOT IN (SELECT c_custkey FROM customer)",
    "not_mirrored": """SELECT DISTINCT l_suppkey AS id, l_partkey AS "to" FROM lineitem a WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_partkey = a.l_partkey AND b.l_suppkey = a.l_suppkey AND b.l_quantity > 25)""",
}
