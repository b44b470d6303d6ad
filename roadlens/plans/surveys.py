"""Queries on surveys: lineitems as logged pedal steps, orders and suppliers as versions, events as tracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlens.operators import surveys, tracks
from roadlens.plans.tables import table
from roadlens.plans.tracks import _T, KEYS, ORDER, _track


def _cells(spark, sf_dir):
    steps = table(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("int").alias("speed"), F.round(F.col("l_discount") * 100).cast("int").alias("pedal"), F.round("l_extendedprice").cast("long").alias("price"), (F.col("l_quantity") + F.col("l_tax")).alias("before"))
    return surveys.calibration_surface(steps, "speed", "pedal", "price", "before").withColumn("mean", F.round("mean", 4)).withColumn("drift", F.round("drift", 9))


def pedal_surface(spark, sf_dir):
    """AG-18."""
    return _cells(spark, sf_dir)


def filled_surface(spark, sf_dir):
    """AG-19: cells of an odd sum of speed and pedal, and each third speed, count as unmeasured."""
    some = _cells(spark, sf_dir).withColumn("mean", F.when((F.col("speed") + F.col("pedal")) % 2 + F.col("speed") % 3 > 1, F.col("mean")))
    return surveys.fill_nearest(some, "speed", "pedal", "mean").select("speed", "pedal", "filled")


def monotone_surface(spark, sf_dir):
    """AG-20: how many cells of each speed were raised."""
    return surveys.monotone(_cells(spark, sf_dir), "speed", "pedal", "mean").groupBy("speed").agg(F.count_if("repaired").alias("n_repaired"), F.max("risen").alias("most"))


def apportioned(spark, sf_dir):
    """AG-28: 1,000 cars over an order's lines by quantity."""
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum(F.col("l_quantity").cast("long")).alias("w"))
    return surveys.apportion(items, ["l_orderkey"], ["l_linenumber"], "w", 1000).select("l_orderkey", "l_linenumber", "share")


def moving_columns(spark, sf_dir):
    """AG-22: numbers of an order's lines that change."""
    return surveys.moving_columns(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]).groupBy("n_moving").agg(F.count(F.lit(1)).alias("n"))


def stage_parity(spark, sf_dir):
    """JN-04: orders before and after some are dropped, added and changed."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    before = o.filter("o_orderstatus <> 'P'")
    after = o.filter("o_orderpriority <> '1-URGENT'").withColumn("o_orderpriority", F.when(F.col("o_totalprice") > 100_000, F.col("o_orderpriority")))
    return surveys.parity(before, after, "o_orderkey")


def restriction_retention(spark, sf_dir):
    """JN-06: orders all of whose suppliers have money."""
    members = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    chosen = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return surveys.retained(members, chosen, "l_orderkey", "l_suppkey")


def heading_swings(spark, sf_dir):
    """WN-13, and the swings of WN-10: swings over 30 degrees in a step, and of 140 degrees or more in three."""
    t = tracks.headings(_track(spark, sf_dir), KEYS, ORDER)
    t = surveys.swings(t, KEYS, ORDER, "heading", 1).withColumnRenamed("swing", "one")
    t = surveys.swings(t, KEYS, ORDER, "heading", 3)
    return t.groupBy("user_id").agg(F.round(F.max("one"), 5).alias("worst"), F.count_if(F.round("one", 5) > 30).alias("n_sharp"), F.count_if(F.round("swing", 5) >= 140).alias("n_turned"))


def dwell_times(spark, sf_dir):
    """WN-07: samples of high value wait for five seconds."""
    t = _track(spark, sf_dir).withColumn("wait", F.when(F.col("value") > 100, 5).otherwise(0))
    return surveys.dwells(t, KEYS, ORDER, "x", "wait").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("leaving").alias("n_waits"), F.max("at").alias("ends"), F.sum("at").alias("total"))


QUERIES = {f.__name__: f for f in (pedal_surface, filled_surface, monotone_surface, apportioned, moving_columns, stage_parity, restriction_retention, heading_swings, dwell_times)}

_C = "c AS (SELECT CAST(l_quantity AS INT) AS speed, CAST(round(l_discount * 100) AS INT) AS pedal, round(avg(CAST(round(l_extendedprice) AS BIGINT)), 4) AS mean, count(*) AS n, round(max(abs(l_quantity + l_tax - CAST(l_quantity AS INT))), 9) AS drift FROM lineitem GROUP BY ALL)"
SQL = {
    "pedal_surface": f"WITH {_C} SELECT speed, pedal, mean, n, drift FROM c",
    "filled_surface": f"""WITH {_C}, k AS (SELECT * FROM c WHERE (speed + pedal) % 2 + speed % 3 > 1)
      SELECT c.speed, c.pedal, min_by(k.mean, abs(k.speed - c.speed) * 1000 + k.speed) AS filled FROM c LEFT JOIN k ON c.pedal = k.pedal GROUP BY ALL""",
    "monotone_surface": f"WITH {_C}, r AS (SELECT *, max(mean) OVER (PARTITION BY speed ORDER BY pedal) AS risen FROM c) SELECT speed, count(*) FILTER (risen > mean) AS n_repaired, max(risen) AS most FROM r GROUP BY 1",
    "apportioned": """WITH w AS (SELECT l_orderkey, l_linenumber, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS w FROM lineitem GROUP BY ALL), s AS (SELECT *, CAST(sum(w) OVER (PARTITION BY l_orderkey) AS BIGINT) AS s FROM w),
      b AS (SELECT *, CASE WHEN s > 0 THEN 1000 * w // s ELSE 0 END AS b, CASE WHEN s > 0 THEN 1000 * w % s ELSE 0 END AS r FROM s),
      k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY r DESC, l_linenumber) AS k, CASE WHEN s > 0 THEN 1000 - sum(b) OVER (PARTITION BY l_orderkey) ELSE 0 END AS rest FROM b)
      SELECT l_orderkey, l_linenumber, b + CASE WHEN k <= rest THEN 1 ELSE 0 END AS share FROM k""",
    "moving_columns": """WITH m AS (SELECT l_orderkey, CAST(stddev_pop(l_quantity) > 1e-6 AS INT) + CAST(stddev_pop(l_extendedprice) > 1e-6 AS INT) + CAST(stddev_pop(l_discount) > 1e-6 AS INT) + CAST(stddev_pop(l_tax) > 1e-6 AS INT) AS n_moving FROM lineitem GROUP BY 1)
      SELECT n_moving, count(*) AS n FROM m GROUP BY 1""",
    "stage_parity": """WITH a AS (SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN o_orderpriority END AS s FROM orders WHERE o_orderpriority <> '1-URGENT'), b AS (SELECT o_orderkey, o_orderpriority AS s FROM orders WHERE o_orderstatus <> 'P'),
      f AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'missing' WHEN b.o_orderkey IS NULL THEN 'extra' WHEN a.s IS DISTINCT FROM b.s THEN 'changed' END AS fault FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
      SELECT * FROM f WHERE fault IS NOT NULL""",
    "restriction_retention": """WITH m AS (SELECT l_orderkey, count(DISTINCT l_suppkey) FILTER (s_suppkey IS NULL) AS n_missing FROM lineitem LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) ON l_suppkey = s_suppkey GROUP BY 1)
      SELECT l_orderkey, n_missing, n_missing = 0 AS retained FROM m""",
    "heading_swings": f"""WITH {_T}, h AS (SELECT *, atan2(lead(y) OVER w - y, lead(x) OVER w - x) AS g FROM t WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
      g AS (SELECT user_id, us, event_id, coalesce(g, lag(g) OVER (PARTITION BY user_id ORDER BY us, event_id)) AS h FROM h),
      d AS (SELECT user_id, lead(h) OVER w - h AS a, lead(h, 3) OVER w - h AS b FROM g WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
      z AS (SELECT user_id, abs(degrees(atan2(sin(a), cos(a)))) AS a, abs(degrees(atan2(sin(b), cos(b)))) AS b FROM d)
      SELECT user_id, round(max(a), 5) AS worst, count(*) FILTER (round(a, 5) > 30) AS n_sharp, count(*) FILTER (round(b, 5) >= 140) AS n_turned FROM z GROUP BY 1""",
    "dwell_times": f"""WITH {_T}, w AS (SELECT *, CASE WHEN value > 100 THEN 5 ELSE 0 END AS q FROM t), b AS (SELECT *, x + coalesce(sum(q) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS m FROM w),
      e AS (SELECT user_id, m, false AS l FROM b UNION ALL SELECT user_id, m + q, true AS l FROM b WHERE q > 0)
      SELECT user_id, count(*) AS n, count(*) FILTER (l) AS n_waits, max(m) AS ends, sum(m) AS total FROM e GROUP BY 1""",
}
