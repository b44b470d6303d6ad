"""Queries on telemetry: gaps, rates, latency, completeness, runs, stop-go cycles, as-of values."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from roadlens.operators import telemetry
from roadlens.plans.tables import events

TOPICS = ["click", "error", "purchase", "signup", "view"]


def message_gaps(spark, sf_dir):
    """WN-01: gaps per channel, summed up."""
    g = telemetry.gaps(events(spark, sf_dir), ["event_type"], F.col("us"), ["event_id"])
    return g.groupBy("event_type").agg(F.count("gap_ms").alias("n_gaps"), F.round(F.max("gap_ms"), 3).alias("longest_ms"), F.round(F.sum("gap_ms"), 3).alias("total_ms"))


def channel_rates(spark, sf_dir):
    """AG-13."""
    r = telemetry.rates(events(spark, sf_dir), ["user_id", "event_type"], F.col("us"))
    return r.select("user_id", "event_type", "n", F.round("span_s", 6).alias("span_s"), F.round("hz", 9).alias("hz"))


def latency_percentiles(spark, sf_dir):
    """AG-12: without the first 20 rows of each topic."""
    r = telemetry.latency(events(spark, sf_dir), ["event_type"], "value", ["us", "event_id"])
    return r.select("event_type", *(F.round(c, 6).alias(c) for c in ("mean", "median", "p95", "p99", "most")))


def frame_completeness(spark, sf_dir):
    """AG-15: minutes as frames."""
    r = telemetry.completeness(events(spark, sf_dir).withColumn("frame", F.floor(F.col("us") / 60_000_000)), ["frame"], "event_type", TOPICS)
    return r.groupBy(F.size("missing").cast("long").alias("n_missing"), "repeated").agg(F.count(F.lit(1)).alias("n_frames"))


def flagged_runs(spark, sf_dir):
    """WN-12: runs of high values of a source."""
    r = telemetry.runs(events(spark, sf_dir), ["user_id"], ["us", "event_id"], F.col("value") > 100)
    return r.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_runs"), F.max("n_rows").alias("longest"))


def long_runs(spark, sf_dir):
    """WN-12: runs of two high values or more."""
    r = telemetry.runs(events(spark, sf_dir), ["user_id"], ["us", "event_id"], F.col("value") > 100, least=2)
    return r.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_runs"), F.max("n_rows").alias("longest"))


def tracked_runs(spark, sf_dir):
    """WN-12: runs of high values of at least 20 m, ten metres a sample."""
    at = F.row_number().over(Window.partitionBy("user_id").orderBy("us", "event_id")) * 10
    r = telemetry.runs(events(spark, sf_dir).withColumn("along", at), ["user_id"], ["us", "event_id"], F.col("value") > 60, along="along", metres=20)
    return r.select("user_id", "run", "n_rows", F.col("length").cast("long").alias("length"))


def stop_go_cycles(spark, sf_dir):
    """WN-14: speed is value / 100."""
    return telemetry.stop_go(events(spark, sf_dir), ["user_id"], ["us", "event_id"], F.col("value") / 100)


def as_of_value(spark, sf_dir):
    """JN-32: the last error value of a source at each of its purchases."""
    e = events(spark, sf_dir).select("event_id", "user_id", "us", "value", "event_type")
    left = e.filter("event_type = 'purchase'").select("event_id", "user_id", "us")
    right = e.filter("event_type = 'error'").select("event_id", "user_id", "us", "value")
    return telemetry.as_of(left, right, ["user_id"], "us", "value", ["event_id"]).select("event_id", "value_as_of")


def latest_statement(spark, sf_dir):
    """WN-18: the last event of each source and topic."""
    r = telemetry.latest(events(spark, sf_dir), ["user_id", "event_type"], [F.desc("us"), F.desc("event_id")])
    return r.select("user_id", "event_type", "event_id", "value")


def standing_statement(spark, sf_dir):
    """WN-18: the last event of each source, unless it is an error, which clears it."""
    r = telemetry.latest(events(spark, sf_dir), ["user_id"], [F.desc("us"), F.desc("event_id")], F.col("event_type") == "error")
    return r.select("user_id", "event_id", "event_type")


def channel_agreement(spark, sf_dir):
    """JN-29: two channels of a source compared by minute."""
    e = events(spark, sf_dir).withColumn("minute", F.floor(F.col("us") / 60_000_000))
    side = lambda t: e.filter(F.col("event_type") == t).groupBy("user_id", "minute").agg(F.max("value").alias("value"))
    return telemetry.agreement(side("click"), side("view"), ["user_id", "minute"], "value", 50.0)


QUERIES = {f.__name__: f for f in (message_gaps, channel_rates, latency_percentiles, frame_completeness, flagged_runs, long_runs, tracked_runs, stop_go_cycles, as_of_value, latest_statement, standing_statement, channel_agreement)}

_E = "e AS (SELECT *, epoch_us(ts) AS us FROM events)"
SQL = {
    "message_gaps": f"WITH {_E}, g AS (SELECT event_type, (us - lag(us) OVER (PARTITION BY event_type ORDER BY us, event_id)) / 1000.0 AS g FROM e) SELECT event_type, count(g) AS n_gaps, round(max(g), 3) AS longest_ms, round(sum(g), 3) AS total_ms FROM g GROUP BY 1",
    "channel_rates": f"WITH {_E}, r AS (SELECT user_id, event_type, count(*) AS n, (max(us) - min(us)) / 1e6 AS s FROM e GROUP BY ALL) SELECT user_id, event_type, n, round(s, 6) AS span_s, round(CASE WHEN n > 1 AND s > 0 THEN (n - 1) / s END, 9) AS hz FROM r",
    "latency_percentiles": f"""WITH {_E}, r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY us, event_id) AS r FROM e)
      SELECT event_type, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99, round(max(value), 6) AS most FROM r WHERE r > 20 GROUP BY 1""",
    "frame_completeness": f"""WITH {_E}, f AS (SELECT us // 60000000 AS frame, 5 - count(DISTINCT event_type) FILTER (event_type IN ('click', 'error', 'purchase', 'signup', 'view')) AS n_missing, count(*) > count(DISTINCT event_type) AS repeated FROM e GROUP BY 1)
      SELECT n_missing, repeated, count(*) AS n_frames FROM f GROUP BY ALL""",
    "flagged_runs": f"""WITH {_E}, r AS (SELECT user_id, value > 100 AS f, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) - row_number() OVER (PARTITION BY user_id, value > 100 ORDER BY us, event_id) AS i FROM e),
      g AS (SELECT user_id, i, count(*) AS n FROM r WHERE f GROUP BY ALL) SELECT user_id, count(*) AS n_runs, max(n) AS longest FROM g GROUP BY 1""",
    "long_runs": f"""WITH {_E}, r AS (SELECT user_id, value > 100 AS f, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) - row_number() OVER (PARTITION BY user_id, value > 100 ORDER BY us, event_id) AS i FROM e),
      g AS (SELECT user_id, i, count(*) AS n FROM r WHERE f GROUP BY ALL HAVING count(*) >= 2) SELECT user_id, count(*) AS n_runs, max(n) AS longest FROM g GROUP BY 1""",
    "tracked_runs": f"""WITH {_E}, r AS (SELECT user_id, value > 60 AS f, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS r, row_number() OVER (PARTITION BY user_id, value > 60 ORDER BY us, event_id) AS q FROM e)
      SELECT user_id, min(r) AS run, count(*) AS n_rows, 10 * (max(r) - min(r)) AS length FROM r WHERE f GROUP BY user_id, r - q HAVING 10 * (max(r) - min(r)) >= 20""",
    "stop_go_cycles": f"""WITH {_E}, s AS (SELECT user_id, us, event_id, last_value(CASE WHEN value / 100 < 0.2 THEN 'stop' WHEN value / 100 > 1.0 THEN 'go' END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY us, event_id) AS s FROM e),
      p AS (SELECT *, lag(s) OVER (PARTITION BY user_id ORDER BY us, event_id) AS p FROM s),
      n AS (SELECT *, count(*) FILTER (s = 'stop' AND p = 'go') OVER (PARTITION BY user_id ORDER BY us, event_id) AS n FROM p) SELECT user_id, count(*) FILTER (s = 'go' AND p = 'stop' AND n > 0) AS cycles FROM n GROUP BY 1""",
    "as_of_value": f"""WITH {_E}, l AS (SELECT event_id, user_id, us FROM e WHERE event_type = 'purchase'), r AS (SELECT user_id, us, max_by(value, event_id) AS value FROM e WHERE event_type = 'error' GROUP BY ALL)
      SELECT l.event_id, r.value AS value_as_of FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.us >= r.us""",
    "latest_statement": f"WITH {_E} SELECT user_id, event_type, event_id, value FROM e QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY us DESC, event_id DESC) = 1",
    "standing_statement": f"""WITH {_E}, r AS (SELECT user_id, event_id, event_type FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY us DESC, event_id DESC) = 1)
      SELECT * FROM r WHERE event_type IS DISTINCT FROM 'error'""",
    "channel_agreement": f"""WITH {_E}, m AS (SELECT user_id, us // 60000000 AS m, event_type AS t, max(value) AS v FROM e WHERE event_type IN ('click', 'view') GROUP BY ALL)
      SELECT count(*) AS n, max(abs(a.v - b.v)) AS largest, count(*) FILTER (abs(a.v - b.v) > 50) AS n_out FROM m a JOIN m b ON a.user_id = b.user_id AND a.m = b.m AND a.t = 'click' AND b.t = 'view'""",
}
