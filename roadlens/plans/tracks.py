"""Queries on tracks: a source's events in order are samples; value is y, the position in the order is x."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from roadlens.operators import tracks
from roadlens.plans.tables import events

KEYS, ORDER = ["user_id"], ["us", "event_id"]


def _track(spark, sf_dir):
    e = events(spark, sf_dir).select("user_id", "us", "event_id", "value")
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("us", "event_id"))
    return e.withColumn("x", (n * 10).cast("double")).withColumn("y", F.col("value"))


def track_length(spark, sf_dir):
    """WN-02."""
    t = tracks.travelled(_track(spark, sf_dir), KEYS, ORDER)
    return t.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("along"), 4).alias("metres"))


def track_headings(spark, sf_dir):
    """WN-03."""
    return tracks.headings(_track(spark, sf_dir), KEYS, ORDER).select("event_id", F.round("heading", 8).alias("heading"))


def speed_profile(spark, sf_dir):
    """WN-05, WN-06: speed held by acceleration and braking, and arrival times."""
    t = tracks.travelled(_track(spark, sf_dir), KEYS, ORDER).withColumn("cap", F.lit(3.0) + F.pmod(F.col("value"), F.lit(12.0)))
    t = tracks.bounded_speed(t, KEYS, ORDER, "along", "cap", 1.5, 2.0)
    t = tracks.arrivals(t, KEYS, ORDER, "along", "speed")
    return t.groupBy("user_id").agg(F.round(F.min("speed"), 4).alias("slowest"), F.round(F.max("speed"), 4).alias("fastest"), F.round(F.max("arrival"), 2).alias("seconds"))


def turn_radius(spark, sf_dir):
    """WN-11: the tightest bend of each track."""
    return tracks.circumradius(_track(spark, sf_dir), KEYS, ORDER).groupBy("user_id").agg(F.round(F.min("radius"), 5).alias("tightest"))


def pooled_speeds(spark, sf_dir):
    """AG-25: the least value in each 500 m of a track."""
    t = tracks.travelled(_track(spark, sf_dir), KEYS, ORDER)
    return tracks.min_pool(t.withColumn("along", F.round("along", 6)), KEYS, "along", "value", 500.0)


def resampled(spark, sf_dir):
    """WN-08: values on an even grid along each track."""
    r = tracks.resample(_track(spark, sf_dir), KEYS, ORDER, "x", "y", 25.0)
    return r.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("y"), 4).alias("total"))


QUERIES = {f.__name__: f for f in (track_length, track_headings, speed_profile, turn_radius, pooled_speeds, resampled)}

_T = """t AS (SELECT user_id, epoch_us(ts) AS us, event_id, value AS y, value, CAST(10 * row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS DOUBLE) AS x FROM events),
s AS (SELECT *, coalesce(sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2), 0) AS step FROM t WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
a AS (SELECT *, sum(step) OVER (PARTITION BY user_id ORDER BY us, event_id) AS along FROM s)"""
SQL = {
    "track_length": f"WITH {_T} SELECT user_id, count(*) AS n, round(max(along), 4) AS metres FROM a GROUP BY 1",
    "track_headings": f"""WITH {_T}, h AS (SELECT *, atan2(lead(y) OVER w - y, lead(x) OVER w - x) AS h FROM t WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
      SELECT event_id, round(coalesce(h, lag(h) OVER (PARTITION BY user_id ORDER BY us, event_id)), 8) AS heading FROM h""",
    "speed_profile": f"""WITH {_T}, c AS (SELECT *, 3 + value % 12 AS cap FROM a),
      f AS (SELECT *, min(cap * cap - 3 * along) OVER (PARTITION BY user_id ORDER BY us, event_id) + 3 * along AS f FROM c),
      v AS (SELECT *, sqrt(greatest(0, min(f + 4 * along) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - 4 * along)) AS v FROM f),
      d AS (SELECT *, coalesce((along - lag(along) OVER w) / ((v + lag(v) OVER w) / 2), 0) AS d FROM v WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
      SELECT user_id, round(min(v), 4) AS slowest, round(max(v), 4) AS fastest, round(sum(d), 2) AS seconds FROM d GROUP BY 1""",
    "turn_radius": f"""WITH {_T}, n AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM t WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
      r AS (SELECT user_id, abs((x - px) * (ny - py) - (nx - px) * (y - py)) AS a2, sqrt((px - x) ** 2 + (py - y) ** 2) * sqrt((x - nx) ** 2 + (y - ny) ** 2) * sqrt((px - nx) ** 2 + (py - ny) ** 2) AS p FROM n)
      SELECT user_id, round(min(CASE WHEN a2 > 1e-12 THEN p / (2 * a2) END), 5) AS tightest FROM r GROUP BY 1""",
    "pooled_speeds": f"WITH {_T} SELECT user_id, CAST(floor(round(along, 6) / 500) AS BIGINT) AS pool, min(value) AS least FROM a GROUP BY ALL",
    "resampled": f"""WITH {_T}, e AS (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM t WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
      g AS (SELECT *, unnest(range(CAST(ceil(x / 25) AS BIGINT), CAST(floor(nx / 25) AS BIGINT) + 1)) AS k, max(x) OVER (PARTITION BY user_id) AS last FROM e WHERE nx > x QUALIFY true), q AS (SELECT user_id, max(x) AS top FROM t GROUP BY 1), z AS (SELECT g.* FROM g JOIN q USING (user_id) WHERE k * 25 < nx OR nx = top)
      SELECT user_id, count(*) AS n, round(sum(y + (k * 25 - x) / (nx - x) * (ny - y)), 4) AS total FROM z GROUP BY 1""",
}
