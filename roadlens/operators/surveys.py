"""Survey operators: calibration surfaces, apportioned totals, version parity, swings and waits of tracks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def calibration_surface(rows: DataFrame, speed: str, pedal: str, value: str, before: str) -> DataFrame:
    """Mean, count and drift of each (speed, pedal) cell; drift is how far a speed ``before`` was from the cell's at most."""
    return rows.groupBy(speed, pedal).agg(F.avg(value).alias("mean"), F.count(value).alias("n"), F.max(F.abs(F.col(before) - F.col(speed))).alias("drift"))


def fill_nearest(cells: DataFrame, speed: str, pedal: str, value: str) -> DataFrame:
    """Add filled: a null value takes that of the nearest speed in its pedal's column, the lower one of two."""
    w = Window.partitionBy(pedal).orderBy(speed)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(speed).alias("s"), F.col(value).alias("v")))
    below = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    above = F.first(known, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    out = cells.withColumn("_b", below).withColumn("_a", above)
    lower = F.col("_a").isNull() | (F.col(speed) - F.col("_b.s") <= F.col("_a.s") - F.col(speed))
    return out.withColumn("filled", F.when(F.col("_b").isNotNull() & lower, F.col("_b.v")).otherwise(F.col("_a.v"))).drop("_b", "_a")


def monotone(cells: DataFrame, speed: str, pedal: str, value: str) -> DataFrame:
    """Add risen, the running maximum along the pedal, and repaired, whether that changed the value."""
    w = Window.partitionBy(speed).orderBy(pedal).rowsBetween(Window.unboundedPreceding, 0)
    return cells.withColumn("risen", F.max(value).over(w)).withColumn("repaired", F.col("risen") > F.col(value))


def apportion(rows: DataFrame, keys: list[str], order: list[str], weight: str, total: int) -> DataFrame:
    """Add share: a whole total split over whole weights of each key by largest remainders.

    Ties go by order. A weight of 0 gets 0; if all weights of a key are 0, nothing is dealt out.
    """
    all_ = Window.partitionBy(*keys)
    out = rows.withColumn("_sum", F.sum(weight).over(all_)).withColumn("_sum", F.when(F.col("_sum") > 0, F.col("_sum")))
    out = out.withColumn("_base", F.expr(f"coalesce({total} * `{weight}` div _sum, 0)")).withColumn("_rest", F.expr(f"coalesce({total} * `{weight}` % _sum, 0)"))
    out = out.withColumn("_left", F.when(F.col("_sum").isNotNull(), F.lit(total)).otherwise(0) - F.sum("_base").over(all_))
    out = out.withColumn("_rank", F.row_number().over(all_.orderBy(F.desc("_rest"), *order)))
    return out.withColumn("share", F.col("_base") + (F.col("_rank") <= F.col("_left")).cast("int")).drop("_sum", "_base", "_rest", "_left", "_rank")


def moving_columns(rows: DataFrame, keys: list[str], values: list[str], least: float = 1e-6) -> DataFrame:
    """Per key, how many columns have a standard deviation over ``least``."""
    spread = rows.groupBy(*keys).agg(*(F.stddev_pop(c).alias(c) for c in values))
    return spread.select(*keys, reduce(Column.__add__, [(F.coalesce(F.col(c), F.lit(0.0)) > least).cast("int") for c in values]).alias("n_moving"))


def parity(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows that differ between two versions of a table: key and fault (missing, extra or changed)."""
    side = lambda df: df.select(key, F.struct(*sorted(c for c in df.columns if c != key)).alias("v"))
    both = side(before).alias("b").join(side(after).alias("a"), key, "full_outer")
    fault = F.when(F.col("a.v").isNull(), "missing").when(F.col("b.v").isNull(), "extra").when(~F.col("a.v").eqNullSafe(F.col("b.v")), "changed")
    return both.select(key, fault.alias("fault")).filter("fault is not null")


def retained(members: DataFrame, selected: DataFrame, key: str, member: str) -> DataFrame:
    """Per key, whether all members are selected, and how many distinct ones are missing."""
    chosen = selected.select(member).distinct().withColumn("_in", F.lit(True))
    joined = members.select(key, member).distinct().join(chosen, member, "left")
    return joined.groupBy(key).agg(F.count_if(F.col("_in").isNull()).alias("n_missing")).withColumn("retained", F.col("n_missing") == 0)


def swings(rows: DataFrame, keys: list[str], order: list[str], heading: str, ahead: int) -> DataFrame:
    """Add swing: degrees between the heading and that of ``ahead`` samples later; null at the end."""
    d = F.lead(heading, ahead).over(Window.partitionBy(*keys).orderBy(*order)) - F.col(heading)
    return rows.withColumn("swing", F.abs(F.degrees(F.atan2(F.sin(d), F.cos(d)))))


def dwells(rows: DataFrame, keys: list[str], order: list[str], arrival: str, wait: str) -> DataFrame:
    """Each wait makes its sample two, arriving and leaving, and moves all later times; adds at and leaving."""
    before = F.coalesce(F.sum(wait).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = rows.withColumn("_at", F.col(arrival) + before)
    ends = F.when(F.col(wait) > 0, F.array(F.struct(F.col("_at").alias("at"), F.lit(False).alias("leaving")), F.struct((F.col("_at") + F.col(wait)).alias("at"), F.lit(True).alias("leaving"))))
    return out.select(*rows.columns, F.inline(F.coalesce(ends, F.array(F.struct(F.col("_at").alias("at"), F.lit(False).alias("leaving"))))))
