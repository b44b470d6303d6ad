"""Telemetry operators: gaps, rates, completeness, runs, stop-go cycles, as-of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def gaps(rows: DataFrame, keys: list[str], stamp_us: Column, ties: list[str], slot_us: int = 3_600_000_000) -> DataFrame:
    """Add gap_ms, the time since the message before in the same channel.

    A channel is cut into slots of time, so that a busy one is many windows; the first message of a slot
    takes its predecessor from a table with one row for each channel and slot.
    """
    dealt = rows.withColumn("_us", stamp_us).withColumn("_slot", F.floor(F.col("_us") / slot_us))
    w = Window.partitionBy(*keys, "_slot").orderBy("_us", *ties)
    ends = dealt.groupBy(*keys, "_slot").agg(F.max("_us").alias("_last"))
    ends = ends.withColumn("_before", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_slot"))).drop("_last")
    joined = dealt.withColumn("_own", F.lag("_us").over(w)).join(ends, [*keys, "_slot"])
    return joined.withColumn("gap_ms", (F.col("_us") - F.coalesce("_own", "_before")) / 1000.0).select(*rows.columns, "gap_ms")


def rates(rows: DataFrame, keys: list[str], stamp_us: Column) -> DataFrame:
    """Messages, span and rate of each channel; a single message is latched and has no rate."""
    out = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), ((F.max(stamp_us) - F.min(stamp_us)) / 1e6).alias("span_s"))
    return out.withColumn("hz", F.when((F.col("n") > 1) & (F.col("span_s") > 0), (F.col("n") - 1) / F.col("span_s")))


def latency(rows: DataFrame, keys: list[str], value: str, order: list[str], warm_up: int = 20) -> DataFrame:
    """Mean, median, p95, p99 and maximum, by linear interpolation, after the first warm-up rows."""
    kept = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_r") > warm_up)
    return kept.groupBy(*keys).agg(
        F.avg(value).alias("mean"), *(F.percentile(value, p).alias(n) for p, n in ((0.5, "median"), (0.95, "p95"), (0.99, "p99"))), F.max(value).alias("most")
    )


def completeness(rows: DataFrame, frame: list[str], topic: str, expected: list[str]) -> DataFrame:
    """For each frame the expected topics that it lacks, and whether a topic comes twice."""
    out = rows.groupBy(*frame).agg(F.collect_set(topic).alias("_t"), (F.count(F.lit(1)) > F.count_distinct(topic)).alias("repeated"))
    return out.withColumn("missing", F.sort_array(F.array_except(F.array(*map(F.lit, expected)), "_t"))).drop("_t")


def runs(rows: DataFrame, keys: list[str], order: list[str], flag: Column, least: int = 1, along: str | None = None, metres: float = 0.0) -> DataFrame:
    """Runs of at least so many flagged rows (gaps and islands): keys, run, n_rows.

    With ``along``, the running length, also length, and runs of under so many metres are left out.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = rows.withColumn("_f", F.coalesce(flag, F.lit(False))).withColumn("_r", F.row_number().over(w))
    marked = marked.withColumn("_i", F.col("_r") - F.row_number().over(Window.partitionBy(*keys, "_f").orderBy(*order))).filter("_f")
    length = [(F.max(along) - F.min(along)).alias("length")] if along else []
    out = marked.groupBy(*keys, "_i").agg(F.min("_r").alias("run"), F.count(F.lit(1)).alias("n_rows"), *length).drop("_i").filter(F.col("n_rows") >= least)
    return out.filter(F.col("length") >= metres) if along else out


def stop_go(rows: DataFrame, keys: list[str], order: list[str], speed: Column, stopped: float = 0.2, moving: float = 1.0) -> DataFrame:
    """Stops that were ended by moving again, for each key, with hysteresis between the two speeds."""
    w = Window.partitionBy(*keys).orderBy(*order)
    said = F.when(speed < stopped, "stop").when(speed > moving, "go")
    state = rows.withColumn("_s", F.last(said, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    turned = state.withColumn("_p", F.lag("_s").over(w)).withColumn("_stop", (F.col("_s") == "stop") & (F.col("_p") == "go"))
    stops = turned.withColumn("_n", F.sum(F.col("_stop").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    went = (F.col("_s") == "go") & (F.col("_p") == "stop") & (F.col("_n") > 0)
    return stops.groupBy(*keys).agg(F.count_if(went).alias("cycles"))


def as_of(left: DataFrame, right: DataFrame, keys: list[str], time: str, value: str, ties: list[str]) -> DataFrame:
    """Add the right value in force at each left row: the last with an equal or earlier time, else null."""
    a = left.withColumn("_v", F.lit(None).cast(right.schema[value].dataType)).withColumn("_side", F.lit(1))
    b = right.select(*keys, time, *ties, F.col(value).alias("_v")).withColumn("_side", F.lit(0))
    w = Window.partitionBy(*keys).orderBy(time, "_side", *ties).rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b, allowMissingColumns=True)
    return both.withColumn(f"{value}_as_of", F.last(F.when(F.col("_side") == 0, F.struct("_v"))["_v"], ignorenulls=True).over(w)).filter("_side = 1").drop("_v", "_side")


def latest(rows: DataFrame, keys: list[str], order: list[Column], cleared: Column | None = None) -> DataFrame:
    """The last row stated for each key; no row if that one is ``cleared``."""
    last = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")
    return last if cleared is None else last.filter(~F.coalesce(cleared, F.lit(False)))


def agreement(left: DataFrame, right: DataFrame, keys: list[str], value: str, tolerance: float) -> DataFrame:
    """Rows of two channels at one stamp: how many, largest difference, how many are out of tolerance; NaN apart."""
    both = left.select(*keys, F.col(value).alias("_a")).join(right.select(*keys, F.col(value).alias("_b")), keys)
    d = F.abs(F.col("_a") - F.col("_b"))
    return both.agg(F.count(F.lit(1)).alias("n"), F.max(F.when(~F.isnan(d), d)).alias("largest"), F.count_if(~F.isnan(d) & (d > tolerance)).alias("n_out"))
