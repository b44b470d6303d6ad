"""Streaming telemetry: rates, sessions, duplicates, incomplete frames. Rows later than the watermark are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def channel_rates(rows: DataFrame, stamp: str, keys: list[str], width: str = "10 seconds", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Messages of each channel in tumbling or sliding windows."""
    return rows.withWatermark(stamp, late).groupBy(F.window(stamp, width, slide), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def sessions(rows: DataFrame, stamp: str, keys: list[str], gap: str, late: str = "10 minutes") -> DataFrame:
    """Stretches of messages of a channel; a gap closes one."""
    s = F.session_window(stamp, gap)
    return rows.withWatermark(stamp, late).groupBy(s, *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *keys, "n")


def without_repeats(rows: DataFrame, stamp: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """The first row of each key within the watermark."""
    return rows.withWatermark(stamp, late).dropDuplicatesWithinWatermark(keys)


def incomplete_frames(rows: DataFrame, stamp: str, topic: str, expected: list[str], width: str, late: str = "10 minutes") -> DataFrame:
    """Windows that lack an expected topic once the watermark has passed them."""
    seen = rows.withWatermark(stamp, late).groupBy(F.window(stamp, width)).agg(F.collect_set(topic).alias("seen"))
    missing = F.array_except(F.array(*map(F.lit, expected)), F.col("seen"))
    return seen.select(F.col("window.start").alias("start"), F.sort_array(missing).alias("missing")).filter(F.size("missing") > 0)


def decimated(rows: DataFrame, step: str, every: int) -> DataFrame:
    """Every k-th step."""
    return rows.filter(F.col(step) % every == 0)
