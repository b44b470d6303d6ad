"""Rules of lines and steps that take one row each."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def movement_side(tag: Column, family: Column, angle: Column, driving: Column, least: float = 10.0) -> Column:
    """nearside or offside of traffic that drives on the ``driving`` side (left or right); null for straight on.

    The turn is what a tag says that names exactly one of both, else the family, else the sign of a large enough angle.
    """
    left, right = F.coalesce(F.contains(tag, F.lit("left")), F.lit(False)), F.coalesce(F.contains(tag, F.lit("right")), F.lit(False))
    turn = (
        F.when(left & ~right, "left").when(right & ~left, "right").when(family.isin("left", "right"), family)
        .when(F.abs(angle) >= least, F.when(angle > 0, "left").otherwise("right"))
    )
    return F.when(turn == driving, "nearside").when(turn != driving, "offside")


def is_signal_node(tags: Column, key: str = "highway") -> Column:
    """Whether a node's tags say traffic_signals."""
    return F.coalesce(F.try_element_at(tags, F.lit(key)) == "traffic_signals", F.lit(False))


def step_s(spacing: Column, planned: Column) -> Column:
    """The recorded step: the spacing of the first two stamps, else the plan's, else 0.1 s."""
    return F.coalesce(spacing, planned, F.lit(0.1))


def is_stub(length: Column, least: Column) -> Column:
    """Whether a lane was clamped: no longer than the least trimmed length and a centimetre."""
    return length <= least + 0.01


def count_from_density(per_km: Column, metres: Column) -> Column:
    """Cars on a stretch: at least one, none at density 0."""
    return F.when(per_km > 0, F.greatest(F.lit(1), F.round(per_km * metres / 1000).cast("long"))).otherwise(0)


def arrival_s(metres: Column, speed: Column) -> Column:
    """Distance over speed; null where the speed is unknown or 0."""
    return F.when(speed > 0, metres / speed)
