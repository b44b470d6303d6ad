"""Registered queries of the library on the driver's tables.

Ways are orders with their lineitems as ordered nodes (l_partkey), nodes are parts, telemetry is
events (event_type a topic, user_id a source). Each query runs over whole tables.
"""

from __future__ import annotations

from roadlens.plans import gates, graph, lanes, paths, review, roads, spatial, surveys, telemetry, tracks


def queries() -> dict:
    return roads.QUERIES | telemetry.QUERIES | tracks.QUERIES | review.QUERIES | graph.QUERIES | surveys.QUERIES | lanes.QUERIES | gates.QUERIES | spatial.QUERIES | paths.QUERIES


def oracle_sql() -> dict[str, str]:
    return roads.SQL | telemetry.SQL | tracks.SQL | review.SQL | graph.SQL | surveys.SQL | lanes.SQL | gates.SQL | spatial.SQL | paths.SQL
