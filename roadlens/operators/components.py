"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadlens.session import discard, materialize

MAX_ROUNDS = 60


def _large_star(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Every larger neighbour of u is linked to the least of u and its neighbours."""
    both = edges.unionByName(edges.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(*keys, "a").agg(F.min("b").alias("least"))
    return (
        both.filter("b > a")
        .join(least, [*keys, "a"])
        .select(*keys, F.col("b").alias("a"), F.least("least", "a").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Every smaller neighbour of u, and u, is linked to the least smaller neighbour of u."""
    down = edges.select(*keys, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(*keys, "a").agg(F.min("b").alias("least"))
    moved = down.join(least, [*keys, "a"]).filter("b <> least").select(*keys, F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select(*keys, "a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame, keys: tuple[str, ...] = (), name: str = "components") -> DataFrame:
    """Edges (keys…, a, b) to (keys…, id, component): component is the least id that can be reached.

    Vertices that have no edge to another vertex are not in the result. Self edges and rows with a
    null end are ignored. Each round is written to the shared folder, so lineage stays short; a
    vertex with very many edges is aggregated before the shuffle and its join can be split.
    """
    keys = list(keys)
    now = edges.select(*keys, "a", "b").filter("a <> b").distinct()
    for _ in range(MAX_ROUNDS):
        stars = materialize(_small_star(_large_star(now, keys), keys), name)
        discard(now)
        now = stars
        ends = now.select(*keys, F.col("a").alias("id"), F.lit(1).alias("below")).unionByName(now.select(*keys, F.col("b").alias("id"), F.lit(0).alias("below")))
        open_ = ends.groupBy(*keys, "id").agg(F.sum("below").alias("up"), F.min("below").alias("leaf")).filter("up > 1 or (up = 1 and leaf = 0)")
        if open_.isEmpty():  # every vertex has one edge, to a vertex that has none upwards
            break
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    roots = now.select(*keys, F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(*keys, F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
