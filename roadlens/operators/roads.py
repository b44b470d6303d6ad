"""Road-network operators: ways with ordered nodes, directed pairs, components, readiness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlens.operators.components import components
from roadlens.session import materialize


def ordered_nodes(rows: DataFrame, way: str, node: str, order: list[str]) -> DataFrame:
    """Rows of (way, node, order) with pos from 0 and the number of nodes of the way."""
    w = Window.partitionBy(way)
    return rows.withColumn("pos", F.row_number().over(w.orderBy(*order, node)) - 1).withColumn("n_nodes", F.count(F.lit(1)).over(w))


def directed_pairs(nodes: DataFrame, way: str, node: str, oneway: Column | None = None, reverse: Column | None = None) -> DataFrame:
    """Travel directions (way, u, v) between successive nodes: both ways unless one-way; turned if reversed."""
    own = nodes.withColumn("v", F.lead(node).over(Window.partitionBy(way).orderBy("pos"))).filter("v is not null")
    one = F.coalesce(oneway, F.lit(False)) if oneway is not None else F.lit(False)
    back = F.coalesce(reverse, F.lit(False)) if reverse is not None else F.lit(False)
    forward, turned = F.struct(F.col(node).alias("u"), F.col("v").alias("v")), F.struct(F.col("v").alias("u"), F.col(node).alias("v"))
    ways = F.when(one & back, F.array(turned)).when(one, F.array(forward)).otherwise(F.array(forward, turned))
    return own.select(way, F.explode(ways).alias("d")).select(way, "d.u", "d.v").distinct()


def terminus_nodes(nodes: DataFrame, node: str) -> DataFrame:
    """Nodes that are first or last in every way that holds them."""
    return nodes.groupBy(node).agg(F.bool_and((F.col("pos") == 0) | (F.col("pos") == F.col("n_nodes") - 1)).alias("t")).filter("t").select(node)


def edges_of_selected(edges: DataFrame, selected: DataFrame, ways: str, way: str) -> tuple[DataFrame, DataFrame]:
    """Edges with any way in ``selected``, and the rest; an edge is named by all its columns."""
    hit = edges.withColumn("_id", F.struct(*edges.columns)).withColumn("_w", F.explode(ways)).join(selected.select(F.col(way).alias("_w")), "_w", "left_semi").select("_id").distinct()
    named = edges.withColumn("_id", F.struct(*edges.columns))
    return named.join(hit, "_id", "left_semi").drop("_id"), named.join(hit, "_id", "left_anti").drop("_id")


def way_adjacency(moves: DataFrame, source: str, target: str) -> DataFrame:
    """For each way the ways that it feeds and that feed it, without itself."""
    moves = moves.filter(F.col(source) != F.col(target)).select(F.col(source).alias("a"), F.col(target).alias("b")).distinct()
    out = moves.groupBy(F.col("a").alias("way")).agg(F.sort_array(F.collect_set("b")).alias("feeds"))
    into = moves.groupBy(F.col("b").alias("way")).agg(F.sort_array(F.collect_set("a")).alias("fed_by"))
    return out.join(into, "way", "full_outer")


def weak_components(pairs: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys…, id, component) of directed pairs (u, v), directions ignored."""
    return components(pairs.select(*keys, F.col("u").alias("a"), F.col("v").alias("b")), keys, "weak")


def component_summary(pairs: DataFrame, way: str, highways: DataFrame | None = None) -> DataFrame:
    """Nodes, edges and ways per weak component, numbered from 1 by size, then least node.

    With highways (way, highway) also how many ways of each highway, sorted by name; ways without one
    are '<missing>', ways without a row are left out. Numbering sorts the components in one task.
    """
    pairs = materialize(pairs.select("u", "v", way), "summary-pairs")
    comp = weak_components(pairs)
    sizes = comp.groupBy("component").agg(F.count(F.lit(1)).alias("n_nodes"))
    edges = pairs.join(comp.withColumnRenamed("id", "u"), "u").groupBy("component").agg(F.count(F.lit(1)).alias("n_edges"), F.count_distinct(way).alias("n_ways"))
    out = sizes.join(edges, "component").withColumn("number", F.row_number().over(Window.orderBy(F.desc("n_nodes"), "component")))
    if highways is None:
        return out
    ways = pairs.join(comp.withColumnRenamed("id", "u"), "u").select("component", way).distinct()
    named = highways.select(way, F.coalesce("highway", F.lit("<missing>")).alias("highway")).dropDuplicates([way])
    counts = ways.join(named, way).groupBy("component", "highway").agg(F.count(F.lit(1)).alias("n"))
    return out.join(counts.groupBy("component").agg(F.sort_array(F.collect_list(F.struct("highway", "n"))).alias("highways")), "component", "left")


def readiness(errors: Column, missing: Column) -> Column:
    """blocked with errors, review_required with missing tags, else ready."""
    return F.when(errors > 0, "blocked").when(missing > 0, "review_required").otherwise("ready")


def flood(pairs: DataFrame, sources: DataFrame, upstream: bool = False, limit: int = 10_000) -> DataFrame:
    """(id, hops) that can be reached from sources (id) along u -> v, or against it."""
    a, b = ("v", "u") if upstream else ("u", "v")
    edges = pairs.select(F.col(a).alias("id"), F.col(b).alias("to")).distinct()
    edges = materialize(edges, "flood-edges")
    front = materialize(sources.select("id").distinct().withColumn("hops", F.lit(0)), "flood-front")
    # Each hop is one table; tables of as many hops are put together now and then, so that what has been
    # seen is written a few times and not once a hop.
    seen = [front]
    for hop in range(1, limit):
        known = reduce(DataFrame.unionByName, seen)
        reached = front.join(edges, "id").select(F.col("to").alias("id")).distinct().join(known, "id", "left_anti")
        front = materialize(reached.withColumn("hops", F.lit(hop)), "flood-front")
        if front.isEmpty():
            return known
        seen.append(front)
        if len(seen) > 24:
            seen = [materialize(reduce(DataFrame.unionByName, seen), "flood")]
    raise RuntimeError(f"no end after {limit} hops")
