"""Turn restrictions that lead through ways: which step of the chain can go, and what is held for review."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

ENFORCED, REVIEW = "enforced", "review_required"


def via_way_chains(restrictions: DataFrame, moves: DataFrame, adjacency: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """restrictions (relation, kind, froms, vias, tos: arrays of ways) over moves (move, from_way, to_way, node).

    Returns decisions (relation, status, reason, ways) and the moves that they touch (relation, move, action: remove
    or hold). The ways from, via … to are a chain; each step of it needs moves, all at one node. A move knows
    nothing of the route around it, so removing a step of a no_… chain is exact only if nothing else feeds the via
    ways up to it and the via ways after it lead nowhere else. Of exact steps the last is removed; if it
    isn't the chain's last, ways are those that would have lost a move. If no step is exact the last is held
    and ways are all that stand in the way. only_… removes the other exits at the chain's last node.

    Reasons: suffix_removed, prefix_removed, exit_kept; for review incomplete (not one from, one to and a via),
    missing, branching (the first step that is at fault counts), blocked, unsupported. adjacency (from_way, to_way)
    are further links of ways, such as continuations. A way doesn't feed itself. relation is unique.
    """
    one = F.coalesce((F.size("froms") == 1) & (F.size("tos") == 1) & (F.size("vias") > 0), F.lit(False))
    asked = restrictions.select("relation", "kind", F.when(one, F.concat("froms", "vias", "tos")).alias("chain")).distinct()
    asked = asked.withColumn("last", F.size("chain") - 2)
    pair = F.transform(F.sequence(F.lit(0), F.col("last")), lambda i: F.struct(F.get("chain", i).alias("src"), F.get("chain", i + 1).alias("dst")))
    steps = asked.filter("chain is not null").select("relation", "last", F.posexplode(pair).alias("leg", "p")).select("relation", "last", "leg", "p.src", "p.dst")
    spots = moves.groupBy(F.col("from_way").alias("src"), F.col("to_way").alias("dst")).agg(F.min("node").alias("node"), F.max("node").alias("far"))
    found = steps.join(spots, ["src", "dst"], "left")
    fault = F.when(F.col("node").isNull(), "missing").when(F.col("node") != F.col("far"), "branching")
    walked = found.groupBy("relation").agg(F.min(F.when(fault.isNotNull(), F.struct("leg", fault.alias("fault")))).alias("first"), F.max_by("node", "leg").alias("end"))

    links = moves.select("from_way", "to_way")
    links = (links.unionByName(adjacency.select("from_way", "to_way")) if adjacency is not None else links).filter("from_way <> to_way").distinct()
    into = steps.filter("leg < last").join(links, F.col("to_way") == F.col("dst")).filter("from_way <> src").groupBy("relation")
    into = into.agg(F.min("leg").alias("fed"), F.collect_set("from_way").alias("feeders"))  # step fed + 1 and later aren't exact
    away = steps.filter("leg > 0").join(links, F.col("from_way") == F.col("src")).filter("to_way <> dst").groupBy("relation")
    away = away.agg(F.max("leg").alias("left"), F.collect_set("to_way").alias("leavers"))  # steps before left aren't exact
    both = asked.join(walked, "relation", "left").join(into, "relation", "left").join(away, "relation", "left")
    exact = F.coalesce("fed", "last")
    sound, none = F.col("chain").isNotNull() & F.col("first").isNull(), F.array().cast(dict(asked.dtypes)["chain"])
    bars, only = F.coalesce(F.col("kind").startswith("no_"), F.lit(False)), F.coalesce(F.col("kind").startswith("only_"), F.lit(False))
    reason = (
        F.when(F.col("chain").isNull(), "incomplete").when(F.col("first").isNotNull(), F.col("first.fault")).when(only, "exit_kept").when(~bars, "unsupported")
        .when(F.coalesce("left", F.lit(0)) > exact, "blocked").when(exact < F.col("last"), "prefix_removed").otherwise("suffix_removed")
    )
    judged = both.withColumn("reason", reason).withColumn("status", F.when(F.col("reason").isin("suffix_removed", "prefix_removed", "exit_kept"), ENFORCED).otherwise(REVIEW))
    feeders, leavers = F.coalesce("feeders", none), F.coalesce("leavers", none)
    ways = F.when(F.col("reason") == "blocked", F.array_union(feeders, leavers)).when(F.col("reason") == "prefix_removed", feeders).otherwise(none)
    decisions = judged.select("relation", "status", "reason", F.sort_array(ways).alias("ways"))

    acts = judged.filter(sound & (bars | only)).select("relation", "reason", "end", F.when(F.col("reason") == "prefix_removed", exact).otherwise(F.col("last")).alias("leg"))
    step = acts.join(steps.select("relation", "leg", "src", "dst"), ["relation", "leg"])
    hit = step.join(moves, F.col("src") == F.col("from_way"))
    kept = F.when(F.col("reason") == "exit_kept", (F.col("node") == F.col("end")) & (F.col("to_way") != F.col("dst"))).otherwise(F.col("to_way") == F.col("dst"))
    return decisions, hit.filter(kept).select("relation", "move", F.when(F.col("reason") == "blocked", "hold").otherwise("remove").alias("action")).distinct()
