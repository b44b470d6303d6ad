"""Lane-model operators: links, changes, connector and restriction checks, movements, dead ends, check registry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def lane_links(exits: DataFrame, lanes: DataFrame, connectors: DataFrame) -> DataFrame:
    """exits (lane, ref) to distinct (lane, target, fault).

    A ref is a lane, or a connector (connector, to_lane, status), which stands for the lane beyond it.
    Connectors that aren't active lead nowhere; a ref that is neither has the fault 'unknown'.
    """
    known = lanes.select(F.col("lane").alias("ref"), F.col("lane").alias("own")).distinct()
    beyond = connectors.select(F.col("connector").alias("ref"), "to_lane", "status")
    both = exits.join(known, "ref", "left").join(beyond, "ref", "left")
    target = F.coalesce("own", F.when(F.col("status") == "active", F.col("to_lane")))
    fault = F.when(F.col("own").isNull() & F.col("status").isNull(), "unknown")
    return both.select("lane", target.alias("target"), fault.alias("fault")).filter("target is not null or fault is not null").distinct()


def lane_changes(lanes: DataFrame) -> DataFrame:
    """lanes (lane, way, direction, left, right) to sideways moves (lane, target, side): same way and direction only."""
    sides = F.array(F.struct(F.lit("left").alias("side"), F.col("left").alias("target")), F.struct(F.lit("right").alias("side"), F.col("right").alias("target")))
    asked = lanes.select("lane", "way", "direction", F.inline(sides)).filter("target is not null")
    return asked.join(lanes.select(F.col("lane").alias("target"), "way", "direction"), ["target", "way", "direction"]).select("lane", "target", "side")


def connector_faults(connectors: DataFrame, lanes: DataFrame, listed: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """(connector, fault): unlisted, unknown_lane, gap, listed_inactive.

    connectors (connector, from_lane, to_lane, status, start_x, start_y, end_x, end_y), lanes (lane,
    start_x, start_y, end_x, end_y), listed (connector).
    """
    at = lambda side, p: lanes.select(F.col("lane").alias(f"{side}_lane"), F.lit(True).alias(f"{side}_there"), F.col(f"{p}_x").alias(f"{side}_x"), F.col(f"{p}_y").alias(f"{side}_y"))
    both = connectors.join(at("from", "end"), "from_lane", "left").join(at("to", "start"), "to_lane", "left")
    both = both.join(listed.select("connector", F.lit(True).alias("listed")).distinct(), "connector", "left")
    far = lambda x, y, s: F.sqrt(F.pow(F.col(x) - F.col(f"{s}_x"), 2) + F.pow(F.col(y) - F.col(f"{s}_y"), 2)) > tolerance
    active, there = F.col("status") == "active", F.col("from_there").isNotNull() & F.col("to_there").isNotNull()
    faults = {
        "unlisted": active & F.col("listed").isNull(), "listed_inactive": ~active & F.col("listed").isNotNull(), "unknown_lane": active & ~there,
        "gap": active & there & (far("start_x", "start_y", "from") | far("end_x", "end_y", "to")),
    }
    return both.select("connector", F.explode(F.array_compact(F.array(*[F.when(c, n) for n, c in faults.items()]))).alias("fault"))


def restriction_faults(forbidden: DataFrame, connectors: DataFrame, listed: DataFrame) -> DataFrame:
    """forbidden (connector) to (connector, fault): missing, not_forbidden or listed."""
    there = connectors.select("connector", F.col("status").alias("_s"))
    both = forbidden.select("connector").distinct().join(there, "connector", "left").join(listed.select("connector", F.lit(True).alias("_l")).distinct(), "connector", "left")
    fault = F.when(F.col("_s").isNull(), "missing").when(F.col("_s") != "forbidden", "not_forbidden").when(F.col("_l").isNotNull(), "listed")
    return both.select("connector", fault.alias("fault")).filter("fault is not null")


def control_faults(controls: DataFrame, lanes: DataFrame) -> DataFrame:
    """Signals or stop lines (control, status, lanes array) to (control, fault): mapped without lanes, or with an unknown lane."""
    named = controls.select("control", F.explode("lanes").alias("lane")).join(lanes.select("lane"), "lane", "left_anti").select("control").distinct().withColumn("fault", F.lit("unknown_lane"))
    empty = controls.filter((F.col("status") == "mapped") & (F.coalesce(F.size("lanes"), F.lit(0)) <= 0)).select("control", F.lit("no_lanes").alias("fault"))
    return named.unionByName(empty)


def forbidden_movements(movements: DataFrame, restrictions: DataFrame) -> DataFrame:
    """Movements (frm, node, to) that restrictions (frm, node, to, kind) forbid.

    no_… forbids the same movement, only_… all others from that way at that node.
    """
    moves = movements.select("frm", "node", "to").distinct()
    rules = restrictions.select("frm", "node", F.col("to").alias("_to"), F.col("kind").startswith("only_").alias("_only")).distinct()
    hit = moves.join(rules, ["frm", "node"]).filter((F.col("_only") & (F.col("to") != F.col("_to"))) | (~F.col("_only") & (F.col("to") == F.col("_to"))))
    return hit.select("frm", "node", "to").distinct()


def signal_lanes(signals: DataFrame, lanes: DataFrame, termini: DataFrame) -> DataFrame:
    """signals (node) to (node, lanes, severity) over lanes (lane, u, v).

    Lanes that end at the node; else, where the node is a terminus of every way, those that start there
    (warning); else none (blocker).
    """
    ends = lanes.groupBy(F.col("v").alias("node")).agg(F.sort_array(F.collect_set("lane")).alias("_in"))
    starts = lanes.groupBy(F.col("u").alias("node")).agg(F.sort_array(F.collect_set("lane")).alias("_out"))
    both = signals.select("node").distinct().join(ends, "node", "left").join(starts, "node", "left").join(termini.select("node", F.lit(True).alias("_end")), "node", "left")
    out = F.when(F.col("_end").isNotNull(), F.col("_out"))
    severity = F.when(F.col("_in").isNotNull(), "ok").when(out.isNotNull(), "warning").otherwise("blocker")
    return both.select("node", F.coalesce("_in", out, F.array().cast("array<bigint>")).alias("lanes"), severity.alias("severity"))


def movement_candidates(lanes: DataFrame) -> DataFrame:
    """lanes (lane, way, u, v) to (node, lane, to_way, kind): each lane that comes in with each way that goes out.

    At a node of three ways or more a movement is a connector, elsewhere a continuation; back into its own
    way a lane doesn't go.
    """
    ends = lanes.select("way", F.explode(F.array("u", "v")).alias("node")).distinct().groupBy("node").agg(F.count(F.lit(1)).alias("_ways"))
    out = lanes.select(F.col("u").alias("node"), F.col("way").alias("to_way")).distinct()
    moves = lanes.select("lane", "way", F.col("v").alias("node")).join(out, "node").filter("way <> to_way").join(ends, "node")
    return moves.select("node", "lane", "to_way", F.when(F.col("_ways") >= 3, "connector").otherwise("continuation").alias("kind"))


def with_dispositions(issues: DataFrame, dispositions: DataFrame, key: str) -> DataFrame:
    """Issues (key, severity): one judged not_applicable (key, finding, status) is a warning that names the finding."""
    judged = dispositions.filter(F.col("status") == "not_applicable").groupBy(key).agg(F.min("finding").alias("finding"))
    out = issues.join(judged, key, "left")
    return out.withColumn("severity", F.when(F.col("finding").isNotNull(), "warning").otherwise(F.col("severity")))


def road_class(features: DataFrame, classes: DataFrame) -> DataFrame:
    """features (feature, affected, sources arrays) to (feature, road_class): the first id that has a class (id, road_class)."""
    ids = F.concat(F.coalesce("affected", F.array().cast("array<bigint>")), F.coalesce("sources", F.array().cast("array<bigint>")))
    found = features.select("feature", F.posexplode(ids).alias("pos", "id")).join(classes, "id")
    return features.select("feature").join(found.groupBy("feature").agg(F.min_by("road_class", "pos").alias("road_class")), "feature", "left")


def starved(moves: DataFrame) -> DataFrame:
    """moves (node, approach, dest, lane, target) to transitions in which more lanes feed than are landed on."""
    out = moves.groupBy("node", "approach", "dest").agg(F.count_distinct("lane").alias("n_feeders"), F.count_distinct("target").alias("n_landed"))
    return out.filter("n_feeders > n_landed")


def kerb_first(groups: DataFrame, keys: list[str], order: str, lanes: str, n: str) -> DataFrame:
    """Deal n approach lanes to destination groups in kerb order where their lanes sum to n; else by proportion.

    (keys…, order, lane, target): approach lane and the lane within its group, both from 0. By
    proportion, lane i of n goes to place floor((i + 0.5) * total / n) of all destination lanes.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*keys)
    dealt = groups.withColumn("_all", F.sum(lanes).over(w)).withColumn("_before", F.sum(lanes).over(w.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)) - F.col(lanes))
    each = dealt.withColumn("lane", F.explode(F.expr(f"sequence(0, cast(`{n}` as int) - 1)")))
    place = F.when(F.col("_all") == F.col(n), F.col("lane")).otherwise(F.expr(f"cast(((2 * lane + 1) * _all) div (2 * `{n}`) as int)"))
    each = each.withColumn("target", (place - F.col("_before")).cast("long"))
    return each.filter((F.col("target") >= 0) & (F.col("target") < F.col(lanes))).select(*keys, order, "lane", "target")


def dead_ends(lanes: DataFrame, links: DataFrame, termini: DataFrame) -> DataFrame:
    """lanes (lane, u, v) without an exit or entry in links (lane, target): (lane, end, fault).

    At a terminus node it is the extract's boundary, elsewhere an interior dead end.
    """
    out = links.select("lane").distinct()
    into = links.select(F.col("target").alias("lane")).distinct()
    no_exit = lanes.join(out, "lane", "left_anti").select("lane", F.lit("exit").alias("end"), F.col("v").alias("node"))
    no_entry = lanes.join(into, "lane", "left_anti").select("lane", F.lit("entry").alias("end"), F.col("u").alias("node"))
    both = no_exit.unionByName(no_entry).join(termini.select("node", F.lit(True).alias("_t")).distinct(), "node", "left")
    return both.select("lane", "end", F.when(F.col("_t").isNotNull(), "boundary").otherwise("interior_dead_end").alias("fault"))


def entries_and_exits(lanes: DataFrame, links: DataFrame) -> DataFrame:
    """(lane, role, reason): entry lanes are unfed and start where no other lane ends; exits have no onward lane."""
    unfed = lanes.join(links.select(F.col("target").alias("lane")).distinct(), "lane", "left_anti")
    reached = lanes.select(F.col("v").alias("u"), F.col("lane").alias("_by")).groupBy("u").agg(F.count(F.lit(1)).alias("_n"))
    entry = unfed.join(reached, "u", "left").select("lane", F.when(F.col("_n").isNull(), "entry").otherwise("rejected").alias("role"), F.when(F.col("_n").isNotNull(), "node_is_reached").alias("reason"))
    exits = lanes.join(links.select("lane").distinct(), "lane", "left_anti").select("lane", F.lit("exit").alias("role"), F.lit(None).cast("string").alias("reason"))
    return entry.unionByName(exits)


def exit_changes(before: DataFrame, after: DataFrame, lanes: DataFrame) -> DataFrame:
    """Lanes by exits (lane) before and after a review: lost, gained or without in both."""
    mark = lambda df, n: df.select("lane", F.lit(True).alias(n)).distinct()
    both = lanes.select("lane").join(mark(before, "b"), "lane", "left").join(mark(after, "a"), "lane", "left")
    change = F.when(F.col("b").isNotNull() & F.col("a").isNull(), "lost").when(F.col("b").isNull() & F.col("a").isNotNull(), "gained").when(F.col("a").isNull(), "without")
    return both.select("lane", change.alias("change")).filter("change is not null")


def run_checks(checks: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Named checks (issues, rows judged) to one row for each that ran: check, n_rows, n_issues, ok."""
    one = lambda name, issues, rows: rows.agg(F.count(F.lit(1)).alias("n_rows")).crossJoin(issues.agg(F.count(F.lit(1)).alias("n_issues"))).select(F.lit(name).alias("check"), "n_rows", "n_issues", (F.col("n_issues") == 0).alias("ok"))  # noqa: E731  two single rows
    return reduce(DataFrame.unionByName, [one(name, *pair) for name, pair in checks.items()])


def bounds(nodes: DataFrame, x: Column, y: Column) -> DataFrame:
    """Least and greatest coordinates and the centre of their box."""
    box = nodes.agg(F.min(x).alias("min_x"), F.min(y).alias("min_y"), F.max(x).alias("max_x"), F.max(y).alias("max_y"))
    return box.withColumn("centre_x", (F.col("min_x") + F.col("max_x")) / 2).withColumn("centre_y", (F.col("min_y") + F.col("max_y")) / 2)
