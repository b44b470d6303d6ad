"""Directed lane graphs: strong components, reach counts, shortest drives, numbers without one task.

Edges are (a, b). Each round of a fixed point is one table in the shared folder, so lineage stays short and a lost
executor costs a round. Vertices with many edges are aggregated before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from roadlens.session import discard, materialize

LANE_CHANGE_M = 5.0
#: Sources of one block of reach counts: as many bits as this travel with a vertex, in words of 64.
BLOCK_WORDS = 16
#: Components that one may reach beside its hub's as listed pairs; those with more are counted in blocks.
MAX_PAIRS = 1024
MAX_ROUNDS = 10_000


def numbered(df: DataFrame, order: list[str | Column], column: str = "number", name: str = "numbered") -> DataFrame:
    """df with numbers from 0 in the order given: counts of sorted ranges are added up, not rows in one task."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    held = materialize(dealt.withColumn("_part", F.spark_partition_id()).withColumn("_row", row), name)
    # One row for each range, so at most as many as there are shuffle partitions.
    sizes = held.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    return held.join(F.broadcast(before), "_part").withColumn(column, F.col("_before") + F.col("_row")).drop("_part", "_row", "_before")


def _ends(nodes: DataFrame, edges: DataFrame, name: str = "ends") -> DataFrame:
    """(id, up, down): the largest id that reaches each vertex and the largest that it reaches, its own counted.

    Both ways go in one round. Only vertices that changed in a round send in the next.
    """
    way = lambda a, b, onward: edges.select(F.col(a).alias("from"), F.col(b).alias("to"), F.lit(onward).alias("onward"))
    arcs = way("a", "b", True).unionByName(way("b", "a", False))
    held = nodes.select("id", F.col("id").alias("up"), F.col("id").alias("down"), F.lit(True).alias("new_up"), F.lit(True).alias("new_down"))
    held = materialize(held, name)

    def step(held: DataFrame) -> DataFrame:
        sent = held.filter("new_up or new_down").join(arcs, F.col("id") == F.col("from")).groupBy(F.col("to").alias("id"))
        sent = sent.agg(F.max(F.when(F.col("onward") & F.col("new_up"), F.col("up"))).alias("got_up"), F.max(F.when(~F.col("onward") & F.col("new_down"), F.col("down"))).alias("got_down"))
        fresh = [F.coalesce(F.col(f"got_{c}") > F.col(c), F.lit(False)).alias(f"new_{c}") for c in ("up", "down")]
        return held.join(sent, "id", "left").select("id", F.greatest("up", "got_up").alias("up"), F.greatest("down", "got_down").alias("down"), *fresh)

    while True:
        seen = Observation()  # read off the write, so a round is one job less
        new = materialize(step(step(held)).observe(seen, F.max(F.col("new_up") | F.col("new_down")).alias("fresh")), name)
        discard(held)
        held = new
        if not seen.get["fresh"]:
            return held.select("id", "up", "down")


def _degrees(edges: DataFrame) -> DataFrame:
    """(id, degree): the lesser of a vertex's edges in and out; vertices without edges are not in it."""
    both = edges.select(F.col("a").alias("id"), F.lit(1).alias("n_out"), F.lit(0).alias("n_in")).unionByName(edges.select(F.col("b").alias("id"), F.lit(0).alias("n_out"), F.lit(1).alias("n_in")))
    return both.groupBy("id").agg(F.least(F.sum("n_out"), F.sum("n_in")).alias("degree"))


def strong_components(vertices: DataFrame, edges: DataFrame, name: str = "strong") -> DataFrame:
    """vertices (id) and edges (a, b) to (id, component): component is the largest id of the strong component.

    Vertices are numbered by degree, so that the largest numbers stand in large components. Where the largest number
    that reaches a vertex is also the largest that it reaches, the two are in one component. Others go through again, with
    the edges between vertices that have the same two numbers, as no cycle holds other edges. A vertex without
    a way in or out among these is a component of its own. Edges to ids that aren't vertices and edges from
    a vertex to itself count for nothing.
    """
    ids = materialize(vertices.select("id").filter("id is not null").distinct(), f"{name}-ids")
    known = lambda e, c: e.join(ids.select(F.col("id").alias(c)), c, "left_semi")
    now = materialize(known(known(edges.select("a", "b").filter("a <> b").distinct(), "a"), "b").select("a", "b"), f"{name}-edges")
    nodes = numbered(_degrees(now).filter("degree > 0"), ["degree", "id"], name=f"{name}-numbers").select("id", "number")
    nodes = materialize(nodes, f"{name}-nodes")
    side = lambda c: nodes.select(F.col("id").alias(c), F.col("number").alias(f"n{c}"))
    now = now.join(side("a"), "a").join(side("b"), "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    now, done = materialize(now, f"{name}-numbered"), []
    while True:
        live = materialize(_degrees(now).filter("degree > 0").select("id"), f"{name}-live")
        if live.isEmpty():
            break
        within = lambda e, c: e.join(live.select(F.col("id").alias(c)), c, "left_semi")  # noqa: B023,E731
        now = materialize(within(within(now, "a"), "b").select("a", "b"), f"{name}-numbered")
        ends = _ends(live, now, f"{name}-ends")
        done.append(ends.filter("up = down").select(F.col("id").alias("number"), "up"))
        side = lambda c: ends.filter("up <> down").select(F.col("id").alias(c), F.struct("up", "down").alias(f"e{c}"))  # noqa: B023,E731
        now = materialize(now.join(side("a"), "a").join(side("b"), "b").filter("ea = eb").select("a", "b"), f"{name}-numbered")
    if not done:
        return ids.withColumn("component", F.col("id"))
    whole = materialize(nodes.join(reduce(DataFrame.unionByName, done), "number").select("id", "up"), f"{name}-done")
    largest = whole.groupBy("up").agg(F.max("id").alias("component"))
    return ids.join(whole.join(largest, "up").select("id", "component"), "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def _block_counts(asked: DataFrame, nodes: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """(id, all): the sizes of all nodes that each asked one reaches, its own counted.

    Sources go in blocks of 64 * ``BLOCK_WORDS``; a block is one flood in which every node holds the set of
    sources that reach it, as bits, so no table of pairs is made.
    """
    asked = materialize(numbered(asked.select("id"), ["id"], name=f"{name}-numbers"), f"{name}-asked")
    n, per = asked.count(), 64 * BLOCK_WORDS
    words = [f"w{i}" for i in range(BLOCK_WORDS)]
    counts = []
    for block in range(-(-n // per)):
        spot = f"(number - {block * per})"
        bits = [F.expr(f"if({spot} div 64 = {i} and {spot} >= 0, shiftleft(1L, cast({spot} % 64 as int)), 0L)").alias(w) for i, w in enumerate(words)]
        held = nodes.select("id").join(asked, "id", "left").select("id", *[F.coalesce(b, F.lit(0)).alias(w) for b, w in zip(bits, words, strict=True)])
        held = materialize(held, f"{name}-bits")
        front = held.filter(reduce(Column.__or__, [F.col(w) != 0 for w in words]))
        while True:
            sent = front.join(links, F.col("id") == F.col("a")).groupBy(F.col("b").alias("id")).agg(*[F.bit_or(w).alias(f"g{w}") for w in words])
            both = held.join(sent, "id", "left")
            grown = [F.coalesce(F.col(f"g{w}"), F.lit(0)).bitwiseOR(F.col(w)) for w in words]
            fresh = reduce(Column.__or__, [g != F.col(w) for g, w in zip(grown, words, strict=True)])
            new = materialize(both.select("id", fresh.alias("fresh"), *[g.alias(w) for g, w in zip(grown, words, strict=True)]), f"{name}-bits")
            discard(held)
            held, front = new, new.filter("fresh")
            if front.isEmpty():
                break
        # A source gets the sizes of all nodes that hold its bit; sums are made before the shuffle.
        sized = held.join(nodes.select("id", "size"), "id")
        bit = lambda w, i: F.transform(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda j: F.call_function("getbit", F.col(w), j) == 1), lambda j: j + 64 * i)
        spots = F.flatten(F.array(*[bit(w, i) for i, w in enumerate(words)]))
        count = sized.select(F.explode(spots).alias("spot"), "size").groupBy("spot").agg(F.sum("size").alias("all"))
        counts.append(materialize(count.select((F.col("spot") + block * per).alias("number"), "all"), f"{name}-counts"))
        discard(held)
    return asked.join(reduce(DataFrame.unionByName, counts), "number").select("id", "all")


def reach_counts(vertices: DataFrame, edges: DataFrame, name: str = "reach") -> DataFrame:
    """(id, component, size, reach): how many other vertices can be reached from each.

    Counted on components, numbered by size. The hub of a component is the largest number that it reaches, if what that
    hub reaches is just what has the hub as the largest number that reaches it: then this part is one sum, the
    same for all with this hub. What a component reaches beside it is listed as pairs. A component with over ``MAX_PAIRS``
    of them is counted by floods of blocks, without pairs, so no table of all pairs is made.
    """
    edges = materialize(edges.select("a", "b").filter("a <> b").distinct(), f"{name}-edges")
    comp = materialize(strong_components(vertices, edges, f"{name}-strong"), f"{name}-comp")
    side = lambda c: comp.select(F.col("id").alias(c), F.col("component").alias(f"c{c}"))
    links = edges.join(side("a"), "a").join(side("b"), "b").filter("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
    links = materialize(links, f"{name}-links")
    sizes = comp.groupBy("component").agg(F.count(F.lit(1)).alias("size")).join(_degrees(links).withColumnRenamed("id", "component"), "component", "left")
    nodes = materialize(numbered(sizes, ["size", "degree", "component"], name=f"{name}-numbers").select(F.col("number").alias("id"), "component", "size"), f"{name}-nodes")
    side = lambda c: nodes.select(F.col("component").alias(c), F.col("id").alias(f"n{c}"))
    links = materialize(links.join(side("a"), "a").join(side("b"), "b").select(F.col("na").alias("a"), F.col("nb").alias("b")), f"{name}-steps")
    nodes = materialize(_ends(nodes, links, f"{name}-ends").join(nodes, "id"), f"{name}-nodes")
    up = lambda c: nodes.select(F.col("id").alias(c), F.col("up").alias(f"up_{c}"))
    steps = materialize(links.join(up("a"), "a").join(up("b"), "b"), f"{name}-steps")
    left = steps.filter("up_a <> up_b").select(F.col("up_a").alias("hub")).distinct()
    hubs = nodes.groupBy(F.col("up").alias("hub")).agg(F.sum("size").alias("below")).join(left, "hub", "left_anti")
    nodes = materialize(nodes.join(hubs, F.col("down") == F.col("hub"), "left").select("id", "component", "size", "hub", "below"), f"{name}-nodes")
    steps = steps.select("a", "b", F.col("up_b").alias("up"))
    beside = F.col("hub").isNull() | (F.col("hub") != F.col("up"))
    held = steps.join(nodes.select(F.col("id").alias("a"), "hub"), "a").filter(beside).select(F.col("a").alias("source"), "hub", F.col("b").alias("id"), F.lit(True).alias("fresh"))
    held, wide = materialize(held, f"{name}-pairs"), []
    while True:
        each = held.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.max("fresh").alias("fresh"))
        most = each.agg(F.max("n").alias("n"), F.max("fresh").alias("fresh")).first()
        if most.n and most.n > MAX_PAIRS:
            wide.append(materialize(each.filter(F.col("n") > MAX_PAIRS).select(F.col("source").alias("id")), f"{name}-wide"))
            new = materialize(held.join(wide[-1].withColumnRenamed("id", "source"), "source", "left_anti"), f"{name}-pairs")
            discard(held)
            held = new
        if not most.fresh:
            break
        sent = held.filter("fresh").select("source", "hub", F.col("id").alias("a")).join(steps, "a").filter(beside).select("source", "hub", F.col("b").alias("id"), F.lit(True).alias("fresh"))
        # A pair that was there before is not fresh.
        new = held.withColumn("fresh", F.lit(False)).unionByName(sent).groupBy("source", "hub", "id").agg(F.min("fresh").alias("fresh"))
        new = materialize(new, f"{name}-pairs")
        discard(held)
        held = new
    listed = held.join(nodes.select("id", "size"), "id").groupBy(F.col("source").alias("id")).agg(F.sum("size").alias("listed"))
    own = F.when(F.col("id") == F.col("hub"), F.col("below")).otherwise(F.col("size") + F.coalesce("below", F.lit(0)))
    total = nodes.join(listed, "id", "left").withColumn("all", own + F.coalesce("listed", F.lit(0)))
    if wide:
        counted = _block_counts(reduce(DataFrame.unionByName, wide), nodes, links, f"{name}-wide").withColumnRenamed("all", "counted")
        total = total.join(counted, "id", "left").withColumn("all", F.coalesce("counted", "all"))
    return comp.join(total.select("component", "size", (F.col("all") - 1).alias("reach")), "component").select("id", "component", "size", "reach")


def reach_facts(reach: DataFrame) -> DataFrame:
    """One row of facts of reach_counts: best start (ties: the largest id), median, components, pairs."""
    parts = reach.groupBy("component").agg(F.first("size").alias("size"), F.first("reach").alias("reach"), F.max("id").alias("id"))
    n = F.coalesce(F.sum("size"), F.lit(0))
    best = F.max(F.struct("reach", "id"))
    return parts.agg(
        best["id"].alias("best_start"), best["reach"].alias("best_start_reaches"), F.coalesce(F.expr("percentile(reach, 0.5, size)"), F.lit(0.0)).alias("median_reach"),
        F.coalesce(F.sum(F.when(F.col("reach") == 0, F.col("size"))), F.lit(0)).alias("reaching_nothing"), F.coalesce(F.sum(F.col("size") * F.col("reach")), F.lit(0)).alias("reachable_pairs"),
        (n * (n - 1)).alias("possible_pairs"), F.count(F.lit(1)).alias("components"), F.coalesce(F.max("size"), F.lit(0)).alias("largest"),
    )


def drive_edges(lanes: DataFrame, exits: DataFrame, changes: DataFrame) -> DataFrame:
    """lanes (id, length), exits and lane changes (a, b) to edges (a, b, cost, change).

    An exit costs the length of the lane it leads to, a lane change half of that and ``LANE_CHANGE_M``. Where both
    lead from a to b the exit counts. Ends that aren't lanes are left out.
    """
    both = exits.select("a", "b", F.lit(False).alias("change")).unionByName(changes.select("a", "b", F.lit(True).alias("change")))
    both = both.groupBy("a", "b").agg(F.min("change").alias("change"))
    to = both.join(lanes.select(F.col("id").alias("b"), "length"), "b").join(lanes.select(F.col("id").alias("a")), "a", "left_semi")
    return to.select("a", "b", F.when(F.col("change"), F.col("length") / 2 + LANE_CHANGE_M).otherwise(F.col("length")).alias("cost"), "change")


def shortest_drives(routes: DataFrame, edges: DataFrame, lanes: DataFrame, step: float, name: str = "drive") -> DataFrame:
    """routes (route, start, end) to (route, start, end, fault, cost, lanes, changes): the cheapest drive of each.

    Costs settle in buckets of ``step``: within a bucket labels that got cheaper are sent on until none does,
    then the next bucket with labels is taken. A route is done when its end is cheaper than the bucket, and sends
    nothing more. Labels keep the lane before them (ties: the least), lanes come from walking back, all
    routes a step at a time. changes are the places in lanes, from 1 behind the start, that are reached by
    a lane change. fault is unknown_start, unknown_end, same_lane or no_drive, else null. Costs are 0 or more.
    """
    known = lambda c: lanes.select(F.col("id").alias(c), F.lit(True).alias(f"has_{c}"))
    asked = routes.select("route", "start", "end").join(known("start"), "start", "left").join(known("end"), "end", "left")
    early = F.when(F.col("has_start").isNull(), "unknown_start").when(F.col("has_end").isNull(), "unknown_end").when(F.col("start") == F.col("end"), "same_lane")
    asked = materialize(asked.select("route", "start", "end", early.alias("early")), f"{name}-asked")
    own = materialize(edges.select("a", "b", F.col("cost").cast("double").alias("cost"), "change"), f"{name}-edges")
    none = own.select(F.col("a").alias("prev"), F.col("change").alias("by_change")).schema
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in none]
    held = asked.filter("early is null").select("route", F.col("start").alias("lane"), "end", F.lit(0.0).alias("cost"), *empty, F.lit(True).alias("open"))
    held = materialize(held, f"{name}-labels")
    for _ in range(MAX_ROUNDS):
        ends = held.filter(F.col("lane") == F.col("end")).select("route", F.col("cost").alias("best"))
        live = held.filter("open").join(ends, "route", "left").filter(F.col("best").isNull() | (F.col("cost") < F.col("best")))
        least = live.agg(F.min("cost").alias("m")).first()["m"]
        if least is None:
            break
        top = (least // step + 1) * step
        sent = live.filter(F.col("cost") < top).select("route", "end", F.col("lane").alias("a"), F.col("cost").alias("so_far")).join(own, "a")
        label = F.struct((F.col("so_far") + F.col("cost")).alias("cost"), F.col("a").alias("prev"), F.col("change").alias("by_change"))
        sent = sent.groupBy("route", "end", F.col("b").alias("lane")).agg(F.min(label).alias("got"))
        both = held.join(sent, ["route", "end", "lane"], "full_outer")
        # The same cost by a lesser lane before is a better label too, but needs no sending on.
        cheaper = F.col("got").isNotNull() & (F.col("cost").isNull() | (F.col("got.cost") < F.col("cost")))
        tie = F.col("got").isNotNull() & (F.col("got.cost") == F.col("cost")) & (F.col("got.prev") < F.col("prev"))
        sends = F.col("open") & (F.col("cost") >= top)
        pick = lambda c: F.when(cheaper | tie, F.col(f"got.{c}")).otherwise(F.col(c)).alias(c)  # noqa: B023,E731
        new = materialize(both.select("route", "lane", "end", pick("cost"), pick("prev"), pick("by_change"), F.coalesce(cheaper | sends, F.lit(False)).alias("open")), f"{name}-labels")
        discard(held)
        held = new
    walk = held.filter(F.col("lane") == F.col("end")).select("route", F.col("cost").alias("total"), F.array("end").alias("chain"), F.array("by_change").alias("by"), F.col("prev").alias("at"))
    walk, finished = materialize(walk, f"{name}-walk"), []
    while not walk.isEmpty():
        finished.append(walk.filter("at is null"))
        back = walk.filter("at is not null").join(held.select("route", F.col("lane").alias("at"), "prev", "by_change"), ["route", "at"])
        walk = materialize(back.select("route", "total", F.concat(F.array("at"), "chain").alias("chain"), F.concat(F.array("by_change"), "by").alias("by"), F.col("prev").alias("at")), f"{name}-walk")
    paths = reduce(DataFrame.unionByName, finished or [walk]).drop("at")
    places = F.filter(F.transform("by", lambda c, i: F.when(c, i)), lambda i: i.isNotNull())
    out = asked.join(paths, "route", "left")
    fault = F.coalesce("early", F.when(F.col("chain").isNull(), "no_drive"))
    return out.select("route", "start", "end", fault.alias("fault"), F.col("total").alias("cost"), F.col("chain").alias("lanes"), places.alias("changes"))
