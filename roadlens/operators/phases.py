"""Signal phases: groups that meet get different stages of a cycle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlens.session import discard, materialize

MAX_ROUNDS = 10_000


def colours(groups: DataFrame, conflicts: DataFrame, name: str = "colours") -> DataFrame:
    """groups (plan, name) and conflicts (plan, a, b) to (plan, name, degree, colour), colours from 0.

    The same as colouring one after another, most conflicts first, then by name, each with the least colour that
    no neighbour has: in a round all groups are coloured whose neighbours before them have their colours, so
    there are as many rounds as the longest descent in that order. Conflicts count once, in either
    direction; those with itself or with an unknown group don't count.
    """
    known = groups.select("plan", "name").filter("name is not null").distinct()
    side = lambda c: known.withColumnRenamed("name", c)
    both = conflicts.select("plan", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
    both = both.join(side("a"), ["plan", "a"], "left_semi").join(side("b"), ["plan", "b"], "left_semi").select("plan", "a", "b")
    both = both.unionByName(both.select("plan", F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.groupBy("plan", F.col("a").alias("name")).agg(F.count(F.lit(1)).alias("degree"))
    held = known.join(degree, ["plan", "name"], "left").select("plan", "name", F.coalesce("degree", F.lit(0)).alias("degree"), F.lit(None).cast("int").alias("colour"))
    held = materialize(held, name)
    of = lambda c: held.select("plan", F.col("name").alias(c), F.col("degree").alias(f"d{c}"))
    earlier = both.join(of("a"), ["plan", "a"]).join(of("b"), ["plan", "b"]).filter("da > db or da = db and a < b").select("plan", "a", "b")
    earlier = materialize(earlier, f"{name}-before")
    for _ in range(MAX_ROUNDS):
        open_ = held.filter("colour is null").select("plan", F.col("name").alias("b"))
        if open_.isEmpty():
            return held
        seen = earlier.join(open_, ["plan", "b"], "left_semi").join(held.select("plan", F.col("name").alias("a"), "colour"), ["plan", "a"])
        seen = seen.groupBy("plan", F.col("b").alias("name")).agg(F.bool_or(F.col("colour").isNull()).alias("waits"), F.collect_set("colour").alias("taken"))
        free = F.array_min(F.array_except(F.sequence(F.lit(0), F.size("taken")), F.col("taken")))
        new = held.join(seen, ["plan", "name"], "left")
        own = F.coalesce("colour", F.when(F.col("waits").isNull(), F.lit(0)).when(~F.col("waits"), free))
        new = materialize(new.select("plan", "name", "degree", own.alias("colour")), name)
        discard(held)
        held = new
    raise RuntimeError(f"no colouring after {MAX_ROUNDS} rounds")


def _tenth(x: Column) -> Column:
    return F.floor(x * 10 + 0.5) / 10


def staged(groups: DataFrame, conflicts: DataFrame, cycle: float, name: str = "stages") -> DataFrame:
    """groups (plan, name, lanes, green, yellow) to (plan, name, stage, offset, green, was, fault) in a cycle of seconds.

    Colours are stages, the one of most lanes first (ties: the lesser colour); each ends where the next begins. A green
    is cut to its stage less its yellow, never made longer. A plan has one fault: nothing_to_do (one group),
    no_conflict, or full_yellow where a yellow fills its stage; its groups then keep their green and have no stage.
    """
    coloured = colours(groups, conflicts, name)
    both = groups.select("plan", "name", "lanes", "green", "yellow").join(coloured, ["plan", "name"])
    by = both.groupBy("plan", "colour").agg(F.sum("lanes").alias("n"))  # a row a colour, few a plan
    order = Window.partitionBy("plan").orderBy(F.desc("n"), "colour")
    by = by.withColumn("stage", F.row_number().over(order) - 1).withColumn("of", F.count(F.lit(1)).over(Window.partitionBy("plan")))
    begins = lambda i: _tenth(i * F.lit(float(cycle)) / F.col("of"))
    ends = F.when(F.col("stage") + 1 < F.col("of"), begins(F.col("stage") + 1)).otherwise(F.lit(float(cycle)))
    by = by.select("plan", "colour", "stage", begins(F.col("stage")).alias("offset"), ends.alias("until"))
    timed = both.join(by, ["plan", "colour"]).withColumn("room", _tenth(F.col("until") - F.col("offset") - F.col("yellow")))
    plans = timed.groupBy("plan").agg(F.count(F.lit(1)).alias("n"), F.max("degree").alias("most"), F.min("room").alias("least"))
    fault = F.when(F.col("n") < 2, "nothing_to_do").when(F.col("most") == 0, "no_conflict").when(F.col("least") <= 0, "full_yellow")
    out = timed.join(plans.select("plan", fault.alias("fault")), "plan")
    fine = F.col("fault").isNull()
    green = F.when(fine, F.least("green", "room")).otherwise(F.col("green"))
    return out.select("plan", "name", F.when(fine, F.col("stage")).alias("stage"), F.when(fine, F.col("offset")).alias("offset"), green.alias("green"), F.col("green").alias("was"), "fault")
