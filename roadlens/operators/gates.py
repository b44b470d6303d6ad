"""Review gates, decisions and their effects, plan and override checks, orders of reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Movements that an override may name.
MOVEMENTS = ("left", "right", "through", "slight_left", "slight_right", "reverse")
MOST_LANES = 12
SIGNAL_RULE, TURN_RULE = "signal_lane_association", "turn_permission_geometry_conflict"
PLAN_NAME = r"^[A-Za-z0-9][A-Za-z0-9-]{0,39}$"


def checksum_gate(inputs: DataFrame, recorded: DataFrame, key: str, checksum: str) -> DataFrame:
    """Inputs whose checksum isn't the recorded one: key and fault (unrecorded or changed)."""
    both = inputs.join(recorded.select(key, F.col(checksum).alias("_r")), key, "left")
    fault = F.when(F.col("_r").isNull(), "unrecorded").when(F.col("_r") != F.col(checksum), "changed")
    return both.select(key, fault.alias("fault")).filter("fault is not null")


def plan_identity_gate(plans: DataFrame, fingerprint: Column, model: Column) -> DataFrame:
    """Plans (plan, fingerprint, model) with the reason why they are refused, null if they aren't."""
    reason = F.when(~F.col("fingerprint").eqNullSafe(fingerprint), "fingerprint").when(~F.col("model").eqNullSafe(model), "model")
    return plans.select("plan", reason.alias("refused"))


def review_gates(decisions: DataFrame, findings: DataFrame, workspace: Column, fingerprint: Column, lanes: DataFrame, tag_rules: tuple[str, ...] = ()) -> DataFrame:
    """Findings whose decision a gate stops, or that need one and have none: finding and gate.

    decisions (finding, workspace, fingerprint, evidence, status, value as JSON text), findings (finding, evidence, severity, rule) and
    the lanes of the model (lane). Gates in order, the first one counts: workspace, fingerprint, unknown_finding, evidence,
    open_blocker (a blocker undecided, unresolved or ignored), tag_rule (an override whose rule is one of ``tag_rules``), and
    what override_fault says of an override. Nulls differ from everything but null; a decision of nulls is still a decision.
    """
    told = decisions.select("finding", "workspace", "fingerprint", F.col("evidence").alias("_e"), "status", "value", F.lit(True).alias("_told"))
    both = findings.select("finding", "evidence", "severity", "rule", F.lit(True).alias("_known")).join(told, "finding", "full_outer")
    fault = with_unknown_lanes(both.filter("status = 'overridden'").select("finding", "rule", "value"), lanes)
    both = both.join(fault.select("finding", override_fault(F.col("rule"), F.col("value"), F.col("unknown")).alias("_f")).distinct(), "finding", "left")
    over = F.coalesce(F.col("status") == "overridden", F.lit(False))
    left = F.coalesce(F.col("status").isin("unresolved", "ignored"), F.lit(True))
    gate = (
        F.when(F.col("_told") & ~F.col("workspace").eqNullSafe(workspace), "workspace").when(F.col("_told") & ~F.col("fingerprint").eqNullSafe(fingerprint), "fingerprint")
        .when(F.col("_known").isNull(), "unknown_finding").when(F.col("_told") & ~F.col("evidence").eqNullSafe(F.col("_e")), "evidence")
        .when((F.col("severity") == "blocker") & left, "open_blocker").when(over & F.coalesce(F.col("rule").isin(*tag_rules), F.lit(False)), "tag_rule").when(over, F.col("_f"))
    )
    return both.select("finding", gate.alias("gate")).filter("gate is not null")


def with_unknown_lanes(overrides: DataFrame, lanes: DataFrame) -> DataFrame:
    """Overrides (finding, value, …) with unknown: whether they name a lane (text) that isn't one of ``lanes`` (lane)."""
    named = overrides.select("finding", F.explode(F.from_json(F.get_json_object("value", "$.lane_ids"), "array<string>")).alias("lane"))
    gone = named.join(lanes.select(F.col("lane").cast("string")), "lane", "left_anti").select("finding").distinct().withColumn("unknown", F.lit(True))
    return overrides.join(gone, "finding", "left").withColumn("unknown", F.coalesce("unknown", F.lit(False)))


def override_fault(rule: Column, value: Column, unknown: Column | None = None) -> Column:
    """Why an override is refused, else null: rule (none that takes one), value, or unknown_lane where ``unknown`` says so.

    The value is JSON: a lane count is a whole number from 1 to 12, not text or a boolean; a movement one of six;
    accepted a boolean; lane_ids a list of one or more texts. Another shape is refused.
    """
    part = lambda key: F.try_variant_get(F.try_parse_json(value), f"$.{key}", "variant")
    kind = lambda key: F.schema_of_variant(part(key))
    n = F.try_variant_get(F.try_parse_json(value), "$.lane_count", "bigint")
    fits = (
        F.when(rule == "lane_count_inference", (kind("lane_count") == "BIGINT") & n.between(1, MOST_LANES))
        .when(rule == TURN_RULE, (kind("movement") == "STRING") & F.try_variant_get(F.try_parse_json(value), "$.movement", "string").isin(*MOVEMENTS))
        .when(rule == "ambiguous_connector", kind("accepted") == "BOOLEAN").when(rule == SIGNAL_RULE, kind("lane_ids") == "ARRAY<STRING>")
    )
    known = F.coalesce(rule.isin("lane_count_inference", TURN_RULE, "ambiguous_connector", SIGNAL_RULE), F.lit(False))
    fault = F.when(~known, "rule").when(~F.coalesce(fits, F.lit(False)), "value")
    return fault if unknown is None else fault.when((rule == SIGNAL_RULE) & unknown, "unknown_lane")


def rewrite_turn(tag: Column, slot: Column, movement: Column, slots: Column) -> Column:
    """A turn tag with slot n (from 0) replaced; null where the tag hasn't so many slots."""
    parts = F.split(tag, r"\|", -1)
    changed = F.transform(parts, lambda p, i: F.when(i == slot, movement).otherwise(p))
    return F.when((F.size(parts) == slots) & (slot >= 0) & (slot < slots), F.array_join(changed, "|"))


def queue(findings: DataFrame, status: str | None = None, rule: str | None = None, severity: str | None = None, text: str | None = None) -> DataFrame:
    """The review queue: ignored rows are hidden unless asked for; the text is looked for in id and reason."""
    out = findings.filter(F.col("status") == status) if status else findings.filter(F.col("status") != "ignored")
    for name, value in (("rule", rule), ("severity", severity)):
        out = out.filter(F.col(name) == value) if value else out
    return out.filter(F.contains(F.lower(F.concat_ws(" ", F.col("finding").cast("string"), "reason")), F.lit(text.lower()))) if text else out


def plan_faults(rows: DataFrame) -> DataFrame:
    """Signal plan rows (plan, name, lane, green, yellow, cycle) to (plan, name, fault)."""
    named = Window.partitionBy("plan", "name")
    laned = Window.partitionBy("plan", "lane")
    finite = F.lit(True)
    for c in ("green", "yellow", "cycle"):
        finite = finite & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    faults = {
        "name": ~F.coalesce(F.col("name").rlike(PLAN_NAME), F.lit(False)), "number": ~finite, "too_long": finite & (F.col("green") + F.col("yellow") > F.col("cycle")),
        "repeated_name": F.col("_names") > 1, "repeated_lane": F.col("_lanes") > 1,
    }
    marked = rows.withColumn("_names", F.count(F.lit(1)).over(named)).withColumn("_lanes", F.count(F.lit(1)).over(laned))
    return marked.select("plan", "name", F.explode(F.array_compact(F.array(*[F.when(c, n) for n, c in faults.items()]))).alias("fault")).distinct()


def effects(decisions: DataFrame, findings: DataFrame) -> DataFrame:
    """Decisions (finding, status) on findings (finding, kind, target, proposed) to (kind, target, effect, contradicted).

    accepted does what is proposed, overridden the contrary, others nothing; a target with both is contradicted.
    """
    told = decisions.filter(F.col("status").isin("accepted", "overridden")).join(findings, "finding")
    want = F.when(F.col("status") == "accepted", F.col("proposed")).when(F.col("proposed") == "forbid", "allow").otherwise("forbid")
    out = told.withColumn("_w", want).groupBy("kind", "target").agg(F.min("_w").alias("effect"), (F.min("_w") < F.max("_w")).alias("contradicted"))
    return out.withColumn("effect", F.when(~F.col("contradicted"), F.col("effect")))


def decision_states(decisions: DataFrame, before: DataFrame, after: DataFrame, unmapped: DataFrame) -> DataFrame:
    """Findings of the reviewed model with the decision that answers their question: finding, state, status, satisfied.

    decisions (finding, status) name findings of the model before (finding, question); a finding after (finding, question,
    rule, nodes) is decided if its question was. A decision is satisfied once it is made, but for a signal association that still
    has a node among ``unmapped`` (node), and for an overridden turn conflict, which would be gone had the override settled it.
    Of findings with the same question before, the last id counts.
    """
    asked = before.groupBy("question").agg(F.max("finding").alias("_answers"))
    told = decisions.select(F.col("finding").alias("_answers"), "status", F.lit(True).alias("_told"))
    waiting = after.filter(F.col("rule") == SIGNAL_RULE).select("finding", F.explode("nodes").alias("node")).join(unmapped.select("node"), "node", "left_semi")
    both = after.join(asked, "question", "left").join(told, "_answers", "left").join(waiting.select("finding", F.lit(True).alias("_open")).distinct(), "finding", "left")
    fine = F.when(F.col("rule") == TURN_RULE, ~F.col("status").eqNullSafe("overridden")).otherwise(F.col("_open").isNull())
    decided = F.col("_told").isNotNull()
    return both.select("finding", F.when(decided, "decided").otherwise("undecided").alias("state"), "status", F.when(decided, fine).alias("satisfied"))


def fan_out(findings: DataFrame, rule: str, status: str, road_class: str | None = None) -> DataFrame:
    """One disposition over a rule (and road class): a decision row for each finding."""
    hit = findings.filter(F.col("rule") == rule)
    hit = hit.filter(F.col("road_class") == road_class) if road_class else hit
    return hit.select("finding", F.lit(status).alias("status"))


def rewritten_tags(ways: DataFrame, approved: DataFrame) -> DataFrame:
    """ways (way, tags) with approved (way, key, value) applied: way, tags, changed and contradicted keys.

    A key with two values is contradicted and stays as it is. Ways without a change or a contradiction aren't returned;
    rows without a key count for nothing.
    """
    one = approved.filter("key is not null").groupBy("way", "key").agg(F.min("value").alias("value"), (F.size(F.collect_set(F.struct("value"))) > 1).alias("_two"))
    entries = F.array_sort(F.collect_list(F.when(~F.col("_two"), F.struct("key", "value"))))
    new = one.groupBy("way").agg(F.map_from_entries(entries).alias("_new"), F.array_sort(F.collect_list(F.when(F.col("_two"), F.col("key")))).alias("contradicted"))
    both = ways.join(new, "way")
    new_ones = F.filter(F.map_entries("_new"), lambda e: ~F.coalesce(F.try_element_at("tags", e["key"]) == e["value"], F.lit(False)))
    both = both.withColumn("changed", F.array_sort(F.transform(new_ones, lambda e: e["key"]))).filter((F.size("changed") > 0) | (F.size("contradicted") > 0))
    kept = F.map_filter("tags", lambda k, v: ~F.array_contains(F.map_keys("_new"), k))
    return both.select("way", F.map_concat(kept, "_new").alias("tags"), "changed", "contradicted")


def question_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Question keys of findings that were created or resolved between two versions."""
    a, b = before.select("question").distinct(), after.select("question").distinct()
    return b.join(a, "question", "left_anti").withColumn("change", F.lit("created")).unionByName(a.join(b, "question", "left_anti").withColumn("change", F.lit("resolved")))


def open_blockers(findings: DataFrame, states: DataFrame | None) -> DataFrame:
    """Blockers of the reviewed model that are undecided or decided but not satisfied (decision_states), without
    those not applicable; all of them without a review."""
    blockers = findings.filter(F.col("severity") == "blocker")
    if states is None:
        return blockers.select("finding")
    both = blockers.join(states, "finding", "left")
    return both.filter(~F.col("status").eqNullSafe("not_applicable") & ~F.coalesce("satisfied", F.lit(False))).select("finding")


def first_by(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows in an order (a top-n report) with their place from 1."""
    return rows.orderBy(*order).limit(n).withColumn("place", F.row_number().over(Window.orderBy(*order)))  # of n rows


def queue_order(priority: dict[str, int]) -> list[Column]:
    """Rule priority, then rule, then id."""
    rank = F.lit(10)
    for rule, value in priority.items():
        rank = F.when(F.col("rule") == rule, value).otherwise(rank)
    return [rank.asc(), F.col("rule").asc(), F.col("finding").asc()]


def issue_order() -> list[Column]:
    """Code, id (null as ''), reason."""
    return [F.col("code").asc(), F.coalesce(F.col("id").cast("string"), F.lit("")).asc(), F.col("reason").asc()]


def id_order(id_: Column) -> list[Column]:
    """Numbers as text: by length, then value."""
    return [F.length(id_).asc(), id_.asc()]


def seeded(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows in a seeded order that depends on their keys alone."""
    return first_by(rows, n, F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))).asc(), F.col(key).asc())


def worst(rows: DataFrame, keys: list[str], value: str, id_: str) -> DataFrame:
    """The largest value of each key with its id, the least id of ties; ids of any type that has an order."""
    most = rows.groupBy(*keys).agg(F.max(value).alias("_m"))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
    both = rows.alias("r").join(most.alias("m"), [*same, F.col(f"r.{value}").eqNullSafe(F.col("m._m"))])
    return both.groupBy(*[F.col(f"r.{k}") for k in keys], F.col(f"r.{value}")).agg(F.min(F.col(f"r.{id_}")).alias(id_))
