"""Review reconciliation: question keys, decision joins, version differences, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def question_key(rule: Column, *parts: Column) -> Column:
    """A key of what a finding asks, which stays when ids change."""
    return F.sha2(F.to_json(F.struct(rule.alias("rule"), *(p.alias(f"p{i}") for i, p in enumerate(parts)))), 256)


def decided(findings: DataFrame, decisions: DataFrame, key: str, status: str, order: str | None = None) -> DataFrame:
    """Findings with their decision's status, or undecided; of several decisions on one the last by ``order``, else the greatest status."""
    last = F.max_by(status, order) if order else F.max(status)
    return findings.join(decisions.groupBy(key).agg(last.alias("_s")), key, "left").withColumn("status", F.coalesce("_s", F.lit("undecided"))).drop("_s")


def decided_by_question(reviewed: DataFrame, before: DataFrame, decisions: DataFrame, key: str, question: str, status: str) -> DataFrame:
    """Reviewed findings with the status of the decision that names an earlier finding of the same question.

    Ids (key) may change between before and reviewed; of earlier findings of one question the greatest id counts.
    """
    earlier = before.groupBy(question).agg(F.max(key).alias("_id"))
    answers = decisions.select(F.col(key).alias("_id"), F.col(status).alias("_s"))
    named = earlier.join(answers, "_id").select(question, "_s")
    return reviewed.join(named, question, "left").withColumn("status", F.coalesce("_s", F.lit("undecided"))).drop("_s")


def version_diff(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Ids that were added or removed between two versions."""
    a, b = before.select(key).distinct(), after.select(key).distinct()
    added = b.join(a, key, "left_anti").withColumn("change", F.lit("added"))
    removed = a.join(b, key, "left_anti").withColumn("change", F.lit("removed"))
    return added.unionByName(removed)


def by_rule(findings: DataFrame, rule: str, severity: str, levels: list[str]) -> DataFrame:
    """Findings per rule, a column for each severity."""
    return findings.groupBy(rule).pivot(severity, levels).agg(F.count(F.lit(1))).fillna(0, levels)


def migrated(decisions: DataFrame, findings: DataFrame, key: str, checksum: str, status: str | None = None, severity: str | None = None) -> DataFrame:
    """Decisions as carried, invalidated (evidence changed, or a blocker ignored) or unknown (no such finding).

    Blockers are judged by the decision's ``status`` and the finding's ``severity``, if both are named.
    """
    judged = bool(status and severity)
    now = findings.select(key, F.col(checksum).alias("_c"), (F.col(severity) if judged else F.lit(None)).alias("_severity"), F.lit(True).alias("_there"))
    aside = F.coalesce((F.col(status) == "ignored") & (F.col("_severity") == "blocker"), F.lit(False)) if judged else F.lit(False)
    state = F.when(F.col("_there").isNull(), "unknown").when(F.col("_c").eqNullSafe(F.col(checksum)) & ~aside, "carried").otherwise("invalidated")
    return decisions.join(now, key, "left").withColumn("state", state).drop("_c", "_severity", "_there")


def identity_relation(mine: tuple[Column, Column, Column], theirs: tuple[Column, Column, Column]) -> Column:
    """other-map, relocated, regenerated or same, from (map, place, fingerprint)."""
    return (
        F.when(~mine[0].eqNullSafe(theirs[0]), "other-map").when(~mine[1].eqNullSafe(theirs[1]), "relocated")
        .when(~mine[2].eqNullSafe(theirs[2]), "regenerated").otherwise("same")
    )


def dangling(links: DataFrame, targets: DataFrame, target: str, key: str) -> DataFrame:
    """Links to ids that don't exist."""
    return links.join(targets.select(F.col(key).alias(target)), target, "left_anti")


def not_mirrored(exits: DataFrame, entries: DataFrame) -> DataFrame:
    """Exits (id, to) that the other side doesn't name as an entry (id, frm)."""
    return exits.join(entries.select(F.col("id").alias("to"), F.col("frm").alias("id")).distinct(), ["id", "to"], "left_anti")
