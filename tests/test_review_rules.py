"""Review rules case by case: gates, overrides, satisfied decisions, rewrites."""

import pytest
from pyspark.sql import functions as F

from roadlens.operators import gates, telemetry

TOLD = "finding string, workspace string, fingerprint string, evidence string, status string, value string"
FOUND = "finding string, evidence string, severity string, rule string"


def gated(spark, decisions, findings):
    lanes = spark.createDataFrame([("l1",), ("l2",)], "lane string")
    out = gates.review_gates(spark.createDataFrame(decisions, TOLD), spark.createDataFrame(findings, FOUND), F.lit("w"), F.lit("g"), lanes, ("speed_default",))
    return {r.finding: r.gate for r in out.collect()}


def test_gates_in_order(spark):
    found = [(f, "e", "warning", "lane_count_inference") for f in ("fine", "moved", "old", "elsewhere", "nulls")]
    told = [
        ("fine", "w", "g", "e", "accepted", None), ("moved", "w", "g", "x", "accepted", None), ("old", "w", "f", "x", "accepted", None), ("elsewhere", "v", "f", "x", "accepted", None),
        ("nulls", None, None, None, None, None), ("gone", "w", "g", "e", "accepted", None),
    ]
    assert gated(spark, told, found) == {"moved": "evidence", "old": "fingerprint", "elsewhere": "workspace", "nulls": "workspace", "gone": "unknown_finding"}


@pytest.mark.parametrize(("status", "gate"), [("accepted", None), ("not_applicable", None), ("ignored", "open_blocker"), ("unresolved", "open_blocker"), (None, "open_blocker")])
def test_a_blocker_needs_an_answer(spark, status, gate):
    found = [("a", "e", "blocker", gates.TURN_RULE), ("b", "e", "blocker", gates.TURN_RULE)]
    got = gated(spark, [("a", "w", "g", "e", status, None)], found)
    assert got.get("a") == gate and got["b"] == "open_blocker"  # nobody decided b


def test_overrides_at_the_gates(spark):
    rules = {"tag": "speed_default", "lane": gates.SIGNAL_RULE, "known": gates.SIGNAL_RULE, "many": "lane_count_inference", "none": "width"}
    values = {"lane": '{"lane_ids": ["l1", "l9"]}', "known": '{"lane_ids": ["l2"]}', "many": '{"lane_count": 13}'}
    got = gated(spark, [(f, "w", "g", "e", "overridden", values.get(f)) for f in rules], [(f, "e", "warning", r) for f, r in rules.items()])
    assert got == {"tag": "tag_rule", "lane": "unknown_lane", "many": "value", "none": "rule"}


def test_override_values(spark):
    count, turn, bridge, signal = "lane_count_inference", gates.TURN_RULE, "ambiguous_connector", gates.SIGNAL_RULE
    cases = [
        (count, '{"lane_count": 1}', None), (count, '{"lane_count": 12}', None), (count, '{"lane_count": 0}', "value"), (count, '{"lane_count": true}', "value"), (count, '{"lane_count": "3"}', "value"),
        (count, '{"lane_count": 2.5}', "value"), (count, '{"lanes": 3}', "value"), (count, "3", "value"), (count, None, "value"), (count, "{broken", "value"),
        (turn, '{"movement": "reverse"}', None), (turn, '{"movement": "none"}', "value"), (turn, '{"movement": ["left"]}', "value"),
        (bridge, '{"accepted": false}', None), (bridge, '{"accepted": "true"}', "value"), (bridge, "true", "value"),
        (signal, '{"lane_ids": ["a"]}', None), (signal, '{"lane_ids": []}', "value"), (signal, '{"lane_ids": [1]}', "value"), ("width", '{"accepted": true}', "rule"), (None, None, "rule"),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, rule string, value string, want string")
    rows = df.withColumn("got", gates.override_fault(F.col("rule"), F.col("value"))).collect()
    assert [(r.rule, r.value, r.got) for r in rows] == [(r.rule, r.value, r.want) for r in rows]


def states(spark):
    before = spark.createDataFrame([(f"b{q}", q) for q in "abcdef"], "finding string, question string")
    told = spark.createDataFrame([("ba", "accepted"), ("bb", "accepted"), ("bc", "accepted"), ("bd", "accepted"), ("be", "overridden"), ("bf", "not_applicable")], "finding string, status string")
    after = [("a", "width", []), ("b", gates.SIGNAL_RULE, ["n1", "n2"]), ("c", gates.SIGNAL_RULE, ["n2"]), ("d", gates.TURN_RULE, []), ("e", gates.TURN_RULE, []), ("f", gates.SIGNAL_RULE, ["n1"]), ("new", "width", [])]
    after = spark.createDataFrame([(f"a{q}", q, r, n, "blocker") for q, r, n in after], "finding string, question string, rule string, nodes array<string>, severity string")
    return after, gates.decision_states(told, before, after, spark.createDataFrame([("n1",), ("n1",)], "node string"))


def test_decisions_are_satisfied_once_made_but_for_two_rules(spark):
    got = {r.finding: (r.state, r.satisfied) for r in states(spark)[1].collect()}
    yes, no = ("decided", True), ("decided", False)
    assert got == {"aa": yes, "ab": no, "ac": yes, "ad": yes, "ae": no, "af": no, "anew": ("undecided", None)}


def test_blockers_that_stay_open(spark):
    after, got = states(spark)
    assert {r.finding for r in gates.open_blockers(after, got).collect()} == {"ab", "ae", "anew"}  # af is not applicable
    assert gates.open_blockers(after, None).count() == 7


def test_rewrite_with_two_values_for_a_key(spark):
    ways = spark.createDataFrame([(1, {"lanes": "1", "name": "x"}), (2, {"lanes": "2"}), (3, {"lanes": "2"})], "way int, tags map<string,string>")
    asked = spark.createDataFrame([(1, "lanes", "2"), (1, "lanes", "3"), (1, "turn", "left"), (2, "lanes", "2"), (3, "lanes", "3"), (3, None, "4")], "way int, key string, value string")
    got = {r.way: (r.tags, r.changed, r.contradicted) for r in gates.rewritten_tags(ways, asked).collect()}
    assert got == {1: ({"lanes": "1", "name": "x", "turn": "left"}, ["turn"], ["lanes"]), 3: ({"lanes": "3"}, ["lanes"], [])}


def test_worst_with_text_ids_and_null_keys(spark):
    df = spark.createDataFrame([("k", 2.0, "b"), ("k", 2.0, "a"), ("k", 1.0, "0"), (None, 5.0, "z")], "k string, v double, id string")
    assert {(r.k, r.v, r.id) for r in gates.worst(df, ["k"], "v", "id").collect()} == {("k", 2.0, "a"), (None, 5.0, "z")}


def test_nan_is_apart_when_channels_are_compared(spark):
    a = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, 9.0)], "t int, v double")
    b = spark.createDataFrame([(1, 1.5), (2, 2.0), (3, 2.0)], "t int, v double")
    r = telemetry.agreement(a, b, ["t"], "v", 1.0).first()
    assert (r.n, r.largest, r.n_out) == (3, 7.0, 1)
