from pyspark.sql import functions as F

from roadlens.operators import review, roads, telemetry


def test_migration_invalidates_ignored_blockers(spark):
    decisions = spark.createDataFrame([(1, "a", "ignored"), (2, "a", "ignored"), (3, "a", "accepted"), (4, "b", "accepted"), (5, "a", "ignored"), (6, "a", None)], "id int, sum string, status string")
    findings = spark.createDataFrame([(1, "a", "blocker"), (2, "a", "warning"), (3, "a", "blocker"), (4, "a", "warning"), (6, "a", None)], "id int, sum string, severity string")
    got = {r.id: r.state for r in review.migrated(decisions, findings, "id", "sum", "status", "severity").collect()}
    assert got == {1: "invalidated", 2: "carried", 3: "carried", 4: "invalidated", 5: "unknown", 6: "carried"}


def test_decisions_follow_the_question(spark):
    before = spark.createDataFrame([(1, "q1"), (2, "q2"), (3, "q3")], "id int, question string")
    reviewed = spark.createDataFrame([(11, "q1"), (3, "q2"), (13, "q4")], "id int, question string")
    decisions = spark.createDataFrame([(1, "accepted"), (3, "ignored")], "id int, state string")
    got = {r.id: r.status for r in review.decided_by_question(reviewed, before, decisions, "id", "question", "state").collect()}
    assert got == {11: "accepted", 3: "undecided", 13: "undecided"}


def test_least_run_and_cleared_key(spark):
    rows = spark.createDataFrame([(1, t, f) for t, f in enumerate([1, 0, 1, 1, 0, 1, 1, 1])] + [(2, 0, 1), (2, 1, 0)], "k int, t int, f int")
    got = sorted((r.k, r.run, r.n_rows) for r in telemetry.runs(rows, ["k"], ["t"], F.col("f") == 1, least=2).collect())
    assert got == [(1, 3, 2), (1, 6, 3)]
    last = telemetry.latest(rows, ["k"], [F.desc("t")], F.col("f") == 0).collect()
    assert [(r.k, r.t) for r in last] == [(1, 7)]


def test_component_histogram_and_number(spark):
    pairs = spark.createDataFrame([(7, 1, 2), (8, 5, 6), (8, 6, 7), (9, 7, 5), (10, 6, 5)], "way int, u long, v long")
    highways = spark.createDataFrame([(7, "road"), (8, "primary"), (9, None), (10, "primary")], "way int, highway string")
    got = {r.component: (r.number, r.n_nodes, r.n_edges, r.n_ways, [tuple(x) for x in r.highways]) for r in roads.component_summary(pairs, "way", highways).collect()}
    assert got == {5: (1, 3, 4, 3, [("<missing>", 1), ("primary", 2)]), 1: (2, 2, 1, 1, [("road", 1)])}


def test_lines_that_meet_themselves(spark):
    from roadlens.operators import spatial

    lines = {
        "straight": [(0, 0), (1, 0), (1, 0), (2, 0)], "ring": [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], "cross": [(0, 0), (4, 4), (4, 0), (0, 4)], "touch": [(0, 0), (4, 0), (4, 4), (2, 0)],
        "back": [(0, 0), (4, 0), (2, 0)], "again": [(0, 0), (4, 0), (4, 4), (0, 0), (-3, 1)], "point": [(1, 1), (1, 1)], "one": [(1, 1)], "endless": [(0, 0), (float("inf"), 0)], "none": [(0, 0), (None, 1), (2, 2)],
    }
    rows = [(k, i, None if x is None else float(x), float(y)) for k, ps in lines.items() for i, (x, y) in enumerate(ps)]
    points = spark.createDataFrame(rows, "line string, pos int, x double, y double")
    got = sorted(tuple(r) for r in spatial.geometry_faults(points, spatial.segments(points, "line", ["pos"]), "line").collect())
    assert got == [("again", "not_simple"), ("back", "not_simple"), ("cross", "not_simple"), ("endless", "not_finite"), ("none", "not_finite"), ("one", "too_few"), ("point", "no_length"), ("touch", "not_simple")]


def test_audits_name_missing_and_endless_coordinates(spark):
    from roadlens.operators import spatial

    inf, nan = float("inf"), float("nan")
    source = spark.createDataFrame([(1, "a", 0.0, 1.0, "f"), (2, "a", None, 1.0, "f"), (3, "a", None, 1.0, "f"), (4, "a", nan, 1.0, "fb"), (5, "a", nan, 1.0, None)], "id int, tag string, x double, y double, way string")
    graph = spark.createDataFrame([(1, "a", 0.0, None, "f"), (2, "a", None, 1.0, "f"), (3, "a", 2.0, 1.0, "b"), (4, "a", nan, 1.0, "f"), (5, "a", 1.0, 1.0, None)], "id int, tag string, x double, y double, way string")
    got = sorted(tuple(r) for r in spatial.source_audit(source, graph, "id", ["tag"], "x", "y", directions="way").collect())
    assert got == [(1, "coordinate_mismatch"), (3, "coordinate_mismatch"), (3, "direction_mismatch"), (4, "direction_mismatch"), (5, "coordinate_mismatch")]

    edges = spark.createDataFrame([(1, 1, 0.0, 0.0, 2, False, False), (2, 2, inf, 0.0, 2, True, True), (3, 3, 0.0, nan, None, True, False), (4, 4, None, 0.0, 1, None, True)], "edge long, u long, x double, y double, lanes int, oneway boolean, reversed boolean")
    nodes = spark.createDataFrame([(1, 1), (2, 1), (3, 3)], "id long, component long")
    got = sorted(tuple(r) for r in spatial.preflight(edges, nodes).collect())
    assert got == [("bad_coordinate", 2), ("bad_coordinate", 3), ("bad_coordinate", 4), ("conflicting_direction", 2), ("disconnected", 3), ("missing_lanes", 3)]
    assert [tuple(r) for r in spatial.preflight(edges.limit(0), nodes.limit(0)).collect()] == [("empty", None)]


def test_sides_of_movements_and_nan_in_channels(spark):
    from roadlens.functions import lines
    from roadlens.operators import telemetry

    rows = [("right", None, 0.0, "left", "offside"), ("left", None, 0.0, "left", "nearside"), ("right", None, 0.0, "right", "nearside"), ("left;right", None, 20.0, "left", "nearside"), ("through", None, 5.0, "left", None),
            (None, "right", 50.0, "left", "offside"), ("through;right", "left", 50.0, "left", "offside"), (None, None, -20.0, "right", "nearside"), (None, None, 20.0, None, None)]
    df = spark.createDataFrame(rows, "tag string, family string, angle double, driving string, want string")
    side = lines.movement_side(*(F.col(c) for c in ("tag", "family", "angle", "driving")))
    assert df.filter(~side.eqNullSafe(F.col("want"))).count() == 0
    one = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, 9.0), (4, None)], "k int, v double")
    assert tuple(telemetry.agreement(one, one.withColumn("v", F.col("v") / 3), ["k"], "v", 2.0).first()) == (4, 6.0, 1)
