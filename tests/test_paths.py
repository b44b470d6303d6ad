import itertools
import random

import pytest

from roadlens.operators import phases, restrictions, vertices

A, B, C, D, X, Z = 1, 2, 3, 4, 24, 26
CASES = {  # name: (kind, vias, moves (from, to, node), status, reason, ways, touched moves)
    "unique": ("no_straight_on", [B], [(A, B, 1), (B, C, 2)], "enforced", "suffix_removed", [], {1}),
    "two lanes at one node": ("no_straight_on", [B], [(A, B, 1), (A, B, 1), (B, C, 2), (B, C, 2)], "enforced", "suffix_removed", [], {2, 3}),
    "branching": ("no_straight_on", [B], [(A, B, 1), (A, B, 9), (B, C, 2)], "review_required", "branching", [], set()),
    "missing": ("no_straight_on", [B], [(A, B, 1)], "review_required", "missing", [], set()),
    "fed": ("no_straight_on", [B], [(A, B, 1), (X, B, 1), (B, C, 2)], "enforced", "prefix_removed", [X], {0}),
    "leads on": ("no_straight_on", [B], [(A, B, 1), (B, C, 2), (B, Z, 2)], "enforced", "suffix_removed", [], {1}),
    "both ends": ("no_straight_on", [B], [(A, B, 1), (X, B, 1), (B, C, 2), (B, Z, 2)], "review_required", "blocked", [X, Z], {2}),
    "two vias": ("no_straight_on", [B, D], [(A, B, 1), (B, D, 2), (D, C, 3), (D, Z, 3)], "enforced", "suffix_removed", [], {2}),
    "two vias, fed": ("no_straight_on", [B, D], [(A, B, 1), (B, D, 2), (D, C, 3), (D, Z, 3), (X, D, 2)], "review_required", "blocked", [X, Z], {2}),
    "middle": ("no_straight_on", [B, D], [(A, B, 1), (B, D, 2), (D, C, 3), (B, Z, 2), (X, D, 2)], "enforced", "prefix_removed", [X], {1}),
    "only": ("only_straight_on", [B], [(A, B, 1), (B, C, 2), (B, Z, 2), (B, X, 7)], "enforced", "exit_kept", [], {2}),
    "other": ("give_way", [B], [(A, B, 1), (B, C, 2)], "review_required", "unsupported", [], set()),
    "no kind": (None, [B], [(A, B, 1), (B, C, 2)], "review_required", "unsupported", [], set()),
    "no via": ("no_straight_on", [], [(A, C, 1)], "review_required", "incomplete", [], set()),
    "null via": ("no_straight_on", None, [(A, C, 1)], "review_required", "incomplete", [], set()),
}


def test_via_way_chains(spark):
    rules, moves = [], []
    for n, (kind, vias, steps, *_) in enumerate(CASES.values()):
        own = lambda w, n=n: n * 100 + w
        rules.append((n, kind, [own(A)], vias and [own(v) for v in vias], [own(C)]))
        moves += [(n * 100 + i, own(a), own(b), own(at)) for i, (a, b, at) in enumerate(steps)]
    rules = spark.createDataFrame(rules, "relation long, kind string, froms array<long>, vias array<long>, tos array<long>")
    moves = spark.createDataFrame(moves, "move long, from_way long, to_way long, node long")
    decisions, touched = restrictions.via_way_chains(rules, moves)
    got, hit = {r.relation: r for r in decisions.collect()}, touched.collect()
    for n, (name, (*_, status, reason, ways, moved)) in enumerate(CASES.items()):
        assert (got[n].status, got[n].reason, [w - n * 100 for w in got[n].ways]) == (status, reason, ways), name
        assert {r.move - n * 100 for r in hit if r.relation == n} == moved, name
        assert {r.action for r in hit if r.relation == n} <= {"hold" if reason == "blocked" else "remove"}, name
    assert restrictions.via_way_chains(rules, moves.limit(0))[1].count() == 0 and restrictions.via_way_chains(rules.limit(0), moves)[0].count() == 0
    more = spark.createDataFrame([(X, B)], "from_way long, to_way long")  # a continuation feeds the via way
    assert restrictions.via_way_chains(rules.filter("relation = 0"), moves, more)[0].first().reason == "prefix_removed"


def _welsh_powell(names, edges):
    near = {n: {b for a, b in edges if a == n} | {a for a, b in edges if b == n} for n in names}
    colour = {}
    for n in sorted(names, key=lambda n: (-len(near[n]), n)):
        taken = {colour[m] for m in near[n] if m in colour}
        colour[n] = next(c for c in itertools.count() if c not in taken)
    return colour


def test_colours_equal_one_after_another(spark):
    random.seed(3)
    groups, conflicts, want = [], [], {}
    for plan, (n, share) in enumerate([(1, 0), (5, 0), (7, 1.0), (20, 0.2), (25, 0.5)]):
        names = [f"g{i:02}" for i in range(n)]
        edges = [e for e in itertools.combinations(names, 2) if random.random() < share]
        groups += [(plan, x, 1 + i % 3, 20.0, 3.0) for i, x in enumerate(names)] + [(plan, None, 1, 1.0, 1.0)]
        conflicts += [(plan, *random.sample(e, 2)) for e in edges for _ in range(2)] + [(plan, "g00", "g00"), (plan, "g00", "unknown"), (plan, None, "g00")]
        want |= {(plan, k): c for k, c in _welsh_powell(names, edges).items()}
    groups = spark.createDataFrame(groups, "plan long, name string, lanes int, green double, yellow double")
    conflicts = spark.createDataFrame(conflicts, "plan long, a string, b string")
    assert {(r.plan, r.name): r.colour for r in phases.colours(groups, conflicts).collect()} == want
    assert phases.colours(groups.limit(0), conflicts).collect() == []
    out = {(r.plan, r.name): r for r in phases.staged(groups, conflicts, 60.0).collect()}
    assert out[0, "g00"].fault == "nothing_to_do" and out[1, "g00"].fault == "no_conflict" and out[1, "g00"].stage is None
    full = sorted((out[2, f"g{i:02}"].stage, out[2, f"g{i:02}"].offset, out[2, f"g{i:02}"].green) for i in range(7))  # seven stages of 8.6 or 8.5 s
    assert [f[1] for f in full] == [0.0, 8.6, 17.1, 25.7, 34.3, 42.9, 51.4] and [f[2] for f in full] == [5.6, 5.5, 5.6, 5.6, 5.6, 5.5, 5.6]
    assert {r.fault for r in phases.staged(groups, conflicts, 7.0).collect()} == {"nothing_to_do", "no_conflict", "full_yellow"}


def _simplify(points, tolerance):
    def split(a, b):
        (ax, ay), (bx, by) = points[a], points[b]
        size = ((bx - ax) ** 2 + (by - ay) ** 2) ** 0.5
        off = [((x - ax) ** 2 + (y - ay) ** 2) ** 0.5 if size < 1e-12 else abs((x - ax) * (-(by - ay) / size) + (y - ay) * ((bx - ax) / size)) for x, y in points[a + 1 : b]]
        if off and max(off) > tolerance:
            m = a + 1 + off.index(max(off))
            return split(a, m) | {m} | split(m, b)
        return set()

    return {0, len(points) - 1} | split(0, len(points) - 1)


@pytest.mark.parametrize("tolerance", [0.005, 3.0])
def test_thinning_equals_the_recursive_form(spark, tolerance):
    random.seed(5)
    lines = {"walk": [(i, random.randint(0, 9)) for i in range(80)], "ring": [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], "flat": [(i, 0.004 * (i % 2)) for i in range(30)], "pair": [(0, 0), (1, 1)], "one": [(2, 2)], "same": [(1, 1)] * 4}
    rows = [(k, 10 * i, float(x), float(y)) for k, ps in lines.items() for i, (x, y) in enumerate(ps)]
    random.shuffle(rows)
    points = spark.createDataFrame(rows, "line string, pos long, x double, y double").repartition(3)
    got = sorted((r.line, r.pos) for r in vertices.thinned(points, tolerance).collect())
    assert got == sorted((k, 10 * i) for k, ps in lines.items() for i in _simplify(ps, tolerance))
    assert vertices.thinned(points.limit(0)).collect() == []


@pytest.mark.parametrize("chunk", [3, 1000])
def test_repeats_are_measured_from_the_last_kept_point(spark, chunk):
    random.seed(6)
    creep = [(0.4 * i, 0.0) for i in range(12)]  # no step is over 1, every third point is kept
    lines = {1: creep, 2: [(0, 0)] * 10, 3: [(random.random() * 3, random.random() * 3) for _ in range(40)], 4: [(5, 5)], 5: [(0, 0), (9, 9), (0, 0)], 2**60: creep}
    want = []
    for k, ps in lines.items():
        last = None
        for i, (x, y) in enumerate(ps):
            if last is None or ((x - last[0]) ** 2 + (y - last[1]) ** 2) ** 0.5 > 1.0:
                want.append((k, i))
                last = (x, y)
    rows = [(k, i, float(x), float(y)) for k, ps in lines.items() for i, (x, y) in enumerate(ps)]
    random.shuffle(rows)
    points = spark.createDataFrame(rows, "line long, pos long, x double, y double")
    assert sorted((r.line, r.pos) for r in vertices.without_repeats(points, 1.0, chunk).collect()) == sorted(want)
    assert [i for k, i in sorted(want) if k == 1] == [0, 3, 6, 9]
    assert vertices.without_repeats(points.limit(0)).collect() == []
