"""Directed graphs against brute force."""

import heapq
import random
import statistics

import pytest

from roadlens.operators import directed


def descendants(n, edges):
    out = {i: {b for a, b in edges if a == i} for i in n}
    reach = {}
    for v in n:
        seen, todo = set(), [v]
        while todo:
            for w in out.get(todo.pop(), ()):
                if w in out and w not in seen:
                    seen.add(w)
                    todo.append(w)
        reach[v] = seen
    return reach


@pytest.mark.parametrize("seed", [1])
def test_components_and_reach_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    n = list(range(60))
    # A ring, a chain, loose vertices and random edges, some to ids that aren't vertices.
    edges = [(i, (i + 1) % 5) for i in range(5)] + [(i, i + 1) for i in range(20, 25)] + [(rng.choice(n), rng.choice(n)) for _ in range(60)] + [(3, 3), (7, 999), (998, 2)]
    reach = descendants(n, edges)
    v = spark.createDataFrame([(i,) for i in n], "id long")
    e = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r for r in directed.reach_counts(v, e).collect()}
    own = {i: max({i} | {w for w in reach[i] if i in reach[w]}) for i in n}
    assert {i: r.component for i, r in got.items()} == own
    assert {i: r.reach for i, r in got.items()} == {i: len(reach[i] - {i}) for i in n}
    facts = directed.reach_facts(spark.createDataFrame(list(got.values()))).first()
    counts = {i: len(reach[i] - {i}) for i in n}
    best = max(counts.items(), key=lambda c: (c[1], c[0]))
    sizes = [list(own.values()).count(c) for c in set(own.values())]
    assert (facts.best_start, facts.best_start_reaches, facts.median_reach) == (*best, statistics.median(counts.values()))
    assert (facts.reaching_nothing, facts.reachable_pairs, facts.possible_pairs) == (list(counts.values()).count(0), sum(counts.values()), 60 * 59)
    assert (facts.components, facts.largest) == (len(sizes), max(sizes))


def test_reach_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(directed, "BLOCK_WORDS", 1)
    n = list(range(150))
    edges = [(i, i + 1) for i in range(0, 149, 3)] + [(i, i + 3) for i in range(0, 60, 3)]
    reach = descendants(n, edges)
    v, e = spark.createDataFrame([(i,) for i in n], "id long"), spark.createDataFrame(edges, "a long, b long")
    assert {r.id: r.reach for r in directed.reach_counts(v, e).collect()} == {i: len(reach[i]) for i in n}


@pytest.mark.parametrize("most", [0, 2, 1024])
def test_reach_beside_hubs(spark, monkeypatch, most):
    """Rings in a row and apart, with chains and forks in front, behind and past them; over ``most`` pairs go by blocks."""
    monkeypatch.setattr(directed, "MAX_PAIRS", most)
    monkeypatch.setattr(directed, "BLOCK_WORDS", 1)
    rng = random.Random(4)
    rings = [(0, 12), (20, 8), (30, 12), (50, 3)]
    edges = [(s + i, s + (i + 1) % k) for s, k in rings for i in range(k)] + [(3, 21), (22, 51), (14, 1), (13, 14), (13, 35), (15, 16), (16, 2), (16, 18), (52, 60), (60, 61)]
    n = list(range(140))
    edges += [(a, b) for a, b in ((rng.randrange(60, 140), rng.randrange(60, 140)) for _ in range(70)) if a < b] + [(rng.randrange(60, 100), rng.choice([5, 33, 25])) for _ in range(12)]
    reach = descendants(n, edges)
    v, e = spark.createDataFrame([(i,) for i in n], "id long"), spark.createDataFrame(edges, "a long, b long")
    own = {i: max({i} | {w for w in reach[i] if i in reach[w]}) for i in n}
    got = {r.id: (r.component, r.size, r.reach) for r in directed.reach_counts(v, e).collect()}
    assert got == {i: (own[i], list(own.values()).count(own[i]), len(reach[i] - {i})) for i in n}


def test_reach_around_a_hub_takes_no_block(spark, monkeypatch):
    """Work doesn't grow by a flood for each 64 * ``BLOCK_WORDS`` components where most of them lead to one hub or away from it."""
    monkeypatch.setattr(directed, "BLOCK_WORDS", 1)
    made, write = [], directed.materialize
    monkeypatch.setattr(directed, "materialize", lambda df, name: (made.append(name), write(df, name))[1])
    ring, n = 10, 410
    edges = [(i, (i + 1) % ring) for i in range(ring)] + [(i, i % ring) for i in range(ring, 200)] + [(i % ring, i) for i in range(200, 400)] + [(15, 300), (401, 402)]
    v, e = spark.createDataFrame([(i,) for i in range(n)], "id long"), spark.createDataFrame(edges, "a long, b long")
    got = {r.id: (r.size, r.reach) for r in directed.reach_counts(v, e).collect()}
    want = {i: (10, 209) if i < ring else (1, 210) if i < 200 else (1, 0) for i in range(n)} | {401: (1, 1)}
    assert got == want
    assert not [x for x in made if x.endswith("-bits")] and len(made) < 40


def test_facts_of_copies_in_few_rounds(spark, monkeypatch):
    """Copies apart from each other are settled together: as many tables as for one of them, and facts that equal brute force."""
    made, write = [], directed.materialize
    monkeypatch.setattr(directed, "BLOCK_WORDS", 1)
    monkeypatch.setattr(directed, "materialize", lambda df, name: (made.append(name), write(df, name))[1])
    one = [(i, (i + 1) % 9) for i in range(9)] + [(i, i % 9) for i in range(9, 40)] + [(i % 9, i) for i in range(40, 80)] + [(41, 80), (80, 81), (81, 80), (81, 82), (12, 11)]
    n, tables = 84, []
    for copies in (1, 5):
        edges = [(a + n * k, b + n * k) for k in range(copies) for a, b in one]
        reach = {v: len(w - {v}) for v, w in descendants(range(n * copies), edges).items()}
        v, e = spark.createDataFrame([(i,) for i in range(n * copies)], "id long"), spark.createDataFrame(edges, "a long, b long")
        made.clear()
        got = directed.reach_facts(directed.reach_counts(v, e)).first()
        tables.append(len(made))
        assert (got.best_start, got.best_start_reaches) == max(reach.items(), key=lambda c: (c[1], c[0]))
        assert (got.median_reach, got.reaching_nothing, got.reachable_pairs) == (statistics.median(reach.values()), list(reach.values()).count(0), sum(reach.values()))
        assert (got.components, got.largest) == (copies * (n - 8 - 1), 9)
    assert tables[0] == tables[1] < 45


def test_no_vertices(spark):
    v, e = spark.createDataFrame([], "id long"), spark.createDataFrame([(1, 2)], "a long, b long")
    assert directed.strong_components(v, e).count() == 0
    got = directed.reach_facts(directed.reach_counts(v, e)).first()
    assert (got.components, got.largest, got.median_reach, got.reachable_pairs) == (0, 0, 0.0, 0)


def dijkstra(lengths, exits, changes, start, end):
    """(cost, lanes) with the least lane before each on ties."""
    cost = {}
    for a, b in changes:
        cost[a, b] = (lengths[b] / 2 + directed.LANE_CHANGE_M, True)
    for a, b in exits:
        cost[a, b] = (lengths[b], False)
    best, prev, todo = {start: 0.0}, {}, [(0.0, start)]
    while todo:
        c, v = heapq.heappop(todo)
        if c > best[v]:
            continue
        for (a, b), (w, _) in cost.items():
            if a == v and (b not in best or c + w < best[b] or (c + w == best[b] and b in prev and v < prev[b])):
                if b not in best or c + w < best[b]:
                    heapq.heappush(todo, (c + w, b))
                best[b], prev[b] = c + w, v
    if end not in best:
        return None
    chain = [end]
    while chain[0] != start:
        chain.insert(0, prev[chain[0]])
    return best[end], chain, [i for i, (a, b) in enumerate(zip(chain, chain[1:]), 1) if cost[a, b][1]]


@pytest.mark.parametrize("step", [7.0, 1000.0])
def test_drives_equal_dijkstra(spark, step):
    rng = random.Random(9)
    lanes = {i: rng.choice([10.0, 20.0, 35.5, 80.25]) for i in range(40)}
    exits = {(rng.randrange(40), rng.randrange(40)) for _ in range(110)}  # dense enough that most routes have a drive
    exits = {(a, b) for a, b in exits if a != b}
    changes = {(a, a ^ 1) for a in range(0, 40, 3)}
    routes = [(r, rng.randrange(40), rng.randrange(40)) for r in range(25)] + [(100, 5, 5), (101, 77, 3), (102, 3, 77)]
    ln = spark.createDataFrame(list(lanes.items()), "id long, length double")
    pair = lambda p: spark.createDataFrame(sorted(p), "a long, b long")
    edges = directed.drive_edges(ln, pair(exits), pair(changes))
    got = {r.route: r for r in directed.shortest_drives(spark.createDataFrame(routes, "route long, start long, end long"), edges, ln, step).collect()}
    assert len(got) == len(routes)
    assert (got[100].fault, got[101].fault, got[102].fault) == ("same_lane", "unknown_start", "unknown_end")
    some = 0
    for route, start, end in routes[:25]:
        want = dijkstra(lanes, exits, changes, start, end) if start != end else None
        r = got[route]
        if want is None:
            assert r.fault == ("same_lane" if start == end else "no_drive") and r.lanes is None
        else:
            some += 1
            assert (r.fault, r.cost, r.lanes, r.changes) == (None, *want)
    assert some > 8


def test_lane_change_costs_half_a_lane_and_five_metres(spark):
    ln = spark.createDataFrame([(1, 10.0), (2, 30.0)], "id long, length double")
    edge = spark.createDataFrame([(1, 2)], "a long, b long")
    assert directed.drive_edges(ln, edge.limit(0), edge).first().cost == 20.0
    assert directed.drive_edges(ln, edge, edge).first().cost == 30.0  # an exit comes first


def test_numbers_in_order(spark):
    df = spark.range(1000).selectExpr("id", "(id * 7919) % 1000 as k")
    assert all(r.number == r.k for r in directed.numbered(df, ["k"]).collect())
