import random

from pyspark.sql import functions as F

from roadlens.functions import geo, tags
from roadlens.operators import roads, telemetry, tracks
from roadlens.operators.components import components
from roadlens.sources import osm
from roadlens.streaming import telemetry as live


def test_components_by_brute_force(spark):
    random.seed(3)
    for n, m in ((40, 25), (200, 150), (60, 200)):
        edges = [(random.randrange(n), random.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(500, 540)]
        root = {}
        find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
        for a, b in edges:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
        want = {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}
        got = {r.id: r.component for r in components(spark.createDataFrame(edges + [(None, 1)], "a long, b long")).collect()}
        assert got == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_exclusion_reasons(spark):
    rows = [({"highway": "primary"}, None), ({}, "not_a_highway"), ({"highway": "footway"}, "highway=footway"), ({"highway": "road", "area": "yes"}, "area=yes"), ({"highway": "road", "vehicle": "private"}, "vehicle=private")]
    out = spark.createDataFrame(rows, "tags map<string,string>, want string").select(tags.exclusion_reason(F.col("tags")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in out)


def test_projection_round_trip_and_lights(spark):
    row = spark.range(1).select(
        geo.unproject(*(geo.project(F.lit(24.5), F.lit(54.4), F.lit(24.4), F.lit(54.3))[c] for c in ("x", "y")), F.lit(24.4), F.lit(54.3)).alias("b"),
        geo.light_colour(F.lit(61.0), F.lit(0.0), F.lit(60.0), F.lit(20.0), F.lit(3.0)).alias("c"),
        geo.green_overlap(F.lit(50.0), F.lit(20.0), F.lit(0.0), F.lit(15.0), F.lit(60.0)).alias("o"),
        tags.movement_class(F.lit(-50.0)).alias("m"),
    ).first()
    assert abs(row.b.lat - 24.5) < 1e-9 and abs(row.b.lon - 54.4) < 1e-9
    assert (row.c, row.o, row.m) == ("green", 10.0, "slight_right")


def test_speed_bound_equals_sequential_passes(spark):
    random.seed(1)
    s, caps = [0.0], [random.uniform(1, 15)]
    for _ in range(200):
        s.append(s[-1] + random.uniform(0.1, 3))
        caps.append(random.uniform(1, 15))
    v = [c * c for c in caps]
    for i in range(1, len(v)):
        v[i] = min(v[i], v[i - 1] + 3.0 * (s[i] - s[i - 1]))
    for i in range(len(v) - 2, -1, -1):
        v[i] = min(v[i], v[i + 1] + 4.0 * (s[i + 1] - s[i]))
    df = spark.createDataFrame([(1, i, a, c) for i, (a, c) in enumerate(zip(s, caps))], "k int, i int, along double, cap double")
    got = [r.speed for r in tracks.bounded_speed(df, ["k"], ["i"], "along", "cap", 1.5, 2.0).orderBy("i").collect()]
    assert max(abs(a - b**0.5) for a, b in zip(got, v)) < 1e-9


def test_as_of_takes_the_last_earlier_row(spark):
    left = spark.createDataFrame([(1, 5), (1, 10), (2, 1)], "k int, t int")
    right = spark.createDataFrame([(1, 5, "a", 0), (1, 5, "b", 1), (1, 9, None, 2)], "k int, t int, v string, n int")
    got = {(r.k, r.t): r.v_as_of for r in telemetry.as_of(left, right, ["k"], "t", "v", ["n"]).collect()}
    assert got == {(1, 5): "b", (1, 10): "b", (2, 1): None}


def test_flood_counts_hops(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1)], "u long, v long")
    hops = lambda up: {r.id: r.hops for r in roads.flood(pairs, spark.createDataFrame([(1,)], "id long"), up).collect()}
    assert hops(False) == {1: 0, 2: 1, 3: 2} and hops(True) == {1: 0, 3: 1, 4: 1, 2: 2}


def test_osm_reader(spark, tmp_path):
    (tmp_path / "a.osm").write_text(
        '<osm><node id="1" lat="1.5" lon="2"><tag k="highway" v="traffic_signals"/></node><node id="2" lat="1" lon="2" action="delete"/><node lat="0" lon="0"/>'
        '<way id="7"><nd ref="1"/><nd ref="2"/><nd ref="1"/></way><relation id="9"><member type="way" ref="7" role="from"/></relation></osm>'
    )
    kinds = {k: osm.read_osm(spark, str(tmp_path / "a.osm"), k) for k in ("node", "way", "relation")}
    assert {r.id: (r.lat, r.deleted, r.tags) for r in kinds["node"].collect()} == {"1": (1.5, False, {"highway": "traffic_signals"}), "2": (1.0, True, {})}
    assert kinds["way"].first().node_ids == ["1", "2", "1"] and kinds["relation"].first().members[0].role == "from"
    assert [(r.kind, r.ids) for r in osm.deleted_report(kinds).collect()] == [("node", ["2"])]


def test_stream_rates_equal_batch(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(2).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    stamped = lambda df: df.withColumn("ts", F.col("ts").cast("timestamp"))
    query = live.channel_rates(stamped(source), "ts", ["event_type"], "1 hour").writeStream.outputMode("complete").format("memory").queryName("rates").start()
    query.processAllAvailable()
    query.stop()
    batch = stamped(spark.read.parquet(str(tmp_path / "in"))).groupBy(F.window("ts", "1 hour"), "event_type").count()
    want = {(r.window.start, r.event_type, r["count"]) for r in batch.collect()}
    assert {(r.start, r.event_type, r.n) for r in spark.table("rates").collect()} == want
