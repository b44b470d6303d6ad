"""URL filters by a sort-merge range join, in DataFrame functions only.

Reversed hosts (``com.example.www.``) turn "this host and all below it" into an interval of keys, and
so does a path prefix. Points and interval ends are put in one order; a sweep over it keeps the stack
of open intervals as a running depth (+1 at a start, -1 at an end), so the innermost open interval at
a point of depth d is the last start that reached depth d. The order is cut into ranges that are swept
at the same time; what is open at the start of a range comes from a small table of one row for each
range and depth. Hosts are swept first, paths under the hosts that have rules second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlens.session import discard, materialize

DEFAULT_VERDICT = "allow"
#: The rules of the registered query.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    """``www.example.com`` as ``com.example.www.``: a host is a prefix of all hosts below it."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _after(raw: Column) -> Column:
    """The least key above all keys with this prefix: its last byte plus 1 (UTF-8 has no byte 255)."""
    size = F.octet_length(raw)
    last = F.conv(F.hex(F.substring(raw, size, F.lit(1))), 16, 10).cast("long")
    return F.concat(F.substring(raw, F.lit(1), size - 1), F.unhex(F.lpad(F.hex(last + 1), 2, "0")))


def innermost(points: DataFrame, intervals: DataFrame, name: str) -> DataFrame:
    """points (key) and intervals (id, lo, hi, nested in each other) to (key or id, owner).

    Rows of points come back as (key, null, owner), those of intervals as (lo, id, owner), where owner
    is the innermost interval that holds the point, or that an interval lies in. ``hi`` null: open end.
    Equal intervals must be made one before. Ties: ends come before starts, outer starts before inner
    ones, starts before points.
    """
    kind = "struct<key:binary,kind:int,size:int,id:string>"
    starts = intervals.select(F.struct(F.col("lo").alias("key"), F.lit(1).alias("kind"), F.octet_length("lo").alias("size"), "id").cast(kind).alias("at"), F.lit(1).alias("step"))
    ends = intervals.filter("hi is not null").select(F.struct(F.col("hi").alias("key"), F.lit(0).alias("kind"), (-F.octet_length("lo")).alias("size"), "id").cast(kind).alias("at"), F.lit(-1).alias("step"))
    seen = points.select(F.struct("key", F.lit(2).alias("kind"), F.lit(0).alias("size"), F.lit(None).alias("id")).cast(kind).alias("at"), F.lit(0).alias("step"))
    spark = points.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    events = starts.unionByName(ends).unionByName(seen)
    # The ranges are fixed once by being written: another run of the sampling could cut elsewhere.
    dealt = materialize(events.repartitionByRange(parts, "at").withColumn("part", F.spark_partition_id()), f"{name}-events")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("part").agg(F.sum("step").alias("net")).select("part", F.coalesce(F.sum("net").over(before), F.lit(0)).alias("base"))
    swept = dealt.join(base, "part").withColumn(
        "depth", (F.col("base") + F.sum("step").over(Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))).cast("int")
    )
    # An interval belongs to the slot one below its own depth when its owner is asked for.
    opened = swept.filter("at.kind = 1")
    last = opened.groupBy("part", "depth").agg(F.max("at").alias("last"))
    until = F.lead("part", 1, parts).over(Window.partitionBy("depth").orderBy("part"))
    carried = (
        last.withColumn("until", until).filter("until > part")
        .select(F.explode(F.sequence(F.col("part") + 1, F.col("until"))).alias("part"), F.col("depth").alias("slot"), F.col("last").alias("carried"))
    )
    asked = swept.filter("at.kind > 0").withColumn("both", F.array(F.struct(F.col("depth").alias("slot"), F.lit(True).alias("own")), F.struct((F.col("depth") - 1).alias("slot"), F.lit(False).alias("own"))))
    # A start is put into its own slot (as what is open) and asks in the slot below; a point asks in its own.
    rows = asked.select("part", "at", F.explode(F.expr("filter(both, x -> at.kind = 1 or x.own)")).alias("s")).select(
        "part", F.col("s.slot").alias("slot"), "at", (F.expr("at.kind = 1") & F.col("s.own")).alias("opens")
    )
    running = Window.partitionBy("part", "slot").orderBy("at", F.desc("opens")).rowsBetween(Window.unboundedPreceding, 0)
    found = (
        rows.withColumn("here", F.last(F.when(F.col("opens"), F.col("at")), ignorenulls=True).over(running))
        .filter("not opens")
        .join(carried, ["part", "slot"], "left")
        .select(F.col("at.key").alias("key"), F.col("at.id").alias("id"), F.when(F.col("slot") > 0, F.coalesce("here.id", "carried.id")).alias("owner"))
    )
    out = materialize(found, f"{name}-found")
    discard(dealt)
    return out


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT_VERDICT, name: str = "url") -> DataFrame:
    """Add host, path, rule and verdict to every row of pages.

    rules (host, path, verdict): a rule fits its host and all hosts below it if the path starts with
    the rule's path; the rule that is longest as ``host || path`` wins, then the one with the longer
    host. Of rules with one host and path, the least verdict counts. Where no rule fits, rule is null
    and the verdict is ``default``. A null url, or one without ``://``, has an empty host and path.
    Rules with a null part are ignored; an empty rules table judges all by default. Pages keep their
    columns, repeated rows and all; columns called host, path, rule or verdict are replaced.
    """
    rules = rules.select("host", "path", "verdict").dropna().groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    rules = rules.withColumn("tail", reversed_host(F.col("host"))).withColumn("rule", F.concat("host", "path"))
    named = pages.drop("host", "path", "rule", "verdict").withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    asked = materialize(named.select("host", "path").distinct().withColumn("tail", reversed_host(F.col("host"))), f"{name}-asked")

    # First sweep: the innermost host with rules for each host, and the one around each host with rules.
    hosts = rules.select(F.col("tail").alias("id"), F.col("tail").cast("binary").alias("lo"), _after(F.col("tail").cast("binary")).alias("hi")).distinct()
    by_host = innermost(asked.select(F.col("tail").cast("binary").alias("key")).distinct(), hosts, f"{name}-hosts")
    # The chain of hosts with rules above a host: its owner's prefixes that have rules.
    inner = by_host.filter("id is null and owner is not null").select(F.col("key").cast("string").alias("tail"), "owner")
    chain = (
        inner.select("owner").distinct()
        .withColumn("ruled", F.explode(F.expr("transform(sequence(1, size(split(owner, '\\\\.', -1)) - 1), i -> concat(array_join(slice(split(owner, '\\\\.', -1), 1, i), '.'), '.'))")))
        .join(hosts.select(F.col("id").alias("ruled")), "ruled", "left_semi")
    )
    level = inner.join(chain, "owner").select("tail", "ruled")

    # Second sweep: the innermost path rule under each of these hosts.
    wanted = asked.join(level, "tail").select("host", "path", "ruled").withColumn("key", _path_key(F.col("ruled"), F.col("path")))
    spans = rules.withColumn("lo", _path_key(F.col("tail"), F.col("path"))).select(F.col("lo").alias("id0"), "lo", "rule", "verdict", "host")
    ids = spans.select(F.hex("lo").alias("id"), "lo", _after(F.col("lo")).alias("hi"))
    by_path = innermost(wanted.select("key").distinct(), ids, f"{name}-paths")
    hits = by_path.filter("id is null and owner is not null").select("key", F.col("owner").alias("id"))
    told = spans.select(F.hex("lo").alias("id"), "rule", "verdict", F.length("host").alias("host_size"))
    best = (
        wanted.join(hits, "key").join(told, "id").groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("size"), "host_size", "rule", "verdict")).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    )
    return named.join(best, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default))).select(*[c for c in named.columns if c not in ("host", "path")], "host", "path", "rule", "verdict")


def _path_key(tail: Column, path: Column) -> Column:
    """Bytes of the reversed host, a zero byte and the path: one host's paths lie together."""
    return F.concat(tail.cast("binary"), F.unhex(F.lit("00")), path.cast("binary"))

