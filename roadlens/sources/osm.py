"""Readers of map extracts, rate sets and artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_TAG = "tag ARRAY<STRUCT<_k:STRING,_v:STRING>>"
_HEAD = "_id STRING, _action STRING, _visible STRING"
SCHEMAS = {
    "node": f"{_HEAD}, _lat DOUBLE, _lon DOUBLE, {_TAG}",
    "way": f"{_HEAD}, nd ARRAY<STRUCT<_ref:STRING>>, {_TAG}",
    "relation": f"{_HEAD}, member ARRAY<STRUCT<_type:STRING,_ref:STRING,_role:STRING>>, {_TAG}",
}


def read_osm(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Nodes, ways or relations of OSM XML; elements without an id are skipped, deleted ones are marked."""
    raw = spark.read.format("xml").option("rowTag", kind).schema(SCHEMAS[kind]).load(path).filter("_id is not null")
    tags = F.map_from_entries(F.transform(F.coalesce("tag", F.array().cast("array<struct<_k:string,_v:string>>")), lambda t: F.struct(t["_k"], t["_v"])))
    gone = F.coalesce(F.col("_action") == "delete", F.lit(False)) | F.coalesce(F.col("_visible") == "false", F.lit(False))
    own = {
        "node": [F.col("_lat").alias("lat"), F.col("_lon").alias("lon")],
        "way": [F.transform("nd", lambda n: n["_ref"]).alias("node_ids")],
        "relation": [F.transform("member", lambda m: F.struct(m["_type"].alias("type"), m["_ref"].alias("ref"), m["_role"].alias("role"))).alias("members")],
    }[kind]
    return raw.select(F.col("_id").alias("id"), *own, gone.alias("deleted"), tags.alias("tags"))


def deleted_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Ids of deleted elements by kind, sorted."""
    rows = None
    for kind, df in tables.items():
        own = df.filter("deleted").select(F.lit(kind).alias("kind"), "id")
        rows = own if rows is None else rows.unionByName(own)
    return rows.groupBy("kind").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and sha256 of every file."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def rate_sets(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows of name,step_hz,decision_hz,physics_hz and the refused rows; # starts a comment."""
    raw = spark.read.option("header", True).option("comment", "#").schema("name string, step_hz string, decision_hz string, physics_hz string").csv(path)
    numbers = {c: F.col(c).try_cast("double") for c in ("step_hz", "decision_hz", "physics_hz")}
    bad = F.col("step_hz").isNull() | numbers["step_hz"].isNull()
    for c in ("decision_hz", "physics_hz"):
        bad = bad | (F.col(c).isNotNull() & numbers[c].isNull())
    name = F.coalesce("name", F.concat(F.col("step_hz"), F.lit("Hz")))
    return raw.filter(~bad).withColumns(numbers).withColumn("name", name), raw.filter(bad)
