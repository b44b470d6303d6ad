"""The driver's tables in the shapes that operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlens.operators.roads import ordered_nodes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def way_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, l_partkey, pos, n_nodes); ties of a line number go by supplier, part and price."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity")
    return ordered_nodes(items, "l_orderkey", "l_partkey", ["l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity"])


def way_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a tag map made of their columns."""
    kind = F.element_at(F.array(*map(F.lit, ["primary", "residential", "footway", "service", "tertiary"])), F.substring("o_orderpriority", 1, 1).cast("int"))
    tags = F.map_filter(
        F.create_map(
            F.lit("highway"), kind, F.lit("lanes"), (F.col("o_custkey") % 4).cast("string"), F.lit("oneway"), F.when(F.col("o_orderstatus") == "F", "yes").when(F.col("o_orderstatus") == "P", "-1"),
            F.lit("access"), F.when(F.col("o_custkey") % 11 == 0, "private"), F.lit("lanes:forward"), F.when(F.col("o_custkey") % 7 == 0, "2"),
        ),
        lambda k, v: v.isNotNull(),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", tags.alias("tags"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their stamp in microseconds."""
    return table(spark, sf_dir, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))


NODES_SQL = """
nodes AS (
  SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_extendedprice, l_quantity, l_partkey) - 1 AS pos,
    count(*) OVER (PARTITION BY l_orderkey) AS n_nodes FROM lineitem
)"""
TAGS_SQL = """
tags AS (
  SELECT o_orderkey, o_custkey, (['primary', 'residential', 'footway', 'service', 'tertiary'])[CAST(substr(o_orderpriority, 1, 1) AS INT)] AS highway,
    o_custkey % 4 AS lanes, CASE o_orderstatus WHEN 'F' THEN 'yes' WHEN 'P' THEN '-1' END AS oneway,
    CASE WHEN o_custkey % 11 = 0 THEN 'private' END AS access, CASE WHEN o_custkey % 7 = 0 THEN '2' END AS forward FROM orders
)"""
