"""Session, shared scratch tables and shipping of the package to Python workers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def get_session(app: str = "roadlens", cpus: str | int = 8, **conf: str) -> SparkSession:
    """A local session with the settings that the tests and the bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers of a local session import this package; clusters use --py-files."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a local one in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and (kept := spark.sparkContext.getCheckpointDir()):
        found = kept
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="roadlens-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._roadlens_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a materialized table that nothing will read again."""
    path = getattr(df, "_roadlens_path", None)
    if path:
        sc = df.sparkSession.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
