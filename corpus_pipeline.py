"""The corpus pipeline: language, near-duplicates, long repeats, benchmarks, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlens.llm import decontaminate, language, minhash, packing, suffix_dedup
from roadlens.session import materialize, ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
PASSAGE = 51  # words: a passage of over 50 that documents share is cut, however short its words are
ORACLE_SQL = None  # the stages are not SQL; tests hold each against a brute-force version


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language the evidence rejects; lang becomes the language found.

    The text model is fitted on a bounded sample of the documents that carry a language.
    """
    model = language.fit_text_model(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    found = language.identify(docs, model, declared="lang", host="source")
    return found.filter("not rejected").withColumn("lang", F.col("detected")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group (five words, similarity 0.8 or more): the least id, null ids last.

    Every row takes part under a number of its own, so repeated rows and null ids are grouped by their
    texts as others are. Rows without a word are one group if they share doc_id and text.
    """
    rows = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "p-minhash-rows")
    found = minhash.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), name="p-minhash")
    found = found.select(F.col("doc_id").alias("_row"), "n_shingles", "component_id")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64(*docs.columns).alias("tie"), "_row")
    named = rows.select("_row", first.alias("first"), F.struct("doc_id", F.xxhash64("text").alias("h")).alias("same")).join(found, "_row")
    group = [F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("near"), F.when(F.col("n_shingles") == 0, F.col("same")).alias("same")]
    named = materialize(named.select("_row", "first", *group), "p-minhash-named")
    kept = named.groupBy("near", "same").agg(F.min("first").alias("first")).select("first._row")
    dropped = named.select("_row").join(kept, "_row", "left_anti")
    return rows.join(dropped, "_row", "left_anti").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut long repeated passages out of the texts; a text of which no word is left goes.

    Long is 400 bytes, as in op10, wherever else they occur, or ``PASSAGE`` words of another document.
    """
    found = suffix_dedup.remove_repeats(docs, name="p-suffix", words=PASSAGE)
    left = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    found = found.withColumn("left", left)
    return (
        found.filter(F.expr("n_removed = 0") | F.col("left").rlike(r"\S"))
        .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("left").cast("long")).otherwise(F.col("n_chars"))).withColumn("text", F.col("left"))
        .select(*docs.columns)
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows that hold a benchmark window of ten words; others that share their id stay."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    # A struct equals another with a null in the same place, so rows without an id are found as well.
    rows = docs.withColumn("_row", F.struct("doc_id", F.xxhash64("text").alias("h")))
    found = decontaminate.contamination(rows.select(F.col("_row").alias("doc_id"), "text"), items, name="p-decon")
    hit = found.filter("n_hit > 0").select(F.col("doc_id").alias("_row"))
    return rows.join(hit, "_row", "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 1,024 tokens."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("language_id", identify_language),
    ("minhash_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written and read again before the next."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
