"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of each run of ``window - gram + 1`` consecutive k-gram hashes the least is kept, so every shared span
of ``window`` words holds a kept hash in both texts. Kept hashes of documents are joined with those of
items; each hit is extended word by word to both sides, and a run of ``window`` equal words or more is
a hit of all its words. Items of fewer words are one window each and are joined whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadlens.llm.words import Scratch
from roadlens.session import materialize

WINDOW, GRAM = 10, 5
#: A join side of at most so many rows of under 200 bytes is broadcast; larger ones are shuffled.
BROADCAST_ROWS = 200_000
#: Low bits of a kept hash are its position: texts of up to 2^28 words.
POSITION = (1 << 28) - 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null has none."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(parts, lambda w: w != "")


def _gram(hashes: str, size: int) -> str:
    """SQL for the hash of the run of ``size`` words of an array of word hashes that starts at i."""
    return f"xxhash64({', '.join(f'{hashes}[i + {j}]' if j else f'{hashes}[i]' for j in range(size))})"


def _winnowed(hashes: str, window: int, gram: int) -> str:
    """SQL for the kept grams of an array of at least ``window`` word hashes: hash above, position below.

    The least number of a run of grams is the least hash, leftmost of ties; a gram is kept once.
    """
    run = window - gram + 1
    grams = f"transform(sequence(0, size({hashes}) - {gram}), i -> ({_gram(hashes, gram)} & ~{POSITION}L) | i)"
    if run == 1:
        return grams
    cells = ", ".join(f"g[i + {j}]" if j else "g[i]" for j in range(run))
    least = f"array_distinct(transform(sequence(0, size(g) - {run}), i -> least({cells})))"
    return f"flatten(transform(array({grams}), g -> {least}))"


def _small(df: DataFrame, weight: Column | None = None) -> DataFrame:
    """Broadcast a stored table if a count shows that it is small; ``weight`` is what a row counts for."""
    if df.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return df
    if weight is not None and (df.agg(F.sum(weight)).first()[0] or 0) > BROADCAST_ROWS:
        return df
    return F.broadcast(df)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM, name: str = "decon") -> DataFrame:
    """docs (doc_id, text) and items (item_id, text) to one row per row of docs: doc_id, n_words, n_hit, items.

    n_hit counts document words inside an occurrence of an item's window (``window`` consecutive words;
    all words of an item that has fewer, but not none); items lists, sorted as strings, the items with
    occurring windows. Null or empty texts have no words. Items with a null id are compared, but not
    listed. Rows of docs that repeat a doc_id and text each get the same result, a null doc_id included.
    A very long text is one row all along; its words must fit into one array. Extra columns are left
    out. No rows give no rows, no items give no hits.
    """
    keyed = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("key", F.struct("doc_id", F.xxhash64("text").alias("h")))
    hashes = lambda text: F.transform(words_of(text), lambda w: F.xxhash64(w))

    scratch = Scratch(name)
    asked = scratch(items.select(F.col("item_id").cast("string").alias("item_id"), hashes(F.col("text").cast("string")).alias("w")).distinct(), "items")
    side = window - gram
    long_ = asked.filter(F.size("w") >= window).withColumn("k", F.explode_outer(F.expr(_winnowed("w", window, gram))))
    at = (F.col("k").bitwiseAND(F.lit(POSITION))).cast("int")
    prints = long_.select("item_id", F.expr(f"k & ~{POSITION}L").alias("h"), *_sides("w", at, gram, side)).groupBy("h", "before", "after").agg(F.collect_set(F.struct("item_id")).alias("own"))
    # Items that share a passage are compared as one; in a struct a null id stays.
    prints = scratch(prints, "prints")
    short = asked.filter((F.size("w") > 0) & (F.size("w") < window))
    sizes = sorted(r["n"] for r in short.select(F.size("w").alias("n")).distinct().collect())  # at most window - 1 rows

    # The one scan of all texts: words and kept hashes. Of the stored arrays, those that an item has.
    kept = keyed.withColumn("w", hashes(F.col("text"))).select("doc_id", "key", F.size("w").alias("n_words"), F.expr(f"if(size(w) >= {window}, {_winnowed('w', window, gram)}, cast(null as array<bigint>))").alias("kept"))
    kept = materialize(kept, f"{name}-kept")
    known = _small(scratch(prints.select("h").distinct(), "known"))
    hits = kept.select("key", F.explode("kept").alias("k")).withColumn("h", F.expr(f"k & ~{POSITION}L")).join(known, "h", "left_semi")
    at = scratch(hits.groupBy("key").agg(F.collect_set(F.struct((F.col("k").bitwiseAND(F.lit(POSITION))).cast("int").alias("p"), "h")).alias("at")), "hits")
    there = keyed.select("key", "text").join(_small(at, F.size("at")), "key").dropDuplicates(["key"]).withColumn("w", hashes(F.col("text")))
    around = there.withColumn("a", F.explode_outer(F.transform("at", lambda a: F.struct(a["p"].alias("p"), a["h"].alias("h"), *_sides("w", a["p"], gram, side)))))
    met = around.select("key", "a.*").join(_small(prints, F.size("own")).withColumnsRenamed({"before": "before_i", "after": "after_i"}), "h")
    back, on = _matches("before", "before_i", side), _matches("after", "after_i", side)
    spans = met.withColumn("back", back).withColumn("on", on).filter(F.col("back") + F.col("on") + gram >= window)
    spans = spans.select("key", F.inline("own"), (F.col("p") - F.col("back")).alias("start"), (F.col("p") + gram + F.col("on")).alias("end"))
    for n in sizes:
        whole = short.filter(F.size("w") == n).select("item_id", F.expr(f"transform(array(0), i -> {_gram('w', n)})[0]").alias("h"))
        whole = scratch(whole.distinct(), "short")
        runs = keyed.withColumn("w", hashes(F.col("text"))).select("key", F.posexplode_outer(F.expr(f"if(size(w) >= {n}, transform(sequence(0, size(w) - {n}), i -> {_gram('w', n)}), null)")).alias("p", "h"))
        spans = spans.unionByName(runs.join(_small(whole), "h").select("key", "item_id", F.col("p").alias("start"), (F.col("p") + n).alias("end")))

    spans = materialize(spans.distinct(), f"{name}-spans")
    scratch.clear()
    # What is left of the one scan is read for its counts only.
    listed = spans.select("key", "item_id").distinct().groupBy("key").agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    # Words covered by any span: spans sorted by start, each adds what lies beyond all before it.
    covered = spans.select("key", "start", "end").distinct().groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("s"))
    covered = covered.select(
        "key",
        F.aggregate("s", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")), lambda t, x: F.struct((t["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], t["to"]))).alias("n"), F.greatest(t["to"], x["end"]).alias("to")))["n"].alias("n_hit"),
    )
    found = covered.join(listed, "key")
    return kept.select("doc_id", "key", "n_words").join(found, "key", "left").select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _sides(words: str, at: Column, gram: int, side: int) -> list[Column]:
    """Up to ``side`` word hashes before (nearest first) and after a k-gram."""
    w = F.col(words)
    size = F.least(at, F.lit(side))
    return [
        F.reverse(F.slice(w, at - size + 1, size)).alias("before"),
        F.slice(w, at + gram + 1, F.lit(side)).alias("after"),
    ]


def _matches(a: str, b: str, side: int) -> Column:
    """How many words in a row are equal, nearest first."""
    total, so_far = F.lit(0), F.lit(True)
    for i in range(side):
        x, y = F.try_element_at(F.col(a), F.lit(i + 1)), F.try_element_at(F.col(b), F.lit(i + 1))
        so_far = so_far & F.coalesce(x == y, F.lit(False))
        total = total + so_far.cast("int")
    return total
