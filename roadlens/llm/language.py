"""Language identification by Bayesian fusion of evidence.

Evidence for a row: how likely each language makes its text (byte trigrams, smoothed counts of a
bounded labelled sample), the language that its markup declares, the suffix of its address, and a
prior of its host. Host priors are grouped counts of the languages that the text alone gives, smoothed
from the host to its domain, from there to the top-level domain, and from there to all rows. What a
declaration or a suffix says of a language, whatever its value, is counted over all rows in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from roadlens.llm.words import CHUNK_BYTES, mix, small_batches, text_chunks, trimmed
from roadlens.session import materialize

#: Rows of each language that the text model is fitted on, about; whole texts of these rows.
SAMPLE_ROWS = 500
BUCKETS = 1 << 15
SMOOTHING = 0.5
PRIOR_WEIGHT = 10.0
#: What is kept on the driver for the text model: languages x buckets of float32, for at most so many languages.
MOST_LANGUAGES = 1000
#: Trigrams beyond so many add no certainty: neighbouring ones depend on each other.
TRUSTED_GRAMS = 200
#: A text whose best language explains a trigram worse than this (mean log ratio to even odds) is rejected.
LEAST_RATIO = 0.0
#: Priors of at most so many hosts (under 100 bytes each) are broadcast.
BROADCAST_ROWS = 200_000
LEAST_CONFIDENCE = 0.5

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[*range(0, 65), *range(91, 97), *range(123, 128)]] = 32


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram at each byte, letters folded and all else blank; which of them count."""
    folded = _FOLD[data].astype(np.uint64)
    n = max(0, len(folded) - 2)
    code = folded[:n] << np.uint64(16) | folded[1 : n + 1] << np.uint64(8) | folded[2 : n + 2]
    use = ~((folded[:n] == 32) & (folded[1 : n + 1] == 32)) & ~((folded[1 : n + 1] == 32) & (folded[2 : n + 2] == 32))
    edge = np.zeros(len(folded) + 3, bool)
    edge[offsets] = True
    use &= ~edge[1 : n + 1] & ~edge[2 : n + 2]
    return (mix(code) & np.uint64(BUCKETS - 1)).astype(np.int64), use


def fit_text_model(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """Labelled rows (id, text, lang) to languages and log-likelihoods [language, bucket].

    About ``sample_rows`` rows of each language are used, chosen by a hash of their id; rows without a
    text or language are not. What comes to the driver is at most languages x buckets counts; labels of
    over ``MOST_LANGUAGES`` values are not languages and are refused.
    """
    rows = small_batches(labelled).select("id", "lang", "text").filter("lang is not null and text is not null")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    if sizes.limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    chosen = rows.join(F.broadcast(sizes), "lang").filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.lit(1_000_000 * sample_rows) / F.col("n"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist())
            for a, b, data, offsets in text_chunks(batch.column(1)):
                bucket, use = _trigrams(data, offsets)
                row = np.searchsorted(offsets, np.arange(len(bucket)), "right") - 1
                for lang in np.unique(langs[a:b]):
                    found = np.bincount(bucket[use & (langs[a:b][row] == lang)], minlength=BUCKETS)
                    at = np.flatnonzero(found)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(found[at], pa.int64())], ["lang", "bucket", "n"])

    counts = chosen.select("lang", "text").mapInArrow(trimmed(count), "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())
    table = np.full((len(langs), BUCKETS), SMOOTHING)
    for i, lang in enumerate(langs):
        own = counts[counts["lang"] == lang]
        table[i, own["bucket"].to_numpy()] += own["n"].to_numpy()
    return langs, np.log(table / table.sum(1, keepdims=True)).astype(np.float32) if langs else table.astype(np.float32)


def score_text(rows: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text") -> DataFrame:
    """Replace a text column by n_grams and mean log ratios to even odds for each language (score).

    Columns that are already named so are replaced.
    """
    rows = small_batches(rows).drop(*{"n_grams", "score"} - {text})
    langs, table = model
    kept = rows.drop(text).schema.fields
    names = [f.name for f in kept]
    even = np.float32(np.log(BUCKETS))

    def sums(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bucket, use = _trigrams(data, offsets)
        at = np.minimum(offsets, len(bucket))
        n = np.diff(np.r_[0, np.cumsum(use)][at])
        score = np.zeros((len(offsets) - 1, len(langs)))
        for i in range(len(langs)):
            score[:, i] = np.diff(np.r_[0.0, np.cumsum(np.where(use, table[i][bucket] + even, 0), dtype="f8")][at])
        return n, score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(batch.num_columns - 1)):
                # A long text is summed over pieces that share two bytes, so that each trigram counts once.
                cuts = range(0, max(1, len(data) - 2), CHUNK_BYTES) if b == a + 1 else [0]
                parts = [sums(data[c : c + CHUNK_BYTES + 2], np.array([0, len(data[c : c + CHUNK_BYTES + 2])])) for c in cuts] if b == a + 1 else [sums(data, offsets)]
                n, score = sum(p[0] for p in parts), sum(p[1] for p in parts)
                score = score / np.maximum(n, 1)[:, None]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i)[a:b] for i in range(batch.num_columns - 1)), pa.array(n, pa.int64()), pa.ListArray.from_arrays(np.arange(b - a + 1, dtype=np.int32) * len(langs), pa.array(score.ravel(), pa.float64()))],
                    [*names, "n_grams", "score"],
                )

    schema = StructType([*kept, StructField("n_grams", LongType()), StructField("score", ArrayType(DoubleType()))])
    return rows.select(*[F.col(f"`{c}`") for c in names], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("_text")).mapInArrow(trimmed(run), schema)


def host_levels(host: Column) -> Column:
    """From all rows to the host: '', top-level domain, domain, host."""
    labels = F.split(F.coalesce(host, F.lit("")), r"\.", -1)
    size = F.size(labels)
    take = lambda n: F.array_join(F.slice(labels, F.greatest(size - n + 1, F.lit(1)), F.least(F.lit(n), size)), ".")
    return F.array(F.lit(""), F.concat(F.lit("1:"), take(1)), F.concat(F.lit("2:"), take(2)), F.concat(F.lit("h:"), F.coalesce(host, F.lit(""))))


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", declared: str | None = None, suffix: str | None = None, host: str | None = None, name: str = "lang") -> DataFrame:
    """Add detected (language or null), confidence, text_ratio and rejected to every row.

    Rows need not have a key; repeated rows each get the same result. A null declaration or suffix, or
    one that no row with a text has, says nothing; a null host is one host. Of languages that are as
    likely the first by name is taken. A null text is empty. A text without
    trigrams has no evidence of its own: it is rejected, as is one that no language explains better than
    even odds, or whose best language is less likely than ``LEAST_CONFIDENCE``. The text column stays;
    columns named as the added ones are replaced, all others stay, whatever their names. A very long
    text is scored in pieces. No rows give no rows.
    """
    langs = model[0]
    added = ("detected", "confidence", "text_ratio", "rejected")
    rows = rows.drop(*added)
    kept = [f"row.`{c}`" for c in rows.columns]
    value = lambda c: F.lower(F.col(f"`{c}`").cast("string")) if c else F.lit(None).cast("string")
    if not langs:
        return rows.select("*", F.lit(None).cast("string").alias("detected"), F.lit(0.0).alias("confidence"), F.lit(0.0).alias("text_ratio"), F.lit(True).alias("rejected"))
    # The row's own columns travel in a struct, so that no name of theirs meets one of ours. Texts are
    # scored twice, once for the counts and once for the result: that needs no shuffle of texts.
    own = [F.col(f"`{text}`").alias("t"), value(declared).alias("declared"), value(suffix).alias("suffix"), F.coalesce(F.col(f"`{host}`").cast("string") if host else F.lit(""), F.lit("")).alias("host")]
    best = F.when(F.col("n_grams") > 0, F.array_position("score", F.array_max("score")).cast("int") - 1)
    sure = score_text(rows.select(*own), model, "t").select("declared", "suffix", "host", best.alias("guess"))
    sure = sure.filter("guess is not null").groupBy("declared", "suffix", "host", "guess").agg(F.count(F.lit(1)).alias("n"))
    sure = materialize(sure, f"{name}-guessed")
    zeros = F.array(*[F.lit(0.0)] * len(langs))

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df

    def counts(df: DataFrame, *by: str) -> DataFrame:
        """How many rows of each language, as an array, for each value of ``by``."""
        each = [F.coalesce(F.sum(F.when(F.col("guess") == i, F.col("n"))), F.lit(0)).cast("double") for i in range(len(langs))]
        return df.groupBy(*by).agg(F.array(*each).alias("counts"))

    def likelihood(column: str) -> DataFrame:
        """log P(column = value | language) for each value, smoothed to the value's share of all rows.

        A value that is a language counts ``PRIOR_WEIGHT`` times for that language beforehand.
        """
        known = materialize(counts(sure.filter(F.col(column).isNotNull()), column), f"{name}-{column}")
        total = known.agg(*(F.coalesce(F.sum(F.col("counts")[i]), F.lit(0.0)) for i in range(len(langs)))).first()  # one row
        rest = sum(total) + PRIOR_WEIGHT
        share = (F.aggregate("counts", F.lit(0.0), lambda s, x: s + x) + PRIOR_WEIGHT / len(langs)) / rest
        said = [(F.col("counts")[i] + PRIOR_WEIGHT * share + F.when(F.col(column) == lang, PRIOR_WEIGHT).otherwise(0.0)) / (total[i] + 2 * PRIOR_WEIGHT) for i, lang in enumerate(langs)]
        return small(materialize(known.select(column, F.array(*[F.log(x) for x in said]).alias(f"{column}_log")), f"{name}-{column}-log"))

    # Counts at each level, then priors from the top down.
    hosts = materialize(counts(sure, "host").withColumn("levels", host_levels(F.col("host"))), f"{name}-hosts")
    prior = hosts.select("host", "levels", F.array(*[F.lit(1.0 / len(langs))] * len(langs)).alias("prior"))
    for level in range(4):
        at = F.col("levels")[level].alias("at")
        sums = hosts.select(at, "counts").groupBy("at").agg(F.array(*[F.sum(F.col("counts")[i]) for i in range(len(langs))]).alias("sums"))
        prior = (
            prior.withColumn("at", at).join(sums, "at").withColumn("total", F.aggregate("sums", F.lit(0.0), lambda s, x: s + x))
            .select("host", "levels", F.zip_with("sums", "prior", lambda n, p: (n + PRIOR_WEIGHT * p) / (F.col("total") + PRIOR_WEIGHT)).alias("prior"))
        )
    prior = materialize(prior.select("host", F.transform("prior", lambda p: F.log(p)).alias("prior")), f"{name}-priors")

    trusted = F.least(F.col("n_grams"), F.lit(TRUSTED_GRAMS))
    even = F.array(*[F.lit(float(-np.log(len(langs))))] * len(langs))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    scored = score_text(rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), *own), model, "t").join(small(prior), "host", "left")
    total = add(F.transform("score", lambda s: s * trusted), F.coalesce("prior", even))
    for column, given in (("declared", declared), ("suffix", suffix)):
        if given:
            scored = scored.join(likelihood(column), column, "left")
            total = add(total, F.coalesce(f"{column}_log", zeros))
    return (
        scored.withColumn("sum", total).withColumn("top", F.array_max("sum"))
        .withColumn("confidence", 1.0 / F.aggregate(F.transform("sum", lambda s: F.exp(s - F.col("top"))), F.lit(0.0), lambda a, b: a + b))
        .withColumn("best", F.array_position("sum", F.col("top")).cast("int") - 1)
        .withColumn("text_ratio", F.col("score")[F.col("best")])
        .withColumn("detected", F.array(*[F.lit(x) for x in langs])[F.col("best")])
        .withColumn("rejected", (F.col("n_grams") == 0) | (F.col("text_ratio") <= LEAST_RATIO) | (F.col("confidence") < LEAST_CONFIDENCE))
        .select(*kept, *added)
    )


def page_evidence(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """Add text, declared, suffix and host to pages: markup's lang and the last label of the address's host.

    Null html is empty; a url without a host has neither suffix nor host; columns named so are replaced.
    """
    body = F.regexp_replace(F.coalesce(F.col(page), F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    host = F.nullif(F.lower(F.regexp_extract(F.col(url), r"://([^/?#:]*)", 1)), F.lit(""))
    suffix = F.nullif(F.regexp_extract(host, r"\.([^.]+)$", 1), F.lit(""))
    declared = F.nullif(F.lower(F.regexp_extract(F.col(page), r"""(?i)<html\b[^>]*\blang\s*=\s*["']?([A-Za-z]{2})""", 1)), F.lit(""))
    return pages.withColumns({"text": body, "declared": declared, "suffix": suffix, "host": host})
