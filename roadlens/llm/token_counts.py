"""Token counts of flat token files without an index, by a scan for separators.

A token file is a run of little-endian unsigned 16-bit ids; each document ends with a separator id.
Files are cut into blocks that are searched at the same time; a prefix scan over one row per block
(separators so far, last separator so far) joins documents that cross block borders.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from roadlens.llm.tokens import SEPARATOR, VOCABULARY, encoder
from roadlens.llm.words import small_batches, trimmed
from roadlens.session import materialize, shared_dir

BLOCK_IDS = 4_000_000


def write_token_files(docs: DataFrame, folder: str | None = None, vocabulary: str = VOCABULARY, separator: int = SEPARATOR) -> DataFrame:
    """Write documents (doc_id, text) as token files, one a task; returns (file, ordinal, doc_id), stored.

    A file's name is drawn anew for each attempt of a task, and only files in the result count, so a
    lost or repeated attempt leaves a file that nobody reads. Null text is empty.
    """
    folder = folder or f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, place, at, out = encoder(vocabulary), None, 0, None
        for batch in batches:
            if out is None:
                where, path = fs.FileSystem.from_uri(folder)
                where.create_dir(path, recursive=True)
                place = f"{folder}/{uuid.uuid4().hex}.u16"
                out = where.open_output_stream(f"{path}/{place.rpartition('/')[2]}")
            for text in batch.column(1):
                ids = np.frombuffer(encode(text.as_py() or ""), "<u4").astype("<u2")
                out.write(ids.tobytes() + separator.to_bytes(2, "little"))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([place] * n, pa.string()), pa.array(range(at, at + n), pa.int64()), batch.column(0)], ["file", "ordinal", "doc_id"])
            at += n
        if out is not None:
            out.close()

    rows = small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(trimmed(write), "file string, ordinal long, doc_id long")
    return materialize(rows, "token-manifest")


def scan(files: DataFrame, separator: int = SEPARATOR, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Token files (file) to one row per document: file, ordinal, start, n_tokens, ended.

    start and n_tokens leave the separator out. Ids after a file's last separator are one more
    document with ended false; an empty file has none. A file named twice is scanned once.
    """

    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file in frame["file"]:
                where, path = fs.FileSystem.from_uri(file)
                n = where.get_file_info(path).size // 2
                yield pd.DataFrame([(file, i, b) for i, b in enumerate(range(0, n, block_ids))], columns=["file", "block", "first"]).assign(n_ids=n)

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, block, first, n_ids in frame.itertuples(index=False):
                where, path = fs.FileSystem.from_uri(file)
                with where.open_input_file(path) as source:
                    source.seek(2 * first)
                    ids = np.frombuffer(source.read(2 * min(block_ids, n_ids - first)), "<u2")
                ends = np.flatnonzero(ids == separator) + first
                starts = np.r_[-1, ends[:-1] + 1] if len(ends) else ends
                yield pd.DataFrame({"file": file, "block": block, "i": np.arange(len(ends)), "start": starts, "end": ends, "n_ids": n_ids})
                # What is left open goes on in the next block; the last block closes it.
                open_ = first + len(ids) == n_ids and (not len(ids) or ids[-1] != separator)
                if open_:
                    yield pd.DataFrame({"file": [file], "block": [block], "i": [len(ends)], "start": [ends[-1] + 1 if len(ends) else -1], "end": [-1], "n_ids": [n_ids]})

    cut = files.select("file").distinct().mapInPandas(blocks, "file string, block long, first long, n_ids long")
    parts = max(8, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = materialize(cut.repartition(parts, "file", "block").mapInPandas(search, "file string, block long, i long, start long, end long, n_ids long"), "token-scan")
    ended = F.col("end") >= 0
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        found.groupBy("file", "block").agg(F.count_if(ended).alias("n"), F.max("end").alias("last"))
        .select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.coalesce(F.max("last").over(before), F.lit(-1)).alias("before"))
    )
    start = F.when(F.col("start") < 0, F.col("before") + 1).otherwise(F.col("start"))
    return found.join(sums, ["file", "block"]).select(
        "file", (F.col("base") + F.col("i")).alias("ordinal"), start.alias("start"), (F.when(ended, F.col("end")).otherwise(F.col("n_ids")) - start).alias("n_tokens"), ended.alias("ended")
    )


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Write documents as token files and count them by a scan: doc_id, n_tokens, file, start.

    Null and empty texts have no tokens. The separator's string inside a text is ordinary text, so it
    never ends a document early. Rows that repeat a doc_id, null included, are counted each on its own;
    a very long text spans blocks. Extra columns are left out. No rows give no rows.
    """
    manifest = write_token_files(docs, vocabulary=vocabulary)
    return manifest.join(scan(manifest.select("file")), ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "start")
