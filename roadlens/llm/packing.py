"""Packing of documents into sequences: best-fit decreasing with a segment tree over free capacity.

Best-fit decreasing looks at sizes only. So the plan is made from a histogram with one row for each
possible length (as many rows as a window has tokens, whatever the corpus), with equal pieces placed
in runs: a run names a range of ranks within a length and the windows they go to. Pieces then get a
rank within their length by a distributed count, and look up their run. Cutting comes first: a
document gives as many full windows as it has, and one rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from roadlens.llm.tokens import VOCABULARY, encoder
from roadlens.llm.words import small_batches, trimmed
from roadlens.session import materialize

WINDOW = 1024
END_ID = 0
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, lot int"


class CapacityTree:
    """A segment tree over capacities 0..size: how many open windows have just this much room."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.total = [0] * (2 * self.leaves)

    def add(self, room: int, n: int) -> None:
        at = room + self.leaves
        while at:
            self.total[at] += n
            at >>= 1

    def tightest(self, need: int) -> int | None:
        """The least room of at least ``need`` that an open window has."""
        at = need + self.leaves
        if self.total[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.total[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.total[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over (length: how many) as runs (length, rank, n, each, sequence, offset).

    The n pieces of this length from this rank on go to windows from ``sequence`` on, ``each`` to a
    window, the first of a window at ``offset``. The result is what placing pieces one by one gives.
    """
    tree, rooms, runs, opened = CapacityTree(window), {}, [], 0

    def put(room: int, first: int, n: int) -> None:
        if n > 0 and room > 0:
            rooms.setdefault(room, []).append((first, n))
            tree.add(room, n)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first = window, opened
                n = -(-left // (window // length))
                opened += n
            else:
                first, n = rooms[room].pop()
                tree.add(room, -n)
            each = room // length
            take = min(left, n * each)
            full, rest = divmod(take, each)
            runs.append((length, rank, take, each, first, window - room))
            put(room - each * length, first, full)
            if rest:
                put(room - rest * length, first + full, 1)
            put(room, first + full + bool(rest), n - full - bool(rest))
            left, rank = left - take, rank + take
    return runs


def pieces(docs: DataFrame, window: int = WINDOW, vocabulary: str = VOCABULARY, lots: int = 64, ids: bool = False) -> DataFrame:
    """(doc_id, text) to one row per piece: full windows, then one rest. Null text is empty.

    Each document ends with id 0, so an empty one has one token. ``lot`` deals the rows of a task out
    evenly, whatever their keys. With ``ids``, the ids come along as little-endian 32-bit bytes.
    """
    schema = PIECE + (", ids binary" if ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, turn = encoder(vocabulary, special=True), TaskContext.get().partitionId()
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            rows = [[] for _ in range(6 + ids)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = encode(text.as_py() or "") + end
                n = len(raw) // 4
                for start in range(0, n, window):
                    part = raw[4 * start : 4 * (start + window)]
                    turn += 1
                    for column, value in zip(rows, (doc_id, start, len(part) // 4, zlib.crc32(part), n, turn % lots, part), strict=False):
                        column.append(value)
            types = [pa.int64()] * 5 + [pa.int32()] + [pa.binary()] * ids
            names = [x.split()[0] for x in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names)

    return small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(trimmed(cut), schema)


def place(cut: DataFrame, window: int = WINDOW, lots: int = 64) -> DataFrame:
    """Add sequence_id and offset to pieces (length, lot); cut must be a stored table.

    Sequence ids run from 0 without gaps; offsets in a sequence are gapless from 0. An empty table
    gives an empty result. A length that a third of all pieces have is ranked in ``lots`` groups.
    """
    spark = cut.sparkSession
    counts = materialize(cut.groupBy("length", "lot").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `window` rows
    runs = spark.createDataFrame(plan(histogram, window) or [], "length long, first long, n long, each long, sequence long, at long")
    before = Window.partitionBy("length").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "lot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "lot").orderBy("doc_id", "start", "ids_crc32")
    ranked = cut.withColumn("rank", F.row_number().over(own) - 1).join(base, ["length", "lot"]).withColumn("rank", F.col("rank") + F.col("base"))
    # Runs are bounded by the window: a length meets each other length's leftovers at most once or so.
    placed = ranked.join(F.broadcast(runs), (ranked["length"] == runs["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n")))
    at = F.col("rank") - F.col("first")
    return placed.select(
        *[ranked[c] for c in cut.columns if c != "lot"],
        (F.col("sequence") + F.floor(at / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + (at % F.col("each")) * ranked["length"]).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, window: int = WINDOW, vocabulary: str = VOCABULARY, ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack documents (doc_id, text): one row per piece with its place.

    Null and empty texts have the end id only. A very long text is tokenized whole in one task and then
    cut. Rows that repeat a doc_id, null included, are packed each on its own; ties in length go by lot,
    doc_id, start and ids. Extra columns are left out. No rows give no rows.
    """
    lots = max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return place(materialize(pieces(docs, window, vocabulary, lots, ids), "pack-pieces"), window, lots)


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences of pack(ids=True): sequence_id, ids (array<int>), doc_ids in order."""
    order = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (
        packed.groupBy("sequence_id").agg(order.alias("p"))
        .select("sequence_id", F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"), F.hex(F.aggregate("p", F.lit(b""), lambda s, x: F.concat(s, x["ids"]))).alias("h"))
        .select("sequence_id", "doc_ids", F.expr("transform(sequence(0, length(h) div 8 - 1), i -> cast(conv(concat(substr(h, 8*i+7, 2), substr(h, 8*i+5, 2), substr(h, 8*i+3, 2), substr(h, 8*i+1, 2)), 16, 10) as int))").alias("ids"))
    )
