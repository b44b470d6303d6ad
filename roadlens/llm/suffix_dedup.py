"""Removal of long repeated byte strings: backward extension on transforms of anchored groups.

The method is the breadth-first backward extension on a Burrows-Wheeler transform that derives common
prefixes by increasing value, stopped at a least length. One transform of a corpus is one index and,
over rows, a shuffle of at least a rank and a position for each byte; so there are many transforms here,
each of the places that can repeat each other:

1. A string of ``length`` bytes that occurs twice has the same least 8-gram (by hash, leftmost of ties)
   in both places. That anchor groups possible repeats: a range of string starts at one distance from
   the anchor has a core that all its strings share and a hull that they cover. Ranges whose core occurs
   once go; of those whose hull occurs twice (by a BLAKE2b digest of 128 bits) all strings are repeated.
2. Other ranges of a core, with one of each settled hull, are a group. Its suffixes at the core's left
   edge are sorted; then bytes are put before them one by one: a stable sort by that byte is the step of
   the transform, and a common prefix grows by one within a byte and ends between two bytes. Intervals
   in which it reaches ``length`` are repeated strings; rows that can't reach it any more leave.
3. A group of over ``GROUP`` rows (a passage in very many documents) isn't put into one task: its
   ranges are cut into narrower ones with longer cores and go through the same steps, down to single
   strings, where the hull decides.

Passages of so many words are found in the same way: each text becomes a string of one 8-byte hash a
word, in which a passage has one length whatever its letters are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from roadlens.llm.words import CHUNK_BYTES, Scratch, mix, prefix_hashes, small_batches, span_hashes, trimmed, word_bounds
from roadlens.session import materialize

LENGTH = 400
GRAM = 8
CODE = 8  # bytes of a word's hash
WIDTHS = (200, 40, 8, 1)
GROUP = 4096  # rows (of under length + width bytes) of one transform
_POSITION_BITS = 24
_PIECE = 200_000  # longer texts are read in pieces of so many string starts


_COLUMNS = ["key", "anchor", "lo", "hi", "core", "hull", "more"]
RANGE = "key string, anchor long, lo int, hi int, core long, hull long, more long"


def _anchors(data: np.ndarray, length: int) -> np.ndarray:
    """For each string start, the position of the least 8-gram within the string."""
    n = len(data) - GRAM + 1
    grams = np.zeros(n, np.uint64)
    for i in range(GRAM):
        grams |= data[i : i + n].astype(np.uint64) << np.uint64(8 * i)
    keys = (mix(grams) >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | np.arange(n, dtype=np.uint64)
    w = length - GRAM + 1
    rows = -(-n // w)
    padded = np.full(rows * w, np.uint64(2**64 - 1), np.uint64)
    padded[:n] = keys
    grid = padded.reshape(rows, w)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    starts = n - w + 1
    least = np.minimum(back[:starts], ahead[w - 1 : w - 1 + starts])
    return (least & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)


def _cut(anchor: np.ndarray, lo: np.ndarray, hi: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Cut offset ranges lo..hi (anchor minus start) at multiples of width: row, block, lo, hi."""
    first, last = lo // width, hi // width
    n = last - first + 1
    row = np.repeat(np.arange(len(lo)), n)
    block = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[row]
    return row, block, np.maximum(lo[row], block * width), np.minimum(hi[row], block * width + width - 1)


def _digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Two columns of 64 bits of data[start:end]. Nobody can build texts that collide, as for sums of powers."""
    view = memoryview(np.ascontiguousarray(data))
    raw = b"".join([hashlib.blake2b(view[s:e], digest_size=16).digest() for s, e in zip(start.tolist(), end.tolist(), strict=True)])
    return np.frombuffer(raw, np.uint64).reshape(-1, 2)


def _ranges(data: np.ndarray, anchor: np.ndarray, lo: np.ndarray, hi: np.ndarray, width: int, length: int) -> tuple[np.ndarray, ...]:
    """Ranges of one width with the hashes of their cores and hulls."""
    row, block, lo, hi = _cut(anchor, lo, hi, width)
    a = anchor[row]
    top = np.minimum(block * width + width - 1, length - GRAM)
    mark = mix(block.astype(np.uint64) + np.uint64(977 * width))
    core = span_hashes(prefix_hashes(data), a - block * width, a - top + length) ^ mark
    own = mix(mark + (lo * 1024 + hi).astype(np.uint64))
    # Cores only bring ranges together; hulls decide, so they rest on no sum of powers.
    digest = _digests(data, a - hi, a - lo + length)
    hull, more = digest[:, 0] ^ own, digest[:, 1] ^ own
    return row, a, lo, hi, core.view(np.int64), hull.view(np.int64), more.view(np.int64)


def _first(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            docs, rows = [], 0
            for r in range(batch.num_rows):
                text = batch.column(1)[r].as_buffer()
                if text is None or text.size < length:
                    continue
                whole = np.frombuffer(text, np.uint8)
                for base in range(0, len(whole) - length + 1, _PIECE):
                    data = whole[base : base + _PIECE + length - 1]
                    at = _anchors(data, length)
                    change = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                    end = np.r_[change[1:], len(at)] - 1
                    anchor = at[change]
                    _, a, *rest = _ranges(data, anchor, anchor - end, anchor - change, WIDTHS[0], length)
                    for column, value in zip(out, (a + base, *rest), strict=True):
                        column.append(value)
                    docs.append(np.full(len(a), r))
                    rows += len(a)
                if rows > 30_000:
                    yield _emit(batch, docs, out)
                    out, docs, rows = [[] for _ in range(6)], [], 0
            if rows:
                yield _emit(batch, docs, out)

    return run


def _emit(batch: pa.RecordBatch, docs: list, out: list[list]) -> pa.RecordBatch:
    ids = batch.column(0).take(pa.array(np.concatenate(docs)))
    columns = [np.concatenate(c) for c in out]
    return pa.RecordBatch.from_arrays([ids, pa.array(columns[0]), *(pa.array(c.astype(np.int32)) for c in columns[1:3]), *(pa.array(c) for c in columns[3:])], _COLUMNS)


def _narrower(width: int, length: int):
    """Ranges with their bytes (key, anchor, lo, hi, bytes) to narrower ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 400):
                part = batch.slice(at, 400)
                anchor, lo, hi = (np.asarray(part.column(c)).astype(np.int64) for c in (1, 2, 3))
                raw = part.column(4).to_pylist()
                local = np.cumsum([0] + [len(x) for x in raw])[:-1] + hi
                row, _, lo, hi, *sums = _ranges(np.frombuffer(b"".join(raw), np.uint8), local, lo, hi, width, length)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(anchor[row]), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), *map(pa.array, sums)], _COLUMNS
                )

    return run


def extend_backward(group: np.ndarray, key: np.ndarray, lo: np.ndarray, hi: np.ndarray, data: np.ndarray, sizes: np.ndarray, width: int, length: int, across: bool = False) -> np.ndarray:
    """Which strings of rows are repeated in their group: a mask [row, place], place 0 to width - 1.

    A row holds the bytes of the strings that start at places lo to hi, the place growing to the left.
    Rows of a group are in a row.
    """
    n, span = len(group), length + width - 1
    text = np.zeros((n, span), ">u2")  # 0 where a row has no byte: an end, smaller than any byte
    first = np.arange(n) * span + width - 1 - hi
    at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(len(data))
    text.ravel()[at] = data.astype(np.uint16) + 1
    hit = np.zeros((n, width), bool)
    tails = text[:, width - 1 :]
    order = np.array(sorted(range(n), key=[(g, t.tobytes()) for g, t in zip(group.tolist(), tails, strict=True)].__getitem__), np.int64)
    # Common prefix of each row of the order and the one before it.
    unlike = tails[order[1:]] != tails[order[:-1]]
    prefix = np.where(unlike.any(1), unlike.argmax(1), length)
    known = length - lo[order]
    prefix = np.minimum(prefix, np.minimum(known[1:], known[:-1])) * (group[order[1:]] == group[order[:-1]])
    prefix = np.r_[0, prefix, 0]
    for place in range(width):
        if place:
            best = np.maximum(prefix[:-1], prefix[1:])
            stay = np.flatnonzero((hi[order] >= place) & (best + hi[order] - place + 1 >= length))
            if not len(stay):
                break
            byte = text[order[stay], width - 1 - place].astype(np.int64)
            by = group[order[stay]] * 512 + byte
            stay, by = (x[np.argsort(by, kind="stable")] for x in (stay, by))
            order = order[stay]
            # The least common prefix between two places of the order before, plus the byte.
            ends = np.stack([stay[:-1] + 1, stay[1:] + 1], 1).ravel()
            between = np.minimum.reduceat(prefix, ends)[::2] if len(ends) else prefix[:0]
            prefix = np.r_[0, np.where(by[1:] == by[:-1], between + 1, 0), 0]
        starts = np.flatnonzero(prefix[:-1] < length)  # intervals of equal strings
        if len(starts) < len(order):
            if across:
                twice = np.minimum.reduceat(key[order], starts) < np.maximum.reduceat(key[order], starts)
            else:
                twice = np.diff(np.r_[starts, len(order)]) > 1
            hit[order[np.repeat(twice, np.diff(np.r_[starts, len(order)]))], place] = True
    return hit


def _expand(width: int, length: int, across: bool):
    """Rows sorted by core (core, key, anchor, lo, hi, bytes) to spans of repeated strings (key, start, end)."""

    def close(rows: pa.Table) -> pa.RecordBatch:
        core, anchor, lo, hi = (np.asarray(rows[c]).astype(np.int64) for c in ("core", "anchor", "lo", "hi"))
        raw = rows["bytes"].to_pylist()
        base = lo // width * width
        group = np.cumsum(np.r_[0, core[1:] != core[:-1]])
        key = np.asarray(rows["key"].combine_chunks().dictionary_encode().indices).astype(np.int64)
        sizes = np.array([len(x) for x in raw], np.int64)
        hit = extend_backward(group, key, lo - base, hi - base, np.frombuffer(b"".join(raw), np.uint8), sizes, width, length, across)
        edge = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, low = np.nonzero(edge == 1)
        _, high = np.nonzero(edge == -1)
        start, end = anchor[row] - base[row] - high + 1, anchor[row] - base[row] - low + length
        return pa.RecordBatch.from_arrays([rows["key"].combine_chunks().take(pa.array(row)), pa.array(start), pa.array(end)], ["key", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            rest = now if rest is None else pa.concat_tables([rest, now])
            core = np.asarray(rest["core"])
            turns = np.flatnonzero(np.r_[True, core[1:] != core[:-1]])[1:]
            at = 0
            while len(turns) and turns[-1] > at:
                # As many whole groups as make GROUP rows, one at least.
                end = turns[max(np.searchsorted(turns, at + GROUP, "right") - 1, np.searchsorted(turns, at, "right"))]
                yield close(rest.slice(at, end - at))
                at = end
            rest = rest.slice(at)
        if rest is not None and rest.num_rows:
            yield close(rest)

    return run


def repeated_spans(texts: DataFrame, length: int = LENGTH, name: str = "suffix", across: bool = False, group: int = GROUP, encode: Callable | None = None) -> DataFrame:
    """(key, text) to (key, start, end): bytes covered by a ``length``-byte string that occurs elsewhere.

    With ``across``, elsewhere is a text of another key only. ``encode`` makes Arrow batches of (key, text, ...)
    into such batches with the strings that are compared in the place of the texts; they are made again
    where they are needed, as they may be longer than the texts.

    The strings are judged on the input; spans of a key may overlap. Texts shorter than ``length``
    have none. A key must name one text; keys may be shared by equal texts only.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    encode = encode or iter
    first, cut_bytes = _first(length), _slice(length)
    data = texts.select(F.col("key").cast("string"), F.col("text").cast("string"))
    # Keys are compared by their hashes: numbers are aggregated without a sort.
    more = F.min(F.xxhash64("key")) < F.max(F.xxhash64("key")) if across else F.count(F.lit(1)) > 1
    scratch = Scratch(name)
    now = materialize(data.mapInArrow(trimmed(lambda batches: first(encode(batches))), RANGE), f"{name}-0")
    spans, held = None, None
    row, hull = ["key", "anchor", "lo", "hi"], ["hull", "more"]
    parts = max(8, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    for turn, width in enumerate(WIDTHS):
        # What is joined with is stored first: the side of a join that is no aggregate can be split where
        # one core or hull has very many rows.
        twice = scratch(now.groupBy("core").agg(more.alias("_")).filter("_").select("core"), "cores")
        alive = scratch(now.join(twice, "core", "left_semi"), "alive")
        scratch.drop(now, twice)
        whole = scratch(alive.groupBy(*hull).agg(more.alias("_")).filter("_").select(*hull, F.lit(True).alias("all")), "hulls")
        judged = scratch(alive.join(whole, hull, "left"), "judged")
        scratch.drop(alive, whole)
        found = judged.filter("all").select("key", (F.col("anchor") - F.col("hi")).alias("start"), (F.col("anchor") - F.col("lo") + length).alias("end"))
        found = materialize(found, f"{name}-found")
        spans = found if spans is None else spans.unionByName(found)
        undecided = judged.filter("all is null").select(*row, "core")
        if turn + 1 == len(WIDTHS) or undecided.isEmpty():
            break
        # One of the equal hulls that are settled stays as a witness where others of its group are open;
        # with across one of each of two keys, as a range can't witness for its own key.
        cores = scratch(undecided.select("core").distinct(), "undecided")
        settled = judged.filter("all").join(cores, "core", "left_semi")
        own = F.struct(*row, "core")
        ends = F.array(F.min(own), F.max(own)) if across else F.array(F.min(own))
        witness = settled.groupBy(*hull).agg(ends.alias("w")).select(F.explode("w").alias("w")).select("w.*").distinct()
        stored = scratch(undecided.unionByName(witness), "open")
        scratch.drop(judged, cores)
        sizes = scratch(stored.groupBy("core").agg((F.count(F.lit(1)) <= group).alias("small")), "sizes")
        open_ = stored.join(sizes, "core")
        if turn == 0:
            ranges = open_.groupBy("key").agg(F.collect_list(F.struct("anchor", "lo", "hi", "core", "small")).alias("r"))
            carried = data.join(ranges, "key").dropDuplicates(["key"]).select("key", "text", "r")
            rows = carried.mapInArrow(trimmed(lambda batches: cut_bytes(encode(batches))), "core long, key string, anchor long, lo int, hi int, bytes binary, small boolean")
        else:
            inside = (F.col("lo") >= F.col("low")) & (F.col("hi") <= F.col("high"))
            cut = F.expr(f"substring(bytes, high - hi + 1, hi - lo + {length})")
            place = F.expr(f"lo div {WIDTHS[0]}")
            rows = open_.withColumn("place", place).join(held, ["key", "anchor", "place"]).filter(inside).select("core", *row, cut.alias("bytes"), "small")
        rows = scratch(rows, "held")
        scratch.drop(stored, sizes)
        grouped = rows.filter("small").drop("small").repartition(parts, "core").sortWithinPartitions("core")
        spans = spans.unionByName(materialize(grouped.mapInArrow(trimmed(_expand(width, length, across)), "key string, start long, end long"), f"{name}-expanded"))
        large = rows.filter("not small")
        if large.isEmpty():
            break
        if turn == 0:
            held = large.select("key", "anchor", F.expr(f"lo div {WIDTHS[0]}").alias("place"), F.col("lo").alias("low"), F.col("hi").alias("high"), "bytes")
        now = materialize(large.select(*row, "bytes").mapInArrow(trimmed(_narrower(WIDTHS[turn + 1], length)), RANGE), f"{name}-{turn + 1}")
    scratch.clear()
    return spans


def _slice(length: int):
    """The bytes of each open range of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["core", "key", "anchor", "lo", "hi", "bytes", "small"]
        for batch in batches:
            for r in range(batch.num_rows):
                raw, rows = batch.column(1)[r].as_buffer(), batch.column(2)[r].values
                for at in range(0, len(rows), 5000):
                    part = rows.slice(at, 5000)
                    anchor, lo, hi, core, small = part.flatten()
                    cut = [raw.slice(x - h, h - b + length).to_pybytes() for x, b, h in zip(anchor.to_pylist(), lo.to_pylist(), hi.to_pylist(), strict=True)]
                    key = pa.array([batch.column(0)[r].as_py()] * len(part))
                    yield pa.RecordBatch.from_arrays([core, key, anchor, lo, hi, pa.array(cut, pa.binary()), small], names)

    return run


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of sorted spans; spans that touch are one run."""
    out: list[list[int]] = []
    for start, end in spans:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts, the second column, as strings of one hash a word; other columns stay."""
    for batch in batches:
        out, first, held = [], 0, 0
        for r in range(batch.num_rows):
            data = np.frombuffer(batch.column(1)[r].as_buffer(), np.uint8)
            start, end = word_bounds(data)
            out.append(span_hashes(prefix_hashes(data), start, end).tobytes())
            held += len(out[-1])
            if held > CHUNK_BYTES or r + 1 == batch.num_rows:
                part = batch.slice(first, len(out))
                yield part.set_column(1, part.schema.names[1], pa.array(out, pa.binary()))
                out, first, held = [], r + 1, 0


def _passages(raw: bytes, spans: list[dict], words: int) -> list[tuple[int, int]]:
    """Bytes of a text that spans of its word hashes stand for; only whole words count."""
    start, end = word_bounds(np.frombuffer(raw, np.uint8))
    # The strings of a span that start with a word.
    cut = [(-(-x["start"] // CODE), x["end"] // CODE) for x in spans]
    return [(int(start[a]), int(end[b - 1])) for a, b in cut if b - a >= words]


def _remove(batches: Iterator[pa.RecordBatch], words: int = 0) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, sums = [], []
        for text, spans, passages in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
            buffer = text.as_buffer()
            raw = b"" if buffer is None else buffer.to_pybytes()
            runs = merge(sorted([(x["start"], x["end"]) for x in spans.as_py() or []] + _passages(raw, passages.as_py() or [], words)))
            at, rest = 0, []
            for a, b in runs:
                rest.append(raw[at:a])
                at = b
            left = b"".join([*rest, raw[at:]])
            kept.append(left)
            sums.append((len(raw), len(raw) - len(left), len(runs), hashlib.sha256(left).hexdigest()))
        columns = [batch.column(0), pa.array(kept, pa.binary()), pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string())]
        columns += [pa.array([s[i] for s in sums], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["row", *ADDED])


ADDED = ("kept_bytes", "kept_text", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, name: str = "suffix", words: int = 0) -> DataFrame:
    """Add kept_bytes, kept_text, n_bytes, n_removed, n_spans and kept_sha256 to every row of docs.

    Removed is each byte covered by a string of ``length`` bytes that also starts at another place, in
    this text or any other row's; overlaps count, and the input decides, not what is left. Null text is
    empty; so is what is left of a text that is all repeated. Rows that repeat a key and text both count,
    so both lose their bytes; rows with a null key are told apart by their texts. A very long text is
    read in pieces. Kept bytes may hold a character in part; kept_text leaves such parts out. Columns
    named as the added ones are replaced, all others stay, whatever their names. No rows give no rows.

    With ``words``, removed too is each passage of so many words (between ASCII white space, equal in
    every byte) that a row with another key or text also holds, with the white space inside it.
    """
    docs = small_batches(docs).drop(*ADDED)
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    # Long texts only can hold a string; a row is named by its key and text. Its own columns travel in a
    # struct, so that none of their names meets one of ours.
    own = F.concat_ws(":", F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("null")), F.hex(F.xxhash64(body)), F.octet_length(body))
    keyed = docs.select(own.alias("key"), body.alias("text"))
    long_ = keyed.filter(F.octet_length("text") >= length)
    spans = repeated_spans(long_, length, name).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    joined = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own.alias("key")).join(spans, "key", "left")
    if words:
        # A passage has at least a byte a word and one between two.
        worded = keyed.filter(F.octet_length("text") >= 2 * words - 1)
        passages = repeated_spans(worded, CODE * words, f"{name}-words", across=True, encode=_codes).groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("passages"))
        joined = joined.join(passages, "key", "left")
    else:
        joined = joined.withColumn("passages", F.lit(None).cast("array<struct<start: bigint, end: bigint>>"))
    # The text is taken from the row after the joins: it travels once.
    joined = joined.select("row", F.coalesce(F.col(f"row.`{text}`").cast("string"), F.lit("")).alias("text"), "spans", "passages")
    types = (BinaryType(), StringType(), LongType(), LongType(), LongType(), StringType())
    schema = StructType([joined.schema["row"], *(StructField(c, t) for c, t in zip(ADDED, types, strict=True))])
    out = joined.mapInArrow(trimmed(lambda batches: _remove(batches, words)), schema)
    return out.select(*[F.col(f"row.`{c}`") for c in docs.columns], *ADDED)
