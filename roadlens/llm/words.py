"""Vectorised words and shingle hashes of Arrow text batches, in chunks of bounded size."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roadlens.session import discard, materialize

CHUNK_BYTES = 1 << 18  # arrays of several 8-byte numbers a byte are made of a chunk
_RNG = np.random.default_rng(20240917)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_ODD = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


#: Rows of an Arrow batch at most: a worker holds a batch of whole texts and what it makes of them.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """Let the session send texts to Python workers in small batches; returns df."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


class Scratch:
    """Tables in the shared folder that a later table makes needless; ``clear`` deletes them."""

    def __init__(self, name: str):
        self.name, self.tables = name, []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(materialize(df, f"{self.name}-{name}"))
        return self.tables[-1]

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that are read no more, and shuffle files of finished steps."""
        for df in tables:
            discard(df)
            self.tables = [t for t in self.tables if t is not df]
        # Shuffle files go when the driver's JVM collects what named them.
        tables[0].sparkSession.sparkContext._jvm.System.gc()

    def clear(self) -> None:
        if self.tables:
            self.drop(*self.tables)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, after which the worker, which waits for other tasks, gives free memory back."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ctypes

        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(AttributeError, OSError):  # other C libraries have no such call
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows; one long text is a chunk of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_HELD: dict = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse up to n; kept for the usual chunk size."""
    if n > CHUNK_BYTES:
        return _powers(_BASE, n), _powers(_BASE_INVERSE, n)
    if not _HELD:
        _HELD["p"] = _powers(_BASE, CHUNK_BYTES), _powers(_BASE_INVERSE, CHUNK_BYTES)
    return _HELD["p"]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running sums that give the hash of any span: see span_hashes."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data))[0][: len(data)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]; equal spans have equal hashes wherever they lie."""
    inverse = powers(len(prefix) - 1)[1]
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64) * _ODD[63])


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of one text between ASCII white space."""
    solid = np.zeros(len(data) + 2, np.int8)
    solid[1:-1] = ~_SPACE[data]
    turn = np.diff(solid)
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words between ASCII white space, A-Z lower-cased, and the row of each word."""
    if len(offsets) == 2 and len(data) > CHUNK_BYTES:
        words = np.concatenate([_word_hashes(part, np.array([0, len(part)]))[0] for part in _pieces(data)])
        return words, np.zeros(len(words), np.int64)
    return _word_hashes(data, offsets)


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lower = _LOWER[data]
    solid = ~_SPACE[lower]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last[:-1] &= ~solid[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return span_hashes(prefix_hashes(lower), start, end), np.searchsorted(offsets, start, "right") - 1


def _pieces(data: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[np.ndarray]:
    """One long text in pieces that end at white space; a word is never cut, however long it is."""
    at = 0
    while at < len(data):
        end = min(len(data), at + limit)
        while end < len(data):
            gap = np.flatnonzero(_SPACE[data[end : end + limit]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(data), end + limit)
        yield data[at:end]
        at = end


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its shingles of ``size`` words.

    A row of fewer words, but not none, has its whole sequence as one shingle.
    """
    words, row = word_hashes(data, offsets)
    n = len(offsets) - 1
    edge = np.searchsorted(row, np.arange(n + 1))
    joined = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for i in range(size):
        joined += words[i : i + len(joined)] * _ODD[i]
    joined = mix(joined)
    out = []
    for i in range(n):
        a, b = edge[i], edge[i + 1]
        if b - a >= size:
            own = np.sort(joined[a : b - size + 1])
            out.append(own[np.r_[True, own[1:] != own[:-1]]])
        elif b > a:
            short = mix((words[a:b] * _ODD[: b - a]).sum(dtype=np.uint64, keepdims=True) + _ODD[32 + b - a])
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out
