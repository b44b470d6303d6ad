"""Toxicity by compression distance: two zstandard dictionaries, windows, calibrated thresholds.

Text is cut into windows of about ``WINDOW`` bytes that end at white space. Every window is compressed
twice: with a dictionary of ordinary text, and with the same followed by a dictionary of toxic text. The
bytes that the second saves say how much of the window toxic text explains better. Both share the
ordinary part, so what neither explains costs the same on both sides and doesn't count.

The toxic dictionary is trained on the passages of toxic rows whose contexts ordinary rows lack: a
piece (the first bytes of a word) is taken if it follows many different words in toxic rows and few in
ordinary ones, so a passage that copies repeat counts once. zstandard trains in rounds, each on what
the dictionary so far doesn't shorten. A quarter of the sample is kept from the dictionaries; on it, the
shares of windows over each number of saved bytes and the means are weighed (logistic, ridge), which
puts the thresholds where held-back rows want them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, functions as F, types as T

from roadlens.llm.words import _LOWER, _SPACE, CHUNK_BYTES, _pieces, small_batches, text_chunks, trimmed

#: Bounds of the sample that the model is fitted on: rows of each label, and characters of a row.
SAMPLE_TOXIC, SAMPLE_ORDINARY, SAMPLE_CHARS = 3000, 6000, 20_000
WINDOW = 32
LEVEL = 3
BASE_BYTES, ROUND_BYTES, ROUNDS = 65_536, 1024, 8
ENOUGH, SEGMENT, STALLED = 3, 64, 0.9
PIECE, PIECE_RATIO, PIECE_EVIDENCE = 5, 8.0, 20.0
_HEADER_END = np.array([1, 4, 8], "<u4").tobytes()  # the repeat offsets, which end the header of a trained dictionary
SAVED = (2, 3, 4, 5)  # the shares of windows that save as many bytes are features
RIDGE = 0.1


def _windows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(start, length) of the windows of a chunk of rows; a window never spans two rows."""
    counts = -(-np.diff(offsets) // WINDOW)
    first = np.repeat(offsets[:-1], counts)
    want = first + (np.arange(len(first)) - np.repeat(np.cumsum(counts) - counts, counts)) * WINDOW
    gaps = np.flatnonzero(_SPACE[data])
    after = np.append(gaps, len(data))[np.searchsorted(gaps, want)]
    after = np.where((after - want > WINDOW) | (want == first), want, after)  # no white space near: cut where it is
    edge = np.unique(np.r_[np.minimum(after, np.repeat(offsets[1:], counts)), offsets])
    return np.stack([edge[:-1], np.diff(edge)], 1).astype(np.uint64)


class Distance:
    """Bytes that the toxic dictionary saves in each window of a chunk."""

    def __init__(self, base: bytes, toxic: bytes):
        def compressor(content: bytes) -> zstd.ZstdCompressor:
            words = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=LEVEL)
            return zstd.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=False, write_dict_id=False, write_checksum=False)

        # zstandard enters one position in three of a dictionary for sure; three shifted copies enter all.
        self.sides = compressor(base), compressor(base + b" ".join([toxic + b" " * (-len(toxic) % 3)] * 3))

    def saved(self, data: np.ndarray, windows: np.ndarray) -> np.ndarray:
        if not len(windows):
            return np.zeros(0)
        held = zstd.BufferWithSegments(data.tobytes(), windows.tobytes())
        plain, toxic = (side.multi_compress_to_buffer(held, threads=1) for side in self.sides)
        return np.fromiter((len(plain[i]) - len(toxic[i]) for i in range(len(windows))), float, len(windows))

    def features(self, column: pa.Array) -> np.ndarray:
        """One row of features for each text: largest, mean, mean of the top twentieth, shares of SAVED."""
        out = [np.zeros((0, 3 + len(SAVED)))]
        for _, _, data, offsets in text_chunks(column):
            data = _LOWER[data]
            if len(offsets) == 2 and len(data) > CHUNK_BYTES:  # one long text: its windows are found piece by piece
                parts = [self.saved(p, _windows(p, np.array([0, len(p)]))) for p in _pieces(data)]
                saved, row = np.concatenate(parts), np.zeros(sum(map(len, parts)), np.int64)
            else:
                windows = _windows(data, offsets)
                saved, row = self.saved(data, windows), np.searchsorted(offsets, windows[:, 0].astype(np.int64), "right") - 1
            out.append(_summary(saved, row, len(offsets) - 1))
        return np.concatenate(out)


def _summary(saved: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((-saved, row))
    saved, row = saved[order], row[order]
    count = np.bincount(row, minlength=n)
    rank = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    some, top = np.maximum(count, 1), np.maximum(count // 20, 1)
    total = lambda mask, of: np.bincount(row[mask], saved[mask] if of else None, n)
    whole = np.ones(len(row), bool)
    return np.stack([total(rank == 0, True), total(whole, True) / some, total(rank < top[row], True) / top, *[total(saved >= s, False) / some for s in SAVED]], 1)


def _pieces_of(texts: list[bytes]) -> Counter:
    """In how many different contexts (the word before) each piece stands."""
    seen = set()
    for text in texts:
        words = text.split()
        seen.update(zip([b"", *words[:-1]], [w[:PIECE] for w in words], strict=False))
    return Counter(p for _, p in seen)


def _telling(toxic: Counter, plain: Counter) -> set[bytes]:
    """Pieces far more frequent in toxic contexts, by ratio and by log-likelihood."""
    nt, no = sum(toxic.values()) or 1, sum(plain.values()) or 1
    out = set()
    for piece, a in toxic.items():
        b = plain[piece]
        both = (a + b) / (nt + no)
        g = 2 * (a * np.log(a / nt / both) + (b * np.log(b / no / both) if b else 0.0))
        if len(piece) >= 3 and (a + 0.5) / (nt + 1) >= PIECE_RATIO * (b + 0.5) / (no + 1) and g >= PIECE_EVIDENCE:
            out.add(piece)
    return out


def _trained(samples: list[bytes], size: int, k: int) -> bytes:
    """Content of a dictionary that zstandard trains; too little text is taken as it is."""
    try:
        whole = zstd.train_dictionary(size, samples, k=k, d=6, level=LEVEL).as_bytes()
        return whole.split(_HEADER_END, 1)[-1]
    except zstd.ZstdError:
        return b"".join(samples)[-size:]


def _cut(texts: list[bytes]) -> list[bytes]:
    joined = np.frombuffer(b"".join(texts), np.uint8)
    windows = _windows(joined, np.cumsum([0, *map(len, texts)])).astype(np.int64)
    held = joined.tobytes()
    return [held[a : a + n] for a, n in windows if n >= 8]


def fit_texts(texts: list[str], toxic: list[int]) -> dict[str, Any]:
    """The model of a sample of labelled texts: two dictionaries, means, scales and weights."""
    lower = [_LOWER[np.frombuffer(t.encode(), np.uint8)].tobytes() for t in texts]
    own = [[t for i, (t, y) in enumerate(zip(lower, toxic, strict=True)) if bool(y) == side and i % 4] for side in (False, True)]
    base = _trained(_cut(own[0]), BASE_BYTES, 64) if own[0] else b""
    telling = _telling(_pieces_of(own[1]), _pieces_of(own[0]))
    left = [b" " + w[:15] for t in own[1] for w in t.split() if w[:PIECE] in telling]
    bad = b""
    for _ in range(ROUNDS):
        if not left:
            break
        bad += _trained(left, min(ROUND_BYTES, max(256, sum(map(len, left)) // 8)), SEGMENT)
        at = np.cumsum([0, *map(len, left)])
        saved = Distance(base, bad).saved(np.frombuffer(b"".join(left), np.uint8), np.stack([at[:-1], np.diff(at)], 1).astype(np.uint64))
        before, left = len(left), [w for w, s in zip(left, saved, strict=True) if s < ENOUGH]
        if len(left) > STALLED * before:  # what is left can't be shortened
            break
    # Rows that no dictionary has seen set the weights; a tiny sample has to do with all its rows.
    held = [i for i in range(len(lower)) if i % 4 == 0]
    held = held if len({bool(toxic[i]) for i in held}) == 2 else list(range(len(lower)))
    x, y = Distance(base, bad).features(pa.array([texts[i] for i in held], pa.large_string())), np.array([float(bool(toxic[i])) for i in held])
    mean, scale = (x.mean(0), x.std(0) + 1e-9) if len(x) else (np.zeros(3 + len(SAVED)), np.ones(3 + len(SAVED)))
    return {"base": base, "toxic": bad, "mean": mean.tolist(), "scale": scale.tolist(), "weights": _weigh((x - mean) / scale, y).tolist()}


def _weigh(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic weights by Newton steps, the constant first; prior pseudo-rows keep it finite."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    pull = np.r_[1e-3, np.full(x.shape[1] - 1, RIDGE)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull) + 1e-9 * np.eye(len(w)), x.T @ (y - p) - pull * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


MODEL = "base binary, toxic binary, mean array<double>, scale array<double>, weights array<double>"


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> dict[str, Any]:
    """The model of docs (key, text) with labels (key, label): a bounded sample of each label, fitted in one task.

    The sample holds the labels with the least hash of their key, so it is chosen before any text is read, and
    texts aren't shuffled but for the sample's. Null labels and keys, and texts that are null or over
    ``SAMPLE_CHARS`` characters, aren't in it. Of a key with several labels or texts the least one counts. With no
    toxic or no ordinary rows the score is about the share of toxic ones.
    """
    rows = labels.groupBy(F.col(key).alias("o")).agg(F.min(F.col(label).cast("int")).alias("y")).filter("o is not null and y is not null")
    part = lambda y, n: rows.filter(y).orderBy(F.xxhash64("o"), F.col("o")).limit(n)
    chosen = part(F.col("y") == 1, SAMPLE_TOXIC).unionByName(part(F.col("y") != 1, SAMPLE_ORDINARY))
    own = docs.select(F.col(key).alias("o"), F.col(text).alias("text")).filter(F.length("text") <= SAMPLE_CHARS)
    # At most SAMPLE_TOXIC + SAMPLE_ORDINARY keys are broadcast.
    sample = own.join(F.broadcast(chosen), "o").groupBy("o").agg(F.min("text").alias("text"), F.min("y").alias("y"))

    def train(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = pd.concat([p for p in parts if len(p)] or [pd.DataFrame({"o": [], "text": [], "y": []})])
        got = got.sort_values(["h", "o"]) if len(got) else got
        yield pd.DataFrame([fit_texts(got["text"].tolist(), [int(v == 1) for v in got["y"]])])

    one = sample.withColumn("h", F.xxhash64("o")).coalesce(1)
    found = one.mapInPandas(train, MODEL).first()
    return found.asDict() if found else fit_texts([], [])  # an empty plan has no task to fit in


def score(docs: DataFrame, model: dict[str, Any], text: str = "text", column: str = "score") -> DataFrame:
    """docs with ``column``: how likely it is that a row is toxic, from 0 to 1, over whole texts.

    Rows keep all their columns, repeated ones too; a column that is named like the result is replaced. Null
    and empty texts have no window and get the score of a text in which nothing is saved. One worker holds
    a chunk of texts at a time; a very long text goes through in pieces.
    """
    docs = docs.drop(column)
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = Distance(model["base"], model["toxic"])
        mean, scale, weights = (np.array(model[k]) for k in ("mean", "scale", "weights"))
        for batch in batches:
            x = (distance.features(batch.column(text)) - mean) / scale
            p = 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], [*batch.schema.names, column])

    return small_batches(docs).mapInArrow(trimmed(run), schema)


def held_out(doc_id: str) -> Any:
    """Whether a row is kept from training: the CRC-32 of its id as text is divisible by five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
