"""Ranked lexical search over K2-treaps: quadtrees of a term-document grid whose cells hold impact maxima.

Documents are dealt into ranges. A range is a grid with a row for each term that it holds and a column for
each document, cut into four again and again; only cells that hold something are kept, as a four-bit mask
of children for each cell and the difference between the largest impact in the cell and in its parent. Rows
are in order of document frequency, so cells hold impacts of like size.

An item descends the paths of all its rows at once: a state is a range of columns with the cell of each
row over it, and its bound is the sum of their maxima. States are expanded best first, a block of them at
a time, until no bound reaches the last of the best documents. A state of one column is a document with its
exact score. Everything is integers, so results are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from roadlens.llm.words import _LOWER, CHUNK_BYTES, Scratch, _pieces, prefix_hashes, small_batches, span_hashes, text_chunks, trimmed

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COLUMNS = 4096  # documents of a range at most
GRID_CELLS = 1 << 24  # columns times terms of the longest item at most, for the states of one search
BATCH_ITEMS, BATCH_BYTES = 10_000, 32 << 20  # items that are searched at once, and bytes of their texts
STATES = 1 << 13  # numbers of a block of states that is expanded at once

_TERM = np.ones(256, bool)
_TERM[:48] = _TERM[58:65] = _TERM[91:97] = _TERM[123:128] = False
_ONES = np.array([bin(m).count("1") for m in range(16)], np.int64)
_BEFORE = np.array([[_ONES[m & ((1 << q) - 1)] for q in range(4)] for m in range(16)], np.int64)


def terms_of(text: Column) -> Column:
    """All terms of a text in order, only A-Z lower-cased; null has none."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0)), F.array().cast("array<string>"))


# --- term numbers -----------------------------------------------------------------------------------------


class Lexicon:
    """Numbers of the asked terms; a hash finds a term, a comparison of its bytes confirms it."""

    def __init__(self, terms: list[str]):
        held = [t.encode() for t in terms]
        self.at = np.cumsum([0, *map(len, held)])
        self.data = np.frombuffer(b"".join(held), np.uint8)
        hashes = span_hashes(prefix_hashes(self.data), self.at[:-1], self.at[1:])
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        # Terms of one hash are tried one after the other; there is hardly ever a second.
        self.tries = int(np.unique(hashes, return_counts=True)[1].max(initial=0))

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the spans, number of its term) of the spans that are asked terms."""
        hashes = span_hashes(prefix_hashes(data), start, end)
        first = np.searchsorted(self.hashes, hashes)
        out = []
        for k in range(self.tries):
            spot = np.minimum(first + k, len(self.hashes) - 1)
            which = np.flatnonzero((first + k < len(self.hashes)) & (self.hashes[spot] == hashes))
            term = self.order[spot[which]]
            size = end[which] - start[which]
            fits = size == self.at[term + 1] - self.at[term]
            which, term, size = which[fits], term[fits], size[fits]
            edge = np.cumsum(size) - size
            within = np.arange(int(size.sum())) - np.repeat(edge, size)
            same = data[np.repeat(start[which], size) + within] == self.data[np.repeat(self.at[term], size) + within]
            good = np.logical_and.reduceat(same, edge) if len(edge) else np.zeros(0, bool)
            out.append((which[good], term[good]))
        return np.concatenate([w for w, _ in out] or [np.zeros(0, np.int64)]), np.concatenate([t for _, t in out] or [np.zeros(0, np.int64)])

    def count(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(terms of each row with repeats, row of each asked term, its number) of a chunk of rows."""
        data = _LOWER[data]
        solid = _TERM[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1] | edge[1:-1]
        last[:-1] &= ~solid[1:] | edge[1:-1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        row = np.searchsorted(offsets, start, "right") - 1
        which, term = self.find(data, start, end)
        return np.bincount(row, minlength=len(offsets) - 1), row[which], term


POSTINGS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tf", T.ArrayType(T.LongType()))])


def postings(docs: DataFrame, terms: list[str]) -> DataFrame:
    """docs (doc_id, text) to (doc_id, n, terms, tf): all terms of a text, and the asked ones with their counts."""
    held = docs.sparkSession.sparkContext.broadcast(terms)  # at most BATCH_BYTES of texts, or one item

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(held.value)
        for batch in batches:
            for row, end, data, offsets in text_chunks(batch.column("text")):
                if len(offsets) == 2 and len(data) > CHUNK_BYTES:
                    parts = [lexicon.count(p, np.array([0, len(p)])) for p in _pieces(data)]
                    n, at, term = sum(p[0] for p in parts), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
                else:
                    n, at, term = lexicon.count(data, offsets)
                key, tf = np.unique(at * np.int64(max(1, len(held.value))) + term, return_counts=True)
                at, term = key // max(1, len(held.value)), key % max(1, len(held.value))
                edge = pa.array(np.searchsorted(at, np.arange(end - row + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(edge, pa.array(v, t)) for v, t in ((term, pa.int32()), (tf, pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, end - row), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tf"])

    return small_batches(docs).mapInArrow(trimmed(run), POSTINGS)


# --- K2-treaps --------------------------------------------------------------------------------------------


def treap(row: np.ndarray, column: np.ndarray, impact: np.ndarray, depth: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(cells of each level, child masks of the inner ones, maxima as differences to the parent's) of a grid of 2^depth."""
    code = np.zeros(len(row), np.int64)
    for bit in range(depth):
        code |= ((row >> bit) & 1) << (2 * bit + 1) | ((column >> bit) & 1) << (2 * bit)
    order = np.argsort(code, kind="stable")
    code, top = code[order], impact[order]
    sizes, masks, deltas = [len(code)], [], []
    for _ in range(depth):
        parent = code >> 2
        edge = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
        own = np.maximum.reduceat(top, edge)
        deltas.append(np.repeat(own, np.diff(np.r_[edge, len(code)])) - top)
        masks.append(np.bitwise_or.reduceat(1 << (code & 3), edge).astype(np.uint8))
        code, top = parent[edge], own
        sizes.append(len(code))
    return sizes[::-1], np.concatenate(masks[::-1] or [np.zeros(0, np.uint8)]), np.concatenate([top, *deltas[::-1]])


class Range:
    """One range of documents, ready to be searched."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, row_max: np.ndarray, sizes: list[int], masks: np.ndarray, deltas: np.ndarray):
        self.ids, self.rows, self.row_max, self.depth = ids, rows, row_max, len(sizes) - 1
        self.masks, self.first, self.top = [], [], []
        inner, cell = 0, 0
        for level, size in enumerate(sizes):
            own = deltas[cell : cell + size]
            if level:
                own = np.repeat(self.top[-1], _ONES[self.masks[-1]]) - own
            self.top.append(own)
            cell += size
            if level < self.depth:
                self.masks.append(masks[inner : inner + size])
                count = _ONES[self.masks[-1]]
                self.first.append(np.cumsum(count) - count)
                inner += size

    def search(self, asked: np.ndarray, best: tuple[np.ndarray, np.ndarray, np.ndarray], origin: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``best`` (scores, ids, origins) of an item with this range's documents among them; asked: rows of its terms."""
        spot = np.minimum(np.searchsorted(self.rows, asked), len(self.rows) - 1)
        row = spot[self.rows[spot] == asked]
        last = lambda: (best[0][-1], best[1][-1]) if len(best[0]) == k else (0, -(2**63))
        if not len(row) or self.row_max[row].sum() < max(1, last()[0]):
            return best
        block = max(1, STATES // len(row))
        pools = [[] for _ in range(self.depth + 1)]
        start = np.zeros((1, len(row)), np.int64)
        pools[0] = [np.zeros(1, np.int64), start, np.full(1, len(row) * self.top[0][0])]
        while True:
            score, ident = last()
            level = max((lv for lv in range(self.depth) if len(pools[lv]) and len(pools[lv][2])), key=lambda lv: pools[lv][2].max(), default=None)
            if level is None:
                if self.depth == 0 and len(pools[0]):  # one document and one term
                    best = _merged(best, self.top[0][:1], self.ids[:1], origin, k)
                return best
            at, cells, bound = pools[level]
            # An equal bound helps only if an earlier id is among its documents; columns are in order of ids.
            hope = (bound > score) | (bound == score) & (bound > 0) & (self.ids[np.minimum(at << (self.depth - level), len(self.ids) - 1)] < ident)
            at, cells, bound = at[hope], cells[hope], bound[hope]
            order = np.argpartition(-bound, block - 1) if len(bound) > block else np.arange(len(bound))
            now, later = order[:block], order[block:]
            pools[level] = [at[later], cells[later], bound[later]]
            if not len(now):
                continue
            bit = (row >> (self.depth - level - 1)) & 1
            at, cells = at[now], cells[now]
            there = cells >= 0
            mask = np.where(there, self.masks[level][cells], 0)
            sides = []
            for side in (0, 1):
                quarter = bit * 2 + side
                has = (mask >> quarter) & 1 == 1
                child = np.where(has, self.first[level][cells] + _BEFORE[mask, quarter], -1)
                sides.append((at * 2 + side, child, np.where(has, self.top[level + 1][child], 0).sum(1)))
            at, cells, bound = (np.concatenate(x) for x in zip(*sides, strict=True))
            some = bound > 0
            if level + 1 == self.depth:
                best = _merged(best, bound[some], self.ids[at[some]], origin, k)
            else:
                old = pools[level + 1]
                new = [at[some], cells[some], bound[some]]
                pools[level + 1] = [np.concatenate(x) for x in zip(old, new, strict=True)] if old else new


def _merged(best: tuple[np.ndarray, np.ndarray, np.ndarray], score: np.ndarray, ids: np.ndarray, origin: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if len(best[0]) == k:
        near = score >= best[0][-1]
        score, ids = score[near], ids[near]
    score, ids, where = np.r_[best[0], score], np.r_[best[1], ids], np.r_[best[2], np.full(len(score), origin)]
    order = np.lexsort((ids, -score))[:k]
    return score[order], ids[order], where[order]


NULL_ID = 2**63 - 1  # stands for a null id inside a range, so it comes last
INDEX = "ids array<bigint>, has_null boolean, rows array<int>, row_max array<bigint>, sizes array<int>, masks binary, deltas array<bigint>"


def build_index(found: DataFrame, place: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int, columns: int = COLUMNS) -> DataFrame:
    """postings to one row for each range of documents; place and weight are those of each term number.

    Every row with a term is a column of some range; one without an asked term is an empty one.
    """
    sc = found.sparkSession.sparkContext
    held = sc.broadcast((place, weight))  # two numbers for each asked term
    rows = found.filter("size(terms) > 0")

    def grid(ids: list, n: list[int], counts: np.ndarray, term: np.ndarray, tf: np.ndarray) -> dict:
        key = np.array([NULL_ID if i is None else i for i in ids], np.int64)
        order = np.argsort(key, kind="stable")
        column = np.empty(len(key), np.int64)
        column[order] = np.arange(len(key))
        own = np.repeat(np.arange(len(key)), counts)
        m = np.array([10 + (90 * v * n_docs) // max(1, n_terms) for v in n], np.int64)  # Python's integers don't overflow
        impact = held.value[1][term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[own]))
        keep = impact > 0
        row, back = np.unique(held.value[0][term[keep]], return_inverse=True)
        if not len(row):
            return {}
        row_max = np.zeros(len(row), np.int64)
        np.maximum.at(row_max, back, impact[keep])
        depth = max(len(key) - 1, len(row) - 1, 1).bit_length()
        sizes, masks, deltas = treap(back.astype(np.int64), column[own[keep]], impact[keep], depth)
        return {"ids": key[order], "has_null": bool(key.max() == NULL_ID), "rows": row, "row_max": row_max, "sizes": sizes, "masks": masks.tobytes(), "deltas": deltas}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("ids", pa.list_(pa.int64())), ("has_null", pa.bool_()), ("rows", pa.list_(pa.int32())), ("row_max", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("masks", pa.binary()), ("deltas", pa.list_(pa.int64()))])
        wait: list[pa.RecordBatch] = []

        def out() -> Iterator[pa.RecordBatch]:
            flat = pa.Table.from_batches(wait).combine_chunks()
            terms, tf = flat["terms"].combine_chunks(), flat["tf"].combine_chunks()
            one = grid(flat["doc_id"].to_pylist(), flat["n"].to_pylist(), np.diff(terms.offsets.to_numpy()), terms.flatten().to_numpy(), tf.flatten().to_numpy())
            wait.clear()
            if one:
                yield pa.RecordBatch.from_pylist([one], schema)

        for batch in batches:
            while batch.num_rows:
                free = columns - sum(b.num_rows for b in wait)
                wait.append(batch.slice(0, free))
                batch = batch.slice(min(free, batch.num_rows))
                if sum(b.num_rows for b in wait) >= columns:
                    yield from out()
        if wait:
            yield from out()

    return small_batches(rows).mapInArrow(trimmed(run), INDEX)


def search_index(index: DataFrame, asked: list[tuple[int, np.ndarray]], k: int) -> DataFrame:
    """(item, doc_id, score) of the best k documents of each task for each item (number, rows of its terms)."""
    held = index.sparkSession.sparkContext.broadcast(asked)  # at most BATCH_BYTES of texts, or one item

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        best = {item: empty for item, _ in held.value}
        for batch in batches:
            for i in range(batch.num_rows):
                c = {name: batch.column(name)[i] for name in batch.schema.names}
                values = {name: np.asarray(c[name].values) for name in ("ids", "rows", "row_max", "deltas")}
                one = Range(values["ids"], values["rows"].astype(np.int64), values["row_max"], c["sizes"].as_py(), np.frombuffer(c["masks"].as_py(), np.uint8), values["deltas"])
                for item, rows in held.value:
                    best[item] = one.search(rows, best[item], int(c["has_null"].as_py()), k)
        for item, (score, ids, nulls) in best.items():
            if len(score):
                ids = pa.array(ids, mask=(nulls == 1) & (ids == NULL_ID))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), item)), ids, pa.array(score)], ["item", "doc_id", "score"])

    return index.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def rank(docs: DataFrame, items: DataFrame, k: int = 10, columns: int = COLUMNS, name: str = "lexical") -> DataFrame:
    """The k best documents (doc_id, text) for each item (item_id, text): (item_id, rank, doc_id, score).

    Scores are those of the module's contract: weights floor(1000 ln((2N + 2) / (2 df + 1))), each term
    once; equal scores go by ascending doc_id, a null one last. Null and empty texts have no term: such a
    document is never found, such an item has no row. Every row is a document and every row an item of its
    own, ids repeated or not. Other columns aren't read. Items are searched in batches of at most
    ``BATCH_ITEMS`` rows and about ``BATCH_BYTES`` (one item is never split); each batch reads all documents
    once and makes an index of the terms it asks for. doc_id is an integer.
    """
    spark, keep = docs.sparkSession, Scratch(name)
    items = keep(items.select("item_id", F.array_distinct(terms_of(F.col("text"))).alias("terms")).filter("size(terms) > 0"), "items")
    total = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.array_join("terms", " ")).cast("long")).alias("b")).first()
    batches = max(1, -(-total["n"] // BATCH_ITEMS), -(-(total["b"] or 0) // BATCH_BYTES))
    out = []
    for batch in range(batches):
        own = items.filter(F.pmod(F.xxhash64("item_id", "terms"), F.lit(batches)) == batch).collect()  # bounded, see above
        terms = sorted({t for r in own for t in r["terms"]})
        number = {t: i for i, t in enumerate(terms)}
        found = keep(postings(docs.select("doc_id", "text"), terms), "postings")
        stats = found.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        df = np.zeros(len(terms), np.int64)
        for r in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row for each asked term at most
            df[r["t"]] = r["count"]
        weight = np.array([math.floor(1000 * math.log((2 * stats["docs"] + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        place = np.empty(len(terms), np.int64)
        place[np.lexsort((np.arange(len(terms)), -df))] = np.arange(len(terms))
        longest = max([len(r["terms"]) for r in own], default=1)
        index = keep(build_index(found, place, weight, stats["docs"], stats["terms"], max(64, min(columns, GRID_CELLS // longest))), "index")
        keep.drop(found)
        asked = [(i, np.sort(place[[number[t] for t in r["terms"]]])) for i, r in enumerate(own)]
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(own)], T.StructType([T.StructField("item", T.LongType()), items.schema["item_id"]]))
        best = search_index(index, asked, k).withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))))
        out.append(best.filter(F.col("rank") <= k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.unionByName, out)
