"""MinHash near-duplicates: one-permutation hashing, optimal densification, bands, star edges.

1. Each document's set of word shingles gives one minimum per bin (one permutation, cut into bins);
   an empty bin copies the bin that its own sequence of draws meets first (optimal densification).
2. Documents with equal sets are one class; only its least id goes on.
3. Bands of a few bins are bucket keys. In a bucket, the member that meets most documents in all its
   buckets is the centre and the others are compared with it: a star, not all pairs. A bucket whose other members then lie in several
   components gets the member that meets most others as a second centre; links between members that the
   centre isn't linked with are found by an index on what they differ from the centre in (see
   ``_around``). No link between two members of a bucket is lost unless other links join them.
4. Pairs are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from roadlens.llm.words import Scratch, mix, shingles, small_batches, text_chunks, trimmed
from roadlens.operators.components import components
from roadlens.session import materialize

BINS, BANDS = 128, 32
WORDS = 5
THRESHOLD = 80  # per cent
_DRAWS = 256
BINS_OF_ALLOWED = 8
BROADCAST_ROWS = 200_000
_ODD = np.random.default_rng(7).integers(1, 2**63, BINS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def densify(minima: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Fill empty bins of each row: bin i takes the value of the first filled bin that it draws.

    Draws depend on the bin alone, so equal sets agree. A row that still has empty bins after all
    draws takes the next filled bin in a circle. Rows without any value are left alone.
    """
    draws = np.random.default_rng(11).integers(0, BINS, (_DRAWS, BINS))
    out, rows = minima.copy(), np.flatnonzero(~filled.all(1) & filled.any(1))
    empty = ~filled
    for draw in draws:
        if not len(rows):
            return out
        take = empty[rows] & filled[np.ix_(rows, draw)]
        r, c = np.nonzero(take)
        out[rows[r], c] = minima[rows[r], draw[c]]
        empty[rows[r], c] = False
        rows = rows[empty[rows].any(1)]
    for row in rows:
        at = np.flatnonzero(filled[row])
        for c in np.flatnonzero(empty[row]):
            out[row, c] = minima[row, at[np.searchsorted(at, c) % len(at)]]
    return out


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """A row of band keys for each sorted set of 64-bit hashes."""
    minima, filled = np.zeros((len(sets), BINS), np.uint64), np.zeros((len(sets), BINS), bool)
    shift = np.uint64(64 - BINS.bit_length() + 1)
    for row, own in enumerate(sets):
        bins = (own >> shift).astype(np.int64)
        first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]]) if len(own) else bins
        minima[row, bins[first]] = own[first]
        filled[row, bins[first]] = True
    each = BINS // BANDS
    marked = (densify(minima, filled) * _ODD).reshape(len(sets), BANDS, each).sum(2, dtype=np.uint64)
    return mix(marked + np.arange(BANDS, dtype=np.uint64) * _ODD[0])


def _signatures(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(1)):
                sets = shingles(data, offsets, words)
                keys = band_keys(sets).view(np.int64)
                sums = [(int(s.sum(dtype=np.uint64).view(np.int64)), int(mix(s * _ODD[1]).sum(dtype=np.uint64).view(np.int64))) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[a:b],
                        batch.column(2)[a:b],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([s[0] for s in sums], pa.int64()),
                        pa.array([s[1] for s in sums], pa.int64()),
                        pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * BANDS, pa.array(keys.ravel())),
                    ],
                    ["doc_id", "h", "n_shingles", "sum1", "sum2", "bands"],
                )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(1)):
                sets = shingles(data, offsets, words)
                ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.ListArray.from_arrays(ends, pa.array(flat))], ["doc_id", "own"])

    return run


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, words: int = WORDS, name: str = "minhash") -> DataFrame:
    """(doc_id, text) to one row per row: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * common >= threshold * joint over their sets of shingles. A
    component's least doc_id is kept. Null or empty text has an empty set and is linked with nothing.
    A null doc_id is linked with nothing: component_id is null, kept is true. Rows that repeat a doc_id
    are one document, whose text is that of the row with the least text hash; n_shingles is each row's
    own. Order, ties and extra columns make no difference; a very long text is hashed in pieces; no rows
    give no rows.
    """
    text = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    signed = materialize(text.mapInArrow(trimmed(_signatures(words)), "doc_id long, h long, n_shingles long, sum1 long, sum2 long, bands array<long>"), f"{name}-signed")
    by = ["n_shingles", "sum1", "sum2"]
    named = signed.filter("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("h", *by)).alias("m")).select("doc_id", "m.*").filter("n_shingles > 0")
    classes = named.groupBy(*by).agg(F.min(F.struct("doc_id", "h")).alias("rep"), F.count(F.lit(1)).alias("copies"))
    scratch = Scratch(name)
    classes = scratch(classes.select(*by, "rep.*", "copies"), "classes")
    repeated = classes.filter("copies > 1").select(*by, F.col("doc_id").alias("b"))
    equal = named.select(F.col("doc_id").alias("a"), *by).join(repeated, by).select("a", "b").filter("a <> b")
    reps = signed.join(classes.select("doc_id", "h"), ["doc_id", "h"], "left_semi").dropDuplicates(["doc_id", "h"])

    banded = reps.select("doc_id", "h", "n_shingles", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = scratch(banded.join(shared, "bucket"), "members")
    ids = scratch(members.select("doc_id", "h").distinct(), "ids")
    if ids.count() <= BROADCAST_ROWS:  # of 16 bytes; more of them are joined by a shuffle of the texts
        ids = F.broadcast(ids)
    chosen = text.join(ids, ["doc_id", "h"], "left_semi").dropDuplicates(["doc_id", "h"]).select("doc_id", "text")
    sets = scratch(chosen.mapInArrow(trimmed(_sets(words)), "doc_id long, own array<long>"), "sets")
    linked = _star_edges(members, sets, threshold, scratch).unionByName(equal)
    comp = components(linked, name=f"{name}-components")
    scratch.clear()
    return (
        signed.select("doc_id", "n_shingles")
        .join(comp.select(F.col("id").alias("doc_id"), F.col("component").alias("found")), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("found", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Add ``linked`` to pairs (a, b), by the full sets."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("own").alias("own_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("own").alias("own_b"))
    both = F.size(F.array_intersect("own_a", "own_b"))
    return (
        pairs.join(left, "a").join(right, "b").withColumn("both", both)
        .select("a", "b", (100 * F.col("both") >= threshold * (F.size("own_a") + F.size("own_b") - F.col("both"))).alias("linked"))
    )


def _star_edges(members: DataFrame, sets: DataFrame, threshold: int, scratch: Scratch) -> DataFrame:
    """Confirmed edges (a, b) that connect all members of buckets that links connect."""
    # The centre is the member that meets most others in all its buckets: buckets of one group then share
    # few centres, so a document is compared with few of them, and these are likely to be linked with it.
    met_by = members.groupBy("doc_id").agg(F.sum("size").alias("meets"))
    centres = (
        members.join(met_by, "doc_id")
        .groupBy("bucket").agg(F.min(F.struct((-F.col("meets")).alias("m"), F.xxhash64("doc_id").alias("h"), "doc_id", "n_shingles")).alias("c"))
    )
    centres = centres.select("bucket", F.col("c.doc_id").alias("centre"), F.col("c.n_shingles").alias("centre_n"))
    met = members.join(centres, "bucket").filter("doc_id <> centre")
    sized = 100 * F.least("n_shingles", "centre_n") >= threshold * F.greatest("n_shingles", "centre_n")
    pairs = met.filter(sized).select(F.least("doc_id", "centre").alias("a"), F.greatest("doc_id", "centre").alias("b")).distinct()
    found = scratch(_confirmed(pairs, sets, threshold), "pairs")
    edges = found.filter("linked").select("a", "b")

    # Where the members that met a centre lie in several components, links among them may be missing.
    comp = components(edges, name=f"{scratch.name}-round").select(F.col("id").alias("doc_id"), "component")
    rest = met.select("bucket", "doc_id").join(comp, "doc_id", "left").select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("comp"))
    open_ = rest.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("bucket")
    rest = scratch(rest.join(open_, "bucket", "left_semi"), "rest")
    # The second centre is the member that meets most others in all its buckets: what it differs in is least.
    crowd = rest.groupBy("bucket").agg(F.count(F.lit(1)).alias("crowd"))
    met_by = rest.join(crowd, "bucket").groupBy("doc_id").agg(F.sum("crowd").alias("meets"))
    best = (
        rest.join(met_by, "doc_id")
        .groupBy("bucket").agg(F.min(F.struct((-F.col("meets")).alias("m"), "doc_id")).alias("c"))
        .select("bucket", F.col("c.doc_id").alias("centre"))
    )
    near = rest.join(best, "bucket").filter("doc_id <> centre").select("centre", "doc_id").distinct()
    return edges.unionByName(_around(near, edges, sets, found.select("a", "b"), threshold, scratch))


def _around(near: DataFrame, edges: DataFrame, sets: DataFrame, tested: DataFrame, threshold: int, scratch: Scratch) -> DataFrame:
    """Edges between each centre and its members (centre, doc_id), and among members that edges don't connect yet.

    With D(x) the n(x) elements in which x and the centre differ, x and y differ in n(x) + n(y) - 2 *
    common elements, and a link allows at most L = size * (100 - threshold) / threshold differences, with
    the size of either. So x and y need c = (n(x) + n(y) - L) / 2 common elements: with one order of the
    elements, the first of them lies among the first |D| - c + 1 elements of both. The other side's n
    is known by its bin, which is part of the key, so each side holds back as many elements as that bin
    asks for. Of its elements only those count that some member in that bin has as well: each element
    carries the bins of its members as bits (bins 64 apart share a bit, so a bit may say too much, never
    too little). Where fewer of them than c are left, the side has no row for the bin at all. Rare
    elements come first, those of one component only aren't held. How many kept elements meet
    bounds the common ones again. Members that a path of known links connects need no more links, so
    one of two is outside the component that most members are in: x here, one of ``far``.
    """
    ratio = (100 - threshold) / threshold
    left = sets.select(F.col("doc_id").alias("centre"), F.col("own").alias("own_c"))
    differ = near.join(left, "centre").join(sets, "doc_id").withColumn("delta", F.concat(F.array_except("own", "own_c"), F.array_except("own_c", "own")))
    joint = (F.size("own") + F.size("own_c") + F.size("delta")) / 2
    width = F.greatest(F.lit(1), F.floor(F.size("own_c") * ratio / BINS_OF_ALLOWED)).cast("int")  # the same for all of a centre
    differ = scratch(
        differ.select("centre", "doc_id", "delta", F.size("own").alias("size"), width.alias("width"), (100 * (joint - F.size("delta")) >= threshold * joint).alias("linked")), "differ"
    )
    own = differ.filter("linked").select(F.least("centre", "doc_id").alias("a"), F.greatest("centre", "doc_id").alias("b"))
    comp = components(edges.unionByName(own), name=f"{scratch.name}-second").select(F.col("id").alias("doc_id"), "component")
    apart = scratch(differ.select("centre", "doc_id").join(comp, "doc_id", "left").select("centre", "doc_id", F.coalesce("component", "doc_id").alias("comp")), "apart")
    parts = apart.groupBy("centre", "comp").agg(F.count(F.lit(1)).alias("k"))
    open_ = parts.groupBy("centre").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(F.struct("k", "comp")).alias("most")).filter("lo < hi")
    apart = apart.join(open_, "centre").select("centre", "doc_id", "comp", (F.col("comp") != F.col("most.comp")).alias("far"))
    differ = differ.join(apart, ["centre", "doc_id"]).withColumn("n", F.size("delta")).withColumn("bin", F.expr("n div width").cast("int"))
    differ = scratch(differ, "open")
    elements = differ.select("centre", "doc_id", "comp", "far", "bin", F.explode("delta").alias("e"))
    ends = [F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("far").alias("far"), F.count(F.lit(1)).alias("often")]
    by_bin = elements.groupBy("centre", "e", "bin").agg(*ends).withColumn("bit", F.expr("shiftleft(1L, bin % 64)"))
    ends = [F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("far").alias("far"), F.sum("often").alias("often")]
    # Bins of all members that have the element, of those of far, and bins with members of two components.
    bits = [F.bit_or("bit").alias("any"), F.bit_or(F.when(F.col("far"), F.col("bit"))).alias("outer"), F.bit_or(F.when(F.col("lo") < F.col("hi"), F.col("bit"))).alias("mixed")]
    common = by_bin.groupBy("centre", "e").agg(*ends, *bits).filter("lo < hi and far").select("centre", "e", "often", "any", "outer", F.coalesce("mixed", F.lit(0)).alias("mixed"))
    common = scratch(common, "common")
    shared = F.struct("often", "e", "any", "outer", "mixed")
    ordered = elements.select("centre", "doc_id", "e").join(common, ["centre", "e"]).groupBy("centre", "doc_id").agg(F.sort_array(F.collect_list(shared)).alias("own"))
    side = ["doc_id", "comp", "n", "size"]
    # Bins are few: a link allows as many differences as BINS_OF_ALLOWED of them, and no D is larger than both sets.
    bins = differ.groupBy("centre").agg(F.collect_set("bin").alias("bins"), F.collect_set(F.when(F.col("far"), F.col("bin"))).alias("far_bins"))
    held = scratch(ordered.join(differ.select("centre", "far", "width", "bin", *side), ["centre", "doc_id"]).join(bins, "centre"), "held")

    def kept(rows: DataFrame, other: str, bits: str) -> DataFrame:
        """The elements that each row keeps for each bin of the other side, whose bins are ``bits`` of an element."""
        most = F.col("size") * ratio + 0.001  # differences that a link allows

        def need(o: Column) -> Column:
            return F.greatest(F.lit(1), F.ceil((F.col("n") + o * F.col("width") - most) / 2).cast("int"))

        def meets(o: Column) -> Column:
            """Whether a link into the bin is possible: n differs by no more than the texts do, and what
            lies beyond the other side's n can't be common."""
            end = (o + 1) * F.col("width")
            possible = (o * F.col("width") <= F.col("n") + most) & (end > F.col("n") - most) & (need(o) <= F.size("own")) & (need(o) < end)
            return possible & (need(o) <= F.size(theirs(o)))

        def theirs(o: Column) -> Column:
            """The row's elements that members in the bin may have; in its own bin, of another component."""
            bit = F.pmod(o, F.lit(64))
            return F.filter("own", lambda x: (F.getbit(x[bits], bit) == 1) & ((o != F.col("bin")) | (F.getbit(x["mixed"], bit) == 1)))

        rows = rows.withColumn("other", F.explode(F.filter(other, meets))).withColumn("need", need(F.col("other"))).withColumn("own", theirs(F.col("other")))
        places = F.size("own") - F.col("need") + 1
        return rows.select("centre", "bin", "other", *side, (F.col("need") - 1).alias("rest"), F.explode(F.transform(F.slice("own", F.lit(1), places), lambda o: o["e"])).alias("e"))

    far = kept(held.filter("far"), "bins", "any").select("centre", "e", F.col("bin").alias("bin_x"), F.col("other").alias("bin"), *(F.col(c).alias(f"{c}_x") for c in (*side, "rest")))
    rare = kept(held, "far_bins", "outer").withColumnRenamed("other", "bin_x")
    allowed = F.least("size", "size_x") * ratio
    fits = (F.col("doc_id") != F.col("doc_id_x")) & (F.col("comp") != F.col("comp_x")) & (100 * F.least("size", "size_x") >= threshold * F.greatest("size", "size_x"))
    # Common elements are those met and, beyond the kept ones of the side whose places end first, what is left of it.
    met = (
        rare.join(far, ["centre", "e", "bin", "bin_x"]).filter(fits & (F.abs(F.col("n") - F.col("n_x")) <= allowed + 0.001))
        .groupBy("centre", "doc_id", "doc_id_x").agg(F.count(F.lit(1)).alias("met"), *(F.first(c).alias(c) for c in ("n", "size", "rest", "n_x", "size_x", "rest_x")))
        .filter(F.col("n") + F.col("n_x") - 2 * (F.col("met") + F.greatest("rest", "rest_x")) <= allowed + 0.001)
    )
    pairs = met.select(F.least("doc_id", "doc_id_x").alias("a"), F.greatest("doc_id", "doc_id_x").alias("b")).distinct().join(tested, ["a", "b"], "left_anti")
    more = scratch(_confirmed(pairs, sets, threshold), "more")
    return more.filter("linked").select("a", "b").unionByName(own)
