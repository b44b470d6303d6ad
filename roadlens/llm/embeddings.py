"""Embedding near-duplicates: Euclidean p-stable hashing in several tables, then exact cosines.

A normalised vector is projected on random directions, shifted and cut into cells of one width; a few
cells together are a bucket key, and there are many tables of such keys. Vectors of one bucket are
compared exactly, by blocks of bounded size: a large bucket is dealt out as pairs of blocks over many
tasks. A pair is counted in the first table in which it meets, so no pair is counted twice. Tasks
give link counts and local components, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from roadlens.operators.components import components
from roadlens.session import discard, materialize

COSINE = 0.93
TABLES, PROJECTIONS, WIDTH = 32, 10, 2.0
BLOCK = 1024
SMALL = 32  # pairs of buckets of so many rows are made together
ROWS = 8192  # of whole buckets that are compared at a time


def _hashes(dims: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(3)
    return draw.standard_normal((dims, TABLES * PROJECTIONS)), draw.uniform(0, WIDTH, TABLES * PROJECTIONS)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a 32-bit bucket for each table; vectors of unlike length get unlike buckets, mostly."""
    odd = np.random.default_rng(4).integers(1, 2**63, TABLES * PROJECTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    held: dict = {}
    for batch in batches:
        vectors = batch.column(batch.schema.names.index("vector"))
        sizes = np.diff(np.asarray(vectors.offsets))
        keys = np.zeros((batch.num_rows, TABLES), np.int32)
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("f8")
        starts = np.cumsum(np.r_[0, sizes])
        for dims in np.unique(sizes):
            if dims not in held:
                held[dims] = _hashes(int(dims))
            rows = np.flatnonzero(sizes == dims)
            own = _unit(flat[starts[rows][:, None] + np.arange(dims)])
            a, b = held[dims]
            cells = np.floor((own @ a + b) / WIDTH).astype(np.int64).view(np.uint64) * odd
            mixed = cells.reshape(len(rows), TABLES, PROJECTIONS).sum(2, dtype=np.uint64) + np.uint64(dims)
            mixed = (mixed + np.arange(TABLES, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            keys[rows] = (mixed >> np.uint64(32)).astype(np.uint32).view(np.int32)
        keys = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * TABLES, pa.array(keys.ravel()))
        yield pa.RecordBatch.from_arrays([*batch.columns, keys], [*batch.schema.names, "keys"])


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest component first, so that no square over- or underflows."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def _compare(cosine: float):
    """Rows sorted by bucket and block pair to (vec_id, n, root) for each vector that has a link there."""

    def matrix(vectors: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        i, j = np.nonzero(vectors[left] @ vectors[right].T >= cosine)
        return left[i], right[j]

    def within(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all pairs inside each of several small groups."""
        row = np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        later = np.repeat(first + size, size) - row - 1
        i = np.repeat(row, later)
        return i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later)

    def close(rows: pa.Table, where: np.ndarray):
        """Whole groups, which start at ``where``."""
        rows = rows.combine_chunks()
        ids, copies, side, table = (np.asarray(rows[c]) for c in ("vec_id", "copies", "side", "table"))
        lists = rows["vector"].chunk(0)
        dims = np.diff(np.asarray(lists.offsets))
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype("f8")
        begin = np.cumsum(np.r_[0, dims])
        keys = rows["keys"].chunk(0).flatten().to_numpy().reshape(-1, TABLES)
        ends = np.r_[where[1:], len(ids)]
        tiny = (ends - where <= SMALL) & (side[where] == 2)
        i, j = within(where[tiny], (ends - where)[tiny])
        same = dims[i] == dims[j]
        i, j = i[same], j[same]
        found = [(np.zeros(0, np.int64),) * 2]
        for d in np.unique(dims[i]):
            a, b = i[dims[i] == d], j[dims[i] == d]
            for at in range(0, len(a), 20_000):
                x, y = a[at : at + 20_000], b[at : at + 20_000]
                near = (_unit(flat[begin[x][:, None] + np.arange(d)]) * _unit(flat[begin[y][:, None] + np.arange(d)])).sum(1) >= cosine
                found.append((x[near], y[near]))
        for a, b in zip(where[~tiny], ends[~tiny], strict=True):
            for d in np.unique(dims[a:b]):
                own = a + np.flatnonzero(dims[a:b] == d)
                x, y = matrix(_unit(flat[begin[own][:, None] + np.arange(d)]), side[own])
                found.append((own[x], own[y]))
        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        ok = np.where(side[i] == 2, ids[i] < ids[j], ids[i] != ids[j])
        ok |= (side[i] == 2) & (ids[i] > ids[j]) & np.repeat(tiny, ends - where)[i]  # each pair of a small group is met once
        # A pair counts in the first table in which it meets.
        ok[ok] &= ((keys[i[ok]] == keys[j[ok]]) & (np.arange(TABLES) < table[i[ok]][:, None])).sum(1) == 0
        i, j = i[ok], j[ok]
        if not len(i):
            return None
        n = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        root = ids.copy()
        while True:
            least = np.minimum(root[i], root[j])
            new = root.copy()
            np.minimum.at(new, i, least)
            np.minimum.at(new, j, least)
            if (new == root).all():
                break
            root = new
        hit = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(n[hit].astype(np.int64)), pa.array(root[hit])], ["vec_id", "n", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            rest = now if rest is None else pa.concat_tables([rest, now])
            while rest.num_rows:
                turn = np.zeros(rest.num_rows - 1, bool)
                for c in ("label", "table", "bucket", "bi", "bj"):
                    column = rest[c].combine_chunks()
                    turn |= np.asarray(pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False), bool)
                where = np.r_[0, np.flatnonzero(turn) + 1]
                # The last group may go on in the next batch.
                last = np.searchsorted(where, ROWS, "right") - 1 if where[-1] > ROWS else len(where) - 1
                last = max(1, last) if len(where) > 1 else 0
                if not last:
                    break
                if (out := close(rest.slice(0, where[last]), where[:last])) is not None:
                    yield out
                rest = rest.slice(where[last])
        if rest is not None and rest.num_rows > 1 and (out := close(rest, np.zeros(1, np.int64))) is not None:
            yield out

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK, name: str = "embed") -> DataFrame:
    """(vec_id, embedding, label) to one row per row: vec_id, n_links, component_id, kept.

    Vectors are compared if their labels are equal and not null, in double precision; a label is of any
    type that casts to a string. Null, zero or empty vectors, and vectors with null or non-finite
    components, are linked with nothing; so are
    rows with a null vec_id (component_id null, kept true). Vectors of unlike length aren't compared.
    Equal vectors of one label are compared once and counted for each copy. Rows that repeat a vec_id
    are one vector: of those that can be compared the least by label, then components. Order and extra
    columns make no difference. No rows give no rows.
    """
    single = dict(vectors.dtypes)["embedding"] == "array<float>"  # doubles and others are kept as doubles
    kind = "float" if single else "double"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast(f"array<{kind}>").alias("vector"))
    sound = F.expr("size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(vector, x -> x <> 0)")
    # -0 and 0 are one value in a copy's key.
    valid = rows.filter("vec_id is not null and label is not null and vector is not null").filter(sound).withColumn("vector", F.expr(f"transform(vector, x -> x + {kind}(0))"))
    valid = materialize(valid.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("m")).select("vec_id", "m.*"), f"{name}-valid")
    keyed = valid.select("vec_id", "label", F.xxhash64("vector").alias("h1"), F.xxhash64(F.reverse("vector"), F.lit(1)).alias("h2"))
    copies = keyed.groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    member = keyed.join(copies.filter("copies > 1"), ["label", "h1", "h2"]).select("vec_id", "rep", "copies")
    member = materialize(member, f"{name}-copies")
    reps = valid.join(member.filter("vec_id <> rep").select("vec_id"), "vec_id", "left_anti").join(member.filter("vec_id = rep").select("vec_id", "copies"), "vec_id", "left")
    reps = reps.select("vec_id", F.coalesce("copies", F.lit(1)).cast("long").alias("copies"), "label", "vector")
    hashed = materialize(reps.mapInArrow(_keys, f"vec_id long, copies long, label string, vector array<{kind}>, keys array<int>"), f"{name}-keys")

    # Buckets are sized and dealt out by ids alone; a vector travels only to buckets that it shares.
    at = ["label", "table", "bucket"]
    spread = hashed.select("vec_id", "label", F.posexplode("keys").alias("table", "bucket"))
    sizes = spread.groupBy(*at).agg(F.count(F.lit(1)).alias("size")).filter("size > 1").withColumn("blocks", F.ceil(F.col("size") / block).cast("int")).drop("size")
    sizes = materialize(sizes, f"{name}-buckets")
    dealt = spread.join(sizes, at).withColumn("own", F.pmod(F.xxhash64("vec_id", "bucket"), F.col("blocks")).cast("int"))
    met = dealt.groupBy("vec_id").agg(F.collect_list(F.struct("table", "bucket", "own", "blocks")).alias("met"))  # at most TABLES a vector
    pairs = hashed.join(met, "vec_id").select("vec_id", "copies", "label", "vector", "keys", F.inline("met"))
    pairs = pairs.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    pairs = pairs.withColumn("bi", F.least("own", "other")).withColumn("bj", F.greatest("own", "other"))
    pairs = pairs.withColumn("side", F.when(F.col("bi") == F.col("bj"), 2).when(F.col("own") == F.col("bi"), 0).otherwise(1))
    order = [*at, "bi", "bj"]
    pairs = pairs.select(*order, "side", "vec_id", "copies", "vector", "keys")
    parts = max(8, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    each = materialize(pairs.repartition(parts, *order).sortWithinPartitions(*order).mapInArrow(_compare(cosine), "vec_id long, n long, root long"), f"{name}-found")
    found = materialize(each.groupBy("vec_id", "root").agg(F.sum("n").alias("n")), f"{name}-summed")

    n = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
    comp = components(
        found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")).unionByName(member.select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))), name=f"{name}-components"
    )
    for spent in (valid, hashed, sizes, each):
        discard(spent)
    return (
        rows.select("vec_id").join(member, "vec_id", "left").withColumn("rep", F.coalesce("rep", "vec_id"))
        .join(n.withColumnRenamed("vec_id", "rep"), "rep", "left").join(comp.select(F.col("id").alias("vec_id"), "component"), "vec_id", "left")
        .select(
            "vec_id", (F.coalesce("n", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
