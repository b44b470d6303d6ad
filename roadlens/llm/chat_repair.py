"""Repair of conversation structure at least cost, by tables of blocks of symbols (four Russians).

A row is one of nine symbols: its role initial (s, u, a or another) with or without truncated text, or a
row that has to go. Roles have to read ``(s?(ua)+)?``, an automaton of four states. For a place in a
conversation the costs of what is left from each state are a vector; less its least number it is one of a
few dozen. What a block of ``BLOCK`` symbols makes of each vector is tabled once: a vector and a number to add.

Conversations are dealt out by order, so a long one is spread over tasks: a chunk of at most ``CHUNK_ROWS``
rows is a row here. Block by block from its end, a chunk gives the costs from each of its first states to each of
its last ones. Two passes over these small rows, each with a state of constant size, give every chunk the
costs behind it and the state before it. Then blocks are expanded, backwards with the costs behind them,
and the edits are taken forwards: the one of least ASCII that is still cheapest, which is right for ties, since
an edit's initial fixes the state after it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import product

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from roadlens.llm.words import Scratch, small_batches

BLOCK = 3
CHUNK_ROWS, CHUNK_CHARS = 1024, 1 << 20
GONE = 8  # symbols: 2 * role (s, u, a, other) + truncated, or GONE
START, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 40
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
_INSERT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_KEEP = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
_END = {START: 0, ASSISTANT: 0}
Vector = tuple[int, int, int, int]


def _moves(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """Edits (initial, cost, next state) that use up a symbol."""
    out = [("D", DELETE, state)]
    if symbol != GONE:
        extra = TRUNCATED * (symbol & 1)
        if (kept := _KEEP.get((state, symbol >> 1))) is not None:
            out.append(("K", extra, kept))
        out.append(("R", REROLE + extra, _INSERT[state]))  # the only user or assistant that fits here
    return out


def _with_inserts(costs: list[int]) -> Vector:
    for _ in range(3):  # a way of inserts passes each state once
        costs = [min(c, INSERT + costs[_INSERT[q]]) for q, c in enumerate(costs)]
    return tuple(min(c, NEVER) for c in costs)


@cache
def _step(after: Vector, symbol: int) -> Vector:
    """Costs before a symbol from the costs after it."""
    return _with_inserts([min(c + after[q] for _, c, q in _moves(state, symbol)) for state in range(4)])


@cache
def _normal(v: Vector) -> tuple[Vector, int]:
    least = min(v)  # never NEVER: deleting every row leads from a state to itself
    return tuple(c - least if c < NEVER else NEVER for c in v), least


END = _with_inserts([_END.get(q, NEVER) for q in range(4)])
UNITS = tuple(tuple(0 if q == j else NEVER for q in range(4)) for j in range(4))


@cache
def tables() -> tuple[list[Vector], dict[Vector, int], list[list[tuple[int, int]]]]:
    """(vectors, their numbers, for each block of symbols and vector the vector before it and what to add)."""
    ends = [END, *(_step(unit, symbol) for unit in UNITS for symbol in range(GONE + 1))]
    vectors = list(dict.fromkeys(_normal(v)[0] for v in ends))
    number = {v: i for i, v in enumerate(vectors)}
    for v in vectors:  # grows while it is read
        for symbol in range(GONE + 1):
            w = _normal(_step(v, symbol))[0]
            if w not in number:
                number[w] = len(vectors)
                vectors.append(w)
    blocks = []
    for block in product(range(GONE + 1), repeat=BLOCK):
        line = []
        for v in vectors:
            total = 0
            for symbol in reversed(block):
                v, more = _normal(_step(v, symbol))
                total += more
            line.append((number[v], total))
        blocks.append(line)
    return vectors, number, blocks


def _code(symbols: bytes, at: int) -> int:
    code = 0
    for s in symbols[at : at + BLOCK]:
        code = code * (GONE + 1) + s
    return code


def _back(symbols: bytes, after: Vector) -> tuple[list[Vector], int, Vector]:
    """(vector behind each whole block, least cost, vector before all) of a chunk: blocks by lookup, the rest by steps."""
    vectors, number, blocks = tables()
    v, total = _normal(after)
    whole = len(symbols) // BLOCK * BLOCK
    for symbol in reversed(symbols[whole:]):
        v, more = _normal(_step(v, symbol))
        total += more
    at, behind = number[v], []
    for i in range(whole - BLOCK, -1, -BLOCK):
        behind.append(vectors[at])
        at, more = blocks[_code(symbols, i)][at]
        total += more
    return behind[::-1], total, vectors[at]


def chunk_costs(symbols: bytes) -> list[int]:
    """Costs from each first state to each last one of a chunk that isn't empty, row by row; inserts behind it aren't in them."""
    columns = []
    for unit in UNITS:
        _, total, v = _back(symbols[:-1], _step(unit, symbols[-1]))
        columns.append([min(c + total, NEVER) for c in v])
    return [columns[j][i] for i in range(4) for j in range(4)]


def costs_before(costs: list[int], after: Vector) -> Vector:
    """Costs before a chunk from its costs and those behind it, inserts included."""
    return _with_inserts([min(costs[i * 4 + j] + after[j] for j in range(4)) for i in range(4)])


def trace(symbols: bytes, after: Vector, state: int) -> tuple[str, list[int], int]:
    """(edits in order, state before each of them, last state) of a chunk at least cost and least ASCII.

    ``after`` are the costs behind the chunk with its inserts. Inserts behind the last symbol are the next
    chunk's, or those of ``finish``.
    """
    behind = _back(symbols, after)[0]
    whole = len(behind) * BLOCK
    edits, states = [], []
    for at, last in [*((i * BLOCK, v) for i, v in enumerate(behind)), (whole, _normal(after)[0])]:
        block = symbols[at : at + BLOCK]
        inner = [last]
        for symbol in reversed(block):
            inner.append(_step(inner[-1], symbol))
        inner.reverse()  # costs before each symbol of the block, and behind the last
        for i, symbol in enumerate(block):
            initial = "I"
            while initial == "I":
                here = inner[i][state]
                ways = [m for m in _moves(state, symbol) if m[1] + inner[i + 1][m[2]] == here]
                if INSERT + inner[i][_INSERT[state]] == here:
                    ways.append(("I", INSERT, _INSERT[state]))
                initial, _, following = min(ways)
                edits.append(initial)
                states.append(state)
                state = following
    return "".join(edits), states, state


def finish(state: int) -> tuple[str, list[int], int]:
    """Inserts at the end of a conversation."""
    states = []
    while state not in _END:
        states.append(state)
        state = _INSERT[state]
    return "I" * len(states), states, state


# --- Spark ------------------------------------------------------------------------------------------------

_SOLID = r"[^\x20\x09-\x0D]"


def faults(rows: DataFrame, keep: Scratch) -> DataFrame:
    """Rows (conv_id, turn, role, text, copy) with their fault: blank, duplicate, truncated or null, the first that holds."""
    rows = keep(rows.withColumn("n", F.monotonically_increasing_id()).withColumn("said", F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)), "rows")
    place = F.struct(F.col("turn").isNotNull().alias("dated"), "turn", "role", "said", "copy", "n")
    # A duplicate is any row but the first with its words: first places are made before the shuffle, and the
    # join may split a conversation's rows.
    first = rows.groupBy("conv_id", "said").agg(F.min(place).alias("first"))
    own = rows.withColumn("place", place).alias("r").join(first.alias("f"), F.col("r.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("r.said") == F.col("f.said")), "left")
    blank = ~F.col("r.text").rlike(_SOLID)
    truncated = ~F.col("r.text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(blank, "blank").when(F.col("place") != F.col("first"), "duplicate").when(truncated, "truncated")
    return own.select("r.conv_id", "r.turn", "r.role", "r.text", "place", fault.alias("fault"))


def _symbol() -> Column:
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.when(F.col("fault").isin("blank", "duplicate"), GONE).otherwise(role * 2 + F.when(F.col("fault") == "truncated", 1).otherwise(0)).cast("tinyint")


CHUNKS = "symbols binary, roles array<string>, texts array<string>, costs array<bigint>, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_turn bigint, last_turn bigint, n_turns bigint"
_LEGAL = ("su", "ua", "au")


def _schema(rows: DataFrame, ddl: str) -> T.StructType:
    return T.StructType([rows.schema["key"], *T.StructType.fromDDL(ddl)])


def _chunks(rows: DataFrame) -> DataFrame:
    """Rows with faults to chunks (key, part, chunk): rows of one conversation that follow each other in one task."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(F.col("conv_id").alias("id")).alias("key")
    dealt = rows.select(key, "place", "turn", "role", "text", "fault", _symbol().alias("symbol")).repartitionByRange(parts, "key", "place")
    dealt = dealt.sortWithinPartitions("key", "place").drop("place")
    out = _schema(dealt, f"part int, chunk bigint, {CHUNKS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, wait = TaskContext.get().partitionId(), 0, []

        def made(own: list[dict]) -> dict:
            symbols, initials = bytes(r["symbol"] for r in own), [r["role"][:1] for r in own]
            turns = [r["turn"] for r in own if r["turn"] is not None]
            n = {f: sum(r["fault"] == f for r in own) for f in ("blank", "duplicate", "truncated")}
            illegal = sum(a + b not in _LEGAL for a, b in zip(initials[:-1], initials[1:], strict=True))
            edge = {"first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "n_turns": len(set(turns))}
            return n | edge | {"key": own[0]["key"], "part": part, "chunk": chunk, "symbols": symbols, "roles": [r["role"] for r in own], "texts": [r["text"] for r in own], "costs": chunk_costs(symbols), "illegal": illegal}

        own, chars, schema = [], 0, None
        for batch in batches:
            text = pa.list_(pa.string())
            kinds = {"part": pa.int32(), "symbols": pa.binary(), "roles": text, "texts": text, "costs": pa.list_(pa.int64()), "key": batch.schema.field("key").type}
            schema = pa.schema([(f.name, kinds.get(f.name, pa.int64())) for f in out])
            for r in batch.to_pylist():
                if own and (r["key"] != own[0]["key"] or len(own) >= CHUNK_ROWS or chars >= CHUNK_CHARS):
                    wait.append(made(own))
                    own, chars, chunk = [], 0, chunk + 1
                own.append(r)
                chars += len(r["text"])
            if wait:
                yield pa.RecordBatch.from_pylist(wait, schema)
                wait = []
        if own:
            yield pa.RecordBatch.from_pylist([made(own)], schema)

    return small_batches(dealt).mapInArrow(run, out)


def _behind(chunks: DataFrame) -> DataFrame:
    """(key, part, chunk, after): the costs behind each chunk, inserts included; runs from the last chunk to the first."""
    light = chunks.select("key", "part", "chunk", "costs").repartition("key").sortWithinPartitions("key", F.desc("part"), F.desc("chunk"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, after = None, END
        for batch in batches:
            out = []
            for r in batch.select(["key", "costs"]).to_pylist():
                if r["key"] != key:
                    key, after = r["key"], END
                out.append(after)
                after = costs_before(r["costs"], after)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.list_(pa.int64()))], ["key", "part", "chunk", "after"])

    return light.mapInArrow(run, T.StructType([*light.drop("costs").schema.fields, T.StructField("after", T.ArrayType(T.LongType()))]))


RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


class _Conversation:
    """What is known of a conversation after its chunks so far; texts only pass through the digest."""

    def __init__(self, key: dict):
        self.key, self.state, self.audit, self.cost, self.digest, self.any = key, START, [], 0, hashlib.sha256(), False
        self.n = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.turns, self.first, self.last, self.role = 0, None, None, None

    def say(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True

    def edit(self, edits: str, states: list[int], rows: Iterator[tuple[int, str, str]]) -> None:
        for initial, state in zip(edits, states, strict=True):
            role = "user" if _INSERT[state] == USER else "assistant"
            if initial == "I":
                self.cost += INSERT
                self.say(role, "")
                continue
            symbol, own, text = next(rows)
            if initial == "D":
                self.cost += DELETE
                continue
            self.cost += TRUNCATED * (symbol & 1) + REROLE * (initial == "R")
            self.say(role if initial == "R" else own, text)
        self.audit.append(edits)

    def add(self, r: dict, after: Vector) -> None:
        for name in self.n:
            self.n[name] += r[name]
        self.n["illegal"] += self.role is not None and self.role + r["roles"][0][:1] not in _LEGAL
        self.role = r["roles"][-1][:1]
        if r["first_turn"] is not None:
            self.turns += r["n_turns"] - (r["first_turn"] == self.last)
            self.first, self.last = r["first_turn"] if self.first is None else self.first, r["last_turn"]
        edits, states, self.state = trace(r["symbols"], after, self.state)
        self.edit(edits, states, zip(r["symbols"], r["roles"], r["texts"], strict=True))

    def row(self) -> dict:
        edits, states, _ = finish(self.state)
        self.edit(edits, states, iter(()))
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return self.n | {"key": self.key, "gaps": gaps, "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest()}


def repair(rows: DataFrame, name: str = "repair") -> DataFrame:
    """Rows (conv_id, turn, role, text, and copy for repeats) to one row for each conversation: faults, edits, digest.

    Rows go by turn, null turns first, then by role and text; a null role or text is one space. Only user, assistant
    and system rows can stay as they are, told by their role's first letter. An empty or blank text is a
    blank row, a row that equals an earlier one in role and text is a duplicate, repeated rows of the table too. Rows
    without a conv_id are one conversation. No rows give no rows; other columns aren't read. The texts of a
    conversation pass through one task for their digest, one chunk in memory at a time; its edits are
    one string, as long as it has rows.
    """
    keep = Scratch(name)
    said = lambda c: F.coalesce(c, F.lit(" ")).alias(c)
    copy = F.col("copy").cast("int") if "copy" in rows.columns else F.lit(0)
    rows = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), said("role"), said("text"), copy.alias("copy"))
    chunks = keep(_chunks(faults(rows, keep)), "chunks")
    # The costs behind a chunk come right before it: one shuffle carries both.
    both = chunks.drop("costs").withColumn("after", F.lit(None).cast("array<bigint>")).unionByName(_behind(chunks), allowMissingColumns=True)
    both = both.repartition("key").sortWithinPartitions("key", "part", "chunk", F.col("after").isNull())
    out = _schema(both, RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, after, done, schema = None, END, [], None
        for batch in batches:
            schema = pa.schema([(f.name, batch.schema.field("key").type if f.name == "key" else pa.string() if f.name in ("audit", "repaired_sha256") else pa.int64()) for f in out])
            for i in range(batch.num_rows):
                r = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if r["after"] is not None:
                    after = tuple(r["after"])
                    continue
                if now is None or r["key"] != now.key:
                    done += [now.row()] if now else []
                    now = _Conversation(r["key"])
                now.add(r, after)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if now:
            yield pa.RecordBatch.from_pylist([now.row()], schema)

    return both.mapInArrow(run, out).select(F.col("key.id").alias("conv_id"), *[f.split(" ")[0] for f in RESULT.split(", ")])


def damage(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) damaged by the CRC-32 of ``conv_id:turn``, with ``copy`` for repeats.

    Of twenty remainders 0 drops a row, 1 empties its text, 2 removes its full stops, 3 repeats it and 4 makes it the
    user's. Nulls are one space, in what is hashed too.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), (F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
