"""Toxicity, ranked search and conversation repair against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib

import pytest

from roadlens.llm import chat_repair, lexical, toxicity

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(lexical.UPPER, lexical.LOWER)


# --- ranked search -----------------------------------------------------------------------------------------


def searched(docs, items, k=10):
    terms = [TERM.findall((t or "").translate(LOWER)) for _, t in docs]
    n_docs, n_terms = sum(1 for t in terms if t), sum(map(len, terms))
    out = []
    for item, text in items:
        found = []
        asked = set(TERM.findall((text or "").translate(LOWER)))
        df = {w: sum(w in t for t in terms) for w in asked}
        for (doc, _), own in zip(docs, terms):
            score, m = 0, 10 + (90 * len(own) * n_docs) // max(1, n_terms)
            for w in asked:
                tf = own.count(w)
                if tf:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, f[3], -f[0]) for i, f in enumerate(sorted(found, key=lambda f: f[:3])[:k])]
    return sorted(out, key=str)


def ranked(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.rank(d, i, **kw).collect()], key=str)


@pytest.mark.parametrize("columns", [64, 4096])
def test_search_equals_brute_force(spark, columns):
    rng = random.Random(columns)
    words = [f"w{i}" for i in range(60)] + ["Éa", "É"]
    text = lambda n: " ".join(rng.choice(words[: rng.choice([5, 20, 62])]).capitalize() for _ in range(n))
    docs = [(i, text(rng.randint(0, 30))) for i in range(300)] + [(900, "w1 w2 w3"), (901, "w1 w2 w3"), (901, "w1 w2 w3"), (None, "w1 w2 w3"), (902, None), (903, "")]
    items = [(i, text(rng.randint(1, 12))) for i in range(12)] + [(50, "w1-w2.w3"), (51, None), (52, ""), (53, "unheard"), (50, "W1")]
    assert ranked(spark, docs, items, columns=columns) == searched(docs, items)


def test_search_of_copies_long_texts_and_empty_tables(spark):
    docs = [(i, "same words here") for i in range(500)] + [(1000, "same " * 120_000 + "rare")]
    items = [(1, "same rare"), (2, "here")]
    assert ranked(spark, docs, items) == searched(docs, items)
    assert ranked(spark, [], items) == ranked(spark, docs, []) == []


def test_search_ignores_other_columns(spark):
    d = spark.createDataFrame([(1, "a b", 7, "x")], "doc_id long, text string, score long, item string")
    i = spark.createDataFrame([(5, "b", 9)], "item_id long, text string, doc_id long")
    assert [(r.item_id, r.doc_id) for r in lexical.rank(d, i).collect()] == [(5, 1)]


# --- conversation repair -----------------------------------------------------------------------------------


def least(symbols):
    """(cost, edits, kept) by plain dynamic programming over whole edit strings."""
    follow = {0: 2, 1: 2, 2: 3, 3: 2}
    keep = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    name = {2: "user", 3: "assistant"}

    def inserted(now):
        todo = list(now)
        while todo:
            q = todo.pop()
            to, (c, e, t) = follow[q], now[q]
            new = (c + 2, e + "I", (*t, f"{name[to]}:"))
            if to not in now or new[:2] < now[to][:2]:
                now[to] = new
                todo.append(to)
        return now

    now = inserted({0: (0, "", ())})
    for role, text, gone, cut in symbols:
        new = {}
        for q, (c, e, t) in now.items():
            ways = [(q, (c + 3, e + "D", t))]
            if not gone:
                if (q, role[:1]) in keep:
                    ways.append((keep[q, role[:1]], (c + cut, e + "K", (*t, f"{role}:{text}"))))
                ways.append((follow[q], (c + 2 + cut, e + "R", (*t, f"{name[follow[q]]}:{text}"))))
            for to, way in ways:
                if to not in new or way[:2] < new[to][:2]:
                    new[to] = way
        now = inserted(new)
    return min((now[q] for q in (0, 3) if q in now), key=lambda w: w[:2])


def repaired(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest()))
        seen, symbols, n = set(), [], [0, 0, 0, 0]
        for i, (_, role, text) in enumerate(own):
            blank, again = not re.search(r"[^\x20\x09-\x0D]", text), (role, text) in seen
            cut = not blank and re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1] not in ".!?"
            n[0 if blank else 1 if again else 2] += blank or again or cut
            n[3] += i > 0 and own[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
            symbols.append((role, text, blank or again, int(cut and not again)))
            seen.add((role, text))
        turns = {t for t, _, _ in own if t is not None}
        cost, edits, said = least(symbols)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *n, cost, edits, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def found(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    return {r[0]: tuple(r[1:]) for r in chat_repair.repair(df).collect()}


def random_rows(rng, n_conv, n_rows):
    texts = ["Yes.", "No", " ", "", "What? ", "é!\n", "line\nmore", "Yes.  "]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    return [(c if c else None, rng.choice([None, i, i + 1, 2 * i]), rng.choice(roles), rng.choice([*texts, None, f"{i} said."])) for c in range(n_conv) for i in range(rng.randint(1, n_rows))]


def test_repair_equals_brute_force(spark):
    rows = random_rows(random.Random(3), 60, 14)
    assert found(spark, rows) == repaired(rows)


def test_repair_across_chunks_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(chat_repair, "CHUNK_ROWS", 4)
    rng = random.Random(4)
    rows = random_rows(rng, 6, 12) + [(77, i, rng.choice(["user", "assistant", "system"]), rng.choice([f"{i}.", "x", "Yes."])) for i in range(400)]
    assert found(spark, rows) == repaired(rows)


def test_repair_of_repeats_and_no_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 1, "assistant", "x" * 300_000 + ".")]
    assert found(spark, rows) == repaired(rows)
    assert found(spark, rows)[1][:7] == (0, 0, 1, 0, 1, 3, "KDK")
    assert found(spark, []) == {}


def test_damage_by_checksum(spark):
    rows = [(c, t, "assistant", "a. b! c?") for c in range(12) for t in range(8)]
    got = chat_repair.damage(spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, kind int")).collect()
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(c, t, "user" if kind == 4 else role, text, i) for i in range(0 if kind == 0 else 2 if kind == 3 else 1)]
    assert sorted(map(tuple, got)) == sorted(want)


# --- toxicity ----------------------------------------------------------------------------------------------


def auc(pairs):
    pairs = sorted(pairs)
    ones = sum(y for _, y in pairs)
    return (sum(i for i, (_, y) in enumerate(pairs) if y) - ones * (ones - 1) / 2) / (ones * (len(pairs) - ones))


def made_up(rng, n):
    part = ["tha", "ion", "er", "ing", "nd", "st", "ou", "ea", "or", "es"]
    word = lambda: "".join(rng.choice(part) for _ in range(rng.randint(1, 3)))
    bad = ["gronkwad", "zliptox", "fumblek"]
    return [(i, " ".join(rng.choice(bad) if i % 3 == 0 and rng.random() < 0.06 else word() for _ in range(rng.randint(60, 200))), int(i % 3 == 0)) for i in range(n)]


@pytest.fixture(scope="module")
def model(spark):
    rows = made_up(random.Random(1), 600)
    df = spark.createDataFrame(rows, "id long, text string, toxic int")
    return toxicity.fit(df, df, "id")


def test_toxicity_of_unseen_rows(spark, model):
    rows = made_up(random.Random(2), 300)
    got = toxicity.score(spark.createDataFrame(rows, "id long, text string, toxic int"), model).collect()
    assert auc([(r.score, r.toxic) for r in got]) > 0.97
    assert sum((r.score >= 0.5) == bool(r.toxic) for r in got) > 0.93 * len(got)


def test_toxicity_of_odd_rows(spark, model):
    # A text over a chunk is cut into pieces; its bad words are at its end.
    long = "there ion sting or " * 20_000 + "gronkwad zliptox fumblek " * 2000
    rows = [(1, None, 5.0), (2, "", 5.0), (3, long, 5.0), (3, long, 5.0), (4, "x" * 500_000, 5.0)]
    got = {}
    for r in toxicity.score(spark.createDataFrame(rows, "id long, text string, score double"), model).collect():
        got.setdefault(r.id, []).append(r.score)
    assert all(0 <= s <= 1 for v in got.values() for s in v)
    assert got[1] == got[2] and len(got[3]) == 2 and got[3][0] == got[3][1] > got[2][0]
    assert toxicity.score(spark.createDataFrame([], "id long, text string"), model).count() == 0


def test_fit_of_no_or_one_sided_rows(spark):
    for rows in ([], [(None, "x", 1), (1, "a", 0), (1, "b", 1)], [(1, "fine words", 0)], [(1, "bad words", 1), (2, None, 0), (3, "more", None)]):
        df = spark.createDataFrame(rows, "id long, text string, toxic int")
        one = toxicity.fit(df, df, "id")
        got = toxicity.score(spark.createDataFrame([(1, "any")], "id long, text string"), one).first()
        assert 0 <= got.score <= 1


def test_held_out_by_checksum(spark):
    got = spark.range(200).select("id", toxicity.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)
