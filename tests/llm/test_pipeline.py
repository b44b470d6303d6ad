import collections
import random

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)


def _cut(text, others, words=51, length=400):
    """What brute force leaves of a text: without words that others share and bytes that occur elsewhere."""
    spans, at = [], 0
    for w in text.split():
        at = text.index(w, at)
        spans.append((at, at + len(w)))
        at += len(w)
    own, hit = text.split(), bytearray(len(text))
    theirs = {tuple(o.split()[k : k + words]) for o in others for k in range(len(o.split()) - words + 1)}
    for k in range(len(own) - words + 1):
        if tuple(own[k : k + words]) in theirs:
            a, b = spans[k][0], spans[k + words - 1][1]
            hit[a:b] = b"\1" * (b - a)
    seen = collections.Counter(t[k : k + length] for t in [text, *others] for k in range(len(t) - length + 1))
    for k in range(len(text) - length + 1):
        if seen[text[k : k + length]] > 1:
            hit[k : k + length] = b"\1" * length
    return "".join(c for c, f in zip(text, hit) if not f)


def test_shared_passages_of_over_50_words_are_cut(spark):
    random.seed(9)
    short = lambda n: " ".join(random.choice("abcdefghij") for _ in range(n))
    word = lambda: "".join(random.choice("klmnopq") for _ in range(random.randint(3, 7)))
    own = lambda n: " ".join(word() for _ in range(n))
    p51, p50, mid, long_ = short(51), short(50), own(54), own(120)
    spaced = p51.replace(" ", "\n ", 5)
    twice = own(55)
    rows = [
        (0, f"{own(9)} {p51} {own(9)}"), (1, f"{own(30)} {spaced} {own(2)}"), (2, f"{p50} {own(8)}"), (3, f"{own(8)} {p50}"),
        (4, f"{own(5)} {mid} {own(5)}"), (5, f"{mid} {own(60)}"), (6, f"{twice} {own(3)} {twice}"), (7, f"{own(4)} {long_}"),
        (8, f"{long_} {own(4)} {mid}"), (9, " ".join(["ha"] * 80)), (10, own(400)), (11, mid + "\n"), (12, ""),
        (13, f"{own(6)} {long_[:420]}"),
    ]
    assert len(mid) < 400 and len(twice) < 400 < len(long_)
    texts = dict(rows)
    want = {i: _cut(t, [o for j, o in rows if j != i]) for i, t in rows}
    want = {i: t for i, t in want.items() if t == texts[i] or t.strip()}
    got = {r.doc_id: r for r in corpus_pipeline.cut_repeats(spark, _docs(spark, rows), "").collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert p51 not in got[0].text and p50 in got[2].text and 11 not in got and got[6].text == texts[6]


def test_many_passages_by_brute_force(spark):
    random.seed(10)
    vocabulary = ["".join(random.choice("abcdefg") for _ in range(random.randint(1, 9))) for _ in range(60)]
    own = lambda n: " ".join(random.choice(vocabulary) for _ in range(n))
    shared = [own(random.choice([49, 50, 51, 52, 60, 90])) for _ in range(8)]
    rows = []
    for i in range(50):
        parts = [own(random.randint(0, 60))]
        for _ in range(random.choice([0, 1, 1, 2, 3])):
            w = random.choice(shared).split()
            parts += [" ".join(w[random.randint(0, 2) : len(w) - random.randint(0, 2)]), own(random.randint(0, 20))]
        rows.append((i, " ".join(p for p in parts if p)))
    want = {i: _cut(t, [o for j, o in rows if j != i]) for i, t in rows}
    texts = dict(rows)
    want = {i: t for i, t in want.items() if t == texts[i] or t.strip()}
    got = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, _docs(spark, rows), "").collect()}
    assert got == want


def test_one_of_all_copies_comes_through_both_duplicate_stages(spark):
    random.seed(11)
    text = lambda: " ".join("".join(random.choice("abcdefgh") for _ in range(5)) for _ in range(120))
    a, b, c, d, e = (text() for _ in range(5))
    rows = [(5, a), (5, a), (7, b), (None, b), (None, c), (None, c), (9, d), (8, d + " end"), (11, e), (11, "other words " + text())]
    rows += [(12, ""), (12, ""), (13, ""), (14, None), (14, None)]
    left = corpus_pipeline.drop_near_duplicates(spark, _docs(spark, rows), "")
    want = sorted([(5, a), (7, b), (None, c), (8, d + " end"), rows[8], rows[9], (12, ""), (13, ""), (14, None)], key=str)
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == want
    through = corpus_pipeline.cut_repeats(spark, left, "")
    assert sorted(((r.doc_id, r.text) for r in through.collect()), key=str) == want


def test_contaminated_rows_go_by_id_and_text(spark, tmp_path):
    item = "one two three four five six seven eight nine ten"
    spark.createDataFrame([("i", item)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, f"so {item} end"), (None, "clean"), (1, f"{item} x"), (1, "clean too"), (2, "x " + item[4:]), (3, None), (None, None)]
    left = corpus_pipeline.drop_contaminated(spark, _docs(spark, rows), str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted([rows[1], rows[3], rows[4], rows[5], rows[6]], key=str)
