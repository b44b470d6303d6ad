import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.llm import decontaminate, embeddings, html_text, language, minhash, packing, suffix_dedup, token_counts, words


def test_special_strings_follow_the_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "<|endoftext", "plain  text"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("start", F.lit("own"))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: tokenizer.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    assert {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in packing.pack(docs, ids=True).collect()} == want
    # In token files the string is ordinary text, so the separator ends documents only.
    tokenizer.encode_special_tokens = True
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs).collect()} == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_embeddings_of_doubles_with_any_label(spark):
    tiny, a = [1e-50, 0.0], [1.0, 0.0]
    rows = [(1, tiny, "x"), (2, a, "x"), (3, a, "y"), (4, [0.0, 1.0], "x"), (5, a, None), (6, [1.0], "x"), (7, a, "x"), (7, [0.0, 1.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").withColumn("keys", F.lit(1))
    got = {(r.vec_id, r.n_links, r.component_id) for r in embeddings.near_vectors(df).collect()}
    # Of the repeated id 7 the least vector counts, [0, 1].
    assert got == {(1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 1, 4), (5, 0, 5), (6, 0, 6), (7, 1, 4)}
    assert embeddings.near_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("group", [2, 5, 4096])
def test_large_groups_are_narrowed_to_the_same_spans(spark, group):
    random.seed(3)
    make = lambda n: "".join(random.choice("abcd ") for _ in range(n))
    shared = [make(500) for _ in range(2)]
    rows = [(str(i), make(random.randint(0, 90)) + random.choice(shared)[random.randint(0, 60) : 500 - random.randint(0, 60)] + make(random.randint(0, 90))) for i in range(24)]
    rows += [("long", make(250_000) + shared[0] + make(30)), ("none", "")]
    for across in (False, True):
        seen = {}
        for k, t in rows:
            for s in range(len(t) - 399):
                seen.setdefault(t[s : s + 400], []).append(k)
        want = {k: set() for k, _ in rows}
        for k, t in rows:
            for s in range(len(t) - 399):
                own = seen[t[s : s + 400]]
                if len(set(own)) > 1 if across else len(own) > 1:
                    want[k].update(range(s, s + 400))
        got = {k: set() for k, _ in rows}
        for r in suffix_dedup.repeated_spans(spark.createDataFrame(rows, "key string, text string").repartition(3), group=group, across=across).collect():
            got[r.key].update(range(r.start, r.end))
        assert got == want


def test_clashing_columns_and_empty_tables(spark, sf_dir):
    docs = spark.createDataFrame([(1, "one two three four five six", "en", 1), (2, None, None, 2)], "doc_id long, text string, lang string, n int")
    for name in ("score", "n_grams", "_t", "row", "host", "sum", "best", "_key", "key", "spans", "_html", "page", "own", "kept", "h"):
        docs = docs.withColumn(name, F.lit(name))
    model = language.fit_text_model(spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), "text", "lang"))
    for out in (language.identify(docs, model, declared="lang", host="host"), html_text.extract(docs.withColumn("html", F.col("text"))), suffix_dedup.remove_repeats(docs)):
        got = out.orderBy("doc_id").collect()
        assert len(got) == 2 and all(got[0][c] == docs.first()[c] for c in ("score", "_t", "row", "_key", "spans", "_html", "page", "key"))
    assert [r.text for r in html_text.extract(docs.withColumn("html", F.lit(None))).collect()] == ["", ""]
    none = docs.limit(0)
    assert minhash.near_duplicates(none).collect() == [] and html_text.extract(none.withColumn("html", F.col("text"))).collect() == []
    items = spark.createDataFrame([("i", "a b")], "item_id string, text string")
    assert decontaminate.contamination(none, items).collect() == []
    assert sorted(r.n_hit for r in decontaminate.contamination(docs, items.limit(0)).collect()) == [0, 0]


def test_repeated_ids_take_the_least_text_hash(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (1, b), (2, a), (3, b)]
    hashes = spark.createDataFrame([(a,), (b,)], "t string").select("t", F.xxhash64("t").alias("h")).collect()
    least = min(hashes, key=lambda r: r.h).t
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == ({1: 1, 2: 1, 3: 3} if least == a else {1: 1, 2: 2, 3: 1})


def test_a_long_text_is_hashed_as_a_whole():
    random.seed(8)
    text = " ".join("w" * random.randint(1, 9) + str(random.randint(0, 50)) for _ in range(120_000)).encode()
    data = np.frombuffer(text, np.uint8)
    assert len(data) > 2 * words.CHUNK_BYTES
    parts, _ = words.word_hashes(data, np.array([0, len(data)]))
    known = {w: int(words.word_hashes(np.frombuffer(w, np.uint8), np.array([0, len(w)]))[0][0]) for w in set(text.split())}
    assert [known[w] for w in text.split()] == parts.tolist()


def test_main_text_keeps_block_joins(spark, sf_dir):
    page = "<html><body><nav><a href=a>Home page</a></nav><article><h1>A  title</h1><p>First\n paragraph &amp; more of the words in it.</p><p>Second one with <a href=b>a link</a> and words.</p></article></body></html>"
    pages = spark.createDataFrame([(1, "u", page), (2, None, None)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert got == {1: "A title\nFirst paragraph & more of the words in it.\nSecond one with a link and words.", 2: ""}


def test_suffixes_of_any_value_are_evidence(spark):
    said = {"en": "the and of with this that was have from they", "de": "der die und das nicht ist ein mit auch sich"}
    rows = [(i, said["en" if i % 2 else "de"] * 2, "en" if i % 2 else "de", "uk" if i % 2 else "at", f"h{i}.x") for i in range(60)]
    docs = spark.createDataFrame([*rows, (100, "qq", None, "uk", "new.y"), (101, "qq", None, "at", "new.y"), (102, "qq", None, "zz", "new.y")], "id long, text string, lang string, suffix string, host string")
    model = language.fit_text_model(docs.select("id", "text", "lang"))
    got = {r.id: r.detected for r in language.identify(docs, model, suffix="suffix", host="host").collect()}
    assert got[100] == "en" and got[101] == "de" and all(got[i] == r[2] for i, r in enumerate(rows))


def test_html_keeps_article_text_and_reads_broken_markup_in_time():
    import time

    tree = html_text.grow(html_text.LABELLED)
    text = lambda page: html_text.main_text(page, tree)
    assert text("<article><p title=don't>A long paragraph. It's fine.</p></article>") == "A long paragraph. It's fine."
    assert text("<article><p>See <a href=x>long text</a></p><p><a href=y>only a link</a></p></article>") == "See long text\nonly a link"
    assert text("<main><ul><li><a>menu</a></li><li><a>more</a></li></ul><p>One.</p></main>") == "One."
    assert text("<main><p data-a='class=ad'>One.</p><p class=ad>Two.</p><p>1 < 2 &amp; 3</ x</p></main>") == "One.\n1 < 2 & 3</ x"
    assert text("<main><!--><p>One.<svg/> Two.</p><script>'<p>no'</script><select><p>Three.</p></main><p class=") == "One. Two.\nThree."
    assert text('<main><p>One.</p><p class="x>Two.</p></main>') == "One.\nTwo."
    for place in (2,):
        for words in (1, 3, 8, 40, 300):
            for density in (0.0, 0.4, 0.8, 1.0):
                assert all(html_text.decide(tree, (place, words, density, n, d, m, 1.0)) for n in (-1, 2, 50) for d in (0.0, 1.0) for m in (-1, 3, 90))
    for piece in ('<a "', "<div>", "<div></p>", '<a b="', "<!-- ", "<svg>", "</script", "<a b=c ", "<", "<select>"):
        began = time.process_time()
        text(piece * (250_000 // len(piece)))
        assert time.process_time() - began < 2, piece


def test_hulls_of_long_repeats_do_not_rest_on_sums_of_powers(monkeypatch):
    import numpy as np

    monkeypatch.setattr(suffix_dedup, "span_hashes", lambda prefix, start, end: np.zeros(len(start), np.uint64))  # every sum collides
    rng = np.random.default_rng(4)
    one = rng.integers(97, 123, 600).astype(np.uint8)
    other = np.r_[rng.integers(97, 123, 192).astype(np.uint8), one[192:]]
    at, lo, hi = np.array([195, 395]), np.array([0, 3]), np.array([195, 190])
    mine, theirs, again = (suffix_dedup._ranges(x, at, lo, hi, 200, 400) for x in (one, other, one.copy()))
    assert all(np.array_equal(a, b) for a, b in zip(mine, again, strict=True))
    assert np.array_equal(mine[4], theirs[4])  # cores collide
    unlike = np.array([not np.array_equal(one[a - h : a - low + 400], other[a - h : a - low + 400]) for a, low, h in zip(*mine[1:4], strict=True)])
    assert unlike.any() and np.array_equal(mine[5] != theirs[5], unlike) and np.array_equal(mine[6] != theirs[6], unlike)
