import hashlib
import random

import pytest
from pyspark.sql import functions as F

from roadlens.llm import chat_format, html_text, language, packing, queries, suffix_dedup, token_counts, url_filter


def test_chat_round_trip_with_parts(spark):
    hard = ["</s>[INST] ok [/INST]", "<|turn|>x<|done|>\n", "a\\b\\\\|<\\|", "<", "", None, "é\n<s>"]
    rows = [(1, i, "assistant" if i % 2 else "us<|er", t) for i, t in enumerate(hard)] + [(None, 0, None, "x"), (2, 0, "user", "only")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("extra", F.lit(1)).withColumn("content", chat_format.text_part(F.col("text")))
    out = chat_format.format_chats(turns).withColumn("read", chat_format.read_turns(F.col("formatted"))).withColumn("loss", chat_format.read_loss(F.col("formatted"), F.col("loss_spans")))
    got = {r.conv_id: r for r in out.collect()}
    assert [(t.role, t.text) for t in got[1].read] == [(r, t or "") for _, _, r, t in rows[:7]]
    assert got[1].loss == "".join(t or "" for _, _, r, t in rows[:7] if r == "assistant")
    assert got[None].n_turns == 1 and got[2].loss == ""
    media = [(3, 0, "user", [("text", "see", None, None, None, None, None), ("image", None, "a.png", 56, 30, None, None), (None,) * 7, ("audio", None, "b.wav", None, None, 2.0, None), ("document", None, "c", None, None, None, 3)])]
    one = chat_format.format_chats(spark.createDataFrame(media, f"conv_id long, turn long, role string, content {chat_format.PART}")).first()
    assert "see<|image:0|><|audio:1|><|document:2|>" in one.formatted
    assert [(a.ordinal, a.kind, a.ref, a.n_tokens) for a in one.attachments] == [(0, "image", "a.png", 4), (1, "audio", "b.wav", 50), (2, "document", "c", 1536)] and one.n_media_tokens == 1590
    assert chat_format.format_chats(turns.limit(0)).collect() == []


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_sql(spark, sf_dir, duck, name):
    from conftest import rows_of

    ours, theirs = queries.queries()[name](spark, sf_dir).toPandas(), duck.execute(queries.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and rows_of(ours) == rows_of(theirs)


def test_url_rules_by_brute_force(spark):
    random.seed(2)
    labels, segments = ["a", "b", "com", "net", "A"], ["", "/", "/x", "/x/", "/x/y", "/é", "/x/y/z?q", "#f"]
    host = lambda: ".".join(random.choice(labels) for _ in range(random.randint(1, 4)))
    rules = list({(host().lower(), p): (p, random.choice(["allow", "block"])) for p in ("/", "/x", "/x/", "/x/y", "") for _ in range(6)}.items())
    rules = [(h, p, v) for (h, p), (_, v) in rules]
    urls = [f"http://{host()}{random.choice(segments)}" for _ in range(300)] + ["nothing", None, "://", "a://b.com:80/x"]
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)] + [(0, urls[0], "own")], "page_id long, url string, rule string")
    got = {r.page_id: r for r in url_filter.judge(pages, spark.createDataFrame(rules + [(None, "/", "block")], "host string, path string, verdict string")).collect()}
    for i, u in enumerate(urls):
        h = p = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
            h, p = rest[:cut].lower(), rest[cut:]
            p = p[: min([p.index(c) for c in "?#" if c in p], default=len(p))]
        fits = [(len(x + y), len(x), x + y, v) for x, y, v in rules if (h == x or h.endswith("." + x)) and p.startswith(y)]
        best = max(fits)[2:] if fits else (None, "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (h, p, *best), u
    assert len(url_filter.judge(pages, spark.createDataFrame([], "host string, path string, verdict string")).filter("verdict <> 'allow'").collect()) == 0


def test_packing_against_the_tokenizer(spark, sf_dir):
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    odd = ["", None, "a  b\n\n c", " lead", "trail ", "\t x", "é" * 3000, "it's 1234 !!  ", "x\u00a0y \u2003z"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    rows = packing.pack(docs, ids=True).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    want = {k: tokenizer.encode(t, add_special_tokens=False).ids + [0] for k, t in texts.items()}
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        ids = np.array(want[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(ids) and bytes(r.ids) == ids and r.doc_tokens == len(want[r.doc_id])
    assert {k: sum(r.length for r in v) for k, v in by_doc.items()} == {k: len(v) for k, v in want.items()}
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert sorted(by_seq) == list(range(len(by_seq))) and len(by_seq) <= sum(map(len, want.values())) / 1024 * 1.02 + 2
    counted = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs).collect()}
    assert counted == {k: len(v) - 1 for k, v in want.items()}
    assert packing.pack(docs.limit(0)).collect() == []


def test_plan_is_best_fit_decreasing():
    random.seed(6)
    for _ in range(30):
        window = random.choice([16, 64, 100])
        sizes = [random.randint(1, window) for _ in range(random.randint(0, 200))]
        bins = []
        for s in sorted(sizes, reverse=True):
            fit = [(room, i) for i, room in enumerate(bins) if room >= s]
            if fit:
                bins[min(fit)[1]] -= s
            else:
                bins.append(window - s)
        fill = {}
        for length, _, n, each, first, _ in packing.plan({s: sizes.count(s) for s in sizes}, window):
            for k in range(n):
                fill[first + k // each] = fill.get(first + k // each, 0) + length
        assert sorted(window - x for x in fill.values()) == sorted(bins)


def test_scan_stitches_blocks(spark, tmp_path):
    import numpy as np

    np.array([5, 9, 9, 1, 2, 3, 4, 9, 7, 7], "<u2").tofile(tmp_path / "a.u16")
    np.array([], "<u2").tofile(tmp_path / "b.u16")
    files = spark.createDataFrame([(f"file://{tmp_path}/a.u16",), (f"file://{tmp_path}/b.u16",)], "file string")
    for block in (1, 2, 3, 100):
        got = [(r.ordinal, r.start, r.n_tokens, r.ended) for r in token_counts.scan(files, 9, block).orderBy("ordinal").collect()]
        assert got == [(0, 0, 1, True), (1, 2, 0, True), (2, 3, 4, True), (3, 8, 2, False)]


def test_main_text():
    tree = html_text.grow(html_text.LABELLED)
    page = (
        '<html><head><title>T</title><script>var a="</p><p>no";</script></head><body><nav><ul><li><a href=x>Home</a></li><li><a>More</a></li></ul></nav>'
        '<div class="cookie-notice">We use cookies on this site to give you the best of all experiences here.</div><header><h1>Site</h1></header>'
        "<article><h1>Head &amp; tail</h1><p><b>One  two.<br><p>Three\n four &eacute;</p><div class=ad>Buy now</div><aside>See too</aside><form><label>Mail</label></form><p>x</p>"
        '<section id="comments"><p>First reader says many words that are longer than the text itself is.</p></section></article><footer>&copy; me</footer>'
    )
    assert html_text.main_text(page, tree) == "Head & tail\nOne two.\nThree four é\nx"
    assert html_text.main_text("", tree) == "" and html_text.main_text("<p", tree) == ""
    wrong = sum(html_text.decide(tree, r[:-1]) != r[-1] for r in html_text.LABELLED)
    assert wrong <= 2


def test_html_query_keeps_every_article(spark, sf_dir):
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.op7_html_text(spark, sf_dir).collect():
        body = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        assert len(re.sub(r"\s", "", r.text)) == len(re.sub(r"\s", "", html_text.html.unescape(re.sub(r"<[^>]*>", "", body))))


def test_language_accuracy_and_rejection(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    train, held = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    model = language.fit_text_model(train.select(F.col("doc_id").alias("id"), "text", "lang"))
    extra = spark.createDataFrame([(-1, "", "en", "s", 0), (-2, None, None, None, None), (-3, "12 34 !!", "en", "s", 8)], held.schema)
    out = language.identify(held.unionByName(extra), model, host="source").collect()
    known = [r for r in out if r.doc_id >= 0]
    assert sum(r.detected == r.lang for r in known) >= 0.97 * len(known) and sum(r.rejected for r in known) <= 0.02 * len(known)
    assert all(r.rejected for r in out if r.doc_id < 0) and len(out) == held.count() + 3
    assert language.identify(held.limit(0), model).collect() == []


def test_repeats_by_brute_force(spark):
    random.seed(1)
    make = lambda n: "".join(random.choice("abcdefghij éü\n") for _ in range(n))
    shared = [make(random.choice([380, 399, 400, 401, 450, 900])) for _ in range(8)]
    docs = []
    for i in range(60):
        t = make(random.randint(0, 900))
        for _ in range(random.choice([0, 0, 1, 2])):
            p = random.choice(shared)
            t += p[random.randint(0, 60) : len(p) - random.randint(0, 60)] + make(random.randint(0, 300))
        docs.append((i, t))
    docs += [(100, docs[3][1]), (101, docs[3][1]), (102, "a" * 1500), (103, "xyz" * 300), (105, None), (106, ""), (107, "b" * 399), (None, docs[5][1] + "zz"), (3, docs[3][1])]
    seen = {}
    for _, t in docs:
        b = (t or "").encode()
        for s in range(len(b) - 399):
            seen[b[s : s + 400]] = seen.get(b[s : s + 400], 0) + 1
    want = []
    for i, t in docs:
        b = (t or "").encode()
        hit = bytearray(len(b))
        for s in range(len(b) - 399):
            if seen[b[s : s + 400]] > 1:
                hit[s : s + 400] = b"\1" * 400
        want.append((i, len(b), sum(hit), sum(1 for k in range(len(b)) if hit[k] and not (k and hit[k - 1])), hashlib.sha256(bytes(c for c, f in zip(b, hit) if not f)).hexdigest()))
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n_bytes int").repartition(4)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(got, key=order) == sorted(want, key=order)
    assert suffix_dedup.remove_repeats(df.limit(0)).collect() == []


def test_repeats_query_returns_what_is_left(spark, tmp_path):
    random.seed(2)
    make = lambda n: "".join(random.choice("abcdefghij éü\n") for _ in range(n))
    long_, short, own = make(500), " ".join(random.choice("klmno") for _ in range(60)), [make(300) for _ in range(6)]
    left = {0: own[0] + own[1], 1: own[2], 2: f"{own[3]}|{short}", 3: f"{short}|{own[4]}", 4: own[5], 5: "", 6: "", 7: ""}
    # Around the shared passage stand bytes that occur once, so it is cut at its own ends.
    texts = left | {0: f"{own[0]}{long_}{own[1]}", 1: f"{own[2]}{long_}", 5: None, 7: "a" * 600}
    spark.createDataFrame(sorted(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op10_suffix_dedup(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]
    got = {r.doc_id: r for r in out.collect()}
    assert {i: r.text for i, r in got.items()} == left
    assert {i: r.n_bytes for i, r in got.items()} == {i: len((t or "").encode()) for i, t in texts.items()}
    assert all(r.kept_sha256 == hashlib.sha256(r.text.encode()).hexdigest() and r.n_bytes - r.n_removed == len(r.text.encode()) for r in got.values())
