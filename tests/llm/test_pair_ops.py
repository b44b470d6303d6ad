import collections
import random
import re

from roadlens.llm import decontaminate, embeddings, minhash


def _groups(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_minhash_by_brute_force(spark):
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(random.choice(vocabulary) for _ in range(random.randint(0, 200))) for _ in range(30)]
    for size in (8, 30, 200, 500):
        base = [random.choice(vocabulary) for _ in range(size)]
        texts.append(" ".join(base))
        for _ in range(25):
            copy = list(base)
            for _ in range(max(1, int(size * random.choice([0.005, 0.01, 0.015, 0.02])))):
                copy[random.randrange(size)] = random.choice(vocabulary)
            texts.append(" ".join(copy).upper() if random.random() < 0.3 else "\n".join(copy))
    chain = [random.choice(vocabulary) for _ in range(300)]
    for i in range(15):
        texts.append(" ".join(chain))
        chain = list(chain)
        chain[random.randrange(300)] = f"z{i}"
    texts += ["", None, "one two", "one  TWO\n", "a b c d e", "a b c d e"]
    docs = list(enumerate(texts))
    random.shuffle(docs)

    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = {i: shingles(t) for i, t in docs}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = _groups(sets, links)
    df = spark.createDataFrame([(*d, 0) for d in docs] + [(None, "one two", 0)], "doc_id long, text string, n_shingles int").repartition(5)
    rows = minhash.near_duplicates(df, 85).collect()
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {i: (r.component_id, r.n_shingles, r.kept) for i, r in got.items()} == {i: (want[i], len(sets[i]), want[i] == i) for i in sets}
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)]


def _generated(spark, since):
    """Rows that explodes of a slice made in the queries after the first ``since``, by Spark's own counts."""
    store, total = spark._jsparkSession.sharedState().statusStore(), 0
    for k in range(since, store.executionsCount()):
        run = store.executionsList(k, 1).head().executionId()
        values, nodes = store.executionMetrics(run), store.planGraph(run).allNodes()
        for node in (nodes.apply(i) for i in range(nodes.size())):
            if node.name().startswith("Generate") and "slice(own" in node.desc():
                metrics = (node.metrics().apply(i) for i in range(node.metrics().size()))
                ids = [m.accumulatorId() for m in metrics if m.name() == "number of output rows"]
                total += sum(int(values.apply(i).replace(",", "")) for i in ids if values.contains(i))
    return total


def test_minhash_index_of_a_large_group_of_near_copies_is_small(spark):
    random.seed(6)
    word = lambda: f"w{random.randrange(10**6)}"
    base, texts = [word() for _ in range(150)], []

    def changed(text, n):
        text = list(text)
        for at in random.sample(range(len(text)), n):
            text[at] = word()
        return text

    for i in range(400):
        texts.append(changed(base, random.randint(2, 9)))
        if i % 10 == 0:  # linked with each other, hardly ever with what is near the base
            texts.append(changed(texts[-1], 6))
            texts += [changed(texts[-1], 1) for _ in range(2)]
    sets = {i: {tuple(t[k : k + 5]) for k in range(len(t) - 4)} for i, t in enumerate(texts)}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    store = spark._jsparkSession.sharedState().statusStore()
    since = store.executionsCount()
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    rows = minhash.near_duplicates(df, 80).collect()
    assert {r.doc_id: r.component_id for r in rows} == _groups(sets, links)
    assert 0 < _generated(spark, since) < 40 * len(texts)


def test_embeddings_by_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    base = rng.standard_normal((40, 16))
    vectors = np.concatenate([base, *(base[:12] + rng.standard_normal((12, 16)) * s for s in (0.02, 0.1, 0.2, 0.3))]).astype(np.float32)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(vectors)] + [(200, vectors[0].tolist(), 0), (201, (vectors[0] * 2).tolist(), 0), (202, vectors[0].tolist(), 1)]
    odd = [(300, None, 0), (301, [0.0] * 16, 0), (302, [float("nan")] * 16, 0), (303, [None] * 16, 0), (304, vectors[0].tolist(), None), (305, [], 0), (None, vectors[0].tolist(), 0)]
    links = []
    for i, a, x in rows:
        for j, b, y in rows:
            p, q = np.array(a, "f8"), np.array(b, "f8")
            if i < j and x == y and p @ q / np.linalg.norm(p) / np.linalg.norm(q) >= 0.93:
                links.append((i, j))
    degree = collections.Counter(x for e in links for x in e)
    want = _groups([r[0] for r in rows + odd if r[0] is not None], links)
    out = embeddings.near_vectors(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int"), block=8).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in out if r.vec_id is not None} == {i: (degree[i], c) for i, c in want.items()}
    assert len(out) == len(rows) + len(odd)


def test_contamination_by_brute_force(spark):
    random.seed(4)
    v = ["a", "B", "c1", "É", "dd"]
    items = [(i, " ".join(random.choice(v) for _ in range(random.choice([1, 4, 6, 9, 10, 11, 14, 30])))) for i in range(8)] + [(90, None), (91, "...")]
    docs = []
    for i in range(40):
        t = " ".join(random.choice([*v, "q", "r", "s", "t"]) for _ in range(random.randint(0, 40)))
        for _ in range(random.choice([0, 1, 1, 2])):
            x = random.choice(items[:8])[1].split()
            t += " - " + ", ".join(x[random.randint(0, 3) :]).upper() + " " + random.choice(v)
        docs.append((i, t))
    docs += [(None, docs[3][1]), (3, docs[3][1]), (70, None), (71, ""), (72, "!!")]
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows, sizes = collections.defaultdict(set), set()
    for i, t in items:
        w = word.findall((t or "").encode().lower())
        n = min(10, len(w))
        sizes.add(n)
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(str(i))
    want = []
    for i, t in docs:
        w, hit, found = word.findall((t or "").encode().lower()), set(), set()
        for n in sizes - {0}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        want.append((i, len(w), len(hit), sorted(found)))
    out = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in out.collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=order) == sorted(want, key=order)


def test_pipeline_stages_keep_columns(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = docs.count()
    kept = corpus_pipeline.identify_language(spark, docs, sf_dir)
    assert kept.columns == docs.columns and 0.95 * n <= kept.count() <= n
    clean = corpus_pipeline.drop_contaminated(spark, docs, sf_dir)
    assert clean.columns == docs.columns and clean.count() < n
