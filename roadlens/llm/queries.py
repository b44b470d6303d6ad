"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlens.llm import chat_format, chat_repair, decontaminate, embeddings, html_text, language, lexical, minhash, packing, suffix_dedup, token_counts, toxicity, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and one that quotes control strings, then read digests back."""
    said = "</s>[INST] ok [/INST]"
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = turns.unionByName(own).withColumn("content", chat_format.text_part(F.col("text")))
    out = chat_format.format_chats(turns)
    read = out.withColumn("read", chat_format.read_turns(F.col("formatted"))).withColumn("loss", chat_format.read_loss(F.col("formatted"), F.col("loss_spans")))
    digest = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(digest, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


# Escaping adds one character for each backslash and each control string; marks add a fixed number.
OP1_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(role) + length(text) + 25
    + length(regexp_replace(role || chr(1) || text, '[^\\]', '', 'g'))
    + len(regexp_extract_all(replace(role || chr(1) || text, '\', '\\'), '<\||</?s>|\[/?INST\]')) AS n FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every page's url by the fixed rules."""
    named = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in url_filter.RULES]
    rules = spark.range(1).select(F.inline(F.array(*named)))
    return url_filter.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = r"""
WITH r(host, path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), p AS (
  SELECT row_number() OVER () AS n, page_id,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
)
SELECT page_id, any_value(p.host) AS host, any_value(p.path) AS path,
  max_by(r.host || r.path, length(r.host || r.path)) AS rule,
  coalesce(max_by(r.verdict, length(r.host || r.path)), 'allow') AS verdict
FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
GROUP BY n, page_id
"""


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 1,024 tokens."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents, at 85 per cent of five-word shingles."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), threshold=85)


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of a label at cosine 0.93."""
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"))


OP5_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
), ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, least(v.vec_id, coalesce(m, v.vec_id)) AS component_id, least(v.vec_id, coalesce(m, v.vec_id)) = v.vec_id AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) x ON x.a = v.vec_id LEFT JOIN (SELECT a, min(b) AS m FROM r GROUP BY a) y ON y.a = v.vec_id
"""


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as token files and count each document's tokens by a scan of the files."""
    out = token_counts.count_tokens(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_tokens")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    out = html_text.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page; the text model is fitted on a bounded sample of labelled documents."""
    labelled = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    pages = language.page_evidence(_table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")
    out = language.identify(pages, language.fit_text_model(labelled), declared="declared", suffix="suffix", host="host")
    return out.select("page_id", "detected", F.round("confidence", 6).alias("confidence"), F.round("text_ratio", 6).alias("text_ratio"), "rejected")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages of ten words in all documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.contamination(docs, _table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove every 400-byte string that occurs elsewhere from all documents; n_bytes is the input's, text what is left."""
    out = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("kept_text").alias("text"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; the model is fitted on a bounded sample of the rows that aren't held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", toxicity.held_out("doc_id"))
    labels = _table(spark, sf_dir, "labels").filter(~toxicity.held_out("doc_id"))
    out = toxicity.score(docs, toxicity.fit(docs, labels))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return lexical.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), s AS (
  SELECT count(*) FILTER (len(t) > 0) AS n, sum(len(t)) AS l FROM d
), i AS (
  SELECT row_number() OVER () AS i, item_id, text FROM benchmark
), q AS (
  SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM i
), p AS (
  SELECT r, w, count(*) AS tf FROM (SELECT r, unnest(t) AS w FROM d) WHERE w IN (SELECT w FROM q) GROUP BY r, w
), f AS (
  SELECT w, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM p, s GROUP BY w, n
), m AS (
  SELECT r, doc_id, CAST(100 - 90 + (CAST(90 AS HUGEINT) * len(t) * n) // l AS BIGINT) AS m FROM d, s WHERE len(t) > 0
), x AS (
  SELECT i, item_id, r, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN p USING (w) JOIN f USING (w) JOIN m USING (r) GROUP BY i, item_id, r, doc_id HAVING score > 0
)
SELECT item_id, CAST(k AS INT) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS k FROM x) WHERE k <= 10
"""


def op13_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage all conversations, then find and repair the faults; one row for every conversation that was there."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = chat_repair.repair(chat_repair.damage(turns)).withColumnRenamed("conv_id", "found_id")
    all_ = turns.select("conv_id").distinct()
    out = all_.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


# A state holds its least (cost, edits) and the text that they leave; s: after system, u: after user, a: after assistant.
_ROW = """CASE WHEN {0} IS NOT NULL THEN {{'c': {0}.c + {1}, 'e': {0}.e || '{2}', 't': {0}.t{3}}} END"""
_ADD = " || CASE WHEN {0}.t = '' THEN '' ELSE chr(10) END || {1}"


def _op13_sql() -> str:
    def way(state: str, cost: str, edit: str, said: str = "") -> str:
        return _ROW.format(state, cost, edit, _ADD.format(state, said) if said else "")

    keep = lambda state, role: f"CASE WHEN NOT gone AND left(role, 1) = '{role}' THEN {way(state, 'short', 'K', said)} END"
    turn = lambda state, to: f"CASE WHEN NOT gone THEN {way(state, '2 + short', 'R', repr(to + ':') + ' || text')} END"
    said = "role || ':' || text"
    least = lambda *ways: "list_min([" + ", ".join(ways) + "])"
    insert_u = lambda state: way(state, "2", "I", "'user:'")
    insert_a = lambda state: way(state, "2", "I", "'assistant:'")
    moved = ", ".join(
        [
            least(way("q", "3", "D")) + " AS q",
            least(way("s", "3", "D"), keep("q", "s")) + " AS s",
            least(way("u", "3", "D"), *(keep(x, "u") for x in "qsa"), *(turn(x, "user") for x in "qsa")) + " AS u",
            least(way("a", "3", "D"), keep("u", "a"), turn("u", "assistant")) + " AS a",
        ]
    )
    # A way of inserts passes a state once: to u from all, to a from u, to u from a.
    user = lambda q, s, u, a: least(u, *(insert_u(x) for x in (q, s, a)))
    return f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ord(x) AS BIGINT)) AS b FROM conversations
), c AS (
  SELECT *, xor(list_reduce(list_concat([4294967295], b), lambda c, x:
    list_reduce(list_concat([xor(c, x)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))), 4294967295) % 20 AS kind FROM k
), d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM c WHERE kind <> 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || ':' || text), copy) AS i FROM d
), f AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM o
), g AS (
  SELECT *, blank OR again AS gone, CASE WHEN cut AND NOT blank AND NOT again THEN 1 ELSE 0 END AS short FROM f
), n AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again AND NOT blank) AS duplicate, sum(short) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS rows FROM g GROUP BY conv_id
), z AS (
  SELECT {{'c': CAST(0 AS BIGINT), 'e': '', 't': ''}} AS q
), r AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, q, CAST(NULL AS STRUCT(c BIGINT, e VARCHAR, t VARCHAR)) AS s,
    {{'c': CAST(2 AS BIGINT), 'e': 'I', 't': 'user:'}} AS u, {{'c': CAST(4 AS BIGINT), 'e': 'II', 't': 'user:' || chr(10) || 'assistant:'}} AS a FROM n, z
  UNION ALL
  SELECT conv_id, i, q, s, {user("q", "s", "u", "a")} AS u, a FROM (
  SELECT conv_id, i, q, s, u, {least("a", insert_a("u"))} AS a FROM (
  SELECT conv_id, i, q, s, {user("q", "s", "u", "a")} AS u, a FROM (
  SELECT r.conv_id, g.i, {moved}
  FROM r JOIN g ON r.conv_id IS NOT DISTINCT FROM g.conv_id AND g.i = r.i + 1)))
), e AS (
  SELECT r.conv_id, list_min([q, a]) AS b FROM r JOIN n ON r.conv_id IS NOT DISTINCT FROM n.conv_id AND r.i = n.rows
)
SELECT h.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.e, '') AS audit, sha256(coalesce(b.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) h LEFT JOIN n ON h.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN e ON h.conv_id IS NOT DISTINCT FROM e.conv_id
"""


OP13_SQL = _op13_sql()


def queries() -> dict:
    return {
        "op1_chat_format": op1_chat_format,
        "op2_url_filter": op2_url_filter,
        "op3_packing": op3_packing,
        "op4_minhash_dedup": op4_minhash_dedup,
        "op5_embedding_dedup": op5_embedding_dedup,
        "op6_token_counts": op6_token_counts,
        "op7_html_text": op7_html_text,
        "op8_language_id": op8_language_id,
        "op9_decontamination": op9_decontamination,
        "op10_suffix_dedup": op10_suffix_dedup,
        "op11_toxicity": op11_toxicity,
        "op12_lexical_search": op12_lexical_search,
        "op13_chat_repair": op13_chat_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_format": OP1_SQL, "op2_url_filter": OP2_SQL, "op5_embedding_dedup": OP5_SQL, "op12_lexical_search": OP12_SQL, "op13_chat_repair": OP13_SQL}
