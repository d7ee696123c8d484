"""The operators' queries over the whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genespark.llm import codebooks, decontam, jaccard, langid, linededup, mixing, pii, prefixtrie, secrets, suffix, tokencount, topk, toxicity
from genespark.llm.util import crc_mod, materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha(col: Column) -> Column:
    return F.sha2(F.encode(F.coalesce(col, F.lit("")), "utf-8"), 256)


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, F.array("source"), mixing.word_count("text"), weights=(3, 1, 2), share=1.5, repeats=2).drop("sources")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find_pii(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", *(f"n_{k}" for k in pii.KINDS), sha(F.col("base")).alias("base_sha256"), "spans")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.dedup_substrings(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "n_bytes", "n_removed", F.size("run_from").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in secrets.KINDS), sha(secrets.listed(*secrets.KINDS)).alias("base_sha256"), secrets.listed(*secrets.KINDS, "random").alias("spans"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = linededup.dedup_lines(docs, linededup.build(docs), keep=["doc_id"], out_text="kept")
    return out.select("doc_id", "n_lines", "n_dropped", sha(F.col("kept")).alias("kept_sha256"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), sha(F.array_join("items", ",")).alias("items_sha256"), decontam.contaminated().alias("contaminated"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = crc_mod("doc_id", 3) == 1
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs.where(~held), labels.where(~held))
    return toxicity.score(docs.select("doc_id", "text"), model, keep=["doc_id"]).select("doc_id", held.alias("held_out"), "score", "predicted")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = crc_mod("doc_id", 4) == 2
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~held))
    return langid.identify(docs.select("doc_id", "text"), model, keep=["doc_id"]).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_similar(table(spark, sf_dir, "documents"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.where("vec_id % 50 = 0"), 5)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codebooks.compress(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = materialize(prefixtrie.turns(table(spark, sf_dir, "conversations")), "turns")
    c = F.col("c")
    rebuilt = prefixtrie.shared_heads(turns, heads=crc_mod("c", 6), base=c - c % 100, most=5)
    return prefixtrie.trie(rebuilt).drop("digest")


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])
    return out.withColumn("over_limit", tokencount.over(2048))


QUERIES = {
    "op1_mix": op1_mix,
    "op2_pii": op2_pii,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_secrets": op4_secrets,
    "op5_line_dedup": op5_line_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_decontaminate": op7_decontaminate,
    "op8_language": op8_language,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_top_k": op10_top_k,
    "op11_vector_codes": op11_vector_codes,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_token_counts": op13_token_counts,
}

def _codes_sql(rounds: int = 4) -> str:
    """Lloyd's rounds as a chain of common tables: a<r> assigns by the codebooks c<r>, which the assignment a<r - 1> gave."""
    steps = [
        r"""WITH e AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS k, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (
  SELECT k, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS s FROM e, (SELECT unnest(range(4)) AS p)),
c0 AS MATERIALIZED (SELECT p, k - 1 AS j, s AS c FROM x WHERE k <= 256)"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT k, p, s, m.j AS j, m.d AS d
  FROM (SELECT k, p, any_value(s) AS s, min({{'d': list_inner_product(s, s) - 2 * list_inner_product(s, c) + list_inner_product(c, c), 'j': j}}) AS m
        FROM x JOIN c{r} USING (p) GROUP BY k, p))""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT p, j, coalesce(m.c, o.c) AS c
  FROM c{r} o LEFT JOIN (
    SELECT p, j, list(y ORDER BY q) AS c
    FROM (SELECT p, j, q, floor(sum(z) / count(*)) AS y FROM (SELECT p, j, unnest(s) AS z, generate_subscripts(s, 1) AS q FROM a{r}) GROUP BY p, j, q)
    GROUP BY p, j) m USING (p, j))""")
    steps.append(f"""coded AS (
  SELECT k, string_agg(printf('%02x', j), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY k),
books AS (
  SELECT sha256(string_agg(CAST(CAST(z AS BIGINT) AS VARCHAR), ',' ORDER BY p, j, q)) AS h FROM (SELECT p, j, unnest(c) AS z, generate_subscripts(c, 1) AS q FROM c{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM coded JOIN e USING (k), books""")
    return ",\n".join(steps)


ORACLES = {
    "op12_prefix_trie": r"""
WITH said AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, list(x ORDER BY pos) AS l,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda z: ascii(z)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda y, i: xor(y >> 1, 3988292384 * (y & 1))))) % 6 AS h
  FROM said GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.l[1 : c.h], []), c.l[c.h + 1 :]) AS l FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 100),
p AS (SELECT conv_id, len(l) = d AS ends, d, sha256(CAST(to_json(l[1 : d]) AS VARCHAR)) AS k, CASE WHEN d > 0 THEN sha256(CAST(to_json(l[1 : d - 1]) AS VARCHAR)) END AS up, CASE WHEN d > 0 THEN length(l[d].t) ELSE 0 END AS chars
  FROM rebuilt, LATERAL (SELECT unnest(range(len(l) + 1)) AS d)),
n AS (
  SELECT d, k, min(conv_id) AS conv_id, any_value(up) AS up, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM p GROUP BY d, k),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n FROM n WHERE d > 0 GROUP BY ALL),
sums AS (
  SELECT a.d, a.k, sum(n.saved) AS saved, count(*) FILTER (WHERE kids.n IS NULL) AS leaves
  FROM n LEFT JOIN kids USING (d, k) JOIN p a ON a.conv_id = n.conv_id AND a.d <= n.d GROUP BY a.d, a.k)
SELECT n.conv_id, n.d AS depth, par.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children, leaves AS n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN sums USING (d, k) LEFT JOIN kids USING (d, k) LEFT JOIN n par ON par.d = n.d - 1 AND par.k = n.up
""",
    "op11_vector_codes": _codes_sql(),
    "op5_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, t.i AS pos, t.line AS line,
         translate(trim(t.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
       LATERAL (SELECT unnest(l) AS line, generate_subscripts(l, 1) AS i) t),
hot AS (
  SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT l.doc_id, l.pos, l.line, h.key IS NOT NULL AND l.doc_id <> h.last AS gone
  FROM lines l LEFT JOIN hot h ON l.key = h.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op7_decontaminate": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[k : k + 12], ' ') AS s
  FROM b, LATERAL (SELECT unnest(range(1, greatest(2, len(w) - 11))) AS k) r WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS s
  FROM d, sizes, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS k) r WHERE len(w) >= n),
m AS (SELECT dw.doc_id, dw.k, dw.n, win.item_id FROM dw JOIN win ON dw.s = win.s AND dw.n = win.n),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, k, n FROM m), LATERAL (SELECT unnest(range(k, k + n)) AS p) r GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
  FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items.s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op9_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + 3], ' ') AS g
  FROM w, LATERAL (SELECT unnest(range(1, greatest(2, len(w) - 2))) AS k) r WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
often AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM s x JOIN often USING (g) JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
links AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(b) FROM reach r WHERE r.a = d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
""",
    "op10_top_k": r"""
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, e.vec_id, CAST(list_inner_product(q.v, e.v) AS BIGINT) AS score
  FROM e q JOIN e ON q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
""",
}
