"""The queries of this package, as the driver runs them, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm import (
    centroids, decontaminate, host_rules, langid, lattice, packing, quality, resharding, secrets, simhash, style_tree, toxicity, treap,
)
from rankloom.llm.common import fold, load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(plan):
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return add


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), word_tokenizer(), 2048, added=True)


@query("op2_ftrl_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = load(spark, sf_dir, "documents"), fold(F.col("doc_id"), 5) == 0
    weights = toxicity.fit(docs, load(spark, sf_dir, "labels"), ~held_out)
    return toxicity.scores(docs, weights).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op3_positive_unlabelled_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = load(spark, sf_dir, "documents"), fold(F.col("doc_id"), 4) == 2
    scorer = quality.fit(docs, load(spark, sf_dir, "labels"), ~held_out)
    return quality.scores(docs, scorer).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"))


def _op4_sql() -> str:
    kinds = "\n  UNION ALL\n".join(
        f"  SELECT r, {k} AS k, '{x.kind}' AS kind, {x.least} AS least, string_split_regex(t, '{q}') AS gaps,\n"
        f"    regexp_extract_all(t, '{q}', 0) AS ms, regexp_extract_all(t, '{q}', {x.value}) AS vs\n"
        f"  FROM d WHERE regexp_matches(t, '{q}')"
        for k, x in enumerate(secrets.BASE + secrets.MORE) for q in [x.regex.replace("'", "''")])
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS (
{kinds}),
each AS (
  SELECT *, coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
            + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM found)),
spans AS (
  SELECT r, k, kind, start, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + length(ms[i]) AS BIGINT) AS s
  FROM each WHERE length(vs[i]) >= least),
by_row AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(s, ',' ORDER BY start, k) FILTER (k < 3) AS base, string_agg(s, ',' ORDER BY start, k) AS spans
  FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN by_row USING (r)"""


@query("op4_trigram_secret_scan", _op4_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(load(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secret_spans", lambda x: x["kind_order"] < len(secrets.BASE))

    def count(kind: str):
        return F.size(F.filter("secret_spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *(count(x.kind) for x in secrets.BASE), F.sha2(secrets.as_text(base), 256).alias("base_sha256"),
        secrets.as_text(F.col("secret_spans")).alias("spans"))


def language_dictionaries(docs: DataFrame) -> langid.Dictionaries:
    return langid.learn(docs, fold(F.col("doc_id"), 3) != 1)


@query("op5_compression_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    found = langid.identify(docs, language_dictionaries(docs))
    return found.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


# Windows are compared as arrays of words; positions that a window covers are counted once.
OP6_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS v
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT r, i, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS v
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n)),
hits AS (SELECT r, i, n, item_id FROM places JOIN windows USING (n, v)),
covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS k FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""


@query("op6_benchmark_decontamination", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), 10)
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.first)")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(F.col("items").cast("array<string>"))), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


OP7_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
wins AS (SELECT r, i, w[i:i + 4] AS v FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT r, v FROM wins GROUP BY r, v HAVING count(*) > 1),
rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM wins JOIN twice USING (r, v)) GROUP BY r),
lines AS (
  SELECT r, count(*) - count(DISTINCT x) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
f AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)),
j AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f),
h AS (SELECT source, count(*) AS n, sum(CAST(base_failed AS INT)) AS failed FROM j WHERE source IS NOT NULL GROUP BY source),
p AS (SELECT count(*) AS k, avg(failed / n) AS m, var_samp(failed / n) AS v FROM h),
ab AS (
  SELECT CASE WHEN ok THEN m * s ELSE 1 END AS a, CASE WHEN ok THEN (1 - m) * s ELSE 1 END AS b
  FROM (SELECT *, m * (1 - m) / nullif(v, 0) - 1 AS s, k >= 2 AND v > 0 AND m > 0 AND m * (1 - m) / nullif(v, 0) - 1 > 0 AS ok FROM p))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce((failed + a) / (n + a + b) > 0.6, false) AS kept
FROM j LEFT JOIN h USING (source) CROSS JOIN ab
"""


@query("op7_host_quality_rules", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(load(spark, sf_dir, "documents"), F.col("source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op8_gray_order_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents"), 3, 2)


@query("op9_flow_resharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    moves = resharding.reshard(docs, F.col("_metadata.file_name"), 40)
    text = F.coalesce("text", F.lit(""))  # as it has come to its new shard
    return moves.select(
        "doc_id", (F.octet_length(text).cast("bigint") + resharding.ROW_OVERHEAD).alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard", "moved")


@query("op10_style_tree_extraction")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.extract(load(spark, sf_dir, "pages"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS t
  FROM documents),
g AS (SELECT count(*) AS docs, CAST(sum(len(t)) AS BIGINT) AS total FROM d WHERE len(t) > 0),
q AS (
  SELECT DISTINCT r AS i, item_id, unnest(t) AS term
  FROM (SELECT row_number() OVER () AS r, item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS t FROM benchmark)),
tf AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY r, doc_id, n, term),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), g),
s AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))) AS impact
  FROM tf JOIN w USING (term), g),
found AS (
  SELECT i, item_id, r, doc_id, CAST(sum(impact) AS BIGINT) AS score
  FROM s JOIN q USING (term) GROUP BY i, item_id, r, doc_id HAVING sum(impact) > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM found) WHERE rank <= 10
"""


@query("op11_k2_treap_search", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treap.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), 10)


OP12_SQL = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS MATERIALIZED (
  SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(e, e) > 0),
l AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach(a, root) AS (
  SELECT r, vec_id FROM v
  UNION
  SELECT l.b, reach.root FROM reach JOIN l ON l.a = reach.a),
least AS (SELECT a AS r, min(root) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS r, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least USING (r) LEFT JOIN degree USING (r)
"""


@query("op12_lattice_near_dedup", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(load(spark, sf_dir, "embeddings"), 0.98)


def _op13_sql(rounds: int = 3) -> str:
    parts = ["""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, i, v[i] AS x FROM (SELECT r, v, unnest(range(1, 65)) AS i FROM kept)),
c0 AS MATERIALIZED (
  SELECT k, i, v[i] AS x FROM (
    SELECT k, v, unnest(range(1, 65)) AS i
    FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS k, v FROM kept) WHERE k < 16))"""]
    for n in range(rounds + 1):
        parts.append(f"""
a{n} AS MATERIALIZED (
  SELECT r, k, d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, k) AS nth FROM (
    SELECT r, k, CAST(sum((p.x - c.x) * (p.x - c.x)) AS BIGINT) AS d FROM p JOIN c{n} c USING (i) GROUP BY r, k)) WHERE nth = 1)""")
        if n < rounds:
            parts.append(f"""
c{n + 1} AS MATERIALIZED (
  SELECT k, i, coalesce((s - (s % m + m) % m) // m, x) AS x FROM c{n} LEFT JOIN (
    SELECT k, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS m FROM a{n} JOIN p USING (r) GROUP BY k, i) USING (k, i))""")
    return ",".join(parts) + f"""
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN (
  SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY k) USING (k)"""


@query("op13_equal_variance_clustering", _op13_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(load(spark, sf_dir, "embeddings"), k=16, rounds=3, size=64, scale=64)


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)
