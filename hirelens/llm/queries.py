"""The registered queries: each operator over its whole table, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm import (decontaminate, exact_dedup, html_text, line_dedup, mixing, near_dedup, periodic_runs, pii, prefix_trie, quality,
                          substring_dedup, topk, toxicity)
from hirelens.llm.common import read_table


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, docs, read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs, carry=["doc_id", "source"]).select("doc_id", "size", "source_size", "target", "taken", "source")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(read_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_quality(docs, docs, read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.matches(docs, read_table(spark, sf_dir, "benchmark")).where("contaminated")
    return found.groupBy("doc_id", "item_id").agg(F.max("found").alias("found"), F.max("longest").cast("long").alias("longest"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie.prefix_trie(prefix_trie.rebuild(prefix_trie.sequences(turns))).drop("node")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {f.__name__: f for f in (op1_topk, op2_html, op3_toxicity, op4_substring_dedup, op5_mixing, op6_pii, op7_quality, op8_decontaminate,
                                   op9_near_dedup, op10_line_dedup, op11_exact_dedup, op12_prefix_trie, op13_periodic_runs)}

ORACLES = {
    "op1_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk FROM s)
SELECT query_id, CAST(rk AS INTEGER) AS rank, vec_id, score FROM r WHERE rk <= 5""",
    "op5_mixing": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS k
  FROM documents
), s0 AS (SELECT source, sum(size) AS sz FROM d GROUP BY source),
s1 AS (SELECT source, CAST(sz AS BIGINT) AS sz, CAST([5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS DOUBLE) AS w FROM s0),
s2 AS (
  SELECT *, 2.0::DOUBLE * sz AS cap, 1.5::DOUBLE * sum(sz) OVER () AS alls, sum(w) OVER () AS allw,
    coalesce(sum(2.0::DOUBLE * sz) OVER o, 0) AS capb, coalesce(sum(w) OVER o, 0) AS wb
  FROM s1 WINDOW o AS (ORDER BY 2.0::DOUBLE * sz / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), s3 AS (SELECT *, (alls - capb) * w > cap * (allw - wb) AS capped FROM s2),
s4 AS (
  SELECT source, sz, CASE WHEN capped THEN cap ELSE
    w * (alls - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0)) / (allw - coalesce(sum(CASE WHEN capped THEN w END) OVER (), 0)) END AS target
  FROM s3
), p AS (
  SELECT d.doc_id, d.size, s4.sz AS source_size, s4.target, d.source, CAST(floor(s4.target + 0.5) AS BIGINT) AS budget,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source
), e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS ep FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, CAST(target AS DOUBLE) AS target, source,
  CAST(ep * size + greatest(0, least(size, budget - ep * source_size - start)) AS BIGINT) AS taken
FROM e""",
    "op10_line_dedup": r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), k AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.keeper AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op11_exact_dedup": r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS sha FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, sha AS text_sha256
FROM d WINDOW w AS (PARTITION BY sha)""",
    "op12_prefix_trie": r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  -- crc32 bit by bit: a byte is mixed in, then eight shifts (marked -1) follow
  SELECT c, xor(4294967295, list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
      lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, y: CASE WHEN y >= 0 THEN xor(a, y) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) % 4 AS h
  FROM (SELECT DISTINCT c FROM t)
), first_turns AS (SELECT ids.c, t.i AS d, t.r, t.x FROM ids JOIN t ON t.c = ids.c - ids.c % 20 AND t.i <= ids.h),
n_first AS (SELECT c, count(*) AS n FROM first_turns GROUP BY c),
rebuilt AS (
  SELECT * FROM first_turns
  UNION ALL SELECT ids.c, coalesce(n, 0) + t.i - ids.h, t.r, t.x FROM ids JOIN t ON t.c = ids.c AND t.i > ids.h LEFT JOIN n_first f ON f.c = ids.c
), p AS (
  SELECT c, d, x, sha256(string_agg(md5(length(r) || ':' || r || x), '') OVER (PARTITION BY c ORDER BY d)) AS k FROM rebuilt
), m AS (
  SELECT c, d, x, k, lag(k, 1, 'root') OVER (PARTITION BY c ORDER BY d) AS up FROM p
  UNION ALL SELECT c, 0, '', 'root', NULL FROM ids
), node AS (
  SELECT k, any_value(d) AS d, min(c) AS c, any_value(up) AS up, count(*) AS n,
    (count(*) - 1) * len(regexp_extract_all(any_value(x), '[^\x20\x09-\x0D]+')) AS saved
  FROM m GROUP BY k
), kids AS (SELECT up AS k, count(*) AS n FROM node WHERE up IS NOT NULL GROUP BY up),
below AS (
  SELECT a.k, sum(CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END) AS leaves, sum(o.saved) AS saved
  FROM node o LEFT JOIN kids ON kids.k = o.k JOIN m a ON a.c = o.c AND a.d <= o.d GROUP BY a.k
), finish AS (
  SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS sha
  FROM (SELECT *, d = max(d) OVER (PARTITION BY c) AS final FROM m) WHERE final GROUP BY k
)
SELECT node.c AS conv_id, CAST(node.d AS BIGINT) AS depth, parent.c AS parent_conv_id, node.n AS n_convs, coalesce(kids.n, 0) AS n_children,
  CAST(below.leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, coalesce(finish.sha, sha256('')) AS ends_sha256
FROM node LEFT JOIN node parent ON parent.k = node.up LEFT JOIN kids ON kids.k = node.k
JOIN below ON below.k = node.k LEFT JOIN finish ON finish.k = node.k""",
}
