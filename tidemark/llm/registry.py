"""The queries of this package, as the contracts ask for them, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, line_dedup, mixing, pii, quality_net, quality_rules, simhash, token_counts, topk, url_filter
from .common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = line_dedup.with_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return lines.select("row.doc_id", "lines.n_lines", "lines.n_dropped", F.sha2(F.col("lines.kept"), 256).alias("kept_sha256"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = quality_net.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_net.score(docs, net)
    return scored.select("doc_id", quality_net.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.cluster(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        F.col("__id").alias("doc_id"),
        F.col("__words").alias("size"),
        F.col("__source_words").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__copies") * F.col("__words")).cast("long").alias("taken"),
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.span_lists(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [of(kind) for kind in pii.BASE]
    added = F.filter("spans", lambda s: ~s["base"])
    more = lambda kind: F.size(F.filter(added, lambda s: s["kind"] == kind)).cast("long").alias(f"n_added_{kind}")
    n_spans, n_added = F.size("spans").cast("long").alias("n_spans"), F.size(added).cast("long").alias("n_added")
    return found.select("doc_id", *counts, F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"), n_spans, n_added, *map(more, pii.CANDIDATES))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


OP3_SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM documents),
k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
d AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (
  SELECT k.doc_id, k.pos, k.line, (d.key IS NOT NULL AND k.doc_id IS DISTINCT FROM d.keeper) AS gone
  FROM k LEFT JOIN d ON k.key = d.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP5_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

OP9_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
w AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM t)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM w),
c AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words
  FROM r, (SELECT unnest([0, 1, 2]) AS j) WHERE c > 1 GROUP BY doc_id),
l AS (
  SELECT doc_id, host, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h
  FROM (SELECT doc_id, host, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM t)),
f AS (SELECT host, h FROM l GROUP BY host, h HAVING count(DISTINCT doc_id) > 50),
g AS (
  SELECT l.doc_id, sum(len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS gone
  FROM l JOIN f ON l.host = f.host AND l.h = f.h GROUP BY l.doc_id),
s AS (
  SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_words_in_frequent_lines
  FROM t LEFT JOIN c ON t.doc_id = c.doc_id LEFT JOIN g ON t.doc_id = g.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (n_words - n_words_in_frequent_lines < 0.3 * n_words) AS kept,
       n_words_in_frequent_lines
FROM s
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = [op1_token_counts, op2_url_filter, op3_line_dedup, op4_simhash, op5_topk, op6_mixing, op7_pii, op8_quality_classifier, op9_quality_rules, op10_byte_bpe]
    return {f.__name__: f for f in made}


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": OP3_SQL, "op5_topk": OP5_SQL, "op9_quality_rules": OP9_SQL}
