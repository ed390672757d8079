"""One query for each operator, over its whole table, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from worklens.llm import (
    ann, html_text, langid, minhash, mixing, negatives, ranking, rules, sentences, simhash,
    token_counts, urls, whitening,
)
from worklens.session import tune

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Callable[..., DataFrame]) -> Run:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return function(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


@query("op2_quality_rules")
def op2(table) -> DataFrame:
    judged = rules.judge(table("documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "log_ppl", F.col("low").alias("log_ppl_low"),
        F.col("high").alias("log_ppl_high"))


@query("op3_sentencepiece")
def op3(table) -> DataFrame:
    return sentences.encode(table("documents").select("doc_id", "text")).select(
        "doc_id", "ids", "n_pieces", "n_byte_pieces", "round_trip")


@query("op9_token_counts")
def op9(table) -> DataFrame:
    return token_counts.add_counts(table("documents").select("doc_id", "text")).drop("text")


@query("op7_simhash_neardup")
def op7(table) -> DataFrame:
    return simhash.near_duplicates(table("documents"))


@query("op8_language_id")
def op8(table) -> DataFrame:
    found = langid.identify(table("documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query("op10_mixing")
def op10(table) -> DataFrame:
    return mixing.mix(table("documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


@query("op1_url_filter")
def op1(table) -> DataFrame:
    pages = table("pages").select("page_id", "url")
    return urls.judge(pages, urls.labelled_by_host(pages)).select(
        "page_id", "host", "path", "rule", "verdict", "blocked_score")


@query("op5_html_extraction")
def op5(table) -> DataFrame:
    return html_text.extract(table("pages").select("page_id", "url", "html")).select(
        "page_id", "url", "text", "n_chars")


@query("op6_quality_classifier")
def op6(table) -> DataFrame:
    docs = table("documents").select("doc_id", "text")
    return ranking.classify(docs, table("labels")).drop("text")


@query("op4_nearest_neighbours")
def op4(table) -> DataFrame:
    return ann.search(table("embeddings"))


@query("op11_embedding_whitening")
def op11(table) -> DataFrame:
    return whitening.whiten(table("embeddings"))


@query("op12_minhash_neardup", """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1),
                                      lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM words
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (doc_id)
""")
def op12(table) -> DataFrame:
    return minhash.near_duplicates(table("documents"))


@query("op13_hard_negatives", """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                          ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
  n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 100 * n.score BETWEEN 50 * p.positive_score AND 95 * p.positive_score
QUALIFY rank <= 3
""")
def op13(table) -> DataFrame:
    return negatives.mine(table("embeddings"))
