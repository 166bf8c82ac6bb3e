"""Queries on whitened vectors and ranked search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymark.llm import lexical_search, whitening
from tallymark.llm.registry import query, table

OP13_SQL = r"""
WITH terms AS MATERIALIZED (
    SELECT doc_id, t, count(*) AS tf FROM (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
        FROM documents)
    GROUP BY ALL
), lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM terms GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths),
tempered AS (SELECT doc_id, 100 - 90 + (90 * n * docs) // words AS m FROM lengths, totals),
weights AS (
    SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT t, count(*) AS df FROM terms GROUP BY t), totals
), wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM benchmark
), scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM wanted JOIN weights USING (t) JOIN terms USING (t) JOIN tempered USING (doc_id)
    GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query("op12_whitening")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))


@query("op13_lexical_search", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
