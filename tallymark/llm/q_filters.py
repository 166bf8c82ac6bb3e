"""Queries that judge documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import decontamination, language_id, quality_rules, toxicity, url_filter
from tallymark.llm.registry import query, table
from tallymark.llm.url_filter import Rule
from tallymark.staging import stage

RULES = [
    Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"),
]
OP7_SQL = r"""
WITH rules(verdict, host, path) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
           ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), rest AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
    FROM pages
), parts AS (
    SELECT page_id,
           translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM rest
), fits AS (
    SELECT page_id, x.host || x.path AS rule, verdict,
           row_number() OVER (PARTITION BY page_id ORDER BY length(x.host || x.path) DESC) AS k
    FROM parts p JOIN rules x
      ON (p.host = x.host OR ends_with(p.host, '.' || x.host)) AND starts_with(p.path, x.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE k = 1) USING (page_id)
"""

TOXIC = 0.5


@query("op3_toxicity")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    chain = toxicity.fit(docs, table(spark, folder, "labels"), ["quality", "toxic"])
    return toxicity.predict(docs, chain).select(
        "doc_id", "p_quality", "p_toxic", (F.col("p_toxic") >= TOXIC).alias("toxic")
    )


@query("op5_decontamination")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


@query("op7_url_filter", OP7_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages").select("page_id", "url"), RULES).drop("url")


@query("op10_language_id")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", language_id.held_out())
    model = language_id.fit(docs.filter(~F.col("held_out")))
    return language_id.predict(docs, model).select("doc_id", "held_out", "lang_pred", "score")


@query("op11_quality_rules")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    measured = stage(quality_rules.measure(docs), "measured")
    rules = quality_rules.fit(measured, table(spark, folder, "labels"))
    return quality_rules.judge(measured, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule",
    )
