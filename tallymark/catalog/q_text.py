"""Queries on text cleaning and text features, over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark.catalog import shapes as fx
from tallymark.catalog.q_tables import TAX_COLUMNS_SQL, with_tax_columns
from tallymark.catalog.registry import query
from tallymark.catalog.sql import (
    quote,
    sql_bucket,
    sql_buckets,
    sql_clean_model,
    sql_clean_rules,
    sql_ngrams,
    sql_tokens,
    with_shapes,
)
from tallymark.config import PAY_LABELS, RETAIL, SME, TEST_DESCRIPTION_PREFIX
from tallymark.functions import text
from tallymark.operators import overrides


@query("txt_fold_accents", "SELECT doc_id, strip_accents(coalesce(text, '')) AS text FROM documents")
def txt_fold_accents(spark, folder):
    documents = fx.table(spark, folder, "documents")
    return documents.select("doc_id", text.fold_accents(F.col("text")).alias("text"))


@query("txt_clean_rules", f"SELECT doc_id, {sql_clean_rules('text')} AS text FROM documents")
def txt_clean_rules(spark, folder):
    documents = fx.table(spark, folder, "documents")
    return documents.select("doc_id", text.clean_for_rules(F.col("text")).alias("text"))


@query("txt_clean_model", f"SELECT doc_id, {sql_clean_model('text')} AS text FROM documents")
def txt_clean_model(spark, folder):
    documents = fx.table(spark, folder, "documents")
    return documents.select("doc_id", text.clean_for_model(F.col("text")).alias("text"))


@query("txt_concat_counterparty", with_shapes("fx_transactions", """
SELECT transaction_id, description || ' ' || coalesce(bank_counterparty_name, '') AS text
FROM fx_transactions"""))
def txt_concat_counterparty(spark, folder):
    rows = fx.transactions(spark, folder)
    return rows.select("transaction_id", text.model_text(SME).alias("text"))


def _cleaned(spark, folder):
    """Documents and the transactions without one, so that empty texts occur too."""
    documents = fx.table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.lit("document").alias("kind"), "text"
    )
    short = fx.transactions(spark, folder, False).select(
        F.col("transaction_id").alias("id"), F.lit("order").alias("kind"),
        F.col("description").alias("text"),
    )
    rows = documents.unionByName(short)
    return rows.select("id", "kind", text.clean_for_model(F.col("text")).alias("cleaned"))


_CLEANED = f"""
texts AS (SELECT doc_id AS id, 'document' AS kind, text FROM documents
  UNION ALL SELECT transaction_id, 'order', description FROM fx_transactions_short),
cleaned AS MATERIALIZED (SELECT id, kind, {sql_clean_model('text')} AS c FROM texts),
tokens AS MATERIALIZED (SELECT id, kind, {sql_tokens('c')} AS t FROM cleaned)"""
_GRAMS = f"grams AS MATERIALIZED (SELECT id, kind, {sql_ngrams('t')} AS g FROM tokens)"


@query("txt_tokenize", with_shapes("fx_transactions_short", f"""
WITH {_CLEANED} SELECT id, kind, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos
FROM tokens"""))
def txt_tokenize(spark, folder):
    tokens = text.tokenize(F.col("cleaned"), RETAIL.max_tokens)
    return _cleaned(spark, folder).select("id", "kind", F.posexplode(tokens).alias("pos", "token"))


@query("txt_ngrams", with_shapes("fx_transactions_short", f"""
WITH {_CLEANED}, {_GRAMS} SELECT id, kind, unnest(g) AS gram, generate_subscripts(g, 1) - 1 AS pos
FROM grams"""))
def txt_ngrams(spark, folder):
    rows = _cleaned(spark, folder).withColumn(
        "tokens", text.tokenize(F.col("cleaned"), RETAIL.max_tokens)
    )
    grams = text.ngrams(F.col("tokens"))
    return rows.select("id", "kind", F.posexplode(grams).alias("pos", "gram"))


@query("txt_hash_buckets", with_shapes("fx_transactions_short", f"""
WITH {_CLEANED}, {_GRAMS}, hashed AS (SELECT id, kind, {sql_buckets('g')} AS b FROM grams)
SELECT id, kind, unnest(b) AS bucket, generate_subscripts(b, 1) - 1 AS pos FROM hashed"""))
def txt_hash_buckets(spark, folder):
    rows = _cleaned(spark, folder).withColumn(
        "tokens", text.tokenize(F.col("cleaned"), RETAIL.max_tokens)
    )
    buckets = text.hash_buckets(
        text.ngrams(F.col("tokens")), RETAIL.hash_buckets, RETAIL.sequence_length
    )
    return rows.select("id", "kind", F.posexplode(buckets).alias("pos", "bucket"))


@query("txt_test_marker", f"""
SELECT p_partkey, trim(regexp_extract(text, '^{TEST_DESCRIPTION_PREFIX}([a-zA-Z ]+)\\z', 1))
  AS test_category
FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name
  WHEN 1 THEN '{TEST_DESCRIPTION_PREFIX}' || p_name WHEN 2
  THEN '{TEST_DESCRIPTION_PREFIX} ' || p_type || ' ' ELSE '{TEST_DESCRIPTION_PREFIX}' || p_brand END
  AS text FROM part)""")
def txt_test_marker(spark, folder):
    key, prefix = F.col("p_partkey") % 4, F.lit(TEST_DESCRIPTION_PREFIX)
    described = (
        F.when(key == 0, F.col("p_name"))
        .when(key == 1, F.concat(prefix, "p_name"))
        .when(key == 2, F.concat(prefix, F.lit(" "), "p_type", F.lit(" ")))
        .otherwise(F.concat(prefix, "p_brand"))
    )
    parts = fx.table(spark, folder, "part")
    return parts.select("p_partkey", text.test_marker(described).alias("test_category"))


_LABEL_CASE = "CASE " + " ".join(
    f"WHEN contains(bank_specific__paylabels, {quote(label)}) THEN {quote(category)}"
    for label, category in PAY_LABELS
) + " ELSE '<null>' END"


@query("txt_paylabel_match", with_shapes("fx_transactions_short", f"""
SELECT transaction_id, {_LABEL_CASE} AS category FROM fx_transactions_short"""))
def txt_paylabel_match(spark, folder):
    category = text.pay_label_category(F.col("bank_specific__paylabels"))
    return fx.transactions(spark, folder, False).select(
        "transaction_id", F.coalesce(category, F.lit("<null>")).alias("category")
    )


_INTEREST_SQL = """CASE transaction_id % 4 WHEN 0 THEN 'Interest PAID after tax ' || description
  || ' deducted' WHEN 1 THEN 'gross interest paid after tax 1 deducted' ELSE description END"""


def with_interest(df):
    key = F.col("transaction_id") % 4
    changed = (
        F.when(key == 0, F.concat(F.lit("Interest PAID after tax "), "description", F.lit(" deducted")))
        .when(key == 1, F.lit("gross interest paid after tax 1 deducted"))
        .otherwise(F.col("description"))
    )
    return df.withColumn("description", changed)


@query("txt_interest_override", with_shapes("fx_transactions_short", f"""
SELECT transaction_id,
  CASE WHEN hit THEN 'Other Income' ELSE coalesce(category, '<null>') END AS category,
  CASE WHEN hit THEN 'ModelPrediction' ELSE 'ModelFallback' END AS category_source
FROM (SELECT *, regexp_matches(lower({_INTEREST_SQL}), '^interest paid after tax .* deducted')
  AS hit FROM fx_transactions_short)"""))
def txt_interest_override(spark, folder):
    rows = with_interest(fx.transactions(spark, folder, False))
    ruled = overrides.apply_interest(rows.withColumn("category_source", F.lit("ModelFallback")))
    return ruled.select(
        "transaction_id", F.coalesce("category", F.lit("<null>")).alias("category"),
        "category_source",
    )


def with_iban(df):
    """Ibans for some transactions, with an empty or missing one for the others."""
    key = F.col("transaction_id") % 5
    iban = F.when(key == 0, F.concat(F.lit("NL"), "transaction_id")).when(
        key == 1, F.concat(F.lit("DE"), "transaction_id")
    ).when(key == 2, F.lit(""))
    return df.withColumn("bank_counterparty_iban", iban)


IBAN_SQL = """CASE transaction_id % 5 WHEN 0 THEN 'NL' || transaction_id
  WHEN 1 THEN 'DE' || transaction_id WHEN 2 THEN '' END AS bank_counterparty_iban"""
COUNTRY_SQL = """CASE WHEN country_code <> '' THEN country_code
  WHEN bank_counterparty_iban <> '' THEN left(bank_counterparty_iban, 2)
  WHEN counter_account_type = 'CURRENT_ACCOUNT' THEN 'GB' ELSE '' END"""


@query("txt_country_from_iban", with_shapes("fx_transactions_short", f"""
SELECT transaction_id, {COUNTRY_SQL} AS country_code
FROM (SELECT *, {TAX_COLUMNS_SQL}, {IBAN_SQL} FROM fx_transactions_short)"""))
def txt_country_from_iban(spark, folder):
    rows = with_iban(with_tax_columns(fx.transactions(spark, folder, False)))
    return overrides.with_country(rows).select("transaction_id", "country_code")
