"""Queries on vectors, score arrays and the ordered business rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark.catalog import shapes as fx
from tallymark.catalog.q_tables import MCC_SQL, mcc_table
from tallymark.catalog.registry import query
from tallymark.catalog.sql import (
    Steps,
    in_list,
    quote,
    sql_buckets,
    sql_clean_model,
    sql_ngrams,
    sql_scores_text,
    sql_tokens,
    text_list,
    with_shapes,
)
from tallymark.config import PAY_LABELS, RETAIL, SME
from tallymark.functions import scores as S
from tallymark.functions import text, vectors
from tallymark.operators import embedding, postprocess
from tallymark.plans.predict import with_mcc_index

DIMENSIONS = 64


def scores_text(column: str = "scores"):
    """A score array as text of whole millionths."""
    millionths = F.transform(column, lambda x: F.round(x * 1000000).cast("long").cast("string"))
    return F.array_join(millionths, ",").alias("scores")


def _values(df, key, vector):
    exploded = df.select(key, F.posexplode(vector).alias("pos", "value"))
    return exploded.withColumn("value", F.round("value", 6) + F.lit(0.0))


# --- vectors ------------------------------------------------------------------------------


@query("vec_l2_normalize", """
SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, round(unnest(embedding)::DOUBLE
  / sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) + 0.0 AS value
FROM embeddings""")
def vec_l2_normalize(spark, folder):
    rows = fx.table(spark, folder, "embeddings")
    return _values(rows, "vec_id", vectors.l2_normalize(F.col("embedding")))


def token_vectors(spark, folder):
    return fx.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("bucket"), F.col("embedding").alias("vector")
    )


def vocabulary(spark, folder) -> int:
    """Number of token vectors: the model's vocabulary size, a configuration value."""
    return fx.table(spark, folder, "embeddings").count()


MEANS_SQL = f"""
cleaned AS MATERIALIZED (SELECT doc_id, {sql_clean_model('text')} AS c FROM documents),
tokens AS MATERIALIZED (SELECT doc_id, {sql_tokens('c')} AS t FROM cleaned),
grams AS MATERIALIZED (SELECT doc_id, {sql_ngrams('t')} AS g FROM tokens),
bucketed AS MATERIALIZED (SELECT doc_id, {sql_buckets('g', 'size')} AS b
  FROM grams, (SELECT count(*) AS size FROM embeddings)),
means AS (SELECT doc_id, p.pos, coalesce(avg(embedding[p.pos + 1]::DOUBLE), 0) AS value
  FROM (SELECT doc_id, unnest(CASE WHEN len(list_filter(b, lambda x: x <> 0)) = 0
      THEN [NULL] ELSE list_filter(b, lambda x: x <> 0) END) AS bucket FROM bucketed)
  LEFT JOIN embeddings ON vec_id = bucket, (SELECT unnest(range({DIMENSIONS})) AS pos) p
  GROUP BY ALL)"""


def _bucketed_documents(spark, folder, size: int):
    documents = fx.table(spark, folder, "documents").select(
        "doc_id", text.clean_for_model(F.col("text")).alias("cleaned")
    )
    tokens = documents.withColumn("tokens", text.tokenize(F.col("cleaned"), RETAIL.max_tokens))
    buckets = text.hash_buckets(text.ngrams(F.col("tokens")), size, RETAIL.sequence_length)
    return tokens.select("doc_id", buckets.alias("buckets"))


@query("vec_masked_mean", f"WITH {MEANS_SQL} SELECT doc_id, pos, round(value, 6) + 0.0 AS value FROM means")
def vec_masked_mean(spark, folder):
    size = vocabulary(spark, folder)
    means = embedding.masked_mean(
        _bucketed_documents(spark, folder, size), ["doc_id"], "buckets",
        token_vectors(spark, folder), DIMENSIONS, size, "mean",
    )
    return _values(means, "doc_id", F.col("mean"))


CENTROIDS_SQL = f"""
label_means AS (SELECT label, p.pos, avg(embedding[p.pos + 1]::DOUBLE) AS value
  FROM embeddings, (SELECT unnest(range({DIMENSIONS})) AS pos) p GROUP BY ALL),
centroids AS (SELECT label, pos, value / sqrt(sum(value * value) OVER (PARTITION BY label)) AS value
  FROM label_means)"""


# The embeddings carry the labels 0 to 9.
LABELS = 10


def _centroids(spark, folder):
    rows = fx.table(spark, folder, "embeddings")
    return embedding.label_centroids(rows, "label", "embedding", DIMENSIONS)


@query("vec_label_centroids", f"""
WITH {CENTROIDS_SQL} SELECT label, pos, round(value, 6) + 0.0 AS value FROM centroids""")
def vec_label_centroids(spark, folder):
    return _values(_centroids(spark, folder), "label", F.col("vector"))


SIMILARITY_SQL = f"""
{CENTROIDS_SQL},
units AS (SELECT vec_id, label AS truth, list_transform(embedding, lambda x: x::DOUBLE
  / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE)))) AS u
  FROM embeddings),
listed AS (SELECT label, list(value ORDER BY pos) AS v FROM centroids GROUP BY label),
sims AS MATERIALIZED (SELECT vec_id, truth, label, list_dot_product(u, v) AS value
  FROM units, listed)"""


def _similarities(spark, folder):
    matrix = embedding.label_matrix(_centroids(spark, folder), "label", LABELS, DIMENSIONS)
    rows = fx.table(spark, folder, "embeddings")
    rows = embedding.with_similarities(rows, F.col("embedding"), matrix, "similarity")
    return rows.select("vec_id", "label", "similarity")


@query("vec_label_similarity", f"""
WITH {SIMILARITY_SQL} SELECT vec_id, label AS pos, round(value, 6) + 0.0 AS value FROM sims""")
def vec_label_similarity(spark, folder):
    return _values(_similarities(spark, folder), "vec_id", F.col("similarity"))


@query("vec_semi_hard_loss", f"""
WITH {SIMILARITY_SQL},
positive AS (SELECT vec_id, value AS pos FROM sims WHERE label = truth),
negative AS (SELECT s.vec_id, any_value(p.pos) AS pos,
  coalesce(max(CASE WHEN s.value < p.pos THEN s.value END), min(s.value)) AS neg
  FROM sims s JOIN positive p USING (vec_id) WHERE s.label <> s.truth GROUP BY s.vec_id)
SELECT round(avg(greatest(0, 0.1 - (pos - neg))), 6) AS loss FROM negative""")
def vec_semi_hard_loss(spark, folder):
    loss = embedding.semi_hard_loss(F.col("similarity"), F.col("label"), RETAIL.margin)
    return _similarities(spark, folder).agg(F.round(F.avg(loss), 6).alias("loss"))


# --- score arrays -------------------------------------------------------------------------


@query("score_add_uncategorized", with_shapes("fx_scored_retail fx_scored_sme", f"""
SELECT 'retail' AS model, transaction_id, {sql_scores_text('list_concat(scores, [0.0])')} AS scores
FROM fx_scored_retail
UNION ALL SELECT 'sme', transaction_id,
  {sql_scores_text('list_concat(scores, [0.0, 0.0, 0.0, 0.0, 0.0])')} FROM fx_scored_sme"""))
def score_add_uncategorized(spark, folder):
    parts = []
    for config in (RETAIL, SME):
        rows = fx.scored(spark, folder, config, texts=False)
        rows = rows.withColumn("scores", S.add_uncategorized(F.col("scores"), config))
        parts.append(rows.select(F.lit(config.name).alias("model"), "transaction_id", scores_text()))
    return parts[0].unionByName(parts[1])


def _apply_rule_sql() -> str:
    steps = Steps("fx_scored_retail").add(is_open="transaction_type = 'debit'")
    steps.set_score(3, 1.0, "amount > 100000", closes=True)
    steps.set_score(7, -1.0, "counter_account_type = 'SAVINGS_ACCOUNT'", closes=False)
    return steps.sql(
        f"SELECT transaction_id, {sql_scores_text()} AS scores, is_open FROM {{src}}"
    )


@query("score_apply_rule", with_shapes("fx_scored_retail", _apply_rule_sql()))
def score_apply_rule(spark, folder):
    rows = fx.scored(spark, folder, RETAIL, texts=False)
    n = len(RETAIL.trainable)
    rows = rows.withColumn("is_open", F.col("transaction_type") == "debit")
    scores, still_open = S.apply_rule(
        F.col("scores"), [3], F.col("amount") > 100000, 1.0, n, F.col("is_open")
    )
    rows = rows.withColumns({"scores": scores, "is_open": still_open})
    condition = F.col("counter_account_type") == "SAVINGS_ACCOUNT"
    scores, _ = S.apply_rule(F.col("scores"), [7], condition, -1.0, n, F.col("is_open"))
    return rows.withColumn("scores", scores).select("transaction_id", scores_text(), "is_open")


def _indices(categories) -> str:
    return "[" + ", ".join(str(SME.index(c) + 1) for c in categories) + "]"


_MASK_SQL = f"""list_transform(list_concat(scores, [0.0, 0.0, 0.0, 0.0, 0.0]), lambda x, i: CASE
  WHEN transaction_type = 'credit' AND list_contains({_indices(SME.outgoing)}, i) THEN -1.0
  WHEN transaction_type = 'debit' AND list_contains({_indices(SME.incoming)}, i) THEN -1.0
  ELSE x END)"""


@query("score_direction_mask", with_shapes("fx_scored_sme", f"""
SELECT transaction_id, {sql_scores_text(_MASK_SQL)} AS scores FROM fx_scored_sme"""))
def score_direction_mask(spark, folder):
    rows = fx.scored(spark, folder, SME, texts=False)
    rows = rows.withColumn("scores", S.add_uncategorized(F.col("scores"), SME))
    masked = S.direction_mask(SME, "scores", "transaction_type")
    return rows.withColumn("scores", masked).select("transaction_id", scores_text())


# --- retail rules, read one after the other -----------------------------------------------

_INTERNAL, _INCOME = RETAIL.index("Internal"), RETAIL.index("Income")
_SAVINGS, _GENERAL = RETAIL.index("Savings"), RETAIL.index("General")
_MAX = "list_max(scores)"
_BEST = "(list_position(scores, list_max(scores)) - 1)"
_TO_SAVINGS = "account_type = 'CURRENT_ACCOUNT' AND counter_account_type = 'SAVINGS_ACCOUNT'"


def retail_begin(source: str = "fx_scored_retail") -> Steps:
    return Steps(source).then(
        f"SELECT * REPLACE (list_concat(scores, [0.0]) AS scores), true AS is_open, "
        f"{MCC_SQL} AS mcc, {sql_clean_model('description')} AS cleaned FROM {{src}}"
    )


def retail_single_sql(s: Steps) -> Steps:
    s.set_score(_INTERNAL, 1, "account_type = 'SAVINGS_ACCOUNT'", True)
    s.set_score(
        _INTERNAL, -1, "internal_transaction = '' AND account_type = 'CURRENT_ACCOUNT'", False
    )
    s.set_score(_INCOME, -1, "transaction_type = 'debit'", False)
    for label, category in PAY_LABELS:
        found = f"contains(bank_specific__paylabels, {quote(label)})"
        s.set_score(RETAIL.index(category), 1, found, True)
    return s


def retail_savings_sql(s: Steps) -> Steps:
    s.set_score(_SAVINGS, 1, _TO_SAVINGS, True)
    s.add(sure=f"{_BEST} = {_SAVINGS} AND {_MAX} >= 0.45")
    s.set_score(_INTERNAL, -1, "internal_transaction <> '' AND sure", False)
    return s.set_score(_INTERNAL, 1, "internal_transaction <> '' AND NOT sure", True)


def retail_remaining_sql(s: Steps) -> Steps:
    s.add(confident=f"{_MAX} >= 0.45")
    s.set_score(_SAVINGS, 1, f"{_BEST} = {_SAVINGS} AND confident", True)
    s.set_score(_INTERNAL, 1, f"{_BEST} = {_INTERNAL} AND confident", True)
    s.set_score(_INTERNAL, 1, "internal_transaction <> ''", True)
    return s.set_score(_INCOME, 1, "transaction_type = 'credit'", True)


def retail_fallback_sql(s: Steps) -> Steps:
    s.set_score(_GENERAL, 1, "cleaned = '' AND transaction_type = 'debit'", True)
    s.add(at_least=f"{_MAX} >= 0.45", was_open="is_open")
    s.replace(is_open="true").set_score(_GENERAL, -1, "at_least AND cleaned <> ''", False)
    s.replace(is_open="was_open AND NOT at_least")
    s.set_score("mcc", 1, "mcc > -1", True)
    s.set_score(_GENERAL, 1, "true", True)
    return s.add(
        category_source="CASE WHEN at_least THEN 'ModelPrediction' ELSE 'ModelFallback' END"
    )


def _stage_out(s: Steps, *more: str) -> str:
    extra = "".join(f", {m}" for m in more)
    return s.sql(f"SELECT transaction_id, {sql_scores_text()} AS scores, is_open AS open{extra} "
                 "FROM {src}")


def _retail_rows(spark, folder, texts: bool = True):
    rows = fx.scored(spark, folder, RETAIL, texts)
    rows = rows.withColumn("cleaned_description", text.clean_for_model(F.col("description")))
    return with_mcc_index(rows, mcc_table(spark, folder))


def _retail_stage(spark, folder, stage):
    rows = stage(postprocess.retail_start(_retail_rows(spark, folder), RETAIL), RETAIL)
    return postprocess.retail_finish(rows, RETAIL, stage_open=True)


@query("post_retail_single_feature", with_shapes(
    "fx_scored_retail", _stage_out(retail_single_sql(retail_begin()))))
def post_retail_single_feature(spark, folder):
    rows = _retail_stage(spark, folder, postprocess.retail_single_feature)
    return rows.select("transaction_id", scores_text(), "open")


@query("post_retail_savings", with_shapes(
    "fx_scored_retail", _stage_out(retail_savings_sql(retail_begin()))))
def post_retail_savings(spark, folder):
    rows = _retail_stage(spark, folder, postprocess.retail_savings)
    return rows.select("transaction_id", scores_text(), "open")


@query("post_retail_remaining", with_shapes(
    "fx_scored_retail", _stage_out(retail_remaining_sql(retail_begin()))))
def post_retail_remaining(spark, folder):
    rows = _retail_stage(spark, folder, postprocess.retail_remaining)
    return rows.select("transaction_id", scores_text(), "open")


@query("post_retail_fallback", with_shapes(
    "fx_scored_retail", _stage_out(retail_fallback_sql(retail_begin()), "category_source")))
def post_retail_fallback(spark, folder):
    rows = _retail_stage(spark, folder, postprocess.retail_fallback)
    return rows.select("transaction_id", scores_text(), "open", "category_source")


def retail_chain_sql(s: Steps) -> Steps:
    for part in (
        retail_single_sql, retail_savings_sql, retail_remaining_sql, retail_fallback_sql
    ):
        part(s)
    return s.add(category_name=f"({text_list(RETAIL.categories)})[{_BEST} + 1]")


@query("post_retail", with_shapes("fx_scored_retail", retail_chain_sql(retail_begin()).sql(
    f"SELECT transaction_id, {sql_scores_text()} AS scores, category_name AS category, "
    "category_source FROM {src}")))
def post_retail(spark, folder):
    rows = _retail_rows(spark, folder).drop("category")
    rows = postprocess.retail(rows, RETAIL)
    return rows.select("transaction_id", scores_text(), "category", "category_source")


# --- sme rules ----------------------------------------------------------------------------

_OTHER_OUT, _OTHER_IN = SME.index("Other Expenses"), SME.index("Other Income")
_TEST_NAMES = ["", "Payroll Tax", "No such category", "Revenue"]


def with_test_category(df):
    names = S.literal_array(_TEST_NAMES)
    chosen = F.when(F.col("transaction_id") % 10 < 4, F.col("transaction_id") % 10).otherwise(0)
    return df.withColumn("test_category", F.get(names, chosen.cast("int")))


_TEST_SQL = (
    f"({text_list(_TEST_NAMES)})[CASE WHEN transaction_id % 10 < 4 THEN transaction_id % 10 "
    "ELSE 0 END + 1]"
)


def sme_begin(source: str = "fx_scored_sme", test_category: str = _TEST_SQL) -> Steps:
    """Counterparty and description cleaned together, and both direction masks."""
    joined = "description || ' ' || coalesce(bank_counterparty_name, '')"
    return Steps(source).then(
        f"SELECT * REPLACE ({_MASK_SQL} AS scores), true AS is_open, "
        f"{test_category} AS test_category, CASE WHEN transaction_id % 19 = 0 THEN '' "
        f"ELSE {sql_clean_model(joined)} END AS cleaned FROM {{src}}"
    )


def sme_business_sql(s: Steps) -> Steps:
    s.set_score(
        SME.index("Corporate Savings Deposits"), 1, f"{_TO_SAVINGS} AND transaction_type = 'debit'",
        True,
    )
    return s.set_score(
        SME.index("Equity Financing"), 1, f"{_TO_SAVINGS} AND transaction_type = 'credit'", True
    )


def sme_fallback_sql(s: Steps) -> Steps:
    s.set_score(_OTHER_OUT, 1, "cleaned = '' AND transaction_type = 'debit'", True)
    s.set_score(_OTHER_IN, 1, "cleaned = '' AND transaction_type = 'credit'", True)
    s.add(at_least=f"{_MAX} >= 0.65", was_open="is_open")
    s.replace(is_open="true")
    s.set_score(_OTHER_OUT, -1, "at_least AND cleaned <> ''", False)
    s.set_score(_OTHER_IN, -1, "at_least AND cleaned <> ''", False)
    s.replace(is_open="was_open")
    s.set_score(_OTHER_OUT, 1, "NOT at_least AND transaction_type = 'debit'", True)
    s.set_score(_OTHER_IN, 1, "NOT at_least AND transaction_type = 'credit'", True)
    return s.add(
        category_source="CASE WHEN at_least THEN 'ModelPrediction' ELSE 'ModelFallback' END"
    )


def sme_test_sql(s: Steps) -> Steps:
    names = text_list(SME.categories)
    known = f"test_category IN {in_list(SME.categories)}"
    return s.replace(
        scores=f"CASE WHEN {known} THEN list_transform({names}, "
        "lambda c: CASE WHEN c = test_category THEN 1.0 ELSE 0.0 END)::DOUBLE[] ELSE scores END",
        category_source=f"CASE WHEN {known} THEN 'ModelPrediction' ELSE category_source END",
    )


def _sme_rows(spark, folder):
    rows = with_test_category(fx.scored(spark, folder, SME))
    cleaned = F.when(F.col("transaction_id") % 19 == 0, F.lit("")).otherwise(
        text.clean_for_model(text.model_text(SME))
    )
    return rows.withColumn("cleaned_description", cleaned)


def _sme_stage(spark, folder, stage):
    rows = stage(postprocess.sme_start(_sme_rows(spark, folder), SME), SME)
    return postprocess.sme_finish(rows, SME, stage_open=True)


@query("post_sme_business", with_shapes("fx_scored_sme", _stage_out(sme_business_sql(sme_begin()))))
def post_sme_business(spark, folder):
    rows = _sme_stage(spark, folder, postprocess.sme_business)
    return rows.select("transaction_id", scores_text(), "open")


@query("post_sme_fallback", with_shapes(
    "fx_scored_sme", _stage_out(sme_fallback_sql(sme_begin()), "category_source")))
def post_sme_fallback(spark, folder):
    rows = _sme_stage(spark, folder, postprocess.sme_fallback)
    return rows.select("transaction_id", scores_text(), "open", "category_source")


@query("post_sme_test_rows", with_shapes("fx_scored_sme", sme_test_sql(
    sme_begin().add(category_source="'ModelFallback'")).sql(
    f"SELECT transaction_id, {sql_scores_text()} AS scores, category_source FROM {{src}}")))
def post_sme_test_rows(spark, folder):
    rows = _sme_rows(spark, folder).withColumn("category_source", F.lit("ModelFallback"))
    rows = rows.withColumn("scores", S.add_uncategorized(F.col("scores"), SME))
    masked = S.direction_mask(SME, "scores", "transaction_type")
    rows = postprocess.sme_test_rows(rows.withColumn("scores", masked), SME)
    return rows.select("transaction_id", scores_text(), "category_source")


def sme_chain_sql(s: Steps) -> Steps:
    sme_test_sql(sme_fallback_sql(sme_business_sql(s)))
    return s.add(category_name=f"({text_list(SME.categories)})[{_BEST} + 1]")


@query("post_sme", with_shapes("fx_scored_sme", sme_chain_sql(sme_begin()).sql(
    f"SELECT transaction_id, {sql_scores_text()} AS scores, category_name AS category, "
    "category_source FROM {src}")))
def post_sme(spark, folder):
    rows = postprocess.sme(_sme_rows(spark, folder).drop("category"), SME)
    return rows.select("transaction_id", scores_text(), "category", "category_source")
