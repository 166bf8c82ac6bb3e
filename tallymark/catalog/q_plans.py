"""Queries on whole compositions: training tables, features, prediction, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark.catalog import shapes as fx
from tallymark.catalog.q_rules import labels_sql, base_sql
from tallymark.catalog.q_samples import (
    COVERAGE_SQL,
    EVALUATED_SQL,
    MRR_SQL,
    RECALL_SQL,
    REPORT_SQL,
    evaluated,
)
from tallymark.catalog.q_scores import (
    DIMENSIONS,
    retail_begin,
    retail_chain_sql,
    sme_begin,
    sme_chain_sql,
    token_vectors,
    vocabulary,
)
from tallymark.catalog.q_tables import (
    COUNTRY_OK_SQL,
    FLAGGED_SQL,
    TAXED_SQL,
    TAX_COLUMNS_SQL,
    mcc_table,
    tax_category_sql,
    with_tax_columns,
)
from tallymark.catalog.q_text import COUNTRY_SQL, IBAN_SQL, with_iban
from tallymark.catalog.registry import query
from tallymark.catalog.sql import (
    in_list,
    quote,
    sql_buckets,
    sql_clean_model,
    sql_hash,
    sql_ngrams,
    sql_tokens,
    text_list,
    with_shapes,
)
from tallymark.config import RETAIL, SME, TEST_DESCRIPTION_PREFIX
from tallymark.operators import embedding, features, filters, metrics
from tallymark.plans import evaluate, predict, training
from tallymark.plans.training import DomainTables, SampleSettings

_SETTINGS = SampleSettings(*fx.WINDOW)
_SAMPLE_COLUMNS = (
    "kind", "domain", "user_id", "account_id", "transaction_id", "country_code", "amount",
    "description_md5", "target_category", "category_index",
)


def _domain_tables(spark, folder, with_feedback: bool) -> DomainTables:
    return DomainTables(
        users=fx.users(spark, folder),
        accounts=fx.accounts(spark, folder),
        transactions=fx.transactions(spark, folder),
        test_users=fx.test_users(spark, folder),
        feedback=fx.feedback_sources(spark, folder) if with_feedback else (),
    )


def _inspection(spark, folder):
    rented = fx.feedback(spark, folder).where(F.col("category") == "Rent")
    return rented.select("user_id", "account_id", "transaction_id")


def _samples(training_rows, production_rows):
    """Both samples below each other."""
    tagged = filters.tag(training_rows, kind="training").unionByName(
        filters.tag(production_rows, kind="production")
    )
    return tagged.withColumns(
        {
            "target_category": F.coalesce("target_category", F.lit("<null>")),
            "category_index": F.coalesce("target_category_int", F.lit(-1)),
            "description_md5": F.md5("description"),
        }
    ).select(*_SAMPLE_COLUMNS)


def eligible_sql(clients, countries: str, domain: str) -> str:
    """Users and accounts that count in a domain."""
    return f"""users_{domain} AS (SELECT * FROM ({FLAGGED_SQL}) WHERE {countries}
  AND client_id IN {in_list(clients)}),
accounts_{domain} AS (SELECT * FROM fx_accounts WHERE deleted IS NULL
  AND site_id <> '{fx.TEST_SITE}')"""


def joined_sql(domain: str, latest: str, transactions: str) -> str:
    return f"""SELECT '{domain}' AS domain, t.user_id, t.account_id, t.transaction_id, t.date,
  t.pending, t.amount, t.description, u.country_code, l.target_category
FROM {latest} l, {transactions} t, users_{domain} u, accounts_{domain} a
WHERE t.user_id = l.user_id AND t.account_id = l.account_id AND t.date = l.date
  AND t.transaction_id = l.transaction_id AND t.pending = l.pending
  AND u.user_id = l.user_id AND a.user_id = l.user_id AND a.account_id = l.account_id"""


def samples_sql(base: str, categories, countries) -> str:
    """Training and production samples of a base with a domain column."""
    index = f"coalesce(list_position({text_list(categories)}, target_category) - 1, -1)"
    columns = f"""domain, user_id, account_id, transaction_id, country_code, amount,
  md5(description) AS description_md5, coalesce(target_category, '<null>') AS target_category, {index} AS category_index"""
    return f"""SELECT 'training' AS kind, {columns} FROM (SELECT *, row_number() OVER
    (PARTITION BY domain, country_code ORDER BY {sql_hash(123)}) AS n FROM {base}
  WHERE date >= DATE '{fx.START}' AND country_code IN {in_list(countries)})
WHERE n <= {fx.PER_COUNTRY}
UNION ALL SELECT 'production', {columns} FROM (SELECT *, row_number() OVER
    (PARTITION BY domain ORDER BY {sql_hash(123)}) AS n FROM {base}
  WHERE date BETWEEN DATE '{fx.WINDOW[0]}' AND DATE '{fx.WINDOW[1]}')
WHERE n <= {fx.PRODUCTION}"""


_RETAIL_SHAPES = "fx_latest fx_users fx_test_users fx_accounts fx_transactions fx_feedback"
_RETAIL_ELIGIBLE = eligible_sql(fx.CLIENTS, COUNTRY_OK_SQL, "app")


def labelled_rows_per_country(spark, folder):
    base = training.labelled_base(
        _domain_tables(spark, folder, True), fx.RETAIL_TEST, "app"
    )
    return metrics.rows_per_country(filters.tag(base, domain="app"))


@query("pipe_labelled_rows_per_country", with_shapes(_RETAIL_SHAPES, f"""
WITH {_RETAIL_ELIGIBLE}
SELECT domain, country_code, count(*) AS n_rows
FROM ({joined_sql('app', 'fx_latest', 'fx_transactions')}) GROUP BY ALL"""))
def pipe_labelled_rows_per_country(spark, folder):
    return labelled_rows_per_country(spark, folder)


@query("pipe_training_table", with_shapes(_RETAIL_SHAPES, f"""
WITH {_RETAIL_ELIGIBLE},
base AS MATERIALIZED ({joined_sql('app', 'fx_latest', 'fx_transactions')})
{samples_sql('base', RETAIL.categories, RETAIL.countries)}"""))
def pipe_training_table(spark, folder):
    pair = training.training_tables(
        _domain_tables(spark, folder, True), fx.RETAIL_TEST, "app", _SETTINGS
    )
    return _samples(*[filters.tag(df, domain="app") for df in pair])


_HELD_OUT = """(SELECT t.* FROM {source} t
  ANTI JOIN (SELECT DISTINCT user_id, account_id, transaction_id FROM fx_feedback
    WHERE category = 'Rent') f USING (user_id, account_id, transaction_id)
  WHERE t.date >= DATE '{start}')"""


@query("pipe_preprocess_retail", with_shapes(_RETAIL_SHAPES, f"""
WITH {_RETAIL_ELIGIBLE},
kept AS MATERIALIZED {_HELD_OUT.format(source='fx_transactions', start=fx.START)},
base AS MATERIALIZED ({joined_sql('app', 'fx_latest', 'kept')})
{samples_sql('base', RETAIL.categories, RETAIL.countries)}"""))
def pipe_preprocess_retail(spark, folder):
    samples = training.preprocess_retail(
        {"app": _domain_tables(spark, folder, True)}, fx.RETAIL_TEST, _SETTINGS,
        _inspection(spark, folder),
    )
    return _samples(*samples)


_SME_COUNTRY = "(country_code = 'GB' AND test_user = 0 OR country_code = 'NL')"


def _sme_sql() -> str:
    """Generated labels of both domains; the app domain only keeps business accounts."""
    ctes = [f"kept AS MATERIALIZED {_HELD_OUT.format(source='fx_transactions', start=fx.START)}"]
    clients = fx.SME_TEST.clients
    no_tests = "user_id NOT IN (SELECT user_id FROM fx_test_users)"
    ctes.append(f"""candidates AS MATERIALIZED (SELECT * REPLACE (lower(description) AS description)
  FROM kept k WHERE category <> 'Internal' AND EXISTS (SELECT 1 FROM fx_users u
    WHERE u.user_id = k.user_id AND country_code = 'GB' AND {no_tests}))""")
    ctes.append(f"""qualifying AS MATERIALIZED (SELECT DISTINCT account_id FROM candidates
  WHERE transaction_type = 'debit' AND amount > 30
  AND regexp_matches(description, {quote(fx.BUSINESS_PATTERN)}))""")
    ctes.append("""app_rows AS (SELECT * FROM candidates
  WHERE account_id IN (SELECT account_id FROM qualifying))""")
    bases = []
    for domain, rows in (("business", "kept"), ("app", "app_rows")):
        ctes.append(eligible_sql(clients[domain], _SME_COUNTRY, domain))
        ctes.append(base_sql(clients[domain], f"(SELECT * FROM {rows} WHERE {no_tests})",
                             f"tagged_{domain}"))
        hits = labels_sql(fx.pack(domain), clients[domain], f"tagged_{domain}")
        ctes.append(f"""latest_{domain} AS MATERIALIZED (SELECT user_id, account_id,
  transaction_id, date, pending, min(category) AS target_category FROM ({hits})
  GROUP BY ALL)""")
        bases.append(joined_sql(domain, f"latest_{domain}", "kept"))
    ctes.append(f"base AS MATERIALIZED ({' UNION ALL '.join(bases)})")
    return f"WITH {', '.join(ctes)} {samples_sql('base', SME.categories, SME.countries)}"


@query("pipe_preprocess_sme", with_shapes(
    "fx_users fx_test_users fx_accounts fx_transactions fx_feedback", _sme_sql()))
def pipe_preprocess_sme(spark, folder):
    domains = {
        d: _domain_tables(spark, folder, False) for d in fx.SME_TEST.domains
    }
    samples = training.preprocess_sme(
        domains, fx.SME_TEST, _SETTINGS, {d: fx.pack(d) for d in domains}, fx.RUN_TIME,
        _inspection(spark, folder), business_only=("app",), pattern=fx.BUSINESS_PATTERN,
    )
    return _samples(*samples)


# --- features and prediction --------------------------------------------------------------


def _model_input(spark, folder):
    """Transactions as they come in for prediction; some texts carry the test marker."""
    rows = fx.with_account_type(fx.transactions(spark, folder)).drop("category")
    marked = F.when(
        F.col("transaction_id") % 37 == 5, F.concat(F.lit(TEST_DESCRIPTION_PREFIX), F.lit("Revenue"))
    ).otherwise(F.col("description"))
    return rows.withColumn("description", marked)


_INPUT_SQL = f"""model_input AS MATERIALIZED (SELECT * EXCLUDE (category) REPLACE (
  CASE WHEN transaction_id % 37 = 5 THEN '{TEST_DESCRIPTION_PREFIX}Revenue' ELSE description END
  AS description, amount::FLOAT::DOUBLE AS amount),
  CASE WHEN account_id % 2 = 1 THEN 'SAVINGS_ACCOUNT' ELSE 'CURRENT_ACCOUNT' END AS account_type
  FROM fx_transactions)"""

_SME_TEXT = "description || ' ' || coalesce(bank_counterparty_name, '')"


def _features_sql(text: str, buckets: str) -> str:
    return f"""{_INPUT_SQL},
cleaned AS MATERIALIZED (SELECT *, {text} AS full_text, {sql_clean_model(text)} AS c
  FROM model_input),
tokens AS MATERIALIZED (SELECT *, {sql_tokens('c')} AS t FROM cleaned),
grams AS MATERIALIZED (SELECT *, {sql_ngrams('t')} AS g FROM tokens),
featured AS MATERIALIZED (SELECT *, {sql_buckets('g', 'size')} AS b
  FROM grams, (SELECT {buckets} AS size))"""


@query("pipe_features", with_shapes("fx_transactions", f"""
WITH {_features_sql(_SME_TEXT, '600000')}
SELECT transaction_id, c AS cleaned_description, array_to_string(b, ',') AS buckets,
  round((amount - (SELECT min(amount) FROM fx_transactions))
    / ((SELECT max(amount) FROM fx_transactions) - (SELECT min(amount) FROM fx_transactions)), 6)
    AS scaled_amount, (transaction_type = 'debit')::INT::DOUBLE AS is_debit,
  (internal_transaction <> '')::INT::DOUBLE AS is_internal,
  CASE WHEN starts_with(full_text, '{TEST_DESCRIPTION_PREFIX}')
    AND regexp_matches(substr(full_text, {len(TEST_DESCRIPTION_PREFIX) + 1}), '^[a-zA-Z ]+\\z')
    THEN trim(substr(full_text, {len(TEST_DESCRIPTION_PREFIX) + 1})) ELSE '' END AS test_category,
  account_type, counter_account_type, bank_specific__mcc, bank_specific__paylabels
FROM featured"""))
def pipe_features(spark, folder):
    rows = _model_input(spark, folder)
    made = features.features(rows, SME, features.limits_of(rows))
    numeric = F.col("preprocessed_numeric_features")
    return made.select(
        "transaction_id", "cleaned_description",
        F.array_join(F.col("preprocessed_description").cast("array<string>"), ",").alias("buckets"),
        F.round(F.get(numeric, F.lit(0)), 6).alias("scaled_amount"),
        F.get(numeric, F.lit(1)).alias("is_debit"), F.get(numeric, F.lit(2)).alias("is_internal"),
        "test_category", "account_type", "counter_account_type", "bank_specific__mcc",
        "bank_specific__paylabels",
    )


def _label_vectors(spark, folder, n: int):
    """One unit vector per trainable category: the mean of every n-th embedding."""
    rows = fx.table(spark, folder, "embeddings").withColumn("index", F.col("vec_id") % n)
    return embedding.label_centroids(rows, "index", "embedding", DIMENSIONS)


def _model(spark, folder, config):
    size = vocabulary(spark, folder)
    sized = config.with_values(hash_buckets=size, embedding_size=DIMENSIONS)
    model = embedding.EmbeddingModel(
        token_vectors(spark, folder), _label_vectors(spark, folder, len(config.trainable))
    )
    return sized, lambda df: model.score(df, ["transaction_id"], sized)


def _scored_sql(text: str, n: int) -> str:
    """Similarity of the mean token vector with every label vector."""
    return f"""{_features_sql(text, '(SELECT count(*) FROM embeddings)')},
flat AS MATERIALIZED (SELECT transaction_id, unnest(b) AS bucket FROM featured),
summed AS MATERIALIZED (SELECT transaction_id, p.pos, sum(embedding[p.pos + 1]::DOUBLE) AS value
  FROM flat JOIN embeddings ON vec_id = bucket, (SELECT unnest(range({DIMENSIONS})) AS pos) p
  WHERE bucket <> 0 GROUP BY ALL),
means AS MATERIALIZED (SELECT transaction_id, list(value ORDER BY pos) AS v FROM summed
  GROUP BY transaction_id),
label_means AS (SELECT vec_id % {n} AS label, p.pos, avg(embedding[p.pos + 1]::DOUBLE) AS value
  FROM embeddings, (SELECT unnest(range({DIMENSIONS})) AS pos) p GROUP BY ALL),
label_lists AS MATERIALIZED (SELECT label, list(value ORDER BY pos) AS v FROM label_means
  GROUP BY label),
sims AS MATERIALIZED (SELECT transaction_id, list(list_cosine_similarity(m.v, l.v)
  ORDER BY label) AS scores FROM means m, label_lists l GROUP BY transaction_id),
predicted_input AS MATERIALIZED (SELECT f.* EXCLUDE (t, g, b, c, size), coalesce(scores,
  list_transform(range({n}), lambda z: 0.0)) AS scores
  FROM featured f LEFT JOIN sims s ON s.transaction_id = f.transaction_id)"""


def _retail_prediction_sql() -> str:
    chain = retail_chain_sql(retail_begin("predicted_input"))
    return (
        f"WITH {_scored_sql('description', len(RETAIL.trainable))}, "
        + chain.sql("SELECT transaction_id, category_name AS category, category_source "
                    "FROM {src}")[5:]
    )


@query("pipe_predict_retail", with_shapes("fx_transactions", _retail_prediction_sql()))
def pipe_predict_retail(spark, folder):
    rows = _model_input(spark, folder)
    config, scorer = _model(spark, folder, RETAIL)
    predicted = predict.predict_retail(
        rows, config, features.limits_of(rows), scorer, mcc_table(spark, folder)
    )
    return predicted.select("transaction_id", "category", "category_source")


def _sme_prediction_sql() -> str:
    prefix = len(TEST_DESCRIPTION_PREFIX)
    marker = f"""CASE WHEN starts_with(full_text, '{TEST_DESCRIPTION_PREFIX}')
      AND regexp_matches(substr(full_text, {prefix + 1}), '^[a-zA-Z ]+\\z')
      THEN trim(substr(full_text, {prefix + 1})) ELSE '' END"""
    start = sme_begin("predicted_input", marker)
    # The shape fixture empties some texts; a prediction reads them as they are.
    start.ctes[0] = start.ctes[0].replace(
        "CASE WHEN transaction_id % 19 = 0 THEN '' ELSE", "CASE WHEN false THEN '' ELSE"
    )
    chain = sme_chain_sql(start).then(
        f"SELECT *, {TAX_COLUMNS_SQL}, {IBAN_SQL} FROM {{src}}"
    )
    chain.replace(country_code=COUNTRY_SQL)
    chain.replace(
        category_name=f"CASE WHEN {TAXED_SQL} THEN {tax_category_sql()} ELSE category_name END",
        category_source=f"CASE WHEN {TAXED_SQL} THEN 'ModelPrediction' ELSE category_source END",
    )
    interest = "regexp_matches(lower(description), '^interest paid after tax .* deducted')"
    chain.replace(
        category_name=f"CASE WHEN {interest} THEN 'Other Income' ELSE category_name END",
        category_source=f"CASE WHEN {interest} THEN 'ModelPrediction' ELSE category_source END",
    )
    chain.replace(category_name="CASE WHEN transaction_id % 23 = 0 "
                  "THEN 'Vehicles and Driving Expenses' ELSE category_name END")
    return (
        f"WITH {_scored_sql(_SME_TEXT, len(SME.trainable))}, "
        + chain.sql("SELECT transaction_id, coalesce(category_name, '<null>') AS category, "
                    "category_source, country_code FROM {src}")[5:]
    )


@query("pipe_predict_sme", with_shapes("fx_transactions", _sme_prediction_sql()))
def pipe_predict_sme(spark, folder):
    rows = with_iban(with_tax_columns(_model_input(spark, folder)))
    rows = rows.withColumn(
        "counterparty_name", F.when(F.col("transaction_id") % 23 == 0, "Shell")
    )
    config, scorer = _model(spark, folder, SME)
    predicted = predict.predict_sme(rows, config, features.limits_of(rows), scorer)
    return predicted.select(
        "transaction_id", F.coalesce("category", F.lit("<null>")).alias("category"),
        "category_source", "country_code",
    )


@query("pipe_evaluate", f"""
WITH {EVALUATED_SQL}, {REPORT_SQL}
SELECT metric, category, round(value, 6) AS value FROM (
  SELECT category, unnest(['precision', 'recall', 'f1_score', 'support']) AS metric,
    unnest([precision, recall, f1_score, support]) AS value FROM full_report
  UNION ALL SELECT '', 'mean_reciprocal_rank', {MRR_SQL}
  UNION ALL SELECT '', 'coverage', {COVERAGE_SQL}
  UNION ALL SELECT '', 'recall_at_' || k, recall FROM ({RECALL_SQL}))""")
def pipe_evaluate(spark, folder):
    results = evaluate.evaluate(evaluated(spark, folder), RETAIL)
    return results.withColumn("value", F.round("value", 6))


# The second word of a part's name decides the label.
NOUNS = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
LEAST_RIGHT = 0.99


@query("fit_text_classifier", with_shapes("fx_transactions", f"""
WITH named AS (SELECT list_position({text_list(NOUNS)}, string_split(description, ' ')[2]) - 1 AS label
  FROM fx_transactions)
SELECT label::INT AS label, count(*) AS n_rows, {len(RETAIL.trainable)} AS n_scores,
  true AS sums_to_one, true AS mostly_right FROM named WHERE label >= 0 GROUP BY ALL"""))
def fit_text_classifier(spark, folder):
    """Train on labels that the texts decide; LEAST_RIGHT of the rows of each must be right."""
    from tallymark.operators import classifier
    from tallymark.staging import stage

    rows = fx.with_account_type(fx.transactions(spark, folder)).drop("category")
    noun = F.array_position(
        F.array(*[F.lit(n) for n in NOUNS]), F.get(F.split("description", " "), F.lit(1))
    )
    label = F.when(noun > 0, noun - 1).cast("int")
    rows = rows.withColumn("target_category_int", label)
    names = F.array(*[F.lit(c) for c in RETAIL.categories])
    rows = rows.withColumn("target_category", F.get(names, F.col("target_category_int")))
    made = features.features(rows, RETAIL, features.limits_of(rows)).select(
        "date", "target_category", "target_category_int", "cleaned_description", "preprocessed_numeric_features"
    )
    made = stage(made, "features")
    train = made.where(F.col("date") < F.lit("2000-01-01").cast("date"))
    model = classifier.fit(train, RETAIL, penalty=1e-5)
    scored = classifier.score(model, made.where("target_category_int is not null"), RETAIL)
    total = F.aggregate("scores", F.lit(0.0), lambda a, x: a + x)
    right = F.array_position("scores", F.array_max("scores")) - 1 == F.col("target_category_int")
    return scored.groupBy(F.col("target_category_int").alias("label")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.size("scores")).alias("n_scores"),
        F.bool_and(F.abs(total - 1) < 1e-6).alias("sums_to_one"),
        (F.avg(right.cast("double")) >= LEAST_RIGHT).alias("mostly_right"),
    )
