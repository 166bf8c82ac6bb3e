"""Queries on set operations, latest feedback, aggregations, samples and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark.catalog import shapes as fx
from tallymark.catalog.q_tables import BUSINESS_SQL
from tallymark.catalog.registry import query
from tallymark.catalog.sql import quote, sql_folded, sql_hash, text_list, with_shapes
from tallymark.config import RETAIL
from tallymark.functions import scores as S
from tallymark.operators import feedback, filters, metrics, sampling

def _null():
    return F.lit("<null>")


_NAMES = text_list(RETAIL.categories)


def _shown(column: str):
    return F.coalesce(column, _null()).alias(column)


_ROWS = "user_id, account_id, transaction_id, date::VARCHAR AS date, pending"
_FEEDBACK_ROWS = f"{_ROWS}, feedback_time, coalesce(category, '<null>') AS category"
_UNION = """SELECT user_id, account_id, transaction_id, date, pending, feedback_time, category
FROM fx_feedback UNION ALL SELECT user_id, account_id, transaction_id, date, pending,
feedback_time, category FROM fx_feedback WHERE src = 0"""


def _feedback_rows(df):
    return df.withColumns(
        {"date": F.date_format("date", "yyyy-MM-dd"), "category": F.coalesce("category", _null())}
    )


@query("union_feedback", with_shapes("fx_feedback", f"SELECT {_FEEDBACK_ROWS} FROM ({_UNION})"))
def union_feedback(spark, folder):
    return _feedback_rows(feedback.union_feedback(fx.feedback_sources(spark, folder)))


@query("agg_dedup_rows", with_shapes("fx_feedback", f"""
SELECT DISTINCT {_FEEDBACK_ROWS} FROM ({_UNION})"""))
def agg_dedup_rows(spark, folder):
    sources = fx.feedback_sources(spark, folder)
    return _feedback_rows(feedback.dedup(feedback.union_feedback(sources)))


@query("win_latest_feedback", with_shapes("fx_latest", f"""
SELECT {_ROWS}, feedback_time::VARCHAR AS feedback_time, coalesce(target_category, '<null>')
  AS target_category FROM fx_latest"""))
def win_latest_feedback(spark, folder):
    latest = feedback.latest_feedback(fx.feedback_sources(spark, folder))
    return latest.withColumns(
        {
            "date": F.date_format("date", "yyyy-MM-dd"),
            "feedback_time": F.col("feedback_time").cast("string"),
            "target_category": F.coalesce("target_category", _null()),
        }
    )


@query("union_domains", with_shapes("fx_transactions_short", """
SELECT transaction_id, CASE WHEN transaction_type = 'debit' THEN 'business' ELSE 'app' END AS domain
FROM fx_transactions_short"""))
def union_domains(spark, folder):
    from tallymark.plans.training import union_domains as union

    rows = fx.transactions(spark, folder, False)
    parts = {
        domain: rows.where(F.col("transaction_type") == kind).select("transaction_id")
        for domain, kind in (("business", "debit"), ("app", "credit"))
    }
    return union(parts)


@query("agg_distinct_keys", with_shapes("fx_transactions fx_users", f"""
WITH {BUSINESS_SQL} SELECT DISTINCT account_id FROM qualifying"""))
def agg_distinct_keys(spark, folder):
    _, accounts = filters.business_account_ids(
        fx.users(spark, folder), fx.transactions(spark, folder), fx.BUSINESS_PATTERN
    )
    return accounts


def _with_country(spark, folder, texts: bool = False):
    users = fx.users(spark, folder).select("user_id", "country_code", "client_id")
    rows = fx.transactions(spark, folder, texts).join(users, "user_id")
    domain = F.when(F.col("client_id").isin(list(fx.CLIENTS)), "app").otherwise("business")
    return rows.withColumn("domain", domain)


_COUNTRY_SQL = f"""SELECT t.*, country_code, CASE WHEN client_id IN
  {'(' + ', '.join(quote(c) for c in fx.CLIENTS) + ')'} THEN 'app' ELSE 'business' END AS domain
FROM fx_transactions_short t JOIN fx_users USING (user_id)"""


@query("agg_rows_per_country", with_shapes("fx_transactions_short fx_users", f"""
SELECT domain, country_code, count(*) AS n_rows FROM ({_COUNTRY_SQL}) GROUP BY ALL"""))
def agg_rows_per_country(spark, folder):
    return metrics.rows_per_country(_with_country(spark, folder))


@query("agg_label_distribution", with_shapes("fx_feedback", """
SELECT category, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM fx_feedback WHERE category IS NOT NULL GROUP BY category"""))
def agg_label_distribution(spark, folder):
    shares = metrics.label_distribution(fx.feedback(spark, folder))
    return shares.withColumn("share", F.round("share", 6))


@query("agg_text_length_hist", with_shapes("fx_transactions", """
SELECT e.edge, round(count(t.transaction_id) / (SELECT count(*) FROM fx_transactions), 6) AS share
FROM (SELECT unnest(range(10, 260, 10)) AS edge) e LEFT JOIN fx_transactions t
  ON length(t.description) >= e.edge - 10
  AND (length(t.description) < e.edge OR e.edge = 250 AND length(t.description) = 250)
GROUP BY e.edge"""))
def agg_text_length_hist(spark, folder):
    shares = metrics.text_length_histogram(fx.transactions(spark, folder))
    return shares.withColumn("share", F.round("share", 6))


@query("agg_amount_range", with_shapes("fx_transactions_short", """
SELECT min(amount) AS min_amount, max(amount) AS max_amount FROM fx_transactions_short"""))
def agg_amount_range(spark, folder):
    from tallymark.operators.features import amount_range

    return amount_range(fx.transactions(spark, folder, False))


# --- samples and splits -------------------------------------------------------------------

_ID = "user_id, account_id, transaction_id"


@query("smp_capped", with_shapes("fx_transactions_short", f"""
SELECT {_ID} FROM fx_transactions_short ORDER BY {sql_hash(123)} LIMIT {fx.PRODUCTION}"""))
def smp_capped(spark, folder):
    rows = fx.transactions(spark, folder, False)
    return sampling.capped(rows, fx.PRODUCTION).select("user_id", "account_id", "transaction_id")


_INDEXED = (
    f"coalesce(list_position({_NAMES}, category) - 1, -1) AS category_index"
)


@query("smp_per_country", with_shapes("fx_transactions_short fx_users", f"""
SELECT {_ID}, country_code, coalesce(list_position({_NAMES}, category) - 1, -1) AS category_index
FROM (SELECT *, row_number() OVER (PARTITION BY country_code ORDER BY {sql_hash(123)}) AS n
  FROM ({_COUNTRY_SQL}) WHERE date >= DATE '{fx.START}' AND country_code <> 'DE')
WHERE n <= {fx.PER_COUNTRY}"""))
def smp_per_country(spark, folder):
    rows = _with_country(spark, folder).withColumn("target_category", F.col("category"))
    sample = sampling.training_sample(rows, fx.RETAIL_TEST)
    return sample.select(
        "user_id", "account_id", "transaction_id", "country_code",
        F.coalesce("target_category_int", F.lit(-1)).alias("category_index"),
    )


@query("smp_production", with_shapes("fx_transactions_short", f"""
SELECT {_ID}, {_INDEXED} FROM (SELECT * FROM fx_transactions_short
  WHERE date BETWEEN DATE '1998-01-01' AND DATE '2000-12-31'
  ORDER BY {sql_hash(123)} LIMIT {fx.PRODUCTION})"""))
def smp_production(spark, folder):
    rows = fx.transactions(spark, folder, False).withColumn("target_category", F.col("category"))
    sample = sampling.production_sample(rows, fx.RETAIL_TEST, "1998-01-01", "2000-12-31")
    return sample.select(
        "user_id", "account_id", "transaction_id",
        F.coalesce("target_category_int", F.lit(-1)).alias("category_index"),
    )


def _labelled(spark, folder):
    """Transactions with domain and a label index; some labels are missing."""
    key = F.col("transaction_id")
    label = F.when(key % 41 != 0, (key * key % 31).cast("int"))
    return _with_country(spark, folder).withColumn("target_category_int", label)


_LABELLED_SQL = f"""SELECT *, CASE WHEN transaction_id % 41 <> 0
  THEN transaction_id * transaction_id % 31 END AS label FROM ({_COUNTRY_SQL})"""


@query("win_stratified_split", with_shapes("fx_transactions_short fx_users", f"""
WITH rows_in AS ({_LABELLED_SQL}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY domain, label ORDER BY {sql_hash(42)}) AS n,
  count(*) OVER (PARTITION BY domain, label) AS size FROM rows_in),
tested AS (SELECT *, CASE WHEN size >= 2 THEN greatest(floor(size * 0.1::DOUBLE), 1)
  ELSE floor(size * 0.1::DOUBLE) END AS n_test FROM ranked),
held AS (SELECT *, CASE WHEN size - n_test >= 2
  THEN greatest(floor((size - n_test) * 0.1::DOUBLE), 1)
  ELSE floor((size - n_test) * 0.1::DOUBLE) END AS n_val FROM tested)
SELECT domain, transaction_id, coalesce(label, -1) AS label, CASE WHEN n <= n_test THEN 'test'
  WHEN n <= n_test + n_val THEN 'validation' ELSE 'train' END AS split FROM held"""))
def win_stratified_split(spark, folder):
    split = sampling.stratified_split(_labelled(spark, folder))
    label = F.coalesce("target_category_int", F.lit(-1)).alias("label")
    return split.select("domain", "transaction_id", label, "split")


# Rows per domain: fewer than any domain has for one, and a share that rounds for the other.
TEST_ROWS, VALIDATION_ROWS = 251, 97


def _counts_sql(rows: str, source: str, n: int, name: str) -> str:
    """Quotas of the strata: their share of the domain's rows, the largest remainders rounded up."""
    return f"""{name}_share AS (SELECT *, least({n}, sum({rows}) OVER w) AS wanted,
  CASE WHEN sum({rows}) OVER w = 0 THEN 0 ELSE {rows} * least({n}, sum({rows}) OVER w)::DOUBLE
    / sum({rows}) OVER w END AS part FROM {source} WINDOW w AS (PARTITION BY domain)),
{name}_quota AS MATERIALIZED (SELECT * EXCLUDE (part, wanted), floor(part) + (row_number() OVER (
    PARTITION BY domain ORDER BY part - floor(part) DESC, label ASC NULLS LAST)
  <= wanted - sum(floor(part)) OVER (PARTITION BY domain))::INT AS n_{name} FROM {name}_share)"""


@query("win_stratified_split_counts", with_shapes("fx_transactions_short fx_users", f"""
WITH rows_in AS MATERIALIZED ({_LABELLED_SQL}),
strata AS (SELECT domain, label, count(*) AS n_rows FROM rows_in GROUP BY ALL),
{_counts_sql('n_rows', 'strata', TEST_ROWS, 'test')},
rest AS (SELECT *, n_rows - n_test AS n_rest FROM test_quota),
{_counts_sql('n_rest', 'rest', VALIDATION_ROWS, 'val')},
ranked AS (SELECT *, row_number() OVER (PARTITION BY domain, label ORDER BY {sql_hash(42)}) AS n
  FROM rows_in)
SELECT r.domain, transaction_id, coalesce(r.label, -1) AS label, CASE WHEN n <= n_test THEN 'test'
  WHEN n <= n_test + n_val THEN 'validation' ELSE 'train' END AS split
FROM ranked r JOIN val_quota q ON q.domain = r.domain AND q.label IS NOT DISTINCT FROM r.label"""))
def win_stratified_split_counts(spark, folder):
    split = sampling.stratified_split(_labelled(spark, folder), TEST_ROWS, VALIDATION_ROWS)
    label = F.coalesce("target_category_int", F.lit(-1)).alias("label")
    return split.select("domain", "transaction_id", label, "split")


# --- top-k and metrics --------------------------------------------------------------------


def evaluated(spark, folder):
    """Scored transactions with a true label, right about half of the time, sometimes missing.

    Scores are the model's thirty plus a zero for the excluded category.
    """
    key = F.col("transaction_id")
    rows = fx.scored(spark, folder, RETAIL, texts=False)
    rows = rows.withColumn("scores", S.add_uncategorized(F.col("scores"), RETAIL))
    rows = rows.withColumn("category", S.argmax_category(F.col("scores"), RETAIL.categories))
    index = F.when(key % 41 == 0, F.lit(None)).when(
        key % 2 == 0, S.argmax_index(F.col("scores"))
    ).otherwise((key % 31).cast("int"))
    rows = rows.withColumn("target_category_int", index)
    return rows.withColumn(
        "target_category", S.category_at(F.col("target_category_int"), RETAIL.categories)
    )


EVALUATED_SQL = f"""
scored AS MATERIALIZED (SELECT o_orderkey AS transaction_id,
  list_concat({sql_folded(30, '2.0')}, [0.0]) AS scores
  FROM (SELECT o_orderkey, o_orderkey % (SELECT count(*) FROM embeddings) AS vector_key FROM orders)
  JOIN embeddings ON vec_id = vector_key),
labelled AS MATERIALIZED (SELECT *, list_position(scores, list_max(scores)) - 1 AS best,
  CASE WHEN transaction_id % 41 = 0 THEN NULL WHEN transaction_id % 2 = 0
  THEN list_position(scores, list_max(scores)) - 1 ELSE transaction_id % 31 END AS truth
  FROM scored),
evaluated AS MATERIALIZED (SELECT *, ({_NAMES})[best + 1] AS category,
  ({_NAMES})[truth + 1] AS target_category FROM labelled)"""


@query("topk_categories", f"""
WITH {EVALUATED_SQL}
SELECT transaction_id, (SELECT string_agg(name, '|' ORDER BY s DESC, i) FROM (
    SELECT ({_NAMES})[i] AS name, s, i FROM (SELECT unnest(scores) AS s,
      generate_subscripts(scores, 1) AS i) ORDER BY s DESC, i LIMIT 3)) AS best
FROM evaluated""")
def topk_categories(spark, folder):
    best = S.top_k(F.col("scores"), RETAIL.categories, 3)
    return evaluated(spark, folder).select("transaction_id", F.array_join(best, "|").alias("best"))


@query("argmax_category", f"WITH {EVALUATED_SQL} SELECT transaction_id, category FROM evaluated")
def argmax_category(spark, folder):
    return evaluated(spark, folder).select("transaction_id", "category")


@query("agg_confusion", f"""
WITH {EVALUATED_SQL} SELECT coalesce(target_category, '<null>') AS "true", category AS predicted,
  count(*) AS n FROM evaluated GROUP BY ALL""")
def agg_confusion(spark, folder):
    return metrics.confusion(evaluated(spark, folder)).withColumn("true", F.coalesce("true", _null()))


REPORT_SQL = f"""
names AS (SELECT unnest({_NAMES}) AS category),
counted AS (SELECT n.category,
  (SELECT count(*) FROM evaluated e WHERE e.category = n.category
    AND target_category = n.category) AS hits,
  (SELECT count(*) FROM evaluated e WHERE e.category = n.category) AS guessed,
  (SELECT count(*) FROM evaluated e WHERE target_category = n.category) AS support FROM names n),
rated AS (SELECT category, support, CASE WHEN guessed = 0 THEN 0 ELSE hits / guessed END AS p,
  CASE WHEN support = 0 THEN 0 ELSE hits / support END AS r FROM counted),
report AS (SELECT category, p AS precision, r AS recall,
  CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f1_score, support FROM rated),
full_report AS (SELECT * FROM report
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM report
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
    sum(recall * support) / sum(support), sum(f1_score * support) / sum(support), sum(support)
  FROM report)"""


@query("agg_classification_report", f"""
WITH {EVALUATED_SQL}, {REPORT_SQL}
SELECT category, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1_score, 6) AS f1_score, support::BIGINT AS support FROM full_report""")
def agg_classification_report(spark, folder):
    report = metrics.classification_report(evaluated(spark, folder), RETAIL)
    return report.withColumns(
        {m: F.round(m, 6) for m in ("precision", "recall", "f1_score")}
    )


COVERAGE_SQL = """(SELECT 1 - count(*) FILTER (target_category = 'General')
  / count(*) FILTER (target_category IS NOT NULL) FROM evaluated)"""


@query("agg_coverage", f"WITH {EVALUATED_SQL} SELECT round({COVERAGE_SQL}, 6) AS coverage")
def agg_coverage(spark, folder):
    return metrics.coverage(evaluated(spark, folder), RETAIL).select(
        F.round("coverage", 6).alias("coverage")
    )


MRR_SQL = """(SELECT avg(1 / len(list_filter(scores, lambda s: s >= scores[truth + 1])))
  FROM evaluated WHERE truth IS NOT NULL)"""


@query("agg_mrr", f"WITH {EVALUATED_SQL} SELECT round({MRR_SQL}, 6) AS mean_reciprocal_rank")
def agg_mrr(spark, folder):
    rows = evaluated(spark, folder).where(F.col("target_category_int").isNotNull())
    return metrics.mean_reciprocal_rank(rows).select(
        F.round("mean_reciprocal_rank", 6).alias("mean_reciprocal_rank")
    )


RECALL_SQL = """SELECT k, avg((place <= k)::INT) AS recall FROM (
  SELECT 1 + len(list_filter(list_transform(scores, lambda s, i: s > scores[truth + 1]
    OR s = scores[truth + 1] AND i < truth + 1), lambda b: b)) AS place
  FROM evaluated WHERE truth IS NOT NULL), (VALUES (1), (2), (3)) v(k) GROUP BY k"""


@query("agg_recall_at_k", f"WITH {EVALUATED_SQL} SELECT k, round(recall, 6) AS recall "
       f"FROM ({RECALL_SQL})")
def agg_recall_at_k(spark, folder):
    rows = evaluated(spark, folder).where(F.col("target_category_int").isNotNull())
    return metrics.recall_at_k(rows, RETAIL).withColumn("recall", F.round("recall", 6))


@query("agg_missing_labels", with_shapes("fx_feedback", f"""
SELECT unnest({_NAMES}) AS category EXCEPT SELECT category FROM fx_feedback"""))
def agg_missing_labels(spark, folder):
    return metrics.missing_labels(fx.feedback(spark, folder), RETAIL, "category")


def golden_rows(spark, folder):
    """Evaluated rows of savings payments as golden samples, numbered by transaction."""
    rows = evaluated(spark, folder).where(F.col("counter_account_type") == "SAVINGS_ACCOUNT")
    return rows.select(
        F.col("transaction_id").alias("sample"), "target_category",
        F.col("category").alias("predicted_category"),
    )


GOLDEN_SQL = """golden AS (SELECT transaction_id AS sample, target_category,
  category AS predicted_category FROM evaluated WHERE transaction_id % 17 = 0)"""


@query("agg_golden_failures", f"""
WITH {EVALUATED_SQL}, {GOLDEN_SQL}
SELECT sample, predicted_category AS predicted, coalesce(target_category, '<null>') AS expected
FROM golden WHERE predicted_category IS DISTINCT FROM target_category""")
def agg_golden_failures(spark, folder):
    failures = metrics.golden_failures(golden_rows(spark, folder))
    return failures.withColumn("expected", F.coalesce("expected", _null()))


VERDICT_SQL = f"""
SELECT golden_passed, metrics_passed, coverage_passed,
  golden_passed AND metrics_passed AND coverage_passed AS is_performant
FROM (SELECT (SELECT count(*) = 0 FROM golden WHERE predicted_category IS DISTINCT FROM
    target_category) AS golden_passed,
  (SELECT precision >= 0.6 AND recall >= 0.6 AND f1_score >= 0.6 FROM full_report
    WHERE category = 'weighted avg') AS metrics_passed,
  {COVERAGE_SQL} >= 0.8 AS coverage_passed)"""


@query("agg_quality_gate", f"WITH {EVALUATED_SQL}, {REPORT_SQL}, {GOLDEN_SQL} {VERDICT_SQL}")
def agg_quality_gate(spark, folder):
    from tallymark.plans.evaluate import release_verdict

    return release_verdict(evaluated(spark, folder), golden_rows(spark, folder), RETAIL)
