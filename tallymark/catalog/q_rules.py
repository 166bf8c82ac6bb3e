"""Queries on rule matching and rule-pack checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark.catalog import shapes as fx
from tallymark.catalog.q_tables import BASE_SQL
from tallymark.catalog.registry import query
from tallymark.catalog.sql import (
    in_list,
    sql_clean_rules,
    sql_hits,
    sql_matches,
    sql_rule,
    with_shapes,
)
from tallymark.operators import rules

_SHAPES = "fx_transactions fx_users fx_accounts"
_ALL = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _base(spark, folder, clients=_ALL):
    return rules.tagging_base(
        fx.users(spark, folder), fx.accounts(spark, folder), fx.transactions(spark, folder), clients
    )


def base_sql(clients=_ALL, source: str = "fx_transactions", name: str = "base") -> str:
    """Tagging base with cleaned texts."""
    return f"""{name} AS MATERIALIZED (SELECT * REPLACE (
  {sql_clean_rules('description')} AS description,
  {sql_clean_rules('bank_counterparty_name')} AS bank_counterparty_name)
FROM ({BASE_SQL.format(transactions=source, clients=in_list(clients))}))"""


_WORDS = [r"\bgizmo\b", "ring$", "(tion|the) (in|of)", r"^cold"]
_PACK = fx.pack("business")


@query("rule_match_words", with_shapes(_SHAPES, f"""
WITH {base_sql()} SELECT transaction_id, {sql_matches('description', _WORDS)} AS hit,
  false AS hit_nothing FROM base"""))
def rule_match_words(spark, folder):
    return _base(spark, folder).select(
        "transaction_id", rules.matches_any("description", _WORDS).alias("hit"),
        rules.matches_any("description", []).alias("hit_nothing"),
    )


_BAND = {"min": 150000, "max": 300000, "description": [r"\blarge\b"], "counterparty": ["^supplier"]}


@query("rule_match_amount", with_shapes(_SHAPES, f"""
WITH {base_sql()} SELECT transaction_id, amount >= 150000 AND amount <= 300000
  AND ({sql_matches('description', _BAND['description'])}
    OR {sql_matches('bank_counterparty_name', _BAND['counterparty'])}) AS hit FROM base"""))
def rule_match_amount(spark, folder):
    return _base(spark, folder).select("transaction_id", rules.matches_band(_BAND).alias("hit"))


_RULE = _PACK["Other Operating Costs"]


@query("rule_match_category", with_shapes(_SHAPES, f"""
WITH {base_sql()} SELECT transaction_id, ({sql_rule(_RULE)}) AS hit FROM base"""))
def rule_match_category(spark, folder):
    hit = rules.matches_rule(_RULE)
    return _base(spark, folder).select("transaction_id", hit.alias("hit"))


@query("union_rule_hits", with_shapes(_SHAPES, f"""
WITH {base_sql()} SELECT * REPLACE (date::VARCHAR AS date) FROM ({sql_hits(_PACK, 'base')})"""))
def union_rule_hits(spark, folder):
    found = rules.hits(_base(spark, folder), _PACK)
    return found.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


_LABEL_CLIENTS = fx.SME_TEST.clients["business"]


def labels_sql(pack, clients, base: str = "base") -> str:
    return f"SELECT *, '{fx.RUN_TIME}' AS feedback_time FROM ({sql_hits(pack, base)})"


@query("rule_tag_all", with_shapes(_SHAPES, f"""
WITH {base_sql(_LABEL_CLIENTS)}
SELECT * REPLACE (date::VARCHAR AS date) FROM ({labels_sql(_PACK, _LABEL_CLIENTS)})"""))
def rule_tag_all(spark, folder):
    labels = rules.generate_labels(
        fx.users(spark, folder), fx.accounts(spark, folder), fx.transactions(spark, folder),
        _PACK, _LABEL_CLIENTS, fx.RUN_TIME,
    )
    return labels.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("rule_hits_per_category", with_shapes(_SHAPES, f"""
WITH {base_sql()}, labels AS MATERIALIZED ({sql_hits(_PACK, 'base')})
SELECT category, count(*) AS hits, count(*) FILTER (EXISTS (SELECT 1 FROM labels o
  WHERE o.transaction_id = l.transaction_id AND o.category <> l.category)) AS multi_hits
FROM labels l GROUP BY category"""))
def rule_hits_per_category(spark, folder):
    return rules.hits_per_category(_base(spark, folder), _PACK)


# --- rule-pack checks, on parts read as patterns ------------------------------------------


def _patterns_sql(pack: str) -> str:
    return f"""SELECT DISTINCT '{pack}' AS pack, p_brand AS category,
  CASE WHEN p_size % 2 = 0 THEN 'debit' ELSE 'credit' END AS transaction_type,
  CASE WHEN p_size % 3 = 0 THEN '-' ELSE '+' END AS sign, p_name AS bare FROM part"""


@query("rule_conflicts_polarity", f"""
WITH p AS ({_patterns_sql('parts')})
SELECT DISTINCT pack, category, bare FROM p WHERE sign = '+' AND (category, bare) IN
  (SELECT category, bare FROM p WHERE sign = '-')""")
def rule_conflicts_polarity(spark, folder):
    return rules.polarity_conflicts(fx.patterns(spark, folder, "parts"))


@query("rule_conflicts_within", f"""
WITH p AS ({_patterns_sql('parts')})
SELECT a.pack, a.transaction_type, a.category AS category_a, b.category AS category_b, a.bare
FROM p a, p b WHERE a.sign = '+' AND b.sign = '+' AND a.bare = b.bare
  AND a.transaction_type = b.transaction_type AND a.category < b.category""")
def rule_conflicts_within(spark, folder):
    return rules.conflicts_within(fx.patterns(spark, folder, "parts"))


@query("rule_conflicts_across", f"""
WITH p AS ({_patterns_sql('a')}),
q AS (SELECT DISTINCT c_mktsegment AS category, CASE WHEN c_nationkey % 2 = 0 THEN 'debit'
  ELSE 'credit' END AS transaction_type, (SELECT min(p_name) FROM part WHERE p_size = c_nationkey)
  AS bare FROM customer)
SELECT p.transaction_type, p.category AS category_a, q.category AS category_b, p.bare
FROM p, q WHERE p.sign = '+' AND p.bare = q.bare AND p.transaction_type = q.transaction_type
  AND p.category <> q.category""")
def rule_conflicts_across(spark, folder):
    """Parts as one pack; customer segments, with the first part name of a size, as the other."""
    names = fx.table(spark, folder, "part").groupBy("p_size").agg(F.min("p_name").alias("name"))
    customers = fx.table(spark, folder, "customer")
    segments = customers.join(names, F.col("p_size") == F.col("c_nationkey"), "inner").select(
        F.lit("b").alias("pack"), F.col("c_mktsegment").alias("category"),
        F.when(F.col("c_nationkey") % 2 == 0, "debit").otherwise("credit").alias("transaction_type"),
        F.lit("+").alias("sign"), F.concat(F.lit(r"\b"), "name", F.lit("$")).alias("pattern"),
    )
    return rules.conflicts_across(fx.patterns(spark, folder, "a"), segments)
