"""The same shapes as DuckDB common table expressions, and helpers to write statements on them."""

from __future__ import annotations

from tallymark.catalog.shapes import TEST_SITE
from tallymark.config import RETAIL, SME


def text_list(values) -> str:
    return "[" + ", ".join(quote(v) for v in values) + "]"


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(quote(v) for v in values) + ")"


_TRANSACTIONS = """
SELECT o_custkey AS user_id, o_custkey * 10 + (o_orderkey % 4 = 3)::INT AS account_id,
  o_orderkey AS transaction_id, o_orderdate::DATE AS date,
  CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS pending,
  CASE WHEN o_orderstatus = 'F' THEN 'credit' ELSE 'debit' END AS transaction_type,
  o_totalprice AS amount,
  CASE WHEN o_orderkey % 19 = 0 AND {blank} THEN '?? 12 !!' ELSE {text} END AS description,
  CASE WHEN o_orderkey % 7 <> 0 THEN s_name END AS bank_counterparty_name,
  CASE WHEN o_orderkey % 11 = 0 THEN 'id_' || o_orderkey ELSE '' END AS internal_transaction,
  CASE o_orderkey % 29 WHEN 0 THEN '[!RO]' WHEN 1 THEN '[!ES],[!XG]' WHEN 2 THEN '[!DC]'
    ELSE '' END AS bank_specific__paylabels,
  CASE o_orderkey % 3 WHEN 0 THEN '3000' WHEN 1 THEN '0742' ELSE '' END AS bank_specific__mcc,
  CASE WHEN o_orderkey % 17 = 0 THEN 'SAVINGS_ACCOUNT' ELSE 'CURRENT_ACCOUNT' END
    AS counter_account_type,
  CASE o_orderkey % 6 WHEN 0 THEN 'Internal' WHEN 1 THEN NULL ELSE 'Shopping' END AS category
FROM (SELECT *, o_orderkey % (SELECT count(*) FROM part) AS part_key,
    o_orderkey % (SELECT count(*) FROM supplier) AS supplier_key FROM orders)
JOIN part ON p_partkey = part_key
JOIN supplier ON s_suppkey = supplier_key
{documents}
"""

def sql_folded(n: int, factor: str) -> str:
    """Scores of n categories: dimensions c, c + n, c + 2n, ... of the embedding added up."""
    return (
        f"list_transform(range({n}), lambda c: list_reduce(list_transform("
        f"range(c, len(embedding)::BIGINT, {n}), lambda d: embedding[d + 1]::DOUBLE), "
        f"lambda a, b: a + b) * {factor})"
    )


_SCORED = """
SELECT t.* EXCLUDE (vector_key), CASE WHEN account_id % 2 = 1 THEN 'SAVINGS_ACCOUNT' ELSE 'CURRENT_ACCOUNT' END
    AS account_type,
  {folded} AS scores
FROM (SELECT *, transaction_id % (SELECT count(*) FROM embeddings) AS vector_key FROM fx_transactions) t
JOIN embeddings ON vec_id = vector_key
"""

_SHAPES: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_users": ((), """
SELECT c_custkey AS user_id, (['GB','FR','IT','NL','DE'])[c_nationkey % 5 + 1] AS country_code,
  c_mktsegment AS client_id FROM customer"""),
    "fx_test_users": (("fx_users",), "SELECT user_id FROM fx_users WHERE user_id % 13 = 0"),
    "fx_accounts": ((), f"""
SELECT c_custkey * 10 + k AS account_id, c_custkey AS user_id,
  CASE WHEN k = 1 AND c_acctbal < 2000 THEN 'Y' END AS deleted,
  CASE WHEN k = 1 THEN 'SAVINGS_ACCOUNT' ELSE 'CURRENT_ACCOUNT' END AS account_type,
  CASE c_custkey % 50 WHEN 0 THEN NULL WHEN 1 THEN '{TEST_SITE}' ELSE 'site-a' END AS site_id
FROM customer, (VALUES (0), (1)) v(k)"""),
    "fx_transactions": ((), _TRANSACTIONS.format(
        text="concat_ws(' ', p_name, text)", blank="text IS NULL",
        documents="LEFT JOIN documents ON doc_id = o_orderkey")),
    "fx_transactions_short": ((), _TRANSACTIONS.format(text="p_name", blank="true", documents="")),
    "fx_feedback": (("fx_transactions_short",), """
SELECT t.user_id, t.account_id, t.transaction_id, t.date, t.pending,
  CASE WHEN event_id % 97 = 0 THEN 'n/a'
    WHEN event_id % 5 = 0 THEN '2024-01-15 12:00:00.000000'
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS feedback_time,
  CASE event_type WHEN 'error' THEN 'Unknown' WHEN 'view' THEN NULL
    ELSE (['Groceries','Transport','Bills','Savings','General','Eating out','Rent'])
      [event_id % 7 + 1] END AS category,
  event_id % 4 AS src
FROM events JOIN fx_transactions_short t ON t.transaction_id = event_id // 3"""),
    "fx_scored_retail": (("fx_transactions",),
                         _SCORED.format(folded=sql_folded(len(RETAIL.trainable), "2.0"))),
    "fx_scored_sme": (("fx_transactions",), _SCORED.format(folded=sql_folded(len(SME.trainable), "3.0"))),
    "fx_read": (("fx_feedback",), """
SELECT * REPLACE (try_cast(feedback_time AS TIMESTAMP) AS feedback_time)
FROM fx_feedback WHERE try_cast(feedback_time AS TIMESTAMP) IS NOT NULL"""),
    # Latest readable feedback per transaction; at equal times the first category by name.
    "fx_latest": (("fx_read",), """
SELECT user_id, account_id, transaction_id, date, pending, feedback_time,
  category AS target_category
FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id, account_id, transaction_id, date, pending
    ORDER BY feedback_time DESC, category ASC NULLS LAST) AS n FROM fx_read)
WHERE n = 1"""),
}


def with_shapes(names: str, body: str) -> str:
    """`body` behind the shapes it names and the shapes those need."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in _SHAPES[name][0]:
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        need(name)
    ctes = [f"{n} AS MATERIALIZED ({_SHAPES[n][1]})" for n in ordered]
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join(ctes) + ", " + body[5:]
    return "WITH " + ", ".join(ctes) + " " + body


def sql_hash(seed: int, columns: str = "user_id, account_id, transaction_id, date, pending") -> str:
    return f"('0x' || substr(md5(concat_ws('|', '{seed}', {columns})), 1, 15))::BIGINT"


def sql_clean_rules(column: str) -> str:
    """Cleaning for the rule packs, step by step."""
    text = f"lower(strip_accents(coalesce({column}, '')))"
    text = f"regexp_replace({text}, '([0-9])+', ' digits ', 'g')"
    text = f"regexp_replace({text}, '[^a-z ]', ' ', 'g')"
    letters = "|".join(f"{c}{{3,}}" for c in "abcdefghijklmnopqrstuvwxyz")
    text = f"regexp_replace({text}, '\\b({letters})\\b', ' repeating chars ', 'g')"
    return f"trim(regexp_replace({text}, ' +', ' ', 'g'))"


def sql_clean_model(column: str) -> str:
    folded = f"strip_accents(coalesce({column}, ''))"
    return f"trim(lower(regexp_replace({folded}, '[^a-zA-Z]+', ' ', 'g')))"


def sql_tokens(cleaned: str, limit: int = 30) -> str:
    words = f"string_split({cleaned}, ' ')"
    return (
        f"CASE WHEN {cleaned} = '' THEN []::VARCHAR[] WHEN len({words}) < {limit} THEN {words} "
        f"ELSE list_append({words}[1:{limit - 1}], array_to_string({words}[{limit}:], ' ')) END"
    )


def sql_ngrams(tokens: str) -> str:
    return (
        f"list_concat({tokens}, list_transform(range(1, greatest(len({tokens}), 1)), "
        f"lambda i: {tokens}[i] || ' ' || {tokens}[i + 1]))"
    )


def sql_bucket(gram: str, buckets: str = "600000") -> str:
    return f"(('0x' || substr(md5({gram}), 1, 15))::BIGINT % {buckets})"


def sql_buckets(grams: str, buckets: str = "600000", length: int = 60) -> str:
    hashed = f"list_transform({grams}, lambda g: {sql_bucket('g', buckets)})"
    return f"list_concat({hashed}, list_transform(range({length}), lambda z: 0))[1:{length}]"


def sql_scores_text(column: str = "scores") -> str:
    return (
        f"array_to_string(list_transform({column}, lambda x: round(x * 1000000)::BIGINT), ',')"
    )


def sql_matches(column: str, patterns) -> str:
    return f"regexp_matches({column}, {quote('|'.join(patterns))})" if patterns else "false"


def sql_rule(rule: dict) -> str:
    """A rule as the definition reads: direction, any wanted hit, no barred hit."""
    wanted = [
        sql_matches("description", rule["description"]["+"]),
        sql_matches("bank_counterparty_name", rule["counterparty"]["+"]),
    ]
    for band in rule.get("amount_based", ()):
        text = (
            sql_matches("description", band["description"]) + " OR "
            + sql_matches("bank_counterparty_name", band["counterparty"])
        )
        low, high = band.get("min", "-1e308"), band.get("max", "1e308")
        wanted.append(f"(amount >= {low} AND amount <= {high} AND ({text}))")
    barred = [
        sql_matches("description", rule["description"]["-"]),
        sql_matches("bank_counterparty_name", rule["counterparty"]["-"]),
    ]
    return (
        f"transaction_type = '{rule['transaction_type']}' AND ({' OR '.join(wanted)}) "
        f"AND NOT ({' OR '.join(barred)})"
    )


def sql_hits(pack: dict, source: str) -> str:
    """One filtered scan per category."""
    return " UNION ALL ".join(
        f"SELECT user_id, account_id, transaction_id, date, pending, {quote(category)} AS category "
        f"FROM {source} WHERE {sql_rule(rule)}"
        for category, rule in pack.items()
    )


class Steps:
    """A statement built as a list of common table expressions, each reading the one before."""

    def __init__(self, source: str):
        self.ctes: list[str] = []
        self.current = source

    def then(self, select: str) -> "Steps":
        name = f"step{len(self.ctes)}"
        self.ctes.append(f"{name} AS MATERIALIZED ({select.format(src=self.current)})")
        self.current = name
        return self

    def add(self, **columns: str) -> "Steps":
        new = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
        return self.then("SELECT *, " + new.replace("{", "{{").replace("}", "}}") + " FROM {src}")

    def replace(self, **columns: str) -> "Steps":
        new = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
        return self.then(
            "SELECT * REPLACE (" + new.replace("{", "{{").replace("}", "}}") + ") FROM {src}"
        )

    def set_score(self, index, value, condition: str, closes: bool) -> "Steps":
        """Set one score where the row is open and the condition holds."""
        new = (
            f"CASE WHEN is_open AND ({condition}) THEN list_transform(scores, "
            f"lambda x, i: CASE WHEN i = ({index}) + 1 THEN {float(value)} ELSE x END) "
            "ELSE scores END"
        )
        changes = {"scores": new}
        if closes:
            changes["is_open"] = f"is_open AND NOT ({condition})"
        return self.replace(**changes)

    def sql(self, select: str) -> str:
        return "WITH " + ", ".join(self.ctes) + " " + select.format(src=self.current)
