"""Queries on sources, sinks, filters, projections and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.catalog import shapes as fx
from tallymark.catalog.registry import query
from tallymark.catalog.sql import in_list, quote, text_list, with_shapes
from tallymark.config import IDENTITY, RETAIL, SME, SME_DEFAULTS
from tallymark.operators import features, feedback, filters, joins, overrides
from tallymark.sources import golden, layout, publication, sinks, tables
from tallymark.staging import new_folder

KEYS = "user_id, account_id, transaction_id"
_CLIENTS = in_list(fx.CLIENTS)


def _keys(df: DataFrame, *more) -> DataFrame:
    return df.select("user_id", "account_id", "transaction_id", *more)


def _day(column: str = "date"):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


_USER_FILE = T.StructType(
    [T.StructField("id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in ("country_code", "client_id")]
)


# --- sources and sinks --------------------------------------------------------------------


@query("src_select_rename", with_shapes("fx_users", "SELECT * FROM fx_users"))
def src_select_rename(spark, folder):
    path = new_folder(spark, "users")
    fx.users(spark, folder).withColumnRenamed("user_id", "id").withColumn(
        "unused", F.lit("x")
    ).write.parquet(path)
    configured = {"users": (_USER_FILE, {"id": "user_id"})}
    assert tables.read_table(spark, "accounts", {"users": path}, configured) is None
    return tables.read_table(spark, "users", {"users": path}, configured)


@query("src_formats", with_shapes("fx_users", """
SELECT f.format, u.user_id, u.country_code, u.client_id
FROM fx_users u, (VALUES ('csv'), ('json'), ('parquet')) f(format)"""))
def src_formats(spark, folder):
    rows = fx.users(spark, folder).withColumnRenamed("user_id", "id")
    root = new_folder(spark, "formats")
    rows.write.option("header", True).csv(f"{root}/users.csv")
    rows.write.json(f"{root}/users.json")
    rows.write.parquet(f"{root}/users")
    result = None
    for kind, path in (("csv", "users.csv"), ("json", "users.json"), ("parquet", "users")):
        read = tables.read_file(spark, f"{root}/{path}", _USER_FILE)
        read = tables.select_rename(read, _USER_FILE.fieldNames(), {"id": "user_id"})
        read = read.select(F.lit(kind).alias("format"), "*")
        result = read if result is None else result.unionByName(read)
    return result


@query("src_lineage", """
SELECT 'o_orderstatus=' || o_orderstatus AS folder, count(*) AS n_rows FROM orders GROUP BY 1""")
def src_lineage(spark, folder):
    path = new_folder(spark, "orders")
    fx.table(spark, folder, "orders").write.partitionBy("o_orderstatus").parquet(path)
    return tables.lineage(spark.read.parquet(path))


_MCC_NAMES = ["Travel", "Pets", "Expenses", "Not a category", "General"]


@query("src_mcc_lookup", f"""
SELECT lpad(p_partkey::VARCHAR, 6, '0') AS code, category, list_position({text_list(RETAIL.categories)},
  category) - 1 AS mcc_index
FROM (SELECT p_partkey, ({text_list(_MCC_NAMES)})[p_size % 5 + 1] AS category FROM part)
WHERE category <> 'Not a category'""")
def src_mcc_lookup(spark, folder):
    path = new_folder(spark, "mcc")
    names = F.array(*[F.lit(n) for n in _MCC_NAMES])
    fx.table(spark, folder, "part").select(
        F.lpad(F.col("p_partkey").cast("string"), 6, "0"), F.get(names, F.col("p_size") % 5)
    ).write.option("sep", ";").csv(path)
    return tables.read_mcc(spark, path, RETAIL)


@query("src_golden_samples", with_shapes("fx_transactions_short", """
SELECT 'test' AS user_id, 'test' AS account_id, 36 AS id_length, description, amount,
  coalesce(bank_counterparty_name, '') AS bank_counterparty_name, 'Savings' AS target_category
FROM fx_transactions_short"""))
def src_golden_samples(spark, folder):
    rows = fx.transactions(spark, folder, texts=False).withColumn("target_category", F.lit("Savings"))
    return golden.prepare(rows, SME).select(
        "user_id", "account_id", F.length("transaction_id").alias("id_length"), "description",
        "amount", "bank_counterparty_name", "target_category",
    )


@query("sink_partitioned", with_shapes("fx_users", f"""
SELECT user_id, country_code, CASE WHEN client_id IN {_CLIENTS} THEN 'app' ELSE 'business' END
  AS domain FROM fx_users"""))
def sink_partitioned(spark, folder):
    path = new_folder(spark, "partitioned")
    domain = F.when(F.col("client_id").isin(list(fx.CLIENTS)), "app").otherwise("business")
    rows = fx.users(spark, folder).select("user_id", "country_code", domain.alias("domain"))
    sinks.write_partitioned(rows, path)
    return spark.read.parquet(path)


_SIZES = f"""
SELECT 'users_size.' || CASE WHEN client_id IN {_CLIENTS} THEN 'app' ELSE 'business' END || '.'
  || country_code AS metric, count(*)::VARCHAR AS value FROM fx_users GROUP BY 1
UNION ALL SELECT * FROM (VALUES ('config.name', 'retail'),
  ('config.categories', {quote(','.join(RETAIL.categories))}), ('config.countries', 'GB,FR,IT,NL'),
  ('config.start_date', '{fx.START}'), ('config.threshold', '0.45'),
  ('config.samples_per_country', '{fx.PER_COUNTRY}'),
  ('config.production_samples', '{fx.PRODUCTION}'), ('run_time', '{fx.RUN_TIME}'))"""


@query("sink_run_metadata", with_shapes("fx_users", _SIZES))
def sink_run_metadata(spark, folder):
    domain = F.when(F.col("client_id").isin(list(fx.CLIENTS)), "app").otherwise("business")
    rows = fx.users(spark, folder).withColumn("domain", domain)
    path = new_folder(spark, "metadata")
    metadata = sinks.run_metadata({"users": rows}, fx.RETAIL_TEST, {"run_time": fx.RUN_TIME})
    sinks.write_metadata(metadata, path)
    return spark.read.schema("metric string, value string").json(path)


@query("sink_counted_write", with_shapes("fx_users", f"""
SELECT CASE WHEN client_id IN {_CLIENTS} THEN 'app' ELSE 'business' END AS domain, country_code,
  count(*) AS n_rows FROM fx_users WHERE country_code <> 'DE' GROUP BY ALL"""))
def sink_counted_write(spark, folder):
    """Rows per domain and country as the write itself observed them."""
    domain = F.when(F.col("client_id").isin(list(fx.CLIENTS)), "app").otherwise("business")
    rows = fx.users(spark, folder).withColumn("domain", domain).where("country_code <> 'DE'")
    config = RETAIL.with_values(domains=("app", "business"))
    counts = sinks.write_counted(rows, new_folder(spark, "counted"), config)
    return spark.createDataFrame(
        [(d, c, n) for (d, c), n in counts.items()], "domain string, country_code string, n_rows long"
    )


@query("sink_published", with_shapes("fx_users", f"""
SELECT user_id, country_code, domain, CASE domain WHEN 'app' THEN 2 ELSE 1 END AS run FROM (
  SELECT *, CASE WHEN client_id IN {_CLIENTS} THEN 'app' ELSE 'business' END AS domain FROM fx_users)
WHERE country_code <> 'DE' AND (domain = 'business' OR country_code <> 'FR')"""))
def sink_published(spark, folder):
    """A first run of two domains, a second that replaces one, a third that is broken off."""
    domain = F.when(F.col("client_id").isin(list(fx.CLIENTS)), "app").otherwise("business")
    rows = fx.users(spark, folder).withColumn("domain", domain).where("country_code <> 'DE'")
    rows = rows.select("user_id", "country_code", "domain")
    root = new_folder(spark, "published")
    both, app = RETAIL.with_values(domains=("app", "business")), RETAIL
    for number, (df, config) in enumerate([(rows, both), (rows.where("domain = 'app' and country_code <> 'FR'"), app)], 1):
        run = publication.Publication(spark, root)
        run.write("training", df.withColumn("run", F.lit(number)), config)
        run.publish()
    publication.Publication(spark, root).write("training", rows.withColumn("run", F.lit(3)), both)
    return publication.read(spark, root, "training")


_PAID_FILE = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("amount", T.DoubleType()), T.StructField("note", T.StringType()),
])


@query("src_set_aside", """
SELECT f.format, o_orderkey AS id, o_totalprice AS amount, (SELECT count(*) FROM orders WHERE o_orderkey % 5 = 0) AS n_value,
  (SELECT count(*) FROM orders WHERE o_orderkey % 5 = 1) AS n_broken
FROM orders, (VALUES ('csv'), ('json')) f(format) WHERE o_orderkey % 5 > 1""")
def src_set_aside(spark, folder):
    """Files of which each fifth row holds a word for a number, and each fifth is broken off."""
    key = F.col("o_orderkey")
    orders = fx.table(spark, folder, "orders").select(key.alias("id"), F.col("o_totalprice").alias("amount"))
    price = F.when(F.col("id") % 5 == 0, "many").otherwise(F.col("amount").cast("string"))
    broken = F.col("id") % 5 == 1
    csv = F.when(broken, F.col("id").cast("string")).otherwise(F.concat_ws(",", F.col("id").cast("string"), price, F.lit("x")))
    value = F.when(F.col("id") % 5 == 0, '"many"').otherwise(F.col("amount").cast("string"))
    json = F.concat(F.lit('{"id": '), F.col("id"), F.lit(', "amount": '), value, F.when(broken, "").otherwise(', "note": "x"}'))
    root, result = new_folder(spark, "checked"), None
    for kind, line in (("csv", csv), ("json", json)):
        path = f"{root}/{kind}"
        if kind == "json":
            orders.select(line).write.text(path)
        else:  # whole lines as one column of that name, so each file has its header
            orders.select(line.alias("id,amount,note")).write.csv(path, sep="\t", header=True, quote="")
        good, bad = tables.read_checked(spark, path, _PAID_FILE, kind)
        counts = bad.groupBy("reason").count()

        def number(*reasons):
            return counts.where(F.col("reason").isin(*reasons)).agg(F.sum("count")).scalar()

        part = good.select(
            F.lit(kind).alias("format"), "id", "amount", number("value").alias("n_value"),
            number("fields", "syntax").alias("n_broken"),
        )
        result = part if result is None else result.unionByName(part)
    return result


# --- filters and projections --------------------------------------------------------------


@query("flt_start_date", with_shapes("fx_transactions_short", f"""
SELECT {KEYS} FROM fx_transactions_short WHERE date >= DATE '{fx.START}'"""))
def flt_start_date(spark, folder):
    return _keys(filters.from_start_date(fx.transactions(spark, folder, False), fx.START))


@query("flt_date_range", with_shapes("fx_transactions_short", f"""
SELECT {KEYS}, date::VARCHAR AS date FROM fx_transactions_short
WHERE date >= DATE '{fx.WINDOW[0]}' AND date <= DATE '{fx.WINDOW[1]}'"""))
def flt_date_range(spark, folder):
    rows = filters.in_date_range(fx.transactions(spark, folder, False), *fx.WINDOW)
    return _keys(rows, _day())


@query("flt_clients", with_shapes("fx_users", f"""
SELECT * FROM fx_users WHERE client_id IN {_CLIENTS}"""))
def flt_clients(spark, folder):
    return filters.of_clients(fx.users(spark, folder), fx.CLIENTS)


@query("flt_active_accounts", with_shapes("fx_accounts", """
SELECT account_id, user_id, account_type FROM fx_accounts WHERE deleted IS NULL"""))
def flt_active_accounts(spark, folder):
    rows = filters.active_accounts(fx.accounts(spark, folder))
    return rows.select("account_id", "user_id", "account_type")


@query("flt_relevant_accounts", with_shapes("fx_accounts", f"""
SELECT account_id, user_id, account_type, site_id FROM fx_accounts
WHERE deleted IS NULL AND NOT (site_id = '{fx.TEST_SITE}')"""))
def flt_relevant_accounts(spark, folder):
    rows = filters.relevant_accounts(fx.accounts(spark, folder), fx.TEST_SITE)
    return rows.select("account_id", "user_id", "account_type", "site_id")


FLAGGED_SQL = """
SELECT u.*, (t.user_id IS NOT NULL)::INT AS test_user
FROM fx_users u LEFT JOIN fx_test_users t ON t.user_id = u.user_id"""
COUNTRY_OK_SQL = "(country_code IN ('GB','FR','IT') AND test_user = 0 OR country_code = 'NL')"


@query("flt_country_testuser", with_shapes("fx_users fx_test_users", f"""
SELECT * FROM ({FLAGGED_SQL}) WHERE {COUNTRY_OK_SQL}"""))
def flt_country_testuser(spark, folder):
    flagged = joins.flag_test_users(fx.users(spark, folder), fx.test_users(spark, folder))
    return filters.eligible_country(flagged, fx.RETAIL_TEST)


BUSINESS_SQL = f"""
candidates AS (SELECT t.* REPLACE (lower(description) AS description) FROM fx_transactions t
  WHERE category <> 'Internal' AND EXISTS (SELECT 1 FROM fx_users u
    WHERE u.user_id = t.user_id AND country_code = 'GB')),
qualifying AS (SELECT account_id FROM candidates WHERE transaction_type = 'debit' AND amount > 30
  AND regexp_matches(description, {quote(fx.BUSINESS_PATTERN)}))"""


@query("flt_business_accounts", with_shapes("fx_transactions fx_users fx_accounts", f"""
WITH {BUSINESS_SQL}
SELECT 'transaction' AS kind, transaction_id AS id FROM candidates
  WHERE account_id IN (SELECT account_id FROM qualifying)
UNION ALL SELECT 'account', account_id FROM fx_accounts
  WHERE account_id IN (SELECT account_id FROM qualifying)
UNION ALL SELECT 'user', user_id FROM fx_users WHERE user_id IN (SELECT user_id FROM fx_accounts
  WHERE account_id IN (SELECT account_id FROM qualifying))"""))
def flt_business_accounts(spark, folder):
    users, accounts, transactions = filters.business_accounts(
        fx.users(spark, folder), fx.accounts(spark, folder), fx.transactions(spark, folder),
        pattern=fx.BUSINESS_PATTERN,
    )

    def ids(df, kind, column):
        return df.select(F.lit(kind).alias("kind"), F.col(column).alias("id"))

    return (
        ids(transactions, "transaction", "transaction_id")
        .unionByName(ids(accounts, "account", "account_id"))
        .unionByName(ids(users, "user", "user_id"))
    )


@query("flt_exclude_labels", with_shapes("fx_feedback", """
SELECT transaction_id, feedback_time, coalesce(category, '<null>') AS category FROM fx_feedback
WHERE category IS NULL OR category <> 'General'"""))
def flt_exclude_labels(spark, folder):
    rows = filters.without_excluded_labels(fx.feedback(spark, folder), RETAIL, "category")
    return rows.select(
        "transaction_id", "feedback_time", F.coalesce("category", F.lit("<null>")).alias("category")
    )


@query("prj_fill_defaults", with_shapes("fx_transactions_short", f"""
SELECT {KEYS}, amount::FLOAT::DOUBLE AS amount, coalesce(bank_counterparty_name, '')
  AS bank_counterparty_name, description FROM fx_transactions_short"""))
def prj_fill_defaults(spark, folder):
    rows = filters.fill_defaults(fx.transactions(spark, folder, False), SME)
    return _keys(rows, "amount", "bank_counterparty_name", "description")


@query("prj_missing_columns", with_shapes("fx_transactions_short", f"""
SELECT {KEYS}, 'CURRENT_ACCOUNT' AS account_type, '' AS bank_counterparty_iban,
  counter_account_type FROM fx_transactions_short"""))
def prj_missing_columns(spark, folder):
    wanted = ["account_type", "bank_counterparty_iban", "counter_account_type"]
    rows = filters.add_missing_columns(fx.transactions(spark, folder, False), SME_DEFAULTS, wanted)
    return _keys(rows, *wanted)


@query("prj_tag_constants", with_shapes("fx_transactions_short", f"""
SELECT {KEYS}, 'Revenue' AS label, '{fx.RUN_TIME}' AS feedback_time, 'business' AS domain
FROM fx_transactions_short"""))
def prj_tag_constants(spark, folder):
    rows = filters.tag(
        fx.transactions(spark, folder, False), label="Revenue", feedback_time=fx.RUN_TIME,
        domain="business",
    )
    return _keys(rows, "label", "feedback_time", "domain")


# --- joins --------------------------------------------------------------------------------


@query("join_users_accounts", with_shapes("fx_users fx_accounts", """
SELECT user_id, account_id, country_code, client_id, account_type
FROM fx_users JOIN fx_accounts USING (user_id)"""))
def join_users_accounts(spark, folder):
    joined = joins.users_with_accounts(fx.users(spark, folder), fx.accounts(spark, folder))
    return joined.select("user_id", "account_id", "country_code", "client_id", "account_type")


BASE_SQL = f"""
SELECT t.user_id, t.account_id, transaction_id, date, amount, pending, transaction_type,
  bank_counterparty_name, description, country_code, client_id, date AS year_month
FROM {{transactions}} t, fx_users u, fx_accounts a
WHERE u.client_id IN {{clients}} AND a.deleted IS NULL AND a.user_id = u.user_id
  AND t.user_id = a.user_id AND t.account_id = a.account_id"""


@query("join_base_tagging", with_shapes("fx_transactions_short fx_users fx_accounts", f"""
SELECT * REPLACE (date::VARCHAR AS date, year_month::VARCHAR AS year_month,
  coalesce(bank_counterparty_name, '<null>') AS bank_counterparty_name)
FROM ({BASE_SQL.format(transactions='fx_transactions_short', clients=_CLIENTS)})"""))
def join_base_tagging(spark, folder):
    base = joins.base_tagging(
        fx.users(spark, folder), fx.accounts(spark, folder), fx.transactions(spark, folder, False),
        fx.CLIENTS,
    )
    return base.withColumns(
        {
            "date": _day(), "year_month": _day("year_month"),
            "bank_counterparty_name": F.coalesce("bank_counterparty_name", F.lit("<null>")),
        }
    )


@query("join_left_flag", with_shapes("fx_users fx_test_users", f"""
SELECT * FROM ({FLAGGED_SQL}) WHERE {COUNTRY_OK_SQL} AND client_id IN {_CLIENTS}"""))
def join_left_flag(spark, folder):
    return joins.users_sample(
        fx.users(spark, folder), fx.test_users(spark, folder), fx.RETAIL_TEST, "app"
    )


@query("join_anti_test_users", with_shapes("fx_users fx_test_users", """
SELECT * FROM fx_users WHERE user_id NOT IN (SELECT user_id FROM fx_test_users)"""))
def join_anti_test_users(spark, folder):
    return joins.without_test_users(fx.users(spark, folder), fx.test_users(spark, folder))


def _inspection(spark, folder) -> DataFrame:
    """Transactions of large events form the inspection set."""
    return fx.feedback(spark, folder).where(F.col("category") == "Rent").select(
        *joins.INSPECTION_KEYS
    )


@query("join_anti_inspection", with_shapes("fx_transactions_short fx_feedback", f"""
WITH held AS MATERIALIZED (SELECT DISTINCT user_id, account_id, transaction_id FROM fx_feedback
  WHERE category = 'Rent'),
removed AS (SELECT count(*) AS held_out FROM fx_transactions_short
  SEMI JOIN held USING (user_id, account_id, transaction_id))
SELECT {KEYS}, held_out FROM (SELECT * FROM fx_transactions_short
  ANTI JOIN held USING (user_id, account_id, transaction_id)), removed"""))
def join_anti_inspection(spark, folder):
    rows = fx.transactions(spark, folder, False)
    held = joins.held_keys(_inspection(spark, folder))
    removed = joins.held_out_count(rows, held).scalar()
    return _keys(joins.hold_out(rows, held)).withColumn("held_out", removed)


@query("join_semi_accounts", with_shapes("fx_transactions_short fx_accounts", f"""
SELECT {KEYS} FROM fx_transactions_short WHERE account_id IN
  (SELECT account_id FROM fx_accounts WHERE deleted IS NULL AND account_type = 'SAVINGS_ACCOUNT')"""))
def join_semi_accounts(spark, folder):
    qualifying = filters.active_accounts(fx.accounts(spark, folder)).where(
        F.col("account_type") == "SAVINGS_ACCOUNT"
    )
    rows = fx.transactions(spark, folder, False)
    return _keys(joins.with_accounts_of(rows, qualifying.select("account_id")))


ELIGIBLE_SQL = f"""
users_ok AS (SELECT * FROM ({FLAGGED_SQL}) WHERE {COUNTRY_OK_SQL} AND client_id IN {{clients}}),
accounts_ok AS (SELECT * FROM fx_accounts WHERE deleted IS NULL AND site_id <> '{fx.TEST_SITE}')"""


@query("join_feedback_base", with_shapes("fx_latest fx_users fx_test_users fx_accounts", f"""
WITH {ELIGIBLE_SQL.format(clients=_CLIENTS)}
SELECT l.user_id, l.account_id, transaction_id, feedback_time::VARCHAR AS feedback_time,
  coalesce(target_category, '<null>') AS target_category, country_code, account_type
FROM fx_latest l JOIN users_ok u ON u.user_id = l.user_id
JOIN accounts_ok a ON a.user_id = l.user_id AND a.account_id = l.account_id"""))
def join_feedback_base(spark, folder):
    users = joins.users_sample(
        fx.users(spark, folder), fx.test_users(spark, folder), fx.RETAIL_TEST, "app"
    )
    accounts = filters.relevant_accounts(fx.accounts(spark, folder), fx.TEST_SITE)
    latest = feedback.latest_feedback(fx.feedback_sources(spark, folder))
    rows = joins.feedback_base(latest, users, accounts)
    return rows.select(
        "user_id", "account_id", "transaction_id",
        time_text("feedback_time"),
        F.coalesce("target_category", F.lit("<null>")).alias("target_category"),
        "country_code", "account_type",
    )


def time_text(column: str):
    """A timestamp as text without trailing zeros, as a plain cast prints it."""
    return F.col(column).cast("string").alias(column)


@query("join_txn_identity", with_shapes("fx_latest fx_transactions_short", """
SELECT t.user_id, t.account_id, t.transaction_id, t.date::VARCHAR AS date, t.pending, t.amount,
  coalesce(target_category, '<null>') AS target_category
FROM fx_latest l, fx_transactions_short t
WHERE t.user_id = l.user_id AND t.account_id = l.account_id AND t.date = l.date
  AND t.transaction_id = l.transaction_id AND t.pending = l.pending"""))
def join_txn_identity(spark, folder):
    latest = feedback.latest_feedback(fx.feedback_sources(spark, folder))
    rows = joins.with_transactions(latest, fx.transactions(spark, folder, False))
    return _keys(
        rows, _day(), "pending", "amount",
        F.coalesce("target_category", F.lit("<null>")).alias("target_category"),
    )


@query("join_identity_layout", with_shapes("fx_latest fx_transactions_short", """
SELECT t.user_id, t.account_id, t.transaction_id, t.date::VARCHAR AS date, t.pending, t.amount,
  coalesce(target_category, '<null>') AS target_category
FROM fx_latest l, fx_transactions_short t
WHERE t.user_id = l.user_id AND t.account_id = l.account_id AND t.date = l.date
  AND t.transaction_id = l.transaction_id AND t.pending = l.pending"""))
def join_identity_layout(spark, folder):
    """The feedback join on tables that lie by identity: newest label and join without a shuffle."""
    made = {
        "transactions": fx.transactions(spark, folder, False).select(*IDENTITY, "amount"),
        "feedback": feedback.union_feedback(fx.feedback_sources(spark, folder)),
    }
    lies, buckets = {}, layout.buckets_for(*made.values())
    for name, df in made.items():
        path = new_folder(spark, name)
        lies[name] = layout.write_by_identity(df, f"{name}_{path.rsplit('-', 1)[-1]}", path, buckets)
    latest = feedback.latest_feedback([lies["feedback"]])
    rows = joins.with_transactions(latest, lies["transactions"])
    return _keys(
        rows, _day(), "pending", "amount",
        F.coalesce("target_category", F.lit("<null>")).alias("target_category"),
    )


_LOOKUP = (("3000", "Travel"), ("0742", "Pets"))


def mcc_table(spark, folder):
    """Merchant codes that occur, with the category index; one code is left out on purpose."""
    codes = fx.transactions(spark, folder, False).select("bank_specific__mcc").distinct()
    index = F.when(F.col("bank_specific__mcc") == "3000", RETAIL.index("Travel")).otherwise(
        RETAIL.index("Pets")
    )
    known = codes.where(F.col("bank_specific__mcc") != "")
    return known.select(F.col("bank_specific__mcc").alias("code"), index.alias("mcc_index"))


MCC_SQL = (
    f"CASE bank_specific__mcc WHEN '3000' THEN {RETAIL.index('Travel')} "
    f"WHEN '0742' THEN {RETAIL.index('Pets')} ELSE -1 END"
)


# Codes of other forms than four digits.
_FORMS_SQL = """CASE WHEN transaction_id % 10 = 3 THEN '12345' WHEN transaction_id % 10 = 4 THEN 'A100'
  ELSE bank_specific__mcc END"""


@query("join_lookup_default", with_shapes("fx_transactions_short", f"""
WITH coded AS (SELECT transaction_id, {_FORMS_SQL} AS bank_specific__mcc FROM fx_transactions_short)
SELECT transaction_id, bank_specific__mcc, CASE bank_specific__mcc
  WHEN '12345' THEN {RETAIL.index('Bills')} WHEN 'A100' THEN {RETAIL.index('Groceries')}
  ELSE {MCC_SQL} END AS mcc_index FROM coded"""))
def join_lookup_default(spark, folder):
    key = F.col("transaction_id") % 10
    rows = fx.transactions(spark, folder, False).withColumn(
        "bank_specific__mcc",
        F.when(key == 3, "12345").when(key == 4, "A100").otherwise(F.col("bank_specific__mcc")),
    )
    others = rows.select(F.col("bank_specific__mcc").alias("code")).distinct().where(
        F.col("code").isin("12345", "A100")
    )
    index = F.when(F.col("code") == "12345", RETAIL.index("Bills")).otherwise(RETAIL.index("Groceries"))
    known = mcc_table(spark, folder).unionByName(others.withColumn("mcc_index", index))
    found = joins.lookup_index(
        rows, joins.merchant_codes(known), "bank_specific__mcc", "code", "mcc_index"
    )
    return found.select("transaction_id", "bank_specific__mcc", "mcc_index")


@query("join_counterparty_override", with_shapes("fx_transactions_short", """
SELECT transaction_id, CASE WHEN s IN (1, 2, 3) THEN 'Vehicles and Driving Expenses'
  WHEN s = 4 THEN 'Loans' ELSE coalesce(category, '<null>') END AS category, 'x' AS category_source
FROM (SELECT *, transaction_id % 6 AS s FROM fx_transactions_short)"""))
def join_counterparty_override(spark, folder):
    named = F.get(
        F.array(*[F.lit(n) for n in (
            None, "Shell", "Tango", "Lekker en GoedkoopTanken.nu", "TheLoanSharks Loans", "shell"
        )]),
        (F.col("transaction_id") % 6).cast("int"),
    )
    rows = fx.transactions(spark, folder, False).withColumns(
        {"counterparty_name": named, "category_source": F.lit("x")}
    )
    return overrides.apply_counterparties(rows).select(
        "transaction_id", F.coalesce("category", F.lit("<null>")).alias("category"),
        "category_source",
    )


TAX_LABEL_NAMES = [
    None, "VAT", "Omzetbelasting", "Toeslag", "Child_benefit", "Not a label", "Loonbelasting",
]
TAX_COUNTRIES = ["GB", "NL", "", "FR"]


def with_tax_columns(df: DataFrame) -> DataFrame:
    """A tax label and a country spread over the transactions."""
    key = F.col("transaction_id")
    labels = F.array(*[F.lit(n).cast("string") for n in TAX_LABEL_NAMES])
    countries = F.array(*[F.lit(n) for n in TAX_COUNTRIES])
    return df.withColumns(
        {
            "tax_label": F.get(labels, (key % len(TAX_LABEL_NAMES)).cast("int")),
            "country_code": F.get(countries, (key % len(TAX_COUNTRIES)).cast("int")),
        }
    )


TAX_COLUMNS_SQL = (
    "([NULL, " + ", ".join(quote(n) for n in TAX_LABEL_NAMES[1:])
    + f"])[transaction_id % {len(TAX_LABEL_NAMES)} + 1] AS tax_label, "
    f"({text_list(TAX_COUNTRIES)})[transaction_id % {len(TAX_COUNTRIES)} + 1] AS country_code"
)


def tax_category_sql() -> str:
    """The mapping as nested cases: the Dutch one, the British one, and both where unknown."""
    from tallymark.config import TAX_LABELS

    def labels(country: str, direction: str) -> str:
        pairs = TAX_LABELS[(country, direction)].items()
        return "CASE tax_label " + " ".join(
            f"WHEN {quote(k)} THEN {quote(v)}" for k, v in pairs
        ) + " END"

    parts = []
    for direction in ("credit", "debit"):
        gb, nl = labels("GB", direction), labels("NL", direction)
        parts.append(
            f"WHEN transaction_type = '{direction}' THEN CASE country_code WHEN 'GB' THEN {gb} "
            f"WHEN 'NL' THEN {nl} ELSE coalesce({gb}, {nl}) END"
        )
    return "CASE " + " ".join(parts) + " END"


TAXED_SQL = (
    "tax_label IS NOT NULL AND country_code IN ('GB', 'NL', '') "
    "AND transaction_type IN ('credit', 'debit')"
)


@query("join_tax_mapping", with_shapes("fx_transactions_short", f"""
SELECT transaction_id, coalesce(CASE WHEN {TAXED_SQL} THEN {tax_category_sql()} ELSE category END,
  '<null>') AS category, CASE WHEN {TAXED_SQL} THEN 'ModelPrediction' ELSE 'ModelFallback' END
  AS category_source
FROM (SELECT *, {TAX_COLUMNS_SQL} FROM fx_transactions_short)"""))
def join_tax_mapping(spark, folder):
    rows = with_tax_columns(fx.transactions(spark, folder, False))
    mapped = overrides.apply_tax_labels(rows.withColumn("category_source", F.lit("ModelFallback")))
    return mapped.select(
        "transaction_id", F.coalesce("category", F.lit("<null>")).alias("category"),
        "category_source",
    )


@query("map_category_index", with_shapes("fx_feedback", f"""
SELECT transaction_id, feedback_time, coalesce(category, '<null>') AS category,
  coalesce(list_position({text_list(RETAIL.categories)}, category) - 1, -1) AS category_index
FROM fx_feedback"""))
def map_category_index(spark, folder):
    rows = filters.map_category_index(fx.feedback(spark, folder), RETAIL, "category")
    return rows.select(
        "transaction_id", "feedback_time", F.coalesce("category", F.lit("<null>")).alias("category"),
        F.coalesce("target_category_int", F.lit(-1)).alias("category_index"),
    )


# --- scalar features that read the whole table --------------------------------------------


@query("num_scaled_amount", with_shapes("fx_transactions_short", """
SELECT transaction_id, round((amount - (SELECT min(amount) FROM fx_transactions_short))
  / ((SELECT max(amount) FROM fx_transactions_short)
   - (SELECT min(amount) FROM fx_transactions_short)), 6) AS scaled_amount
FROM fx_transactions_short"""))
def num_scaled_amount(spark, folder):
    rows = fx.transactions(spark, folder, False)
    scaled = features.scaled_amount(F.col("amount"), features.limits_of(rows))
    return rows.select("transaction_id", F.round(scaled, 6).alias("scaled_amount"))


@query("num_flags", with_shapes("fx_transactions_short", """
SELECT transaction_id, (transaction_type = 'debit')::INT::DOUBLE AS is_debit,
  (internal_transaction <> '')::INT::DOUBLE AS is_internal FROM fx_transactions_short"""))
def num_flags(spark, folder):
    return fx.transactions(spark, folder, False).select(
        "transaction_id", features.is_debit().alias("is_debit"),
        features.is_internal().alias("is_internal"),
    )


@query("num_feature_vector", with_shapes("fx_transactions_short", """
SELECT transaction_id, p.pos, round(CASE p.pos
  WHEN 0 THEN (amount - lo) / (hi - lo) WHEN 1 THEN (transaction_type = 'debit')::INT
  ELSE (internal_transaction <> '')::INT END, 6) AS value
FROM fx_transactions_short, (SELECT min(amount) AS lo, max(amount) AS hi FROM fx_transactions_short),
  (VALUES (0), (1), (2)) p(pos)"""))
def num_feature_vector(spark, folder):
    rows = fx.transactions(spark, folder, False)
    vector = features.numeric_features(features.limits_of(rows))
    exploded = rows.select("transaction_id", F.posexplode(vector).alias("pos", "value"))
    return exploded.withColumn("value", F.round("value", 6))
