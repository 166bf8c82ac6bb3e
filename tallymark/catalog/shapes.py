"""The test tables in the shapes the operators expect (Spark side).

Every table is used whole: orders are the transactions, documents supply their long texts, and
other tables are reached through keys that cover all of their rows.
"""

from __future__ import annotations

import copy

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.config import RETAIL, SME
from tallymark.operators.rules import load_pack
from tallymark.staging import stage

CLIENTS = ("BUILDING", "HOUSEHOLD", "MACHINERY")
TEST_SITE = "test-site"
START = "1997-01-01"
WINDOW = ("1999-01-01", "1999-03-01")
RUN_TIME = "2024-02-01 10:30"
PER_COUNTRY = 200
PRODUCTION = 150
BUSINESS_PATTERN = r"red.*\bring\b|\bbolt\b|gizmo|cold.?rod"

RETAIL_TEST = RETAIL.for_deployment({"app": CLIENTS}, TEST_SITE).with_values(
    start_date=START, samples_per_country=PER_COUNTRY, production_samples=PRODUCTION
)
SME_TEST = SME.for_deployment(
    {"app": CLIENTS, "business": ("AUTOMOBILE", "FURNITURE")}, TEST_SITE
).with_values(start_date=START, samples_per_country=PER_COUNTRY, production_samples=PRODUCTION)

# Patterns over the words of the test tables, added to the shipped packs.
_EXTRA = {
    "business": {
        "Investments": {"+": [r"\banvil\b"], "band": [r"\bplate\b"]},
        "Vehicles and Driving Expenses": {"+": [r"\brod\b"], "-": [r"\bold rod\b"]},
        "Travel Expenses": {"+": [r"\bring\b"], "-": [r"\bblue ring\b"]},
        "Utilities": {"+": [r"\bcold\b"], "-": [r"\bcold (ring|rod)\b"]},
        "Food and Drinks": {"+": [r"\bhot plate\b", "ionth"]},
        "Rent and Facilities": {"band": [r"\blarge\b"]},
        "Other Operating Costs": {
            "+": [r"\bbolt\b", r"\bgizmo\b"], "-": [r"\bsmall gizmo\b"],
            "cpty+": [r"digits$"], "cpty-": ["supplier"],
        },
        "Marketing and Promotion": {"+": [r"\bred\b"], "-": [r"\bred (bolt|rod|ring)\b"]},
        "Other Expenses": {"+": [r"\bwidget\b"], "-": [r"\b(new|old) widget\b"]},
        "Equity Financing": {"+": [r"\bold\b"], "-": [r"\bold (bolt|ring)\b"]},
        "Revenue": {"+": [r"\b(bolt|ring|plate|rod)\b"], "-": [r"\bnew (bolt|plate)\b"]},
        "Other Income": {"+": [r"\bsmall\b", "repeating chars"]},
    },
    "app": {
        "Vehicles and Driving Expenses": {"+": [r"\bnew rod\b"]},
        "Travel Expenses": {"+": [r"\bring\b"]},
        "Utilities": {"+": [r"\bcold\b"], "-": [r"\bcold plate\b"]},
        "Food and Drinks": {"+": [r"\bhot\b"], "-": [r"\bhot (rod|ring)\b"]},
        "Other Operating Costs": {"+": [r"\bgizmo\b", r"\bbolt\b"]},
        "Marketing and Promotion": {"+": [r"\bred\b"], "-": [r"\bred plate\b"]},
        "Other Expenses": {"+": [r"\bwidget\b"]},
        "Equity Financing": {"+": [r"\bblue\b"]},
        "Revenue": {"+": [r"\b(anvil|ring|rod)\b"]},
        "Other Income": {"+": [r"\bsmall\b"]},
    },
}


def pack(name: str) -> dict:
    """A shipped pack with the extra patterns."""
    merged = copy.deepcopy(load_pack(name))
    for category, extra in _EXTRA[name].items():
        rule = merged[category]
        rule["description"]["+"] += extra.get("+", [])
        rule["description"]["-"] += extra.get("-", [])
        rule["counterparty"]["+"] += extra.get("cpty+", [])
        rule["counterparty"]["-"] += extra.get("cpty-", [])
        if "band" in extra:
            rule["amount_based"][0]["description"] += extra["band"]
    return merged


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once."""
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _choose(number: Column, values: list) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    return F.get(options, (number % len(values)).cast("int"))


def _rows(df: DataFrame) -> Column:
    """Row count as a subquery, so that keys can cover a whole table."""
    return df.agg(F.count(F.lit(1))).scalar()


def users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        _choose(F.col("c_nationkey"), ["GB", "FR", "IT", "NL", "DE"]).alias("country_code"),
        F.col("c_mktsegment").alias("client_id"),
    )


def test_users(spark: SparkSession, folder: str) -> DataFrame:
    """Every thirteenth customer is a test user."""
    return users(spark, folder).where(F.col("user_id") % 13 == 0).select("user_id")


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    second = F.col("k") == 1
    return (
        table(spark, folder, "customer")
        .withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
        .select(
            (key * 10 + F.col("k")).alias("account_id"),
            key.alias("user_id"),
            F.when(second & (F.col("c_acctbal") < 2000), "Y").alias("deleted"),
            F.when(second, "SAVINGS_ACCOUNT").otherwise("CURRENT_ACCOUNT").alias("account_type"),
            F.when(key % 50 == 0, F.lit(None))
            .when(key % 50 == 1, F.lit(TEST_SITE))
            .otherwise("site-a")
            .alias("site_id"),
        )
    )


def transactions(spark: SparkSession, folder: str, texts: bool = True) -> DataFrame:
    """Orders as bank transactions; `texts` appends the whole document of the same number."""
    orders = table(spark, folder, "orders")
    part, supplier = table(spark, folder, "part"), table(spark, folder, "supplier")
    key = F.col("o_orderkey")
    # Columns, as a join key with a subquery fails where its side is broadcast at run time.
    orders = orders.withColumns({"_part": key % _rows(part), "_supplier": key % _rows(supplier)})
    joined = orders.join(part, F.col("p_partkey") == F.col("_part")).join(
        supplier, F.col("s_suppkey") == F.col("_supplier")
    )
    text, no_document = F.col("p_name"), F.lit(True)
    if texts:
        documents = table(spark, folder, "documents")
        joined = joined.join(documents, F.col("doc_id") == key, "left")
        text, no_document = F.concat_ws(" ", "p_name", "text"), F.col("text").isNull()
    return joined.select(
        F.col("o_custkey").alias("user_id"),
        (F.col("o_custkey") * 10 + (key % 4 == 3).cast("int")).alias("account_id"),
        key.alias("transaction_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.when(F.col("o_orderstatus") == "P", 2).otherwise(1).alias("pending"),
        F.when(F.col("o_orderstatus") == "F", "credit").otherwise("debit").alias("transaction_type"),
        F.col("o_totalprice").alias("amount"),
        F.when((key % 19 == 0) & no_document, "?? 12 !!").otherwise(text).alias("description"),
        F.when(key % 7 != 0, F.col("s_name")).alias("bank_counterparty_name"),
        F.when(key % 11 == 0, F.concat(F.lit("id_"), key)).otherwise("").alias(
            "internal_transaction"
        ),
        F.when(key % 29 == 0, "[!RO]").when(key % 29 == 1, "[!ES],[!XG]").when(
            key % 29 == 2, "[!DC]"
        ).otherwise("").alias("bank_specific__paylabels"),
        F.when(key % 3 == 0, "3000").when(key % 3 == 1, "0742").otherwise("").alias(
            "bank_specific__mcc"
        ),
        F.when(key % 17 == 0, "SAVINGS_ACCOUNT").otherwise("CURRENT_ACCOUNT").alias(
            "counter_account_type"
        ),
        F.when(key % 6 == 0, "Internal").when(key % 6 != 1, "Shopping").alias("category"),
    )


def with_account_type(df: DataFrame) -> DataFrame:
    """The account type as part of the account number (odd: savings)."""
    return df.withColumn(
        "account_type",
        F.when(F.col("account_id") % 2 == 1, "SAVINGS_ACCOUNT").otherwise("CURRENT_ACCOUNT"),
    )


def feedback(spark: SparkSession, folder: str) -> DataFrame:
    """Events as category feedback, three per labelled transaction, from four sources."""
    event = F.col("event_id")
    names = ["Groceries", "Transport", "Bills", "Savings", "General", "Eating out", "Rent"]
    category = F.when(F.col("event_type") == "error", "Unknown").when(
        F.col("event_type") == "view", F.lit(None)
    ).otherwise(_choose(event, names))
    facts = table(spark, folder, "events").select(
        F.floor(event / 3).alias("transaction_id"),
        F.when(event % 97 == 0, "n/a")
        .when(event % 5 == 0, "2024-01-15 12:00:00.000000")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .alias("feedback_time"),
        category.alias("category"),
        (event % 4).alias("src"),
    )
    keys = transactions(spark, folder, texts=False).select(
        "user_id", "account_id", "transaction_id", "date", "pending"
    )
    return keys.join(facts, "transaction_id")


def feedback_sources(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The four sources, each with its rows written twice by one of them.

    Events meet their transactions once, not once a source.
    """
    every = stage(feedback(spark, folder), "feedback")
    sources = [every.where(F.col("src") == i).drop("src") for i in range(4)]
    return sources + [sources[0]]


def scored(spark: SparkSession, folder: str, config, texts: bool = True) -> DataFrame:
    """Transactions with a model score vector made of the embeddings.

    Category c gets the sum of the dimensions c, c + n, c + 2n, ... of n categories.
    """
    embeddings = table(spark, folder, "embeddings")
    n = len(config.trainable)
    factor = 2.0 if config.name == "retail" else 3.0

    def folded(c: Column) -> Column:
        own = F.sequence(c, F.size("embedding") - 1, F.lit(n))
        total = F.aggregate(own, F.lit(0.0), lambda a, d: a + F.get("embedding", d).cast("double"))
        return F.when(c < F.size("embedding"), total * factor).when(F.col("embedding").isNotNull(), 0.0)

    places = F.sequence(F.lit(0), F.lit(n - 1))
    vectors = embeddings.select("vec_id", F.transform(places, folded).alias("scores"))
    rows = with_account_type(transactions(spark, folder, texts))
    rows = rows.withColumn("_vector", F.col("transaction_id") % _rows(embeddings))
    return rows.join(vectors, F.col("vec_id") == F.col("_vector")).drop("vec_id", "_vector")


def patterns(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Parts as rule patterns: brand -> category, size -> direction, name -> pattern."""
    key = F.col("p_partkey")
    decorated = (
        F.when(key % 3 == 0, F.concat(F.lit(r"\b"), "p_name", F.lit(r"\b")))
        .when(key % 3 == 1, F.concat(F.lit("^"), "p_name", F.lit("$")))
        .otherwise(F.col("p_name"))
    )
    return table(spark, folder, "part").select(
        F.lit(name).alias("pack"),
        F.col("p_brand").alias("category"),
        F.when(F.col("p_size") % 2 == 0, "debit").otherwise("credit").alias("transaction_type"),
        F.when(F.col("p_size") % 3 == 0, "-").otherwise("+").alias("sign"),
        decorated.alias("pattern"),
    )
