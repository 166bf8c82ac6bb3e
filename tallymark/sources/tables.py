"""Table sources: configured files with explicit schemas."""

from __future__ import annotations

from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark import schemas
from tallymark.config import ModelConfig
from tallymark.operators.metrics import categories_table


def format_of(path: str) -> str:
    """csv or json by file suffix, also behind a glob; everything else is Parquet."""
    for suffix in ("csv", "json"):
        if path.rstrip("/").endswith("." + suffix):
            return suffix
    return "parquet"


def read_file(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str | None = None
) -> DataFrame:
    reader = spark.read.schema(schema)
    kind = file_format or format_of(path)
    if kind == "csv":
        reader = reader.option("header", True)
    return reader.format(kind).load(path)


RECORD = "_unread_record"


def read_checked(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of a file that fit the schema, and (file, record, reason, read) of those that do not.

    A row is bad if it has another number of fields than columns, is no JSON object, or holds a
    value that its column cannot take; reason is `fields`, `syntax` or `value`, and `read` holds what
    could be read, as JSON. Parquet has its own types, so no row of it is bad. Every column is parsed, whichever the reader of the rows wants:
    a bad value in an unused column counts as well, so the split is the same for every use.
    """
    kind = file_format or format_of(path)
    if kind == "parquet":
        none = spark.createDataFrame([], "file string, record string, reason string, read string")
        return read_file(spark, path, schema, kind), none
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
    whole = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    file = F.col("_metadata.file_path").alias("file")
    if kind == "csv":
        rows = (
            spark.read.schema(whole).options(**options).option("header", True).csv(path).select("*", file)
        )
        fields = F.size(F.split(RECORD, ",", -1)) != len(schema)
        quoted = F.col(RECORD).contains('"')
        reason = F.when(fields & ~quoted, "fields").otherwise("value")
    else:
        lines = spark.read.text(path).where(F.trim("value") != "")
        parsed = F.from_json("value", whole, options)
        rows = lines.select(F.inline(F.array(parsed)), "value", file)
        rows = rows.withColumn(RECORD, F.when(F.col(RECORD).isNotNull(), F.col("value"))).drop("value")
        is_object = F.get_json_object(RECORD, "$").startswith("{")
        reason = F.when(F.coalesce(is_object, F.lit(False)), "value").otherwise("syntax")
    # A scan parses only the columns that are asked for; this condition asks for all of them.
    every = [F.col(c).isNull() | F.col(c).isNotNull() for c in schema.fieldNames()]
    rows = rows.where(reduce(lambda a, b: a & b, every))
    bad = rows.where(F.col(RECORD).isNotNull()).select(
        "file", F.col(RECORD).alias("record"), reason.alias("reason"),
        F.to_json(F.struct(*schema.fieldNames())).alias("read"),
    )
    return rows.where(F.col(RECORD).isNull()).select(*schema.fieldNames()), bad


def select_rename(
    df: DataFrame, columns: Sequence[str], aliases: Mapping[str, str] | None = None
) -> DataFrame:
    aliases = aliases or {}
    return df.select(*[F.col(c).alias(aliases.get(c, c)) for c in columns])


# table -> (schema, aliases)
RETAIL_TABLES = {
    "users": (schemas.USERS, schemas.USER_ALIASES),
    "accounts": (schemas.ACCOUNTS, schemas.ACCOUNT_ALIASES),
    "test_users": (schemas.TEST_USERS, {}),
    "transactions": (schemas.TRANSACTIONS_RETAIL, {}),
    "historical_feedback": (schemas.FEEDBACK, {}),
    "user_single_feedback_created": (schemas.FEEDBACK_EVENTS, schemas.EVENT_ALIASES),
    "user_multiple_feedback_created": (schemas.FEEDBACK_EVENTS, schemas.EVENT_ALIASES),
    "user_multiple_feedback_applied": (schemas.FEEDBACK_EVENTS, schemas.EVENT_ALIASES),
}
FEEDBACK_TABLES = tuple(t for t in RETAIL_TABLES if "feedback" in t)

SME_TABLES = {
    f"{table}_{domain}": (schema, aliases)
    for domain in ("app", "business")
    for table, (schema, aliases) in {
        "users": (schemas.USERS, schemas.USER_ALIASES),
        "accounts": (schemas.ACCOUNTS, schemas.ACCOUNT_ALIASES),
        "test_users": (schemas.TEST_USERS, {}),
        "transactions": (schemas.TRANSACTIONS_SME, {}),
        "synthetic_feedback": (schemas.FEEDBACK, {}),
    }.items()
}


def read_table(
    spark: SparkSession,
    table: str,
    paths: Mapping[str, str],
    tables: Mapping[str, tuple[T.StructType, Mapping[str, str]]] = RETAIL_TABLES,
    set_aside: Callable[[str, DataFrame], None] | None = None,
) -> DataFrame | None:
    """The listed columns of a configured table, renamed; None when it has no path.

    With `set_aside`, rows that do not fit the schema are left out and handed to it with the table's
    name; without, their unreadable values are null.
    """
    if table not in paths:
        return None
    schema, aliases = tables[table]
    if set_aside is None:
        df = read_file(spark, paths[table], schema)
    else:
        df, bad = read_checked(spark, paths[table], schema)
        if format_of(paths[table]) != "parquet":
            set_aside(table, bad)
    return select_rename(df, schema.fieldNames(), aliases)


def lineage(df: DataFrame) -> DataFrame:
    """Folders the rows were read from, with row counts."""
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return df.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("n_rows"))


def read_mcc(spark: SparkSession, path: str, config: ModelConfig) -> DataFrame:
    """Merchant category codes (code;category, no header) with the category index.

    Codes stay text, as they have leading zeros. Categories the model does not know are dropped.
    """
    codes = spark.read.schema(schemas.MCC).option("sep", ";").csv(path)
    named = F.broadcast(categories_table(codes, config).withColumnRenamed("index", "mcc_index"))
    return codes.join(named, "category", "inner").select("code", "category", "mcc_index")
