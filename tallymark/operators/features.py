"""Model inputs: hashed n-grams, numeric features and pass-through columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.config import POSTPROCESSING_COLUMNS, ModelConfig
from tallymark.functions import fingerprint, text
from tallymark.operators import filters

_BUCKETS = {"md5": text.hash_buckets, "fingerprint": fingerprint.fingerprint_buckets}


def amount_range(df: DataFrame) -> DataFrame:
    """Smallest and largest amount; of the training split, before labels are excluded."""
    return df.agg(F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"))


def scaled_amount(amount: Column, limits: Column) -> Column:
    """(amount - min) / (max - min); NULL when all amounts are equal. `limits` is a struct."""
    low, high = limits["min_amount"], limits["max_amount"]
    return F.try_divide(amount - low, high - low)


def limits_of(df: DataFrame) -> Column:
    """`amount_range` of a table as a one-row subquery, usable in any projection."""
    return amount_range(df).select(F.struct("min_amount", "max_amount")).scalar()


def fixed_limits(low: float, high: float) -> Column:
    """Limits remembered from an earlier training run."""
    return F.struct(F.lit(low).alias("min_amount"), F.lit(high).alias("max_amount"))


def is_debit() -> Column:
    return (F.col("transaction_type") == "debit").cast("double")


def is_internal() -> Column:
    return (F.col("internal_transaction") != "").cast("double")


def numeric_features(limits: Column) -> Column:
    """[scaled_amount, is_debit, is_internal], in this order."""
    return F.array(scaled_amount(F.col("amount"), limits), is_debit(), is_internal())


def prepared(df: DataFrame, config: ModelConfig) -> DataFrame:
    """Input rows with every column the model reads, without NULLs in them."""
    needed = list(dict.fromkeys([*config.input_columns, *POSTPROCESSING_COLUMNS]))
    return filters.add_missing_columns(filters.fill_defaults(df, config), config.defaults, needed)


def features(df: DataFrame, config: ModelConfig, limits: Column) -> DataFrame:
    """Add cleaned_description, preprocessed_description, preprocessed_numeric_features and
    test_category."""
    rows = prepared(df, config)
    combined = text.model_text(config)
    rows = rows.withColumns(
        {
            "cleaned_description": text.clean_for_model(combined),
            "test_category": text.test_marker(combined),
            "preprocessed_numeric_features": numeric_features(limits),
        }
    )
    rows = rows.withColumn(
        "_tokens", text.tokenize(F.col("cleaned_description"), config.max_tokens)
    )
    buckets = _BUCKETS[config.bucket_hash](
        text.ngrams(F.col("_tokens")), config.hash_buckets, config.sequence_length
    )
    return rows.withColumn("preprocessed_description", buckets).drop("_tokens")
