"""Overrides applied after the scores: country, tax labels, taxed interest, counterparties.

The mappings are constants of the configuration, a few dozen entries, and so are broadcast.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.config import (
    COUNTERPARTY_CATEGORIES,
    CURRENT_ACCOUNT,
    MODEL_PREDICTION,
    TAX_LABELS,
)
from tallymark.functions.text import is_taxed_interest


def country_code() -> Column:
    """The given country, else the country of the counterparty's IBAN, else GB for a transfer with
    a current account, else ''."""
    given = F.nullif(F.col("country_code"), F.lit(""))
    by_iban = F.nullif(F.substring("bank_counterparty_iban", 1, 2), F.lit(""))
    by_account = F.when(F.col("counter_account_type") == CURRENT_ACCOUNT, F.lit("GB"))
    return F.coalesce(given, by_iban, by_account, F.lit(""))


def with_country(df: DataFrame) -> DataFrame:
    missing = [c for c in ("country_code", "bank_counterparty_iban") if c not in df.columns]
    df = df.withColumns({c: F.lit("") for c in missing}) if missing else df
    return df.withColumn("country_code", country_code())


def tax_table(spark: SparkSession) -> DataFrame:
    """(country, direction, label) -> category. Country '' merges all countries, GB winning."""
    merged: dict[tuple[str, str, str], str] = {}
    for (country, direction), labels in TAX_LABELS.items():
        for label, category in labels.items():
            merged[(country, direction, label)] = category
            merged[("", direction, label)] = category
    rows = [(*key, category) for key, category in merged.items()]
    schema = "country_code string, transaction_type string, tax_label string, tax_category string"
    return spark.createDataFrame(rows, schema)


def apply_tax_labels(df: DataFrame) -> DataFrame:
    """Where a tax label is present, the mapped category replaces the predicted one.

    A label outside the mapping gives a NULL category. Other countries keep their prediction.
    """
    if "tax_label" not in df.columns:
        return df
    countries = list(dict.fromkeys([*[c for c, _ in TAX_LABELS], ""]))
    directions = list(dict.fromkeys(d for _, d in TAX_LABELS))
    ruled = (
        F.col("tax_label").isNotNull()
        & F.col("country_code").isin(countries)
        & F.col("transaction_type").isin(directions)
    )
    keys = ["country_code", "transaction_type", "tax_label"]
    columns = df.columns
    return (
        df.join(F.broadcast(tax_table(df.sparkSession)), keys, "left")
        .withColumns(
            {
                "category": F.when(ruled, F.col("tax_category")).otherwise(F.col("category")),
                "category_source": F.when(ruled, F.lit(MODEL_PREDICTION)).otherwise(
                    F.col("category_source")
                ),
            }
        )
        .select(*columns)
    )


def apply_interest(df: DataFrame) -> DataFrame:
    taxed = is_taxed_interest(F.col("description"))
    return df.withColumns(
        {
            "category": F.when(taxed, F.lit("Other Income")).otherwise(F.col("category")),
            "category_source": F.when(taxed, F.lit(MODEL_PREDICTION)).otherwise(
                F.col("category_source")
            ),
        }
    )


def counterparty_table(
    spark: SparkSession, mapping: Mapping[str, str] = COUNTERPARTY_CATEGORIES
) -> DataFrame:
    schema = "counterparty_name string, counterparty_category string"
    return spark.createDataFrame(list(mapping.items()), schema)


def apply_counterparties(
    df: DataFrame, mapping: Mapping[str, str] = COUNTERPARTY_CATEGORIES
) -> DataFrame:
    """A known counterparty's category always wins; the source stays as it was."""
    if "counterparty_name" not in df.columns:
        return df
    columns = df.columns
    table = F.broadcast(counterparty_table(df.sparkSession, mapping))
    winner = F.coalesce("counterparty_category", "category")
    joined = df.join(table, "counterparty_name", "left")
    return joined.withColumn("category", winner).select(*columns)
