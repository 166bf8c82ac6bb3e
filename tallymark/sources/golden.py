"""Golden samples: rows with a known category that must all be predicted right."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.config import TARGET, TEST_DESCRIPTION_PREFIX, ModelConfig


def prepare(df: DataFrame, config: ModelConfig) -> DataFrame:
    """Fill defaults, set a fixed user and account and give every row a fresh id."""
    filled = df.fillna({c: v for c, v in config.defaults.items() if c in df.columns})
    return filled.withColumns(
        {"user_id": F.lit("test"), "account_id": F.lit("test"), "transaction_id": F.uuid()}
    )


def from_rows(
    spark: SparkSession, rows: Sequence[Mapping[str, object]], config: ModelConfig
) -> DataFrame:
    """Golden samples from literal rows, numbered in the given order."""
    columns = list(dict.fromkeys(c for row in rows for c in row))
    types = ["double" if c == "amount" else "string" for c in columns]
    schema = ", ".join(["sample int", *[f"{c} {t}" for c, t in zip(columns, types)]])
    data = [
        (i, *[float(r[c]) if c == "amount" and c in r else r.get(c) for c in columns])
        for i, r in enumerate(rows, start=1)
    ]
    return prepare(spark.createDataFrame(data, schema), config)


def _row(category: str, description: str, direction: str, amount: float, **more) -> dict:
    return {
        "description": description, "transaction_type": direction, "amount": amount,
        TARGET: category, **more,
    }


# Samples decided by the business rules alone, so they hold for every trained model.
RETAIL_RULE_SAMPLES = (
    _row("General", "!!!", "debit", 12.5),
    _row("General", "", "debit", 3.0),
    _row("Internal", "to my rainy day pot", "debit", 75.0, account_type="SAVINGS_ACCOUNT"),
    _row("Internal", "interest for june", "credit", 1.2, account_type="SAVINGS_ACCOUNT"),
    _row("Savings", "monthly set aside", "debit", 40.0, counter_account_type="SAVINGS_ACCOUNT"),
    _row("Internal", "spare change", "debit", 0.4, bank_specific__paylabels="[!RO]"),
    _row("Savings", "jar", "credit", 9.0, bank_specific__paylabels="[!XX],[!ES]"),
    _row("Income", "bonus", "credit", 15.0, bank_specific__paylabels="[!RW]",
         internal_transaction="id-1"),
)
SME_RULE_SAMPLES = (
    _row("Other Expenses", "", "debit", 12.0),
    _row("Other Income", "", "credit", 12.0),
    _row("Corporate Savings Deposits", "", "debit", 12.0, counter_account_type="SAVINGS_ACCOUNT"),
    _row("Equity Financing", "", "credit", 12.0, counter_account_type="SAVINGS_ACCOUNT"),
    _row("Payroll Tax", TEST_DESCRIPTION_PREFIX, "debit", 12.0,
         bank_counterparty_name="Payroll Tax"),
    _row("Other Income", TEST_DESCRIPTION_PREFIX + "Other Income", "credit", 12.0),
    _row("Other Income", "Interest paid after tax 0.35 deducted", "credit", 12.0),
)
