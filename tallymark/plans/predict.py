"""From transactions to categories."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.config import ModelConfig
from tallymark.operators import features, joins, overrides, postprocess

Scorer = Callable[[DataFrame], DataFrame]


def with_mcc_index(df: DataFrame, mcc: DataFrame) -> DataFrame:
    """Category index of the merchant code, -1 when unknown. `mcc` has (code, mcc_index)."""
    codes = joins.merchant_codes(mcc)
    return joins.lookup_index(df, codes, "bank_specific__mcc", "code", "mcc_index")


def rate(
    df: DataFrame, config: ModelConfig, limits: Column, scorer: Scorer, mcc: DataFrame | None = None
) -> DataFrame:
    """Rows with features, rewritten `scores`, `category` and `category_source`."""
    scored = scorer(features.features(df, config, limits))
    if config.join_counterparty:
        return postprocess.sme(scored, config)
    coded = scored.withColumn("mcc_index", F.lit(-1)) if mcc is None else with_mcc_index(scored, mcc)
    return postprocess.retail(coded, config)


def predict_retail(
    df: DataFrame, config: ModelConfig, limits: Column, scorer: Scorer, mcc: DataFrame | None = None
) -> DataFrame:
    """Input columns with `category` and `category_source`."""
    return rate(df, config, limits, scorer, mcc).select(*df.columns, "category", "category_source")


def predict_sme(df: DataFrame, config: ModelConfig, limits: Column, scorer: Scorer) -> DataFrame:
    """Input columns with `category` and `category_source`.

    The country is derived before defaults are filled: a missing counter account is not taken for
    a current account there.
    """
    if "counter_account_type" not in df.columns:
        rows = df.withColumn("counter_account_type", F.lit(None).cast("string"))
    else:
        rows = df
    rated = rate(overrides.with_country(rows), config, limits, scorer)
    ruled = overrides.apply_interest(overrides.apply_tax_labels(rated))
    return overrides.apply_counterparties(ruled).select(
        *df.columns, "category", "category_source"
    )
