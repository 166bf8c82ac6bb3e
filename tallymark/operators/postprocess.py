"""Ordered business rules that rewrite the score array of a transaction.

The rules only ever touch a few categories, so those scores travel as plain double columns
("lanes") next to the untouched array and the array is assembled once at the end. Every step is
then ordinary column arithmetic inside one generated stage, instead of a copy of the array per
rule. `_open` is true while no assigning rule has hit the row.

Temporary columns start with an underscore and are dropped by `_assemble`.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.config import (
    CURRENT_ACCOUNT,
    MODEL_FALLBACK,
    MODEL_PREDICTION,
    SAVINGS_ACCOUNT,
    ModelConfig,
)
from tallymark.functions import scores as S
from tallymark.functions.text import pay_label_category

_RETAIL_LANES = ("Internal", "Income", "Savings", "General")
_SME_LANES = ("Corporate Savings Deposits", "Equity Financing", "Other Expenses", "Other Income")


def _lane(category: str) -> Column:
    return F.col(f"_s_{category}")


def _open() -> Column:
    return F.col("_open")


def _assign(df: DataFrame, category: str, condition: Column) -> DataFrame:
    """Give the category the score 1 where the row is open, and close it."""
    df = df.withColumn("_hit", _open() & condition)
    return df.withColumns(
        {
            f"_s_{category}": F.when(F.col("_hit"), F.lit(1.0)).otherwise(_lane(category)),
            "_open": _open() & ~F.col("_hit"),
        }
    )


def _reject(df: DataFrame, category: str, condition: Column) -> DataFrame:
    """Give the category the score -1; the row stays open."""
    score = F.when(condition, F.lit(-1.0)).otherwise(_lane(category))
    return df.withColumn(f"_s_{category}", score)


def _largest(indices: list[int]) -> Column:
    return F.expr(f"greatest({', '.join(f'get(scores, {i})' for i in indices)})")


def _is(column: str, value: str) -> Column:
    return F.col(column) == value


def _between_current_and_savings() -> Column:
    return _is("account_type", CURRENT_ACCOUNT) & _is("counter_account_type", SAVINGS_ACCOUNT)


def _source(confident: Column) -> Column:
    return F.when(confident, F.lit(MODEL_PREDICTION)).otherwise(F.lit(MODEL_FALLBACK))


def _assemble(df: DataFrame, scores: Column, extra: Mapping[str, Column]) -> DataFrame:
    """Select the inputs and the results of a chain.

    The planner pushes a later filter, say on the category, down through projections and puts the
    whole chain in place of the column each time it is mentioned, which grows without bound. It
    never moves a filter past a projection that is not deterministic, so the scores pass through
    a condition on the row number that always holds.
    """
    kept = [c for c in df.columns if not c.startswith("_") and c != "scores"]
    settled = F.when(F.monotonically_increasing_id() >= 0, scores)
    return df.select(*kept, settled.alias("scores"), *[c.alias(n) for n, c in extra.items()])


# --- retail -------------------------------------------------------------------------------


def retail_start(df: DataFrame, config: ModelConfig) -> DataFrame:
    """Split the model scores into lanes. `General`, which the model does not score, starts at 0.

    The untouched scores matter only by their largest value left and right of `Internal`: equal
    scores are won by the category that comes first.
    """
    lanes = {}
    for category in _RETAIL_LANES:
        if category in config.trainable:
            lanes[f"_s_{category}"] = F.get("scores", F.lit(config.index(category)))
        else:
            lanes[f"_s_{category}"] = F.lit(0.0)
    internal = config.index("Internal")
    others = [config.index(c) for c in config.trainable if c not in _RETAIL_LANES]
    low = [i for i in others if i < internal]
    high = [i for i in others if i > internal]
    return df.withColumns(
        {**lanes, "_low": _largest(low), "_high": _largest(high), "_open": F.lit(True)}
    )


def _retail_max() -> Column:
    return F.greatest(F.col("_low"), F.col("_high"), *[_lane(c) for c in _RETAIL_LANES])


def _savings_leads() -> Column:
    """Savings is the first category with the largest score (only General comes after it)."""
    ahead = F.greatest(F.col("_low"), F.col("_high"), _lane("Internal"), _lane("Income"))
    return (_lane("Savings") > ahead) & (_lane("Savings") >= _lane("General"))


def _internal_leads() -> Column:
    after = F.greatest(F.col("_high"), _lane("Income"), _lane("Savings"), _lane("General"))
    return (_lane("Internal") > F.col("_low")) & (_lane("Internal") >= after)


def retail_single_feature(df: DataFrame, config: ModelConfig) -> DataFrame:
    """Savings accounts, rejected categories and pay labels."""
    df = _assign(df, "Internal", _is("account_type", SAVINGS_ACCOUNT))
    not_internal = _is("internal_transaction", "") & _is("account_type", CURRENT_ACCOUNT)
    df = _reject(df, "Internal", _open() & not_internal)
    df = _reject(df, "Income", _open() & _is("transaction_type", "debit"))
    label = pay_label_category(F.col("bank_specific__paylabels"))
    df = df.withColumn("_label", F.coalesce(label, F.lit("")))
    # The first listed label decides, so at most one of these assignments hits.
    for category in _RETAIL_LANES:
        df = _assign(df, category, _is("_label", category))
    return df


def retail_savings(df: DataFrame, config: ModelConfig) -> DataFrame:
    """Transfers to savings accounts, and internal transfers unless the model is sure of Savings."""
    df = _assign(df, "Savings", _between_current_and_savings())
    sure_savings = _savings_leads() & (_retail_max() >= config.threshold)
    df = df.withColumns(
        {"_sure": sure_savings, "_internal": F.col("internal_transaction") != ""}
    )
    df = _reject(df, "Internal", _open() & F.col("_internal") & F.col("_sure"))
    return _assign(df, "Internal", F.col("_internal") & ~F.col("_sure"))


def retail_remaining(df: DataFrame, config: ModelConfig) -> DataFrame:
    """Keep a confident Savings or Internal; then internal transfers and credits."""
    # Confidence is taken before Savings is raised, the leading category after it.
    df = df.withColumn("_confident", _retail_max() >= config.threshold)
    df = _assign(df, "Savings", _savings_leads() & F.col("_confident"))
    df = _assign(df, "Internal", _internal_leads() & F.col("_confident"))
    df = _assign(df, "Internal", F.col("internal_transaction") != "")
    return _assign(df, "Income", _is("transaction_type", "credit"))


def retail_fallback(df: DataFrame, config: ModelConfig) -> DataFrame:
    """Empty text, the confidence threshold and merchant codes. Reads `mcc_index` (-1: unknown)."""
    empty = _is("cleaned_description", "")
    df = _assign(df, "General", empty & _is("transaction_type", "debit"))
    df = df.withColumn("_confident", _retail_max() >= config.threshold)
    # This rejection ignores whether the row is open.
    df = _reject(df, "General", F.col("_confident") & ~empty)
    df = df.withColumn("_open", _open() & ~F.col("_confident"))
    df = df.withColumn("_by_mcc", _open() & (F.col("mcc_index") > -1))
    df = df.withColumn("_open", _open() & ~F.col("_by_mcc"))
    return _assign(df, "General", F.lit(True))


def retail_finish(df: DataFrame, config: ModelConfig, stage_open: bool = False) -> DataFrame:
    """Assemble the score array; `stage_open` also keeps the open flag (for single stages)."""
    by_mcc = "_by_mcc" in df.columns

    def score(i: int, category: str) -> str:
        lane = f"`_s_{category}`" if category in _RETAIL_LANES else f"get(scores, {i})"
        return f"IF(_by_mcc AND mcc_index = {i}, 1.0D, {lane})" if by_mcc else lane

    listed = ", ".join(score(i, c) for i, c in enumerate(config.categories))
    assembled = F.expr(f"array({listed})")
    extra = {}
    if by_mcc:
        extra["category_source"] = _source(F.col("_confident"))
    if stage_open:
        extra["open"] = _open()
    return _assemble(df, assembled, extra)


def retail(df: DataFrame, config: ModelConfig) -> DataFrame:
    """The whole chain: rewritten `scores`, `category_source` and `category`."""
    df = retail_start(df, config)
    for stage in (retail_single_feature, retail_savings, retail_remaining, retail_fallback):
        df = stage(df, config)
    df = retail_finish(df, config)
    return df.withColumn("category", S.argmax_category(F.col("scores"), config.categories))


# --- sme ----------------------------------------------------------------------------------


def sme_start(df: DataFrame, config: ModelConfig) -> DataFrame:
    """Bar the categories of the other direction and split the scores into lanes."""
    df = df.withColumn("scores", S.add_uncategorized(F.col("scores"), config))
    df = df.withColumn("scores", S.direction_mask(config, "scores", "transaction_type"))
    others = [i for i, c in enumerate(config.categories) if c not in _SME_LANES]
    lanes = {f"_s_{c}": F.get("scores", F.lit(config.index(c))) for c in _SME_LANES}
    return df.withColumns({**lanes, "_rest": _largest(others), "_open": F.lit(True)})


def sme_business(df: DataFrame, config: ModelConfig) -> DataFrame:
    """Transfers between the current and the savings account."""
    transfer = _between_current_and_savings()
    df = _assign(df, "Corporate Savings Deposits", transfer & _is("transaction_type", "debit"))
    return _assign(df, "Equity Financing", transfer & _is("transaction_type", "credit"))


def sme_fallback(df: DataFrame, config: ModelConfig) -> DataFrame:
    """Empty text and the confidence threshold."""
    empty = _is("cleaned_description", "")
    by_direction = (("Other Expenses", "debit"), ("Other Income", "credit"))
    for category, direction in by_direction:
        df = _assign(df, category, empty & _is("transaction_type", direction))
    largest = F.greatest(F.col("_rest"), *[_lane(c) for c in _SME_LANES])
    df = df.withColumn("_confident", largest >= config.threshold)
    for category, _ in by_direction:
        # This rejection ignores whether the row is open.
        df = _reject(df, category, F.col("_confident") & ~empty)
    for category, direction in by_direction:
        df = _assign(df, category, ~F.col("_confident") & _is("transaction_type", direction))
    return df


def sme_finish(df: DataFrame, config: ModelConfig, stage_open: bool = False) -> DataFrame:
    listed = ", ".join(
        f"`_s_{c}`" if c in _SME_LANES else f"get(scores, {i})"
        for i, c in enumerate(config.categories)
    )
    assembled = F.expr(f"array({listed})")
    extra = {}
    if "_confident" in df.columns:
        extra["category_source"] = _source(F.col("_confident"))
    if stage_open:
        extra["open"] = _open()
    return _assemble(df, assembled, extra)


def sme_test_rows(df: DataFrame, config: ModelConfig) -> DataFrame:
    """A test description that names a category gets exactly that category."""
    known = F.col("test_category").isin(list(config.categories))
    names = S.literal_array(config.categories)
    wanted = F.transform(names, lambda c: (c == F.col("test_category")).cast("double"))
    return df.withColumns(
        {
            "scores": F.when(known, wanted).otherwise(F.col("scores")),
            "category_source": F.when(known, F.lit(MODEL_PREDICTION)).otherwise(
                F.col("category_source")
            ),
        }
    )


def sme(df: DataFrame, config: ModelConfig) -> DataFrame:
    """The whole chain: rewritten `scores`, `category_source` and `category`."""
    df = sme_start(df, config)
    df = sme_finish(sme_fallback(sme_business(df, config), config), config)
    df = sme_test_rows(df, config)
    return df.withColumn("category", S.argmax_category(F.col("scores"), config.categories))
