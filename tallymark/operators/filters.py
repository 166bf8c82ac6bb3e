"""Filters and projections."""

from __future__ import annotations

from datetime import date, timedelta
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.config import (
    BUSINESS_USE_MIN_AMOUNT,
    BUSINESS_USE_PATTERN,
    TARGET,
    TARGET_INDEX,
    ModelConfig,
)
from tallymark.staging import measured


def from_start_date(df: DataFrame, start: str) -> DataFrame:
    return df.where(F.col("date") >= F.to_date(F.lit(start)))


def default_window(today: date, days: int = 30) -> tuple[str, str]:
    """The production window used when none is configured: the last `days` days up to today."""
    return (today - timedelta(days=days)).isoformat(), today.isoformat()


def in_date_range(df: DataFrame, start: str, end: str) -> DataFrame:
    """Both ends belong to the range. The date is cast, so timestamps keep the whole last day."""
    day = F.col("date") if dict(df.dtypes)["date"] == "date" else F.col("date").cast("date")
    return df.where(day.between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def of_clients(users: DataFrame, clients: Sequence[str]) -> DataFrame:
    return users.where(F.col("client_id").isin(list(clients)))


def active_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.where(F.col("deleted").isNull())


def relevant_accounts(accounts: DataFrame, test_site_id: str) -> DataFrame:
    """Accounts that are neither deleted nor on the test site; an unknown site is dropped too."""
    return active_accounts(accounts).where(F.col("site_id") != test_site_id)


def eligible_country(users: DataFrame, config: ModelConfig) -> DataFrame:
    """Users of the configured countries; test users stay only in one of them."""
    kept = config.test_users_kept_country
    others = [c for c in config.countries if c != kept]
    country = F.col("country_code")
    return users.where((country.isin(others) & (F.col("test_user") == 0)) | (country == kept))


def business_account_ids(
    users: DataFrame,
    transactions: DataFrame,
    pattern: str = BUSINESS_USE_PATTERN,
    min_amount: float = BUSINESS_USE_MIN_AMOUNT,
    country: str = "GB",
) -> tuple[DataFrame, DataFrame]:
    """Transactions that may be business use, and the accounts that show it.

    An account qualifies by one debit above `min_amount` whose text names a tax or bookkeeping
    vendor.
    """
    local_users = measured(
        users.where(F.col("country_code") == country).select("user_id").distinct(), "local-users"
    )
    candidates = (
        transactions.where(F.col("category") != "Internal")
        .withColumn("description", F.lower(F.col("description")))
        .join(local_users, "user_id", "left_semi")
    )
    accounts = (
        candidates.where(
            (F.col("transaction_type") == "debit")
            & (F.col("amount") > min_amount)
            & F.col("description").rlike(pattern)
        )
        .select("account_id")
        .distinct()
    )
    return candidates, accounts


def business_accounts(
    users: DataFrame, accounts: DataFrame, transactions: DataFrame, **options
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Restrict users, accounts and transactions to accounts that show business use.

    The qualifying account ids are found once, at once, and written; all three read them.
    """
    candidates, qualifying = business_account_ids(users, transactions, **options)
    chosen = measured(qualifying, "business-accounts")
    kept_accounts = accounts.join(chosen, "account_id", "left_semi")
    kept_users = users.join(kept_accounts.select("user_id"), "user_id", "left_semi")
    return kept_users, kept_accounts, candidates.join(chosen, "account_id", "left_semi")


def without_excluded_labels(df: DataFrame, config: ModelConfig, label: str = TARGET) -> DataFrame:
    """Rows with a trainable label; an unlabelled row is kept."""
    target = F.col(label)
    return df.where(target.isNull() | ~target.isin(list(config.excluded)))


def fill_defaults(df: DataFrame, config: ModelConfig) -> DataFrame:
    """Replace NULL in the columns that have a default; amounts become single-precision values."""
    present = {c: v for c, v in config.defaults.items() if c in df.columns}
    filled = df.fillna(present)
    if "amount" in df.columns:
        filled = filled.withColumn("amount", F.col("amount").cast("float").cast("double"))
    return filled


def add_missing_columns(
    df: DataFrame, defaults: Mapping[str, object], columns: Sequence[str]
) -> DataFrame:
    missing = {c: F.lit(defaults[c]) for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def tag(df: DataFrame, **constants: str) -> DataFrame:
    """Constant columns, such as a domain or the run time (passed in, never read from a clock)."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def map_category_index(df: DataFrame, config: ModelConfig, label: str = TARGET) -> DataFrame:
    """Category index of a label; an unknown label gives NULL."""
    entries = [F.lit(x) for i, c in enumerate(config.categories) for x in (c, i)]
    return df.withColumn(TARGET_INDEX, F.try_element_at(F.create_map(*entries), F.col(label)))
