"""Joins between transactions, users, accounts and lookups.

Transactions are the only large side. What they are joined to (eligible users and accounts, held
out keys, merchant codes) is written once, counted, and broadcast up to a documented number of rows,
so transactions and their texts stay where they are; a larger dimension is joined by shuffle, with
the same rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.config import IDENTITY, ModelConfig
from tallymark.operators import filters
from tallymark.staging import measured, stage

BASE_TRANSACTION_COLUMNS = (
    "user_id", "account_id", "transaction_id", "date", "amount", "pending", "transaction_type",
    "bank_counterparty_name", "description",
)


def users_with_accounts(users: DataFrame, accounts: DataFrame) -> DataFrame:
    return users.join(accounts, "user_id", "inner")


def eligible(users: DataFrame, accounts: DataFrame) -> DataFrame:
    """Users joined with their accounts as a measured dimension; runs that join at once."""
    return measured(users_with_accounts(users, accounts), "eligible-accounts")


def base_tagging(
    users: DataFrame, accounts: DataFrame, transactions: DataFrame, clients: Sequence[str]
) -> DataFrame:
    """Transactions of the clients' active accounts, with country and client."""
    chosen = filters.of_clients(users, clients).select("user_id", "country_code", "client_id")
    active = filters.active_accounts(accounts).select("user_id", "account_id")
    return (
        transactions.select(*BASE_TRANSACTION_COLUMNS)
        .join(eligible(chosen, active), ["user_id", "account_id"], "inner")
        .withColumn("year_month", F.col("date"))
    )


def flag_test_users(users: DataFrame, test_users: DataFrame | None) -> DataFrame:
    """Add test_user = 1 or 0; without a test-user table nobody is one."""
    if test_users is None:
        return users.withColumn("test_user", F.lit(0))
    marked = test_users.withColumn("test_user", F.lit(1))
    return users.join(marked, "user_id", "left").fillna(0, subset="test_user")


def users_sample(
    users: DataFrame, test_users: DataFrame | None, config: ModelConfig, domain: str
) -> DataFrame:
    flagged = flag_test_users(filters.of_clients(users, config.clients[domain]), test_users)
    return filters.eligible_country(flagged, config)


def without_test_users(users: DataFrame, test_users: DataFrame | None) -> DataFrame:
    if test_users is None:
        return users
    return users.join(test_users, "user_id", "left_anti")


INSPECTION_KEYS = ["user_id", "account_id", "transaction_id"]


def held_keys(inspection: DataFrame) -> DataFrame:
    """The keys of the inspection set, written and counted once for all uses."""
    return measured(inspection.select(*INSPECTION_KEYS).distinct(), "inspection")


def hold_out(transactions: DataFrame, held: DataFrame) -> DataFrame:
    """Transactions that are not in the inspection set; `held` are its keys."""
    return transactions.join(held, INSPECTION_KEYS, "left_anti")


def held_out_count(transactions: DataFrame, held: DataFrame) -> DataFrame:
    """How many transactions the hold-out removes, counted from the removed rows alone."""
    removed = transactions.select(*INSPECTION_KEYS).join(held, INSPECTION_KEYS, "left_semi")
    return removed.agg(F.count(F.lit(1)).alias("held_out"))


def with_accounts_of(transactions: DataFrame, account_ids: DataFrame) -> DataFrame:
    return transactions.join(measured(account_ids.distinct(), "account-ids"), "account_id", "left_semi")


def feedback_base(feedback: DataFrame, users: DataFrame, accounts: DataFrame) -> DataFrame:
    """Feedback of known users and accounts."""
    return feedback.join(eligible(users, accounts), ["user_id", "account_id"], "inner")


def with_transactions(base: DataFrame, transactions: DataFrame) -> DataFrame:
    return base.join(transactions, list(IDENTITY), "inner")


def labelled_transactions(
    feedback: DataFrame, transactions: DataFrame, users: DataFrame, accounts: DataFrame
) -> DataFrame:
    """Latest feedback with its transaction, user and account.

    Both sides are reduced to eligible accounts first; only what is left of the transactions moves
    to the feedback, which is already partitioned on the identity.
    """
    owner = ["user_id", "account_id"]
    known = eligible(users, accounts)
    kept = transactions.join(known.select(*owner), owner, "left_semi")
    return with_transactions(feedback.join(known, owner, "inner"), kept)


def lookup_index(
    df: DataFrame, lookup: DataFrame, key: str, code: str, value: str, default: int = -1
) -> DataFrame:
    """Left join to a lookup; a key without entry gets `default`."""
    entries = lookup.select(F.col(code).alias(key), value)
    return df.join(entries, key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


# Most merchant codes that are copied to every executor; a larger table is joined by shuffle.
COPIED_CODES = 100_000


def merchant_codes(mcc: DataFrame, most: int = COPIED_CODES) -> DataFrame:
    """One row per merchant code, whatever its form; a code with two categories is an error.

    The codes are written once, counted (up to `most` + 1) and broadcast only if there are no more than
    `most`: shuffling the transactions on their code would put all those without one into one partition,
    which adaptive execution then has to split.
    """
    mcc = stage(mcc.select("code", "mcc_index").distinct(), "merchant-codes")
    index, low = F.max("mcc_index"), F.min("mcc_index")
    conflict = F.raise_error(F.concat(F.lit("two categories for the merchant code "), F.col("code")))
    codes = (
        mcc.where(F.col("code").isNotNull())
        .groupBy(F.col("code").cast("string").alias("code"))
        .agg(index.alias("mcc_index"), low.alias("_low"))
        .select("code", F.when(F.col("_low") == F.col("mcc_index"), F.col("mcc_index")).otherwise(
            conflict.cast("int")).alias("mcc_index"))
    )
    known = mcc.select("code").distinct().limit(most + 1).count()
    return F.broadcast(codes) if known <= most else codes
