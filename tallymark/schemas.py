"""Explicit schemas and column renames of the input tables (no inference at read time)."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _struct(*fields: T.StructField) -> T.StructType:
    return T.StructType(list(fields))


_AMOUNT = T.StructField("amount", T.DoubleType())
_PENDING = T.StructField("pending", T.IntegerType())
_DATE = T.StructField("date", T.DateType())

USERS = _struct(*_strings("id", "country_code", "client_id"))
ACCOUNTS = _struct(*_strings("id", "user_id", "deleted", "type", "site_id"))
TEST_USERS = _struct(*_strings("user_id"))
INSPECTION = _struct(*_strings("user_id", "account_id", "transaction_id"))
TRANSACTIONS_RETAIL = _struct(
    *_strings("user_id", "account_id", "transaction_id"), _DATE, _PENDING,
    *_strings("description", "internal_transaction", "transaction_type"), _AMOUNT,
    *_strings("bank_specific"),
)
TRANSACTIONS_SME = _struct(
    *_strings("user_id", "account_id", "transaction_id"), _DATE,
    *_strings("category"), _PENDING,
    *_strings("description", "internal_transaction", "transaction_type"), _AMOUNT,
    *_strings("bank_counterparty_name"),
)
FEEDBACK = _struct(
    *_strings("user_id", "account_id", "transaction_id"), _PENDING, _DATE,
    *_strings("feedback_time", "category"),
)
FEEDBACK_EVENTS = _struct(
    *_strings("id__userId", "id__accountId", "id__transactionId"),
    T.StructField("id__localDate", T.DateType()),
    T.StructField("id__pendingType", T.IntegerType()),
    *_strings("kafka__timestamp", "fact__category"),
)
MCC = _struct(*_strings("code", "category"))

EVENT_ALIASES = {
    "id__userId": "user_id",
    "id__accountId": "account_id",
    "id__transactionId": "transaction_id",
    "id__localDate": "date",
    "id__pendingType": "pending",
    "kafka__timestamp": "feedback_time",
    "fact__category": "category",
}
USER_ALIASES = {"id": "user_id"}
ACCOUNT_ALIASES = {"id": "account_id", "type": "account_type"}
