"""Queries on tokens: encoding, token files, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import bpe, token_counts, token_store
from tallymark.llm.registry import query, table
from tallymark.staging import new_folder


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_bpe")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, vocabulary()).select("doc_id", "ids")
    return bpe.decode(ids, vocabulary()).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op2_token_store")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    store = new_folder(spark, "tokens")
    token_store.write(table(spark, folder, "documents"), store, vocabulary())
    return token_store.read(spark, store).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query("op4_token_counts")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, vocabulary()).drop("text")
