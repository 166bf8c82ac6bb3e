"""From documents to token ids: language, near-duplicates, repeated passages, benchmarks, BPE.

Each stage gets what its predecessor kept, as a written table, and returns the columns of its
input; the last one adds the tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import bpe, decontamination, language_id, minhash, substring
from tallymark.llm.batches import fresh, without
from tallymark.llm.q_tokens import vocabulary
from tallymark.staging import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a language: null, without a letter, or of which the model knows nothing."""
    return language_id.recognised(docs, language_id.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group with a similarity of 0.8 or more."""
    return minhash.distinct_documents(docs, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that an earlier document has; every document stays."""
    return substring.remove_repeats(docs, n_chars="n_chars" if "n_chars" in docs.columns else None)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold an item of the benchmark, in whatever order."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (binary, little-endian unsigned 32-bit), their number, and the text they give.

    Columns `ids` and `n_tokens` are replaced, all others stay.
    """
    kept = without(docs, "ids", "n_tokens")
    (given,) = fresh(kept, "__text")
    encoded = bpe.encode(kept.withColumnRenamed("text", given), vocabulary(), text=given, decoded="text")
    return encoded.select(
        *(F.col(f"`{c}`") for c in kept.columns),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
    )


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontaminate", decontaminate),
    ("tokens", tokens),
]

#: The language model, sketches and content-defined chunks have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
