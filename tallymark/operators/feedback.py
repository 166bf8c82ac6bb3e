"""Category feedback: union of sources and the latest label per transaction."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.config import FEEDBACK_COLUMNS, IDENTITY, TARGET


def union_feedback(sources: Iterable[DataFrame]) -> DataFrame:
    tables = [source.select(*FEEDBACK_COLUMNS) for source in sources]
    return reduce(DataFrame.unionByName, tables)


def dedup(feedback: DataFrame) -> DataFrame:
    return feedback.dropDuplicates()


def parse_time(feedback: DataFrame) -> DataFrame:
    """Feedback time as a timestamp; rows with an unreadable time are dropped."""
    parsed = feedback.withColumn("feedback_time", F.try_to_timestamp(F.col("feedback_time")))
    return parsed.where(F.col("feedback_time").isNotNull())


def latest_feedback(sources: Iterable[DataFrame]) -> DataFrame:
    """The newest label of every transaction; at equal times the first category by name.

    A minimum, unlike a window, combines before the shuffle: a transaction with very many
    feedback rows sends one row per map task. Repeated rows do not change a minimum, so no
    separate deduplication is needed. A missing category sorts last among equal times.
    """
    newest_first = F.struct(
        (-F.unix_micros("feedback_time")).alias("age"),
        F.col("category").isNull().alias("missing"),
        F.col("category").alias("category"),
        F.col("feedback_time").alias("feedback_time"),
    )
    return (
        parse_time(union_feedback(sources))
        .groupBy(*IDENTITY)
        .agg(F.min(newest_first).alias("_newest"))
        .select(
            *IDENTITY,
            F.col("_newest.feedback_time").alias("feedback_time"),
            F.col("_newest.category").alias(TARGET),
        )
    )
