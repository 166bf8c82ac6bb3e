"""Metrics of predictions and the release verdict."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.config import ModelConfig
from tallymark.operators import metrics


def evaluate(scored: DataFrame, config: ModelConfig) -> DataFrame:
    """All metrics as (metric, category, value) rows.

    `scored` has the true label and its index, the predicted category and the score array.
    """

    def rows(df: DataFrame, metric: Column | str, value: str, category: Column | None = None):
        name = F.lit(metric) if isinstance(metric, str) else metric
        label = F.lit("") if category is None else category
        return df.select(
            name.alias("metric"), label.alias("category"), F.col(value).cast("double").alias("value")
        )

    report = metrics.classification_report(scored, config)
    measures = ("precision", "recall", "f1_score", "support")
    stacked = report.select(
        "category",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                    for m in measures
                ]
            )
        ),
    )
    ranked = scored.where(F.col("target_category_int").isNotNull())
    recall = metrics.recall_at_k(ranked, config)
    parts = [
        stacked.select("metric", "category", "value"),
        rows(metrics.mean_reciprocal_rank(ranked), "mean_reciprocal_rank", "mean_reciprocal_rank"),
        rows(recall, F.concat(F.lit("recall_at_"), F.col("k")), "recall"),
        rows(metrics.coverage(scored, config), "coverage", "coverage"),
    ]
    return reduce(DataFrame.unionByName, parts)


def release_verdict(scored: DataFrame, golden: DataFrame, config: ModelConfig) -> DataFrame:
    report = metrics.classification_report(scored, config)
    return metrics.quality_gate(report, metrics.coverage(scored, config), golden, config)
