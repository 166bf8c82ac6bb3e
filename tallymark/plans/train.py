"""The training job: split, fit, choose by validation, evaluate on the test split and judge."""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.config import IDENTITY, ModelConfig
from tallymark.operators import classifier, features, filters, metric_learning, metrics, sampling
from tallymark.operators.embedding import EmbeddingModel
from tallymark.plans import evaluate, predict
from tallymark.staging import discard, stage


@dataclass
class TrainedModel:
    """A fitted scorer, of either kind, with the amount limits of its training split."""

    model: PipelineModel | EmbeddingModel
    config: ModelConfig
    low: float
    high: float
    mcc: DataFrame | None = None

    @property
    def limits(self) -> Column:
        return features.fixed_limits(self.low, self.high)

    def scorer(self, df: DataFrame) -> DataFrame:
        if isinstance(self.model, EmbeddingModel):
            return self.model.score(df, [c for c in IDENTITY if c in df.columns], self.config)
        return classifier.score(self.model, df, self.config)

    def rate(self, df: DataFrame) -> DataFrame:
        return predict.rate(df, self.config, self.limits, self.scorer, self.mcc)

    def predict(self, df: DataFrame) -> DataFrame:
        if self.config.join_counterparty:
            return predict.predict_sme(df, self.config, self.limits, self.scorer)
        return predict.predict_retail(df, self.config, self.limits, self.scorer, self.mcc)


@dataclass
class TrainingOutcome:
    """The model, its metrics, the verdict, and monitoring shares of a production sample."""

    model: TrainedModel
    metrics: DataFrame
    verdict: DataFrame
    golden_failures: DataFrame
    missing_labels: DataFrame
    split_sizes: DataFrame
    fit_seconds: float
    tries: int = 1
    #: (round, validation loss) of the last try: training rounds, or fits of the classifier compared
    rounds: list[tuple[int, float]] = field(default_factory=list)
    chosen_round: int = 0
    label_shares: DataFrame | None = None
    text_lengths: DataFrame | None = None


def missing_labels(split: DataFrame, config: ModelConfig) -> DataFrame:
    """(split, category): trainable categories that a split lacks, excluded labels left out."""
    kept = filters.without_excluded_labels(split, config)
    parts = [
        metrics.missing_labels(kept.where(F.col("split") == name), config)
        .where(~F.col("category").isin(list(config.excluded)))
        .select(F.lit(name).alias("split"), "category")
        for name in ("train", "validation", "test")
    ]
    return reduce(DataFrame.unionByName, parts)


def record(outcome: TrainingOutcome, path: str) -> DataFrame:
    """Write what a training run found as (metric, category, value) rows of JSON; returns them."""

    def rows(df: DataFrame, metric: str, category: str, value: str) -> DataFrame:
        return df.select(
            F.lit(metric).alias("metric"), F.col(category).cast("string").alias("category"),
            F.col(value).cast("string").alias("value"),
        )

    spark = outcome.metrics.sparkSession
    verdict = outcome.verdict
    parts = [
        outcome.metrics.select("metric", "category", F.col("value").cast("string").alias("value")),
        rows(outcome.split_sizes, "split_size", "split", "n_rows"),
        rows(outcome.missing_labels, "missing_label", "split", "category"),
        rows(outcome.golden_failures, "golden_failure", "sample", "predicted"),
        verdict.select(F.inline(F.array(*[
            F.struct(F.lit("verdict").alias("metric"), F.lit(c).alias("category"),
                     F.col(c).cast("string").alias("value"))
            for c in verdict.columns
        ]))),
        spark.createDataFrame(
            [
                ("fit_seconds", "", f"{outcome.fit_seconds:.1f}"), ("tries", "", str(outcome.tries)),
                ("chosen_round", "", str(outcome.chosen_round)),
                *(("validation_loss", str(k), repr(loss)) for k, loss in outcome.rounds),
            ],
            "metric string, category string, value string",
        ),
    ]
    if outcome.label_shares is not None:
        parts.append(rows(outcome.label_shares, "label_share", *outcome.label_shares.columns))
        parts.append(rows(outcome.text_lengths, "text_length", *outcome.text_lengths.columns))
    found = reduce(DataFrame.unionByName, parts)
    found.write.mode("overwrite").json(path)
    return spark.read.schema(found.schema).json(path)


def _classifier(learned, validated, config, seed, penalties=(1e-4,), **options):
    if len(penalties) == 1:
        return classifier.fit(learned, config, penalty=penalties[0], **options), [], 0
    model, tried = classifier.choose(learned, validated, config, penalties, **options)
    losses = [c.validation_loss for c in tried]
    return model, list(enumerate(losses)), losses.index(min(losses))


def _embedding(learned, validated, config, seed, **options):
    fitted = metric_learning.fit(learned, validated, config, seed=seed, **options)
    losses = [(r.number, r.validation_loss) for r in fitted.rounds]
    return fitted.model(learned.sparkSession), losses, fitted.best


_KINDS = {"classifier": _classifier, "embedding": _embedding}


def train(
    training: DataFrame,
    golden: DataFrame,
    config: ModelConfig,
    production: DataFrame | None = None,
    mcc: DataFrame | None = None,
    kind: str = "classifier",
    **fit_options,
) -> TrainingOutcome:
    """Fit on the training split of a table made by preprocessing, choose by the validation split.

    `kind`: "classifier" (logistic regression; several `penalties` are compared) or "embedding"
    (metric learning; the best round counts). An embedding model that misses the release gate is
    trained again from other initial values, up to `config.max_retries` times; the last one stands.
    Only the two amount limits and the fitted parameters come to the driver.
    """
    split = stage(
        sampling.stratified_split(training, config.test_share, config.validation_share), "split"
    )
    sizes = split.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    learned = split.where(F.col("split") == "train")
    # The limits are of the whole split, before excluded labels are dropped.
    low, high = features.amount_range(learned).first()
    limits = features.fixed_limits(low, high)
    made = {
        name: stage(features.features(split.where(F.col("split") == name), config, limits), "features")
        for name in ("train", "validation")
    }
    retries = config.max_retries if kind == "embedding" else 0
    for attempt in range(retries + 1):
        began = time.monotonic()
        fitted, rounds, chosen = _KINDS[kind](
            made["train"], made["validation"], config, config.seed + attempt, **fit_options
        )
        seconds = time.monotonic() - began
        model = TrainedModel(fitted, config, low, high, mcc)
        tested = stage(model.rate(split.where(F.col("split") == "test")), "rated-test-split")
        judged = model.predict(golden).withColumnRenamed("category", "predicted_category")
        verdict = evaluate.release_verdict(tested, judged, config)
        if attempt == retries or verdict.first()["is_performant"]:
            break
        discard(tested)
    discard(*made.values())

    outcome = TrainingOutcome(
        model=model,
        metrics=evaluate.evaluate(tested, config),
        verdict=verdict,
        golden_failures=metrics.golden_failures(judged),
        missing_labels=missing_labels(split, config),
        split_sizes=sizes,
        fit_seconds=seconds,
        tries=attempt + 1,
        rounds=rounds,
        chosen_round=chosen,
    )
    if production is not None:
        outcome.label_shares = metrics.label_distribution(model.rate(production))
        outcome.text_lengths = metrics.text_length_histogram(production)
    return outcome
