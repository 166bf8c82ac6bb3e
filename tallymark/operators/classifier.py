"""Trained scorer: multinomial logistic regression on hashed n-grams and numeric features."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.config import TARGET_INDEX, ModelConfig
from tallymark.functions import text
from tallymark.operators import filters, sampling


NUMERIC = 3


def _with_inputs(df: DataFrame, config: ModelConfig) -> DataFrame:
    tokens = text.tokenize(F.col("cleaned_description"), config.max_tokens)
    numeric = F.transform("preprocessed_numeric_features", lambda x: F.coalesce(x, F.lit(0.0)))
    return df.withColumn("_tokens", tokens).withColumns(
        {"_grams": text.ngrams(F.col("_tokens")), "_numeric": array_to_vector(numeric)}
    )


def fit(
    train: DataFrame, config: ModelConfig, n_features: int = 1 << 14, max_iter: int = 100,
    max_rows: int | None = None, penalty: float = 1e-4,
) -> PipelineModel:
    """Fit on rows with features and a trainable label, at most `max_rows` of them if given."""
    labelled = filters.without_excluded_labels(train, config).where(F.col(TARGET_INDEX).isNotNull())
    if max_rows is not None:
        labelled = sampling.capped(labelled, max_rows, seed=config.seed)
    labelled = labelled.withColumn("_label", F.col(TARGET_INDEX).cast("double"))
    stages = [
        HashingTF(inputCol="_grams", outputCol="_counts", numFeatures=n_features),
        # so that an empty table can be scored as well
        VectorSizeHint(inputCol="_numeric", size=NUMERIC, handleInvalid="optimistic"),
        VectorAssembler(inputCols=["_counts", "_numeric"], outputCol="_features"),
        LogisticRegression(
            featuresCol="_features", labelCol="_label", probabilityCol="_probability",
            rawPredictionCol="_raw", predictionCol="_prediction", family="multinomial",
            maxIter=max_iter, regParam=penalty,
        ),
    ]
    return Pipeline(stages=stages).fit(_with_inputs(labelled, config))


def score(model: PipelineModel, df: DataFrame, config: ModelConfig) -> DataFrame:
    """Add `scores`, one probability per trainable category."""
    predicted = model.transform(_with_inputs(df, config))
    probabilities = vector_to_array("_probability")
    n = len(config.trainable)
    # Labels above the largest one seen in training have no probability of their own.
    padded = F.slice(F.concat(probabilities, F.array_repeat(F.lit(0.0), n)), 1, n)
    return predicted.select(*df.columns, padded.alias("scores"))


@dataclass
class Choice:
    """A fit with the mean log loss of the validation rows that have a trainable label."""

    penalty: float
    validation_loss: float


def validation_loss(model: PipelineModel, validation: DataFrame, config: ModelConfig) -> float | None:
    """Mean log loss of the labels, None without labelled rows."""
    labelled = filters.without_excluded_labels(validation, config).where(
        F.col(TARGET_INDEX).between(0, len(config.trainable) - 1)
    )
    given = F.get("scores", F.col(TARGET_INDEX).cast("int"))
    return score(model, labelled, config).agg(F.avg(-F.log(F.greatest(given, F.lit(1e-15))))).first()[0]


def choose(
    train: DataFrame, validation: DataFrame, config: ModelConfig, penalties: Sequence[float], **options
) -> tuple[PipelineModel, list[Choice]]:
    """The fit among `penalties` with the least validation loss, the first of equal ones.

    Without labelled validation rows the first penalty is taken.
    """
    best, tried = None, []
    for penalty in penalties:
        model = fit(train, config, penalty=penalty, **options)
        loss = validation_loss(model, validation, config)
        if best is None or loss is not None and loss < min(c.validation_loss for c in tried):
            best = model
        tried.append(Choice(penalty, float("inf") if loss is None else loss))
    return best, tried
