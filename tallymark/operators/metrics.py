"""Classification, ranking and coverage metrics, and the release gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.config import TARGET, TARGET_INDEX, ModelConfig
from tallymark.functions import scores as S

_BIN_WIDTH = 10
_BINS = 25


def categories_table(df: DataFrame, config: ModelConfig) -> DataFrame:
    """(category, index) for every category of the model: as many rows as the configuration."""
    rows = [(c, i) for i, c in enumerate(config.categories)]
    return df.sparkSession.createDataFrame(rows, "category string, index int").coalesce(1)


def rows_per_country(df: DataFrame) -> DataFrame:
    return df.groupBy("domain", "country_code").agg(F.count(F.lit(1)).alias("n_rows"))


def label_distribution(df: DataFrame, label: str = "category") -> DataFrame:
    """Share of every label. The window runs over the labels, not over the rows."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(label, (F.col("n") / total).alias("share"))


def text_length_histogram(df: DataFrame, column: str = "description") -> DataFrame:
    """Share of texts per length bin of width 10 up to 250, keyed by the right edge.

    The last bin includes 250; longer texts only count in the denominator.
    """
    length = F.char_length(column)
    bin_of = F.least(F.floor(length / _BIN_WIDTH), F.lit(_BINS - 1)).cast("int")
    edge = F.when(length <= _BINS * _BIN_WIDTH, (bin_of + 1) * _BIN_WIDTH)
    counts = df.groupBy(edge.alias("edge")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    shares = counts.withColumn("_share", F.col("n") / total)
    edges = df.sparkSession.range(1, _BINS + 1).select(
        (F.col("id") * _BIN_WIDTH).cast("int").alias("edge")
    )
    return edges.join(shares, "edge", "left").select(
        "edge", F.coalesce("_share", F.lit(0.0)).alias("share")
    )


def confusion(df: DataFrame, true: str = TARGET, predicted: str = "category") -> DataFrame:
    return df.groupBy(F.col(true).alias("true"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def classification_report(
    df: DataFrame, config: ModelConfig, true: str = TARGET, predicted: str = "category"
) -> DataFrame:
    """Precision, recall, F1 and support of every category, then macro and weighted averages.

    One pass over the rows gives the confusion counts; everything after works on at most
    categories x categories of them.
    """
    counts = confusion(df, true, predicted)
    sides = F.array(
        F.struct(
            F.col("true").alias("category"),
            F.when(F.col("true") == F.col("predicted"), F.col("n")).otherwise(0).alias("hits"),
            F.col("n").alias("actual"),
            F.lit(0).cast("long").alias("guessed"),
        ),
        F.struct(
            F.col("predicted").alias("category"),
            F.lit(0).cast("long").alias("hits"),
            F.lit(0).cast("long").alias("actual"),
            F.col("n").alias("guessed"),
        ),
    )
    totals = (
        counts.select(F.inline(sides))
        .groupBy("category")
        .agg(*[F.sum(c).alias(c) for c in ("hits", "actual", "guessed")])
    )
    listed = categories_table(df, config).join(totals, "category", "left").fillna(0)
    precision = _ratio(F.col("hits"), F.col("guessed"))
    recall = _ratio(F.col("hits"), F.col("actual"))
    rows = listed.withColumns({"precision": precision, "recall": recall})
    rows = rows.withColumn(
        "f1_score",
        _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
    ).select("category", "precision", "recall", "f1_score", F.col("actual").alias("support"))

    measures = ("precision", "recall", "f1_score")

    def average(name: str, weighted: bool) -> Column:
        fields = [
            (_ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")) if weighted
             else F.avg(m)).alias(m)
            for m in measures
        ]
        return F.struct(F.lit(name).alias("category"), *fields, F.sum("support").alias("support"))

    # One row per category, so the list is as long as the configuration.
    everything = rows.agg(
        F.concat(
            F.collect_list(F.struct(*rows.columns)),
            F.array(average("macro avg", False), average("weighted avg", True)),
        ).alias("report")
    )
    return everything.select(F.inline("report"))


def coverage(df: DataFrame, config: ModelConfig, true: str = TARGET) -> DataFrame:
    """1 - share of rows whose true label is an excluded category; 1 without rows.

    Only rows with a label of the model count.
    """
    label = F.col(true)
    excluded = F.count_if(label.isin(list(config.excluded)))
    known = F.count_if(label.isin(list(config.categories)))
    return df.agg((F.lit(1.0) - _ratio(excluded, known)).alias("coverage"))


def mean_reciprocal_rank(df: DataFrame, label_index: str = TARGET_INDEX) -> DataFrame:
    rank = S.rank_with_ties(F.col("scores"), F.col(label_index))
    return df.agg(F.avg(F.lit(1.0) / rank).alias("mean_reciprocal_rank"))


def recall_at_k(df: DataFrame, config: ModelConfig, label_index: str = TARGET_INDEX) -> DataFrame:
    """Share of rows whose true label is among the k best, for k up to the configured rank."""
    ranked = df.select(S.rank_of(F.col("scores"), F.col(label_index)).alias("_rank"))
    ks = range(1, config.max_recall_rank + 1)
    found = [
        F.coalesce(F.avg((F.col("_rank") <= k).cast("double")), F.lit(0.0)).alias(f"_r{k}")
        for k in ks
    ]
    pairs = F.array(
        *[F.struct(F.lit(k).alias("k"), F.col(f"_r{k}").alias("recall")) for k in ks]
    )
    return ranked.agg(*found).select(F.inline(pairs))


def missing_labels(df: DataFrame, config: ModelConfig, label: str = TARGET) -> DataFrame:
    """Configured categories that do not occur."""
    present = df.select(F.col(label).alias("category")).distinct()
    return categories_table(df, config).join(present, "category", "left_anti").select("category")


def golden_failures(
    golden: DataFrame, predicted: str = "predicted_category", number: str = "sample"
) -> DataFrame:
    """Golden rows whose prediction differs from the expected category."""
    failed = ~F.col(predicted).eqNullSafe(F.col(TARGET))
    return golden.where(failed).select(
        number, F.col(predicted).alias("predicted"), F.col(TARGET).alias("expected")
    )


def quality_gate(
    report: DataFrame,
    coverage_row: DataFrame,
    golden: DataFrame,
    config: ModelConfig,
    predicted: str = "predicted_category",
) -> DataFrame:
    """One row with each verdict: golden rows, weighted metrics, coverage and all together."""
    weighted = report.where(F.col("category") == "weighted avg")
    good = F.lit(True)
    for measure, least in config.min_weighted.items():
        good = good & (F.col(measure) >= least)
    passed = F.coalesce(F.bool_and(F.col(predicted).eqNullSafe(F.col(TARGET))), F.lit(True))
    return (
        golden.agg(passed.alias("golden_passed"))
        .withColumns(
            {
                "metrics_passed": weighted.select(good).scalar(),
                "coverage_passed": coverage_row.select(
                    F.col("coverage") >= config.min_coverage
                ).scalar(),
            }
        )
        .withColumn(
            "is_performant",
            F.col("golden_passed") & F.col("metrics_passed") & F.col("coverage_passed"),
        )
    )
