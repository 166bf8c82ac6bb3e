import pytest
from pyspark.sql import functions as F

from tallymark.config import RETAIL, SME
from tallymark.functions import scores as S
from tallymark.operators import metrics
from tallymark.plans import evaluate


def uniform(spark, config):
    """One row per category, all with the same ascending scores."""
    n = len(config.categories)
    scores = [i / (n - 1) for i in range(n)]
    rows = [(c, i, scores) for i, c in enumerate(config.categories)]
    df = spark.createDataFrame(
        rows, "target_category string, target_category_int int, scores array<double>"
    )
    return df.withColumn("category", S.argmax_category(F.col("scores"), config.categories))


@pytest.mark.parametrize(
    "config, precision, recall, f1, mrr",
    [(RETAIL, 0.001, 0.032, 0.002, 0.130), (SME, 0.002, 0.042, 0.003, 0.157)],
    ids=["retail", "sme"],
)
def test_uniform_scores(spark, config, precision, recall, f1, mrr):
    results = evaluate.evaluate(uniform(spark, config), config).collect()
    values = {(r.metric, r.category): r.value for r in results}
    assert round(values["precision", "weighted avg"], 3) == precision
    assert round(values["recall", "weighted avg"], 3) == recall
    assert round(values["f1_score", "weighted avg"], 3) == f1
    assert values["support", "weighted avg"] == len(config.categories)
    assert round(values["mean_reciprocal_rank", ""], 3) == mrr
    assert round(values["recall_at_1", ""], 3) == recall
    assert round(values["coverage", ""], 3) == round(
        1 - len(config.excluded) / len(config.categories), 3
    )


def test_no_rows(spark):
    empty = uniform(spark, RETAIL).limit(0)
    assert metrics.coverage(empty, RETAIL).first().coverage == 1.0
    assert [r.recall for r in metrics.recall_at_k(empty, RETAIL).collect()] == [0.0] * 3
    report = metrics.classification_report(empty, RETAIL)
    assert report.count() == len(RETAIL.categories) + 2
    assert report.where("support > 0 or f1_score > 0").count() == 0


@pytest.mark.parametrize(
    "weighted, coverage, predicted, verdict",
    [(0.3, 0.6, "Bills", False), (0.8, 0.93, "Housing", False), (0.8, 0.93, "Bills", True),
     (0.6, 0.8, "Bills", True), (0.8, 0.79, "Bills", False), (0.8, 0.93, None, False)],
)
def test_gate(spark, weighted, coverage, predicted, verdict):
    report = spark.createDataFrame(
        [("weighted avg", weighted, weighted, weighted)],
        "category string, precision double, recall double, f1_score double",
    )
    covered = spark.createDataFrame([(coverage,)], "coverage double")
    golden = spark.createDataFrame(
        [("Bills", predicted)], "target_category string, predicted_category string"
    )
    assert metrics.quality_gate(report, covered, golden, RETAIL).first().is_performant is verdict


def test_histogram(spark):
    lengths = [0, 9, 10, 249, 250, 251, None]
    df = spark.createDataFrame(
        [(None if n is None else "x" * n,) for n in lengths], "description string"
    )
    shares = {r.edge: round(r.share * 7) for r in metrics.text_length_histogram(df).collect()}
    assert len(shares) == 25
    assert {e: n for e, n in shares.items() if n} == {10: 2, 20: 1, 250: 2}


def test_golden_failures(spark):
    golden = spark.createDataFrame(
        [(1, "A", "A"), (2, "A", "B"), (3, "A", None)],
        "sample int, target_category string, predicted_category string",
    )
    assert sorted(r.sample for r in metrics.golden_failures(golden).collect()) == [2, 3]
