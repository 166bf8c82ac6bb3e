"""Stored models: a second session predicts the same, damaged versions are refused."""

import json
import subprocess
import sys
from datetime import date
from pathlib import Path

import pytest

from tallymark.config import RETAIL, SME
from tallymark.operators import classifier
from tallymark.operators.metric_learning import Schedule
from tallymark.plans.train import record, train
from tallymark.sources import golden, models

WORDS = ["grocer market", "bus ticket", "gas bill", "cinema seat"]
LABELS = ["Groceries", "Transport", "Bills", "Leisure"]
SMALL = RETAIL.with_values(hash_buckets=500, embedding_size=8, clients={"app": ("c1", "c2")}, test_site_id="t")


def table(spark, n=200):
    rows = [
        ("u", "a", f"t{i}", date(2020, 1, 1), 1, f"{WORDS[i % 4]} {i}", 10.0 + i, "debit", "", LABELS[i % 4],
         RETAIL.index(LABELS[i % 4]), "app")
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows, "user_id string, account_id string, transaction_id string, date date, pending int, "
        "description string, amount double, transaction_type string, internal_transaction string, "
        "target_category string, target_category_int int, domain string",
    )


@pytest.fixture(scope="module")
def outcomes(spark):
    samples = golden.from_rows(spark, golden.RETAIL_RULE_SAMPLES, SMALL)
    codes = spark.createDataFrame([("3000", RETAIL.index("Travel"))], "code string, mcc_index int")
    return {
        "classifier": train(table(spark), samples, SMALL, mcc=codes, n_features=256, max_iter=5),
        "embedding": train(
            table(spark), samples, SMALL, kind="embedding", schedule=Schedule(rate=0.05, most_rounds=8), batch_size=16
        ),
    }


def predictions(model, df):
    return sorted((r.transaction_id, r.category, r.category_source) for r in model.predict(df).collect())


READER = """
import json, sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2")
         .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
from tallymark.sources import models
for kind in ("classifier", "embedding"):
    model = models.load(spark, f"{sys.argv[1]}/{kind}")
    rows = model.predict(spark.read.parquet(sys.argv[2])).collect()
    print(json.dumps(sorted([r.transaction_id, r.category, r.category_source] for r in rows)))
"""


def test_second_session_predicts_the_same(spark, outcomes, tmp_path):
    table(spark, 80).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    for kind, outcome in outcomes.items():
        assert models.save(spark, outcome.model, f"{tmp_path}/{kind}") == 1
    done = subprocess.run(
        [sys.executable, "-c", READER, str(tmp_path), f"{tmp_path}/rows"], capture_output=True, text=True, timeout=300
    )
    lines = [line for line in done.stdout.splitlines() if line.startswith("[[")]
    assert len(lines) == 2, done.stderr[-2000:]
    for kind, line in zip(("classifier", "embedding"), lines):
        assert [tuple(r) for r in json.loads(line)] == predictions(outcomes[kind].model, rows)


def test_versions_and_configuration(spark, outcomes, tmp_path):
    root = str(tmp_path / "m")
    with pytest.raises(models.Damaged, match="no finished version"):
        models.load(spark, root)
    assert [models.save(spark, outcomes[k].model, root) for k in ("classifier", "embedding")] == [1, 2]
    assert models.save(spark, outcomes["classifier"].model, root, 7) == 7
    with pytest.raises(ValueError, match="exists"):
        models.save(spark, outcomes["classifier"].model, root, 2)
    (tmp_path / "m" / "9" / "tokens").mkdir(parents=True)  # broken off before its manifest
    assert models.versions(spark, root) == [1, 2, 7]
    again = models.load(spark, root, 2)
    assert again.config == SMALL and (again.low, again.high) == (outcomes["embedding"].model.low, outcomes["embedding"].model.high)
    assert models.load(spark, root).mcc.collect() == [("3000", RETAIL.index("Travel"))]
    assert models.save(spark, outcomes["embedding"].model, root) == 10
    with pytest.raises(models.Damaged):
        models.load(spark, root, 9)


def first_file(folder: Path, suffix: str) -> Path:
    return sorted(f for f in folder.rglob(f"*{suffix}") if not f.name.startswith((".", "_")))[0]


def test_damage_is_refused(spark, outcomes, tmp_path):
    def saved(kind):
        root = tmp_path / f"{kind}{len(list(tmp_path.iterdir()))}"
        models.save(spark, outcomes[kind].model, str(root))
        return root

    root = saved("embedding")
    manifest = first_file(root / "1" / "manifest", ".txt")
    whole = manifest.read_text()
    (manifest.parent / f".{manifest.name}.crc").unlink()
    for text in (whole[:-20], whole.replace('"low": ', '"low": 1'), "", whole + whole, whole.replace('"format": 1', '"format": 2')):
        manifest.write_text(text)
        with pytest.raises(models.Damaged, match="manifest"):
            models.load(spark, str(root))
    manifest.write_text(whole)
    assert models.load(spark, str(root)).config == SMALL

    other = saved("embedding")
    labels = spark.read.parquet(f"{other}/1/labels").collect()
    spark.createDataFrame([(r["index"] if i else r["index"] + 1, r.vector) for i, r in enumerate(labels)], "index long, vector array<double>").write.mode("overwrite").parquet(f"{other}/1/labels")
    with pytest.raises(models.Damaged, match="labels"):
        models.load(spark, str(other))

    third = saved("classifier")
    stage = next(f for f in (third / "1" / "scorer" / "stages").iterdir() if "LogisticRegression" in f.name)
    part = first_file(stage / "data", ".parquet")
    (part.parent / f".{part.name}.crc").unlink()
    part.write_bytes(part.read_bytes()[:-1] + b"x")
    with pytest.raises(models.Damaged, match="scorer"):
        models.load(spark, str(third))


def test_embedding_training_outcome(spark, outcomes, tmp_path):
    outcome = outcomes["embedding"]
    verdict = outcome.verdict.first()
    assert verdict.is_performant and outcome.tries == 1
    losses = [loss for _, loss in outcome.rounds]
    assert 0 <= outcome.chosen_round < len(losses) <= 8
    kept = {(r.metric, r.category): r.value for r in record(outcome, f"{tmp_path}/record").collect()}
    assert kept["chosen_round", ""] == str(outcome.chosen_round) and kept["tries", ""] == "1"
    assert float(kept["validation_loss", "0"]) == losses[0]


def test_missed_gate_is_tried_again(spark):
    strict = SMALL.with_values(min_coverage=1.1, max_retries=2)
    samples = golden.from_rows(spark, golden.RETAIL_RULE_SAMPLES, strict)
    outcome = train(table(spark, 80), samples, strict, kind="embedding", schedule=Schedule(most_rounds=1))
    assert outcome.tries == 3 and not outcome.verdict.first().is_performant
    assert SME.max_retries == 2


def test_classifier_chosen_by_validation(spark):
    from tallymark.operators import features

    made = features.features(table(spark), SMALL, features.fixed_limits(10.0, 210.0))
    train_rows, validation = made.where("pmod(hash(transaction_id), 3) > 0"), made.where("pmod(hash(transaction_id), 3) = 0")
    penalties = (10.0, 1e-3, 1.0)
    model, tried = classifier.choose(train_rows, validation, SMALL, penalties, n_features=256, max_iter=5)
    losses = [
        classifier.validation_loss(classifier.fit(train_rows, SMALL, penalty=p, n_features=256, max_iter=5), validation, SMALL)
        for p in penalties
    ]
    assert [c.validation_loss for c in tried] == pytest.approx(losses)
    assert classifier.validation_loss(model, validation, SMALL) == pytest.approx(min(losses))
    assert losses.index(min(losses)) == 1
    none, tried = classifier.choose(train_rows, validation.limit(0), SMALL, penalties[:2], n_features=256, max_iter=2)
    assert [c.validation_loss for c in tried] == [float("inf")] * 2
