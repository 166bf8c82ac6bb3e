"""The preprocessing job on small files of all three formats."""

from datetime import date

import pytest

from tallymark.config import RETAIL, SME
from tallymark.operators import filters
from tallymark.operators.rules import load_pack
from tallymark.plans import preprocess
from tallymark.plans.training import SampleSettings

CLIENT = "client-1"
RETAIL = RETAIL.for_deployment({"app": (CLIENT,)}, "test-site")
SME = SME.for_deployment({"app": (CLIENT,), "business": ("client-2",)}, "test-site")
SETTINGS = SampleSettings("2020-01-01", "2020-01-31", per_country=50, production=50)


def write(spark, path, schema, rows, kind="csv"):
    df = spark.createDataFrame(rows, schema)
    writer = df.write.option("header", True) if kind == "csv" else df.write
    writer.format(kind).save(path)
    return path


def common(spark, root, suffix=""):
    users = [(f"u{i}", "GB" if i % 2 else "NL", CLIENT) for i in range(8)]
    accounts = [(f"a{i}", f"u{i}", None, "CURRENT_ACCOUNT", "s") for i in range(8)]
    return {
        f"users{suffix}": write(
            spark, f"{root}/users.csv", "id string, country_code string, client_id string", users
        ),
        f"accounts{suffix}": write(
            spark, f"{root}/accounts", "id string, user_id string, deleted string, type string, "
            "site_id string", accounts, "parquet",
        ),
        f"test_users{suffix}": write(
            spark, f"{root}/test_users.csv", "user_id string", [("u1",), ("u2",)]
        ),
    }


def test_retail(spark, tmp_path):
    root = str(tmp_path)
    paths = common(spark, root)
    rows = [
        (f"u{i % 8}", f"a{i % 8}", f"t{i}", "2020-01-15" if i % 2 else "2019-05-01", 1, f"text {i}",
         "", "debit", float(i), None)
        for i in range(40)
    ]
    paths["transactions"] = write(
        spark, f"{root}/tx.csv", "user_id string, account_id string, transaction_id string, "
        "date string, pending int, description string, internal_transaction string, "
        "transaction_type string, amount double, bank_specific string", rows,
    )
    events = [(r[0], r[1], r[2], r[3], 1, "2020-02-01 10:00:00", "Bills") for r in rows]
    paths["user_single_feedback_created"] = write(
        spark, f"{root}/events.json", "id__userId string, id__accountId string, "
        "id__transactionId string, id__localDate string, id__pendingType int, "
        "kafka__timestamp string, fact__category string", events, "json",
    )
    later = [(r[0], r[1], r[2], 1, r[3], "2020-03-01 10:00:00", "Pets") for r in rows[:4]]
    paths["historical_feedback"] = write(
        spark, f"{root}/history.csv", "user_id string, account_id string, transaction_id string, "
        "pending int, date string, feedback_time string, category string", later,
    )
    held = write(
        spark, f"{root}/inspected.csv", "user_id string, account_id string, transaction_id string",
        [("u3", "a3", "t3")],
    )
    metadata = preprocess.run(
        spark, RETAIL, paths, f"{root}/out", SETTINGS, "2020-04-01", inspection_path=held
    )
    found = {r.metric: r.value for r in metadata.collect()}
    # User 1 is a test user outside NL; t3 is held out.
    assert found["training_size.app.GB"] == "14"
    assert found["training_size.app.NL"] == "20"
    assert found["production_size.app.GB"] == "14"
    training = spark.read.parquet(f"{root}/out/training")
    labels = {r.transaction_id: r.target_category for r in training.collect()}
    assert "t3" not in labels and "t1" not in labels
    assert labels["t0"] == "Pets" and labels["t4"] == "Bills"
    assert spark.read.json(f"{root}/out/metadata").count() == len(found)
    assert found["held_out.app"] == "1" and found["window"] == "2020-01-01/2020-01-31"
    sources = {m.rpartition(".")[2]: v for m, v in found.items() if m.startswith("feedback.app.")}
    assert sorted(sources.values()) == ["4", "40"]
    assert {"seconds.training", "seconds.production", "seconds.inspection"} <= found.keys()


def test_default_production_window_and_required_deployment(spark, tmp_path):
    settings = SampleSettings().with_window("2020-04-01 10:00", RETAIL)
    assert (settings.window_start, settings.window_end) == ("2020-03-02", "2020-04-01")
    assert SampleSettings("2020-01-01").with_window("2020-04-01", RETAIL).window_start == "2020-01-01"
    with pytest.raises(ValueError):
        RETAIL.for_deployment({}, "site")
    with pytest.raises(ValueError):
        preprocess.run(spark, RETAIL.with_values(test_site_id=None), {}, str(tmp_path), SETTINGS, "2020-04-01")


def test_staged_folders_go_when_the_job_is_done(spark, tmp_path):
    from tallymark import staging

    with staging.kept_until_done(spark):
        path = staging.new_folder(spark, "part")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_sme(spark, tmp_path):
    root = str(tmp_path)
    paths = common(spark, root, "_app")
    texts = ["Invoice 12", "hotel", "xero and payroll", "nothing"]
    rows = [
        (f"u{i % 8}", f"a{i % 8}", f"t{i}", "2020-01-15", "Other", 1, texts[i % 4], "",
         "credit" if i % 4 == 0 else "debit", 100.0 + i, None)
        for i in range(32)
    ]
    paths["transactions_app"] = write(
        spark, f"{root}/tx.json", "user_id string, account_id string, transaction_id string, "
        "date string, category string, pending int, description string, "
        "internal_transaction string, transaction_type string, amount double, "
        "bank_counterparty_name string", rows, "json",
    )
    config = SME.with_values(domains=("app",))
    metadata = preprocess.run(
        spark, config, paths, f"{root}/out", SETTINGS, "2020-04-01 10:00",
        packs={"app": load_pack("app")},
    )
    assert any(r.metric.startswith("training_size.app") for r in metadata.collect())
    training = spark.read.parquet(f"{root}/out/training").collect()
    kinds = {(r.description, r.target_category) for r in training}
    assert kinds == {
        ("Invoice 12", "Revenue"), ("hotel", "Travel Expenses"), ("xero and payroll", "Salaries"),
    }
    generated = spark.read.parquet(f"{root}/out/feedback/app").collect()
    assert {r.category for r in generated} == {"Revenue", "Travel Expenses", "Salaries"}
    # Test users get no generated labels at all.
    assert not {r.user_id for r in training} & {"u1", "u2"}


def test_default_window():
    assert filters.default_window(date(2024, 3, 1)) == ("2024-01-31", "2024-03-01")


def test_train_and_judge(spark, tmp_path):
    from pyspark.sql import functions as F

    from tallymark.plans.train import record as train_record
    from tallymark.plans.train import train
    from tallymark.sources import golden

    words = ["grocer market", "bus ticket", "gas bill", "cinema seat"]
    labels = ["Groceries", "Transport", "Bills", "Leisure"]
    rows = [
        ("u", "a", f"t{i}", date(2020, 1, 1), 1, f"{words[i % 4]} {i}", 10.0 + i, "debit", "",
         labels[i % 4], RETAIL.index(labels[i % 4]), "app")
        for i in range(400)
    ]
    table = spark.createDataFrame(
        rows, "user_id string, account_id string, transaction_id string, date date, pending int, "
        "description string, amount double, transaction_type string, internal_transaction string, "
        "target_category string, target_category_int int, domain string",
    )
    samples = golden.from_rows(spark, golden.RETAIL_RULE_SAMPLES, RETAIL)
    outcome = train(table, samples, RETAIL, production=table, n_features=256, max_iter=10)
    verdict = outcome.verdict.first()
    assert verdict.golden_passed and verdict.metrics_passed and verdict.is_performant
    assert outcome.golden_failures.count() == 0
    missing = [(r.split, r.category) for r in outcome.missing_labels.collect()]
    absent = set(RETAIL.trainable) - set(labels)
    assert sorted(missing) == sorted((s, c) for s in ("train", "validation", "test") for c in absent)
    measured = {(r.metric, r.category): r.value for r in outcome.metrics.collect()}
    assert measured["support", "weighted avg"] == 40.0
    assert measured["recall", "weighted avg"] == 1.0
    assert abs(outcome.label_shares.agg(F.sum("share")).first()[0] - 1) < 1e-9
    assert outcome.text_lengths.count() == 25

    kept = train_record(outcome, f"{tmp_path}/record").collect()
    found = {(r.metric, r.category): r.value for r in kept}
    assert found["split_size", "test"] == "40" and found["verdict", "is_performant"] == "true"
    assert float(found["fit_seconds", ""]) >= 0 and found["recall", "weighted avg"] == "1.0"
    assert sum(m == "missing_label" for m, _ in ((r.metric, r.category) for r in kept)) == len(missing)
    assert sum(r.metric == "text_length" for r in kept) == 25
