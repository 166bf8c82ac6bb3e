import math
import random

import pytest
from pyspark.sql import functions as F

from tallymark.config import COUNTERPARTY_CATEGORIES, RETAIL, SME, TAX_LABELS
from tallymark.operators import embedding, features, filters, joins, overrides
from tallymark.plans import predict
from tallymark.sources import golden, tables

LIMITS = (0.0, 1000.0)


def flat_scorer(config):
    """A model without an opinion: every score is low."""
    low = F.array_repeat(F.lit(0.05), len(config.trainable))
    return lambda df: df.withColumn("scores", low)


def no_codes(spark):
    return spark.createDataFrame([("3000", RETAIL.index("Travel"))], "code string, mcc_index int")


def test_retail_rule_samples(spark):
    rows = golden.from_rows(spark, golden.RETAIL_RULE_SAMPLES, RETAIL)
    predicted = predict.predict_retail(
        rows, RETAIL, features.fixed_limits(*LIMITS), flat_scorer(RETAIL), no_codes(spark)
    ).collect()
    assert len(predicted) == len(golden.RETAIL_RULE_SAMPLES)
    for row in predicted:
        assert row.category == row.target_category, row
    assert len({r.transaction_id for r in predicted}) == len(predicted)


def test_sme_rule_samples(spark):
    rows = golden.from_rows(spark, golden.SME_RULE_SAMPLES, SME)
    predicted = predict.predict_sme(
        rows, SME, features.fixed_limits(*LIMITS), flat_scorer(SME)
    ).collect()
    assert len(predicted) == len(golden.SME_RULE_SAMPLES)
    for row in predicted:
        assert row.category == row.target_category, row


def test_empty_input(spark):
    rows = golden.from_rows(spark, golden.SME_RULE_SAMPLES, SME).limit(0)
    predicted = predict.predict_sme(
        rows, SME, features.fixed_limits(*LIMITS), flat_scorer(SME)
    )
    assert predicted.count() == 0
    assert {"category", "category_source"} <= set(predicted.columns)


def test_country(spark):
    rows = spark.createDataFrame(
        [
            ("NL", None, None, "NL"), (None, "NL86X", None, "NL"), ("", "GB1", "CURRENT_ACCOUNT", "GB"),
            ("", "", "CURRENT_ACCOUNT", "GB"), ("", None, "SAVINGS_ACCOUNT", ""), ("", "", None, ""),
            ("FR", "NL86X", "CURRENT_ACCOUNT", "FR"),
        ],
        "country_code string, bank_counterparty_iban string, counter_account_type string, want string",
    )
    for row in overrides.with_country(rows).collect():
        assert row.country_code == row.want
    bare = spark.createDataFrame([("CURRENT_ACCOUNT",)], "counter_account_type string")
    assert overrides.with_country(bare).first().country_code == "GB"


def test_override_tables(spark):
    assert set(COUNTERPARTY_CATEGORIES.values()) <= set(SME.categories)
    assert {c for labels in TAX_LABELS.values() for c in labels.values()} <= set(SME.categories)
    merged = {
        (r.transaction_type, r.tax_label): r.tax_category
        for r in overrides.tax_table(spark).where("country_code = ''").collect()
    }
    assert len(merged) == 15 + 21 + 3 + 5
    keys = overrides.tax_table(spark).select("country_code", "transaction_type", "tax_label")
    assert keys.count() == keys.distinct().count()


def test_unmapped_tax_label_gives_null(spark):
    rows = spark.createDataFrame(
        [("GB", "debit", "Nonsense", "Loans", "s"), ("FR", "debit", "VAT", "Loans", "s"),
         ("GB", "debit", None, "Loans", "s"), ("", "debit", "VAT", "Loans", "s")],
        "country_code string, transaction_type string, tax_label string, category string, "
        "category_source string",
    )
    found = {
        (r.country_code, r.tax_label): (r.category, r.category_source)
        for r in overrides.apply_tax_labels(rows).collect()
    }
    assert found == {
        ("GB", "Nonsense"): (None, "ModelPrediction"), ("FR", "VAT"): ("Loans", "s"),
        ("GB", None): ("Loans", "s"), ("", "VAT"): ("Sales Tax", "ModelPrediction"),
    }


def embedding_model(spark, seed=3):
    rng = random.Random(seed)
    size, vocabulary, labels = 4, 50, len(RETAIL.trainable)
    vector = lambda: [rng.uniform(-1, 1) for _ in range(size)]
    tokens = spark.createDataFrame(
        [(i, vector()) for i in range(0, vocabulary, 2)], "bucket int, vector array<double>"
    )
    names = spark.createDataFrame(
        [(i, vector()) for i in range(labels)], "index int, vector array<double>"
    )
    weights = [[rng.uniform(-1, 1) for _ in range(size + 3)] for _ in range(size)]
    model = embedding.EmbeddingModel(tokens, names, weights=weights, bias=[0.1] * size)
    return model, RETAIL.with_values(hash_buckets=vocabulary, embedding_size=size)


def test_local_and_joined_scorer_agree(spark, monkeypatch):
    model, config = embedding_model(spark)
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["gas", "tea", "bus", "pay", "rent"], k=k)) for k in range(9)]
    rows = spark.createDataFrame(
        [(i, t, float(i), "debit", "") for i, t in enumerate(texts + ["", "!!"])],
        "transaction_id int, description string, amount double, transaction_type string, "
        "internal_transaction string",
    )
    made = features.features(rows, config, features.limits_of(rows))
    local = {r.transaction_id: r.scores for r in model.score(made, ["transaction_id"], config).collect()}
    monkeypatch.setattr(embedding, "_COPY_BYTES", 0)
    joined = {r.transaction_id: r.scores for r in model.score(made, ["transaction_id"], config).collect()}
    assert local.keys() == joined.keys() and len(local) == 11
    for key, values in local.items():
        assert values == pytest.approx(joined[key], abs=1e-9)
        assert len(values) == len(RETAIL.trainable)


@pytest.mark.parametrize("copied", [True, False])
def test_gaps_lengths_and_repeats_of_a_model(spark, monkeypatch, copied):
    """Missing labels score 0, label lengths do not count, odd buckets are averaged or unknown."""
    if not copied:
        monkeypatch.setattr(embedding, "_COPY_BYTES", 0)
    tokens = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.0, 3.0]), (2, [0.0, 1.0]), (0, [9.0, 9.0]), (70, [5.0, 5.0]), (-1, [7.0, 7.0])],
        "bucket int, vector array<double>",
    )
    names = spark.createDataFrame(
        [(0, [4.0, 0.0]), (2, [0.0, 0.5]), (3, [1.0, 1.0]), (3, [10.0, 0.0]), (99, [1.0, 0.0]), (-1, [1.0, 0.0])],
        "index int, vector array<double>",
    )
    config = RETAIL.with_values(hash_buckets=50, embedding_size=2)
    rows = spark.createDataFrame(
        [(1, [1, 0], [0.0]), (2, [1, 2, 70, 50, -1, 0], [0.0]), (3, [0], [0.0]), (4, [2, 2], [0.0])],
        "id int, preprocessed_description array<int>, preprocessed_numeric_features array<double>",
    )
    model = embedding.EmbeddingModel(tokens, names)
    found = {r.id: r.scores for r in model.score(rows, ["id"], config).collect()}
    third = [math.cos(math.pi / 8), math.sin(math.pi / 8)]
    units = {1: [1.0, 0.0], 2: [1 / math.sqrt(5), 2 / math.sqrt(5)], 3: [0.0, 0.0], 4: [0.0, 1.0]}
    for key, u in units.items():
        wanted = [u[0], 0.0, u[1], u[0] * third[0] + u[1] * third[1]]
        assert found[key] == pytest.approx(wanted + [0.0] * (len(RETAIL.trainable) - 4), abs=1e-9)


def test_single_precision_vectors_are_copied_as_such(spark, monkeypatch):
    """A table that is too large with doubles moves no rows if singles hold its numbers; others are joined."""
    model, config = embedding_model(spark)
    n, size = config.hash_buckets, config.embedding_size
    single = model.token_vectors.withColumn("vector", F.col("vector").cast("array<float>"))
    rows = spark.createDataFrame(
        [(i, [k % n for k in range(i, 3 * i)], [0.5, 1.0, 0.0]) for i in range(9)],
        "id int, preprocessed_description array<int>, preprocessed_numeric_features array<double>",
    )
    for tokens, copied in ((single, True), (model.token_vectors, False)):
        sized = embedding.EmbeddingModel(tokens, model.label_vectors, weights=model.weights, bias=model.bias)
        monkeypatch.setattr(embedding, "_COPY_BYTES", n * (size * 8 + 32))
        wanted = {r.id: r.scores for r in sized.score(rows, ["id"], config).collect()}
        monkeypatch.setattr(embedding, "_COPY_BYTES", n * (size * 8 + 32) - 1)
        scored = sized.score(rows, ["id"], config)
        assert ("Join" not in scored._jdf.queryExecution().toString()) == copied
        found = {r.id: r.scores for r in scored.collect()}
        assert found.keys() == wanted.keys() and len(found) == 9
        assert all(found[k] == pytest.approx(wanted[k], abs=1e-12) for k in found)


def test_means_by_a_copied_table_equal_joined_ones(spark, monkeypatch):
    """Repeated and null keys, rows without buckets, unknown buckets; no join, so no vector moves."""
    tokens = spark.createDataFrame(
        [(k, [float(k), 1 / k]) for k in range(1, 40)] + [(7, [1.0, 1.0])], "bucket int, vector array<double>"
    )
    rows = spark.createDataFrame(
        [(k % 11 or None, None if k % 7 == 0 else [k % 50, 0, k % 3, 45, -2, None]) for k in range(90)] + [(99, [0, 60])],
        "id int, b array<int>",
    )
    monkeypatch.setattr(embedding, "_BROADCAST_BYTES", 0)

    def means():
        found = embedding.masked_mean(rows, ["id"], "b", tokens, 2, 50, "mean")
        return {r.id: r.mean for r in found.collect()}, "Join" in found._jdf.queryExecution().toString()

    copied, joins_copied = means()
    monkeypatch.setattr(embedding, "_COPY_BYTES", 0)
    joined, joins_joined = means()
    assert not joins_copied and joins_joined
    assert copied.keys() == joined.keys() and len(copied) == 12 and copied[99] == [0.0, 0.0]
    assert all(copied[k] == pytest.approx(joined[k], abs=1e-12) for k in copied)


def test_merchant_codes_are_read_once(spark):
    """What makes the codes may be a join of all transactions: readers read what was written."""
    codes = spark.createDataFrame([("0742", 1), ("742", 2)], "code string, mcc_index int")
    assert all("merchant-codes" in f for f in joins.merchant_codes(codes).inputFiles())
    assert joins.merchant_codes(codes).inputFiles()


def test_merchant_codes_of_any_form(spark):
    codes = spark.createDataFrame(
        [("0742", 1), ("742", 2), ("12345", 3), ("A100", 4), ("A100", 4), (None, 5)], "code string, mcc_index int"
    )
    for most in (100, 2):
        found = joins.merchant_codes(codes, most).collect()
        assert {r.code: r.mcc_index for r in found} == {"0742": 1, "742": 2, "12345": 3, "A100": 4}
    double = codes.union(spark.createDataFrame([("742", 9)], codes.schema))
    with pytest.raises(Exception, match="two categories for the merchant code 742"):
        joins.merchant_codes(double).collect()


def test_repeated_token_is_the_token(spark):
    tokens = spark.createDataFrame([(32, [1.0, 2.0]), (22, [3.0, 0.0])], "bucket int, vector array<double>")
    rows = spark.createDataFrame(
        [(1, [0, 0]), (2, [32, 0]), (3, [32, 32]), (4, [32, 22])], "id int, b array<int>"
    )
    means = embedding.masked_mean(rows, ["id"], "b", tokens, 2, 50, "mean").collect()
    assert {r.id: r.mean for r in means} == {
        1: [0.0, 0.0], 2: [1.0, 2.0], 3: [1.0, 2.0], 4: [2.0, 1.0],
    }


def test_filters_keep_and_drop_missing_values(spark):
    accounts = spark.createDataFrame(
        [(1, None, "a"), (2, None, None), (3, "y", "a"), (4, None, "t")],
        "account_id int, deleted string, site_id string",
    )
    assert [r.account_id for r in filters.relevant_accounts(accounts, "t").collect()] == [1]
    labels = spark.createDataFrame([("General",), ("Bills",), (None,)], "target_category string")
    kept = [r[0] for r in filters.without_excluded_labels(labels, RETAIL).collect()]
    assert kept == ["Bills", None]
    times = spark.sql(
        "select timestamp'2020-01-02 23:59:00' as date union all select timestamp'2020-01-03 00:00:00'"
    )
    assert filters.in_date_range(times, "2020-01-01", "2020-01-02").count() == 1


def test_formats():
    assert tables.format_of("a/b/*.csv") == "csv"
    assert tables.format_of("a/b.json") == "json"
    assert tables.format_of("a/b") == tables.format_of("a/b.parquet") == "parquet"
