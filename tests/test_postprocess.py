"""The rule chains against a plain sequential reading of the rules, on random rows."""

import random

import pytest
from pyspark.sql import functions as F

from tallymark.config import PAY_LABELS, RETAIL, SME
from tallymark.functions import scores as S
from tallymark.operators import postprocess

FIELDS = (
    "internal_transaction", "transaction_type", "account_type", "bank_specific__paylabels",
    "counter_account_type", "cleaned_description", "test_category",
)
CHOICES = {
    "internal_transaction": ["", "", "id"],
    "transaction_type": ["debit", "credit", ""],
    "account_type": ["CURRENT_ACCOUNT", "CURRENT_ACCOUNT", "SAVINGS_ACCOUNT", ""],
    "bank_specific__paylabels": ["", "", "", "[!RO]", "[!DC]", "[!ES],[!DC]", "[!RW]", "[!ES]"],
    "counter_account_type": ["CURRENT_ACCOUNT", "CURRENT_ACCOUNT", "SAVINGS_ACCOUNT", ""],
    "cleaned_description": ["text", "text", ""],
    "test_category": ["", "", "", "Payroll Tax", "Unheard of", "Loans"],
}


def first_best(scores):
    return scores.index(max(scores))


class Row:
    def __init__(self, config, fields, scores, mcc):
        self.config, self.f, self.mcc = config, fields, mcc
        self.s = list(scores) + [0.0] * len(config.excluded)
        self.open = True

    def put(self, category, value, condition, closes):
        index = category if isinstance(category, int) else self.config.index(category)
        if self.open and condition:
            self.s[index] = value
            if closes:
                self.open = False

    def assign(self, category, condition):
        self.put(category, 1.0, condition, True)

    def reject(self, category, condition):
        self.put(category, -1.0, condition, False)


def read_retail(fields, scores, mcc):
    row, f, limit = Row(RETAIL, fields, scores, mcc), fields, RETAIL.threshold
    current = f["account_type"] == "CURRENT_ACCOUNT"
    internal = f["internal_transaction"] != ""
    debit, credit = f["transaction_type"] == "debit", f["transaction_type"] == "credit"
    empty = f["cleaned_description"] == ""
    row.assign("Internal", f["account_type"] == "SAVINGS_ACCOUNT")
    row.reject("Internal", not internal and current)
    row.reject("Income", debit)
    for label, category in PAY_LABELS:
        row.assign(category, label in f["bank_specific__paylabels"])
    row.assign("Savings", current and f["counter_account_type"] == "SAVINGS_ACCOUNT")
    sure = first_best(row.s) == RETAIL.index("Savings") and max(row.s) >= limit
    row.reject("Internal", internal and sure)
    row.assign("Internal", internal and not sure)
    confident = max(row.s) >= limit
    row.assign("Savings", first_best(row.s) == RETAIL.index("Savings") and confident)
    row.assign("Internal", first_best(row.s) == RETAIL.index("Internal") and confident)
    row.assign("Internal", internal)
    row.assign("Income", credit)
    row.assign("General", empty and debit)
    confident = max(row.s) >= limit
    if confident and not empty:
        row.s[RETAIL.index("General")] = -1.0
    row.open = row.open and not confident
    row.assign(mcc, mcc > -1)
    row.assign("General", True)
    return row.s, "ModelPrediction" if confident else "ModelFallback"


def read_sme(fields, scores, mcc):
    row, f = Row(SME, fields, scores, mcc), fields
    debit, credit = f["transaction_type"] == "debit", f["transaction_type"] == "credit"
    empty = f["cleaned_description"] == ""
    for barred, condition in ((SME.outgoing, credit), (SME.incoming, debit)):
        for category in barred if condition else ():
            row.s[SME.index(category)] = -1.0
    transfer = (
        f["account_type"] == "CURRENT_ACCOUNT" and f["counter_account_type"] == "SAVINGS_ACCOUNT"
    )
    row.assign("Corporate Savings Deposits", transfer and debit)
    row.assign("Equity Financing", transfer and credit)
    row.assign("Other Expenses", empty and debit)
    row.assign("Other Income", empty and credit)
    confident = max(row.s) >= SME.threshold
    if confident and not empty:
        row.s[SME.index("Other Expenses")] = row.s[SME.index("Other Income")] = -1.0
    row.assign("Other Expenses", not confident and debit)
    row.assign("Other Income", not confident and credit)
    source = "ModelPrediction" if confident else "ModelFallback"
    if f["test_category"] in SME.categories:
        row.s = [float(c == f["test_category"]) for c in SME.categories]
        source = "ModelPrediction"
    return row.s, source


def random_rows(config, n, seed):
    """Scores on a coarse grid around the threshold, so that ties and limits occur."""
    rng = random.Random(seed)
    grid = [-1.0, 0.0, 0.2, 0.45, 0.65, 0.3]
    rows = []
    for i in range(n):
        fields = {name: rng.choice(CHOICES[name]) for name in FIELDS}
        low = rng.random() < 0.5
        scores = [rng.choice(grid[:3] if low else grid) for _ in config.trainable]
        if rng.random() < 0.3:
            scores[config.trainable.index(rng.choice(config.trainable[-5:]))] = 0.9
        if config is RETAIL and rng.random() < 0.2:
            scores[config.index("Internal")] = 0.9
        rows.append((i, fields, scores, rng.choice([-1, -1, 5, 30])))
    return rows


def frame(spark, rows):
    data = [(i, *[fields[c] for c in FIELDS], scores, mcc) for i, fields, scores, mcc in rows]
    columns = ", ".join(f"{c} string" for c in FIELDS)
    return spark.createDataFrame(data, f"i int, {columns}, scores array<double>, mcc_index int")


@pytest.mark.parametrize(
    "config, chain, read",
    [(RETAIL, postprocess.retail, read_retail), (SME, postprocess.sme, read_sme)],
    ids=["retail", "sme"],
)
def test_chain(spark, config, chain, read):
    rows = random_rows(config, 4000, 7)
    result = {r.i: r for r in chain(frame(spark, rows), config).collect()}
    assert len(result) == len(rows)
    for i, fields, scores, mcc in rows:
        expected, source = read(fields, scores, mcc)
        assert list(result[i].scores) == expected, (fields, scores, mcc)
        assert result[i].category_source == source
        assert result[i].category == config.categories[first_best(expected)]


def retail_row(spark, scores=None, mcc=-1, **changes):
    fields = {
        "internal_transaction": "", "transaction_type": "debit", "account_type": "CURRENT_ACCOUNT",
        "bank_specific__paylabels": "", "counter_account_type": "CURRENT_ACCOUNT",
        "cleaned_description": "text", "test_category": "",
    }
    given = [0.1] * len(RETAIL.trainable)
    for category, value in (scores or {}).items():
        given[RETAIL.index(category)] = value
    rows = [(0, {**fields, **changes}, given, mcc)]
    return postprocess.retail(frame(spark, rows), RETAIL).first()


def test_general_pay_label_is_undone_when_there_is_text(spark):
    """The label closes the row with a score of 1, which then counts as confidence and bars it."""
    row = retail_row(spark, {"Coffee": 0.3}, bank_specific__paylabels="[!DC]")
    assert (row.category, row.category_source) == ("Coffee", "ModelPrediction")
    row = retail_row(spark, bank_specific__paylabels="[!DC]", cleaned_description="")
    assert row.category == "General"


def test_merchant_code_is_a_fallback(spark):
    travel = RETAIL.index("Travel")
    assert retail_row(spark, mcc=travel).category == "Travel"
    assert retail_row(spark, {"Pets": 0.5}, mcc=travel).category == "Pets"
    row = retail_row(spark)
    assert (row.category, row.category_source) == ("General", "ModelFallback")


def test_argmax_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([([0.1, 0.7, 0.7],)], "s array<double>")
    row = df.select(
        S.argmax_category(F.col("s"), ["a", "b", "c"]).alias("best"),
        S.top_k(F.col("s"), ["a", "b", "c"], 2).alias("top"),
    ).first()
    assert row.best == "b" and row.top == ["b", "c"]


def test_chain_shuffles_nothing(spark):
    df = postprocess.retail(frame(spark, random_rows(RETAIL, 10, 1)), RETAIL)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_filters_stay_above_the_chain(spark):
    df = postprocess.retail(frame(spark, random_rows(RETAIL, 50, 2)), RETAIL)
    wanted = df.where((F.col("category") == "Internal") & (F.col("category_source") != "x"))
    assert len(wanted._jdf.queryExecution().optimizedPlan().toString()) < 100_000
    assert wanted.count() == sum(r.category == "Internal" for r in df.collect())
