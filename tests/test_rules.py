import re

import pytest
from pyspark.sql import functions as F

from tallymark.catalog import shapes as fx
from tallymark.config import SME
from tallymark.operators import rules

SCHEMA = (
    "user_id int, account_id int, transaction_id int, date string, pending int, "
    "transaction_type string, amount double, description string, bank_counterparty_name string"
)


def rows(spark, *items):
    data = [(1, 1, i, "2020-01-01", 1, *item) for i, item in enumerate(items)]
    return spark.createDataFrame(data, SCHEMA)


RULE = {
    "transaction_type": "debit",
    "description": {"+": ["dinner"], "-": ["leave out"]},
    "counterparty": {"+": ["savings.*pot"], "-": []},
}


def matched(df, rule):
    return [r.transaction_id for r in df.where(rules.matches_rule(rule)).sort("transaction_id").collect()]


def test_rule(spark):
    df = rules.cleaned(
        rows(
            spark,
            ("debit", 1.0, "Dinner", None),
            ("credit", 1.0, "Dinner", None),
            ("debit", 1.0, "x", "Savings 12 Pot"),
            ("debit", 1.0, "leave out", "savings pot"),
            ("debit", 1.0, None, None),
        )
    )
    assert matched(df, RULE) == [0, 2]


def test_band_is_inclusive_and_needs_an_amount(spark):
    band = {"min": 10, "max": 20, "description": ["rent"], "counterparty": []}
    rule = {
        "transaction_type": "debit", "description": {"+": [], "-": []},
        "counterparty": {"+": [], "-": []}, "amount_based": [band],
    }
    df = rows(
        spark, *[("debit", a, "rent", "") for a in (9.99, 10.0, 20.0, 20.01, None)],
        ("debit", 15.0, "other", ""),
    )
    assert matched(df, rule) == [1, 2]


def test_a_transaction_may_hit_several_categories(spark):
    pack = {"A": RULE, "B": {**RULE, "counterparty": {"+": [], "-": ["bad"]}}, "C": {
        **RULE, "transaction_type": "credit"}}
    df = rows(spark, ("debit", 1.0, "dinner", "bad"), ("debit", 1.0, "dinner", ""))
    found = sorted((r.transaction_id, r.category) for r in rules.hits(df, pack).collect())
    assert found == [(0, "A"), (1, "A"), (1, "B")]
    counts = {r.category: (r.hits, r.multi_hits) for r in rules.hits_per_category(df, pack).collect()}
    assert counts == {"A": (2, 1), "B": (1, 1)}


@pytest.mark.parametrize("name", ["business", "app"])
def test_packs_are_sound(spark, name):
    pack = rules.load_pack(name)
    assert len(pack) == 21
    assert sum(r["transaction_type"] == "debit" for r in pack.values()) == 16
    assert set(pack) <= set(SME.categories)
    patterns = [
        p for r in pack.values() for part in ("description", "counterparty")
        for sign in "+-" for p in r[part][sign]
    ]
    for pattern in patterns:
        re.compile(pattern)
        # Cleaned text has only letters and spaces, so anything else could never match.
        assert not re.search(r"[0-9A-Z_&]", pattern)
    table = rules.pattern_table(spark, pack, name)
    assert rules.polarity_conflicts(table).count() == 0
    assert rules.conflicts_within(table).count() == 0


def test_conflicts_are_found(spark):
    def rule(direction, plus, minus=()):
        return {
            "transaction_type": direction, "description": {"+": list(plus), "-": list(minus)},
            "counterparty": {"+": [], "-": []},
        }

    a = {"X": rule("debit", [r"\bcar\b", "bus"], ["^car$"]), "Y": rule("debit", ["bus$"]),
         "Z": rule("credit", ["bus"])}
    b = {"X": rule("debit", ["bus"]), "W": rule("credit", [r"\bbus"])}
    ta, tb = rules.pattern_table(spark, a, "a"), rules.pattern_table(spark, b, "b")
    assert [(r.category, r.bare) for r in rules.polarity_conflicts(ta).collect()] == [("X", "car")]
    within = rules.conflicts_within(ta).collect()
    assert [(r.category_a, r.category_b, r.bare) for r in within] == [("X", "Y", "bus")]
    across = sorted((r.category_a, r.category_b) for r in rules.conflicts_across(ta, tb).collect())
    assert across == [("Y", "X"), ("Z", "W")]


def test_rules_run_after_the_joins_and_once(spark, folder):
    labels = rules.generate_labels(
        fx.users(spark, folder), fx.accounts(spark, folder), fx.transactions(spark, folder),
        fx.pack("business"), fx.CLIENTS, fx.RUN_TIME,
    )
    plan = labels._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if line.strip(" :+-").startswith("Filter")]
    assert not any("RLIKE" in line or "regexp_replace" in line for line in filters)
    assert plan.count("translate(") == 2
    assert labels.select(F.count("*")).first()[0] > 0
