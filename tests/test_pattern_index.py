"""The literal index: hits are those of `rlike`, whatever the pattern."""

import random

import pytest
from pyspark.sql import functions as F

from tallymark.operators import rules
from tallymark.operators.pattern_index import PatternIndex, is_plain, literals

WORDS = ["gas", "bill", "rent", "coffee", "train", "ticket", "payment", "groceries", "fee", "refund", "loan", "interest"]


@pytest.mark.parametrize(
    "pattern, want",
    [
        (r"\bfuel\b", ["fuel"]), ("^cold$", ["cold"]), ("drawings?", ["drawing"]), ("(gas|coal) bill", [" bill"]),
        ("(?:tion|the) (in|of)", None), ("council tax|hmrc", ["council tax", "hmrc"]), ("a+b", None), ("(abcd)+", ["abcd"]),
        ("(abcd)*", None), ("abcd|x", None), (".*", None), ("", None), ("(?i)gasbill", None), ("a[bc]d", None),
        ("ab.cdef", ["cdef"]), (r"\d{3}loan", ["loan"]), (r"\Qfoo\E", None), ("(open", None), ("loan(?=s)", None),
        ("[a&&[b]]foo", None), ("x{2}train", ["train"]), ("tickets*", ["ticket"]), (r"pay\.ment", ["pay.ment"]),
    ],
)
def test_literals(pattern, want):
    assert literals(pattern) == want


def test_every_match_holds_a_literal():
    import re

    pick = random.Random(2)
    for _ in range(2000):
        pattern = made_pattern(pick)
        found = literals(pattern)
        if found is None:
            continue
        for _ in range(20):
            text = made_text(pick)
            if re.search(pattern, text):
                assert any(x in text for x in found), (pattern, text)


def made_pattern(pick):
    word = pick.choice(WORDS)
    kind = pick.randrange(8)
    if kind == 0:
        return word
    if kind == 1:
        return rf"\b{word}\b"
    if kind == 2:
        return f"^{word}"
    if kind == 3:
        return f"{word}s? {pick.choice(WORDS)}"
    if kind == 4:
        return f"({word}|{pick.choice(WORDS)}) {pick.choice(WORDS)}"
    if kind == 5:
        return f"{word}.*{pick.choice(WORDS)}$"
    if kind == 6:
        return f"{word[:2]}[a-z]+ {pick.choice('abcdefg')}"
    return f"{word}|{pick.choice(WORDS)}|{pick.choice(WORDS)[:3]}"


def made_text(pick):
    return " ".join(pick.choice(WORDS) + pick.choice(["", "", "s", "x"]) for _ in range(pick.randrange(6)))


@pytest.mark.parametrize("automaton", [True, False])
def test_hits_equal_rlike(spark, automaton):
    pick = random.Random(4)
    patterns = list(dict.fromkeys(made_pattern(pick) for _ in range(150)))
    assert any(is_plain(p) for p in patterns) and any(literals(p) is None for p in patterns)
    rows = spark.createDataFrame([(k, made_text(pick)) for k in range(300)] + [(300, None), (301, "")], "k int, t string")
    index = PatternIndex(tuple(patterns), automaton)
    got = {r.k: sorted(r.m) for r in rows.select("k", index.matched(F.col("t")).alias("m")).collect()}
    want = rows.select("k", *[F.col("t").rlike(p).alias(f"p{n}") for n, p in enumerate(patterns)]).collect()
    assert got == {r.k: [n for n in range(len(patterns)) if r[f"p{n}"]] for r in want}
    for some in ((), ("zzz",), ("a.c",)):
        found = rows.select(PatternIndex(some, automaton).matched(F.col("t")).alias("m")).collect()
        assert all(len(r.m) <= len(some) for r in found)


def big_pack(pick, categories=24, patterns=45):
    def some(n):
        return [made_pattern(pick) if pick.random() < 0.3 else "".join(pick.choices("abcdefghij ", k=9)).strip() + pick.choice(["", r"\b"]) for _ in range(n)]

    return {
        f"C{k}": {
            "transaction_type": pick.choice(["debit", "credit"]),
            "description": {"+": some(patterns), "-": some(2)}, "counterparty": {"+": some(5), "-": some(1)},
            **({"amount_based": [{"min": 10, "max": 60, "description": some(3), "counterparty": some(1)}]} if k % 3 == 0 else {}),
        }
        for k in range(categories)
    }


def test_large_pack_gives_the_same_categories(spark, monkeypatch):
    pick = random.Random(6)
    pack = big_pack(pick)
    assert sum(len(rules._part_patterns(pack, p)) for p in ("description", "counterparty")) > 500
    rows = spark.createDataFrame(
        [
            (k, pick.choice(["debit", "credit"]), pick.choice([None, 5.0, 10.0, 42.0, 60.0, 99.0]), made_text(pick) or None, pick.choice([None, "", *WORDS]))
            for k in range(400)
        ],
        "k int, transaction_type string, amount double, description string, bank_counterparty_name string",
    )
    found = rows.select("k", rules.matching_categories(pack).alias("c"))
    assert "ArrowEvalPython" in found._jdf.queryExecution().executedPlan().toString()
    got = {r.k: r.c for r in found.collect()}
    monkeypatch.setattr(rules, "INDEXED_PATTERNS", 10**9)
    want = {r.k: r.c for r in rows.select("k", rules.matching_categories(pack).alias("c")).collect()}
    assert got == want and any(got.values())


def test_cost_of_a_row_does_not_follow_the_pack(spark):
    """No rule of an indexed pack is tried on its own; bands alone are looked at one by one."""
    pack = big_pack(random.Random(4))
    for rule in pack.values():
        rule.pop("amount_based", None)
    schema = "transaction_type string, description string, bank_counterparty_name string, amount double"
    rows = spark.createDataFrame([("debit", "a", None, 1.0)], schema)
    plan = rows.select(rules.matching_categories(pack))._jdf.queryExecution().optimizedPlan().toString()
    assert "arrays_overlap" not in plan
