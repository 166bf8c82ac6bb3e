import unicodedata

import pytest
from pyspark.sql import functions as F

from tallymark.config import RETAIL, SME, TEST_DESCRIPTION_PREFIX
from tallymark.functions import text


def apply(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    rows = df.select("i", expression(F.col("t")).alias("o")).collect()
    return [r.o for r in sorted(rows, key=lambda r: r.i)]


def test_fold_matches_decomposition(spark):
    values = [
        "café", "señor Ñandú", "meeëten", "straße", "Ελλάδα", "Żółć", "é ä", "plain",
        "", None, "Việt Nam", "Å̧",
    ]
    expected = [
        "".join(
            c for c in unicodedata.normalize("NFD", v or "") if unicodedata.category(c) != "Mn"
        )
        for v in values
    ]
    assert apply(spark, values, text.fold_accents) == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        ("Café  Crème", "cafe creme"),
        ("44ab", "digits ab"),
        ("yyy-12-qqqq", "repeating chars digits repeating chars"),
        ("aab", "aab"),
        ("zzzz1", "repeating chars digits"),
        ("A&B_c", "a b c"),
        ("  ", ""),
        (None, ""),
    ],
)
def test_clean_for_rules(spark, given, expected):
    assert apply(spark, [given], text.clean_for_rules) == [expected]


def test_clean_for_model_drops_digits(spark):
    assert apply(spark, ["Gas & Água 24/7!", "?? 5", None], text.clean_for_model) == [
        "gas agua", "", "",
    ]


def test_last_token_keeps_the_rest(spark):
    words = " ".join(f"w{chr(97 + i % 26)}" for i in range(40))
    tokens = apply(spark, [words, "", "one two"], lambda c: text.tokenize(c, 30))
    assert [len(t) for t in tokens] == [30, 0, 2]
    assert tokens[0][-1] == " ".join(words.split(" ")[29:])


def test_ngrams(spark):
    def grams(c):
        return text.ngrams(text.tokenize(c, 30))

    assert apply(spark, ["a b c", "a", ""], grams) == [["a", "b", "c", "a b", "b c"], ["a"], []]


def test_repeated_word_gives_five_buckets(spark):
    """Three words, one of them twice: five n-grams, of which four differ."""

    def buckets(c):
        grams = text.ngrams(text.tokenize(text.clean_for_model(c), 30))
        return text.hash_buckets(grams, RETAIL.hash_buckets, RETAIL.sequence_length)

    (row,) = apply(spark, ["Solar Power Power 7"], buckets)
    assert len(row) == 60
    assert sum(b != 0 for b in row) == 5
    assert len(set(row)) == 5


def test_marker(spark):
    p = TEST_DESCRIPTION_PREFIX
    values = [p + "Loans", p + " Sales Tax ", p + "Loans\n", p + "1", "Loans", p, None]
    assert apply(spark, values, text.test_marker) == ["Loans", "Sales Tax", "", "", "", "", ""]


def test_first_listed_label_wins(spark):
    found = apply(spark, ["[!ES],[!RO]", "x[!ES]", "", None], text.pay_label_category)
    assert found == ["Internal", "Savings", None, None]


def test_model_text_with_counterparty(spark):
    df = spark.createDataFrame(
        [("a", None), (None, "b"), ("a", "b")], "description string, bank_counterparty_name string"
    )
    rows = df.select(text.model_text(SME).alias("s"), text.model_text(RETAIL).alias("r")).collect()
    assert [(r.s, r.r) for r in rows] == [("a ", "a"), (" b", ""), ("a b", "a")]
