"""Rule packs: regular expressions per category that generate labels.

A pack maps a category to

    {"transaction_type": "debit" | "credit",
     "description": {"+": [...], "-": [...]},
     "counterparty": {"+": [...], "-": [...]},
     "amount_based": [{"min": x, "max": y, "description": [...], "counterparty": [...]}]}

Patterns are matched against cleaned text, which holds only a-z and single spaces. A small pack is
one alternation per category and sign; a pack of more than INDEXED_PATTERNS patterns goes through an
index of their literals (`pattern_index`), so that a text meets only patterns that may match.
"""

from __future__ import annotations

import json
from pathlib import Path
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.config import FEEDBACK_COLUMNS, IDENTITY
from tallymark.functions.text import clean_for_rules
from tallymark.functions.vectors import let
from tallymark.operators import joins
from tallymark.operators.pattern_index import PatternIndex

Pack = Mapping[str, Mapping]

_PACK_FOLDER = Path(__file__).resolve().parent.parent / "packs"
_TEXT_COLUMNS = {"description": "description", "counterparty": "bank_counterparty_name"}
INDEXED_PATTERNS = 50


def load_pack(name: str) -> dict:
    """A pack shipped with the package (`business` or `app`)."""
    return json.loads((_PACK_FOLDER / f"{name}.json").read_text(encoding="utf-8"))


def matches_any(column: str, patterns: Sequence[str]) -> Column:
    """Does the text contain any of the patterns? An empty list matches nothing."""
    return F.col(column).rlike("|".join(patterns)) if patterns else F.lit(False)


def _inside(band: Mapping) -> Column:
    amount = F.col("amount")
    inside = amount.isNotNull()
    if "min" in band:
        inside = inside & (amount >= F.lit(float(band["min"])))
    if "max" in band:
        inside = inside & (amount <= F.lit(float(band["max"])))
    return inside


def matches_band(band: Mapping) -> Column:
    """Amount within [min, max] and a hit in the description or the counterparty."""
    hit = matches_any("description", band.get("description", ())) | matches_any(
        "bank_counterparty_name", band.get("counterparty", ())
    )
    return _inside(band) & hit


def matches_rule(rule: Mapping) -> Column:
    """A category's rule as one condition; a NULL anywhere counts as no match.

    The cheap test on the direction comes first: And does not evaluate its right side when the
    left side is false, so the regular expressions only run on rows of that direction.
    """
    wanted = F.lit(False)
    barred = F.lit(False)
    for part, column in _TEXT_COLUMNS.items():
        wanted = wanted | matches_any(column, rule[part]["+"])
        barred = barred | matches_any(column, rule[part]["-"])
    for band in rule.get("amount_based", ()):
        wanted = wanted | matches_band(band)
    return (F.col("transaction_type") == rule["transaction_type"]) & wanted & ~barred


def cleaned(df: DataFrame) -> DataFrame:
    return df.withColumns({c: clean_for_rules(F.col(c)) for c in _TEXT_COLUMNS.values()})


def _part_patterns(pack: Pack, part: str) -> list[str]:
    """All patterns of a pack on a text column, each once."""
    every = [p for rule in pack.values() for sign in ("+", "-") for p in rule[part][sign]]
    every += [p for rule in pack.values() for band in rule.get("amount_based", ()) for p in band.get(part, ())]
    return list(dict.fromkeys(every))


def _matching_by_index(pack: Pack) -> Column:
    """`matches_rule` for all rules at once, by the places of the patterns that match.

    A place names the rules that want or bar its pattern, so a row's cost follows its matches, not
    the pack. A missing text that a rule has barred patterns for is no match, as there.
    """
    patterns = {part: _part_patterns(pack, part) for part in _TEXT_COLUMNS}
    places = {part: {p: k for k, p in enumerate(some)} for part, some in patterns.items()}
    found = F.struct(*[
        PatternIndex(tuple(some)).matched(F.col(_TEXT_COLUMNS[part])).alias(part) for part, some in patterns.items()
    ])
    rules = list(pack.values())

    def numbers(some: Sequence[int]) -> Column:
        return F.array(*map(F.lit, some)).cast("array<int>")

    def named_by(part: str, sign: str, own: Column) -> Column:
        owners: list[list[int]] = [[] for _ in patterns[part]]
        for n, rule in enumerate(rules):
            for p in dict.fromkeys(rule[part][sign]):
                owners[places[part][p]].append(n)
        if not any(owners):
            return numbers(())
        table = F.array(*map(numbers, owners))
        return F.flatten(F.transform(own[part], lambda k: F.get(table, k)))

    def banded(n: int, band: Mapping, own: Column) -> Column:
        hit = F.lit(False)
        for part in _TEXT_COLUMNS:
            if some := band.get(part, ()):
                hit = hit | F.arrays_overlap(own[part], numbers([places[part][p] for p in some]))
        return F.when(_inside(band) & hit, numbers([n])).otherwise(numbers(()))

    def without_text(part: str) -> Column:
        some = [n for n, rule in enumerate(rules) if rule[part]["-"]]
        return F.when(F.col(_TEXT_COLUMNS[part]).isNull(), numbers(some)).otherwise(numbers(()))

    def categories(own: Column) -> Column:
        wanted = F.concat(
            *[named_by(part, "+", own) for part in _TEXT_COLUMNS],
            *[banded(n, band, own) for n, rule in enumerate(rules) for band in rule.get("amount_based", ())],
        )
        barred = F.concat(*[
            some for part in _TEXT_COLUMNS for some in (named_by(part, "-", own), without_text(part))
        ])
        ways = F.array(*[F.lit(rule["transaction_type"]) for rule in rules])
        fitting = F.filter(wanted, lambda n: F.get(ways, n) == F.col("transaction_type"))
        names = F.array(*map(F.lit, pack))
        return F.transform(F.array_sort(F.array_except(fitting, barred)), lambda n: F.get(names, n))

    return let(found, categories)


def matching_categories(pack: Pack) -> Column:
    """Array of all categories that match a cleaned row, in a single pass over the row."""
    if sum(len(_part_patterns(pack, part)) for part in _TEXT_COLUMNS) > INDEXED_PATTERNS:
        return _matching_by_index(pack)
    found = [F.when(matches_rule(rule), F.lit(category)) for category, rule in pack.items()]
    return F.array_compact(F.array(*found))


def hits(df: DataFrame, pack: Pack) -> DataFrame:
    """One row per transaction and matching category.

    The array stands inside explode, not in a column of its own: the planner infers a non-empty
    test for exploded columns and pushes it below the joins, where it would clean the texts anew
    for every pattern.
    """
    return df.select(*IDENTITY, F.explode(matching_categories(pack)).alias("category"))


def tagging_base(
    users: DataFrame, accounts: DataFrame, transactions: DataFrame, clients: Sequence[str]
) -> DataFrame:
    """The clients' transactions with cleaned description and counterparty."""
    return cleaned(joins.base_tagging(users, accounts, transactions, clients))


def generate_labels(
    users: DataFrame,
    accounts: DataFrame,
    transactions: DataFrame,
    pack: Pack,
    clients: Sequence[str],
    run_time: str,
) -> DataFrame:
    """Feedback rows generated by a pack for the clients' transactions."""
    found = hits(tagging_base(users, accounts, transactions, clients), pack)
    return found.withColumn("feedback_time", F.lit(run_time)).select(*FEEDBACK_COLUMNS)


def hits_per_category(df: DataFrame, pack: Pack) -> DataFrame:
    """Hits per category, and how many of them are on transactions that several categories hit."""
    marked = let(
        matching_categories(pack),
        lambda found: F.transform(
            found,
            lambda c: F.struct(
                c.alias("category"), (F.size(found) > 1).cast("int").alias("several")
            ),
        ),
    )
    return (
        df.select(F.inline(marked))
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("hits"), F.sum("several").alias("multi_hits"))
    )


def pattern_table(spark: SparkSession, pack: Pack, name: str = "") -> DataFrame:
    """A pack as rows (pack, category, transaction_type, sign, pattern)."""
    rows = [
        (name, category, rule["transaction_type"], sign, pattern)
        for category, rule in pack.items()
        for part in _TEXT_COLUMNS
        for sign in ("+", "-")
        for pattern in rule[part][sign]
    ]
    schema = "pack string, category string, transaction_type string, sign string, pattern string"
    return spark.createDataFrame(rows, schema)


def bare_patterns(table: DataFrame) -> DataFrame:
    """Distinct patterns with word boundaries and anchors removed."""
    bare = F.regexp_replace("pattern", r"\\b|[\^\$]", "")
    return table.select(
        "pack", "category", "transaction_type", "sign", bare.alias("bare")
    ).distinct()


def polarity_conflicts(table: DataFrame) -> DataFrame:
    """Patterns that a category both wants and bars."""
    return (
        bare_patterns(table)
        .groupBy("pack", "category", "bare")
        .agg(F.count_distinct("sign").alias("_signs"))
        .where(F.col("_signs") == 2)
        .select("pack", "category", "bare")
    )


def _wanted(table: DataFrame) -> DataFrame:
    return bare_patterns(table).where(F.col("sign") == "+").drop("sign")


def conflicts_within(table: DataFrame) -> DataFrame:
    """Patterns wanted by two categories of the same direction."""
    a, b = _wanted(table).alias("a"), _wanted(table).alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("pack", "transaction_type", "bare")]
    return a.join(b, same + [F.col("a.category") < F.col("b.category")]).select(
        "a.pack", "a.transaction_type", F.col("a.category").alias("category_a"),
        F.col("b.category").alias("category_b"), "a.bare",
    )


def conflicts_across(table_a: DataFrame, table_b: DataFrame) -> DataFrame:
    """Patterns wanted by different categories of two packs in the same direction."""
    a, b = _wanted(table_a).alias("a"), _wanted(table_b).alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("transaction_type", "bare")]
    return a.join(b, same + [F.col("a.category") != F.col("b.category")]).select(
        "a.transaction_type", F.col("a.category").alias("category_a"),
        F.col("b.category").alias("category_b"), "a.bare",
    )
