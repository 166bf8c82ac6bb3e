"""Text cleaning and text features as native column expressions."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.config import (
    INTEREST_PATTERN,
    PAY_LABELS,
    TEST_DESCRIPTION_PREFIX,
    ModelConfig,
)

# 15 hex digits are 60 bits: the longest md5 prefix that fits a signed long.
_HEX_DIGITS = 15


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    """Code points whose canonical decomposition without marks is one other character."""
    source, target = [], []
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        decomposed = unicodedata.normalize("NFD", char)
        if decomposed == char:
            continue
        base = "".join(c for c in decomposed if unicodedata.category(c) != "Mn")
        if len(base) == 1 and base != char:
            source.append(char)
            target.append(base)
    return "".join(source), "".join(target)


def _fold(col: Column, marks: str) -> Column:
    source, target = _fold_table()
    text = F.coalesce(col, F.lit(""))
    folded = F.regexp_replace(F.translate(text, source, target), marks + "+", "")
    # Plain ASCII has as many bytes as characters, so most rows skip both passes.
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(folded)


def fold_accents(col: Column) -> Column:
    """Drop nonspacing marks; NULL becomes ''.

    Characters that decompose into several base characters stay composed: Hangul syllables, which
    is canonically the same text, and U+0CCB and U+0DDD, which so keep a mark. Rules and models read
    a-z only and see no difference.
    """
    return _fold(col, r"\p{Mn}")


def clean_for_rules(col: Column) -> Column:
    """Text the rule packs match on: only a-z and single spaces.

    Digit runs become the word `digits`; a word of three or more equal letters becomes
    `repeating chars`.
    """
    text = F.lower(fold_accents(col))
    text = F.regexp_replace(text, "[0-9]+", " digits ")
    text = F.regexp_replace(text, "[^a-z]+", " ")
    text = F.regexp_replace(text, r"\b([a-z])\1{2,}\b", "repeating chars")
    return F.trim(text)


def clean_for_model(col: Column) -> Column:
    """Text the model sees: letters only, lower case, single spaces."""
    text = F.regexp_replace(_fold(col, r"\p{M}"), "[^a-zA-Z]+", " ")
    return F.trim(F.lower(text))


def model_text(config: ModelConfig) -> Column:
    """The text a model reads: the description, followed by the counterparty where configured."""
    description = F.coalesce(F.col("description"), F.lit(""))
    if not config.join_counterparty:
        return description
    counterparty = F.coalesce(F.col("bank_counterparty_name"), F.lit(""))
    return F.concat_ws(" ", description, counterparty)


def tokenize(cleaned: Column, max_tokens: int) -> Column:
    """Words of cleaned text; the last allowed token keeps the remainder of the text."""
    no_tokens = F.array().cast("array<string>")
    return F.when(cleaned == "", no_tokens).otherwise(F.split(cleaned, " ", max_tokens))


def ngrams(tokens: Column) -> Column:
    """All unigrams, then all bigrams."""
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    bigrams = F.zip_with(
        F.slice(tokens, F.lit(1), pairs),
        F.slice(tokens, F.lit(2), pairs),
        lambda left, right: F.concat_ws(" ", left, right),
    )
    return F.concat(tokens, bigrams)


def hash60(text: Column) -> Column:
    """First 60 bits of md5 as a non-negative long; the same in every engine and partitioning."""
    return F.conv(F.substring(F.md5(text), 1, _HEX_DIGITS), 16, 10).cast("long")


def hash_buckets(grams: Column, n_buckets: int, length: int) -> Column:
    """Bucket number of every n-gram, padded with 0 or cut to `length`."""
    hashed = F.transform(grams, lambda gram: (hash60(gram) % n_buckets).cast("int"))
    return F.slice(F.concat(hashed, F.array_repeat(F.lit(0), length)), 1, length)


def test_marker(text: Column, prefix: str = TEST_DESCRIPTION_PREFIX) -> Column:
    """Category named by a test description, else ''."""
    pattern = "^" + re.escape(prefix) + r"([a-zA-Z ]+)\z"
    return F.coalesce(F.trim(F.regexp_extract(text, pattern, 1)), F.lit(""))


def pay_label_category(labels: Column, mapping=PAY_LABELS) -> Column:
    """Category of the first listed pay label found in `labels`, else NULL."""
    return F.coalesce(*[F.when(labels.contains(label), F.lit(cat)) for label, cat in mapping])


def is_taxed_interest(description: Column) -> Column:
    return F.coalesce(F.lower(description).rlike("^" + INTEREST_PATTERN), F.lit(False))
