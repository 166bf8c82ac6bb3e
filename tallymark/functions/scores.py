"""Score arrays: one score per category, in category order."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.config import ModelConfig


def literal_array(values: Sequence[str]) -> Column:
    """Constant array of texts, as one expression: one call into the JVM, not one per element."""
    quoted = ["'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values]
    return F.expr(f"array({', '.join(quoted)})")


def add_uncategorized(scores: Column, config: ModelConfig) -> Column:
    """Append a zero score for every excluded category."""
    return F.concat(scores, F.array_repeat(F.lit(0.0), len(config.excluded)))


def apply_rule(
    scores: Column,
    indices: Iterable[int],
    condition: Column,
    value: Column | float,
    size: int,
    open_rows: Column | None = None,
) -> tuple[Column, Column | None]:
    """Where `condition` holds (on rows still open, if given) set the scores at `indices`.

    `value` is a number, or an array with one value per category. Returns the new scores and the
    new open flag.
    """
    chosen = set(indices)
    hit = condition if open_rows is None else open_rows & condition

    def replacement(i: int) -> Column:
        if isinstance(value, Column):
            return F.get(value, F.lit(i))
        return F.lit(float(value))

    updated = F.array(
        *[replacement(i) if i in chosen else F.get(scores, F.lit(i)) for i in range(size)]
    )
    scores = F.when(hit, updated).otherwise(scores)
    return scores, None if open_rows is None else open_rows & ~condition


def direction_mask(config: ModelConfig, scores: str, transaction_type: str) -> Column:
    """Credit rows lose every outgoing category, debit rows every incoming one."""
    outgoing = set(config.outgoing)
    masked = [
        f"IF({transaction_type} = '{'credit' if c in outgoing else 'debit'}', -1.0D, "
        f"get({scores}, {i}))"
        for i, c in enumerate(config.categories)
    ]
    return F.expr(f"array({', '.join(masked)})")


def argmax_index(scores: Column) -> Column:
    """0-based index of the first largest score."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def category_at(index: Column, categories: Sequence[str]) -> Column:
    return F.get(literal_array(categories), index)


def argmax_category(scores: Column, categories: Sequence[str]) -> Column:
    return category_at(argmax_index(scores), categories)


def top_k(scores: Column, categories: Sequence[str], k: int) -> Column:
    """The k best categories, best first; equal scores keep category order."""
    entries = F.transform(
        scores, lambda s, i: F.struct((-s).alias("key"), i.alias("index"))
    )
    best = F.slice(F.array_sort(entries), 1, k)
    names = literal_array(categories)
    return F.transform(best, lambda e: F.get(names, e["index"]))


def rank_of(scores: Column, index: Column) -> Column:
    """1-based position of category `index` in descending order; equal scores keep category order."""
    true_score = F.get(scores, index)
    ahead = F.filter(
        scores, lambda s, i: (s > true_score) | ((s == true_score) & (i < index))
    )
    return F.size(ahead) + 1


def rank_with_ties(scores: Column, index: Column) -> Column:
    """Number of categories scoring at least as high as category `index`."""
    true_score = F.get(scores, index)
    return F.size(F.filter(scores, lambda s: s >= true_score))
