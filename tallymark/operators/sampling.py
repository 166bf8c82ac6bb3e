"""Reproducible samples and splits.

Rows are ordered by a hash of their identity, so the outcome does not depend on partitioning.
No group is ever ordered as a whole: a histogram over hash ranges finds the range in which a
quota ends, and only rows inside one range are ranked against each other.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.config import IDENTITY, TARGET_INDEX, ModelConfig
from tallymark.functions.text import hash60
from tallymark.operators import filters
from tallymark.staging import stage

_HASH_BITS = 60
# 65,536 ranges: ranking inside a range touches about 1/65,536 of a group.
_RANGE_BITS = 16


def sample_hash(key: Sequence[str], seed: int) -> Column:
    return hash60(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))


def _with_range(df: DataFrame, key: Sequence[str], seed: int) -> DataFrame:
    hashed = df.withColumn("_hash", sample_hash(key, seed))
    return hashed.withColumn(
        "_range", F.shiftright("_hash", _HASH_BITS - _RANGE_BITS).cast("int")
    )


def _range_totals(ranged: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows per group and range, with running totals: at most 65,536 rows per group."""
    counts = ranged.groupBy(*groups, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(*groups)
    upto = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumns(
        {"_upto": F.sum("_rows").over(upto), "_group_rows": F.sum("_rows").over(whole)}
    )


def _cut(quota: Column, name: str) -> list[Column]:
    """Last range a quota reaches and how many of its rows it takes (none when the quota is 0)."""
    before = F.col("_upto") - F.col("_rows")
    reached = (quota > before) & (quota <= F.col("_upto"))
    return [
        F.coalesce(F.max(F.when(reached, F.col("_range"))), F.lit(-1)).alias(f"_{name}_range"),
        F.coalesce(F.max(F.when(reached, quota - before)), F.lit(0)).alias(f"_{name}_left"),
    ]


# Most groups whose cuts are copied to every executor; more are joined by shuffle.
COPIED_GROUPS = 100_000


def _attach(
    df: DataFrame, cuts: DataFrame, groups: Sequence[str], values: Sequence[str],
    most: int = COPIED_GROUPS,
) -> DataFrame:
    """Add each group's cut values to its rows.

    Cuts have one row per group and are staged and counted. Up to `most` are broadcast: without the
    hint the planner would size them by their input and shuffle all rows on the group.
    """
    if not groups:
        only = cuts.select(F.struct(*values)).scalar()
        return df.withColumn("_cut", only).select(df["*"], *[F.col(f"_cut.{v}") for v in values])
    renamed = stage(cuts.select(*[F.col(g).alias(f"_cut_{g}") for g in groups], *values), "cuts")
    condition = F.lit(True)
    for g in groups:
        condition = condition & F.col(g).eqNullSafe(F.col(f"_cut_{g}"))
    small = renamed.count() <= most
    return df.join(F.broadcast(renamed) if small else renamed, condition).select(df["*"], *values)


def capped_per_group(
    df: DataFrame, n: int, groups: Sequence[str], key: Sequence[str] = IDENTITY, seed: int = 123
) -> DataFrame:
    """The n rows of every group with the smallest hash; whole groups when they are smaller.

    Reads `df` twice, so stage an expensive input first. `key` must identify a row, save for full
    copies: those count as one row with a multiplicity and are emitted as often as they fit.
    `groups` must take few values.
    """
    columns = df.columns
    ranged = _with_range(df, key, seed)
    quota = F.least(F.lit(n).cast("long"), F.col("_group_rows"))
    cuts = _range_totals(ranged, groups).groupBy(*groups).agg(*_cut(quota, "cap"))
    limits = ["_cap_range", "_cap_left"]
    candidates = _attach(ranged, cuts, groups, limits).where(F.col("_range") <= F.col("_cap_range"))

    copies = candidates.groupBy(*columns, "_hash", "_range", *limits).agg(
        F.count(F.lit(1)).alias("_copies")
    )
    earlier = (
        Window.partitionBy(*groups, "_range")
        .orderBy("_hash", *[F.col(c) for c in columns])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("_copies").over(earlier), F.lit(0))
    fits = F.greatest(F.least(F.col("_copies"), F.col("_cap_left") - before), F.lit(0))
    taken = F.when(F.col("_range") < F.col("_cap_range"), F.col("_copies")).otherwise(fits)
    return (
        copies.withColumn("_taken", taken.cast("int"))
        .where(F.col("_taken") > 0)
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_taken"))))
        .select(*columns)
    )


def capped(
    df: DataFrame, n: int, key: Sequence[str] = IDENTITY, seed: int = 123
) -> DataFrame:
    """The n rows with the smallest hash."""
    return capped_per_group(df, n, [], key, seed)


def training_sample(
    base: DataFrame, config: ModelConfig, n_per_country: int | None = None,
    start: str | None = None,
) -> DataFrame:
    """Rows from the start date on, capped per configured country, with the category index."""
    n = config.samples_per_country if n_per_country is None else n_per_country
    recent = filters.from_start_date(base, start or config.start_date)
    listed = recent.where(F.col("country_code").isin(list(config.countries)))
    sample = capped_per_group(listed, n, ["country_code"], seed=config.seed)
    return filters.map_category_index(sample, config)


def production_sample(
    base: DataFrame, config: ModelConfig, start: str, end: str, n: int | None = None
) -> DataFrame:
    """Rows of a date window, capped as a whole, with the category index."""
    n = config.production_samples if n is None else n
    sample = capped(filters.in_date_range(base, start, end), n, seed=config.seed)
    return filters.map_category_index(sample, config)


def _share_quota(rows: Column, share: float) -> Column:
    """floor(rows * share), but at least one row of a group of two or more."""
    quota = F.floor(rows * F.lit(share)).cast("long")
    return F.when((rows >= 2) & (quota < 1), F.lit(1)).otherwise(quota)


def _absolute_quota(
    sizes: DataFrame, domain: str, label: str, rows: str, n: int, name: str
) -> DataFrame:
    """Spread n rows over the strata of a domain by size; largest remainders get the rest.

    A domain with n rows or fewer gives all of them, so quotas always add up to the lesser of both.
    Works on the table of strata, which has one row per domain and label.
    """
    domain_window = Window.partitionBy(domain)
    total = F.sum(rows).over(domain_window)
    wanted = F.least(F.lit(n).cast("long"), total)
    share = F.coalesce(F.try_divide(F.col(rows) * wanted.cast("double"), total), F.lit(0.0))
    sizes = sizes.withColumn("_wanted", wanted).withColumn("_share", share)
    sizes = sizes.withColumn("_base", F.floor("_share").cast("long"))
    by_remainder = domain_window.orderBy(
        (F.col("_share") - F.col("_base")).desc(), F.col(label).asc_nulls_last()
    )
    extra = F.row_number().over(by_remainder) <= F.col("_wanted") - F.sum("_base").over(domain_window)
    return sizes.withColumn(name, F.col("_base") + extra.cast("long")).drop("_share", "_base", "_wanted")


def stratified_split(
    df: DataFrame,
    test: float | int = 0.1,
    validation: float | int = 0.1,
    domain: str = "domain",
    label: str = TARGET_INDEX,
    key: Sequence[str] = IDENTITY,
    seed: int = 42,
) -> DataFrame:
    """Add `split` = test, validation or train, stratified by label within each domain.

    Shares apply per stratum: the test set first, then the validation set from what is left.
    Whole numbers are row counts per domain, all of its rows if it has fewer. Rows without a label
    form a stratum of their own.

    A stratum's quotas end in one or two hash ranges. Rows of all other ranges are decided where
    they are; only those of the cut ranges are ranked, full copies as one row with a multiplicity.
    Reads `df` three times, so stage an expensive input first.
    """
    strata = [domain, label]
    ranged = _with_range(df, key, seed)
    totals = stage(_range_totals(ranged, strata), "ranges")
    sizes = totals.groupBy(*strata).agg(F.max("_group_rows").alias("_n"))

    if isinstance(test, float):
        sizes = sizes.withColumn("_test", _share_quota(F.col("_n"), test))
    else:
        sizes = _absolute_quota(sizes, domain, label, "_n", test, "_test")
    sizes = sizes.withColumn("_rest", F.col("_n") - F.col("_test"))
    if isinstance(validation, float):
        sizes = sizes.withColumn("_validation", _share_quota(F.col("_rest"), validation))
    else:
        sizes = _absolute_quota(sizes, domain, label, "_rest", validation, "_validation")

    quotas = ["_test", "_validation"]
    cuts = (
        _attach(totals, sizes, strata, quotas)
        .groupBy(*strata)
        .agg(
            *_cut(F.col("_test"), "test"),
            *_cut(F.col("_test") + F.col("_validation"), "held"),
        )
    )
    limits = ["_test_range", "_test_left", "_held_range", "_held_left"]
    placed = _attach(ranged, cuts, strata, limits)
    at_cut = (F.col("_range") == F.col("_test_range")) | (F.col("_range") == F.col("_held_range"))
    whole = F.when(F.col("_range") < F.col("_test_range"), "test").when(
        F.col("_range") < F.col("_held_range"), "validation"
    ).otherwise("train")
    decided = placed.where(~at_cut).select(*df.columns, whole.alias("split"))

    copies = placed.where(at_cut).groupBy(*df.columns, "_hash", "_range", *limits).agg(
        F.count(F.lit(1)).alias("_copies")
    )
    earlier = (
        Window.partitionBy(*strata, "_range")
        .orderBy("_hash", *[F.col(c) for c in df.columns])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("_copies").over(earlier), F.lit(0))

    def within(name: str) -> Column:
        last, place = F.col(f"_{name}_range"), F.col("_before") + F.col("_copy") + 1
        return (F.col("_range") < last) | ((F.col("_range") == last) & (place <= F.col(f"_{name}_left")))

    split = F.when(within("test"), "test").when(within("held"), "validation").otherwise("train")
    ranked = (
        copies.withColumn("_before", before)
        .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
        .select(*df.columns, split.alias("split"))
    )
    return decided.unionByName(ranked)
