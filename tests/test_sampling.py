import hashlib

import pytest
from pyspark.sql import functions as F

from tallymark.operators import sampling

KEY = ["id"]


def hash60(seed, value):
    return int(hashlib.md5(f"{seed}|{value}".encode()).hexdigest()[:15], 16)


def smallest(ids, n, seed=123):
    return sorted(sorted(ids, key=lambda i: hash60(seed, i))[:n])


@pytest.mark.parametrize("n", [0, 1, 37, 999, 5000])
def test_capped_matches_brute_force_for_any_partitioning(spark, n):
    df = spark.range(1000)
    for partitions in (1, 7):
        rows = sampling.capped(df.repartition(partitions), n, KEY).collect()
        assert sorted(r.id for r in rows) == smallest(range(1000), n)


def test_one_country_with_most_rows(spark):
    df = spark.range(3000).withColumn(
        "country", F.when(F.col("id") < 2900, "GB").otherwise(F.concat(F.lit("C"), F.col("id") % 3))
    )
    rows = sampling.capped_per_group(df, 25, ["country"], KEY).collect()
    groups = {}
    for r in df.collect():
        groups.setdefault(r.country, []).append(r.id)
    expected = {(c, i) for c, ids in groups.items() for i in smallest(ids, 25)}
    assert {(r.country, r.id) for r in rows} == expected
    assert len(rows) == 100


@pytest.mark.parametrize("n", [10, 500, 1200])
def test_copies_count_one_by_one(spark, n):
    """A third of the rows are copies of one row; the sample still has exactly n rows."""
    df = spark.range(1000).union(spark.range(1).select(F.explode(F.array_repeat(F.lit(7).cast("long"), 499))))
    rows = sorted(r.id for r in sampling.capped(df, n, KEY).collect())
    everything = [*range(1000), *[7] * 499]
    assert rows == sorted(sorted(everything, key=lambda i: hash60(123, i))[:n])


def test_empty_input(spark):
    assert sampling.capped(spark.range(0), 10, KEY).count() == 0


def labelled(spark, n=1000):
    return spark.range(n).select(
        "id", F.lit("d").alias("domain"),
        F.when(F.col("id") % 10 < 6, 1).when(F.col("id") % 10 < 9, 2).alias("target_category_int"),
    )


def sizes(df):
    return {
        (r.target_category_int, r.split): r["count"]
        for r in df.groupBy("target_category_int", "split").count().collect()
    }


def test_split_by_share(spark):
    found = sizes(sampling.stratified_split(labelled(spark), key=KEY))
    assert found == {
        (1, "test"): 60, (1, "validation"): 54, (1, "train"): 486,
        (2, "test"): 30, (2, "validation"): 27, (2, "train"): 243,
        (None, "test"): 10, (None, "validation"): 9, (None, "train"): 81,
    }


def test_split_by_count_is_exact(spark):
    split = sampling.stratified_split(labelled(spark, 997), 250, 250, key=KEY)
    totals = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert totals == {"test": 250, "validation": 250, "train": 497}


def test_small_strata(spark):
    df = spark.createDataFrame(
        [(1, "d", 1), (2, "d", 2), (3, "d", 2)], "id long, domain string, target_category_int int"
    )
    found = sizes(sampling.stratified_split(df, key=KEY))
    assert found == {(1, "train"): 1, (2, "test"): 1, (2, "train"): 1}


def test_split_by_count_with_another_label_and_copies(spark):
    df = labelled(spark, 500).withColumnRenamed("target_category_int", "y")
    df = df.union(spark.range(1).select(
        F.explode(F.array_repeat(F.lit(7).cast("long"), 300)).alias("id"), F.lit("d"), F.lit(2)
    ))
    split = sampling.stratified_split(df, 100, 37, label="y", key=KEY)
    totals = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert totals == {"test": 100, "validation": 37, "train": 663}


@pytest.mark.parametrize("test,validation,wanted", [
    (100, 5, {"test": 50}), (50, 5, {"test": 50}), (45, 20, {"test": 45, "validation": 5}),
    (0, 0, {"train": 50}), (100, 0.1, {"test": 50}),
])
def test_counts_above_the_domain_take_all_of_it(spark, test, validation, wanted):
    split = sampling.stratified_split(labelled(spark, 50), test, validation, key=KEY)
    assert {r.split: r["count"] for r in split.groupBy("split").count().collect()} == wanted


def test_only_cut_ranges_are_ranked(spark):
    plan = sampling.stratified_split(labelled(spark), key=KEY)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 and plan.count("Join Inner") >= 2
