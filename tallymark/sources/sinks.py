"""Sinks: partitioned tables and run metadata."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallymark.config import ModelConfig


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str] = ("domain", "country_code")
) -> None:
    """Overwrite a Parquet table, one folder per value of `by`.

    The rebalance hint collects each folder's rows into files of a fair size; adaptive execution
    splits a folder that holds a large share of the rows over many tasks.
    """
    balanced = df.hint("rebalance", *by)
    balanced.write.mode("overwrite").partitionBy(*by).parquet(path)


Counts = dict[tuple[str, str], int]


def write_counted(
    df: DataFrame, path: str, config: ModelConfig, by: Sequence[str] = ("domain", "country_code")
) -> Counts | None:
    """`write_partitioned`, and the rows written per (domain, country_code) of the configuration.

    The numbers are observed on the write itself, so the table is not read again. They stand behind
    the last shuffle, in the tasks that write: a task that is repeated counts once, like its file.
    None if there were rows of other domains or countries.
    """
    groups = [(d, c) for d in config.domains for c in config.countries]
    observed = Observation()
    counts = [
        F.count(F.when((F.col(by[0]) == d) & (F.col(by[1]) == c), 1)).alias(f"n{k}")
        for k, (d, c) in enumerate(groups)
    ]
    counted = df.hint("rebalance", *by).observe(observed, F.count(F.lit(1)).alias("total"), *counts)
    counted.write.mode("overwrite").partitionBy(*by).parquet(path)
    found = observed.get
    sizes = {group: found[f"n{k}"] for k, group in enumerate(groups) if found[f"n{k}"]}
    return sizes if sum(sizes.values()) == found["total"] else None


def write_feedback(df: DataFrame, path: str) -> None:
    """Overwrite a generated-feedback table with as many files as there are tasks."""
    df.write.mode("overwrite").parquet(path)


def config_metrics(df: DataFrame, config: ModelConfig) -> DataFrame:
    """Configuration values as (metric, value) rows."""
    values = [
        ("config.name", config.name),
        ("config.categories", ",".join(config.categories)),
        ("config.countries", ",".join(config.countries)),
        ("config.start_date", config.start_date),
        ("config.threshold", str(config.threshold)),
        ("config.samples_per_country", str(config.samples_per_country)),
        ("config.production_samples", str(config.production_samples)),
    ]
    return df.sparkSession.createDataFrame(values, "metric string, value string")


def run_metadata(
    tables: Mapping[str, DataFrame], config: ModelConfig, facts: Mapping[str, str] | None = None,
    counts: Mapping[str, Counts | None] | None = None,
) -> DataFrame:
    """Configuration, given facts (such as timings) and rows per domain and country of each table.

    One (metric, value) row each; a table is counted in one pass, or not read if `counts` has it.
    """
    facts, known = dict(facts or {}), {k: v for k, v in (counts or {}).items() if v is not None}
    for name, sizes in known.items():
        facts |= {f"{name}_size.{d}.{c}": str(n) for (d, c), n in sizes.items()}
    first = next(iter(tables.values()))
    parts = [config_metrics(first, config)]
    if facts:
        parts.append(
            first.sparkSession.createDataFrame(list(facts.items()), "metric string, value string")
        )
    for name, table in tables.items():
        if name in known:
            continue
        counts = table.groupBy("domain", "country_code").agg(F.count(F.lit(1)).alias("n"))
        metric = F.concat_ws(".", F.lit(f"{name}_size"), "domain", "country_code")
        parts.append(counts.select(metric.alias("metric"), F.col("n").cast("string").alias("value")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def write_metadata(metadata: DataFrame, path: str) -> None:
    metadata.write.mode("overwrite").json(path)
