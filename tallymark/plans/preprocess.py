"""The preprocessing job: configured files in, training and production tables out."""

from __future__ import annotations

import time
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tallymark import schemas, staging
from tallymark.config import ModelConfig
from tallymark.operators import filters, joins
from tallymark.operators.rules import Pack
from tallymark.plans.training import (
    DomainTables,
    SampleSettings,
    from_start,
    generated_domains,
    samples,
)
from tallymark.sources import sinks, tables
from tallymark.sources.publication import Publication


def read_domain(
    spark: SparkSession, config: ModelConfig, domain: str, paths: Mapping[str, str],
    set_aside: Callable[[str, DataFrame], None] | None = None,
) -> DomainTables:
    """Tables of a domain by their configured names; test users may have no path.

    The small-business model names its tables per domain (`users_app`) and reads no feedback.
    """
    generated = config.join_counterparty
    known = tables.SME_TABLES if generated else tables.RETAIL_TABLES

    def read(name: str) -> DataFrame | None:
        table = f"{name}_{domain}" if generated else name
        return tables.read_table(spark, table, paths, known, set_aside)

    feedback = [] if generated else [read(name) for name in tables.FEEDBACK_TABLES]
    return DomainTables(
        users=read("users"),
        accounts=read("accounts"),
        transactions=read("transactions"),
        test_users=read("test_users"),
        feedback=[source for source in feedback if source is not None],
    )


def run(
    spark: SparkSession,
    config: ModelConfig,
    paths: Mapping[str, str],
    output: str,
    settings: SampleSettings,
    run_time: str,
    packs: Mapping[str, Pack] | None = None,
    business_only: Sequence[str] = (),
    inspection_path: str | None = None,
    set_aside: bool = False,
    publish: bool = False,
) -> DataFrame:
    """Write `training`, `production`, `metadata` and, with packs, `feedback/<domain>` below
    `output`; returns the metadata.

    Sizes are observed while the tables are written. Metadata also hold the folders that feedback was
    read from, the number of held-out transactions and the seconds of each step. Intermediate tables
    of the job are deleted at the end.

    `set_aside` leaves out rows of CSV and JSON files that do not fit their schema, writes them with
    file and reason to `rejected/<table>`, and counts them in the metadata. `publish` writes the
    training and production tables as one new version (see `publication`) that readers see only
    when both are complete, instead of overwriting `training` and `production`.
    """
    if config.test_site_id is None:
        raise ValueError("give the configuration its clients and test site: for_deployment()")
    settings = settings.with_window(run_time, config)
    facts = {"run_time": run_time, "window": f"{settings.window_start}/{settings.window_end}"}
    clock = time.monotonic()

    def lap(step: str) -> None:
        nonlocal clock
        facts[f"seconds.{step}"] = f"{time.monotonic() - clock:.1f}"
        clock = time.monotonic()

    def reject(table: str, bad: DataFrame) -> None:
        if f"rejected.{table}" in facts:  # tables that several domains read
            return
        bad.write.mode("overwrite").json(f"{output}/rejected/{table}")
        written = spark.read.schema(bad.schema).json(f"{output}/rejected/{table}")
        facts[f"rejected.{table}"] = str(written.count())

    with staging.kept_until_done(spark):
        domains = {
            d: read_domain(spark, config, d, paths, reject if set_aside else None) for d in config.domains
        }
        if set_aside:
            lap("rejected")
        held = None
        if inspection_path is not None:
            held = joins.held_keys(tables.read_file(spark, inspection_path, schemas.INSPECTION))
            for d, t in domains.items():
                recent = filters.from_start_date(t.transactions, config.start_date)
                facts[f"held_out.{d}"] = str(joins.held_out_count(recent, held).first()[0])
            lap("inspection")
        if packs is None:
            prepared = {d: from_start(t, config, held) for d, t in domains.items()}
        else:
            prepared = generated_domains(domains, config, packs, run_time, held, business_only)
            for d, t in prepared.items():
                sinks.write_feedback(t.feedback[0], f"{output}/feedback/{d}")
            lap("feedback")
        for d, t in domains.items():
            for number, source in enumerate(t.feedback):
                for row in tables.lineage(source).collect():  # one row per folder
                    facts[f"feedback.{d}.{number}.{row.folder}"] = str(row.n_rows)
        written, counts = {}, {}
        publication = Publication(spark, output) if publish else None
        for name, sample in zip(("training", "production"), samples(prepared, config, settings)):
            path = f"{output}/{name}"
            if publication is None:
                counts[name] = sinks.write_counted(sample, path, config)
            else:
                counts[name] = publication.write(name, sample, config)
                path = f"{publication.run}/{name}"
            written[name] = spark.read.schema(sample.schema).parquet(path)
            lap(name)
        if publication is not None:
            facts["version"] = str(publication.publish())
        metadata = sinks.run_metadata(written, config, facts, counts)
        sinks.write_metadata(metadata, f"{output}/metadata")
    return spark.read.schema("metric string, value string").json(f"{output}/metadata")
