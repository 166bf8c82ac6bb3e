"""From raw tables and feedback to the training and production samples."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame

from tallymark.config import IDENTITY, TARGET, ModelConfig
from tallymark.operators import feedback as fb
from tallymark.operators import filters, joins, rules, sampling
from tallymark.staging import stage


@dataclass
class DomainTables:
    """Input tables of one domain. `test_users` may be absent."""

    users: DataFrame
    accounts: DataFrame
    transactions: DataFrame
    test_users: DataFrame | None = None
    feedback: Sequence[DataFrame] = ()


@dataclass(frozen=True)
class SampleSettings:
    """Sizes and production window; jobs fill in a window without dates (see `with_window`)."""

    window_start: str | None = None
    window_end: str | None = None
    per_country: int | None = None
    production: int | None = None

    def with_window(self, run_time: str, config: ModelConfig) -> "SampleSettings":
        """The same settings with the last days before the run where no window is given."""
        start, end = filters.default_window(
            date.fromisoformat(run_time[:10]), config.production_window_days
        )
        return replace(self, window_start=self.window_start or start, window_end=self.window_end or end)


def labelled_base(tables: DomainTables, config: ModelConfig, domain: str) -> DataFrame:
    """Every labelled transaction of eligible users and accounts, narrowed to what is sampled."""
    users = joins.users_sample(tables.users, tables.test_users, config, domain)
    accounts = filters.relevant_accounts(tables.accounts, config.test_site_id)
    latest = fb.latest_feedback(tables.feedback)
    columns = dict.fromkeys([*IDENTITY, *config.input_columns])
    base = joins.labelled_transactions(
        latest,
        tables.transactions.select(*columns),
        users.select("user_id", "country_code"),
        accounts.select("user_id", "account_id"),
    )
    return base.select(*columns, TARGET, "country_code")


def training_tables(
    tables: DomainTables, config: ModelConfig, domain: str, settings: SampleSettings
) -> tuple[DataFrame, DataFrame]:
    """Training and production sample of one domain.

    The joined base feeds four scans (a histogram and a selection per sample), so it is written
    once to the shared work folder.
    """
    base = stage(labelled_base(tables, config, domain), "labelled-base")
    training = sampling.training_sample(base, config, settings.per_country)
    production = sampling.production_sample(
        base, config, settings.window_start, settings.window_end, settings.production
    )
    return training, production


def union_domains(parts: Mapping[str, DataFrame]) -> DataFrame:
    tagged = [filters.tag(df, domain=domain) for domain, df in parts.items()]
    return reduce(DataFrame.unionByName, tagged)


def from_start(
    tables: DomainTables, config: ModelConfig, held: DataFrame | None = None
) -> DomainTables:
    """Drop transactions before the start date and those with the keys `held` (`joins.held_keys`)."""
    transactions = filters.from_start_date(tables.transactions, config.start_date)
    if held is not None:
        transactions = joins.hold_out(transactions, held)
    return DomainTables(
        tables.users, tables.accounts, transactions, tables.test_users, tables.feedback
    )


def samples(
    domains: Mapping[str, DomainTables], config: ModelConfig, settings: SampleSettings
) -> tuple[DataFrame, DataFrame]:
    pairs = {
        domain: training_tables(tables, config, domain, settings)
        for domain, tables in domains.items()
    }
    training = union_domains({d: pair[0] for d, pair in pairs.items()})
    production = union_domains({d: pair[1] for d, pair in pairs.items()})
    return training, production


def preprocess_retail(
    domains: Mapping[str, DomainTables],
    config: ModelConfig,
    settings: SampleSettings,
    inspection: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Training and production tables from user feedback."""
    held = None if inspection is None else joins.held_keys(inspection)
    prepared = {d: from_start(t, config, held) for d, t in domains.items()}
    return samples(prepared, config, settings)


def with_generated_feedback(
    tables: DomainTables,
    config: ModelConfig,
    domain: str,
    pack: rules.Pack,
    run_time: str,
    business_only: bool = False,
    **business_options,
) -> DomainTables:
    """Replace the feedback of a domain by labels from its rule pack.

    Test users are dropped first; `business_only` keeps accounts that show business use. The
    generated table is written once and read by the joins behind it.
    """
    users = joins.without_test_users(tables.users, tables.test_users)
    accounts, transactions = tables.accounts, tables.transactions
    if business_only:
        users, accounts, transactions = filters.business_accounts(
            users, accounts, transactions, **business_options
        )
    generated = rules.generate_labels(
        users, accounts, transactions, pack, config.clients[domain], run_time
    )
    feedback = stage(generated, f"generated-feedback-{domain}")
    return DomainTables(
        tables.users, tables.accounts, tables.transactions, tables.test_users, [feedback]
    )


def generated_domains(
    domains: Mapping[str, DomainTables],
    config: ModelConfig,
    packs: Mapping[str, rules.Pack],
    run_time: str,
    held: DataFrame | None = None,
    business_only: Sequence[str] = (),
    **business_options,
) -> dict[str, DomainTables]:
    """The domains with generated feedback in place of their own."""
    return {
        domain: with_generated_feedback(
            from_start(tables, config, held), config, domain, packs[domain], run_time,
            domain in business_only, **business_options,
        )
        for domain, tables in domains.items()
    }


def preprocess_sme(
    domains: Mapping[str, DomainTables],
    config: ModelConfig,
    settings: SampleSettings,
    packs: Mapping[str, rules.Pack],
    run_time: str,
    inspection: DataFrame | None = None,
    business_only: Sequence[str] = (),
    **business_options,
) -> tuple[DataFrame, DataFrame]:
    """Training and production tables from generated labels."""
    held = None if inspection is None else joins.held_keys(inspection)
    prepared = generated_domains(
        domains, config, packs, run_time, held, business_only, **business_options
    )
    return samples(prepared, config, settings)
