"""Outputs of a job that readers see as a whole, or not at all.

    <root>/runs/<run>/<table>/domain=<d>/...   what one run wrote
    <root>/manifests/<n>                       for each table its schema and the folder of each domain

A run writes into a folder of its own and, when all its tables are there, the next manifest. Readers
follow the newest finished manifest, so a run that is broken off leaves the tables as they were. A
run may write some domains only: the manifest keeps the folders of the others where they are, which
replaces a domain without touching the rest.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallymark.config import ModelConfig
from tallymark.sources import manifests, sinks


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the finished manifests, ascending."""
    names = manifests.names_in(spark, f"{root}/manifests")
    return sorted(
        int(n) for n in names if n.isdigit() and manifests.is_finished(spark, f"{root}/manifests/{n}")
    )


def _tables(spark: SparkSession, root: str, version: int) -> dict:
    return manifests.read(spark, f"{root}/manifests/{version}")["tables"]


class Publication:
    """One run: write its tables, then `publish`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.run = f"{root}/runs/{uuid.uuid4().hex}"
        known = versions(spark, root)
        self.base = known[-1] if known else 0
        self._written: dict[str, dict] = {}

    def write(self, name: str, df: DataFrame, config: ModelConfig) -> sinks.Counts | None:
        """Write a table partitioned by domain and country; returns its counts as `write_counted`.

        The domains of the configuration are replaced, those without rows by nothing.
        """
        folder = f"{self.run}/{name}"
        counts = sinks.write_counted(df, folder, config)
        folders = {d: None for d in config.domains}
        for found in manifests.names_in(self.spark, folder):
            if found.startswith("domain="):
                folders[found.removeprefix("domain=")] = folder
        self._written[name] = {"schema": df.schema.json(), "domains": folders}
        return counts

    def publish(self) -> int:
        """Make the tables of this run, and all others as they were, the newest version.

        Refused if another run has published since this one began.
        """
        known = versions(self.spark, self.root)
        if (known[-1] if known else 0) != self.base:
            raise RuntimeError("another run has published since this one began")
        tables = _tables(self.spark, self.root, self.base) if self.base else {}
        for name, new in self._written.items():
            domains = {**tables.get(name, {}).get("domains", {}), **new["domains"]}
            tables[name] = {"schema": new["schema"], "domains": {d: f for d, f in domains.items() if f}}
        # A manifest that was broken off keeps its number.
        numbers = [int(n) for n in manifests.names_in(self.spark, f"{self.root}/manifests") if n.isdigit()]
        version = max(numbers, default=0) + 1
        manifests.write(
            self.spark, f"{self.root}/manifests/{version}", {"version": version, "run": self.run, "tables": tables}
        )
        return version


def read(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A published table, by default of the newest version; domains lie where their run wrote them."""
    known = versions(spark, root)
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"no published version {'' if version is None else version} in {root}")
    table = _tables(spark, root, known[-1] if version is None else version)[name]
    schema = T.StructType.fromJson(json.loads(table["schema"]))
    by_folder: dict[str, list[str]] = {}
    for domain, folder in sorted(table["domains"].items()):
        by_folder.setdefault(folder, []).append(f"{folder}/domain={domain}")
    parts = [
        spark.read.schema(schema).option("basePath", folder).parquet(*paths).select(*schema.fieldNames())
        for folder, paths in by_folder.items()
    ]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def retire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the folders of runs that none of the newest `keep` versions reads; returns their names.

    Run it when no job is writing: a run that has not published yet looks like one broken off.
    """
    known = versions(spark, root)
    read_by = {
        folder.removeprefix(f"{root}/runs/").split("/")[0]
        for version in known[-keep:]
        for table in _tables(spark, root, version).values()
        for folder in table["domains"].values()
    }
    gone = [n for n in manifests.names_in(spark, f"{root}/runs") if n not in read_by]
    for version in known[:-keep]:
        manifests.delete(spark, f"{root}/manifests/{version}")
    for name in gone:
        manifests.delete(spark, f"{root}/runs/{name}")
    return sorted(gone)
