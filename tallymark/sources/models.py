"""Stored models: versions in folders, each with a manifest that is written last.

    <root>/<version>/scorer   the fitted pipeline, or tables `tokens` and `labels`
    <root>/<version>/mcc      merchant codes, if the model has some
    <root>/<version>/manifest one line of JSON: format, kind, configuration, amount limits, and of
                              each part the number of rows or files and a digest

A version without a manifest is not finished, and no reader takes it. Loading compares every part
with its digest, so a damaged or mixed model is refused instead of predicting something else.
"""

from __future__ import annotations

import dataclasses

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.config import ModelConfig
from tallymark.operators.embedding import EmbeddingModel
from tallymark.plans.train import TrainedModel
from tallymark.sources import manifests
from tallymark.sources.manifests import Damaged

FORMAT = 1


def _table_digest(df: DataFrame) -> dict:
    """Number of rows and a digest that does not depend on their order."""
    row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)]).cast("decimal(38,0)")
    n, total = df.agg(F.count(F.lit(1)), F.sum(row)).first()
    return {"n": n, "digest": str(total)}


def _file_digest(spark: SparkSession, folder: str) -> dict:
    """The same for the files below a folder, by their places in it; Spark's markers left out."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        .select(F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("place"), "content")
        .where(~F.col("place").rlike(r"/[_.][^/]*$"))
    )
    return _table_digest(files)


def _config_json(config: ModelConfig) -> dict:
    return dataclasses.asdict(config)


def _config(stored: dict) -> ModelConfig:
    """The configuration as it was: tuples come back from JSON as lists."""
    known = {f.name for f in dataclasses.fields(ModelConfig)}
    values = {k: tuple(v) if isinstance(v, list) else v for k, v in stored.items() if k in known}
    values["clients"] = {k: tuple(v) for k, v in values.get("clients", {}).items()}
    return ModelConfig(**values)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Finished versions, ascending."""
    names = manifests.names_in(spark, root)
    return sorted(
        int(n) for n in names if n.isdigit() and manifests.is_finished(spark, f"{root}/{n}/manifest")
    )


def save(spark: SparkSession, model: TrainedModel, root: str, version: int | None = None) -> int:
    """Write the model as a version of its own, by default the next one; returns its number.

    A version that exists, finished or not, is never written again.
    """
    if version is None:
        version = max((int(n) for n in manifests.names_in(spark, root) if n.isdigit()), default=0) + 1
    folder = f"{root}/{version}"
    if manifests.exists(spark, folder):
        raise ValueError(f"{folder} exists")
    manifest = {
        "format": FORMAT, "version": version, "config": _config_json(model.config),
        "low": model.low, "high": model.high, "parts": {},
    }

    def part(name: str, df: DataFrame) -> None:
        df.write.parquet(f"{folder}/{name}")
        manifest["parts"][name] = _table_digest(spark.read.parquet(f"{folder}/{name}"))

    if isinstance(model.model, EmbeddingModel):
        scorer = model.model
        manifest |= {"kind": "embedding", "weights": scorer.weights, "bias": scorer.bias}
        part("tokens", scorer.token_vectors.select("bucket", "vector"))
        part("labels", scorer.label_vectors.select(F.col(scorer.label_index).alias("index"), "vector"))
    else:
        manifest["kind"] = "classifier"
        model.model.write().save(f"{folder}/scorer")
        manifest["parts"]["scorer"] = _file_digest(spark, f"{folder}/scorer")
    if model.mcc is not None:
        part("mcc", model.mcc)
    manifests.write(spark, f"{folder}/manifest", manifest)
    return version


def load(spark: SparkSession, root: str, version: int | None = None) -> TrainedModel:
    """A stored model, by default the newest finished version.

    Raises Damaged if there is none, or if the manifest or a part is not as it was written.
    """
    known = versions(spark, root)
    if not known or version is not None and version not in known:
        raise Damaged(f"no finished version {'' if version is None else version} in {root}")
    folder = f"{root}/{known[-1] if version is None else version}"
    manifest = manifests.read(spark, f"{folder}/manifest")
    if manifest["format"] != FORMAT:
        raise Damaged(f"{folder} has format {manifest['format']}, this library reads {FORMAT}")

    def part(name: str) -> DataFrame:
        try:
            df = spark.read.parquet(f"{folder}/{name}")
            same = _table_digest(df) == manifest["parts"][name]
        except Exception as problem:
            raise Damaged(f"{name} of {folder} cannot be read") from problem
        if not same:
            raise Damaged(f"{name} of {folder} is not what was written")
        return df

    if manifest["kind"] == "embedding":
        scorer = EmbeddingModel(part("tokens"), part("labels"), weights=manifest["weights"], bias=manifest["bias"])
    else:
        if _file_digest(spark, f"{folder}/scorer") != manifest["parts"]["scorer"]:
            raise Damaged(f"scorer of {folder} is not what was written")
        scorer = PipelineModel.load(f"{folder}/scorer")
    mcc = part("mcc") if "mcc" in manifest["parts"] else None
    return TrainedModel(scorer, _config(manifest["config"]), manifest["low"], manifest["high"], mcc)
