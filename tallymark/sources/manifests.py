"""Numbered manifests: one sealed line of JSON each, in a folder that counts once it is finished.

Spark writes the line, so it may lie in any store that Spark reaches; the marker it leaves last tells
a finished manifest from one that was broken off.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import SparkSession


class Damaged(ValueError):
    """A manifest that is not what was written, or something it speaks of is not."""


def file_system(spark: SparkSession, text: str):
    """The path and the file system that holds it, as Spark knows them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, text: str) -> bool:
    path, files = file_system(spark, text)
    return files.exists(path)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    path, files = file_system(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []


def delete(spark: SparkSession, folder: str) -> None:
    path, files = file_system(spark, folder)
    files.delete(path, True)


def is_finished(spark: SparkSession, folder: str) -> bool:
    return exists(spark, f"{folder}/_SUCCESS")


def _digest(content: dict) -> str:
    return hashlib.sha256(json.dumps(content, sort_keys=True).encode()).hexdigest()


def write(spark: SparkSession, folder: str, content: dict) -> None:
    """Write a manifest; a folder that exists is an error."""
    line = json.dumps({"sha256": _digest(content), "content": content}, sort_keys=True)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(folder)


def read(spark: SparkSession, folder: str) -> dict:
    lines = spark.read.text(folder, wholetext=True).collect()
    try:
        (line,) = lines
        sealed = json.loads(line["value"])
        content = sealed["content"]
        whole = _digest(content) == sealed["sha256"]
    except (ValueError, KeyError, TypeError):
        whole = False
    if not whole:
        raise Damaged(f"the manifest {folder} is damaged")
    return content
