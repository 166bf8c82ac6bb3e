"""Where intermediate tables go: the shared folder the session names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_roots: dict[str, str] = {}
_open: list[list[str]] = []


def work_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables; a private one only for unconfigured local sessions."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tallymark-")
    return _local_roots[app]


def new_folder(spark: SparkSession, name: str) -> str:
    path = f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


@contextmanager
def kept_until_done(spark: SparkSession) -> Iterator[None]:
    """Delete the folders that are made inside, once the block ends: after its last write."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            _delete(spark, path)


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of each query inside when it ends; the setting is put back."""
    before = spark.conf.get(_FREED, "false")
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as Parquet and read it back.

    Readers of the result do not repeat the joins behind it, and a lost executor costs only the
    tasks it was running, not the whole lineage. The shuffles behind it go once it is written.
    """
    path = new_folder(df.sparkSession, name)
    with _shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._staged_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete staged tables whose readers have all run; others are left alone."""
    for table in tables:
        path = table.__dict__.get("_staged_at")
        if path:
            _delete(table.sparkSession, path)


# Rows of a narrow table that are copied to every executor; a larger one is joined by shuffle.
COPIED_ROWS = 1_000_000


def measured(df: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """`df` (few narrow columns), staged and counted, and broadcast if it has `most` rows or fewer."""
    small = stage(df, name)
    return F.broadcast(small) if small.count() <= (COPIED_ROWS if most is None else most) else small
