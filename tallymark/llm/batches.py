"""Arrow batches inside tasks: bounded slices, text buffers, words of texts."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.hashing import range_hashes

SLICE_BYTES = 1 << 19
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_DEFAULT_BYTES = "67108864b"
_ROOT = str(Path(__file__).resolve().parents[2])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def importable(spark: SparkSession) -> None:
    """Let Python workers of a session started elsewhere import this package by its path."""
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (_ROOT, env.get("PYTHONPATH"))))


def map_arrow(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: T.StructType | str,
) -> DataFrame:
    """mapInArrow with small batches, and memory given back at the end of each task.

    Rows hold whole texts; Spark's default of 64 MB a batch is held several times over on the way to
    Python and back. A limit that the session has set itself is left alone. Columns may have any name;
    those that Spark would read as a path go in under their numbers.
    """
    spark = df.sparkSession
    names = schema.names if isinstance(schema, T.StructType) else None
    if any("." in c or "`" in c for c in df.columns):
        df = df.toDF(*(f"c{k}" for k in range(len(df.columns))))
    importable(spark)
    if spark.conf.get(_BATCH_BYTES) == _DEFAULT_BYTES:
        spark.conf.set(_BATCH_BYTES, "4m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in function(batches):
            yield batch.rename_columns(names) if names else batch
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of `df` has, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """`df` without its columns of these names, in any case."""
    taken = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def text_array(column: pa.Array) -> pa.StringArray:
    """The column as texts; null counts as empty."""
    return pc.fill_null(column.cast(pa.string()), "")


def sliced(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most `limit` bytes in a text or binary column, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def buffers_of(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and the offsets between them."""
    n = len(texts)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32, n + 1, texts.offset * 4).astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets * 0
    raw = np.frombuffer(data, np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0]))
    return raw, offsets - offsets[0]


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of texts, A-Z lower-cased unless `lower` is false.

    `blank` is another table of the 256 bytes that separate words. `hashes`, `starts`, `ends`
    (bytes in `raw`) have one entry per word; the words of text i are first[i]:first[i + 1].
    """

    def __init__(self, texts: pa.StringArray, lower: bool = True, blank: np.ndarray = BLANK):
        self.raw, self.offsets = buffers_of(texts)
        solid = np.zeros(len(self.raw) + 2, bool)
        solid[1:-1] = ~blank[self.raw]
        edge = solid[1:] & ~solid[:-1]
        inner = self.offsets[self.offsets < len(self.raw)]
        edge[inner] = solid[1:-1][inner]
        self.starts = np.flatnonzero(edge)
        stop = solid[:-1] & ~solid[1:]
        stop[inner] |= solid[:-1][inner]
        self.ends = np.flatnonzero(stop)
        self.hashes = range_hashes(_LOWER[self.raw] if lower else self.raw, self.starts, self.ends)
        self.first = np.searchsorted(self.starts, self.offsets)
        self.first[-1] = len(self.starts)


def string_array(data: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Text or binary values from their joined bytes and the end of each."""
    offsets = np.zeros(len(ends) + 1, np.int32)
    offsets[1:] = ends
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(kind, len(ends), buffers)


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
