"""Whitening of vectors by their leading principal components.

Entries become integers, so counts, sums and deviations are exact. The covariance is summed from
centred vectors in Arrow batches, entry by entry over the tasks; its leading eigenpairs come from
spectrum slicing (see `spectrum`), at the size of one vector squared whatever the number of rows.
Every pass reads the vectors where they lie; none is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.batches import map_arrow
from tallymark.llm.spectrum import Pair, leading

STEPS = 64
OFFSET = 1_000_000
COMPONENTS = 32
BATCH = 4096
_FITS = float(1 << 62)


def usable(df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """(vec_id, v) of the rows that take part: v holds doubles, none null or non-finite.

    An entry too large for its integer to be a long counts as non-finite, a vector without entries
    as null. Of several lengths the most frequent one takes part (the shortest of equally frequent).
    """
    v = F.col("v")
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter(
        v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda c: F.coalesce(F.abs(c) * STEPS < _FITS, F.lit(False)) & ~F.isnan(c))
    )
    first = rows.groupBy(F.size(v).alias("length")).count().orderBy(F.desc("count"), "length").first()
    return rows.filter(F.size(v) == (first["length"] if first else 0))


def _blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Row blocks with floor(STEPS * v) as a matrix of doubles, each value an integer."""
    for whole in batches:
        for start in range(0, whole.num_rows, BATCH):
            batch = whole.slice(start, BATCH)
            flat = batch.column(column).flatten().to_numpy(zero_copy_only=False)
            yield batch, np.floor(flat.reshape(batch.num_rows, -1) * STEPS)


@dataclass
class Moments:
    """Number of vectors, per dimension the exact sum of floor(STEPS * v), and its largest size."""

    n: int
    sums: list[int]
    most: int

    @property
    def exact(self) -> bool:
        """Whether squares summed over the dimensions stay below 2**63."""
        return len(self.sums) * (2 * self.n * max(self.most, 1)) ** 2 < 1 << 63

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S: integers, of any size if need be."""
        if self.exact:
            return self.n * x.astype(np.int64) - np.array(self.sums, np.int64)
        whole = np.array([[int(c) for c in row] for row in x], object).reshape(x.shape)
        return self.n * whole - np.array(self.sums, object)

    def means_removed(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, from the exact difference."""
        return (self.centred(x) / self.n).astype(float)


def moments(rows: DataFrame) -> Moments:
    """Exact sums over `rows` (see `usable`), added per dimension over the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, most, n = 0, 0, 0
        for batch, x in _blocks(batches, 0):
            big = np.abs(x).max(initial=0.0)
            whole = x.astype(np.int64) if big * len(x) < _FITS else x.astype(np.int64).astype(object)
            total = total + whole.sum(0).astype(object)
            most, n = max(most, int(big)), n + len(x)
        if n:
            yield pa.RecordBatch.from_pylist(
                [{"d": d, "s": str(s), "most": most, "n": n} for d, s in enumerate(total)],
                schema=pa.schema([("d", pa.int32()), ("s", pa.string()), ("most", pa.int64()), ("n", pa.int64())]),
            )

    parts = map_arrow(rows.select("v"), run, "d int, s string, most long, n long")
    found = parts.groupBy("d").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.max("most").alias("most"), F.sum("n").alias("n")
    ).orderBy("d").collect()
    if not found:
        return Moments(0, [], 0)
    return Moments(found[0]["n"], [int(r["s"]) for r in found], max(r["most"] for r in found))


def covariance(rows: DataFrame, values: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Covariance (divisor n) of `values` of the blocks of `rows`, whose mean is about 0.

    Each task sums products of its rows, Spark adds the sums entry by entry; the mean that rounding
    leaves is taken off at the end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums, n = 0.0, 0.0, 0
        for _, x in _blocks(batches, 0):
            y = values(x)
            products, sums, n = products + y.T @ y, sums + y.sum(0), n + len(y)
        if n:
            size = len(sums)
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([i, np.arange(size)]).astype(np.int32)),
                    pa.array(np.concatenate([j, np.full(size, -1)]).astype(np.int32)),
                    pa.array(np.concatenate([products[i, j], sums])), pa.array(np.full(len(i) + size, n)),
                ],
                names=["i", "j", "value", "n"],
            )

    found = (
        map_arrow(rows.select("v"), run, "i int, j int, value double, n long")
        .groupBy("i", "j").agg(F.sum("value").alias("value"), F.sum("n").alias("n")).toPandas()
    )
    size = int(found.i.max()) + 1
    out, n = np.zeros((size, size)), int(found.n.iloc[0])
    entries, means = found[found.j >= 0], found[found.j < 0].sort_values("i").value.to_numpy() / n
    out[entries.i, entries.j] = entries.value / n
    out = np.triu(out) + np.triu(out, 1).T
    return out - np.outer(means, means)


@dataclass
class Whitening:
    moments: Moments
    pairs: list[Pair]
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        axes = np.column_stack([p.vector / np.sqrt(p.value) for p in self.pairs])
        return self.moments.means_removed(x) @ axes


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of `rows` (see `usable`): at most `components`, fewer where the rank is lower."""
    m = moments(rows)
    if not m.n:
        return Whitening(m, [], 0.0)
    v = covariance(rows, m.means_removed)
    return Whitening(m, leading(v, components), float(np.trace(v)))


def identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured."""
    if not fitted.pairs:
        return 0.0
    return float(np.abs(covariance(rows, fitted.whitened) - np.eye(len(fitted.pairs))).max())


def apply(rows: DataFrame, fitted: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened array<double>) of every row of `rows`.

    `deviation` is the exact sum over the dimensions of (n * x - S)**2, null beyond a long.
    """
    schema = T.StructType([
        rows.schema["vec_id"], T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.ArrayType(T.DoubleType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _blocks(batches, 1):
            squares = (fitted.moments.centred(x) ** 2).sum(1)
            if not fitted.moments.exact:
                squares = [int(s) if s < 1 << 63 else None for s in squares]
            y = fitted.whitened(x) if fitted.pairs else np.zeros((len(x), 0))
            ends = pa.array(np.arange(len(y) + 1, dtype=np.int32) * y.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(squares, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(y.ravel()))],
                names=schema.names,
            )

    return map_arrow(rows, run, schema)


def whiten(df: DataFrame, components: int = COMPONENTS, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained,
    identity_error.

    Components are numbered from 1 by falling eigenvalue; directions without variance have none, so
    equal vectors, a single one and an empty table give no rows. Repeated rows and null ids stay.
    Other columns are left out.
    """
    rows = usable(df, vector, vec_id)
    fitted = fit(rows, components)
    error = identity_error(rows, fitted)
    shares = F.array(*(F.lit(p.value / fitted.trace) for p in fitted.pairs)).cast("array<double>")
    return apply(rows, fitted).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")
    ).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.moments.n).cast("long").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
