"""Embedding scorer: mean token vector, label vectors and their similarity."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.config import ModelConfig
from tallymark.functions import vectors

# Largest token table that is copied to every executor; a larger one is joined by shuffle.
_COPY_BYTES = 256 * 1024 * 1024
# Largest token table that is broadcast for a join, which the driver's JVM holds several times over.
_BROADCAST_BYTES = 32 * 1024 * 1024
# Rows whose token vectors are gathered together; bounds the memory of a batch.
_ROWS_AT_ONCE = 1024


def _can_copy(vocabulary: int, size: int, most: int = _COPY_BYTES, number: int = 8) -> bool:
    return vocabulary * (size * number + 32) <= most


def _copied_as(known: DataFrame, vocabulary: int, size: int) -> type | None:
    """The numbers that a copied token table consists of; None if it is too large to be copied.

    Doubles, or singles where the table is too large with doubles and all its numbers are singles anyway.
    """
    if _can_copy(vocabulary, size, _COPY_BYTES):
        return np.float64
    if not _can_copy(vocabulary, size, _COPY_BYTES, 4):
        return None
    exact = F.forall("vector", lambda x: x == x.cast("float").cast("double"))
    return np.float32 if known.agg(F.coalesce(F.bool_and(exact), F.lit(True))).first()[0] else None


def token_table(token_vectors: DataFrame, vocabulary: int, size: int) -> DataFrame:
    """One row (bucket, vector) per known bucket, so at most `vocabulary` - 1 rows.

    Bucket 0 is padding and buckets outside the vocabulary are not known; the vectors of a bucket
    that has several are averaged.
    """
    known = token_vectors.where((F.col("bucket") > 0) & (F.col("bucket") < vocabulary))
    means = known.groupBy(F.col("bucket").cast("long").alias("bucket")).agg(
        *vectors.mean_per_dimension(F.col("vector").cast("array<double>"), size)
    )
    return means.select("bucket", vectors.dimensions(size).alias("vector"))


def masked_mean(
    df: DataFrame,
    key: Sequence[str],
    buckets: str,
    token_vectors: DataFrame,
    size: int,
    vocabulary: int,
    output: str = "description_embedding",
) -> DataFrame:
    """Mean vector of the known tokens of every row (see `token_table`); none gives zeros.

    Where the token table fits on every executor, a row's buckets go to its key, and no vector moves.
    Otherwise tokens meet their vectors by a join, and the means combine before the shuffle, so a row
    sends one partial result, not one per token. Returns the key columns and `output`.
    """
    known = token_table(token_vectors, vocabulary, size)
    if _can_copy(vocabulary, size, _BROADCAST_BYTES):
        known = F.broadcast(known)
    elif numbers := _copied_as(known, vocabulary, size):
        return _local_means(df, key, buckets, _token_matrix(known, vocabulary, size, numbers), output)
    tokens = df.select(
        *key,
        F.explode_outer(
            F.filter(F.col(buckets).cast("array<bigint>"), lambda b: b != 0)
        ).alias("bucket"),
    )
    return (
        tokens.join(known, "bucket", "left")
        .groupBy(*key)
        .agg(*vectors.mean_per_dimension(F.col("vector"), size))
        .select(*key, vectors.dimensions(size).alias(output))
    )


def _local_means(
    df: DataFrame, key: Sequence[str], buckets: str, table: tuple[np.ndarray, np.ndarray], output: str
) -> DataFrame:
    """`masked_mean` by a token table (see `_token_matrix`) that is copied to every executor."""
    model, size = df.sparkSession.sparkContext.broadcast(table), table[0].shape[1]
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    @F.arrow_udf("array<double>")
    def sums(lists: pa.Array) -> pa.Array:
        """Of each row the number of its known tokens, then the sum of their vectors."""
        token_rows, known = model.value
        flat, rows = _lists(lists)
        found = np.zeros((len(lists), size + 1))
        for start in range(0, len(lists), _ROWS_AT_ONCE):
            stop = min(start + _ROWS_AT_ONCE, len(lists))
            low, high = np.searchsorted(rows, [start, stop])
            found[start:stop, 0], found[start:stop, 1:] = _sum_vectors(
                flat[low:high], rows[low:high] - start, stop - start, token_rows, known
            )
        offsets = np.arange(0, (len(lists) + 1) * (size + 1), size + 1, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))

    tokens = F.filter(F.col(buckets).cast("array<bigint>"), lambda b: b != 0)
    tokens = F.coalesce(tokens, F.array().cast("array<bigint>"))
    rows = df.select(*key, tokens.alias("_tokens")).repartition(*key)
    parts = rows.select(*key, sums("_tokens").alias("_part"))
    totals = parts.groupBy(*key).agg(*[F.sum(F.get("_part", F.lit(i))).alias(f"_dim{i}") for i in range(size + 1)])
    means = [F.when(F.col("_dim0") > 0, F.col(f"_dim{i + 1}") / F.col("_dim0")).otherwise(0.0) for i in range(size)]
    return totals.select(*key, F.array(*means).alias(output))


def label_centroids(df: DataFrame, label: str, vector: str, size: int) -> DataFrame:
    """Unit-length mean vector per label."""
    means = df.groupBy(label).agg(
        *vectors.mean_per_dimension(F.col(vector).cast("array<double>"), size)
    )
    return means.select(label, vectors.l2_normalize(vectors.dimensions(size)).alias("vector"))


def _label_rows(labels: DataFrame, index: str, n: int, size: int) -> DataFrame:
    """One row, one column `m`: n unit vectors in index order, zeros for an index without a vector.

    Vectors may have any length; those of an index that has several are averaged at unit length.
    Indices outside 0 to n - 1 are left out.
    """
    unit = vectors.l2_normalize(F.col("vector").cast("array<double>"))
    entries = labels.where((F.col(index) >= 0) & (F.col(index) < n)).select(
        F.col(index).cast("int").alias("i"), unit.alias("v")
    )
    cells = entries.select("i", F.posexplode("v").alias("pos", "x")).groupBy("i", "pos").agg(
        F.avg("x").alias("x")
    )
    rows = cells.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("v"))
    rows = rows.select("i", vectors.l2_normalize(F.transform("v", lambda e: e["x"])).alias("v"))
    known = rows.agg(F.map_from_entries(F.collect_list(F.struct("i", "v"))).alias("known"))
    zeros = F.array_repeat(F.lit(0.0), size)
    places = F.sequence(F.lit(0), F.lit(n - 1))
    return known.select(
        F.transform(places, lambda i: F.coalesce(F.try_element_at("known", i), zeros)).alias("m")
    )


def label_matrix(labels: DataFrame, index: str, n: int, size: int) -> Column:
    """The label vectors of n categories as one array of arrays (see `_label_rows`).

    A subquery rather than a join: the matrix becomes a constant of the projection that reads it.
    """
    return _label_rows(labels, index, n, size).scalar()


def with_similarities(df: DataFrame, vector: Column, matrix: Column, output: str) -> DataFrame:
    """Dot product of the unit row vector with every label vector of the matrix."""
    unit = vectors.l2_normalize(vector)
    scores = vectors.let(unit, lambda u: vectors.matvec(F.col("_labels"), u))
    return df.withColumn("_labels", matrix).withColumn(output, scores).drop("_labels")


def semi_hard_loss(similarity: Column, label_index: Column, margin: float) -> Column:
    """max(0, margin - (positive - negative)) of one row.

    The negative is the largest similarity below the positive one, or, when none is below, the
    smallest of all negatives.
    """
    positive = F.get(similarity, label_index)
    negatives = F.filter(similarity, lambda s, i: i != label_index)
    below = F.array_max(F.filter(negatives, lambda s: s < positive))
    negative = F.coalesce(below, F.array_min(negatives))
    return F.greatest(F.lit(0.0), negative - positive + F.lit(margin))


def parts_of(table: DataFrame, key: str, vector: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and vectors of a table, packed by its tasks and fetched a partition at a time."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, values = batch.column(0), batch.column(1).flatten()
            packed = [x.to_numpy(zero_copy_only=False).tobytes() for x in (keys, values)]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in packed], names=["keys", "packed"])

    rows = table.select(F.col(key).cast("long"), F.col(vector).cast("array<double>"))
    for row in rows.mapInArrow(pack, "keys binary, packed binary").toLocalIterator():
        keys = np.frombuffer(row["keys"], np.int64)
        if len(keys):
            yield keys, np.frombuffer(row["packed"]).reshape(len(keys), -1)


def _token_matrix(
    known: DataFrame, rows: int, size: int, numbers: type = np.float64
) -> tuple[np.ndarray, np.ndarray]:
    """A token table as a dense matrix, and which of its rows exist. Bounded by `rows`."""
    matrix = np.zeros((rows, size), numbers)
    present = np.zeros(rows, dtype=bool)
    for places, found in parts_of(known, "bucket", "vector"):
        matrix[places] = found
        present[places] = True
    return matrix, present


def _lists(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values of a list array, and the row each of them belongs to."""
    flat = array.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(array.offsets.to_numpy())
    return flat, np.repeat(np.arange(len(array)), lengths)


def _sum_vectors(
    buckets: np.ndarray, rows: np.ndarray, n: int, tokens: np.ndarray, present: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Number of known tokens per row and the sum of their vectors, in doubles; `rows` ascends."""
    inside = (buckets > 0) & (buckets < len(present))
    kept = inside & present[np.where(inside, buckets, 0)]
    buckets, rows = buckets[kept], rows[kept]
    sums, counts = np.zeros((n, tokens.shape[1])), np.zeros(n)
    if len(rows):
        starts = np.flatnonzero(np.r_[True, np.diff(rows) > 0])
        counts[rows[starts]] = np.diff(np.r_[starts, len(rows)])
        sums[rows[starts]] = np.add.reduceat(tokens[buckets], starts, dtype=np.float64)
    return counts, sums


def _mean_vectors(
    buckets: np.ndarray, rows: np.ndarray, n: int, tokens: np.ndarray, present: np.ndarray
) -> np.ndarray:
    """Mean token vector per row; `rows` ascends."""
    counts, sums = _sum_vectors(buckets, rows, n, tokens, present)
    return sums / np.maximum(counts, 1)[:, None]


@dataclass
class EmbeddingModel:
    """Token vectors (bucket, vector), label vectors (index, vector) and an optional dense layer
    given as one weight row and one bias per output dimension."""

    token_vectors: DataFrame
    label_vectors: DataFrame
    label_index: str = "index"
    weights: Sequence[Sequence[float]] | None = None
    bias: Sequence[float] | None = None

    def _transaction_vector(self) -> Column:
        text = F.col("description_embedding")
        if self.weights is None:
            return text
        rows = F.array(*[F.array(*[F.lit(float(w)) for w in row]) for row in self.weights])
        numeric = F.transform("preprocessed_numeric_features", lambda x: F.coalesce(x, F.lit(0.0)))
        inputs = F.concat(text, numeric)
        product = vectors.let(inputs, lambda x: vectors.matvec(rows, x))
        if self.bias is None:
            return product
        bias = F.array(*[F.lit(float(b)) for b in self.bias])
        return F.zip_with(product, bias, lambda p, b: p + b)

    def _label_size(self, config: ModelConfig) -> int:
        return config.embedding_size if self.weights is None else len(self.weights)

    def score(self, df: DataFrame, key: Sequence[str], config: ModelConfig) -> DataFrame:
        """Add `scores`, one similarity per trainable category, to rows with features.

        A model that fits on every executor scores rows where they are: no shuffle, and dense
        arithmetic on Arrow batches. A larger one looks its tokens up by a join.
        """
        known = token_table(self.token_vectors, config.hash_buckets, config.embedding_size)
        if numbers := _copied_as(known, config.hash_buckets, config.embedding_size):
            table = _token_matrix(known, config.hash_buckets, config.embedding_size, numbers)
            return df.withColumn("scores", self._local_scorer(df.sparkSession, config, *table))
        means = masked_mean(
            df, key, "preprocessed_description", self.token_vectors, config.embedding_size,
            config.hash_buckets,
        )
        rows = df.join(means, list(key), "inner")
        matrix = label_matrix(
            self.label_vectors, self.label_index, len(config.trainable), self._label_size(config)
        )
        scored = with_similarities(rows, self._transaction_vector(), matrix, "scores")
        return scored.drop("description_embedding")

    def _local_scorer(
        self, spark: SparkSession, config: ModelConfig, tokens: np.ndarray, present: np.ndarray
    ) -> Column:
        n_labels = len(config.trainable)
        rows = _label_rows(self.label_vectors, self.label_index, n_labels, self._label_size(config))
        labels = np.array(rows.first().m, dtype=float)
        weights = None if self.weights is None else np.asarray(self.weights, dtype=float).T
        bias = 0.0 if self.bias is None else np.asarray(self.bias, dtype=float)
        model = spark.sparkContext.broadcast((tokens, present, labels.T.copy(), weights, bias))
        smallest = vectors.EPSILON
        # The function travels with its helpers, so workers need not have this package.
        cloudpickle.register_pickle_by_value(sys.modules[__name__])

        @F.arrow_udf("array<double>")
        def similarity(buckets: pa.Array, numeric: pa.Array) -> pa.Array:
            token_rows, known, label_columns, dense, offset = model.value
            n, size = len(buckets), label_columns.shape[1]
            flat, rows = _lists(buckets)
            scores = np.empty((n, size))
            for start in range(0, n, _ROWS_AT_ONCE):
                stop = min(start + _ROWS_AT_ONCE, n)
                low, high = np.searchsorted(rows, [start, stop])
                x = _mean_vectors(
                    flat[low:high], rows[low:high] - start, stop - start, token_rows, known
                )
                if dense is not None:
                    extra = np.array(numeric.slice(start, stop - start).to_pylist(), dtype=float)
                    x = np.hstack([x, np.nan_to_num(extra)]) @ dense + offset
                norm = np.sqrt(np.maximum((x * x).sum(axis=1), smallest))
                scores[start:stop] = (x / norm[:, None]) @ label_columns
            offsets = np.arange(0, (n + 1) * size, size, dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(scores.ravel()))

        return similarity("preprocessed_description", "preprocessed_numeric_features")
