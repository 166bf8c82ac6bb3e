"""Training of token vectors, a dense layer and label vectors on the semi-hard loss.

A row's vector is a dense layer over the mean of its token vectors and its numeric features, brought
to unit length; its scores are the dot products with the unit label vectors. Training runs in
rounds. In a round every partition starts from the same parameters and takes Adam steps over its own
rows; what it changed, only the vectors of tokens it met, is averaged by Spark into the parameters
of the next round. After each round the validation rows are scored. `Schedule` decides from that
alone how fast the next round learns and when training ends; the best round's parameters stay. By
default a round is judged by the share of validation rows whose label does not come first: vectors
that have not spread yet can have a small loss and tell nothing apart.

The driver holds the parameters (token vectors of the vocabulary at most) and one line per round,
never rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.config import TARGET_INDEX, ModelConfig
from tallymark.operators import filters
from tallymark.operators.embedding import EmbeddingModel, parts_of
from tallymark.staging import discard, stage

NUMERIC = 3
PARTITION_ROWS = 25_000
MOST_PARTITIONS = 64
# Vectors of a task that turns parameters into rows, and of an Arrow batch.
_TASK_VECTORS, _BATCH_VECTORS = 100_000, 4096
# Vectors of a task that merges the changes of a round.
_MERGED_VECTORS = 50_000
# Numbers of a table that finds places of buckets.
_LONGEST_TABLE = 1 << 24
# A message's array and place as one number.
_PLACES = 1 << 40
_SMALL = 1e-12


@dataclass
class Parameters:
    """`buckets` ascends; tokens[k] is the vector of buckets[k]."""

    buckets: np.ndarray
    tokens: np.ndarray
    dense: np.ndarray
    bias: np.ndarray
    labels: np.ndarray

    @staticmethod
    def initial(buckets: np.ndarray, size: int, n_labels: int, seed: int) -> Parameters:
        pick = np.random.default_rng(seed)
        edge = np.sqrt(6 / (2 * size + NUMERIC))
        return Parameters(
            buckets,
            pick.uniform(-0.05, 0.05, (len(buckets), size)),
            pick.uniform(-edge, edge, (size + NUMERIC, size)),
            np.zeros(size),
            pick.uniform(-0.05, 0.05, (n_labels, size)),
        )

    def copy(self) -> Parameters:
        return Parameters(
            self.buckets, self.tokens.copy(), self.dense.copy(), self.bias.copy(), self.labels.copy()
        )

    @property
    def groups(self) -> tuple[np.ndarray, ...]:
        """The arrays that training changes; a message names them by their place here."""
        return self.tokens, self.dense, self.bias.reshape(1, -1), self.labels


@dataclass
class Batch:
    """Rows as token places (in Parameters.tokens) with the row of each, numeric features, labels."""

    place: np.ndarray
    row: np.ndarray
    numeric: np.ndarray
    label: np.ndarray

    @property
    def n(self) -> int:
        return len(self.label)

    def part(self, start: int, stop: int) -> Batch:
        low, high = np.searchsorted(self.row, [start, stop])
        return Batch(
            self.place[low:high], self.row[low:high] - start, self.numeric[start:stop],
            self.label[start:stop],
        )


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.sqrt(np.maximum((x * x).sum(1), _SMALL))
    return x / norm[:, None], norm


def _semi_hard(similarity: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive similarity of each row, and the place of its negative: the largest below the
    positive one, or the smallest of all negatives where none is below."""
    rows = np.arange(len(label))
    positive = similarity[rows, label]
    below = similarity < positive[:, None]
    place = np.where(below, similarity, -np.inf).argmax(1)
    least = np.flatnonzero(~below.any(1))
    if len(least):
        others = similarity[least]
        others[np.arange(len(least)), label[least]] = np.inf
        place[least] = others.argmin(1)
    return positive, place


@dataclass
class _Forward:
    x: np.ndarray
    counts: np.ndarray
    unit: np.ndarray
    norm: np.ndarray
    labels: np.ndarray
    label_norm: np.ndarray
    similarity: np.ndarray


def _forward(p: Parameters, batch: Batch) -> _Forward:
    size = p.tokens.shape[1]
    counts = np.bincount(batch.row, minlength=batch.n)
    x = np.zeros((batch.n, size + NUMERIC))
    x[:, size:] = batch.numeric
    some = np.flatnonzero(counts)
    if len(some):
        sums = np.add.reduceat(p.tokens[batch.place], (np.cumsum(counts) - counts)[some])
        x[some, :size] = sums / counts[some][:, None]
    unit, norm = _unit(x @ p.dense + p.bias)
    labels, label_norm = _unit(p.labels)
    return _Forward(x, counts, unit, norm, labels, label_norm, unit @ labels.T)


def similarities(p: Parameters, batch: Batch) -> np.ndarray:
    return _forward(p, batch).similarity


def loss_and_gradients(
    p: Parameters, batch: Batch, margin: float
) -> tuple[float, np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    """Mean loss; places of the tokens that the batch holds, their gradients, and those of the dense
    layer, the bias and the labels."""
    f = _forward(p, batch)
    size = p.tokens.shape[1]
    positive, negative = _semi_hard(f.similarity, batch.label)
    loss = margin - positive + f.similarity[np.arange(batch.n), negative]
    active = np.flatnonzero(loss > 0)
    mean = float(loss[active].sum() / batch.n)
    places = np.unique(batch.place)
    tokens = np.zeros((len(places), size))
    if not len(active):
        return mean, places, tokens, tuple(np.zeros(g.shape) for g in p.groups[1:])
    # Rows without a loss have no gradient.
    rows, unit = np.arange(len(active)), f.unit[active]
    by_score = np.zeros((len(active), len(f.labels)))
    by_score[rows, negative[active]] += 1 / batch.n
    by_score[rows, batch.label[active]] -= 1 / batch.n

    by_unit, by_label = by_score @ f.labels, by_score.T @ unit
    by_vector = (by_unit - unit * (unit * by_unit).sum(1, keepdims=True)) / f.norm[active][:, None]
    labels = (by_label - f.labels * (f.labels * by_label).sum(1, keepdims=True)) / f.label_norm[:, None]
    by_mean = (by_vector @ p.dense.T)[:, :size] / np.maximum(f.counts[active], 1)[:, None]

    number = np.full(batch.n, -1)
    number[active] = rows
    row = number[batch.row]
    place, row = batch.place[row >= 0], row[row >= 0]
    order = np.argsort(place, kind="stable")
    moved, first = np.unique(place[order], return_index=True)
    if len(moved):
        tokens[np.searchsorted(places, moved)] = np.add.reduceat(by_mean[row[order]], first)
    others = (f.x[active].T @ by_vector, by_vector.sum(0, keepdims=True), labels)
    return mean, places, tokens, others


class Adam:
    """Steps over parameters; token vectors move only when a batch holds them.

    Only tokens that had a gradient have moments, kept in rows in the order of their first one; steps leave out the others.
    """

    def __init__(self, p: Parameters, rate: float):
        self.p, self.rate, self.steps, self.used = p, rate, 0, 0
        shapes = [(min(len(p.tokens), 1024), p.tokens.shape[1]), *(g.shape for g in p.groups[1:])]
        self.first = [np.zeros(x) for x in shapes]
        self.second = [np.zeros(x) for x in shapes]
        self.row = np.full(len(p.tokens), -1, np.int32)

    @property
    def live(self) -> np.ndarray:
        """Which tokens had a gradient."""
        return self.row >= 0

    def _give_rows(self, places: np.ndarray) -> None:
        self.row[places] = np.arange(self.used, self.used + len(places))
        self.used += len(places)
        for moments in (self.first, self.second):
            have, size = moments[0].shape
            if self.used > have:
                more = np.zeros((min(len(self.row), max(2 * have, self.used)), size))
                more[:have] = moments[0]
                moments[0] = more

    def step(self, places: np.ndarray, tokens: np.ndarray, others: tuple[np.ndarray, ...]) -> None:
        self.steps += 1
        rate = self.rate * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        new = places[tokens.any(1) & (self.row[places] < 0)]
        if len(new):
            self._give_rows(new)
        rows = self.row[places]
        kept = np.flatnonzero(rows >= 0)
        whole = [slice(None)] * len(others)
        held, moments = [places[kept], *whole], [rows[kept], *whole]
        for group, m, v, at, row, g in zip(self.p.groups, self.first, self.second, held, moments, (tokens[kept], *others)):
            m[row] = first = 0.9 * m[row] + 0.1 * g
            v[row] = second = 0.999 * v[row] + 0.001 * g * g
            group[at] -= rate * first / (np.sqrt(second) + 1e-7)


class _Places:
    """Places of buckets among the known ones, which ascend: by a table, or by bisection where that would be long."""

    def __init__(self, known: np.ndarray):
        self.known, self.table = known, None
        if len(known) and 0 <= known[0] and known[-1] < _LONGEST_TABLE:
            self.table = np.full(known[-1] + 2, -1, np.int32)
            self.table[known] = np.arange(len(known))

    def find(self, buckets: np.ndarray) -> np.ndarray:
        """-1 for an unknown bucket."""
        if self.table is not None:
            return self.table[np.where((buckets >= 0) & (buckets < len(self.table)), buckets, -1)]
        if not len(self.known):
            return np.full(len(buckets), -1)
        at = np.minimum(np.searchsorted(self.known, buckets), len(self.known) - 1)
        return np.where(self.known[at] == buckets, at, -1)


def _batch(columns: pa.RecordBatch, places: _Places) -> Batch:
    """Rows (buckets, numeric, label) with their known buckets; a null feature counts as 0."""
    buckets = columns.column(0)
    at = places.find(buckets.flatten().to_numpy(zero_copy_only=False))
    row = np.repeat(np.arange(len(buckets)), buckets.value_lengths().to_numpy(zero_copy_only=False))
    kept = at >= 0
    numeric = columns.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, NUMERIC)
    return Batch(at[kept], row[kept], np.nan_to_num(numeric), columns.column(2).to_numpy())


@dataclass
class Schedule:
    """What counts as better (a smaller `monitor`), how the rate falls, and when training ends.

    `monitor` is "error" (the share of validation rows whose label does not come first) or "loss".
    The rate is cut by `factor` after `patience` rounds that are not better by `min_delta`, down to
    `least_rate`; `stop_after` such rounds end training, as do `most_rounds` rounds.
    """

    rate: float = 0.01
    factor: float = 0.1
    patience: int = 2
    least_rate: float = 1e-4
    stop_after: int = 4
    min_delta: float = 1e-3
    most_rounds: int = 40
    monitor: str = "error"

    def after(self, values: list[float]) -> tuple[float, bool]:
        """The rate of the next round, and whether training is over, after rounds of these values."""
        best, rate, waited, since = np.inf, self.rate, 0, 0
        for value in values:
            if value < best - self.min_delta:
                best, waited, since = value, 0, 0
                continue
            waited, since = waited + 1, since + 1
            if waited >= self.patience:
                rate, waited = max(rate * self.factor, self.least_rate), 0
        return rate, since >= self.stop_after or len(values) >= self.most_rounds

    def value(self, round_: Round) -> float:
        return round_.validation_loss if self.monitor == "loss" else round_.validation_error

    def best_round(self, rounds: list[Round]) -> int:
        """The round with the least monitored value, of equal ones that with the least loss, the first."""
        return min(range(len(rounds)), key=lambda k: (self.value(rounds[k]), rounds[k].validation_loss, k))


@dataclass
class Round:
    number: int
    rate: float
    train_loss: float
    validation_loss: float
    validation_error: float


@dataclass
class Fit:
    parameters: Parameters
    rounds: list[Round] = field(default_factory=list)
    best: int = -1

    def model(self, spark: SparkSession) -> EmbeddingModel:
        """The scorer of the best round."""
        p = self.parameters
        indices = pa.table({
            "index": pa.array(np.arange(len(p.labels)), pa.int64()),
            "vector": pa.array(list(p.labels), pa.list_(pa.float64())),
        })
        return EmbeddingModel(
            _token_rows(spark, p.buckets, p.tokens), spark.createDataFrame(indices),
            weights=p.dense.T.tolist(), bias=p.bias.tolist(),
        )


def _token_rows(spark: SparkSession, buckets: np.ndarray, tokens: np.ndarray) -> DataFrame:
    """(bucket, vector) rows, made by tasks and written once: the JVM of the driver never holds them."""
    shared = spark.sparkContext.broadcast((buckets, tokens))
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, vectors = shared.value
        for columns in batches:
            at = columns.column(0).to_numpy()
            for low in range(0, len(at), _BATCH_VECTORS):
                some = at[low : low + _BATCH_VECTORS]
                ends = np.arange(len(some) + 1, dtype=np.int32) * vectors.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(vectors[some].ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(keys[some], pa.int64()), lists], names=["bucket", "vector"])

    numbers = spark.range(0, len(buckets), 1, max(1, -(-len(buckets) // _TASK_VECTORS)))
    rows = stage(numbers.mapInArrow(run, "bucket long, vector array<double>"), "token-vectors")
    shared.destroy()
    return rows


def _rows(df: DataFrame, config: ModelConfig) -> DataFrame:
    """(buckets, numeric, label) of the rows with a trainable label; padding goes, null is empty."""
    label = F.col(TARGET_INDEX)
    kept = filters.without_excluded_labels(df, config).where((label >= 0) & (label < len(config.trainable)))
    buckets = F.filter(F.col("preprocessed_description").cast("array<bigint>"), lambda b: b > 0)
    numeric = F.col("preprocessed_numeric_features").cast("array<double>")
    return kept.select(
        F.coalesce(buckets, F.array().cast("array<bigint>")).alias("buckets"),
        F.coalesce(numeric, F.array(*[F.lit(0.0)] * NUMERIC)).alias("numeric"),
        label.cast("long").alias("label"),
    )


def _mixed(rows: DataFrame, n: int) -> DataFrame:
    """The rows in n files of about equal size, each in the order of a hash, so that batches mix labels."""
    return rows.repartition(n).sortWithinPartitions(F.xxhash64("buckets", "numeric", "label"))


def _round(rows: DataFrame, start: Parameters, rate: float, margin: float, size: int) -> tuple[Parameters, float]:
    """The averaged parameters after each partition's steps, and the mean loss met on the way."""
    shared = rows.sparkSession.sparkContext.broadcast(start)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    schema = "kind int, place long, weight double, change array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = shared.value
        p = begin.copy()
        adam, met, total, loss = Adam(p, rate), np.zeros(len(p.buckets)), 0, 0.0
        known = _Places(p.buckets)
        for columns in batches:
            whole = _batch(columns, known)
            for low in range(0, whole.n, size):
                part = whole.part(low, min(low + size, whole.n))
                value, places, tokens, others = loss_and_gradients(p, part, margin)
                adam.step(places, tokens, others)
                met[places] += 1
                total, loss = total + part.n, loss + value * part.n
        if not total:
            return
        yield _message(-1, np.zeros(1, np.int64), np.full(1, float(total)), np.full((1, 1), loss / total))
        live = adam.live
        for kind, (new, old) in enumerate(zip(p.groups, begin.groups)):
            at = np.flatnonzero(live) if kind == 0 else np.arange(len(new))
            weight = met[at] if kind == 0 else np.full(len(at), float(total))
            for low in range(0, len(at), 4096):
                some = at[low : low + 4096]
                yield _message(kind, some, weight[low : low + 4096], new[some] - old[some])
        # Tokens that were met and stayed where they were count by their weight alone.
        still = np.flatnonzero((met > 0) & ~live)
        for low in range(0, len(still), 65536):
            yield _message(0, still[low : low + 65536], met[still[low : low + 65536]], None)

    def _message(kind: int, place: np.ndarray, weight: np.ndarray, change: np.ndarray | None) -> pa.RecordBatch:
        if change is None:
            changes = pa.nulls(len(place), pa.list_(pa.float64()))
        else:
            ends = np.arange(len(place) + 1, dtype=np.int32) * change.shape[1]
            changes = pa.ListArray.from_arrays(pa.array(ends), pa.array(change.ravel()))
        kinds = pa.array(np.full(len(place), kind, np.int32))
        return pa.RecordBatch.from_arrays(
            [kinds, pa.array(place.astype(np.int64)), pa.array(weight), changes], names=["kind", "place", "weight", "change"]
        )

    dims = start.tokens.shape[1]
    weight = F.col("weight")
    sums = [F.sum(F.get("change", F.lit(d)) * weight).alias(f"_{d}") for d in range(dims)]
    # The number of tasks goes by the vectors: changes that are mostly null or zero take few bytes, but not few rows.
    changes = rows.mapInArrow(run, schema).repartition(max(1, -(-len(start.buckets) // _MERGED_VECTORS)), "place")
    means = changes.groupBy("kind", "place").agg(F.sum("weight").alias("weight"), *sums).where("_0 is not null")
    means = means.select(
        ((F.col("kind") + 1) * _PLACES + F.col("place")).alias("at"),
        F.array(*[F.coalesce(F.col(f"_{d}") / weight, F.lit(0.0)) for d in range(dims)]).alias("change"),
    )
    # Merged by all tasks, as parts are then read one after another.
    merged = stage(means, "changes")
    out, loss = start.copy(), 0.0
    for at, change in parts_of(merged, "at", "change"):
        kind, place = at // _PLACES - 1, at % _PLACES
        for k, group in enumerate(out.groups):
            group[place[kind == k]] += change[kind == k]
        if (kind == -1).any():
            loss = float(change[kind == -1][0, 0])
    discard(merged)
    shared.destroy()
    return out, loss


def measure(rows: DataFrame, p: Parameters, margin: float) -> tuple[int, float, float]:
    """Number of rows, their mean loss, and the share whose best score is their label's."""
    shared = rows.sparkSession.sparkContext.broadcast(p)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, loss, right = 0, 0.0, 0
        known = _Places(shared.value.buckets)
        for columns in batches:
            whole = _batch(columns, known)
            for low in range(0, whole.n, 4096):
                part = whole.part(low, min(low + 4096, whole.n))
                scores = similarities(shared.value, part)
                positive, negative = _semi_hard(scores, part.label)
                loss += np.maximum(margin - positive + scores[np.arange(part.n), negative], 0).sum()
                right += int((scores.argmax(1) == part.label).sum())
                n += part.n
        yield pa.RecordBatch.from_pydict({"n": [n], "loss": [float(loss)], "right_ones": [right]})

    found = rows.mapInArrow(run, "n long, loss double, right_ones long").agg(
        F.sum("n").alias("n"), F.sum("loss").alias("loss"), F.sum("right_ones").alias("right_ones")
    ).first()
    shared.destroy()
    n = found["n"] or 0
    return n, (found["loss"] / n if n else 0.0), (found["right_ones"] / n if n else 0.0)


def fit(
    train: DataFrame, validation: DataFrame, config: ModelConfig, schedule: Schedule | None = None,
    partitions: int | None = None, batch_size: int | None = None, margin: float | None = None,
    seed: int | None = None, observe: Callable[[Round, Parameters], None] | None = None,
) -> Fit:
    """Train on rows with features and labels, and keep the round that `schedule` finds best.

    Excluded labels are left out. Without validation rows the training rows are measured instead.
    Without training rows there is no fit. `partitions` train side by side, by default one for
    PARTITION_ROWS rows. `observe(round, parameters)` sees every round.
    """
    schedule = schedule or Schedule(rate=config.learning_rate, most_rounds=config.max_epochs)
    margin, seed = config.margin if margin is None else margin, config.seed if seed is None else seed
    batch_size = batch_size or config.batch_size
    rows = stage(_rows(train, config), "training-rows")
    n = rows.count()
    if not n:
        raise ValueError("no rows with a trainable label")
    partitions = partitions or min(MOST_PARTITIONS, -(-n // PARTITION_ROWS))
    mixed = stage(_mixed(rows, partitions), "training-rows")
    held = stage(_rows(validation, config), "validation-rows")
    judged = held if held.count() else mixed
    known = rows.select(F.explode("buckets").alias("b")).where(F.col("b") < config.hash_buckets).distinct()
    buckets = np.sort(known.toArrow().column("b").to_numpy())
    found = Fit(Parameters.initial(buckets, config.embedding_size, len(config.trainable), seed))
    p, over = found.parameters, False
    while not over:
        values = [schedule.value(r) for r in found.rounds]
        rate, _ = schedule.after(values)
        p, train_loss = _round(mixed, p, rate, margin, batch_size)
        _, loss, recall = measure(judged, p, margin)
        found.rounds.append(Round(len(found.rounds), rate, train_loss, loss, 1 - recall))
        if schedule.best_round(found.rounds) == len(found.rounds) - 1:
            found.parameters, found.best = p, len(found.rounds) - 1
        if observe:
            observe(found.rounds[-1], p)
        _, over = schedule.after([*values, schedule.value(found.rounds[-1])])
    discard(rows, mixed, held)
    return found
