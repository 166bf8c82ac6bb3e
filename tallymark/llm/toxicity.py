"""Toxicity categories by a classifier chain of linear models.

Categories are predicted one after the other. A category's model is a logistic regression on the
words of a text (presence, hashed into 2**BITS buckets; words in fewer than `least_texts` texts of
the sample are no features) and on the probabilities of the categories before it. While training, those probabilities come from models of the other folds, so a later
model sees earlier categories with the errors they have on new texts; for prediction each category
has one model of all training rows.

Training takes a bounded sample: at most `sample` labelled documents, drawn by a hash of their ids,
whole texts; of documents with the same words and labels one counts. Their word buckets meet in one
task that fits all models; only the weights, at most 2**BITS a category, pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.batches import list_array, map_arrow, sliced, text_array, without
from tallymark.llm.graph import staged
from tallymark.llm.letters import LetterWords

BITS = 18
SAMPLE = 20_000
FOLDS = 3
PENALTY = 1e-4
LEAST_TEXTS = 5
NEVER = 35.0  # as a log odds


def word_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and word buckets, each pair once, by text."""
    words = LetterWords(texts)
    bucket = (words.hashes >> np.uint64(64 - BITS)).astype(np.int64)
    pairs = np.unique(words.text.astype(np.int64) << BITS | bucket)
    return pairs >> BITS, (pairs & ((1 << BITS) - 1)).astype(np.int32)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -NEVER, NEVER)))


class _Rows:
    """Texts as sparse rows of words, 0 to `words` - 1, next to a few dense columns."""

    def __init__(self, row: np.ndarray, word: np.ndarray, n: int, words: int, dense: np.ndarray):
        self.row, self.word, self.n, self.words, self.dense = row, word, n, words, dense

    def times(self, w: np.ndarray) -> np.ndarray:
        """w: weights of the words, of the dense columns, and the constant."""
        sparse = np.bincount(self.row, w[self.word], self.n)
        return sparse + self.dense @ w[self.words : -1] + w[-1]

    def transposed(self, r: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.word, r[self.row], self.words)
        return np.concatenate([sparse, self.dense.T @ r, [r.sum()]])


def fit_logistic(x: _Rows, y: np.ndarray, rows: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Weights that minimise mean log loss over `rows` plus a penalty, by L-BFGS.

    A word counts by the logarithm of its smoothed frequencies in both classes, so words that
    decide little are penalised most.
    """
    w = np.zeros(x.words + x.dense.shape[1] + 1)
    share = float(y[rows].mean()) if rows.any() else 0.0
    if not 0 < share < 1:
        w[-1] = NEVER if share == 1 else -NEVER
        return w
    w[-1] = np.log(share / (1 - share))
    yes, no = (np.bincount(x.word, (rows & (y == v))[x.row].astype(float), x.words) + 1 for v in (1, 0))
    scale = np.ones(len(w))
    scale[: x.words] = np.log((yes / yes.sum()) / (no / no.sum()))
    use = rows / rows.sum()

    def loss(w):
        z = x.times(w * scale)
        value = (use * np.logaddexp(0, np.where(y > 0, -z, z))).sum() + PENALTY / 2 * (w[:-1] @ w[:-1])
        gradient = x.transposed(use * (_sigmoid(z) - y)) * scale
        gradient[:-1] += PENALTY * w[:-1]
        return value, gradient

    value, gradient = loss(w)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        direction, alphas = -gradient, []
        for s, d, rho in reversed(steps):
            alphas.append(rho * (s @ direction))
            direction -= alphas[-1] * d
        if steps:
            s, d, _ = steps[-1]
            direction *= (s @ d) / (d @ d)
        for (s, d, rho), a in zip(steps, reversed(alphas)):
            direction += (a - rho * (d @ direction)) * s
        size, slope = 1.0, gradient @ direction
        while True:
            new, new_gradient = loss(w + size * direction)
            if new <= value + 1e-4 * size * slope or size < 1e-8:
                break
            size /= 2
        s, d = size * direction, new_gradient - gradient
        if s @ d > 1e-12:
            steps = [*steps[-9:], (s, d, 1 / (s @ d))]
        done = value - new < 1e-6 * max(abs(value), 1e-9)
        w, value, gradient = w + s, new, new_gradient
        if done:
            break
    return w * scale


@dataclass
class Chain:
    """For each category the weights of buckets, of earlier categories, and the constant."""

    categories: list[str]
    weights: list[np.ndarray]

    def probabilities(self, texts: list[str]) -> np.ndarray:
        row, bucket = word_buckets(texts)
        dense = np.zeros((len(texts), 0))
        for w in self.weights:
            p = _sigmoid(_Rows(row, bucket, len(texts), 1 << BITS, dense).times(w))
            dense = np.column_stack([dense, p])
        return dense


def train_chain(
    row: np.ndarray, bucket: np.ndarray, labels: np.ndarray, fold: np.ndarray, least_texts: int = LEAST_TEXTS
) -> list[np.ndarray]:
    """Weights for each column of `labels` (0, 1, or nan: no label), chained in their order."""
    n = len(labels)
    common = np.flatnonzero(np.bincount(bucket, minlength=1 << BITS) >= least_texts)
    number = np.full(1 << BITS, -1)
    number[common] = np.arange(len(common))
    word = number[bucket]
    row, word = row[word >= 0], word[word >= 0]
    dense, weights = np.zeros((n, 0)), []
    for k in range(labels.shape[1]):
        x, y = _Rows(row, word, n, len(common), dense), np.nan_to_num(labels[:, k])
        known = ~np.isnan(labels[:, k])
        w = fit_logistic(x, y, known)
        weights.append(np.zeros((1 << BITS) + k + 1))
        weights[-1][common] = w[: len(common)]
        weights[-1][1 << BITS :] = w[len(common) :]
        if k + 1 < labels.shape[1]:
            out_of_fold = np.zeros(n)
            for f in np.unique(fold):
                w = fit_logistic(x, y, known & (fold != f))
                out_of_fold[fold == f] = _sigmoid(x.times(w))[fold == f]
            dense = np.column_stack([dense, out_of_fold])
    return weights


def _chosen(labels: DataFrame, categories: list[str], sample: int, doc_id: str) -> DataFrame:
    """(doc, y0, y1, ...) of at most `sample` ids."""
    draw = F.pmod(F.xxhash64(F.col("doc"), F.lit("toxicity")), F.lit(1 << 30))
    named = labels.select(
        F.col(doc_id).cast("long").alias("doc"), *(F.col(c).cast("double").alias(f"y{k}") for k, c in enumerate(categories))
    ).filter("doc is not null").groupBy("doc").agg(*(F.max(f"y{k}").alias(f"y{k}") for k in range(len(categories))))
    rate = min(1.0, sample / max(1, named.count()))
    return named.filter(draw <= int(rate * (1 << 30))).orderBy(draw, "doc").limit(sample)


def fit(
    df: DataFrame, labels: DataFrame, categories: list[str], sample: int = SAMPLE,
    folds: int = FOLDS, least_texts: int = LEAST_TEXTS, text: str = "text", doc_id: str = "doc_id",
) -> Chain:
    """The chain of `categories` (columns of `labels`: 0, 1 or null), trained on texts of `df`.

    A null text counts as empty; an id with several labels has the largest of each category, and
    null ids have none. A category without labels, or with one value only, gets the probability of
    that value (0 without labels) for every text.
    """
    chosen = _chosen(labels, categories, sample, doc_id)
    docs = df.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    rows = docs.join(F.broadcast(chosen), "doc").select(
        "text", F.pmod(F.xxhash64("doc", F.lit("fold")), F.lit(folds)).cast("int").alias("fold"),
        F.array(*(f"y{k}" for k in range(len(categories)))).alias("y"),
    )

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, 0):
                row, bucket = word_buckets(text_array(batch.column(0)).to_pylist())
                buckets = list_array(bucket, np.bincount(row, minlength=batch.num_rows), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [buckets, batch.column(1), batch.column(2)], names=["buckets", "fold", "y"]
                )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        lengths = [b.column(0).value_lengths().to_numpy(zero_copy_only=False) for b in got]
        buckets = [b.column(0).flatten().to_numpy(zero_copy_only=False) for b in got]
        y = [np.array(b.column(2).to_pylist(), float).reshape(-1, len(categories)) for b in got]
        fold = [b.column(1).to_numpy(zero_copy_only=False) for b in got]
        counts = np.concatenate([*lengths, np.zeros(0, np.int64)]).astype(np.int64)
        weights = train_chain(
            np.repeat(np.arange(len(counts)), counts),
            np.concatenate([*buckets, np.zeros(0, np.int32)]).astype(np.int64),
            np.concatenate([*y, np.zeros((0, len(categories)))]),
            np.concatenate([*fold, np.zeros(0, np.int32)]),
            least_texts,
        )
        for k, w in enumerate(weights):
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k, np.int32)), pa.array(at), pa.array(w[at])],
                names=["category", "place", "weight"],
            )

    gathered = staged(map_arrow(rows, words, "buckets array<int>, fold int, y array<double>"), "words")
    mark = F.xxhash64("buckets", "y")
    rows = gathered.groupBy("buckets", "y").agg(F.min("fold").alias("fold")).select("buckets", "fold", "y")
    found = map_arrow(
        rows.orderBy(mark, "buckets", "y").limit(sample).coalesce(1), train,
        "category int, place long, weight double",
    ).toPandas()
    weights = []
    for k in range(len(categories)):
        w = np.zeros((1 << BITS) + k + 1)
        own = found[found.category == k]
        w[own.place.to_numpy()] = own.weight.to_numpy()
        if not len(own):  # no rows at all
            w[-1] = -NEVER
        weights.append(w)
    return Chain(list(categories), weights)


def predict(df: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """`df` with p_<category> (0 to 1) for each category of the chain, of every whole text.

    Null and empty texts get the probability of a text without known words. Columns of these names
    are replaced, other columns and repeated rows stay.
    """
    data = df.sparkSession.sparkContext.broadcast(chain)
    added = [f"p_{c}" for c in chain.categories]
    kept = without(df, *added)
    column = kept.columns.index(text)
    schema = T.StructType([*kept.schema.fields, *(T.StructField(n, T.DoubleType()) for n in added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, column):
                p = data.value.probabilities(text_array(batch.column(column)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *(pa.array(p[:, k]) for k in range(len(added)))],
                    names=schema.names,
                )

    return map_arrow(kept, run, schema)
