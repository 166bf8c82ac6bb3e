"""Metric learning: gradients, rounds, the schedule, the chosen round, and what it beats."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymark.config import RETAIL
from tallymark.operators import embedding, metric_learning
from tallymark.operators.metric_learning import Adam, Batch, Parameters, Schedule, fit, loss_and_gradients

CONFIG = RETAIL.with_values(hash_buckets=200, embedding_size=8)


def some_batch(pick, n, tokens, labels, longest=6):
    counts = pick.integers(0, longest, n)
    row = np.repeat(np.arange(n), counts)
    return Batch(
        pick.integers(0, tokens, len(row)), row, pick.normal(size=(n, metric_learning.NUMERIC)), pick.integers(0, labels, n)
    )


def test_gradients_equal_finite_differences():
    pick = np.random.default_rng(0)
    p = Parameters.initial(np.arange(1, 13), 5, 7, 1)
    for group in p.groups:
        group += pick.normal(size=group.shape) * 0.5
    batch = some_batch(pick, 20, 12, 7)
    loss, places, tokens, others = loss_and_gradients(p, batch, 0.4)
    assert loss > 0
    whole = np.zeros(p.tokens.shape)
    whole[places] = tokens
    for group, gradient in zip(p.groups, (whole, *others)):
        for at in np.ndindex(group.shape):
            kept = group[at]
            sides = []
            for step in (1e-6, -1e-6):
                group[at] = kept + step
                sides.append(loss_and_gradients(p, batch, 0.4)[0])
            group[at] = kept
            assert abs((sides[0] - sides[1]) / 2e-6 - gradient[at]) < 1e-6


def test_loss_equals_the_column_operator(spark):
    """The same semi-hard negative as `embedding.semi_hard_loss`."""
    pick = np.random.default_rng(3)
    scores, label = pick.normal(size=(200, 6)).round(1), pick.integers(0, 6, 200)
    positive, negative = metric_learning._semi_hard(scores, label)
    loss = np.maximum(0.3 - positive + scores[np.arange(200), negative], 0)
    rows = spark.createDataFrame([(k, s, int(y)) for k, (s, y) in enumerate(zip(scores.tolist(), label))], "k int, s array<double>, y int")
    found = rows.select("k", embedding.semi_hard_loss(F.col("s"), F.col("y"), 0.3).alias("l")).collect()
    assert np.allclose([r.l for r in sorted(found)], loss)


def made(spark, n=600, seed=5):
    """Six labels; a row's buckets are noise and one or two of the label's own."""
    pick = random.Random(seed)
    rows = []
    for k in range(n):
        label = pick.randrange(6)
        own = [label * 5 + 1 + pick.randrange(5) for _ in range(pick.choice((1, 1, 2)))]
        noise = [40 + pick.randrange(100) for _ in range(6)]
        rows.append((k, own + noise + [0, 0], [pick.random(), float(k % 2), None if k % 50 == 0 else 0.0], label, RETAIL.categories[label]))
    return spark.createDataFrame(
        rows, "id long, preprocessed_description array<int>, preprocessed_numeric_features array<double>, "
        "target_category_int int, target_category string",
    )


def accuracy(scored):
    right = F.array_position("scores", F.array_max("scores")) - 1 == F.col("target_category_int")
    return scored.agg(F.avg(right.cast("double"))).first()[0]


def test_fit_beats_centroids_on_held_out_rows(spark):
    df = made(spark, 3000)
    train, validation, test = df.where("id % 5 > 1"), df.where("id % 5 = 0"), df.where("id % 5 = 1")
    found = fit(train, validation, CONFIG, Schedule(rate=0.02, most_rounds=6), partitions=2, batch_size=16)
    learned = accuracy(found.model(spark).score(test, ["id"], CONFIG))
    start = Parameters.initial(found.parameters.buckets, CONFIG.embedding_size, len(CONFIG.trainable), CONFIG.seed)
    rows = [(int(b), v) for b, v in zip(start.buckets, start.tokens.tolist())]
    tokens = spark.createDataFrame(rows, "bucket int, vector array<double>")
    means = embedding.masked_mean(train, ["id"], "preprocessed_description", tokens, 8, 200)
    labels = embedding.label_centroids(
        train.join(means, "id").withColumn("index", F.col("target_category_int")), "index", "description_embedding", 8
    )
    plain = accuracy(embedding.EmbeddingModel(tokens, labels).score(test, ["id"], CONFIG))
    assert learned > 0.95 and learned > plain + 0.05
    # what `measure` says of the best round is what the scorer does
    n, loss, recall = metric_learning.measure(metric_learning._rows(test, CONFIG), found.parameters, CONFIG.margin)
    assert n == test.count() and abs(recall - learned) < 1e-12 and loss < 0.05


@pytest.mark.parametrize("monitor", ["error", "loss"])
def test_best_round_equals_a_search_over_all_rounds(spark, monitor):
    df = made(spark, 300)
    seen = []
    schedule = Schedule(rate=0.2, most_rounds=6, stop_after=9, monitor=monitor)
    found = fit(
        df.where("id % 3 > 0"), df.where("id % 3 = 0"), CONFIG, schedule, batch_size=16,
        observe=lambda r, p: seen.append((r.number, p)),
    )
    assert [k for k, _ in seen] == list(range(6)) == [r.number for r in found.rounds]
    rows = metric_learning._rows(df.where("id % 3 = 0"), CONFIG)
    _, losses, recalls = zip(*(metric_learning.measure(rows, p, CONFIG.margin) for _, p in seen))
    assert np.allclose(losses, [r.validation_loss for r in found.rounds])
    assert np.allclose(recalls, [1 - r.validation_error for r in found.rounds])
    if monitor == "loss":
        assert found.best == int(np.argmin(losses))
    else:
        best = [k for k in range(6) if recalls[k] == max(recalls)]
        assert found.best == min(best, key=lambda k: losses[k])
    assert all((a == b).all() for a, b in zip(found.parameters.groups, seen[found.best][1].groups))


def test_a_round_is_the_mean_of_what_partitions_do(spark):
    """Dense parts by rows, tokens by the batches that met them; untouched tokens stay."""
    df = made(spark, 90)
    rows = metric_learning._rows(df, CONFIG).repartition(3).cache()
    start = Parameters.initial(np.arange(1, 199), 8, len(CONFIG.trainable), 2)
    got, loss = metric_learning._round(rows, start, 0.05, 0.3, 8)
    changes, weights, total, losses = [], [], [], 0.0
    for part in rows.rdd.glom().collect():
        p = start.copy()
        adam, met = Adam(p, 0.05), np.zeros(len(p.buckets))
        for low in range(0, len(part), 8):
            some = part[low : low + 8]
            batch = Batch(
                np.array([b - 1 for r in some for b in r.buckets if b < 199], int),
                np.array([k for k, r in enumerate(some) for b in r.buckets if b < 199], int),
                np.nan_to_num(np.array([r.numeric for r in some], float)), np.array([r.label for r in some]),
            )
            value, places, tokens, others = loss_and_gradients(p, batch, 0.3)
            adam.step(places, tokens, others)
            met[places] += 1
            losses += value * len(some)
        changes.append([a - b for a, b in zip(p.groups, start.groups)])
        weights.append(met)
        total.append(len(part))
    sums = np.maximum(sum(weights), 1)[:, None]
    assert np.allclose(got.tokens, start.tokens + sum(c[0] * w[:, None] for c, w in zip(changes, weights)) / sums)
    for k in (1, 2, 3):
        assert np.allclose(got.groups[k], start.groups[k] + sum(c[k] * n for c, n in zip(changes, total)) / 90)
    assert abs(loss - losses / 90) < 1e-12


def test_steps_keep_moments_of_tokens_with_a_gradient_only():
    """The same parameters as by steps that keep moments of all tokens."""
    pick = np.random.default_rng(4)
    p = Parameters.initial(np.arange(1, 5001), 6, 5, 3)
    plain, moments = p.copy(), [[np.zeros(g.shape) for g in p.groups] for _ in range(2)]
    adam, gradients = Adam(p, 0.05), set()
    for k in range(1, 41):
        places = np.sort(pick.choice(5000, 90, replace=False))
        tokens = pick.normal(size=(90, 6)) * (pick.random(90) < 0.2)[:, None]
        others = [pick.normal(size=g.shape) for g in p.groups[1:]]
        adam.step(places, tokens, tuple(others))
        gradients |= set(places[tokens.any(1)].tolist())
        rate = 0.05 * np.sqrt(1 - 0.999**k) / (1 - 0.9**k)
        for group, m, v, at, g in zip(plain.groups, *moments, [places, *[slice(None)] * 3], [tokens, *others]):
            m[at] = 0.9 * m[at] + 0.1 * g
            v[at] = 0.999 * v[at] + 0.001 * g * g
            group[at] -= rate * m[at] / (np.sqrt(v[at]) + 1e-7)
    assert all(np.allclose(a, b, rtol=0, atol=1e-12) for a, b in zip(p.groups, plain.groups))
    assert set(np.flatnonzero(adam.live).tolist()) == gradients
    assert len(gradients) <= len(adam.first[0]) < 2000


def test_places_by_table_and_by_bisection(monkeypatch):
    known, asked = np.array([2, 5, 900]), np.array([900, 3, 5, 2, 901, 10**12, -1, 0, -10**12])
    for longest in (1 << 24, 0):
        monkeypatch.setattr(metric_learning, "_LONGEST_TABLE", longest)
        found = metric_learning._Places(known)
        assert (found.table is None) == (longest == 0)
        assert found.find(asked).tolist() == [2, -1, 1, 0, -1, -1, -1, -1, -1]
    assert metric_learning._Places(known[:0]).find(asked).tolist() == [-1] * 9


def plain_schedule(s, losses):
    """Round by round, as callbacks would do it."""
    rate, best, wait_rate, wait_stop = s.rate, float("inf"), 0, 0
    for k, loss in enumerate(losses):
        if loss < best - s.min_delta:
            best, wait_rate, wait_stop = loss, 0, 0
        else:
            wait_rate += 1
            wait_stop += 1
            if wait_rate >= s.patience:
                rate, wait_rate = max(rate * s.factor, s.least_rate), 0
            if wait_stop >= s.stop_after:
                return rate, k + 1
        if k + 1 >= s.most_rounds:
            return rate, k + 1
    return rate, None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(0, 1).map(lambda x: round(x, 2)), min_size=1, max_size=30), st.integers(1, 4), st.integers(1, 6))
def test_schedule_equals_a_plain_one(losses, patience, stop_after):
    s = Schedule(patience=patience, stop_after=stop_after, most_rounds=20, min_delta=0.015)
    over, k = False, 0
    while not over and k < len(losses):
        k += 1
        rate, over = s.after(losses[:k])
    assert (rate, k if over else None) == plain_schedule(s, losses)
    rounds = [metric_learning.Round(n, s.rate, 0.0, loss, 0.5) for n, loss in enumerate(losses[:k])]
    assert s.best_round(rounds) == losses.index(min(losses[:k]))


def test_odd_rows(spark):
    df = made(spark, 60)
    odd = spark.createDataFrame(
        [
            (100, [], [0.0, 0.0, 0.0], 1, "x"), (101, [0, 0], [None, None, None], 2, "x"), (102, [5, -3, 999], [1.0, 0.0, 0.0], 3, "x"),
            (103, [5], [1.0, 0.0, 0.0], None, None), (104, [5], [1.0, 0.0, 0.0], 30, "General"), (105, None, None, 0, "x"),
        ],
        df.schema,
    )
    both = df.union(odd)
    assert metric_learning._rows(both, CONFIG).count() == 64
    found = fit(both, both.limit(0), CONFIG, Schedule(most_rounds=2))
    assert len(found.rounds) == 2 and all(np.isfinite(r.validation_loss) for r in found.rounds)
    assert set(found.parameters.buckets.tolist()) <= set(range(1, 200))
    scored = found.model(spark).score(both.where("id < 105"), ["id"], CONFIG).collect()
    assert all(np.isfinite(r.scores).all() for r in scored)
    with pytest.raises(ValueError, match="no rows"):
        fit(df.limit(0), df, CONFIG)


def test_driver_takes_parameters_in_parts(spark, monkeypatch):
    """Neither rounds, models nor scorers collect a table of vectors whole or pass one through the driver's JVM."""
    from pyspark.sql import DataFrame

    def refused(self):
        if any("array" in kind for _, kind in self.dtypes):
            raise AssertionError("a table of vectors is collected whole")
        return whole(self)

    whole = DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow", refused)
    keys, vectors = np.array([3, 5, 9]), np.arange(12, dtype=float).reshape(3, 4)
    p = Parameters(keys, vectors, np.eye(4 + metric_learning.NUMERIC)[:, :4], np.zeros(4), np.eye(4))
    model = metric_learning.Fit(p).model(spark)
    assert "LocalRelation" not in model.token_vectors._jdf.queryExecution().optimizedPlan().toString()
    matrix, present = embedding._token_matrix(model.token_vectors, 10, 4)
    assert np.flatnonzero(present).tolist() == keys.tolist() and (matrix[keys] == vectors).all()
    empty, none = embedding._token_matrix(model.token_vectors.limit(0), 10, 4)
    assert not none.any() and not empty.any()
