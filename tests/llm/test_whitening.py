"""Whitening: eigenpairs against numpy, exact moments, the query against plain numpy, odd rows."""

import numpy as np
import pytest

from tallymark.llm import spectrum, whitening
from tallymark.llm.q_search import op12
from tallymark.llm.whitening import whiten


def matrix(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    a = (q * values) @ q.T
    return (a + a.T) / 2


SPECTRA = {
    "random": np.random.default_rng(1).random(64) * 10,
    "equal": np.repeat(np.random.default_rng(2).random(16), 4),
    "all equal": np.ones(20),
    "close": 1 + 1e-9 * np.random.default_rng(3).random(64),
    "falling": 10.0 ** -np.arange(40),
    "rank": np.r_[np.random.default_rng(4).random(7), np.zeros(30)],
    "large": np.random.default_rng(5).random(200) * 1e12,
    "one": np.array([3.0]),
    "zero": np.zeros(5),
}


@pytest.mark.parametrize("name", list(SPECTRA))
def test_leading_pairs_equal_numpy(name):
    a = matrix(SPECTRA[name])
    want = np.sort(SPECTRA[name])[::-1]
    want = want[want > 1e-12 * np.abs(a).sum(1).max(initial=0)][:32]
    got = spectrum.leading(a, 32)
    scale = max(want, default=1)
    assert len(got) == len(want)
    assert np.allclose([p.value for p in got], want, rtol=0, atol=1e-13 * len(a) * scale)
    v = np.column_stack([p.vector for p in got]) if got else np.zeros((len(a), 0))
    assert np.abs(v.T @ v - np.eye(len(got))).max(initial=0) < 1e-12
    assert all(np.linalg.norm(a @ p.vector - p.value * p.vector) < 1e-12 * scale for p in got)


def test_counts_are_inertia_and_certify_numbers():
    a = matrix(SPECTRA["random"])
    values = np.linalg.eigvalsh(a)
    for shift in (-1.0, 0.5, 3.3, 9.0, 20.0):
        d, growth = spectrum.pivots(a, shift)
        assert (d > 0).sum() == (values > shift).sum()
    for k, p in enumerate(spectrum.leading(a, 32)):
        assert (values > p.low).sum() == k + 1 and (values > p.high).sum() == k


def plain(vectors):
    """deviation, whitened (up to sign), explained."""
    x = np.floor(64 * np.array(vectors, float)) + 1_000_000
    n, total = len(x), x.sum(0)
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, total)) for row in x]
    y = x - total / n
    v = y.T @ y / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    return deviation, y @ axes[:, :32] / np.sqrt(values[:32]), values[:32] / np.trace(v)


def assert_equals_plain(rows, ids, vectors):
    deviation, want, explained = plain(vectors)
    k = want.shape[1]
    assert len(rows) == len(ids) * k and {r.n for r in rows} == {len(ids)}
    at = {v: i for i, v in enumerate(ids)}
    got = np.zeros(want.shape)
    for r in rows:
        got[at[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviation[at[r.vec_id]] and r.identity_error < 1e-9
        assert abs(r.explained - explained[r.component - 1]) < 1e-9
    sign = np.sign((got * want).sum(0))
    assert np.abs(got * sign - want).max() < 1e-7


def test_query_equals_plain_numpy(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    some = [r for r in rows if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding)]
    assert_equals_plain(op12(spark, folder).collect(), [r.vec_id for r in some], [r.embedding for r in some])


def test_odd_rows(spark):
    pick = np.random.default_rng(0)
    good = [(k, [float(c) for c in pick.normal(size=4)], "x") for k in range(40)]
    odd = [
        (100, None, "x"), (101, [], "x"), (102, [1.0, None, 2.0, 3.0], "x"), (103, [float("nan"), 0.0, 0.0, 0.0], "x"),
        (104, [float("inf")] * 4, "x"), (105, [1.0], "x"), (106, [1e30, 0.0, 0.0, 0.0], "x"),
    ]
    schema = "vec_id long, embedding array<double>, component string"
    out = whiten(spark.createDataFrame(good + odd, schema)).collect()
    assert_equals_plain(out, [r[0] for r in good], [r[1] for r in good])
    again = whiten(spark.createDataFrame(good + good[:3] + [(None, good[0][1], "y")], schema)).collect()
    assert len(again) == 44 * 4 and sum(r.vec_id is None for r in again) == 4
    for some in ([], good[:1], [good[0]] * 5, odd[:2]):
        empty = whiten(spark.createDataFrame(some, schema))
        assert empty.count() == 0
        assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries_stay_exact(spark):
    pick = np.random.default_rng(0)
    big = [(k, [float(c) for c in pick.normal(size=3) * 1e13]) for k in range(30)]
    rows = whitening.usable(spark.createDataFrame(big, "vec_id long, embedding array<double>"))
    m = whitening.moments(rows)
    assert not m.exact
    assert m.sums == [sum(int(np.floor(64 * v[k])) for _, v in big) for k in range(3)]
    out = whiten(rows.withColumnRenamed("v", "embedding")).collect()
    assert len(out) == 90 and {r.deviation for r in out} == {None} and max(r.identity_error for r in out) < 1e-9


def test_components_with_less_variance_than_dimensions(spark):
    pick = np.random.default_rng(0)
    rows = [(k, [float(c) for c in (a, a, b)]) for k, (a, b) in enumerate(pick.normal(size=(50, 2)) * 4)]
    out = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in out} == {1, 2} and max(r.identity_error for r in out) < 1e-9
