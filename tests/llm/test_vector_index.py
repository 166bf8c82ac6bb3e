"""Links of vectors against all pairs, recall of the index, odd rows."""

import numpy as np
import pytest

from tallymark.llm import vector_index
from tallymark.llm.q_dedup import op8
from tallymark.llm.vector_index import near_vectors, reach_of, traversal


def brute(rows, least=0.9):
    units = []
    for _, v in rows:
        good = v and all(x is not None for x in v) and np.isfinite(v).all() and np.any(v)
        x = np.array(v, float) / np.abs(v).max() if good else None
        units.append(None if x is None else x / np.sqrt(x @ x))
    n = len(rows)
    links = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= least:
                links[i].append(j)
                links[j].append(i)
    out, comp = [], list(range(n))
    for start in range(n):
        todo, seen = [start], {start}
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        comp[start] = min(ids, default=None) if units[start] is not None else rows[start][0]
    for k, (vec, _) in enumerate(rows):
        out.append((vec, len(links[k]), comp[k], vec == comp[k]))
    return sorted(out, key=str)


def clusters(n, size, seed, spread):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(n // 4, size))
    x = centres[pick.integers(0, n // 4, n)]
    return (x + pick.normal(size=(n, size)) * spread * pick.random((n, 1))).astype(np.float32)


@pytest.mark.parametrize("block", [7, 2048])
def test_complete_traversal_equals_all_pairs(spark, block):
    x = clusters(300, 16, 1, 0.5)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = near_vectors(df, complete=True, block=block).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_odd_rows(spark):
    e = [1.0, 0.0, 0.0, 0.0]
    rows = [
        (5, e), (5, e), (3, [2.0, 0.1, 0.0, 0.0]), (None, [1e30, 0.0, 0.0, 0.0]), (9, None), (8, []), (7, [0.0] * 4),
        (6, [1.0, None, 0.0, 0.0]), (4, [float("nan"), 1.0, 0.0, 0.0]), (2, [float("inf"), 1.0, 0.0, 0.0]), (1, [1.0, 0.0]),
        (10, [1.0]), (11, [3.0]), (12, [-1.0, 0.0, 0.0, 0.0]), (13, [0.9, 0.43588989435, 0.0, 0.0]), (14, [1e-30, 0.0, 0.0, 0.0]),
        (15, [1.0, 2.0, 3.0]), (16, [1.0, 2.0, 3.1]),
    ]
    for kind in ("array<float>", "array<double>"):
        df = spark.createDataFrame([(*r, 1, "x") for r in rows], f"vec_id long, embedding {kind}, cls int, key string")
        wanted = [(i, None if v is None else [None if y is None else float(np.float32(y)) for y in v] if kind == "array<float>" else v) for i, v in rows]
        for complete in (True, False):
            got = near_vectors(df, complete=complete).collect()
            assert sorted((tuple(r) for r in got), key=str) == brute(wanted)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_vectors(empty).count() == 0


def test_traversal_is_in_order_and_complete():
    pick = np.random.default_rng(2)
    a, b = pick.random(9), pick.random(7)
    cells = traversal(a, b, 1.1)
    sums = [a[i] + b[j] for i, j in cells]
    assert sums == sorted(sums) and len(set(cells)) == len(cells) == int((a[:, None] + b <= 1.1).sum())


def test_bounds_hold():
    x = vector_index._normal(clusters(400, 12, 3, 1.0))
    grid = vector_index._fit_grid(x, 4000)
    home, first, second = grid.bounds(x)
    k = len(grid.halves[1])
    for n in range(0, 400, 7):
        true = ((x - x[n]) ** 2).sum(1)
        assert (first[n, home // k] + second[n, home % k] <= true + 1e-9).all()


def test_recall_on_the_test_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    pick = np.random.default_rng(5)
    for k in range(0, 200):  # copies with noise, at all cosines around the limit
        v = np.array(rows[k][1])
        noise = pick.normal(size=len(v))
        noise *= np.linalg.norm(v) / np.linalg.norm(noise) * pick.uniform(0, 0.55)
        rows.append((10**6 + k, (v + noise).astype(np.float32).tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    wanted = {r[0]: r[1] for r in brute(rows)}
    got = {r.vec_id: r.n_links for r in near_vectors(df).collect()}
    assert sum(wanted.values()) > 100
    assert all(got[k] <= n for k, n in wanted.items())
    assert sum(got.values()) >= 0.9 * sum(wanted.values())


@pytest.mark.parametrize("hot", [0, 700])
def test_rare_loose_links_are_found(spark, hot):
    """Some pairs just over the limit, alone or beside a large group of tight copies."""
    pick = np.random.default_rng(6)
    x = pick.normal(size=(700, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = pick.normal(size=(40, 16))
    u -= (u * x[:40]).sum(1, keepdims=True) * x[:40]
    loose = 0.91 * x[:40] + np.sqrt(1 - 0.91**2) * u / np.linalg.norm(u, axis=1, keepdims=True)
    tight = x[50] + pick.normal(size=(hot, 16)) * 1e-3
    rows = list(enumerate(np.concatenate([x, loose, tight]).astype(np.float32).tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted((tuple(r) for r in near_vectors(df).collect()), key=str) == brute(rows)


def test_reach_is_complete_without_enough_pairs_or_recall():
    assert reach_of(np.full(vector_index.ENOUGH - 1, 0.001), 0.01, 0.2) == 0.2
    few = np.zeros(300)
    assert reach_of(few, 0.01, 0.2) == 0.01
    few[[2, 10, 24, 40]] = 0.05
    assert reach_of(few, 0.01, 0.2) == 0.2
    assert reach_of(np.tile([0.03, 0.03, 0.001], 100), 0.01, 0.2) == pytest.approx(0.06)


def test_query_equals_all_pairs(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted((tuple(r) for r in op8(spark, folder).collect()), key=str) == brute(rows)
