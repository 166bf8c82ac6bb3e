"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut into two halves; each half has its own codebook (k-means on a bounded sample).
The product of the two codebooks is a grid of cells, and a vector lives in the cell of its nearest
centroids. A vector visits cells in the order of the multi-sequence algorithm: by the sum of two
lower bounds, one for each half, of its squared distance to anything in the cell (the distance to
the boundary between that cell's centroid and its own). It stops at a reach that is set by recall:
sampled vectors, no two of them partners, are compared with all rows of other classes. The reach is
the largest bound seen among their true pairs, with a margin; what one half of the vectors give must
find all pairs of RECALL of the other half, and it covers RECALL of pairs made at the loosest cosine
allowed. Too few vectors with a partner lead to more vectors, up to the sample; if these are too few
too, or recall is missed, the reach is the bound that no pair can exceed. At that bound the
traversal is complete (`complete=True`).

Vectors with equal values are one class that counts with its number. Each unordered pair of cells is
visited from one side only. Cells are split into blocks of bounded size, and a group is one block of
residents with one block of visitors: it computes cosines in double precision, verifies them, and
returns for each vector a count and a component label, never pairs.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.batches import importable, map_arrow
from tallymark.llm.graph import components, measured, staged

SAMPLE = 10_000
QUERIES = 300
MARGIN = 2.0
RECALL = 0.99
ENOUGH = 100
MADE = 4
CHUNK = 1024
BLOCK = 2048
CELL_ROWS = 64
MOST_CENTROIDS = 1024
_NO_ID = -(1 << 63)


def _normal(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # no overflow or underflow in the sum of squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _raw(value: list | None, kind: str) -> bytes | None:
    """The vector's bytes; None for one that links with nothing."""
    if not value or any(v is None for v in value):
        return None
    vector = np.array(value, kind)
    return vector.tobytes() if np.isfinite(vector).all() and vector.any() else None


def _prepared(df: DataFrame, kind: str) -> DataFrame:
    """vec_id, key (digest) and raw (bytes), null if the vector links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [_raw(v, kind) for v in batch.column(1).to_pylist()]
            keys = [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())],
                names=["vec_id", "key", "raw"],
            )

    return map_arrow(df, run, "vec_id long, key binary, raw binary")


def _units(column: pa.Array, kind: str) -> np.ndarray:
    raw = column.to_pylist()
    return _normal(np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1))


def _squares(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 1) -> np.ndarray:
    pick = np.random.default_rng(seed)
    centroids = x[pick.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        nearest = _squares(x, centroids).argmin(1)
        counts = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        filled = counts > 0
        centroids[filled] = sums[filled] / counts[filled, None]
    return np.unique(centroids, axis=0)


def traversal(first: np.ndarray, second: np.ndarray, reach: float) -> list[tuple[int, int]]:
    """Multi-sequence order: cells (i, j) by first[i] + second[j], up to `reach`, nearest first."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen, cells = [(float(first[a[0]] + second[b[0]]), 0, 0)], {(0, 0)}, []
    while heap:
        bound, i, j = heapq.heappop(heap)
        if bound > reach:
            break
        cells.append((int(a[i]), int(b[j])))
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(a) and q < len(b) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (float(first[a[p]] + second[b[q]]), p, q))
    return cells


@dataclass
class Grid:
    """The codebooks of both halves, for vectors of one length."""

    halves: tuple[np.ndarray, np.ndarray]

    def bounds(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Home cell of each vector, and for both halves the least squared distance between the
        vector and anything whose half belongs to each centroid."""
        cut = units.shape[1] // 2
        homes, bounds = [], []
        for half, centroids in zip((units[:, :cut], units[:, cut:]), self.halves):
            squares = _squares(half, centroids)
            home = squares.argmin(1)
            gap = squares - squares[np.arange(len(half)), home][:, None]
            between = np.sqrt(np.maximum(_squares(centroids, centroids), 1e-300))[home]
            bound = (np.maximum(gap, 0) / (2 * between)) ** 2
            bound[np.arange(len(half)), home] = 0
            homes.append(home)
            bounds.append(bound)
        return homes[0] * len(self.halves[1]) + homes[1], bounds[0], bounds[1]


def _fit_grid(sample: np.ndarray, rows: int) -> Grid:
    k = int(np.clip(np.ceil(np.sqrt(rows / CELL_ROWS)), 1, MOST_CENTROIDS))
    cut = sample.shape[1] // 2
    return Grid((kmeans(sample[:, :cut], k), kmeans(sample[:, cut:], k)))


def _leaders(x: np.ndarray, least: float) -> np.ndarray:
    """Rows of x, in order, that are no partners of an earlier one: a group of copies asks once."""
    kept: list[int] = []
    for low in range(0, len(x), CHUNK):
        part = x[low : low + CHUNK]
        free = np.flatnonzero(~(part @ x[kept].T >= least).any(1)) if kept else np.arange(len(part))
        near, taken = part[free] @ part[free].T >= least, []
        for k in range(len(free)):
            if not near[k, taken].any():
                taken.append(k)
        kept += (low + free[taken]).tolist()
    return np.array(kept, np.int64)


def _pair_bounds(home_x, bounds_x, home_y, bounds_y, k: int) -> np.ndarray:
    """The bound of each pair of rows: the one with the smaller cell visits the other."""
    row = np.arange(len(home_x))
    return np.where(
        home_x <= home_y,
        bounds_x[0][row, home_y // k] + bounds_x[1][row, home_y % k],
        bounds_y[0][row, home_x // k] + bounds_y[1][row, home_x % k],
    )


def _needs(classes: DataFrame, grids: dict, queries: dict, least: float, kind: str) -> np.ndarray:
    """For each query with a partner of another class, the reach that finds all of its pairs."""
    data = classes.sparkSession.sparkContext.broadcast((grids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids, queries = data.value
        asked = {size: grids[size].bounds(x) for size, (_, x) in queries.items()}
        most = {size: np.full(len(x), -1.0) for size, (_, x) in queries.items()}
        for whole in batches:
            for low in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(low, CHUNK)
                for size, at, x in _rows_by_size(batch.column(1), kind):
                    if size not in queries:
                        continue
                    own, q = queries[size]
                    near = q @ x.T >= least
                    near &= own[:, None] != batch.column(0).to_numpy()[at]
                    i, j = np.nonzero(near)
                    if not len(i):
                        continue
                    home_q, *bounds_q = asked[size]
                    home_x, *bounds_x = grids[size].bounds(x)
                    bound = _pair_bounds(
                        home_q[i], [b[i] for b in bounds_q], home_x[j], [b[j] for b in bounds_x],
                        len(grids[size].halves[1]),
                    )
                    np.maximum.at(most[size], i, bound)
        for size, found in most.items():
            hit = np.flatnonzero(found >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(queries[size][0][hit]), pa.array(found[hit])], names=["query", "need"]
            )

    found = map_arrow(classes.select("cls", "raw"), run, "query long, need double")
    rows = found.groupBy("query").agg(F.max("need").alias("need")).orderBy("query").collect()
    return np.array([r.need for r in rows])


def _at_limit(grids: dict, queries: dict, least: float) -> float:
    """The bound that RECALL of made pairs stay within: queries turned towards each other up to a
    cosine of `least`, the loosest link, of which the sample may have none."""
    bounds, pick = [np.zeros(1)], np.random.default_rng(1)
    for size, (_, x) in queries.items():
        for _ in range(MADE if len(x) > 1 else 0):
            y = x[(np.arange(len(x)) + pick.integers(1, len(x))) % len(x)]
            y = y - (x * y).sum(1)[:, None] * x
            length = np.sqrt((y * y).sum(1))
            good = length > 1e-6
            y = least * x[good] + np.sqrt(1 - least * least) * y[good] / length[good, None]
            home_x, *bounds_x = grids[size].bounds(x[good])
            home_y, *bounds_y = grids[size].bounds(y)
            bounds.append(_pair_bounds(home_x, bounds_x, home_y, bounds_y, len(grids[size].halves[1])))
    return float(np.quantile(np.concatenate(bounds), RECALL, method="higher"))


def reach_of(needs: np.ndarray, floor: float, complete: float) -> float:
    """The greatest need with the margin, or the floor; complete with too few needs, or if the reach
    that one half of them gives has a recall under RECALL on the other half."""
    if len(needs) < ENOUGH:
        return complete
    for one, other in ((needs[::2], needs[1::2]), (needs[1::2], needs[::2])):
        if (other <= max(floor, MARGIN * one.max())).mean() < RECALL:
            return complete
    return min(complete, max(floor, MARGIN * float(needs.max())))


def _reach(classes: DataFrame, grids: dict, sample: dict, least: float, kind: str, first: int) -> float:
    """The reach by the recall of sampled pairs. `sample`: (classes, vectors) by length."""
    leaders = {}
    for size, (cls, x) in sample.items():
        kept = _leaders(x, least)
        leaders[size] = cls[kept], x[kept]
    needs = np.zeros(0)
    for most in (first, max((len(x) for _, x in leaders.values()), default=0)):
        if len(needs) < ENOUGH:
            needs = _needs(classes, grids, {s: (c[:most], x[:most]) for s, (c, x) in leaders.items()}, least, kind)
    return reach_of(needs, _at_limit(grids, leaders, least), 2 - 2 * least)


def _rows_by_size(column: pa.Array, kind: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of dimensions, the rows that have them, and their unit vectors."""
    sizes = np.array([len(v) for v in column.to_pylist()], np.int64) // np.dtype(kind).itemsize
    for size in np.unique(sizes).tolist():
        yield size, np.flatnonzero(sizes == size), _units(column.filter(pa.array(sizes == size)), kind)


_OUT = "cls long, links long, label long"
_VISITS = "cell long, visitor boolean, inner boolean, cls long, mult long, raw binary"


def _one_cell(size: int) -> Grid:
    """For lengths that the sample did not have."""
    return Grid((np.zeros((1, size // 2)), np.zeros((1, size - size // 2))))


def _visits(classes: DataFrame, grids: dict, reach: float, kind: str) -> DataFrame:
    """One row for each class in its home cell, and one for each cell that it visits."""
    data = classes.sparkSession.sparkContext.broadcast(grids)
    names = [f.split(" ")[0] for f in _VISITS.split(", ")]

    def of_size(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
        grid = data.value.get(size) or _one_cell(size)
        home, first, second = grid.bounds(_units(batch.column(2), kind))
        k = len(grid.halves[1])
        row, cell, visitor = [], [], []
        for n in range(batch.num_rows):
            visited = [c for i, j in traversal(first[n], second[n], reach) if (c := i * k + j) >= home[n]]
            row += [n] * (1 + len(visited))
            cell += [int(home[n]), *visited]
            visitor += [False] + [True] * len(visited)
            if len(row) >= 20_000 or n + 1 == batch.num_rows:
                at, cells = pa.array(row, pa.int64()), np.array(cell, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(size << 32 | cells), pa.array(visitor), pa.array(cells == home[row]),
                        *(c.take(at) for c in batch.columns),
                    ],
                    names=names,
                )
                row, cell, visitor = [], [], []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(2).to_pylist()], np.int64)
            sizes //= np.dtype(kind).itemsize
            for size in np.unique(sizes).tolist():
                yield from of_size(batch.filter(pa.array(sizes == size)), size)

    return map_arrow(classes.select("cls", "mult", "raw"), run, _VISITS)


def _labels(n: int, m: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least reachable number for n visitors and m residents linked by pairs (i, j)."""
    a, b = np.arange(n), np.arange(n, n + m)
    while True:
        before = a.copy(), b.copy()
        np.minimum.at(b, j, a[i])
        np.minimum.at(a, i, b[j])
        if (a == before[0]).all() and (b == before[1]).all():
            return a, b


def _compare(least: float, kind: str):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        visitor = group["visitor"].to_numpy()
        cls, mult = group["cls"].to_numpy(), group["mult"].to_numpy()
        inner = group["inner"].to_numpy()
        v, r = np.flatnonzero(visitor), np.flatnonzero(~visitor)
        empty = pa.table([pa.array([], pa.int64())] * 3, names=["cls", "links", "label"])
        if not len(v) or not len(r):
            return empty
        units = _units(group["raw"].combine_chunks(), kind)
        near = units[v] @ units[r].T >= least
        near &= cls[v][:, None] != cls[r]
        i, j = np.nonzero(near)
        if not len(i):
            return empty
        links_v = np.bincount(i, mult[r][j], len(v))
        # a vector that visits its own cell is visited there in turn
        outer = ~inner[v][i]
        links_r = np.bincount(j[outer], mult[v][i][outer], len(r))
        a, b = _labels(len(v), len(r), i, j)
        names = np.concatenate([cls[v], cls[r]])
        label = names[np.concatenate([a, b])]
        links = np.concatenate([links_v, links_r]).astype(np.int64)
        hit = np.concatenate([near.any(1), near.any(0)])
        return pa.table(
            [pa.array(names[hit]), pa.array(links[hit]), pa.array(label[hit])],
            names=["cls", "links", "label"],
        )

    return run


def _blocked(visits: DataFrame, block: int) -> DataFrame:
    """The visits, dealt to groups of at most about `block` residents and `block` visitors."""
    sizes = visits.groupBy("cell").agg(
        F.ceil(F.count(F.when(~F.col("visitor"), 1)) / block).cast("int").alias("rs"),
        F.ceil(F.count(F.when(F.col("visitor"), 1)) / block).cast("int").alias("vs"),
    ).filter("rs > 0 and vs > 0")
    sized = visits.join(measured(sizes, "cells"), "cell")
    own = F.when(F.col("visitor"), F.pmod(F.xxhash64("cls"), F.col("vs"))).otherwise(
        F.pmod(F.xxhash64("cls"), F.col("rs"))
    )
    others = F.sequence(F.lit(0), F.when(F.col("visitor"), F.col("rs")).otherwise(F.col("vs")) - 1)
    dealt = sized.withColumn("own", own).withColumn("other", F.explode(others))
    return dealt.select(
        "cell", F.when(F.col("visitor"), F.col("other")).otherwise(F.col("own")).alias("rb"),
        F.when(F.col("visitor"), F.col("own")).otherwise(F.col("other")).alias("vb"),
        "visitor", "inner", "cls", "mult", "raw",
    )


def near_vectors(
    df: DataFrame, least: float = 0.9, complete: bool = False, vec_id: str = "vec_id",
    vector: str = "embedding", sample: int = SAMPLE, queries: int = QUERIES, block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of `df`.

    Links join vectors of one length with a cosine of at least `least` (over 0.5) in double
    precision. n_links counts other rows, equal ones included; component_id is the least vec_id
    reachable, kept says that it is the row's own. Null, empty and zero vectors and those with null
    or non-finite parts have no links and are their own component. Repeated rows and ids count row
    by row; a null vec_id takes part and gets its group's least id, or null. Other columns are not
    read. `complete` visits every cell that can hold a partner.
    """
    importable(df.sparkSession)
    kind = "<f4" if dict(df.dtypes)[vector] == "array<float>" else "<f8"
    values = F.col(vector) if kind == "<f4" else F.col(vector).cast("array<double>")
    rows = staged(
        _prepared(df.select(F.col(vec_id).cast("long").alias("vec_id"), values.alias("vector")), kind),
        "vectors",
    )
    classes = staged(
        rows.filter(F.col("key").isNotNull()).groupBy("key")
        .agg(F.count("*").alias("mult"), F.min("vec_id").alias("least_id"), F.first("raw").alias("raw"))
        .withColumn("cls", F.monotonically_increasing_id()),
        "classes",
    )
    n = classes.count()
    rate = min(1.0, sample / max(1, n))
    drawn = classes.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(rate * (1 << 30)))
    drawn = drawn.select("cls", "raw").orderBy("key").collect()
    cls, raw = np.array([r.cls for r in drawn], np.int64), pa.array([bytes(r.raw) for r in drawn], pa.binary())
    asked = {size: (cls[at], x) for size, at, x in _rows_by_size(raw, kind) if size > 1}
    grids = {size: _fit_grid(x, n) for size, (_, x) in asked.items()}
    reach = 2 - 2 * least if complete else _reach(classes, grids, asked, least, kind, queries)
    # the second use visits again: what it sends is many times what it reads
    groups = _blocked(_visits(classes, grids, reach, kind), block)
    found = staged(
        groups.groupBy("cell", "rb", "vb").applyInArrow(_compare(least, kind), _OUT), "links"
    )
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    comps = components(found.select(F.col("cls").alias("u"), F.col("label").alias("v")))
    named = classes.join(links, "cls", "left").join(
        comps.select(F.col("vertex").alias("cls"), F.col("component").alias("comp")), "cls", "left"
    ).select(
        "key", "least_id", F.coalesce("comp", "cls").alias("comp"),
        (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    least_ids = named.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    by_key = named.join(least_ids, "comp").select("key", "n_links", "component_id")
    lone = F.col("key").isNull()
    return rows.select("vec_id", "key").join(by_key, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(lone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
