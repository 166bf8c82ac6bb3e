"""Documents that contain benchmark items, by greedy string tiling.

Seeds are runs of `tile` words (a shorter item is one seed). Seeds that an item and a document
share are joined; Karp-Rabin hashes of the runs find them, so a document is compared only with
items of which seeds cover enough words. Then tiles are laid: the longest common run of words that
are not marked yet, in either text, is marked, again and again, until no run of `tile` words is
left. The share of the item's words under tiles is its coverage; order does not matter, so passages
that were put in another order are found. Items with a coverage of `threshold` or more count.

The benchmark is taken in blocks of bounded bytes; each block is broadcast and meets all documents
in one pass without a shuffle.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.batches import Words, map_arrow, sliced, text_array
from tallymark.llm.hashing import ranges_of, sequence_hashes

TILE = 4
THRESHOLD = 0.6
BLOCK_BYTES = 16 << 20
PAIRS = 1 << 20


@dataclass
class Items:
    """Words of a block of items and its seeds, sorted by hash."""

    ids: list
    words: list[np.ndarray]
    sizes: list[int]
    seeds: np.ndarray
    starts: np.ndarray
    item: np.ndarray
    place: np.ndarray


def prepare(rows: list[tuple], tile: int) -> Items:
    """`rows`: (item id, text). Items without words are left out."""
    words = Words(text_array(pa.array([t for _, t in rows], pa.string())))
    lengths = np.diff(words.first)
    hashes, item, place = [], [], []
    sizes = sorted({int(min(n, tile)) for n in lengths if n})
    for size in sizes:
        for k in np.flatnonzero(np.minimum(lengths, tile) == size).tolist():
            starts = np.arange(words.first[k], words.first[k + 1] - size + 1)
            hashes.append(sequence_hashes(words.hashes, starts, starts + size))
            item.append(np.full(len(starts), k))
            place.append(starts - words.first[k])
    joined = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    order = np.argsort(joined, kind="stable")
    seeds, starts = np.unique(joined[order], return_index=True)
    return Items(
        [i for i, _ in rows], np.split(words.hashes, words.first[1:-1]), sizes, seeds,
        np.append(starts, len(joined)),
        np.concatenate(item)[order] if item else np.zeros(0, np.int64),
        np.concatenate(place)[order] if place else np.zeros(0, np.int64),
    )


def common_runs(
    a: np.ndarray, low: np.ndarray, high: np.ndarray, places: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal common runs: start in the item, start in the text, length.

    `a`: ascending item places of seeds; that of a[k] lies at places[low[k]:high[k]] of the text.
    A text that repeats itself has far more pairs of equal seeds than runs, so pairs are made for
    some item places at a time, PAIRS in the mean, and runs are carried on from one part to the next.
    """
    counts, done = high - low, []
    open_ = [np.zeros(0, np.int64)] * 3  # diagonal, start in the item, seeds; by diagonal
    ends, k, last = np.cumsum(counts), 0, -2
    while k < len(a):
        stop = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + PAIRS, side="right")))
        at = np.repeat(a[k:stop], counts[k:stop])
        diagonal = places[ranges_of(low[k:stop], counts[k:stop])] - at
        order = np.lexsort((at, diagonal))
        at, diagonal = at[order], diagonal[order]
        new = np.ones(len(at), bool)
        new[1:] = (diagonal[1:] != diagonal[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        runs = [diagonal[first], at[first], np.diff(np.append(first, len(at)))]
        if a[k] == last + 1 and len(open_[0]):
            begins = np.flatnonzero(runs[1] == a[k])
            found = np.minimum(np.searchsorted(open_[0], runs[0][begins]), len(open_[0]) - 1)
            same = open_[0][found] == runs[0][begins]
            begins, found = begins[same], found[same]
            runs[1][begins] = open_[1][found]
            runs[2][begins] += open_[2][found]
            open_ = [np.delete(c, found) for c in open_]
        done.append(open_)
        last = a[stop - 1]
        going = runs[1] + runs[2] - 1 == last
        done.append([c[~going] for c in runs])
        open_, k = [c[going] for c in runs], stop
    diagonal, start, n = (np.concatenate(c) for c in zip(*done, open_))
    return start, start + diagonal, n + size - 1


def tiles(
    i: np.ndarray, j: np.ndarray, n: np.ndarray, size: int, words_a: int, words_b: int
) -> list[tuple[int, int, int]]:
    """Greedy tiling from the maximal common runs: (start in each, length).

    Longest first, then by place; a run that meets marked words goes back with its unmarked parts.
    """
    order = np.lexsort((j, i, -n))
    i, j, n = i[order], j[order], n[order]
    heap: list[tuple[int, int, int]] = []
    marked_a, marked_b, laid, at = np.zeros(words_a, bool), np.zeros(words_b, bool), [], 0
    left = words_a
    while left >= size and (heap or at < len(n)):
        if at < len(n) and (not heap or (-int(n[at]), int(i[at]), int(j[at])) < heap[0]):
            x, y, length, at = int(i[at]), int(j[at]), int(n[at]), at + 1
        else:
            minus, x, y = heapq.heappop(heap)
            length = -minus
        free = ~(marked_a[x : x + length] | marked_b[y : y + length])
        if free.all():
            marked_a[x : x + length] = marked_b[y : y + length] = True
            laid.append((x, y, length))
            left -= length
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([0], free.view(np.int8), [0]))))
        for low, high in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if high - low >= size:
                heapq.heappush(heap, (low - high, x + low, y + low))
    return laid


def _hits(words: Words, items: Items) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(text number, seed numbers, word numbers in the text) of texts with seeds."""
    seeds, places, texts = [], [], []
    for size in items.sizes:
        starts = np.arange(max(0, len(words.hashes) - size + 1))
        text = np.searchsorted(words.first, starts, side="right") - 1
        whole = starts + size <= words.first[text + 1]
        starts, text = starts[whole], text[whole]
        found = sequence_hashes(words.hashes, starts, starts + size)
        at = np.minimum(np.searchsorted(items.seeds, found), len(items.seeds) - 1)
        hit = items.seeds[at] == found
        seeds.append(at[hit])
        places.append(starts[hit] - words.first[text[hit]])
        texts.append(text[hit])
    if not seeds:
        return
    seeds, places, texts = map(np.concatenate, (seeds, places, texts))
    order = np.argsort(texts, kind="stable")
    seeds, places, texts = seeds[order], places[order], texts[order]
    some, first = np.unique(texts, return_index=True)
    for text, low, high in zip(some.tolist(), first.tolist(), [*first[1:].tolist(), len(texts)]):
        yield text, seeds[low:high], places[low:high]


def _matches(words: Words, items: Items, tile: int, threshold: float):
    """(text number, item number, coverage, number of tiles)."""
    for text, seeds, places in _hits(words, items):
        order = np.lexsort((places, seeds))
        seeds, places = seeds[order], places[order]
        known, first = np.unique(seeds, return_index=True)
        last = np.append(first[1:], len(seeds))
        counts = items.starts[known + 1] - items.starts[known]
        entry = ranges_of(items.starts[known], counts)
        seed = np.repeat(np.arange(len(known)), counts)
        order = np.lexsort((items.place[entry], items.item[entry]))
        entry, seed = entry[order], seed[order]
        item, a = items.item[entry], items.place[entry]
        some, begin = np.unique(item, return_index=True)
        n = int(words.first[text + 1] - words.first[text])
        for k, low, high in zip(some.tolist(), begin.tolist(), [*begin[1:].tolist(), len(item)]):
            m = len(items.words[k])
            size = min(m, tile)
            covered = np.zeros(m + 1, np.int64)
            np.add.at(covered, a[low:high], 1)
            np.add.at(covered, a[low:high] + size, -1)
            if np.count_nonzero(np.cumsum(covered)) < threshold * m:
                continue
            own = seed[low:high]
            laid = tiles(*common_runs(a[low:high], first[own], last[own], places, size), size, m, n)
            coverage = sum(t[2] for t in laid) / m
            if coverage >= threshold:
                yield text, k, coverage, len(laid)


def _blocks(benchmark: DataFrame, item_id: str, text: str, tile: int) -> Iterator[Items]:
    """Items of BLOCK_BYTES bytes at a time, or one longer item; equal texts need not share a block."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("item"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    if total > BLOCK_BYTES:
        rows = rows.repartition(-(-total // BLOCK_BYTES))  # what the driver reads at once
    held: list[tuple] = []
    size = 0
    for r in rows.toLocalIterator():
        more = len((r.text or "").encode()) + 64
        if held and size + more > BLOCK_BYTES:
            yield prepare(held, tile)
            held, size = [], 0
        held.append((r.item, r.text))
        size += more
    if held:
        yield prepare(held, tile)


def contaminated(
    df: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, tile: int = TILE,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """doc_id, item_id, coverage, n_tiles: a row per document and item that it contains.

    Coverage is the share of the item's words (`[^\\x20\\x09-\\x0D]+`, A-Z lower-cased) under tiles.
    Null and wordless texts and items match nothing. Rows that repeat a document or an item count
    one by one. An empty benchmark gives no rows. Other columns are not read.
    """
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = None
    for items in _blocks(benchmark, item_id, item_text, tile):
        found = map_arrow(
            docs, _finder(docs, items, tile, threshold),
            "doc_id long, item_id long, coverage double, n_tiles int",
        )
        out = found if out is None else out.union(found)
    if out is None:
        return df.sparkSession.createDataFrame(
            [], "doc_id long, item_id long, coverage double, n_tiles int"
        )
    return out


def _finder(docs: DataFrame, items: Items, tile: int, threshold: float):
    data = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = data.value
        for whole in batches:
            for batch in sliced(whole, 1):
                found = list(_matches(Words(text_array(batch.column(1))), block, tile, threshold))
                text, item, coverage, n = zip(*found) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(text, pa.int64())),
                        pa.array([block.ids[k] for k in item], pa.int64()),
                        pa.array(coverage, pa.float64()), pa.array(n, pa.int32()),
                    ],
                    names=["doc_id", "item_id", "coverage", "n_tiles"],
                )

    return run


def clean(
    df: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, tile: int = TILE,
    text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of `df` that contain no benchmark item, all columns as they are."""
    column = df.columns.index(text)
    for items in _blocks(benchmark, item_id, item_text, tile):
        df = map_arrow(df, _sieve(df, items, column, tile, threshold), df.schema)
    return df


def _sieve(df: DataFrame, items: Items, column: int, tile: int, threshold: float):
    data = df.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, column):
                keep = np.ones(batch.num_rows, bool)
                words = Words(text_array(batch.column(column)))
                keep[[m[0] for m in _matches(words, data.value, tile, threshold)]] = False
                yield batch.filter(pa.array(keep))

    return run
