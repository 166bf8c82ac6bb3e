"""Ranked search: the best documents of each item by the terms they share.

1. Every document is read once for its terms of the items' vocabulary. The postings (document, its
   length, terms and counts) are written; number of documents, total length and the number of
   documents of each term are summed from them.
2. Each task walks its postings in blocks. For an item, every document of the block gets a bitmap of
   the item's terms that it holds, and documents with the same bitmap form a group. A group's score
   cannot exceed the sum of its terms' best contributions in the block. Groups are evaluated by
   falling bound, until no bound reaches the k-th best score so far; only their documents are scored.
3. The best of all tasks, at most k an item and task, are ranked.

Items are taken in parts of PART_TERMS terms, one pass over the documents each, so what is broadcast
and what the driver holds is bounded by a part, or one longer item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.batches import Words, list_array, map_arrow, sliced, text_array
from tallymark.llm.graph import staged
from tallymark.llm.hashing import HashIndex

PART_TERMS = 1_000_000
BLOCK_ROWS = 1 << 16
BLOCK_POSTINGS = 1 << 21
K = 10

#: Bytes between terms: ASCII but digits and letters.
_BETWEEN = np.zeros(256, bool)
_BETWEEN[:128] = True
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    _BETWEEN[_low : _high + 1] = False


def _terms(texts: pa.Array) -> Words:
    return Words(text_array(texts), blank=_BETWEEN)


def _item_terms(items: DataFrame, text: str, item_id: str) -> DataFrame:
    """(item_id, terms): hashes of the distinct terms of each item with one at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, 1):
                words = _terms(batch.column(1))
                of = [np.unique(words.hashes[a:b]) for a, b in zip(words.first, words.first[1:])]
                flat = np.concatenate([*of, np.zeros(0, np.uint64)]).view(np.int64)
                lengths = np.array([len(h) for h in of], np.int64)
                out = pa.RecordBatch.from_arrays(
                    [batch.column(0), list_array(flat, lengths, pa.int64())], names=["item_id", "terms"]
                )
                yield out.filter(pa.array(lengths > 0))

    source = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    schema = T.StructType([source.schema["item_id"], T.StructField("terms", T.ArrayType(T.LongType()))])
    return map_arrow(source, run, schema)


@dataclass
class Part:
    """Some items: ids, and for each the numbers of its terms in the sorted vocabulary."""

    ids: list
    vocabulary: np.ndarray
    terms: list[np.ndarray]


def _part(rows: list) -> Part:
    hashes = [np.array(r["terms"], np.int64).view(np.uint64) for r in rows]
    vocabulary = np.unique(np.concatenate(hashes))
    return Part([r["item_id"] for r in rows], vocabulary, [np.searchsorted(vocabulary, h) for h in hashes])


def _parts(items: DataFrame, most: int) -> Iterator[Part]:
    rows, size = [], 0
    for row in items.toLocalIterator():
        if rows and size + len(row["terms"]) > most:
            yield _part(rows)
            rows, size = [], 0
        rows.append(row)
        size += len(row["terms"])
    if rows:
        yield _part(rows)


def postings(docs: DataFrame, vocabulary: np.ndarray, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a term: its number of terms with repeats,
    and the numbers in `vocabulary` (sorted hashes) and counts of those in it."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        index = HashIndex(len(known))
        index.add(known)
        for whole in batches:
            for batch in sliced(whole, 1):
                words = _terms(batch.column(1))
                n = np.diff(words.first)
                owner = np.repeat(np.arange(len(n)), n)
                found = index.find(words.hashes)
                pairs, counts = np.unique(
                    owner[found >= 0] * len(known) + found[found >= 0], return_counts=True
                )
                lengths = np.bincount(pairs // len(known), minlength=len(n))
                out = pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array(n, pa.int64()),
                        list_array((pairs % len(known)).astype(np.int32), lengths, pa.int32()),
                        list_array(counts, lengths, pa.int64()),
                    ],
                    names=["doc_id", "n", "terms", "counts"],
                )
                yield out.filter(pa.array(n > 0))

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_arrow(source, run, "doc_id long, n long, terms array<int>, counts array<long>")


def _weights(n_docs: int, holding: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) for each df."""
    some, again = np.unique(holding, return_inverse=True)
    w = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in some]
    return np.array(w, np.int64)[again]


def _tempered(n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """A document's m: 100 - 90 + (90 n N) div L, in integers of any size where a long is too short."""
    if 90 * int(n.max(initial=0)) * n_docs >= 1 << 63:
        return (10 + (90 * n.astype(object) * n_docs) // total).astype(np.int64)
    return 10 + (90 * n * n_docs) // total


class _Best:
    """The best k documents of an item so far, ordered by falling score, then by id, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.doc, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """What a document must score at least to be taken."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        some = score >= self.least
        score, doc, null = (
            np.concatenate(pair)
            for pair in ((self.score, score[some]), (self.doc, doc[some]), (self.null, null[some]))
        )
        order = np.lexsort((doc, null, -score))[: self.k]
        self.score, self.doc, self.null = score[order], doc[order], null[order]


class _Block:
    """Postings of some documents by term, each with its contribution apart from the term's weight."""

    def __init__(self, batch: pa.RecordBatch, vocabulary: int, n_docs: int, total: int):
        ids = batch.column(0)
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.doc = ids.fill_null(0).to_numpy(zero_copy_only=False)
        lengths = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
        term = batch.column(2).flatten().to_numpy(zero_copy_only=False)
        tf = batch.column(3).flatten().to_numpy(zero_copy_only=False)
        m = _tempered(batch.column(1).to_numpy(zero_copy_only=False), n_docs, total)
        row = np.repeat(np.arange(len(m)), lengths)
        order = np.argsort(term, kind="stable")
        self.row, tf = row[order], tf[order]
        self.gain = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.row])
        self.first = np.zeros(vocabulary + 1, np.int64)
        np.cumsum(np.bincount(term, minlength=vocabulary), out=self.first[1:])
        self.top = np.zeros(vocabulary, np.int64)
        used = np.flatnonzero(np.diff(self.first))
        if len(used):
            self.top[used] = np.maximum.reduceat(self.gain, self.first[used])

    def search(self, terms: np.ndarray, weights: np.ndarray, best: _Best) -> None:
        """Take the documents of this block that belong to the best of the item."""
        bounds = weights * self.top[terms]
        terms, weights, bounds = terms[bounds > 0], weights[bounds > 0], bounds[bounds > 0]
        if bounds.sum() < best.least:
            return
        spans = [slice(self.first[t], self.first[t + 1]) for t in terms]
        masks = np.zeros((len(self.doc), (len(terms) + 63) // 64), np.uint64)
        for k, span in enumerate(spans):
            masks[self.row[span], k // 64] |= np.uint64(1 << k % 64)
        rows = np.flatnonzero(masks.any(1))
        masks = np.ascontiguousarray(masks[rows])
        if masks.shape[1] == 1:
            first, group = np.unique(masks[:, 0], return_index=True, return_inverse=True)[1:]
        else:
            first, group = np.unique(
                masks.view([("", np.uint64)] * masks.shape[1])[:, 0], return_index=True, return_inverse=True
            )[1:]
        bound = np.zeros(len(first), np.int64)
        for k in range(len(terms)):
            held = masks[first, k // 64] >> np.uint64(k % 64) & np.uint64(1)
            bound += held.astype(np.int64) * bounds[k]
        falling = np.argsort(-bound, kind="stable")
        place = np.empty(len(falling), np.int64)
        place[falling] = np.arange(len(falling))
        rows = rows[np.argsort(place[group], kind="stable")]
        ends = np.cumsum(np.bincount(place[group], minlength=len(falling)))
        bound = bound[falling]
        done, size = 0, 4 * best.k
        while done < len(bound) and bound[done] >= best.least:
            begin = ends[done - 1] if done else 0
            reach = len(bound) - int(np.searchsorted(bound[::-1], best.least))  # groups that may matter
            filled = int(np.searchsorted(ends, begin + size, side="right"))
            done = max(done + 1, min(filled, reach))
            some = np.sort(rows[begin : ends[done - 1]])
            score = np.zeros(len(some), np.int64)
            for w, span in zip(weights, spans):
                own = self.row[span]
                at = np.minimum(np.searchsorted(own, some), len(own) - 1)
                score += np.where(own[at] == some, w * self.gain[span][at], 0)
            best.add(score, self.doc[some], self.null[some])
            size *= 2


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of several batches joined, up to BLOCK_ROWS rows or BLOCK_POSTINGS postings."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for whole in batches:
        lengths = whole.column(2).value_lengths().to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(lengths), 0
        while start < len(lengths):
            before = ends[start - 1] if start else 0
            room = max(BLOCK_POSTINGS - size, 0)
            stop = int(np.searchsorted(ends, before + room, side="right"))
            stop = min(max(stop, start + (not held)), start + BLOCK_ROWS - rows)
            if stop > start:
                held.append(whole.slice(start, stop - start))
                rows, size = rows + stop - start, size + int(ends[stop - 1] - before)
                start = stop
            if start < len(lengths):
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows, size = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _searched(found: DataFrame, part: Part, k: int) -> DataFrame:
    """(item, doc_id, score): the best k of each task for each item of the part, by its number."""
    size = len(part.vocabulary)
    n_docs, total = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(size, np.int64)
    for r in found.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        holding[r["term"]] = r["count"]
    weights = np.maximum(_weights(n_docs, holding), 0)
    shared = found.sparkSession.sparkContext.broadcast((part.terms, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights = shared.value
        best = [_Best(k) for _ in terms]
        for batch in _blocks(batches):
            block = _Block(batch, size, n_docs, total)
            for own, b in zip(terms, best):
                block.search(own, weights[own], b)
        item = np.repeat(np.arange(len(best)), [len(b.score) for b in best])
        if len(item):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(item), pa.array(np.concatenate([b.doc for b in best]), mask=np.concatenate([b.null for b in best])),
                    pa.array(np.concatenate([b.score for b in best])),
                ],
                names=["item", "doc_id", "score"],
            )

    return map_arrow(found, run, "item long, doc_id long, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = K, text: str = "text", doc_id: str = "doc_id",
    item_text: str = "text", item_id: str = "item_id", part_terms: int = PART_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` documents of the highest scores above 0 for each row
    of `items`.

    Equal scores rank by ascending id, null ids last. Null and empty texts have no terms: such items
    get no rows, such documents count nowhere. Repeated rows of either table are rows of their own.
    Other columns are not read. Empty tables give no rows.
    """
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = out.withColumn("item_id", F.col("item_id").cast(items.schema[item_id].dataType))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    for part in _parts(_item_terms(items, item_text, item_id), part_terms):
        found = staged(postings(docs, part.vocabulary, text, doc_id), "postings")
        ranked = _searched(found, part, k).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = docs.sparkSession.createDataFrame(
            list(enumerate(part.ids)),
            T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", items.schema[item_id].dataType)]),
        )
        out = out.union(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
