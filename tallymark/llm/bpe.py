"""BPE encoding and decoding on a contiguous rank array.

A word is an array of parts, and next to it the rank of each adjacent pair. The smallest rank is
found by a scan, its boundary is deleted, and the ranks on both sides of the merged part are looked
up anew, until no pair has a rank. Words of one slice that are new to the task run side by side as
the rows of one matrix; a word of more than 64 bytes runs alone, with a heap in place of the scan.
Words seen before come from a table of bounded size.

The vocabulary is read once per Python worker: from its path, or from bytes that were broadcast
(a vocabulary file is a few MB, and refused beyond 64 MB).
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallymark.llm.batches import map_arrow, sliced, string_array, text_array, without
from tallymark.llm.hashing import ranges_of
from tallymark.llm.pretokens import WordTable

NO_RANK = np.int32(1 << 30)
SHORT = 64
MOST_VOCABULARY_BYTES = 64 << 20


def read_vocabulary(path: str) -> bytes:
    """The file's bytes, for a broadcast of a proven size."""
    data = Path(path).read_bytes()
    if len(data) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MOST_VOCABULARY_BYTES} bytes")
    return data


def _byte_of_sign() -> dict[str, int]:
    """Vocabulary files write printable bytes as themselves and the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """Merges and token bytes of a byte-level BPE vocabulary file (.json)."""

    def __init__(self, data: bytes):
        content = json.loads(data)
        model = content["model"]
        ids = model["vocab"]
        byte = _byte_of_sign()
        self.specials = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
        self.size = 1 + max([*ids.values(), *self.specials.values()])
        token = [b""] * self.size
        for sign, number in ids.items():
            if sign not in self.specials:
                token[number] = bytes(byte[c] for c in sign)
        for text, number in self.specials.items():
            token[number] = text.encode()
        self._token_lengths = np.fromiter(map(len, token), np.int64, self.size)
        self._token_starts = np.cumsum(self._token_lengths) - self._token_lengths
        self._token_bytes = np.frombuffer(b"".join(token), np.uint8)
        self.byte_ids = np.zeros(256, np.int32)
        for sign, b in byte.items():
            self.byte_ids[b] = ids[sign]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        order = np.argsort(left << 32 | right)
        self._pairs = (left << 32 | right)[order]
        self._ranks = order.astype(np.int32)
        self._rank_of = dict(zip(self._pairs.tolist(), order.tolist()))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of token ids, NO_RANK where the pair never merges."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        return np.where(self._pairs[at] == key, self._ranks[at], NO_RANK)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and their numbers."""
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        lengths = np.zeros(len(raw), np.int64)
        parts: dict[int, np.ndarray] = {}
        for low, high in ((0, 8), (8, 16), (16, 32), (32, SHORT)):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            for start in range(0, len(rows), 8192):
                some = rows[start : start + 8192]
                ids, counts = self._side_by_side([raw[k] for k in some], sizes[some])
                lengths[some] = counts
                for k, row, count in zip(some.tolist(), ids, counts.tolist()):
                    parts[k] = row[:count]
        for k, word in enumerate(words):
            if word in self.specials:
                parts[k] = np.array([self.specials[word]], np.int32)
            elif sizes[k] > SHORT:
                parts[k] = self._alone(raw[k])
            elif sizes[k]:
                continue
            else:
                parts[k] = np.zeros(0, np.int32)
            lengths[k] = len(parts[k])
        flat = np.concatenate([parts[k] for k in range(len(raw))]) if raw else np.zeros(0, np.int32)
        return flat, lengths

    def _side_by_side(self, raw: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Short words as rows: parts in `ids`, the rank of parts k and k + 1 in `ranks`."""
        width = int(sizes.max())
        n = len(raw)
        ids = np.full((n, width + 1), -1, np.int32)
        filled = np.arange(width + 1) < sizes[:, None]
        ids[filled] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        ranks = np.full((n, width + 1), NO_RANK, np.int32)
        pair = filled[:, 1:]
        ranks[:, :-1][pair] = self.ranks(ids[:, :-1][pair], ids[:, 1:][pair])
        left = sizes.astype(np.int64).copy()
        done, rows = ids.copy(), np.arange(n)
        columns = np.arange(width + 1)
        while len(rows):
            at = ranks.argmin(1)
            every = np.arange(len(rows))
            best = ranks[every, at]
            over = best == NO_RANK
            if over.any():
                done[rows[over], : ids.shape[1]] = ids[over]
                keep = ~over
                rows, ids, ranks, at, best = rows[keep], ids[keep], ranks[keep], at[keep], best[keep]
                every = np.arange(len(rows))
                if not len(rows):
                    break
            # delete the boundary behind `at`: what is right of it moves one place to the left
            source = np.minimum(columns + (columns > at[:, None]), width)
            ids = np.take_along_axis(ids, source, 1)
            ranks = np.take_along_axis(ranks, source, 1)
            ids[:, width] = -1
            ranks[:, width] = NO_RANK
            ids[every, at] = self.merged[best]
            left[rows] -= 1
            behind = ids[every, at + 1]
            ranks[every, at] = np.where(
                behind >= 0, self.ranks(ids[every, at], np.maximum(behind, 0)), NO_RANK
            )
            inner = np.flatnonzero(at > 0)
            before = at[inner] - 1
            ranks[inner, before] = self.ranks(ids[inner, before], ids[inner, at[inner]])
        return done, left

    def _alone(self, word: bytes) -> np.ndarray:
        """A long word: the same merges, the smallest rank from a heap."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of, merged = self._rank_of, self.merged
        heap = []
        for k in range(n - 1):
            rank = rank_of.get(ids[k] << 32 | ids[k + 1])
            if rank is not None:
                heap.append((rank, k, ids[k], ids[k + 1]))
        heapq.heapify(heap)
        while heap:
            rank, k, a, b = heapq.heappop(heap)
            m = after[k] if ids[k] == a else n
            if m >= n or ids[m] != b:
                continue
            ids[k], ids[m] = int(merged[rank]), -1
            after[k] = after[m]
            if after[k] < n:
                before[after[k]] = k
            for i, j in ((before[k], k), (k, after[k])):
                if i >= 0 and j < n:
                    new = rank_of.get(ids[i] << 32 | ids[j])
                    if new is not None:
                        heapq.heappush(heap, (new, i, ids[i], ids[j]))
        return np.array([i for i in ids if i >= 0], np.int32)

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all id sequences, one after the other, and the end of each."""
        if len(ids) and (int(ids.min()) < 0 or int(ids.max()) >= self.size):
            raise ValueError("an id outside the vocabulary")
        sizes = self._token_lengths[ids]
        ends = np.append(0, np.cumsum(sizes))[np.cumsum(lengths)] if len(lengths) else lengths
        return self._token_bytes[ranges_of(self._token_starts[ids], sizes)], ends


_workers: dict[int, tuple[Vocabulary, WordTable]] = {}


def worker_vocabulary(data: bytes) -> tuple[Vocabulary, WordTable]:
    """Vocabulary and word table of this Python worker."""
    key = hash(data)
    if key not in _workers:
        vocabulary = Vocabulary(data)
        _workers.clear()
        _workers[key] = vocabulary, WordTable(vocabulary.encode_words)
    return _workers[key]


def encode(
    df: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids",
    decoded: str | None = None,
) -> DataFrame:
    """`df` with the token ids of `text` as a binary column of little-endian unsigned 32-bit ids.

    Null and empty texts have no ids (an empty binary). Special strings inside a text are their
    token. `decoded` names a column for the text that the ids give, as `decode` makes it, in the
    same pass. Columns of these names are replaced; every other column stays, repeated rows too.
    """
    data = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    added = [T.StructField(ids, T.BinaryType())]
    if decoded is not None:
        added.append(T.StructField(decoded, T.StringType()))
    kept = without(df, *(f.name for f in added))
    column = kept.columns.index(text)
    schema = T.StructType([*kept.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, table = worker_vocabulary(data.value)
        specials = tuple(vocabulary.specials)
        for whole in batches:
            for batch in sliced(whole, column):
                texts = text_array(batch.column(column)).to_pylist()
                flat, lengths = table.encode(texts, specials)
                packed = string_array(
                    flat.astype("<u4").view(np.uint8), np.cumsum(lengths) * 4, pa.binary()
                )
                columns = [*batch.columns, packed]
                if decoded is not None:
                    joined, ends = vocabulary.decode(flat, lengths)
                    columns.append(_utf8(string_array(joined, ends, pa.binary())))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(kept, run, schema)


def decode(df: DataFrame, vocabulary_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`df` with the text of a binary column of ids as `encode` writes it.

    Null ids give an empty text. Special tokens are kept; bytes that are no UTF-8 become U+FFFD.
    A column of the name `text` is replaced. An id outside the vocabulary is an error.
    """
    data = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    kept = without(df, text)
    column = kept.columns.index(ids)
    schema = T.StructType([*kept.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, _ = worker_vocabulary(data.value)
        for whole in batches:
            for batch in sliced(whole, column, 4 << 20):
                packed = pc.fill_null(batch.column(column).cast(pa.binary()), b"")
                sizes = pc.binary_length(packed).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = np.frombuffer(b"".join(packed.to_pylist()), "<u4").astype(np.int32)
                joined, ends = vocabulary.decode(flat, sizes // 4)
                texts = string_array(joined, ends, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, _utf8(texts)], names=[*whole.schema.names, text]
                )

    return map_arrow(kept, run, schema)


def _utf8(texts: pa.Array) -> pa.Array:
    try:
        return texts.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())
