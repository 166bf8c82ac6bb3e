"""Token counts by overlap resynchronisation.

A long text is cut into chunks that overlap. Each chunk is encoded by itself, with the character
offsets of its pre-tokens. Two neighbours are spliced where both have a boundary that is proven:

- In the left chunk, a boundary is right if it follows from right boundaries before it and lies at
  least `margin` characters before the chunk's end. No pre-token looks further ahead than two
  characters behind its end, and a special string that starts before the boundary is seen whole.
- The pattern never looks back, so from a right boundary on the right chunk is encoded as the
  whole text would be.

Where an overlap has no common boundary (one very long word or run of blanks), it is widened: the
left chunk is encoded again from its last proven boundary through the end of the right one, and
further in doubling steps until there is such a boundary or the text ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallymark.llm.batches import SLICE_BYTES, map_arrow, sliced, text_array, without
from tallymark.llm.bpe import read_vocabulary
from tallymark.llm.library import Library, worker_library
from tallymark.llm.pretokens import PreTokens

CHUNK = 8192
OVERLAP = 256


class _Encoded:
    """Boundaries of a chunk in the text's characters, and the tokens before each boundary."""

    def __init__(self, start: int, stop: int, boundaries: np.ndarray, before: np.ndarray):
        self.start, self.stop, self.boundaries, self.before = start, stop, boundaries, before

    def tokens(self, low: int, high: int | None = None) -> int:
        """Tokens from boundary `low` to boundary `high` (or the chunk's end)."""
        first = self.before[np.searchsorted(self.boundaries, low)]
        last = self.before[-1] if high is None else self.before[np.searchsorted(self.boundaries, high)]
        return int(last - first)


class Counter:
    """Counts the tokens of texts with `chunk` characters at a time."""

    def __init__(self, library: Library, chunk: int = CHUNK, overlap: int = OVERLAP):
        if not 0 < overlap < chunk:
            raise ValueError("0 < overlap < chunk")
        self.library, self.chunk, self.overlap = library, chunk, overlap
        self.margin = 4 + max(map(len, library.specials), default=0)
        self.widened = 0

    def _encode(self, pieces: list[tuple[str, int, int]]) -> Iterator[_Encoded]:
        """Chunks (text, start, stop), encoded side by side."""
        pre = PreTokens([text[a:b] for text, a, b in pieces], self.library.specials)
        table = self.library.table
        before = np.append(0, np.cumsum(table.lengths(table.rows(pre))))
        for k, (_, a, b) in enumerate(pieces):
            low, high = pre.first[k], pre.first[k + 1]
            yield _Encoded(
                a, b, pre.starts[low:high] - pre.offsets[k] + a, before[low : high + 1]
            )

    def _pieces(self, texts: list[str]) -> Iterator[tuple[int, tuple[str, int, int]]]:
        for k, text in enumerate(texts):
            start = 0
            while True:
                stop = min(len(text), start + self.chunk)
                yield k, (text, start, stop)
                if stop == len(text):
                    break
                start = stop - self.overlap

    def _groups(self, texts: list[str]):
        group, size = [], 0
        for item in self._pieces(texts):
            group.append(item)
            size += item[1][2] - item[1][1]
            if size >= SLICE_BYTES:
                yield group
                group, size = [], 0
        if group:
            yield group

    def count(self, texts: list[str]) -> np.ndarray:
        totals = np.zeros(len(texts), np.int64)
        doc, splice = -1, None
        for group in self._groups(texts):
            for (k, (text, _, _)), chunk in zip(group, self._encode([p for _, p in group])):
                if k != doc:
                    doc, splice = k, _Splice(self, text)
                totals[k] = splice.take(chunk)
        return totals


class _Splice:
    """One text: tokens up to a proven boundary, and the chunk that goes on from there."""

    def __init__(self, counter: Counter, text: str):
        self.counter, self.text = counter, text
        self.total, self.at = 0, 0
        self.left: _Encoded | None = None

    def take(self, right: _Encoded) -> int:
        """Tokens of the text if `right` is its last chunk."""
        if self.left is None:
            self.left = right
        elif right.stop > self.left.stop:
            common = np.intersect1d(self._proven(), right.boundaries, assume_unique=True)
            if not len(common):
                right = self._widen(right.stop)
                common = right.boundaries[:1]
            self._move(int(common[0]), right)
        return self.total + (self.left.tokens(self.at) if len(self.left.boundaries) else 0)

    def _proven(self) -> np.ndarray:
        left = self.left
        most = left.stop - self.counter.margin
        return left.boundaries[(left.boundaries >= self.at) & (left.boundaries <= most)]

    def _move(self, boundary: int, right: _Encoded) -> None:
        self.total += self.left.tokens(self.at, boundary)
        self.at, self.left = boundary, right

    def _widen(self, stop: int) -> _Encoded:
        counter = self.counter
        counter.widened += 1
        proven = self._proven()
        start = int(proven[-1]) if len(proven) else self.at
        while True:
            wide = next(counter._encode([(self.text, start, stop)]))
            most = stop - counter.margin
            if stop == len(self.text) or (
                (wide.boundaries > start) & (wide.boundaries <= most)
            ).any():
                return wide
            stop = min(len(self.text), start + 2 * (stop - start))


def count_tokens(
    df: DataFrame, vocabulary_path: str, text: str = "text", limit: int = 1024,
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """`df` with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of `text`.

    The counts are those of the tokenizers library for whole texts, special strings inside texts
    included. Null and empty texts have none. Columns of these names are replaced; all other
    columns and repeated rows stay.
    """
    data = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    added = ("n_bytes", "n_tokens", "over_limit")
    kept = without(df, *added)
    column = kept.columns.index(text)
    kinds = (T.LongType(), T.LongType(), T.BooleanType())
    schema = T.StructType(
        [*kept.schema.fields, *(T.StructField(n, kind) for n, kind in zip(added, kinds))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(worker_library(data.value), chunk, overlap)
        for whole in batches:
            for batch in sliced(whole, column):
                texts = text_array(batch.column(column))
                n = counter.count(texts.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns, pc.binary_length(texts).cast(pa.int64()), pa.array(n),
                        pa.array(n > limit),
                    ],
                    names=[*whole.schema.names, *added],
                )

    return map_arrow(kept, run, schema)
