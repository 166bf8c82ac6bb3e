"""Token files of bit-packed ids: fixed width, blocks with offsets, random access.

A store is a folder. `segments` holds Parquet rows, each with one binary payload:

    bytes 0-3    b"TKB1"
    byte  4      width: bits of each id, the least that hold the largest id of the vocabulary
    bytes 5-8    ids in a block (little-endian unsigned 32-bit), a multiple of 64
    bytes 9-16   number of ids (unsigned 64-bit)
    then         blocks + 1 unsigned 64-bit offsets of the blocks, from the end of this table
    then         the blocks: ids one after the other, least significant bit first

A segment holds whole documents, about `segment_ids` ids (more for one longer document), with the
documents' ids and lengths in columns next to it. Segments of one task carry its number `part`;
parts are ranges of document ids. `parts` holds where each part starts among the ids of all
documents. So readers unpack any document, or any block, without its neighbours, and Parquet's own
statistics skip segments by document id.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.llm.batches import map_arrow, sliced, string_array, text_array
from tallymark.llm.bpe import read_vocabulary
from tallymark.llm.library import worker_library

BLOCK = 4096
SEGMENT_IDS = 1 << 18
SLICE_BYTES = 1 << 20
TABLE_WORDS = 1_000_000
_MAGIC, _HEADER = b"TKB1", "<4sBIQ"
_START = struct.calcsize(_HEADER)

_SEGMENTS = (
    "part int, segment int, first long, n_ids long, low_doc long, high_doc long, "
    "doc_ids array<bigint>, lengths array<bigint>, payload binary"
)


def bits_for(vocabulary_size: int) -> int:
    return max(1, int(vocabulary_size - 1).bit_length())


def _pack_bits(ids: np.ndarray, width: int) -> np.ndarray:
    """Bytes of the ids, `width` bits each: 64 ids fill `width` words of 64 bits."""
    n = len(ids)
    groups = np.zeros((-(-n // 64), 64), np.uint64)
    groups.reshape(-1)[:n] = ids
    words = np.zeros((len(groups), width), np.uint64)
    for k in range(64):
        word, shift = divmod(k * width, 64)
        words[:, word] |= groups[:, k] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= groups[:, k] >> np.uint64(64 - shift)
    return words.astype("<u8").view(np.uint8).reshape(-1)[: -(-n * width // 8)]


def _unpack_bits(data: np.ndarray, n: int, width: int) -> np.ndarray:
    groups = -(-n // 64)
    words = np.zeros(groups * width * 8, np.uint8)
    words[: len(data)] = data
    words = words.view("<u8").reshape(groups, width)
    out = np.empty((groups, 64), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for k in range(64):
        word, shift = divmod(k * width, 64)
        out[:, k] = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            out[:, k] |= words[:, word + 1] << np.uint64(64 - shift)
    return (out.reshape(-1)[:n] & mask).astype(np.uint32)


def pack(ids: np.ndarray, width: int, block: int = BLOCK) -> bytes:
    """The payload of a segment. An id that needs more than `width` bits is an error."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    if not 1 <= width <= 32 or block % 64:
        raise ValueError("1 to 32 bits, and blocks of a multiple of 64 ids")
    counts = np.diff(np.append(np.arange(0, len(ids), block), len(ids)))
    offsets = np.append(0, np.cumsum(-(-counts * width // 8))).astype("<u8")
    header = struct.pack(_HEADER, _MAGIC, width, block, len(ids))
    return header + offsets.tobytes() + _pack_bits(ids, width).tobytes()


def unpack(payload: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids first to last (without last) of a segment; reads only the blocks that hold them."""
    magic, width, block, n = struct.unpack_from(_HEADER, payload)
    if magic != _MAGIC:
        raise ValueError("no token segment")
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, np.uint32)
    blocks = -(-n // block)
    offsets = np.frombuffer(payload, "<u8", blocks + 1, _START)
    low, high = first // block, -(-last // block)
    base = _START + 8 * (blocks + 1)
    data = np.frombuffer(
        payload, np.uint8, int(offsets[high] - offsets[low]), base + int(offsets[low])
    )
    ids = _unpack_bits(data, min(n, high * block) - low * block, width)
    return ids[first - low * block : last - low * block]


class _Part:
    """Documents of one task, gathered into segments."""

    def __init__(self, width: int, most: int):
        self.width, self.most = width, most
        self.part, self.segment, self.first = TaskContext.get().partitionId(), 0, 0
        self.ids: list[np.ndarray] = []
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.held = 0

    def add(self, docs: list, flat: np.ndarray, lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
        start, ends = 0, np.cumsum(lengths)
        done = 0
        while start < len(docs):
            stop = int(np.searchsorted(ends, done + self.most - self.held)) + 1
            stop = min(max(stop, start + 1), len(docs))
            self.ids.append(flat[done : ends[stop - 1]])
            self.docs += docs[start:stop]
            self.lengths += lengths[start:stop].tolist()
            self.held += int(ends[stop - 1]) - done
            start, done = stop, int(ends[stop - 1])
            if self.held >= self.most:
                yield self.flush()

    def flush(self) -> pa.RecordBatch:
        known = [d for d in self.docs if d is not None]
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array([self.part], pa.int32()), pa.array([self.segment], pa.int32()),
                pa.array([self.first], pa.int64()), pa.array([self.held], pa.int64()),
                pa.array([min(known, default=None)], pa.int64()),
                pa.array([max(known, default=None)], pa.int64()),
                pa.array([self.docs], pa.list_(pa.int64())),
                pa.array([self.lengths], pa.list_(pa.int64())),
                pa.array([pack(np.concatenate(self.ids), self.width)], pa.binary()),
            ],
            names=[f.split(" ")[0] for f in _SEGMENTS.split(", ")],
        )
        self.segment += 1
        self.first += self.held
        self.ids, self.docs, self.lengths, self.held = [], [], [], 0
        return batch


def write(
    df: DataFrame, folder: str, vocabulary_path: str, end_id: int = 2, doc_id: str = "doc_id",
    text: str = "text", segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encode every text with the tokenizers library, append `end_id`, and write a store.

    Documents are in ascending order of `doc_id` (an integer; null first, then equal ids by a hash
    of the text; repeated rows stay, one behind the other). A null or empty text is its end id
    alone. An empty table gives a store without documents. Other columns are not read.
    """
    spark = df.sparkSession
    data = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = worker_library(data.value, TABLE_WORDS)
        part = _Part(bits_for(max(library.size, end_id + 1)), segment_ids)
        for whole in batches:
            for batch in sliced(whole, 1, SLICE_BYTES):
                texts = text_array(batch.column(1)).to_pylist()
                flat, lengths = library.table.encode(texts, library.specials)
                ends = np.cumsum(lengths)
                flat = np.insert(flat, ends, end_id)
                yield from part.add(batch.column(0).to_pylist(), flat, lengths + 1)
        if part.docs:
            yield part.flush()

    order = [F.asc_nulls_first("doc"), F.asc("tie")]
    docs = (
        df.select(
            F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"),
            F.xxhash64(F.col(text)).alias("tie"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    segments = map_arrow(docs.select("doc", "text"), run, _SEGMENTS)
    segments.write.option("compression", "zstd").parquet(f"{folder}/segments")
    # one row per task of the write above
    totals = (
        spark.read.schema(_SEGMENTS).parquet(f"{folder}/segments")
        .groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals.select(
        "part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start")
    ).coalesce(1).write.parquet(f"{folder}/parts")


def read(spark: SparkSession, folder: str, wanted: list[int] | None = None) -> DataFrame:
    """Documents of a store: doc_id, start (ids of all documents before it), n_tokens with the end
    id, ids (binary, little-endian unsigned 32-bit). `wanted`: these document ids only; segments
    without them are skipped and only their blocks are unpacked."""
    segments = spark.read.schema(_SEGMENTS).parquet(f"{folder}/segments")
    if wanted is not None:
        hit = F.lit(False)
        for w in wanted:
            hit = hit | ((F.col("low_doc") <= w) & (F.col("high_doc") >= w))
        segments = segments.filter(hit)
    parts = spark.read.schema("part int, start long").parquet(f"{folder}/parts")
    rows = segments.join(F.broadcast(parts), "part").select(
        (F.col("start") + F.col("first")).alias("start"), "doc_ids", "lengths", "payload"
    )
    only = None if wanted is None else set(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start, docs, lengths, payload in zip(*(c for c in whole.columns)):
                yield from _documents(
                    start.as_py(), docs.as_py(), np.array(lengths.as_py(), np.int64),
                    payload.as_py(), only,
                )

    return map_arrow(rows, run, "doc_id long, start long, n_tokens long, ids binary")


def _documents(start, docs, lengths, payload, only) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "n_tokens", "ids"]
    before = np.cumsum(lengths) - lengths
    if only is None:
        data = unpack(payload).astype("<u4").view(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(docs, pa.int64()), pa.array(start + before), pa.array(lengths),
                string_array(data, np.cumsum(lengths) * 4, pa.binary()),
            ],
            names=names,
        )
        return
    for k in [k for k, d in enumerate(docs) if d in only]:
        ids = unpack(payload, int(before[k]), int(before[k] + lengths[k])).astype("<u4")
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([docs[k]], pa.int64()), pa.array([start + before[k]]),
                pa.array([lengths[k]]), pa.array([ids.tobytes()], pa.binary()),
            ],
            names=names,
        )
