"""Passages that repeat across documents, by content-defined chunking.

A rolling gear hash runs over the words of a text: the hash of the last word moves up by half its
bits and that of the next word is added, so it depends on two words. A chunk begins where the gear
hash is least among its two neighbours on each side. A boundary thus depends on six words around it
and on no position: words inserted before a passage move its chunks along but do not change them.
Chunks have five words in the mean. Consecutive chunks from each boundary on, until they hold
`least` words, are digested together; a digest that occurs in several documents is a repeat. A
passage of 50 words keeps its own boundaries but for some words at either end, so a run of `least`
= 25 words inside it is found, while stock phrases of fewer than 25 words never count.

The first pass reduces (digest, document) to the least and the greatest document of each digest,
combined before the shuffle, and writes those that repeat. The second pass computes the chunks again
and meets them in a plain join of two shuffles, so that Spark splits the places of a digest that very
many documents hold. Before, a look at ids and digests of the texts tells whether ids are shared.

A document is an id; where rows with different texts share an id, or have none, it is an id with a
digest of the text, so that places belong to the text they were found in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.batches import Words, fresh, map_arrow, sliced, text_array
from tallymark.llm.graph import measured, staged
from tallymark.llm.hashing import sequence_hashes

LEAST_WORDS = 25
MOST_CUTS = 100_000
_NO_ID = -(1 << 63)


def chunk_starts(words: Words) -> np.ndarray:
    """Word numbers at which a chunk begins; the first word of each text is one."""
    n = len(words.hashes)
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    gear = words.hashes.copy()
    same = text[1:] == text[:-1]
    gear[1:][same] += words.hashes[:-1][same] << np.uint64(32)
    cut = np.ones(n, bool)
    for d in (1, 2):
        other = text[d:] != text[:-d]
        cut[d:] &= other | (gear[d:] <= gear[:-d])
        cut[:-d] &= other | (gear[:-d] <= gear[d:])
    cut[words.first[:-1][np.diff(words.first) > 0]] = True
    return np.flatnonzero(cut)


def runs(words: Words, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of whole chunks with `least` words or some more: first word, end, text number."""
    cuts = chunk_starts(words)
    text = np.searchsorted(words.first, cuts, side="right") - 1
    fits = cuts + least <= words.first[text + 1]
    starts, text = cuts[fits], text[fits]
    bounds = np.append(cuts, len(words.hashes))
    return starts, bounds[np.searchsorted(bounds, starts + least)], text


def _number(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID))


def _mark(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def _shared(df: DataFrame, doc_id: str, text: str) -> bool:
    """Whether rows with different texts share an id or have none."""
    marks = df.select(_number(doc_id).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark"))
    ends = marks.groupBy("id").agg(F.min("mark").alias("low"), F.max("mark").alias("high"))
    return not ends.filter("low < high").isEmpty()


def _key(shared: bool, doc_id: str, text: str) -> Column:
    """What tells documents apart, in order of their ids."""
    number = _number(doc_id)
    return F.struct(number.alias("id"), _mark(text).alias("mark")) if shared else number


def _occurrences(docs: DataFrame, least: int, places: bool) -> DataFrame:
    """(digest, doc) of every run, with its words (start, stop) if `places`."""
    kind = docs.schema[0].dataType.simpleString()
    names = ["digest", "doc", *(["start", "stop"] if places else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, 1):
                words = Words(text_array(batch.column(1)))
                starts, ends, text = runs(words, least)
                digest = sequence_hashes(words.hashes, starts, ends).view(np.int64)
                columns = [pa.array(digest), batch.column(0).take(pa.array(text))]
                if places:
                    before = words.first[text]
                    columns += [
                        pa.array((starts - before).astype(np.int32)),
                        pa.array((ends - before).astype(np.int32)),
                    ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_arrow(docs, run, f"digest long, doc {kind}" + ", start int, stop int" * places)


def _places(df: DataFrame, least: int, doc_id: str, text: str, shared: bool) -> DataFrame:
    """The rows of `repeats`, with the keys of the documents: doc, start_word, n_words, first_doc, kept."""
    docs = df.select(_key(shared, doc_id, text).alias("doc"), F.col(text))
    first = _occurrences(docs, least, False).groupBy("digest").agg(
        F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc")
    )
    repeated = staged(first.filter("first_doc < last_doc").select("digest", "first_doc"), "repeated")
    places = _occurrences(docs, least, True).join(repeated, "digest").select(
        "doc", "start", "stop", "first_doc", (F.col("doc") == F.col("first_doc")).alias("kept")
    )
    order = Window.partitionBy("doc", "kept").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start") <= reach, 0).otherwise(1)).over(order)
    return (
        places.dropDuplicates(["doc", "start", "stop", "first_doc"]).withColumn("island", island)
        .groupBy("doc", "kept", "island")
        .agg(
            F.min("start").alias("start"), F.max("stop").alias("stop"),
            F.min("first_doc").alias("first_doc"),
        )
        .select(
            "doc", F.col("start").alias("start_word"), (F.col("stop") - F.col("start")).alias("n_words"),
            "first_doc", "kept",
        )
    )


def repeats(
    df: DataFrame, least: int = LEAST_WORDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Repeated passages: doc_id, start_word, n_words, first_doc_id, kept; a row per place.

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased, counted from 0. A passage repeats if it
    occurs in documents with different ids or different texts; repeats within one document do not
    count, nor do rows that repeat an id with its text. `kept`: the place is in the passage's first
    document, the one with the least id and, among rows that share it, the least digest of the text.
    Overlapping runs of a document are one place; first_doc_id is the least of theirs. Null, empty
    and short texts have no place. A null doc_id is the least. Other columns are not read.
    """
    places = _places(df, least, doc_id, text, _shared(df, doc_id, text))
    number = ("doc.id", "first_doc.id") if isinstance(places.schema["doc"].dataType, T.StructType) else ("doc", "first_doc")
    return places.select(
        F.nullif(F.col(number[0]), F.lit(_NO_ID)).alias("doc_id"), "start_word", "n_words",
        F.nullif(F.col(number[1]), F.lit(_NO_ID)).alias("first_doc_id"), "kept",
    )


def _cut(text: str, spans: list[dict]) -> str:
    """The text without the words of the spans and the blanks behind them."""
    words = Words(pa.array([text], pa.string()))
    bounds = np.append(words.starts, len(words.raw))
    keep = np.ones(len(words.raw), bool)
    for span in spans:
        low = span["start_word"]
        keep[bounds[low] : bounds[low + span["n_words"]]] = False
    return words.raw[keep].tobytes().decode()


def remove_repeats(
    df: DataFrame, least: int = LEAST_WORDS, doc_id: str = "doc_id", text: str = "text",
    n_chars: str | None = None,
) -> DataFrame:
    """Every row of `df`, its text without the repeated passages that an earlier document has.

    Columns and their order stay; `n_chars` names a column to set to the new length where a text
    was cut. A document that is nothing but a repeat keeps its row with what is left.
    """
    shared = _shared(df, doc_id, text)
    spans = _places(df, least, doc_id, text, shared).filter("not kept")
    doc, mark, found = fresh(df, "__doc", "__mark", "__spans")
    cuts = spans.groupBy("doc").agg(F.collect_list(F.struct("start_word", "n_words")).alias(found))
    number = F.col("doc.id") if shared else F.col("doc")
    same = _number(doc_id) == F.col(doc)
    if shared:
        cuts = cuts.select(number.alias(doc), F.col("doc.mark").alias(mark), found)
        same &= _mark(text) == F.col(mark)
    else:
        cuts = cuts.select(number.alias(doc), found)
    cuts = measured(cuts, "cuts", MOST_CUTS)
    joined = df.join(cuts, same, "left").drop(doc, mark)
    schema = T.StructType(df.schema.fields)
    column = df.columns.index(text)
    count = df.columns.index(n_chars) if n_chars else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans_of = batch.column(batch.num_columns - 1)
            columns = list(batch.columns[:-1])
            rows = np.flatnonzero(pc.is_valid(spans_of).to_numpy(zero_copy_only=False))
            if len(rows):
                texts = columns[column].to_pylist()
                for k in rows.tolist():
                    texts[k] = _cut(texts[k] or "", spans_of[k].as_py())
                columns[column] = pa.array(texts, columns[column].type)
                if count is not None:
                    counts = columns[count].to_pylist()
                    for k in rows.tolist():
                        counts[k] = len(texts[k])
                    columns[count] = pa.array(counts, columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(joined, run, schema)
