"""Language identification, word first with backoff to shorter character n-grams.

Training counts words and character n-grams (1 to 5, with marks for a word's edges) per language.
A known word scores the logarithm of its relative frequency in each language. For an unknown word
the longest order at which any of its n-grams is known scores instead: the mean of the logarithms
of the known ones. A text's scores are the sums over its words; the language with the largest sum
wins, and its share after normalising is the score.

The model is fit on a bounded sample: documents chosen by a hash of id and text at a rate that gives
`per_language` documents of each language in the mean, their whole texts; rows equal in both count
once. It knows the `words` most frequent words and the `grams` most frequent n-grams of each order of
every language, each with its counts in all languages, so what is broadcast is bounded by the number
of languages (at most MOST_LANGUAGES).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.batches import map_arrow, sliced, text_array, without
from tallymark.llm.graph import staged
from tallymark.llm.hashing import HashIndex, range_hashes
from tallymark.llm.letters import LetterWords

PER_LANGUAGE = 3000
WORDS = 30_000
GRAMS = 10_000
ORDERS = 5
MOST_LANGUAGES = 500
_EDGE = 0x20
SLICE_BYTES = 1 << 18


def _padded(words: LetterWords, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of the words with a mark on both sides, and where each padded word begins."""
    lengths = words.ends[rows] - words.starts[rows] + 2
    ends = np.cumsum(lengths)
    starts = ends - lengths
    source = np.repeat(words.starts[rows] - 1 - starts, lengths) + np.arange(lengths.sum())
    codes = words.codes[np.clip(source, 0, max(len(words.codes) - 1, 0))].copy()
    codes[starts] = codes[ends - 1] = _EDGE
    return codes, starts, lengths


def _grams(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, order: int):
    """Hash and word number of every n-gram of `order` characters; a mark alone is none."""
    if order == 1:
        starts, lengths = starts + 1, lengths - 2
    counts = np.maximum(lengths - order + 1, 0)
    word = np.repeat(np.arange(len(starts)), counts)
    at = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return range_hashes(codes, at, at + order), word


@dataclass
class Model:
    """Known words (order 0) and n-grams: keys and, per key and language, log frequencies."""

    languages: list[str]
    keys: list[np.ndarray]
    logs: list[np.ndarray]

    def indexed(self) -> list[HashIndex]:
        out = []
        for keys in self.keys:
            index = HashIndex(len(keys))
            index.add(keys)
            out.append(index)
        return out


class Scorer:
    def __init__(self, model: Model):
        self.model, self.index = model, model.indexed()

    def _backoff(self, words: LetterWords, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of unknown words, and whether an n-gram of each is known: if not even a letter is,
        the scores are 0 for every language."""
        scores = np.zeros((len(rows), len(self.model.languages)))
        left = np.arange(len(rows))
        for order in range(ORDERS, 0, -1):
            if not len(left):
                break
            hashes, word = _grams(*_padded(words, rows[left]), order)
            found = self.index[order].find(hashes)
            known = found >= 0
            n = np.bincount(word[known], minlength=len(left))
            for k in range(scores.shape[1]):
                logs = self.model.logs[order][found[known], k]
                total = np.bincount(word[known], logs, minlength=len(left))
                scores[left[n > 0], k] = total[n > 0] / n[n > 0]
            left = left[n == 0]
        return scores, ~np.isin(np.arange(len(rows)), left)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language and score of each text, and whether the model knows any of its words or n-grams."""
        model = self.model
        words = LetterWords(texts)
        sums = np.zeros((len(texts), len(model.languages)))
        lettered = np.bincount(words.text, minlength=len(texts)) > 0
        rows = self.index[0].find(words.hashes)
        known = rows >= 0
        unknown = np.flatnonzero(~known)
        _, first, again = np.unique(words.hashes[unknown], return_index=True, return_inverse=True)
        backoff, some = self._backoff(words, unknown[first])
        known_texts = np.concatenate([words.text[known], words.text[unknown][some[again]]])
        evidence = np.bincount(known_texts, minlength=len(texts)) > 0
        for k in range(len(model.languages)):
            sums[:, k] = np.bincount(
                words.text[known], model.logs[0][rows[known], k], minlength=len(texts)
            ) + np.bincount(words.text[unknown], backoff[again, k], minlength=len(texts))
        if not model.languages:
            return ["und"] * len(texts), np.zeros(len(texts)), evidence
        best = sums.argmax(1)
        shares = np.exp(sums - sums.max(1, keepdims=True))
        score = np.where(lettered, 1 / shares.sum(1), 0.0)
        return [model.languages[b] if ok else "und" for b, ok in zip(best.tolist(), lettered)], score, evidence


def _counts(docs: DataFrame) -> DataFrame:
    """(lang, order, key, n) of words and n-grams, summed by slice. `docs`: lang, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, 1, SLICE_BYTES):
                langs, number = np.unique(np.array(batch.column(0).to_pylist()), return_inverse=True)
                words = LetterWords(text_array(batch.column(1)).to_pylist())
                lang = number[words.text]
                padded = _padded(words, np.arange(len(words.starts)))
                # one order at a time: all of them are many times the text
                for order in range(ORDERS + 1):
                    if order:
                        hashes, word = _grams(*padded, order)
                        of = lang[word]
                    else:
                        hashes, of = words.hashes, lang
                    for k, name in enumerate(langs.tolist()):
                        keys, n = np.unique(hashes[of == k], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([name] * len(keys), pa.string()),
                                pa.array(np.full(len(keys), order, np.int32)),
                                pa.array(keys.view(np.int64)), pa.array(n),
                            ],
                            names=["lang", "order", "key", "n"],
                        )

    return map_arrow(docs, run, "lang string, order int, key long, n long")


def fit(
    docs: DataFrame, per_language: int = PER_LANGUAGE, words: int = WORDS, grams: int = GRAMS,
    text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
) -> Model:
    """The model of the labelled rows of `docs` (lang and text not null).

    Repeated or null ids are drawn by their texts. Without such rows the model knows no language.
    """
    rows = docs.select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"),
        F.xxhash64(F.col(doc_id).cast("string"), F.col(text), F.lit("language")).alias("mark"),
    ).filter("lang is not null and text is not null").withColumn("draw", F.pmod("mark", F.lit(1 << 30)))
    totals = rows.groupBy("lang").count().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(totals) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not totals:
        empty = [np.zeros(0, np.uint64)] * (ORDERS + 1)
        return Model([], empty, [np.zeros((0, 0))] * (ORDERS + 1))
    languages = [r["lang"] for r in totals]
    below = F.create_map(*[
        F.lit(x)
        for r in totals
        for x in (r["lang"], int(min(1.0, per_language / r["count"]) * (1 << 30)))
    ])
    sample = rows.filter(F.col("draw") < below[F.col("lang")]).dropDuplicates(["lang", "mark"]).select("lang", "text")
    counts = staged(
        _counts(sample).groupBy("lang", "order", "key").agg(F.sum("n").alias("n")), "language"
    )
    rank = F.row_number().over(Window.partitionBy("lang", "order").orderBy(F.desc("n"), "key"))
    number = F.create_map(*[F.lit(x) for k, name in enumerate(languages) for x in (name, k)])
    top = (
        counts.withColumn("rank", rank)
        .filter(F.col("rank") <= F.when(F.col("order") == 0, words).otherwise(grams))
        .select("order", "key").distinct()
    )
    kept = (
        counts.join(top, ["order", "key"], "left_semi")
        .select(number[F.col("lang")].alias("column"), "order", "key", F.col("n").cast("int")).toArrow()
    )
    column, level, all_found, n = (kept.column(c).to_numpy() for c in ("column", "order", "key", "n"))
    sums = counts.groupBy("lang", "order").agg(F.sum("n").alias("total")).collect()
    total = {(r["lang"], r["order"]): r["total"] for r in sums}
    all_keys, logs = [], []
    for order in range(ORDERS + 1):
        some = level == order
        keys, row = np.unique(all_found[some].view(np.uint64), return_inverse=True)
        table = np.zeros((len(keys), len(languages)))
        table[row, column[some]] = n[some]
        every = np.array([total.get((name, order), 1) for name in languages], float)
        all_keys.append(keys)
        logs.append(np.log(np.maximum(table, 0.5) / every))
    return Model(languages, all_keys, logs)


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`df` with lang_pred and score (0 to 1) of every whole text.

    Texts that are null or have no letter, and every text if the model knows no language, get `und`
    and 0. Equal sums give the first language by name. Columns of these names are replaced, other
    columns and repeated rows stay.
    """
    data = df.sparkSession.sparkContext.broadcast(model)
    kept = without(df, "lang_pred", "score")
    column = kept.columns.index(text)
    schema = T.StructType([
        *kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(data.value)
        for whole in batches:
            for batch in sliced(whole, column, SLICE_BYTES):
                names, score, _ = scorer.predict(text_array(batch.column(column)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(names, pa.string()), pa.array(score)],
                    names=schema.names,
                )

    return map_arrow(kept, run, schema)


def recognised(df: DataFrame, model: Model, least: float = 0.0, text: str = "text") -> DataFrame:
    """The rows of `df` whose text has letters, some word or n-gram that the model knows, and a
    language with a score of at least `least`. So texts in a script of which nothing was learned go."""
    data = df.sparkSession.sparkContext.broadcast(model)
    column = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(data.value)
        for whole in batches:
            for batch in sliced(whole, column, SLICE_BYTES):
                names, score, evidence = scorer.predict(text_array(batch.column(column)).to_pylist())
                keep = (np.array(names, object) != "und") & evidence & (score >= least)
                yield batch.filter(pa.array(keep.astype(bool)))

    return map_arrow(df, run, df.schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that no model learns from: crc32 of the id's text is 2 modulo 4."""
    crc = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    return crc % 4 == 2
