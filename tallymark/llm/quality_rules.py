"""Quality rules: fixed base rules and a learned decision list.

`measure` counts words, lines and characters of whole texts. `fit` learns from labelled documents by
sequential covering: a rule for bad documents is grown on two thirds of the rows, condition by
condition (the threshold with the largest information gain), until it covers no good one; then
conditions are pruned from its end as the last third says, and the rows it covers leave. The rule
that is no longer right ends the list. `judge` evaluates the list as one ordered Spark conditional
expression over the counts, without Python.

Training takes a bounded sample: at most `sample` labelled documents, drawn by a hash of their ids,
their counts taken over whole texts. It meets in one task; the driver sees the rules.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.batches import BLANK, Words, map_arrow, sliced, text_array, without
from tallymark.llm.hashing import mix, range_hashes, shingle_hashes

SAMPLE = 20_000
LEAST_WORDS = 50
REPEATED_PERCENT = 50
LEAST_PRECISION = 0.95
LEAST_COVER = 5
MOST_RULES = 32
MOST_CONDITIONS = 4

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words",
    "n_lines", "n_closed_lines", "n_capitals", "n_digits", "n_marks",
)
#: What rules compare with thresholds: a count over another (one at least), or a count.
RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "word_length": ("word_chars", "n_words"),
    "repeated_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "distinct_words": ("n_distinct_words", "n_words"),
    "closed_lines": ("n_closed_lines", "n_lines"),
    "capitals": ("n_capitals", "word_chars"),
    "digits": ("n_digits", "word_chars"),
    "marks": ("n_marks", "word_chars"),
    "words": ("n_words", None),
}


def _byte_set(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_SYMBOLS = _byte_set(b"#*$%&|<>")
_CLOSING = _byte_set(b".!?:;\"')")
_CAPITALS = _byte_set(bytes(range(65, 91)))
_DIGITS = _byte_set(b"0123456789")
_MARKS = _byte_set(b".,;:!?")
_STARTS = np.ones(256, bool)  # bytes that begin a code point
_STARTS[0x80:0xC0] = False


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(np.flatnonzero(mask), offsets))


def _twice(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    _, again, n = np.unique(keys, return_inverse=True, return_counts=True)
    return n[again] > 1


def count_texts(texts: pa.StringArray) -> list[np.ndarray]:
    """The columns COUNTS of the texts."""
    words = Words(texts, lower=False)
    raw, offsets, n = words.raw, words.offsets, len(texts)
    n_words = np.diff(words.first)
    owner = np.repeat(np.arange(n), n_words)
    salt = mix(np.arange(1, n + 1, dtype=np.uint64))

    pairs = np.unique(words.hashes ^ salt[owner], return_index=True)[1]
    n_distinct = np.bincount(owner[pairs], minlength=n)

    windows = shingle_hashes(words.hashes, 3)
    inside = np.flatnonzero(owner[: len(windows)] == owner[2:]) if len(windows) else np.zeros(0, np.int64)
    again = inside[_twice(windows[inside] ^ salt[owner[inside]])]
    repeated = np.zeros(len(owner), bool)
    for k in range(3):
        repeated[again + k] = True

    # Lines: from a text's begin or a line feed to the next one or the text's end.
    feeds = np.flatnonzero(raw == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1], feeds + 1]))
    line_starts = line_starts[line_starts < len(raw)]
    line_ends = np.minimum.reduce([
        np.append(feeds, len(raw))[np.searchsorted(feeds, line_starts)],
        offsets[np.searchsorted(offsets, line_starts, side="right")],
    ]) if len(line_starts) else line_starts
    first_word = np.searchsorted(words.starts, line_starts)
    last_word = np.searchsorted(words.starts, line_ends)
    some = last_word > first_word
    line_starts, line_ends, last_word = line_starts[some], line_ends[some], last_word[some]
    line_owner = np.searchsorted(offsets, line_starts, side="right") - 1
    keys = range_hashes(raw, line_starts, line_ends) ^ salt[line_owner]
    firsts = np.unique(keys, return_index=True)[1]
    later = np.ones(len(keys), bool)
    later[firsts] = False
    last_byte = raw[words.ends[last_word - 1] - 1] if len(last_word) else np.zeros(0, np.uint8)

    solid = ~BLANK[raw]
    return [
        n_words,
        _per_text(_STARTS[raw] & solid, offsets),
        _per_text(_SYMBOLS[raw], offsets),
        np.bincount(line_owner[later], minlength=n),
        np.bincount(owner[repeated], minlength=n),
        n_distinct,
        np.bincount(line_owner, minlength=n),
        np.bincount(line_owner[_CLOSING[last_byte]], minlength=n),
        _per_text(_CAPITALS[raw], offsets),
        _per_text(_DIGITS[raw], offsets),
        _per_text(_MARKS[raw], offsets),
    ]


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` with the columns COUNTS (long) of every whole text instead of the text.

    Null and empty texts count 0 everywhere. Columns of these names are replaced; other columns and
    repeated rows stay.
    """
    kept = without(df, *COUNTS)
    column = kept.columns.index(text)
    others = [k for k in range(len(kept.columns)) if k != column]
    schema = T.StructType([
        *(kept.schema.fields[k] for k in others), *(T.StructField(c, T.LongType()) for c in COUNTS)
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, column):
                counts = count_texts(text_array(batch.column(column)))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k) for k in others), *(pa.array(c, pa.int64()) for c in counts)],
                    names=schema.names,
                )

    return map_arrow(kept, run, schema)


def ratio(name: str) -> Column:
    """A ratio of RATIOS as a column over COUNTS."""
    above, below = RATIOS[name]
    if below is None:
        return F.col(above).cast("double")
    return F.col(above).cast("double") / F.greatest(F.col(below), F.lit(1)).cast("double")


@dataclass
class Condition:
    name: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return ratio(self.name) > self.threshold if self.above else ratio(self.name) <= self.threshold

    def holds(self, x: np.ndarray) -> np.ndarray:
        values = x[:, list(RATIOS).index(self.name)]
        return values > self.threshold if self.above else values <= self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.threshold:.6g}"


def _covered(rule: list[Condition], x: np.ndarray) -> np.ndarray:
    held = np.ones(len(x), bool)
    for condition in rule:
        held &= condition.holds(x)
    return held


def _best(x: np.ndarray, bad: np.ndarray) -> Condition | None:
    """The condition of the largest information gain (FOIL's) over these rows; None without gain."""
    before = np.log2(bad.mean())
    best, chosen = 1e-9, None
    for k, name in enumerate(RATIOS):
        order = np.argsort(x[:, k], kind="stable")
        values, hits = x[order, k], np.cumsum(bad[order])
        cut = np.flatnonzero(values[1:] > values[:-1])
        for above in (False, True):
            p = hits[-1] - hits[cut] if above else hits[cut]
            size = len(values) - 1 - cut if above else cut + 1
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / size) - before), 0.0)
            if len(cut) and gain.max() > best:
                at = int(gain.argmax())
                low, high = values[cut[at]], values[cut[at] + 1]
                middle = (low + high) / 2
                best = gain[at]
                chosen = Condition(name, above, float(middle if low <= middle < high else low))
    return chosen


def _grown(x: np.ndarray, bad: np.ndarray) -> list[Condition]:
    rule: list[Condition] = []
    held = np.ones(len(x), bool)
    while len(rule) < MOST_CONDITIONS and not bad[held].all():
        condition = _best(x[held], bad[held])
        if condition is None:
            break
        rule.append(condition)
        held &= condition.holds(x)
    return rule


def _pruned(rule: list[Condition], x: np.ndarray, bad: np.ndarray) -> list[Condition]:
    """The shortest beginning of the rule with the best (p - n) / (p + n) on these rows."""
    def worth(some: list[Condition]) -> float:
        hits = bad[_covered(some, x)]
        return 2 * hits.mean() - 1 if len(hits) else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=worth)


def learn(x: np.ndarray, bad: np.ndarray, third: np.ndarray) -> list[list[Condition]]:
    """Rules in order. `x`: the ratios; `third`: 0, 1 (rows to grow on) or 2 (rows to prune on).

    A rule counts if LEAST_COVER bad rows at least are covered and LEAST_PRECISION of all covered
    ones are bad, in both parts. Without bad or without good rows there are no rules.
    """
    rules: list[list[Condition]] = []
    if not len(bad) or bad.all():
        return rules
    left = np.ones(len(bad), bool)
    while len(rules) < MOST_RULES:
        grow, prune = left & (third < 2), left & (third == 2)
        if not bad[grow].any() or bad[grow].all():
            break
        rule = _grown(x[grow], bad[grow])
        if not rule:
            break
        rule = _pruned(rule, x[prune], bad[prune])
        held = _covered(rule, x)
        parts = [bad[held & part] for part in (grow, prune)]
        if any(p.sum() < LEAST_COVER or p.mean() < LEAST_PRECISION for p in parts):
            break
        rules.append(rule)
        left &= ~held
    return rules


def fit(
    measured: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE,
    doc_id: str = "doc_id",
) -> list[list[Condition]]:
    """The decision list for bad documents: `label` 0 in `labels`; null labels and ids are left out.

    `measured` holds COUNTS (see `measure`). An id with several labels has the least of them. Of
    documents with the same ratios and label one counts. Empty tables give an empty list.
    """
    draw = F.pmod(F.xxhash64(F.col("doc"), F.lit("quality")), F.lit(1 << 30))
    named = labels.select(F.col(doc_id).cast("long").alias("doc"), F.col(label).cast("int").alias("y"))
    named = named.filter("doc is not null and y is not null").groupBy("doc").agg(F.min("y").alias("y"))
    rate = min(1.0, sample / max(1, named.count()))
    chosen = named.filter(draw <= int(rate * (1 << 30))).orderBy(draw, "doc").limit(sample)
    rows = (
        measured.select(F.col(doc_id).cast("long").alias("doc"), *(ratio(c).alias(c) for c in RATIOS))
        .join(F.broadcast(chosen), "doc")
        .select(*RATIOS, (F.col("y") == 0).alias("bad"), F.xxhash64(*RATIOS).alias("mark"))
        .distinct().orderBy("mark", *RATIOS, "bad").limit(sample)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        got = pa.Table.from_batches(held)
        x = np.column_stack([got.column(c).to_numpy() for c in RATIOS])
        third = (got.column("mark").to_numpy().view(np.uint64) >> np.uint64(20)) % np.uint64(3)
        found = learn(x, got.column("bad").to_numpy(), third)
        flat = [(k, c.name, c.above, c.threshold) for k, rule in enumerate(found) for c in rule]
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("rule", "name", "above", "threshold"), row)) for row in flat],
            schema=pa.schema([
                ("rule", pa.int32()), ("name", pa.string()), ("above", pa.bool_()), ("threshold", pa.float64()),
            ]),
        )

    found = map_arrow(rows.coalesce(1), run, "rule int, name string, above boolean, threshold double")
    rules: list[list[Condition]] = []
    for r in found.collect():
        if r["rule"] == len(rules):
            rules.append([])
        rules[r["rule"]].append(Condition(r["name"], r["above"], r["threshold"]))
    return rules


def judge(measured: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    """`measured` with base_failed, kept and rule (the text of the first rule that holds, else null).

    The base rules ask for LEAST_WORDS words and at most REPEATED_PERCENT percent of words in
    repeated windows of three; a text without words fails. Columns of these names are replaced.
    """
    base = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")
    )
    verdict = F.lit(None).cast("string")
    for k, rule in enumerate(rules):
        held = F.lit(True)
        for condition in rule:
            held = held & condition.column()
        text = F.lit(" and ".join(map(str, rule)))
        verdict = F.when(held, text) if not k else verdict.when(held, text)
    return without(measured, "base_failed", "kept", "rule").select(
        "*", base.alias("base_failed"), (~base & verdict.isNull()).alias("kept"), verdict.alias("rule")
    )
