"""Ranked search against a plain version and its SQL, pruning, odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import connect, differences

from tallymark.llm import lexical_search
from tallymark.llm.lexical_search import search
from tallymark.llm.q_search import OP13_SQL, op13
from tallymark.staging import stage

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=10):
    """(item_id, rank, doc_id, score) of lists of (id, text)."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, total = len(counts), sum(c.total() for _, c in counts)
    holding = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in counts:
            m = 10 + 90 * c.total() * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1)))
                * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(terms(text)) if c[t]
            )
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        best = sorted(scores)[:k]
        out += [(item, rank, row[3], -row[0]) for rank, row in enumerate(best, 1)]
    return out


def made(n, words, seed, length=(1, 60)):
    pick = random.Random(seed)
    weights = [1 / (k + 1) for k in range(len(words))]
    return [(k, " ".join(pick.choices(words, weights, k=pick.randint(*length)))) for k in range(n)]


def got(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@pytest.mark.parametrize("rows, postings", [(1 << 16, 1 << 21), (7, 1 << 21), (1 << 16, 50)])
def test_equals_plain_version(spark, monkeypatch, rows, postings):
    words = [f"{a}{b}" for a in "ABcdéF" for b in "xyz12Ü"]
    docs, items = made(300, words, 1), made(40, words, 2, (1, 12))
    monkeypatch.setattr(lexical_search, "BLOCK_ROWS", rows)
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", postings)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    assert got(search(d, i)) == plain(docs, items)
    assert got(search(d, i, k=3, part_terms=25)) == plain(docs, items, 3)


def test_items_of_more_than_64_terms(spark):
    words = [f"w{k}" for k in range(300)]
    docs, items = made(200, words, 3, (20, 200)), made(5, words, 4, (300, 600))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    assert got(search(d, i)) == plain(docs, items)


def test_groups_below_the_best_are_not_scored(monkeypatch):
    best = lexical_search._Best(2)
    block = lexical_search._Block.__new__(lexical_search._Block)
    n = 1000
    block.doc, block.null = np.arange(n), np.zeros(n, bool)
    # term 0 in the first three documents, term 1 in all
    block.row = np.concatenate([np.arange(3), np.arange(n)])
    block.gain = np.concatenate([np.array([50, 40, 30]), np.full(n, 2)])
    block.first, block.top = np.array([0, 3, 3 + n]), np.array([50, 2])
    scored = []
    monkeypatch.setattr(best, "add", lambda s, d, u, add=best.add: scored.extend(d.tolist()) or add(s, d, u))
    block.search(np.array([0, 1]), np.array([10, 1]), best)
    assert scored == [0, 1, 2] and best.doc.tolist() == [0, 1] and best.score.tolist() == [502, 402]


def test_odd_rows(spark):
    docs = [
        (5, "alpha beta"), (4, "alpha beta"), (None, "alpha beta"), (4, "alpha beta"), (1, None), (2, ""), (3, "... !!"),
        (9, "gamma " * 100_000 + "delta"), (8, "ALPHA-Beta éé"), (7, "αβγ 42"),
    ]
    items = [(1, "Alpha"), (1, "beta; alpha alpha"), (2, None), (3, ""), (None, "DELTA"), (4, "zeta"), (5, "42 αβγ éé")]
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, score string, item long")
    i = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, rank string")
    assert sorted(map(str, got(search(d, i)))) == sorted(map(str, plain(docs, items)))
    assert search(d.limit(0), i).count() == search(d, i.limit(0)).count() == 0
    assert search(d, i.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_lengths_beyond_a_long():
    n = np.array([1, 10**9, 10**10], np.int64)
    assert lexical_search._tempered(n, 10**10, 10**13).tolist() == [10 + 90 * int(c) * 10**10 // 10**13 for c in n]


def test_query_equals_its_statement(spark, folder):
    problem, rows = differences(stage(op13(spark, folder), "ranked"), connect(folder), OP13_SQL)
    assert problem is None and rows > 0
