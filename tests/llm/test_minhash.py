"""Components of near-duplicates against all pairs on full sets."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.llm.minhash import distinct_documents, near_duplicates, parity, shared_at_least
from tallymark.llm.q_dedup import op9


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def set_of(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows, percent):
    """rows: (doc_id, text) -> {index: (n, least id reachable)}."""
    sets = [set_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    holders = {}
    for k, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    pairs = {p for h in holders.values() for p in combinations(h, 2)}
    for i, j in pairs:
        a, b = sets[i], sets[j]
        if 100 * len(a & b) >= percent * len(a | b):
            parent[root(i)] = root(j)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(root(k), []).append(k)
    out = []
    for k, (doc, _) in enumerate(rows):
        ids = [rows[m][0] for m in groups[root(k)] if rows[m][0] is not None]
        least = min(ids, default=None)
        out.append((doc, len(sets[k]), least if sets[k] else doc, doc == (least if sets[k] else doc)))
    return out


def key(row):
    return tuple(-1 if x is None else x for x in row)


def check(spark, rows, percent):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = [tuple(r) for r in near_duplicates(df, percent).collect()]
    assert sorted(found, key=key) == sorted(brute(rows, percent), key=key)


def made(seed):
    pick = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = pick.choices(vocabulary, k=60)
    rows, bases = [], [pick.choices(vocabulary, k=pick.choice((5, 12, 60, 200))) for _ in range(12)]
    for k in range(320):
        words = list(pick.choice(bases)) if k % 4 else pick.choices(vocabulary, k=150)
        for _ in range(pick.choice((0, 0, 1, 2, 4))):
            words[pick.randrange(len(words))] = pick.choice(vocabulary)
        if k % 3 == 0:
            at = pick.randrange(len(words))
            words = words[:at] + passage + words[at:]
        text = pick.choice((" ", "\n", " \t ")).join(words)
        rows.append((k, text.upper() if k % 7 == 0 else text))
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_components_equal_all_pairs(spark, percent):
    check(spark, made(percent), percent)


def test_chain_and_large_group(spark):
    words = [f"v{k}" for k in range(300)]
    chain = [" ".join(words[k : k + 100]) for k in range(0, 120, 4)]  # neighbours only
    copies = [" ".join(["q"] * k + words[:60]) for k in (0, 1)] * 40
    near = []
    for k in range(120):
        own = list(words[100:220])
        own[k] = f"x{k}"
        near.append(" ".join(own))
    check(spark, list(enumerate(chain + copies + near)), 85)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE two"), (6, "two one"), (None, "one two"),
        (7, "a b c d e"), (7, "other text of some words here"), (8, "a b c d e"), (8, "a b c d e"),
        (None, "nobody else has this one"), (9, "É é É é É"), (10, "é É é É é"), (11, "x " * 30000),
        (12, "x " * 20000), (13, "a\x0bb\x0cc\rd\te f"), (14, "a b c d e f"),
    ]
    check(spark, rows, 85)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0


def test_one_row_of_each_group_stays(spark):
    """Rows that share an id, or have none, leave only with their own group."""
    text = " ".join(f"w{k}" for k in range(60))
    rows = [
        (1, text, "a"), (None, text + " x", "b"), (None, "clean text of some words without an id", "c"),
        (2, text + " y", "d"), (2, "another text under the id of a copy", "e"), (3, "three copies of a row", "f"),
        (3, "three copies of a row", "g"), (3, "three copies of a row", "h"), (None, "copies without an id", "i"),
        (None, "copies without an id", "j"), (None, "Copies  without an ID", "k"), (None, None, "l"), (None, " ", "m"),
        (4, None, "n"), (4, None, "o"), (5, "no copy of this", "p"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(4)
    out = distinct_documents(df)
    assert out.columns == df.columns
    got = [r.key for r in out.collect()]
    assert len(got) == len(set(got))
    assert set(got) - set("fghijk") == set("acelmnop")
    assert len(set(got) & set("fgh")) == len(set(got) & set("ijk")) == 1


def test_other_columns_are_left_alone(spark):
    df = spark.createDataFrame([(1, "a b", 3, "x"), (2, "a b", 4, "y")], "id int, body string, n int, key string")
    out = near_duplicates(df.withColumn("comp", F.lit(1)), doc_id="id", text="body").collect()
    assert sorted(tuple(r) for r in out) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_shared_values_bound():
    assert shared_at_least(48, 100) == 48
    assert 15 <= shared_at_least(48, 80) < shared_at_least(48, 85) <= 30


def test_parity_maps_never_differ_in_more_bits_than_the_sets_in_values():
    pick = np.random.default_rng(1)
    for size in (1, 50, 400, 5000):
        both = pick.integers(0, 1 << 63, size, dtype=np.uint64)
        a = np.unique(np.append(both, pick.integers(0, 1 << 63, size // 4, dtype=np.uint64)))
        b = np.unique(np.append(both, pick.integers(0, 1 << 63, size // 3, dtype=np.uint64)))
        differ = sum(int(x).bit_count() for x in (parity(a) ^ parity(b)).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b)) and (size > 100 or differ > 0 or len(a) == len(b))


def test_query_equals_all_pairs(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in op9(spark, folder).collect()) == sorted(brute(rows, 85))
