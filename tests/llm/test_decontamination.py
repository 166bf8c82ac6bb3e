"""Greedy string tiling against a plain search for the longest unmarked run."""

import random
import re

import pytest

from tallymark.llm.decontamination import clean, contaminated
from tallymark.llm.q_filters import op5


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def coverage(item, doc, tile):
    size = min(tile, len(item))
    used_a, used_b, total = [False] * len(item), [False] * len(doc), 0
    while size:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and not used_a[i + k] and not used_b[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        n, i, j = best
        if n < size:
            break
        for k in range(n):
            used_a[i + k] = used_b[j + k] = True
        total += n
    return total / len(item)


def brute(docs, items, tile, threshold):
    out = []
    for d, text in docs:
        for k, item in items:
            a = words_of(item)
            c = coverage(a, words_of(text), tile) if a else 0
            if a and c >= threshold:
                out.append((d, k, round(c, 9)))
    return sorted(out, key=str)


def found(df, bench, **options):
    rows = contaminated(df, bench, **options).collect()
    return sorted(((r.doc_id, r.item_id, round(r.coverage, 9)) for r in rows), key=str)


@pytest.mark.parametrize("threshold", [0.3, 0.6])
def test_equals_plain_tiling(spark, threshold):
    pick = random.Random(4)
    words = [f"v{k}" for k in range(30)]
    items = [(k, " ".join(pick.choices(words, k=pick.choice((1, 2, 3, 4, 12, 25))))) for k in range(12)]
    docs = []
    for d in range(60):
        own = pick.choices(words, k=pick.randint(0, 30))
        if d % 2:
            part = pick.choice(items)[1].split()
            cut = pick.randrange(len(part) + 1)
            own += part[cut:] + pick.choices(words, k=3) + part[:cut]
        docs.append((d, " ".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert found(df, bench, threshold=threshold) == brute(docs, items, 4, threshold)


def test_reordered_passage_and_odd_rows(spark):
    item = [f"q{k}" for k in range(30)]
    swapped = " ".join(item[20:] + ["and"] + item[8:20] + ["so", "on"] + item[:8])
    docs = [
        (1, None, 1), (2, "", 2), (3, swapped.upper(), 3), (None, " ".join(item), 4), (5, "x " * 30000, 5),
        (6, "clean text", 6), (3, swapped.upper(), 3), (7, "w\n" * 40 + " ".join(item[:15]), 7),
    ]
    items = [(1, " ".join(item)), (2, None), (3, ""), (4, "x x x x x x x"), (1, " ".join(item)), (None, "clean TEXT")]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert found(df, bench) == sorted(
        [(3, 1, 1.0)] * 4 + [(None, 1, 1.0)] * 2 + [(5, 4, 1.0), (6, None, 1.0)], key=str
    )
    left = clean(df, bench)
    assert left.columns == df.columns
    assert sorted(r.item_id for r in left.collect()) == [1, 2, 7]
    assert found(df, bench.limit(0)) == [] and clean(df, bench.limit(0)).count() == len(docs)
    assert found(df.limit(0), bench) == [] and clean(df.limit(0), bench).count() == 0


def test_query_finds_whole_items(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    rows = {(r.doc_id, r.item_id): r.coverage for r in op5(spark, folder).collect()}
    whole = {(d.doc_id, b.item_id) for d in docs for b in items if b.text in (d.text or "")}
    assert whole and whole <= rows.keys()
    texts = {d.doc_id: words_of(d.text) for d in docs}
    wanted = {b.item_id: words_of(b.text) for b in items}
    for (d, k), c in rows.items():
        if len(texts[d]) < 400:
            assert abs(coverage(wanted[k], texts[d], 4) - c) < 1e-9


def test_repetitive_text_with_a_long_item_stays_small():
    """A worker's memory follows the runs and the words, not the pairs of equal seeds."""
    import tracemalloc

    import pyarrow as pa

    from tallymark.llm import decontamination as D

    items = D.prepare([(1, "x " * 1000)], 4)
    words = D.Words(pa.array(["x " * 30_000], pa.string()))
    tracemalloc.start()
    found = list(D._matches(words, items, 4, 0.6))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(0, 0, 1.0, 1)] and peak < 200 << 20


@pytest.mark.parametrize("pairs", [1, 7, 1 << 20])
def test_runs_of_any_part_size_give_plain_tiling(monkeypatch, pairs):
    import pyarrow as pa

    from tallymark.llm import decontamination as D

    monkeypatch.setattr(D, "PAIRS", pairs)
    pick = random.Random(9)
    for _ in range(150):
        few = [f"v{k}" for k in range(pick.choice((1, 2, 3)))]
        item, doc = pick.choices(few, k=pick.randint(1, 14)), pick.choices(few, k=pick.randint(1, 40))
        items = D.prepare([(0, " ".join(item))], 3)
        found = list(D._matches(D.Words(pa.array([" ".join(doc)], pa.string())), items, 3, 0.01))
        want = coverage(item, doc, 3)
        assert [round(c, 9) for _, _, c, _ in found] == ([round(want, 9)] if want >= 0.01 else [])


def test_equal_items_are_spread_over_blocks(spark, monkeypatch):
    from tallymark.llm import decontamination as D

    monkeypatch.setattr(D, "BLOCK_BYTES", 2000)
    text = " ".join(f"w{k}" for k in range(60))
    bench = spark.createDataFrame([(k, text) for k in range(40)], "item_id long, text string")
    sizes = [sum(len(w) for w in block.words) for block in D._blocks(bench, "item_id", "text", 4)]
    assert sum(sizes) == 40 * 60 and max(sizes) <= 60 * (2000 // len(text) + 1)
    docs = spark.createDataFrame([(1, text), (2, "clean")], "doc_id long, text string")
    assert found(docs, bench) == [(1, k, 1.0) for k in sorted(range(40), key=lambda k: str((1, k, 1.0)))]
