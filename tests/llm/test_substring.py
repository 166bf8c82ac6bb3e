"""Repeated passages: all long ones found, nothing else reported."""

import random
import re

import pyarrow as pa
import pytest

from tallymark.llm.batches import Words
from tallymark.llm.q_dedup import op6
from tallymark.llm.substring import chunk_starts, remove_repeats, repeats


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def made():
    pick = random.Random(2)
    words = [f"w{k}é" for k in range(2000)]
    passages = [pick.choices(words, k=pick.randint(51, 90)) for _ in range(15)]
    short = [pick.choices(words, k=pick.randint(3, 24)) for _ in range(15)]
    rows, holds = [], {}
    for doc in range(150):
        own = []
        for _ in range(pick.randint(0, 3)):
            k = pick.randrange(15)
            holds.setdefault(k, set()).add(doc)
            own += pick.choices(words, k=pick.randint(0, 40)) + passages[k]
        own += pick.choices(words, k=30)
        if doc % 2:
            own += short[doc % 15] + pick.choices(words, k=5)
        rows.append((doc, pick.choice((" ", "\n", "\t ")).join(own)))
    return rows, passages, holds


def runs_of(words, n):
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}


@pytest.fixture(scope="module")
def found(spark):
    rows, passages, holds = made()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return dict(rows), passages, holds, df, repeats(df).collect()


def test_every_long_repeat_is_found(found):
    texts, passages, holds, _, places = found
    for k, docs in holds.items():
        if len(docs) < 2:
            continue
        inside = runs_of(passages[k], 25)
        for doc in docs:
            mine = [p for p in places if p.doc_id == doc]
            hit = [p for p in mine if runs_of(words_of(texts[doc])[p.start_word : p.start_word + p.n_words], 25) & inside]
            assert hit, (k, doc)
            assert any(p.kept == (doc == min(docs)) for p in hit)


def test_every_place_repeats(found):
    texts, _, _, _, places = found
    assert places
    everywhere = {}
    for doc, text in texts.items():
        for run in runs_of(words_of(text), 25):
            everywhere.setdefault(run, set()).add(doc)
    for p in places:
        words = words_of(texts[p.doc_id])[p.start_word : p.start_word + p.n_words]
        assert len(words) == p.n_words >= 25
        for run in (tuple(words[:25]), tuple(words[-25:])):
            assert len(everywhere[run]) > 1
        assert p.kept == (p.first_doc_id == p.doc_id)


def test_insertions_do_not_move_chunks():
    pick = random.Random(9)
    words = [str(pick.random()) for _ in range(300)]
    a = Words(pa.array([" ".join(words), " ".join(["new", "start", "x"] + words[:150] + ["y"] + words[150:])]))
    cuts = chunk_starts(a)
    first = {words[c] for c in cuts if c < 300}
    texts = ["new", "start", "x"] + words[:150] + ["y"] + words[150:]
    second = {texts[c - 300] for c in cuts if c >= 300}
    assert len(first - second) <= 6 and len(second - first) <= 6


def test_removal_takes_what_repeats(spark, found):
    texts, _, _, df, places = found
    out = {r.doc_id: r.text for r in remove_repeats(df).collect()}
    assert out.keys() == texts.keys()
    for doc, text in texts.items():
        words = words_of(text)
        for p in places:
            if p.doc_id == doc and not p.kept:
                words[p.start_word : p.start_word + p.n_words] = [None] * p.n_words
        assert words_of(out[doc]) == [w for w in words if w is not None]
    again = spark.createDataFrame(list(out.items()), "doc_id long, text string")
    assert repeats(again).filter("not kept").count() == 0


def test_odd_rows(spark):
    long = " ".join(f"a{k}" for k in range(80))
    same = "x " * 20000
    rows = [
        (1, None, "a", 1), (2, "", "b", 2), (3, long, "c", 3), (3, long, "c", 3), (None, "pre " + long, "d", 4),
        (5, "B " + long.upper() + " end", "e", 5), (6, same, "f", 6), (7, same + "y", "g", 7), (8, "short", "h", 8),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string, n_chars int")
    places = repeats(df).collect()
    assert {(p.doc_id, p.kept) for p in places} == {(None, True), (3, False), (5, False), (6, True), (7, False)}
    out = remove_repeats(df, n_chars="n_chars")
    assert out.columns == df.columns
    left = {r.digest: r for r in out.collect()}
    assert left["d"].text == "pre " + long and left["a"].text is None and left["h"].n_chars == 8
    assert left["e"].text.startswith("B ") and left["e"].text.endswith(" end")
    assert left["e"].n_chars == len(left["e"].text) < 60
    assert out.count() == len(rows)
    assert repeats(df.limit(0)).count() == 0 and remove_repeats(df.limit(0)).count() == 0
    once = spark.createDataFrame([(3, long), (3, long), (4, "z")], "doc_id long, text string")
    assert repeats(once).count() == 0


def test_rows_that_share_an_id_or_have_none(spark):
    """Spans meet only the text they were found in, and such rows repeat each other's passages."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(80)) for x in "abc")
    rows = [
        (1, a, "a"), (2, "new start " + a, "b"), (2, "short other text", "c"), (2, None, "d"),
        (2, " ".join(f"z{k}" for k in range(120)), "e"), (None, "one " + b, "f"), (None, "two " + b + " end", "g"),
        (3, c + " x", "h"), (3, c + " y", "i"), (None, "two " + b + " end", "j"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(4)
    left = {r.key: r.text for r in remove_repeats(df).collect()}
    texts = {k: t for _, t, k in rows}
    assert {k for k in "acde" if left[k] == texts[k]} == set("acde")
    assert left["b"].startswith("new start ") and len(words_of(left["b"])) < 25
    for one, other in ("fg", "hi"):
        cut = [k for k in (one, other) if left[k] != texts[k]]
        assert len(cut) == 1 and len(words_of(left[cut[0]])) < 25
    assert left["j"] == left["g"]
    assert {p.doc_id for p in repeats(df).collect()} == {1, 2, 3, None}


def test_query(spark, folder):
    docs = {r.doc_id: words_of(r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    holders = {}
    for doc, words in docs.items():
        for run in runs_of(words, 25):
            holders.setdefault(run, set()).add(doc)
    places = op6(spark, folder).collect()
    spans = {}
    for p in places:
        words = docs[p.doc_id][p.start_word : p.start_word + p.n_words]
        assert len(holders[tuple(words[:25])]) > 1 and len(holders[tuple(words[-25:])]) > 1
        spans.setdefault(p.doc_id, []).append(p)
    wide = {}
    for doc, words in docs.items():
        for run in runs_of(words, 51):
            wide.setdefault(run, set()).add(doc)
    assert {d for docs_ in wide.values() if len(docs_) > 1 for d in docs_} <= spans.keys()
