"""Language predictions: held-out accuracy, backoff against a plain version, odd rows."""

import math
import random
import zlib

import numpy as np
import pytest

from tallymark.llm import language_id
from tallymark.llm.language_id import ORDERS, Scorer, fit, predict
from tallymark.llm.letters import LetterWords
from tallymark.llm.q_filters import op10

WORDS = {"aa": ["der", "und", "ist", "nicht", "größe"], "bb": ["the", "and", "of", "is", "house"], "cc": ["el", "la", "año", "que"]}


def docs(spark, n=60):
    pick = random.Random(1)
    rows = []
    for k in range(n):
        lang = pick.choice(sorted(WORDS))
        rows.append((k, " ".join(pick.choices(WORDS[lang], k=30)), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_backoff_equals_a_plain_version(spark):
    df = docs(spark)
    model = fit(df)
    assert model.languages == ["aa", "bb", "cc"]
    counts = [{} for _ in range(ORDERS + 1)]
    for r in df.collect():
        for word in r.text.lower().split():
            grams = {0: [word]}
            padded = f" {word} "
            for n in range(1, ORDERS + 1):
                grams[n] = [g for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) != " "]
            for n, some in grams.items():
                for g in some:
                    counts[n].setdefault(g, dict.fromkeys(model.languages, 0))[r.lang] += 1
    totals = [{x: sum(c[x] for c in some.values()) for x in model.languages} for some in counts]

    def logs(n, g):
        return [math.log(max(counts[n][g][x], 0.5) / totals[n][x]) for x in model.languages]

    def plain(text):
        sums = np.zeros(3)
        for word in text.lower().split():
            if word in counts[0]:
                sums += logs(0, word)
                continue
            padded = f" {word} "
            for n in range(ORDERS, 0, -1):
                known = [g for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) != " " and g in counts[n]]
                if known:
                    sums += np.mean([logs(n, g) for g in known], 0)
                    break
        e = np.exp(sums - sums.max())
        return e.max() / e.sum(), model.languages[int(sums.argmax())]

    texts = ["der house", "undista", "größer zzz", "theand x", "xyz", "queso el", "Ñ", "AÑO nichts"]
    names, score, _ = Scorer(model).predict(texts)
    for t, name, s in zip(texts, names, score):
        wanted, lang = plain(t)
        assert lang == name and abs(wanted - s) < 1e-9


def test_odd_rows(spark):
    model = fit(docs(spark))
    rows = [(1, None, "aa", 1.0), (2, "", "zz", 2.0), (3, "12 34 !?", None, 3.0), (4, "und " * 20000, "bb", 4.0), (4, "und", "bb", 4.0), (None, "the 中", None, 5.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    out = predict(df, model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = sorted(((r.text or "")[:3], r.lang_pred) for r in out.collect())
    assert got == sorted([("", "und"), ("", "und"), ("12 ", "und"), ("und", "aa"), ("und", "aa"), ("the", "bb")])
    assert all(0 <= r.score <= 1 for r in out.collect())
    nothing = fit(df.limit(0))
    assert nothing.languages == [] and {r.lang_pred for r in predict(df, nothing).collect()} == {"und"}
    assert predict(df.limit(0), model).count() == 0
    assert fit(df.filter("lang is null")).languages == []


def test_words_of_letters():
    words = LetterWords(["It's É1", "", "Straße", "x"])
    got = ["".join(map(chr, words.codes[s:e])) for s, e in zip(words.starts, words.ends)]
    assert got == ["it", "s", "é", "straße", "x"] and words.text.tolist() == [0, 0, 0, 2, 3]


def test_query_is_right_on_held_out_documents(spark, folder):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op10(spark, folder).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_null_and_repeated_ids_are_drawn_by_their_texts(spark):
    pick = random.Random(7)
    rows = [
        (None if k % 2 else 5, " ".join(pick.choices(WORDS["aa" if k % 3 else "bb"], k=20)) + f" w{k}", "aa" if k % 3 else "bb")
        for k in range(400)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit(df, per_language=40)
    got = predict(df, model).collect()
    assert sum(r.lang_pred == r.lang for r in got) == 400
    seen = []
    real = language_id._counts
    try:
        language_id._counts = lambda sample: seen.append(sample.count()) or real(sample)
        fit(df, per_language=40)
        assert 40 <= seen[-1] <= 130  # 80 in the mean
        copies = df.limit(1).union(df.limit(1)).union(df)
        for _ in range(4):
            copies = copies.union(copies.limit(1))
        fit(copies, per_language=10_000)
        assert seen[-1] == 400  # equal rows count once
    finally:
        language_id._counts = real


def test_known_keys_have_their_counts_in_every_language(spark):
    rows = [(1, "alpha alpha alpha beta beta gamma", "aa"), (2, "delta delta delta beta gamma gamma", "bb")]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), words=1)
    words = LetterWords(["alpha", "beta", "delta"]).hashes
    known = dict(zip(model.keys[0].tolist(), model.logs[0].tolist()))
    assert sorted(known) == sorted(words[[0, 2]].tolist())
    assert known[int(words[0])] == pytest.approx([math.log(3 / 6), math.log(0.5 / 6)])
    model = fit(spark.createDataFrame([*rows, (3, "beta beta beta beta", "bb")], "doc_id long, text string, lang string"), words=1)
    known = dict(zip(model.keys[0].tolist(), model.logs[0].tolist()))
    assert known[int(words[1])] == pytest.approx([math.log(2 / 6), math.log(5 / 10)])


def test_texts_of_which_nothing_is_known_are_not_recognised(spark):
    df = docs(spark)
    model = fit(df)
    odd = spark.createDataFrame(
        [(1, "中文 文字", None), (2, "42 !!", None), (3, None, None), (4, "中文 und", None), (5, "größer", None)],
        df.schema,
    )
    assert sorted(r.doc_id for r in language_id.recognised(odd, model).collect()) == [4, 5]
    assert language_id.recognised(df, model).count() == df.count()
    assert {r.lang_pred for r in predict(odd.filter("doc_id = 1"), model).collect()} == {"aa"}
