"""The pipeline stage by stage against brute force, on the test table with planted documents."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallymark.llm.q_tokens import vocabulary
from tallymark.staging import stage
from test_decontamination import coverage
from test_decontamination import words_of
from test_minhash import brute
from test_substring import runs_of


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    pick = random.Random(3)
    words = [w for t in texts[:50] for w in t.split()]
    passage = " ".join(pick.choices(words, k=60))
    item = spark.read.parquet(f"{folder}/benchmark.parquet").first().text
    planted = [
        (10**6, None), (10**6 + 1, "12 %% 34"), (10**6 + 2, texts[3]),
        (10**6 + 3, " ".join(pick.choices(words, k=80)) + " " + passage),
        (10**6 + 4, passage + " " + " ".join(pick.choices(words, k=70))),
        (10**6 + 5, " ".join(pick.choices(words, k=50)) + " " + item), (10**6 + 6, ""),
    ]
    rows = [(k, t, None, "planted", len(t or "")) for k, t in planted]
    docs = docs.union(spark.createDataFrame(rows, docs.schema))
    out = [docs.collect()]
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        result = function(spark, docs, folder)
        if k < 4:
            assert result.columns == docs.columns
        result.write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
        out.append(docs.collect())
    return out, passage


def test_language_rejects_only_what_has_no_language(stages):
    before, after = stages[0][0], stages[0][1]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert gone == {10**6, 10**6 + 1, 10**6 + 6}


def test_one_document_of_each_group_stays(stages):
    before, after = stages[0][1], stages[0][2]
    kept = {d for d, _, _, keep in brute([(r.doc_id, r.text) for r in before], 80) if keep}
    assert {r.doc_id for r in after} == kept and len(after) == len(kept) < len(before)
    assert 10**6 + 2 not in kept


def test_passages_are_cut_from_later_documents(stages):
    (_, _, before, after, *_), passage = stages[0], stages[1]
    texts = {r.doc_id: r.text for r in after}
    assert texts.keys() == {r.doc_id for r in before}
    inside = runs_of(words_of(passage), 25)
    assert runs_of(words_of(texts[10**6 + 3]), 25) & inside
    assert not runs_of(words_of(texts[10**6 + 4]), 25) & inside
    holders = {}
    for r in before:
        for run in runs_of(words_of(r.text), 25):
            holders.setdefault(run, set()).add(r.doc_id)
    for r in before:
        repeated = any(len(holders[x]) > 1 for x in runs_of(words_of(r.text), 25))
        assert texts[r.doc_id] == r.text or repeated
        assert len(words_of(texts[r.doc_id])) <= len(words_of(r.text))
    assert all(r.n_chars == len(r.text) for r in after)
    wide = {}
    for r in after:
        for run in runs_of(words_of(r.text), 51):
            wide.setdefault(run, set()).add(r.doc_id)
    assert all(len(d) == 1 for d in wide.values())


def test_benchmark_documents_go(spark, folder, stages):
    before, after = stages[0][3], stages[0][4]
    items = [words_of(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in after}
    assert 10**6 + 5 not in kept
    for r in before:
        words = words_of(r.text)
        near = [i for i in items if len(runs_of(i, 4) & runs_of(words, 4)) * 8 >= len(i)]
        held = any(coverage(i, words, 4) >= 0.6 for i in near)
        assert (r.doc_id in kept) == (not held)


def test_tokens_give_the_text_back(stages):
    library = Tokenizer.from_file(vocabulary())
    before = {r.doc_id: r.text for r in stages[0][4]}
    for r in stages[0][5]:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.text == before[r.doc_id] and r.n_tokens == len(ids)
        assert ids == library.encode(r.text, add_special_tokens=False).ids


def test_run_equals_its_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs.count()
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, folder), name)
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == docs.columns
    assert set(out.columns) == {"doc_id", "text", "lang", "source", "n_chars", "n_tokens", "ids"}
    want, got = ({(r.doc_id, r.text, r.n_tokens, bytes(r.ids)) for r in df.collect()} for df in (docs, out))
    assert got == want and len(got) == out.count() > 0.5 * before


def test_clashing_names(spark, folder):
    """Columns that are named like those the stages use inside, or hold dots, come out as they went in."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id % 3 = 0")
    docs = docs.union(docs.limit(5))
    names = ["__text", "__ID", "__mark", "__stays", "__doc", "__spans", "a.b", "cls", "digest", "N_TOKENS", "Ids"]
    odd = docs.select("*", *[F.concat(F.lit(f"{n}="), F.col("doc_id")).alias(n) for n in names])
    plain = docs
    for name, function in corpus_pipeline.STAGES:
        odd, plain = (stage(function(spark, df, folder), name) for df in (odd, plain))
    assert {r.doc_id: (r.text, r.n_tokens) for r in odd.collect()} == {r.doc_id: (r.text, r.n_tokens) for r in plain.collect()}
    assert odd.columns == [*docs.columns, *names[:-2], "n_tokens", "ids"]
    for r in odd.collect():
        values = dict(zip(odd.columns, r))
        assert all(values[n] == f"{n}={r.doc_id}" for n in names[:-2])


def test_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, folder)
    assert docs.count() == 0
