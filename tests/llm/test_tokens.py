"""Encoding, token files and counts against the tokenizers library on whole texts."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallymark.llm import bpe, token_store
from tallymark.llm.library import Library
from tallymark.llm.q_tokens import op1, op2, op4, vocabulary
from tallymark.llm.token_counts import Counter, count_tokens

SIGNS = [
    *"abcdefgs tdlmrv''''   \n\t\r  ", "'s", "'re", "'ll", "　", "é", "ß", "½", "²", "Ⅷ", "中", "한",
    "́", "😀", "<|endoftext|>", "<|endo", "\x1c", "\x85", "​", "_", "-", "1", "23", "İ",
    "\U0001d400", "\xa0",
]


def texts():
    pick = random.Random(7)
    some = ["".join(pick.choices(SIGNS, k=pick.randint(0, 60))) for _ in range(3000)]
    return some + ["x" * 3000 + " " + "ab" * 300, "", " ", "\n\n", "<|endoftext|>", "a" * 65, "é" * 40]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_rank_array_equals_the_library(library):
    own = bpe.Vocabulary(bpe.read_vocabulary(vocabulary()))
    table = bpe.WordTable(own.encode_words, most=500)  # forgets again and again
    for start in range(0, 3000, 250):
        some = texts()[start : start + 250] + texts()[3000:]
        flat, lengths = table.encode(some, tuple(own.specials))
        wanted = [ids_of(library, t) for t in some]
        assert lengths.tolist() == [len(w) for w in wanted]
        assert flat.tolist() == [i for w in wanted for i in w]
        joined, ends = own.decode(flat, lengths)
        assert joined.tobytes().decode() == "".join(some)


def test_long_words_by_heap_equal_the_matrix():
    own = bpe.Vocabulary(bpe.read_vocabulary(vocabulary()))
    pick = random.Random(3)
    words = ["".join(pick.choices("abcdeth", k=60)) for _ in range(200)]
    flat, lengths = own.encode_words(words)
    assert flat.tolist() == [i for w in words for i in own._alone(w.encode()).tolist()]


@pytest.mark.parametrize("chunk,overlap", [(64, 24), (40, 39), (200, 30)])
def test_spliced_counts_equal_whole_texts(library, chunk, overlap):
    counter = Counter(Library(bpe.read_vocabulary(vocabulary())), chunk, overlap)
    pick = random.Random(5)
    long = ["".join(pick.choices(texts(), k=pick.randint(1, 60))) for _ in range(60)]
    long += ["x" * 3000, " " * 3000 + "a", "<|endoftext|>" * 90, "", "it's " * 200]
    assert counter.count(long).tolist() == [len(ids_of(library, t)) for t in long]
    assert counter.widened > 0


@pytest.mark.parametrize("width", [1, 5, 8, 13, 16, 17, 31, 32])
def test_bits_round_trip_and_random_access(width):
    pick = np.random.default_rng(width)
    for n in (0, 1, 63, 64, 65, 1000):
        ids = pick.integers(0, 1 << width, n, dtype=np.uint64)
        payload = token_store.pack(ids, width, block=128)
        assert token_store.unpack(payload).tolist() == ids.tolist()
        for first, last in ((0, 1), (n // 3, n // 2), (127, 129), (n - 1, n)):
            assert token_store.unpack(payload, max(first, 0), last).tolist() == ids[max(first, 0) : max(last, 0)].tolist()
    with pytest.raises(ValueError):
        token_store.pack(np.array([2], np.uint64), 1)


ROWS = [
    (3, "Hello  world's end\n", "x", 1), (1, None, None, None), (None, "null id", "en", 5), (2, "", "y", 0),
    (3, "Hello  world's end\n", "x", 1), (9, "<|endoftext|> and\t" * 900, "z", 2), (3, "other", "y", 4),
]
SCHEMA = "doc_id long, text string, ids string, n_tokens int"


def digest(ids):
    return hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_encode_and_decode_odd_rows(spark, library):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = bpe.decode(bpe.encode(df, vocabulary()), vocabulary()).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in out) == sorted((r[0] or 0, r[1] or "") for r in ROWS)
    for r in out:
        assert np.frombuffer(r.ids, "<u4").tolist() == ids_of(library, r.text)
    both = bpe.encode(df, vocabulary(), decoded="n_tokens").select("ids", "n_tokens")
    assert sorted((bytes(r.ids), r.n_tokens) for r in both.collect()) == sorted((bytes(r.ids), r.decoded) for r in out)
    assert bpe.encode(df.limit(0), vocabulary()).count() == 0
    assert bpe.decode(df.limit(0).withColumn("ids", df.text.cast("binary")), vocabulary()).count() == 0


def test_counts_of_odd_rows(spark, library):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = count_tokens(df, vocabulary(), chunk=100, overlap=30).collect()
    assert len(out) == len(ROWS)
    for r in out:
        n = len(ids_of(library, r.text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 1024)
    assert count_tokens(df.limit(0), vocabulary()).count() == 0


def test_store_of_odd_rows(spark, library, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    token_store.write(df, f"{tmp_path}/a", vocabulary(), segment_ids=8)
    rows = token_store.read(spark, f"{tmp_path}/a").orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 3, 3, 9]
    start = 0
    texts_of = {}
    for r in ROWS:
        texts_of.setdefault(r[0], []).append([*ids_of(library, r[1]), 2])
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids in texts_of[r.doc_id] and r.start == start and r.n_tokens == len(ids)
        start += len(ids)
    some = token_store.read(spark, f"{tmp_path}/a", [9, 2]).collect()
    assert sorted(r.doc_id for r in some) == [2, 9]
    assert {r.doc_id: r.ids for r in some} == {r.doc_id: r.ids for r in rows if r.doc_id in (2, 9)}
    token_store.write(df.limit(0), f"{tmp_path}/b", vocabulary())
    assert token_store.read(spark, f"{tmp_path}/b").count() == 0


def test_queries_equal_the_library(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    ids = {d.doc_id: ids_of(library, d.text) for d in docs}
    text = {d.doc_id: d.text or "" for d in docs}
    for r in op1(spark, folder).collect():
        assert (r.n_tokens, r.ids_sha256) == (len(ids[r.doc_id]), digest(ids[r.doc_id]))
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
    counts = {r.doc_id: r for r in op4(spark, folder).collect()}
    assert {d: r.n_tokens for d, r in counts.items()} == {d: len(i) for d, i in ids.items()}
    assert all(r.n_bytes == len(text[d].encode()) for d, r in counts.items())
    start = 0
    for r in op2(spark, folder).orderBy("doc_id").collect():
        own = [*ids[r.doc_id], 2]
        crc = zlib.crc32(np.array(own, "<u4").tobytes())
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(own), crc)
        start += len(own)
