"""Fingerprints against published values and a plain version, and buckets made of them."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymark.config import RETAIL
from tallymark.functions.fingerprint import fingerprint, fingerprint_buckets, fingerprints
from tallymark.operators import features

# Published values of the function: from its own checks, and from the manuals of systems that offer it.
PUBLISHED = {
    "test": 8581389452482819506,
    "test" * 8: -4196240717365766262,
    "test" * 64: 3500507768004279527,
    "1footrue": -1541654101129638711,
    "2applefalse": 2794438866806483259,
    "3true": -4880158226897771312,
}
M = (1 << 64) - 1
K = 0xC3A5C85C97CB3127, 0xB492B66FBE98F273, 0x9AE16A3B2F90404F


def plain(s: bytes) -> int:
    """Strings of up to 64 bytes, one at a time in whole numbers."""
    n, k0, k1, k2 = len(s), *K

    def word(at, size=8):
        return int.from_bytes(s[at : at + size], "little")

    def turn(x, bits):
        x &= M
        return (x >> bits | x << (64 - bits)) & M

    def fold(x):
        x &= M
        return x ^ x >> 47

    mul = (k2 + 2 * n) & M

    def pair(u, v):
        a = fold((u ^ v) * mul)
        return fold((v ^ a) * mul) * mul & M

    if n == 0:
        return k2
    if n < 4:
        return fold((s[0] + (s[n // 2] << 8)) * k2 & M ^ (n + (s[-1] << 2)) * k0 & M) * k2 & M
    if n < 8:
        return pair(n + (word(0, 4) << 3) & M, word(n - 4, 4))
    if n <= 16:
        a, b = word(0) + k2 & M, word(n - 8)
        return pair(turn(b, 37) * mul + a & M, (turn(a, 25) + b) * mul & M)
    a, b = word(0) * (k1 if n <= 32 else k2) & M, word(8)
    c, d = word(n - 8) * mul & M, word(n - 16) * k2 & M
    y, rest = turn(a + b, 43) + turn(c, 30) + d & M, a + turn(b + k2, 18) + c & M
    if n <= 32:
        return pair(y, rest)
    z = pair(y, rest)
    e, f = word(16) * mul & M, word(24)
    g, h = (y + word(n - 32)) * mul & M, (z + word(n - 24)) * mul & M
    return pair(turn(e + f, 43) + turn(g, 30) + h & M, e + turn(f + a, 18) + g & M)


def of(texts):
    data = [t.encode() for t in texts]
    raw = np.frombuffer(b"".join(data), np.uint8)
    return fingerprints(raw, np.cumsum([0, *map(len, data)]))


def test_published_values():
    assert of(PUBLISHED).view(np.int64).tolist() == list(PUBLISHED.values())
    assert (of(["Hello", "TensorFlow", "2.x"]) % np.uint64(3)).tolist() == [0, 2, 2]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=64), max_size=12))
def test_short_strings_equal_a_plain_version(texts):
    for text, got in zip(texts, of(texts)):
        if len(text.encode()) <= 64:
            assert int(got) == plain(text.encode())


def test_a_string_has_one_fingerprint_in_any_company():
    texts = ["a" * k for k in range(200)] + ["é" * 70, ""]
    together = of(texts)
    assert len(set(together.tolist())) == 201
    assert all(of([t])[0] == f for t, f in zip(texts, together))


def test_columns(spark):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate([*PUBLISHED, None])], "k int, t string").repartition(3)
    got = {r.k: r.f for r in rows.select("k", fingerprint(F.col("t")).alias("f")).collect()}
    assert [got[k] for k in range(6)] == list(PUBLISHED.values()) and got[6] == plain(b"") - (1 << 64)
    lists = spark.createDataFrame([(1, ["Hello", "2.x"]), (2, []), (3, None), (4, ["Hello"] * 9)], "k int, g array<string>")
    found = {r.k: r.b for r in lists.select("k", fingerprint_buckets(F.col("g"), 3, 4).alias("b")).collect()}
    assert found == {1: [0, 2, 0, 0], 2: [0] * 4, 3: [0] * 4, 4: [0] * 4}


@pytest.mark.parametrize("kind", ["md5", "fingerprint"])
def test_features_take_the_configured_hash(spark, kind):
    config = RETAIL.with_values(bucket_hash=kind)
    rows = spark.createDataFrame(
        [("Gas bill GAS", 1.0, "debit", ""), ("!!", 2.0, "debit", "")],
        "description string, amount double, transaction_type string, internal_transaction string",
    )
    made = features.features(rows, config, features.fixed_limits(0.0, 2.0)).collect()
    first = made[0].preprocessed_description
    assert len(first) == 60 and first[0] == first[2] and sum(b != 0 for b in first) == 5
    assert made[1].preprocessed_description == [0] * 60
    if kind == "fingerprint":
        assert first[:5] == [plain(g.encode()) % 600_000 for g in ("gas", "bill", "gas", "gas bill", "bill gas")]
