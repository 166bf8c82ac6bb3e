"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set is its distinct shingles, each a 64-bit hash; its sketch is the k least values.

1. Documents with the same set (by a 128-bit digest) form one class; from here on a class counts
   once, so a group of copies of any size costs one row per task.
2. Retained values form inverted lists. Two sets of a similarity t or more share at least `need`
   retained values (all but one in 10**9 such pairs; sets of up to k shingles: certainly). With
   rare values first, sharing that many means sharing one among the first `size - need + 1`, so
   only those are listed. A value that a third of all documents hold is listed only for documents
   whose sketches consist largely of such values: near copies of each other.
3. A list is not expanded into its pairs. The class whose values are the most frequent meets every
   member: the union sketch of the two estimates their similarity and, if it may reach t, the full
   sets decide. Links merge components; a list with one component left is done.
4. What is left are classes that share values with others of another component. Among these the full
   sets are listed in the same way, now exactly: rare values first, a pair with a similarity of t
   shares one among the first `n - ceil(t n) + 1` of both, and the positions of the first shared
   value bound their overlap from above. Lists are cut into bands of set size: a class resides in
   the band of its size if its position allows a partner as long as itself, and visits the bands of
   the shorter partners that its position allows. In rounds a few residents of each list meet its
   visitors of other components, and then leave; their number grows thirtyfold by round. No pair that
   may link is left untried.
5. Before two sets are fetched, their parity maps are compared: each value flips one of 512 bits, so
   the bits in which two maps differ are at most the values that only one set has. Pairs that differ
   in more bits than the similarity allows are no links, whatever their sketches say.
6. Components of classes give those of documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.batches import Words, fresh, list_array, map_arrow, sliced, text_array
from tallymark.llm.graph import components, measured, staged
from tallymark.llm.hashing import mix, shingle_hashes
from tallymark.staging import discard

SKETCH = 48
MISSES = 1e-9
MOST_MARKS = 1_000_000
_NO_ID = -(1 << 63)


def shared_at_least(size: int, percent: int) -> int:
    """The most values that two sketches of `size` share with a probability of 1 - MISSES or more,
    where each value is shared with a probability of percent / 100."""
    t, tail = percent / 100, 0.0
    for n in range(size + 1):
        tail += comb(size, n) * t**n * (1 - t) ** (size - n)
        if tail > MISSES:
            return n
    return size


def shingle_sets(texts: pa.StringArray, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(texts)
    shingles = shingle_hashes(words.hashes, size)
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if high - low >= size:
            yield np.unique(shingles[low : high - size + 1])
        elif high > low:
            whole = words.hashes[low:high].tobytes()
            digest = hashlib.blake2b(whole, digest_size=8).digest()
            yield mix(np.frombuffer(digest, np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def _lists(sets: list[np.ndarray]) -> pa.ListArray:
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return list_array(values.view(np.int64), lengths, pa.int64())


_WORDS = 8


def parity(values: np.ndarray) -> np.ndarray:
    """512 bits, each the parity of the number of values whose top nine bits are its place."""
    odd = np.bincount((values >> np.uint64(55)).astype(np.int64), minlength=64 * _WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def sketches(docs: DataFrame, size: int, keep: int | None) -> DataFrame:
    """doc_id, n (set size), key (digest of the set, null if empty), bits (parity map), vals (the
    `keep` least values of the set, or the whole set), and mark if `docs` has it.
    `docs`: doc_id, text, mark (binary, may be missing)."""
    marked = len(docs.columns) > 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, 1):
                sets = list(shingle_sets(text_array(batch.column(1)), size))
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        list_array(
                            np.concatenate([parity(s) for s in sets]), np.full(len(sets), _WORDS), pa.int64()
                        ),
                        _lists([s[:keep] for s in sets]), *batch.columns[2:],
                    ],
                    names=["doc_id", "n", "key", "bits", "vals", *["mark"] * marked],
                )

    return map_arrow(
        docs, run, "doc_id long, n long, key binary, bits array<bigint>, vals array<bigint>" + ", mark binary" * marked
    )


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    values = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(values, ends[:-1]) if len(ends) else []


def _pairs_by(df: DataFrame, decide) -> DataFrame:
    """Rows (a, b, ca, cb, na, nb, va, vb) -> the (a, b, ca, cb) for which decide(na, nb, va, vb)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(
                batch.column(4).to_pylist(), batch.column(5).to_pylist(),
                _arrays(batch.column(6)), _arrays(batch.column(7)),
            )
            yes = pa.array([bool(decide(*row)) for row in rows], pa.bool_())
            yield batch.select(["a", "b", "ca", "cb"]).filter(yes)

    wanted = df.select("a", "b", "ca", "cb", "na", "nb", "va", "vb")
    return map_arrow(wanted, run, "a long, b long, ca long, cb long")


def _estimate(size: int, percent: int):
    need = shared_at_least(size, percent)

    def may_link(na, nb, va, vb) -> bool:
        union = np.union1d(va, vb)
        if na + nb <= size or len(union) < size:
            return 100 * len(np.intersect1d(va, vb, assume_unique=True)) >= percent * len(union)
        top = union[size - 1]
        both = np.intersect1d(va[va <= top], vb[vb <= top], assume_unique=True)
        return len(both) >= need

    return may_link


def _confirm(percent: int):
    def linked(na, nb, va, vb) -> bool:
        shared = len(np.intersect1d(va, vb, assume_unique=True))
        return 100 * shared >= percent * (na + nb - shared)

    return linked


def _in_order(sets: DataFrame) -> DataFrame:
    """cls, order (frequency and value of those that several classes have, rare first), weight, n, bits."""
    values = sets.select("cls", F.explode("vals").alias("value"))
    shared = values.groupBy("value").agg(F.count("*").alias("df")).filter("df >= 2")
    return values.join(shared, "value").groupBy("cls").agg(
        F.sort_array(F.collect_list(F.struct("df", "value"))).alias("order"), F.avg("df").alias("weight")
    ).join(sets.select("cls", "n", "bits"), "cls")


def _sketch_lists(classes: DataFrame, size: int, percent: int) -> DataFrame:
    """value, cls, n, weight, bits: each class under the rarest of its retained values."""
    need = F.least(
        F.lit(shared_at_least(size, percent)), F.ceil(F.col("n") * percent / 100).cast("int")
    )
    # values of one class only would come first and meet nobody
    rare = _in_order(classes).withColumn("take", F.size("order") - need + 1).filter("take > 0")
    return rare.select(
        F.explode(F.slice("order", F.lit(1), F.col("take"))).alias("x"), "cls", "n", "weight", "bits"
    ).select("x.value", "cls", "n", "weight", "bits")


_BAND = 0.02


def _set_lists(sets: DataFrame, percent: int) -> DataFrame:
    """value, band, resident, cls, n, place, weight, bits: residents and visitors of exact lists."""
    most = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    unique = F.col("n") - F.size("order")
    taken = F.greatest(F.lit(0), F.least(F.size("order"), (most - unique).cast("int")))
    listed = _in_order(sets).withColumn("unique", unique).withColumn("take", taken).filter("take > 0")
    rows = listed.select(
        F.posexplode(F.slice("order", F.lit(1), F.col("take"))).alias("k", "x"), "cls", "n", "weight", "unique",
        "bits",
    ).select("x.value", "cls", "n", "weight", "bits", (F.col("unique") + F.col("k") + 1).alias("place"))

    def band(n):
        return F.floor(F.log(n) / F.log(F.lit(1 + _BAND)) + 1e-9)

    low = F.ceil(F.col("n") * percent / 100)
    high = F.least(
        F.col("n"), F.floor((F.col("n") - F.col("place") + 1) * (100 + percent) / percent) - F.col("n")
    )
    # as the shorter of two, it shares at least 2t / (1 + t) of its own values
    alone = F.col("n") - F.col("place") + 1 >= F.ceil(F.col("n") * 2 * percent / (100 + percent))
    residents = rows.filter(alone).withColumn("band", band(F.col("n"))).withColumn("resident", F.lit(True))
    visitors = rows.filter(high >= low).withColumn(
        "band", F.explode(F.sequence(band(low), band(high)))
    ).withColumn("resident", F.lit(False))
    return residents.unionByName(visitors)


def _with_values(pairs: DataFrame, values: DataFrame) -> DataFrame:
    left = values.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("vals").alias("va"))
    right = values.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("vals").alias("vb"))
    return pairs.join(right, "b").join(left, "a")


def _overlap(percent: int) -> Column:
    """The least overlap of sets of sizes na and nb with the similarity."""
    return F.ceil((F.col("na") + F.col("nb")) * percent / (100 + percent))


def _may_fit(percent: int) -> Column:
    """Sizes na, nb and parity maps ba, bb allow the similarity."""
    differ = sum(
        (F.bit_count(F.get("ba", F.lit(k)).bitwiseXOR(F.get("bb", F.lit(k)))) for k in range(_WORDS)), F.lit(0)
    )
    return (
        (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)
        & (differ <= F.col("na") + F.col("nb") - 2 * _overlap(percent))
    )


def _mixed(lists: DataFrame, comps: DataFrame, keys: list[str]) -> DataFrame:
    """The lists that hold several components, each row with its component."""
    rows = lists.join(comps, "cls")
    mixed = rows.groupBy(keys).agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    return rows.join(mixed.filter("low != high").select(keys), keys)


def _pairs(members: DataFrame, leaders: DataFrame, keys: list[str], fits: Column) -> DataFrame:
    """(a, b, ca, cb), a < b: leaders (a) with the members (b) of their lists that they may fit."""
    met = members.join(leaders, keys).filter((F.col("ca") != F.col("cb")) & fits)
    swap = F.col("a") > F.col("b")
    return met.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
        F.when(swap, F.col("cb")).otherwise(F.col("ca")).alias("ca"),
        F.when(swap, F.col("ca")).otherwise(F.col("cb")).alias("cb"),
    ).distinct()


def _merge(comps: DataFrame, links: DataFrame) -> DataFrame:
    merged = components(links.select(F.col("ca").alias("u"), F.col("cb").alias("v")))
    merged = merged.select(F.col("vertex").alias("comp"), F.col("component").alias("new"))
    out = staged(
        comps.join(merged, "comp", "left").select("cls", F.coalesce("new", "comp").alias("comp")), "comps"
    )
    discard(comps, links)
    return out


def _by_sketches(classes: DataFrame, sets: DataFrame, lists: DataFrame, keep: int, percent: int) -> DataFrame:
    """(cls, comp) after the leader of each list has met its members. `lists` stay."""
    first = F.min(F.struct(-F.col("weight"), "cls", "n", "bits")).alias("lead")
    leaders = lists.groupBy("value").agg(first).select(
        "value", F.col("lead.cls").alias("a"), F.col("lead.cls").alias("ca"), F.col("lead.n").alias("na"),
        F.col("lead.bits").alias("ba"),
    )
    members = lists.select(
        "value", F.col("cls").alias("b"), F.col("cls").alias("cb"), F.col("n").alias("nb"),
        F.col("bits").alias("bb"),
    )
    pairs = _pairs(members, leaders, ["value"], _may_fit(percent))
    maybe = staged(_pairs_by(_with_values(pairs, classes), _estimate(keep, percent)), "pairs")
    links = staged(_pairs_by(_with_values(maybe, sets), _confirm(percent)), "links")
    discard(maybe)
    comps = staged(lists.select("cls").distinct().withColumn("comp", F.col("cls")), "comps")
    return _merge(comps, links)


def _by_sets(sets: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """(cls, comp) after all pairs of `sets` that may link have been tried."""
    keys = ["value", "band"]
    lists, slots = staged(_set_lists(sets, percent), "lists"), 32
    used = [lists]
    left = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    while True:
        lists = staged(_mixed(lists.drop("comp"), comps, keys), "lists")
        discard(*used)
        if lists.isEmpty():
            return comps
        slot = F.pmod(F.xxhash64("cls", F.lit(slots)), F.lit(slots)).alias("slot")
        first = F.min(F.struct(-F.col("weight"), "cls", "comp", "n", "place", "bits")).alias("lead")
        leaders = staged(
            lists.filter("resident").groupBy(*keys, slot).agg(first).select(
                *keys, F.col("lead.cls").alias("a"), F.col("lead.comp").alias("ca"),
                F.col("lead.n").alias("na"), F.col("lead.place").alias("pa"),
                F.col("lead.bits").alias("ba"),
            ),
            "leaders",
        )
        visitors = lists.filter("not resident").select(
            *keys, F.col("cls").alias("b"), F.col("comp").alias("cb"), F.col("n").alias("nb"),
            F.col("place").alias("pb"), F.col("bits").alias("bb"),
        )
        pairs = _pairs(visitors, leaders, keys, _may_fit(percent) & (left + 1 >= _overlap(percent)))
        links = staged(_pairs_by(_with_values(pairs, sets), _confirm(percent)), "links")
        used = [lists, leaders]
        met = leaders.select(*keys, F.col("a").alias("cls"), F.lit(True).alias("resident"))
        lists = lists.join(met, [*keys, "cls", "resident"], "left_anti")
        # a list without residents is done
        lists = lists.join(lists.filter("resident").select(keys).distinct(), keys, "left_semi")
        if not links.isEmpty():
            comps = _merge(comps, links)
        else:
            discard(links)
        slots *= 32


def _linked_classes(docs: DataFrame, classes: DataFrame, keep: int, size: int, percent: int) -> DataFrame:
    """(cls, comp) of every class that has a link or was a candidate for one."""
    lists = staged(_sketch_lists(classes, keep, percent), "lists")
    members = staged(
        classes.join(lists.select("cls").distinct(), "cls", "left_semi").select("cls", "key", "doc", "n", "bits", "vals"),
        "members",
    )
    wanted = measured(members.select(F.coalesce("doc", F.lit(_NO_ID)).alias("doc")).distinct(), "wanted")
    # a document is read again only if its class is in a list; the digest picks the right row
    again = docs.join(wanted, F.coalesce("doc_id", F.lit(_NO_ID)) == F.col("doc"), "left_semi")
    sets = staged(
        sketches(again, size, None).join(members.select("cls", "key"), "key")
        .select("cls", "n", "bits", "vals").dropDuplicates(["cls"]),
        "sets",
    )
    comps = _by_sketches(members.select("cls", "n", "vals"), sets, lists, keep, percent)
    open_ = _mixed(lists, comps, ["value"]).select("cls").distinct()
    left = staged(sets.join(open_, "cls", "left_semi"), "open")
    discard(lists, members, sets)
    comps = _by_sets(left, comps, percent)
    discard(left)
    return comps


def _grouped(docs: DataFrame, percent: int, size: int, keep: int) -> tuple[DataFrame, DataFrame]:
    """The set sizes and digests of all rows, and (key, doc, comp): the classes of equal sets, their
    least id and their component."""
    rows = staged(sketches(docs, size, keep), "sketches")
    classes = staged(
        rows.filter(F.col("key").isNotNull()).groupBy("key")
        .agg(
            F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("bits").alias("bits"),
            F.first("vals").alias("vals"),
        )
        .withColumn("cls", F.monotonically_increasing_id()),
        "classes",
    )
    keys, names = staged(rows.drop("vals", "bits"), "keys"), staged(classes.select("cls", "key", "doc"), "names")
    discard(rows)
    comps = _linked_classes(docs.select("doc_id", "text"), classes, keep, size, percent)
    discard(classes)
    comp = F.coalesce("comp", "cls")
    return keys, names.join(comps, "cls", "left").withColumn("comp", comp)


def near_duplicates(
    df: DataFrame, percent: int = 80, size: int = 5, keep: int = SKETCH, doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `df`.

    Two documents are linked if 100 * |A and B| >= percent * |A or B| of their sets of `size`-word
    shingles (fewer words: one shingle of all). component_id is the least doc_id reachable over
    links, kept says that it is the row's own. Null or wordless texts have n_shingles 0 and are
    their own component. Rows that repeat a doc_id are judged by their own texts; a null doc_id
    takes part and gets its group's least id, or null. Other columns are not read.
    """
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows, named = _grouped(docs, percent, size, keep)
    least = named.groupBy("comp").agg(F.min("doc").alias("component_id"))
    by_key = named.join(least, "comp").select("key", "component_id")
    return (
        rows.select("doc_id", F.col("n").alias("n_shingles"), "key").join(by_key, "key", "left")
        .withColumn(
            "component_id",
            F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")),
        )
        .select(
            "doc_id", "n_shingles", "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )


def distinct_documents(df: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near-duplicates in `df`: that with the least id, null ids last.

    Rows are judged one by one, by id and text: those that share an id, or have none, leave only
    with their own group. Of rows equal in both one stays. Null or wordless texts all stay.
    """
    number, mark = F.col(doc_id).cast("long"), F.unhex(F.md5(F.col(text)))
    docs = df.select(number.alias("doc_id"), F.col(text).alias("text"), mark.alias("mark"))
    rows, named = _grouped(docs, percent, 5, SKETCH)
    rows = rows.filter(F.col("key").isNotNull()).select(
        "key", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark").alias("row")
    )
    named = named.join(rows.groupBy("key").agg(F.min("row").alias("own")), "key").select("key", "comp", "own")
    best = named.groupBy("comp").agg(F.min("own").alias("best"))
    judged = rows.join(named.join(best, "comp").select("key", "best"), "key").groupBy("row").agg(
        F.count("*").alias("n"), F.first(F.col("row") == F.col("best")).alias("stays")
    )
    own_id, own_mark, stays = fresh(df, "__id", "__mark", "__stays")
    marks = measured(
        judged.filter("not stays or n > 1").select(
            F.col("row.doc_id").alias(own_id), F.col("row.mark").alias(own_mark), F.col("stays").alias(stays)
        ),
        "marks", MOST_MARKS,
    )
    same = number.eqNullSafe(F.col(own_id)) & (mark == F.col(own_mark))
    left = df.join(marks, same, "left_anti")
    if marks.filter(stays).isEmpty():
        return left
    copies = df.join(marks.filter(stays), same).dropDuplicates([own_id, own_mark])
    return left.unionByName(copies.select([F.col(f"`{c}`") for c in df.columns]))
