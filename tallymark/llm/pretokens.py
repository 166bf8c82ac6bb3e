"""Pre-tokens of byte-level BPE vocabularies, found for many texts at once.

The pattern is the one that these vocabularies are published with:
'(s|t|re|ve|m|ll|d) | ?letters | ?digits | ?others | white space, of which the last character is
left to the word behind it. Instead of running a regular expression over each text, characters are
put into four classes by a table and all boundaries of a slice follow from the classes.
"""

from __future__ import annotations

import sys

import numpy as np
import regex

from tallymark.llm.hashing import HashIndex, range_hashes

OTHER, LETTER, DIGIT, BLANK = 0, 1, 2, 3


def _class_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (BLANK, r"\p{White_Space}+")):
        for found in regex.finditer(pattern, every):
            first, last = ord(found[0][0]), ord(found[0][-1])
            if last - first + 1 == len(found[0]):
                table[first : last + 1] = kind
            else:
                table[[ord(c) for c in found[0]]] = kind
    return table


_classes: list[np.ndarray] = []


def class_table() -> np.ndarray:
    if not _classes:
        _classes.append(_class_table())
    return _classes[0]


class PreTokens:
    """Pre-tokens of a slice of texts.

    `text` is all of them joined, `starts` and `ends` are in characters; those of text i are
    first[i]:first[i + 1]. A special string is one pre-token of its own.
    """

    def __init__(self, texts: list[str], specials: tuple[str, ...] = ()):
        self.text = "".join(texts)
        self.codes = np.frombuffer(self.text.encode("utf-32-le"), np.uint32)
        n = len(self.codes)
        self.offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=self.offsets[1:])
        forced = np.zeros(n + 1, bool)
        forced[self.offsets] = True
        spans = self._special_spans(specials, forced)
        for start, end in spans:
            forced[start] = forced[end] = True
        self.starts = np.flatnonzero(self._boundaries(forced)) if n else np.zeros(0, np.int64)
        if spans:
            inside = np.zeros(n, bool)
            for start, end in spans:
                inside[start + 1 : end] = True
            self.starts = self.starts[~inside[self.starts]]
        self.ends = np.append(self.starts[1:], n) if n else self.starts
        self.first = np.searchsorted(self.starts, self.offsets)
        self.hashes = range_hashes(self.codes, self.starts, self.ends)

    def _special_spans(self, specials, forced) -> list[tuple[int, int]]:
        """Leftmost special strings that lie within one text."""
        if not any(s in self.text for s in specials):
            return []
        pattern = "|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True))
        spans, at, search = [], 0, regex.compile(pattern)
        while found := search.search(self.text, at):
            if forced[found.start() + 1 : found.end()].any():
                at = found.start() + 1  # joined by the slice only
            else:
                spans.append(found.span())
                at = found.end()
        return spans

    def _boundaries(self, forced: np.ndarray) -> np.ndarray:
        codes, n = self.codes, len(self.codes)
        kind = class_table()[codes]
        start = np.zeros(n + 2, bool)
        start[:n] = forced[:n]
        start[1:n] |= kind[1:] != kind[:-1]
        # a word behind white space: the last blank is a pre-token, or a space joins the word
        behind = 1 + np.flatnonzero((kind[1:] != BLANK) & (kind[:-1] == BLANK) & ~forced[1:n])
        start[behind - 1] = True
        start[behind[codes[behind - 1] == 32]] = False
        # contractions: a lone apostrophe that starts a pre-token, and letters behind it
        lone = np.flatnonzero((codes[:-1] == 39) & start[: n - 1] & (kind[1:] == LETTER) & ~forced[1:n])
        if len(lone):
            a = codes[lone + 1]
            two = lone + 2 < n
            after = np.minimum(lone + 2, n - 1)
            b = np.where(two & ~forced[after], codes[after], 0)
            length = np.where(np.isin(a, [ord(c) for c in "stmd"]), 1, 0)
            for pair in ("re", "ve", "ll"):
                length[(a == ord(pair[0])) & (b == ord(pair[1]))] = 2
            lone, length = lone[length > 0], length[length > 0]
            start[lone + 1] = False
            start[lone + 1 + length] |= True
            # a blank, a digit or a sign behind the letters begins as it did before
        return start[:n]

    def words(self, rows: np.ndarray) -> list[str]:
        return [self.text[s:e] for s, e in zip(self.starts[rows].tolist(), self.ends[rows].tolist())]


class WordTable:
    """Token ids of pre-tokens seen so far, found by hash; only new ones are encoded.

    When it holds more than `most` words it keeps the third of them that was met most often, so
    its memory is bounded and common words stay.
    """

    def __init__(self, encode_words, most: int = 250_000):
        self._encode, self._most = encode_words, most
        self._clear()

    def _clear(self) -> None:
        self._index = HashIndex()
        self._flat = np.zeros(1 << 16, np.int32)
        self._used = 0
        self._starts = np.zeros(1 << 14, np.int64)
        self._lengths = np.zeros(1 << 14, np.int64)
        self._keys = np.zeros(1 << 14, np.uint64)
        self._met = np.zeros(1 << 14, np.int64)

    def _forget(self) -> None:
        size = self._index.size
        room = min(self._most // 3, size)
        kept = np.argpartition(-self._met[:size], room - 1)[:room] if room else np.zeros(0, np.int64)
        if self._lengths[kept].sum() > 4 * self._most:  # a few endless words fill the table
            kept = kept[self._lengths[kept] <= 8]
        keys, met, flat, lengths = self._keys[kept], self._met[kept] // 2, self.ids(kept), self._lengths[kept]
        self._clear()
        self._learn(keys, (flat, lengths))
        self._met[: len(met)] = met

    def rows(self, pre: PreTokens) -> np.ndarray:
        """Row of each pre-token in the table."""
        if self._index.size > self._most or self._used > 8 * self._most:
            self._forget()
        rows = self._index.find(pre.hashes)
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            keys, first = np.unique(pre.hashes[missing], return_index=True)
            self._learn(keys, self._encode(pre.words(missing[first])))
            rows[missing] = self._index.find(pre.hashes[missing])
        self._met[: self._index.size] += np.bincount(rows, minlength=self._index.size)
        return rows

    def _learn(self, keys: np.ndarray, encoded: tuple[np.ndarray, np.ndarray]) -> None:
        flat, lengths = encoded
        size, used = self._index.size, self._used
        if size + len(keys) > len(self._starts):
            grow = max(len(self._starts), len(keys))
            self._starts = np.append(self._starts, np.zeros(grow, np.int64))
            self._lengths = np.append(self._lengths, np.zeros(grow, np.int64))
            self._keys = np.append(self._keys, np.zeros(grow, np.uint64))
            self._met = np.append(self._met, np.zeros(grow, np.int64))
        if used + len(flat) > len(self._flat):
            self._flat = np.append(self._flat, np.zeros(max(len(self._flat), len(flat)), np.int32))
        self._starts[size : size + len(keys)] = used + np.cumsum(lengths) - lengths
        self._lengths[size : size + len(keys)] = lengths
        self._keys[size : size + len(keys)] = keys
        self._flat[used : used + len(flat)] = flat
        self._used += len(flat)
        self._index.add(keys)

    def lengths(self, rows: np.ndarray) -> np.ndarray:
        return self._lengths[rows]

    def ids(self, rows: np.ndarray) -> np.ndarray:
        from tallymark.llm.hashing import ranges_of

        return self._flat[ranges_of(self._starts[rows], self._lengths[rows])]

    def encode(self, texts: list[str], specials: tuple[str, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each."""
        pre = PreTokens(texts, specials)
        rows = self.rows(pre)
        ends = np.append(0, np.cumsum(self.lengths(rows)))
        return self.ids(rows), np.diff(ends[pre.first])
