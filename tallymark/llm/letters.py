"""Words of letters, lower-cased, for many texts at once."""

from __future__ import annotations

import sys

import numpy as np

from tallymark.llm.hashing import range_hashes
from tallymark.llm.pretokens import LETTER, class_table

_lower: list[np.ndarray] = []


def lower_table() -> np.ndarray:
    """Each character's lower case where that is one character, else itself."""
    if not _lower:
        table = np.arange(0x110000, dtype=np.uint32)
        for c in range(sys.maxunicode + 1):
            low = chr(c).lower()
            if len(low) == 1 and ord(low) != c:
                table[c] = ord(low)
        _lower.append(table)
    return _lower[0]


class LetterWords:
    """Runs of letters. `codes` are the lower-cased characters of all texts; word k is
    codes[starts[k]:ends[k]], its text number is text[k], its hash is hashes[k]."""

    def __init__(self, texts: list[str]):
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        self.codes = lower_table()[codes]
        solid = np.zeros(len(codes) + 2, bool)
        solid[1:-1] = class_table()[self.codes] == LETTER
        offsets = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        inner = offsets[offsets < len(codes)]
        edge, stop = solid[1:] & ~solid[:-1], solid[:-1] & ~solid[1:]
        edge[inner] = solid[1:-1][inner]
        stop[inner] |= solid[:-1][inner]
        self.starts, self.ends = np.flatnonzero(edge), np.flatnonzero(stop)
        self.text = np.searchsorted(offsets, self.starts, side="right")
        self.hashes = range_hashes(self.codes, self.starts, self.ends)
