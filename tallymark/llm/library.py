"""The tokenizers library inside tasks, on pre-tokens that a task has not seen before."""

from __future__ import annotations

import os

import numpy as np

from tallymark.llm.pretokens import WordTable

LINE_WORDS = 2000
TABLE_WORDS = 250_000


class Library:
    """A tokenizer of the library with a table of the pre-tokens it has encoded.

    For byte-level BPE files the library encodes pre-token by pre-token, so encoding each distinct
    one once gives the ids of whole texts. New ones go to it many at a time, as lines of one text:
    a line feed is a pre-token of its own between two that are not white space, and its id tells
    them apart again.
    """

    def __init__(self, data: bytes, most: int = TABLE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(data)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        kind = type(self.tokenizer.pre_tokenizer).__name__
        if kind != "ByteLevel" or self.tokenizer.normalizer is not None:
            raise ValueError("only byte-level BPE files without a normalizer are supported")
        self.specials = tuple(
            t.content for t in self.tokenizer.get_added_tokens_decoder().values()
        )
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self._feed = self._ids(["\n"])[0]
        self.table = WordTable(self._encode, most)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens, one after the other, and the number of ids of each."""
        alone = [k for k, w in enumerate(words) if w.isspace() or w in self.specials or len(self._feed) != 1]
        if alone:
            lines = np.delete(np.arange(len(words)), alone)
            parts: list = [None] * len(words)
            for k, ids in zip(alone, self._ids([words[k] for k in alone])):
                parts[k] = np.array(ids, np.int32)
            flat, lengths = self._lines([words[k] for k in lines])
            for k, ids in zip(lines.tolist(), np.split(flat, np.cumsum(lengths)[:-1])):
                parts[k] = ids
            return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        return self._lines(words)

    def _lines(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pre-tokens that are neither white space nor special strings."""
        texts = ["\n".join([*words[k : k + LINE_WORDS], ""]) for k in range(0, len(words), LINE_WORDS)]
        flat = np.concatenate([np.array(ids, np.int32) for ids in self._ids(texts)] or [np.zeros(0, np.int32)])
        feeds = np.flatnonzero(flat == self._feed[0]) if words else np.zeros(0, np.int64)
        if len(feeds) != len(words):
            raise ValueError("the vocabulary does not keep lines apart")
        return np.delete(flat, feeds), np.diff(feeds, prepend=-1) - 1


_workers: dict[tuple[int, int], Library] = {}


def worker_library(data: bytes, most: int = TABLE_WORDS) -> Library:
    key = hash(data), most
    if key not in _workers:
        _workers.clear()
        _workers[key] = Library(data, most)
    return _workers[key]
