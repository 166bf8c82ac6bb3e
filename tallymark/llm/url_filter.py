"""URL verdicts by pattern rules, indexed by their rarest literal token.

A rule is a host and a path; its pattern fits that host and all its subdomains if the URL's path
starts with the rule's. Of the tokens (letters and digits) that any fitting URL must contain as
wholes, the one that the fewest URLs of the table contain indexes the rule. A URL's tokens fetch
candidate rules and only these run their regular expressions; the longest that fits decides.
Rules come as a list, so their number is bounded by the driver; they are broadcast.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.batches import map_arrow, without

_TOKEN = re.compile(r"[^\W_]+")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    """`path` begins with a slash; `verdict` is allow or block."""

    verdict: str
    host: str
    path: str

    def __post_init__(self):
        if not self.host or not self.path.startswith("/"):
            raise ValueError("a rule needs a host and a path that begins with /")

    @property
    def text(self) -> str:
        return self.host + self.path

    def pattern(self) -> re.Pattern:
        return re.compile(r"(?:[^/]*\.)?" + re.escape(self.text))

    def tokens(self) -> set[str]:
        """Tokens that end within the rule; the last of the path may go on in a URL."""
        return {m[0] for m in _TOKEN.finditer(self.text) if m.end() < len(self.text)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without `://`."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(_UPPER), re.match(r"[^?#]*", rest[len(host) :])[0]


def tokens_of(host: str, path: str) -> set[str]:
    return set(_TOKEN.findall(host + path))


class Index:
    """Rules under their rarest token; equal frequencies by the token itself."""

    def __init__(self, rules: list[Rule], frequency: dict[str, int]):
        self.by_token: dict[str, list[tuple[Rule, re.Pattern]]] = {}
        self.always: list[tuple[Rule, re.Pattern]] = []
        for rule in rules:
            tokens = sorted(rule.tokens(), key=lambda t: (frequency.get(t, 0), t))
            entry = rule, rule.pattern()
            if tokens:
                self.by_token.setdefault(tokens[0], []).append(entry)
            else:
                self.always.append(entry)

    def decide(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits; of equal texts, block before allow."""
        best, text = None, host + path
        for token in tokens_of(host, path) & self.by_token.keys() | {None}:
            for rule, pattern in self.by_token[token] if token is not None else self.always:
                if pattern.match(text):
                    rank = len(rule.text), rule.verdict == "block"
                    if best is None or rank > best[0]:
                        best = rank, rule
        return best[1] if best else None


def _frequencies(urls: DataFrame, tokens: set[str]) -> dict[str, int]:
    """In how many URLs each of the rules' tokens occurs."""
    data = urls.sparkSession.sparkContext.broadcast(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for url in batch.column(0).cast(pa.string()).to_pylist():
                counts.update(tokens_of(*split_url(url)) & data.value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["token", "n"],
        )

    rows = map_arrow(urls, run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r.token: r.n for r in rows.collect()}


def judge(df: DataFrame, rules: list[Rule], default: str = "allow", url: str = "url") -> DataFrame:
    """`df` with host, path, rule (text of the rule that decides, or null) and verdict.

    Null URLs and those without `://` have an empty host and path and get `default`. Columns of
    these names are replaced unless one is `url` itself, which is an error; others stay.
    """
    added = ("host", "path", "rule", "verdict")
    if url in added:
        raise ValueError(f"rename the column {url} first")
    needed = {t for rule in rules for t in rule.tokens()}
    index = Index(rules, _frequencies(df.select(url), needed))
    data = df.sparkSession.sparkContext.broadcast(index)
    kept = without(df, *added)
    column = kept.columns.index(url)
    schema = T.StructType([*kept.schema.fields, *(T.StructField(n, T.StringType()) for n in added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [split_url(u) for u in batch.column(column).cast(pa.string()).to_pylist()]
            found = [data.value.decide(*p) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([p[0] for p in parts], pa.string()),
                    pa.array([p[1] for p in parts], pa.string()),
                    pa.array([r.text if r else None for r in found], pa.string()),
                    pa.array([r.verdict if r else default for r in found], pa.string()),
                ],
                names=schema.names,
            )

    return map_arrow(kept, run, schema)
