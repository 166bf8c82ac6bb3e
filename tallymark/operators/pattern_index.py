"""Many regular expressions on one text: an index of literals picks the few that may match.

Every match of a pattern contains at least one of a few literals that follow from the pattern (the
parts it cannot do without). One pass over a text finds all literals of all patterns at once, in an
Aho-Corasick automaton; only the patterns they point to are evaluated as regular expressions, by
Spark, so a hit is what `rlike` says. Patterns that are plain words need no further look, and
patterns without such a literal are always evaluated.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

try:
    from re import _parser as parser
except ImportError:  # before Python 3.11
    import sre_parse as parser

LEAST_LITERAL = 3
MOST_LITERALS = 16


def _choices(tokens) -> list[str] | None:
    """Literals of which every match of the parsed sequence contains one; None if unknown.

    Of all parts that a match must contain, the one whose shortest literal is longest is taken.
    """
    best: list[str] | None = None
    run: list[str] = []

    def offer(found: list[str] | None) -> None:
        nonlocal best
        if found and len(found) <= MOST_LITERALS and min(map(len, found)) >= LEAST_LITERAL:
            if best is None or min(map(len, found)) > min(map(len, best)):
                best = found

    def end_run() -> None:
        if run:
            offer(["".join(run)])
            run.clear()

    for kind, value in tokens:
        name = str(kind)
        if name == "LITERAL":
            run.append(chr(value))
        elif name == "AT":
            continue  # an anchor stands between characters
        else:
            end_run()
            if name == "SUBPATTERN":
                _, add, drop, inner = value
                offer(None if add or drop else _choices(inner))
            elif name in ("MAX_REPEAT", "MIN_REPEAT") and value[0] >= 1:
                offer(_choices(value[2]))
            elif name == "BRANCH":
                parts = [_choices(branch) for branch in value[1]]
                offer(None if any(p is None for p in parts) else sorted({x for p in parts for x in p}))
    end_run()
    return best


def literals(pattern: str) -> list[str] | None:
    """Literals of which every match contains at least one, or None if there are none to name.

    Syntax that Python does not share with the regular expressions of Spark gives None.
    """
    if re.search(r"\\[^bwsdBWSD.\-+*?()\[\]{}|^$/]|\(\?(?!:)|&&|\[[^\]]*\[", pattern):
        return None
    try:
        parsed = parser.parse(pattern)
    except re.error:
        return None
    if parsed.state.flags & (re.IGNORECASE | re.VERBOSE):
        return None
    return _choices(parsed)


def is_plain(pattern: str) -> bool:
    """Whether the pattern matches itself and nothing else."""
    return re.fullmatch(r"[A-Za-z0-9 ]+", pattern) is not None


@dataclass(frozen=True)
class PatternIndex:
    """`patterns` are known by their place in the list."""

    patterns: tuple[str, ...]
    use_automaton: bool = field(default=True)

    @cached_property
    def _needs(self) -> list[list[str] | None]:
        return [[p] if is_plain(p) else literals(p) for p in self.patterns]

    @cached_property
    def always(self) -> list[int]:
        return [k for k, found in enumerate(self._needs) if found is None]

    @cached_property
    def by_literal(self) -> dict[str, list[int]]:
        out: dict[str, list[int]] = {}
        for k, found in enumerate(self._needs):
            for literal in found or ():
                out.setdefault(literal, []).append(k)
        return out

    def _by_automaton(self, text: Column) -> Column:
        by_literal = list(self.by_literal.items())

        @F.arrow_udf("array<int>")
        def candidates(texts: pa.Array) -> pa.Array:
            import ahocorasick

            automaton = ahocorasick.Automaton()
            for literal, places in by_literal:
                automaton.add_word(literal, places)
            automaton.make_automaton()
            found = []
            for value in texts:
                own: set[int] = set()
                for _, places in automaton.iter(value.as_py() or ""):
                    own.update(places)
                found.append(sorted(own))
            return pa.array(found, pa.list_(pa.int32()))

        return candidates(text)

    def _by_contains(self, text: Column) -> Column:
        """The same without the library of the automaton: every literal is looked for."""
        entries = F.array(*[
            F.struct(F.lit(literal).alias("literal"), F.array(*map(F.lit, places)).alias("places"))
            for literal, places in self.by_literal.items()
        ])
        hit = F.filter(entries, lambda e: F.coalesce(F.contains(text, e["literal"]), F.lit(False)))
        return F.array_distinct(F.flatten(F.transform(hit, lambda e: e["places"])))

    def candidates(self, text: Column) -> Column:
        """Places of the patterns that may match, beyond those that are always tried."""
        if not self.by_literal:
            return F.array().cast("array<int>")
        if self.use_automaton:
            try:
                import ahocorasick  # noqa: F401

                return self._by_automaton(text)
            except ImportError:
                pass
        return self._by_contains(text)

    def matched(self, text: Column) -> Column:
        """array<int>: the places of all patterns that the text contains; null contains none."""
        if not self.patterns:
            return F.array().cast("array<int>")
        tried = self.candidates(text)
        if self.always:
            tried = F.concat(tried, F.array(*map(F.lit, self.always)))
        rest = [k for k, p in enumerate(self.patterns) if not is_plain(p)]
        if not rest:
            return tried
        texts = F.array(*[F.lit(None if is_plain(p) else p).cast("string") for p in self.patterns])
        return F.filter(
            tried,
            lambda k: F.when(F.get(texts, k).isNull(), True).otherwise(
                F.coalesce(F.rlike(text, F.get(texts, k)), F.lit(False))
            ),
        )
