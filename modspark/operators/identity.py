"""Identity slices of texts for long term lists: one automaton over the terms of all groups.

The regular expressions of ``functions.slices`` try every term at every place; here a text is
read once, however many terms there are. Both give the same slices.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark import constants as K
from modspark.functions.slices import Groups, usable

MOST_TERM_BYTES = 64 << 20
"""Terms go to every task, so their size is checked."""


class _Folded(dict):
    """Every letter as the one that stands for all its cases, a letter at a time."""

    def __missing__(self, point: int) -> int:
        char = chr(point)
        upper = char.upper() if len(char.upper()) == 1 else char
        lower = upper.lower() if len(upper.lower()) == 1 else upper
        self[point] = ord(lower)
        return self[point]


class _WordChars(dict):
    """Whether a character is a letter, a number or the underscore."""

    def __missing__(self, char: str) -> bool:
        self[char] = char == "_" or unicodedata.category(char)[0] in "LN"
        return self[char]


class TermAutomaton:
    """Finds which groups a text mentions.

    A term counts between word edges: next to a word character an edge is the absence of
    another one, next to any other character it is the presence of one.
    """

    def __init__(self, groups: Groups):
        import ahocorasick

        self.names = list(usable(groups))
        self.folded, self.word = _Folded(), _WordChars()
        found: dict[str, tuple[int, bool, bool, set[int]]] = {}
        starts = re.compile(r"\w")
        for i, terms in enumerate(usable(groups).values()):
            for term in terms:
                key = term.translate(self.folded)
                entry = (len(key), not starts.match(term[0]), not starts.match(term[-1]))
                found.setdefault(key, (*entry, set()))[3].add(i)
        self.automaton = ahocorasick.Automaton()
        for key, value in found.items():
            self.automaton.add_word(key, value)
        if found:
            self.automaton.make_automaton()
        self.empty = not found

    def groups_of(self, text: str) -> list[str]:
        if self.empty:
            return []
        seen: set[int] = set()
        line, word, end_of_text = text.translate(self.folded), self.word, len(text)
        for end, (length, inner_before, inner_after, groups) in self.automaton.iter(line):
            if groups <= seen:
                continue
            start, after = end - length + 1, end + 1
            before = start > 0 and word[text[start - 1]]
            behind = after < end_of_text and word[text[after]]
            if before == inner_before and behind == inner_after:
                seen |= groups
                if len(seen) == len(self.names):
                    break
        return [self.names[i] for i in sorted(seen)]


def term_slices(text: Column, groups: Groups) -> Column:
    """Array of the slices a text belongs to: its groups plus any / none; null for a null text."""
    size = sum(len(t.encode()) for terms in groups.values() for t in map(str, terms))
    if size > MOST_TERM_BYTES:
        raise ValueError(f"terms of {size} bytes are too many to send to every task")

    @F.pandas_udf("array<string>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = TermAutomaton(groups)
        for batch in batches:
            yield batch.map(lambda t: _with_rest(automaton.groups_of(t)) if t is not None else None)

    return found(text)


def _with_rest(found: list[str]) -> list[str]:
    return [*found, K.ANY_SLICE if found else K.REFERENCE_SLICE]


def term_slice_rows(df: DataFrame, groups: Groups, text: str = "text") -> DataFrame:
    """One row per row and slice it belongs to; a null text belongs to none of the groups."""
    slices = term_slices(F.coalesce(F.col(text), F.lit("")), groups)
    return df.withColumn("slice", F.explode_outer(slices))
