"""Identity-term slices: which groups a text mentions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from modspark import constants as K
from modspark.functions.numbers import bind

Groups = Mapping[str, Sequence[str]]


def usable(groups: Groups) -> dict[str, list[str]]:
    """Trim terms, drop blank ones, and skip groups left without terms."""
    trimmed = {str(g): [str(t).strip() for t in terms if str(t).strip()] for g, terms in groups.items()}
    return {g: terms for g, terms in trimmed.items() if terms}


def slice_names(groups: Groups) -> list[str]:
    return [*usable(groups), K.ANY_SLICE, K.REFERENCE_SLICE]


def _literal(term: str) -> str:
    """A term with every regex metacharacter escaped for Java."""
    return re.sub(r"([\\^$.|?*+()\[\]{}\-&~#\s])", r"\\\1", term)


def _edges(term: str) -> str:
    """The term between word edges.

    Next to a word character an edge is the absence of another one; next to any other
    character it is the presence of one.
    """
    word = re.compile(r"\w")
    before = "(?<!" if word.match(term[0]) else "(?<="
    after = "(?!" if word.match(term[-1]) else "(?="
    return f"{before}[{K.WORD_CHARS}]){_literal(term)}{after}[{K.WORD_CHARS}])"


def mentions(text: Column, terms: Sequence[str]) -> Column:
    """Some term occurs as a whole word, in any case."""
    return text.rlike("(?iu)(?:" + "|".join(_edges(t) for t in terms) + ")")


def slices_of(text: Column, groups: Groups) -> Column:
    """Array of the slices a text belongs to: its groups plus any / none."""
    hits = F.array(
        *[F.when(mentions(text, terms), F.lit(g)) for g, terms in usable(groups).items()]
    )
    return bind(F.array_compact(hits.cast("array<string>")), _with_any_or_none)


def _with_any_or_none(found: Column) -> Column:
    rest = F.when(F.size(found) > 0, F.lit(K.ANY_SLICE)).otherwise(F.lit(K.REFERENCE_SLICE))
    return F.concat(found, F.array(rest))
