"""Label vectors, three-class labels and score re-keying as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark import constants as K
from modspark.functions.numbers import parse_number
from modspark.functions.text import strip


def literal_map(pairs: Mapping[str, object]) -> Column:
    """A map literal for small fixed look-ups."""
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def look_up(pairs: Mapping[str, str], key: Column, default: Column) -> Column:
    if not pairs:
        return default
    return F.coalesce(F.try_element_at(literal_map(pairs), key), default)


def _number(df: DataFrame, field: str) -> Column:
    col = F.col(f"`{field}`")
    if dict(df.dtypes)[field] == "string":
        return parse_number(strip(col))
    return col.try_cast("double")


def label_vector(df: DataFrame, fields: Sequence[str]) -> Column:
    """``array<double>`` in field order; a missing or unparsable value counts as 0."""
    return F.array(
        *[
            F.coalesce(_number(df, f), F.lit(0.0)) if f in df.columns else F.lit(0.0)
            for f in fields
        ]
    )


def has_labels(df: DataFrame, fields: Sequence[str]) -> Column:
    """Every label is there, parses and is not negative (-1 marks an unlabelled row)."""
    if any(f not in df.columns for f in fields):
        return F.lit(False)
    passed = F.lit(True)
    for f in fields:
        passed = passed & F.coalesce(_number(df, f) >= 0, F.lit(False))
    return passed


def any_positive(labels: Column) -> Column:
    """Some label is above zero; NaN is not."""
    return F.exists(labels, lambda x: (x > 0) & ~F.isnan(x))


def all_zero(labels: Column) -> Column:
    return ~any_positive(labels)


def class_id(label: Column) -> Column:
    """Three-class label (name, number or numeric text) as 0/1/2; anything else is 0."""
    text = label.cast("string")
    name = F.upper(strip(text))
    number = parse_number(strip(text)).try_cast("int")
    by_name = {alias: i for i, aliases in K.CLASS_ALIASES.items() for alias in aliases}
    known = F.when(number.isin(*K.CLASS_ALIASES), number).otherwise(F.lit(0))
    return F.coalesce(F.try_element_at(literal_map(by_name), name), known)


def multi_hot(cls: Column) -> Column:
    """Class id as the two-label vector (offensive, hate)."""
    return F.array(
        *[F.when(cls == i, F.lit(1.0)).otherwise(F.lit(0.0)) for i in (1, 2)]
    )


def class_name(cls: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in K.CLASS_NAMES]), cls + 1)


def split_name(value: Column) -> Column:
    """Canonical split name; an unknown name passes through lower-cased."""
    # a null reads as the word "none", which no split carries
    s = F.lower(strip(F.coalesce(value.cast("string"), F.lit("none"))))
    return look_up(K.SPLIT_ALIASES, s, s)


def rekey(scores: Column, labels: Sequence[str], renames: Mapping[str, str] | None = None) -> Column:
    """Scorer output (a map) in canonical label order; an absent label scores 0."""
    keys = [(renames or {}).get(label, label) for label in labels]
    return F.array(
        *[F.coalesce(F.try_element_at(scores, F.lit(k)), F.lit(0.0)).cast("float") for k in keys]
    )
