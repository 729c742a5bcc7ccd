"""Text cleaning, features, redaction and hashing as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from modspark import constants as K

# Float features are held in 32 bits, counts and flags in 32-bit integers.
FEATURES = (
    "length_chars",
    "length_words",
    "uppercase_ratio",
    "punct_ratio",
    "exclam",
    "question",
    "has_url",
    "has_email",
    "has_repeat",
    "non_ascii_ratio",
    "has_quote",
)


_PUNCTUATION_RUN = "[" + "".join("\\" + c for c in K.PUNCTUATION) + "]+"


def normalize(text: Column) -> Column:
    """Collapse every run of whitespace to one space and trim; null becomes ''.

    A lone plain space is its own replacement, so the pattern passes it over.
    """
    runs = rf"[{K.SPACE_CHARS}&&[^ ]][{K.SPACE_CHARS}]*| [{K.SPACE_CHARS}]+"
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), runs, " "))


def strip(text: Column) -> Column:
    """Trim Unicode whitespace at both ends."""
    return F.regexp_replace(text, f"^[{K.SPACE_CHARS}]+|[{K.SPACE_CHARS}]+$", "")


def content_hash(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def short_id(text: Column, digits: int = 12) -> Column:
    return F.substring(content_hash(text), 1, digits)


def redact_pii(text: Column) -> Column:
    """Mask e-mail addresses, then URLs, then phone numbers.

    Each pattern runs only on texts that hold a character it needs, so plain prose costs
    three substring searches.
    """
    mail = F.when(
        F.contains(text, F.lit("@")), F.regexp_replace(text, K.EMAIL_PATTERN, "<EMAIL>")
    ).otherwise(text)
    may_link = F.contains(mail, F.lit("http")) | F.contains(mail, F.lit("www."))
    link = F.when(may_link, F.regexp_replace(mail, K.URL_PATTERN, "<URL>")).otherwise(mail)
    return F.when(
        link.rlike(r"\p{Nd}{2}"), F.regexp_replace(link, K.PHONE_PATTERN, "<PHONE>")
    ).otherwise(link)


def _kept(text: Column, dropped: str) -> Column:
    """Number of characters left after deleting runs of ``dropped``."""
    return F.length(F.regexp_replace(text, dropped, ""))


def _occurrences(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0)).cast("float")


def _flag(condition: Column) -> Column:
    return condition.cast("int")


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, f"[{K.SPACE_CHARS}]+"), ""))


def feature(name: str, text: Column) -> Column:
    """One of ``FEATURES``; ``text`` must not be null."""
    size = F.length(text)
    if name == "length_chars":
        return size
    if name == "length_words":
        return word_count(text)
    if name == "uppercase_ratio":
        return _ratio(_kept(text, r"\P{Lu}+"), _kept(text, r"\P{L}+"))
    if name == "punct_ratio":
        return _ratio(size - _kept(text, _PUNCTUATION_RUN), size)
    if name == "exclam":
        return _occurrences(text, "!")
    if name == "question":
        return _occurrences(text, "?")
    if name == "has_url":
        low = F.lower(text)
        may_link = F.contains(low, F.lit("http")) | F.contains(low, F.lit("www."))
        return _flag(may_link & text.rlike("(?iu)" + K.URL_PATTERN))
    if name == "has_email":
        return _flag(F.contains(text, F.lit("@")) & text.rlike("(?iu)" + K.EMAIL_PATTERN))
    if name == "has_repeat":
        return _flag(text.rlike(K.REPEAT_PATTERN))
    if name == "non_ascii_ratio":
        return _ratio(_kept(text, r"[\x00-\x7F]+"), size)
    if name == "has_quote":
        return _flag(F.contains(text, F.lit('"')) | F.contains(text, F.lit("'")))
    raise KeyError(name)


def all_features(text: Column) -> list[Column]:
    """The eleven features as columns named after ``FEATURES``."""
    filled = F.coalesce(text, F.lit(""))
    return [feature(name, filled).alias(name) for name in FEATURES]
