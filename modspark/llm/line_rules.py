"""Quality rules with cross-document line frequency, in DataFrame operations only.

Every line is normalised and hashed; for each host the distinct documents of a line are
counted. Lines of more documents than the limit are boilerplate and are taken out; a
document that keeps too few of its words without them is rejected, as is one that fails the
basic rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class LineRules:
    """Limits: documents per host and line; words and their share that must be left."""

    documents_per_host: int = 20
    least_words: int = 20
    least_share: int = 30
    """Hundredths of the document's words."""
    base_words: int = 50
    base_repeat: int = 50
    """Hundredths of the words that may lie in repeated 3-word windows."""


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeat_words(tokens: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the same list."""
    last = F.size(tokens) - 2
    windows = F.transform(
        F.when(last > 0, F.sequence(F.lit(0), last - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)),
    )

    def covered(hashes: Column) -> Column:
        # windows by hash and place: a repeated one has an equal neighbour
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(o: Column) -> Column:
            marked = F.transform(
                o, lambda w, k: F.when((F.get(o, k - 1)["h"] == w["h"]) | (F.get(o, k + 1)["h"] == w["h"]), w["i"])
            )
            return F.sort_array(F.array_compact(marked))

        def total(at: Column) -> Column:
            gaps = F.transform(at, lambda s, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1), s + 3) - s))
            return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

        return bound(bound(ordered, starts), total)

    def of(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered(hashes)).otherwise(F.lit(0))

    return bound(windows, of)


def bound(value: Column, use) -> Column:
    """use(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def normal(line: Column) -> Column:
    """Lower case, digits alike, single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"[0-9]+", "0"), r"[\x20\x09-\x0D]+", " "))


def key_columns() -> list[Column]:
    return [F.col("doc_id"), F.col("source"), F.xxhash64("text").alias("text_key")]


def same_row(other: dict[str, str]) -> Column:
    condition = F.lit(True)
    for mine, theirs in other.items():
        condition = condition & F.col(mine).eqNullSafe(F.col(theirs))
    return condition


def frequent_lines(lines: DataFrame, rules: LineRules) -> DataFrame:
    """host, line: lines of more distinct documents of the host than the limit."""
    documents = lines.groupBy("source", "line", "doc_id").agg(F.lit(1).alias("one"))
    counted = documents.groupBy("source", "line").agg(F.count("*").alias("documents"))
    return counted.filter(F.col("documents") > rules.documents_per_host).select(
        F.col("source").alias("host"), F.col("line").alias("frequent")
    )


def line_table(docs: DataFrame) -> DataFrame:
    """doc_id, source, text_key, line (hash), n: every line with a word and its number of words."""
    split = F.explode(F.split(F.coalesce("text", F.lit("")), "\n"))
    lines = docs.select(*key_columns(), split.alias("raw"))
    n = F.size(words(F.col("raw")))
    return lines.select("doc_id", "source", "text_key", F.xxhash64(normal(F.col("raw"))).alias("line"), n.alias("n")).filter("n > 0")


def measured(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, removed_words, source, text_key.

    One row per row of docs. A null text is empty: no words, fails the basic rules. A null
    source is a host of its own, a null doc_id a document like any other; repeated rows
    count as one document and come out as often as they came in. Other columns of docs are
    ignored; an empty table gives an empty result.
    """
    lines = line_table(docs)
    frequent = frequent_lines(lines, rules)
    removed = (
        lines.join(frequent, F.col("source").eqNullSafe(F.col("host")) & (F.col("line") == F.col("frequent")))
        .groupBy("doc_id", "source", "text_key")
        .agg(F.sum("n").alias("words"), F.count("*").alias("lines"))
        .toDF("_d", "_s", "_k", "removed", "_lines")
    )
    text = F.coalesce("text", F.lit(""))
    base = docs.select(*key_columns(), text.alias("text"))
    lines_with_words = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = base.select(
        "doc_id", "source", "text_key",
        bound(words(F.col("text")), lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("r"))).alias("w"),
        F.char_length(without(F.col("text"), BLANKS)).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        bound(lines_with_words, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )
    n_words, repeated = F.col("w.n").cast("long"), F.col("w.r").cast("long")
    copies = docs.groupBy(*key_columns()).agg(F.count("*").alias("times")).toDF("_d2", "_s2", "_k2", "times")
    rows = counted.select(
        "doc_id", "source", "text_key", n_words.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        repeated.alias("n_repeat_words"),
    )
    # equal rows share the lines of each: divide by their number
    removed = removed.join(copies, same_row({"_d": "_d2", "_s": "_s2", "_k": "_k2"})).select(
        "_d", "_s", "_k", (F.col("removed") / F.col("times")).cast("long").alias("removed")
    )
    joined = rows.join(removed, same_row({"doc_id": "_d", "source": "_s", "text_key": "_k"}), "left")
    failed = (F.col("n_words") < rules.base_words) | (100 * F.col("n_repeat_words") > rules.base_repeat * F.col("n_words"))
    gone = F.coalesce("removed", F.lit(0))
    left = F.col("n_words") - gone
    depleted = (gone > 0) & ((left < rules.least_words) | (100 * left < rules.least_share * F.col("n_words")))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
        gone.cast("long").alias("removed_words"), "source",
    )


SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents
), cut AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs
), windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM cut WHERE len(w) > 2)
), repeats AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY r, g) AS c FROM windows) WHERE c > 1)
  GROUP BY r
), lines AS (
  SELECT r, doc_id, source, raw, len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) AS n,
    trim(regexp_replace(regexp_replace(lower(raw), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line
  FROM (SELECT r, doc_id, source, unnest(string_split(text, chr(10))) AS raw FROM docs)
), worded AS (
  SELECT * FROM lines WHERE n > 0
), doubled AS (
  SELECT r, count(*) - count(DISTINCT raw) AS n FROM worded GROUP BY r
), frequent AS (
  SELECT source, line FROM (SELECT DISTINCT source, line, doc_id FROM worded) GROUP BY source, line HAVING count(*) > 20
), removed AS (
  SELECT r, sum(n) AS n FROM worded l JOIN frequent f ON l.source IS NOT DISTINCT FROM f.source AND l.line = f.line GROUP BY r
), measured AS (
  SELECT c.doc_id, c.source, len(c.w)::BIGINT AS n_words, len(regexp_replace(c.text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (len(c.text) - len(regexp_replace(c.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(d.n, 0)::BIGINT AS n_dup_lines, coalesce(p.n, 0)::BIGINT AS n_repeat_words, coalesce(m.n, 0)::BIGINT AS removed_words
  FROM cut c LEFT JOIN repeats p USING (r) LEFT JOIN doubled d USING (r) LEFT JOIN removed m USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND NOT (removed_words > 0 AND (n_words - removed_words < 20 OR 100 * (n_words - removed_words) < 30 * n_words)) AS kept,
  removed_words, source
FROM measured
"""
