"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

Every benchmark item is cut into windows of consecutive words. The words of a window are
ordered by their number of occurrences in the documents; the rarest is the prefix that any
text with the window must contain. Documents are joined on these words alone, the place of
the word in the window bounds where the window may lie, and the window is then compared
word by word in the text.

Before the join, words pass a bitmap of a fixed size over the hashes of the wanted words;
what passes takes along only the words around it. So the join stays small whether Spark
broadcasts the windows or, with a large benchmark, shuffles both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark.llm.store import saved

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
"""A word of a text whose A-Z are lower case already."""
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Decontamination:
    window: int = 10


FLAGS = 1 << 20
"""Bits of the bitmap that words pass before a join."""


def may_contain(values: DataFrame, column: str) -> Callable[[Column], Column]:
    """A test that every value of the column passes, and few others: one bit per hash."""
    place = lambda value: F.pmod(F.xxhash64(value), F.lit(FLAGS))
    bits = values.select(place(F.col(column)).alias("at")).select(
        F.expr("at div 64").alias("id"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bit")
    )
    every = values.sparkSession.range(FLAGS // 64).join(bits.groupBy("id").agg(F.bit_or("bit").alias("bits")), "id", "left")
    cells = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits"))))
    table = saved(every.agg(F.transform(cells, lambda c: c["bits"]).alias("bitmap")))

    def test(value: Column) -> Column:
        at = place(value)
        cell = F.element_at(table.select("bitmap").scalar(), F.shiftright(at, 6).cast("int") + 1)
        return F.call_function("shiftright", cell, (at % 64).cast("int")).bitwiseAND(1) == 1

    return test


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def windows(items: DataFrame, settings: Decontamination) -> DataFrame:
    """item_id, window (words): every run of ``window`` words; a shorter item is one window."""
    w = settings.window
    n = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(n - w + 1, F.lit(1)))
    cut = items.select("item_id", words(F.col("text")).alias("words")).filter(n > 0)
    placed = cut.select("item_id", "words", F.explode(starts).alias("at"))
    return placed.select("item_id", F.slice("words", F.col("at"), w).alias("window")).distinct()


def anchors(docs: DataFrame, items: DataFrame, settings: Decontamination) -> DataFrame:
    """word, offset, window, items: the windows by their rarest word.

    Written as a table: Spark then knows its size and broadcasts it only if it is small.
    """
    shingles = saved(windows(items, settings))
    vocabulary = saved(shingles.select(F.explode("window").alias("word")).distinct())
    wanted = may_contain(vocabulary, "word")
    seen = docs.select(F.explode_outer(words(F.col("text"))).alias("word")).filter(wanted(F.col("word")))
    # counted before the join: a frequent word is one row per task
    counts = seen.groupBy("word").agg(F.count("*").alias("n")).join(vocabulary, "word")
    # a word that no document has makes the window impossible: the inner join drops it
    placed = shingles.groupBy("window").agg(F.collect_set("item_id").alias("items"))
    each = placed.select("window", "items", F.posexplode("window").alias("offset", "word"))
    ranked = each.join(counts, "word").groupBy("window").agg(
        F.first("items").alias("items"),
        F.min(F.struct("n", "word", "offset")).alias("rarest"),
        F.count("*").alias("found"),
    )
    whole = ranked.filter(F.col("found") == F.size("window"))
    return saved(whole.select(F.col("rarest.word").alias("word"), F.col("rarest.offset").alias("offset"), "window", "items"))


def key_columns() -> list[Column]:
    """What tells documents apart: the id, and a hash of the text for ids that occur twice."""
    return [F.col("doc_id"), F.xxhash64("text").alias("text_key")]


def occurrences(docs: DataFrame, index: DataFrame, settings: Decontamination) -> DataFrame:
    """doc_id, text_key, start, stop, items: where windows occur, in words."""
    wanted = may_contain(index, "word")
    at = docs.select(*key_columns(), words(F.col("text")).alias("words"))
    placed = at.select("doc_id", "text_key", "words", F.posexplode_outer("words").alias("place", "word"))
    reach = F.lit(settings.window - 1)
    begin = F.greatest(F.col("place") - reach, F.lit(0))
    near = placed.filter(wanted(F.col("word"))).select(
        "doc_id", "text_key", "place", "word", begin.alias("begin"),
        F.slice("words", begin + 1, 2 * settings.window - 1).alias("around"),
    )
    start = F.col("place") - F.col("offset")
    n = F.size("window")
    inside = (start >= 0) & (start - F.col("begin") + n <= F.size("around"))
    same = F.slice("around", F.greatest(start - F.col("begin"), F.lit(0)) + 1, n) == F.col("window")
    return near.join(index, "word").filter(inside & same).select(
        "doc_id", "text_key", start.alias("start"), (start + n).alias("stop"), "items"
    )


def hits(docs: DataFrame, items: DataFrame, settings: Decontamination = Decontamination()) -> DataFrame:
    """doc_id, text_key, n_hit, item_ids of the documents in which a window occurs."""
    found = occurrences(docs, anchors(docs, items, settings), settings)
    by_doc = found.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"),
        F.array_sort(F.array_distinct(F.array_compact(F.flatten(F.collect_set(F.transform("items", lambda i: i.cast("string"))))))).alias("item_ids"),
    )
    # spans come by start; each adds what lies beyond the furthest end so far
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(so_far: Column, span: Column) -> Column:
        new = F.greatest(span["stop"] - F.greatest(span["start"], so_far["end"]), F.lit(0))
        return F.struct(F.greatest(so_far["end"], span["stop"]).alias("end"), (so_far["n"] + new).alias("n"))

    return by_doc.select("doc_id", "text_key", F.aggregate("spans", begin, add)["n"].alias("n_hit"), "item_ids")


def contamination(docs: DataFrame, items: DataFrame, settings: Decontamination = Decontamination()) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, item_ids for every row of docs.

    A null text or a text without words has no words and no hits, an item without words no
    windows, a null item_id counts as no item. Repeated rows come out as often as they
    came in; a null doc_id stands like any other. Empty tables give empty results or no
    hits. Other columns are ignored.
    """
    n_words = F.coalesce(F.regexp_count("text", F.lit(ANY_CASE_WORD)), F.lit(0)).cast("long")
    rows = docs.select(*key_columns(), n_words.alias("n_words"))
    found = hits(docs, items, settings).select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "n_hit", "item_ids")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(found, same, "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, settings: Decontamination = Decontamination()) -> DataFrame:
    """The rows of docs in which no window occurs, with all their columns."""
    found = hits(docs, items, settings).select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__k"))
    same = F.col("doc_id").eqNullSafe(F.col("__d")) & (F.xxhash64("text") == F.col("__k"))
    return docs.join(found, same, "left_anti")


SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i : i + least(len(words), 10) - 1], ' ') AS w
  FROM (SELECT item_id, words, unnest(generate_series(1, greatest(len(words) - 9, 1))) AS i FROM items WHERE len(words) > 0)
), runs AS (
  SELECT doc_id, n, i, array_to_string(words[i : i + n - 1], ' ') AS w
  FROM (SELECT doc_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i
        FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n)
), found AS (
  SELECT doc_id, i, n, item_id FROM runs JOIN windows USING (n, w)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(m.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(m.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN named m ON d.doc_id = m.doc_id
"""
