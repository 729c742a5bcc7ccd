"""Mixing of sources to target weights by weighted fair queueing.

Every source is a queue of shuffled documents, served up to ``most`` times over. A copy's
virtual finish time is the source's words up to its end, divided by the source's weight.
Serving the copies in that order up to the total budget gives each source its share, and
hands on what exhausted sources leave, by weight.

Running totals come in two steps, over fixed ranges of the shuffle key and then inside one
range, so a source that holds a third of all documents is many small pieces. The global
order is cut the same way: totals of ranges of virtual time find the range in which the
budget ends, and only that range is ordered document by document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modspark.llm.store import saved

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Weights go to the sources in code point order, null last, and repeat."""

    weights: tuple[int, ...] = (5, 2, 1)
    most: int = 3
    """How often a document may be taken."""
    seed: str = "mix"
    time_ranges: int = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """source, source_size, rank, weight, level, target from (source, source_size).

    One row per source, so the whole table is the list of sources and not data. ``level``
    is the words per weight at which all sources together reach the budget when none
    gives more than ``most`` times its size: the end of resharing the excess by weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name)
    names = sources.select("*", rank.alias("rank"))
    weight = F.element_at(F.array(*map(F.lit, mix.weights)), (F.col("rank") - 1) % len(mix.weights) + 1)
    full = F.col("source_size") * F.lit(mix.most)
    ranked = names.select("*", weight.alias("weight"), full.alias("full"))
    by_exhaustion = Window.orderBy(F.col("full") / F.col("weight"), "rank")
    before = F.sum("full").over(by_exhaustion.rowsBetween(Window.unboundedPreceding, -1))
    left = F.sum("weight").over(by_exhaustion.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    budget = F.sum("source_size").over(everything)
    candidate = (budget - F.coalesce(before, F.lit(0))) / left
    levels = ranked.select("*", candidate.alias("candidate"), (F.col("full") / F.col("weight")).alias("ratio"))
    # the first source that is not exhausted at its candidate gives the level; later ones are lower
    level = F.max(F.when(F.col("candidate") <= F.col("ratio"), F.col("candidate"))).over(everything)
    levels = levels.select("*", level.alias("level"))
    target = F.least(F.col("weight") * F.col("level"), F.col("full").cast("double"))
    return levels.select("source", "source_size", "rank", "weight", "level", target.alias("target"))


def queue(docs: DataFrame, mix: Mix) -> DataFrame:
    """doc_id, source, size, times, source columns and ``until``: words of the source up to the document's end.

    Rows that agree in doc_id, source and size are one entry with ``times`` rows, served
    together.
    """
    sized = saved(
        docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
        .groupBy("doc_id", "source", "size")
        .agg(F.count("*").alias("times"))
        .withColumn("shuffle", F.md5(F.concat(F.lit(mix.seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))))
        .withColumn("part", F.substring("shuffle", 1, 3))
    )
    words = F.sum(F.col("size") * F.col("times"))
    parts = sized.groupBy("source", "part").agg(words.alias("words"))
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("source", "part", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead"))
    aims = targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), mix)
    o = offsets.join(aims.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    inside = (
        Window.partitionBy("source", "part")
        .orderBy("shuffle", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    own = sized.select("*", words.over(inside).alias("own"))
    o = o.select(F.col("source").alias("s"), F.col("part").alias("p"), "ahead", "source_size", "rank", "weight", "level", "target")
    joined = own.join(o, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    return saved(joined.select(*sized.columns[:5], "source_size", "rank", "weight", "level", "target", (F.col("own") + F.col("ahead")).alias("until")))


def _finish(copy: Column) -> Column:
    return (copy * F.col("source_size") + F.col("until")) / F.col("weight")


def _range(finish: Column, mix: Mix) -> Column:
    """The range of virtual time: even up to the expected end, then ever wider."""
    share = finish / F.when(F.col("level") > 0, F.col("level"))
    n = mix.time_ranges
    wide = n + F.floor(F.log2(share) * n)
    return F.coalesce(F.when(share < 1, F.floor(share * n)).otherwise(wide), F.lit(0)).cast("long")


def _place(finish: Column, copy: Column) -> Column:
    return F.struct(finish.alias("f"), F.col("rank"), copy.alias("copy"), F.col("shuffle"), F.coalesce(F.col("doc_id"), F.lit(-1)).alias("id"), F.col("size"))


def served(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, source, size, times, source_size, target, copies for the entries of ``docs``.

    ``copies`` says how often each row is taken, 0 to ``most``. A null text has no words
    and a null source is a source of its own, the last. The order of service is total up
    to equal rows, so reruns agree. No words at all, or no rows, take nothing. Other
    columns of docs are ignored.
    """
    waiting = queue(docs, mix)
    copies = waiting.select("*", F.explode(F.array(*map(F.lit, range(mix.most)))).alias("copy"))
    timed = copies.select(
        (F.col("size") * F.col("times")).alias("words"),
        _finish(F.col("copy")).alias("finish"),
        _range(_finish(F.col("copy")), mix).alias("range"),
        _place(_finish(F.col("copy")), F.col("copy")).alias("place"),
    )
    budget = waiting.agg(F.sum(F.col("size") * F.col("times"))).first()[0] or 0
    totals = timed.groupBy("range").agg(F.sum("words").alias("words"))
    running = F.sum("words").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0))
    last = (
        totals.select("range", "words", running.alias("running"))
        .filter(F.col("running") > budget)
        .orderBy("range")
        .first()
    )
    if last is None:
        # all copies together are within the budget, or there are no words
        taken = lambda copy: F.lit(1 if budget else 0)
    else:
        spent = last["running"] - last["words"]
        in_range = F.sum("words").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
        end = (
            timed.filter(F.col("range") == last["range"])
            .select("place", in_range.alias("own"))
            .filter(F.col("own") + spent <= budget)
            .agg(F.max("place").alias("end"))
            .first()["end"]
        )

        def taken(copy: int) -> Column:
            at = _range(_finish(F.lit(copy)), mix)
            earlier = at < last["range"]
            if end is not None:
                values = F.struct(
                    F.lit(end["f"]), F.lit(end["rank"]), F.lit(end["copy"]), F.lit(end["shuffle"]),
                    F.lit(end["id"]).cast("long"), F.lit(end["size"]).cast("long"),
                )
                earlier = earlier | ((at == last["range"]) & (_place(_finish(F.lit(copy)), F.lit(copy)) <= values))
            return earlier.cast("int")

    n = sum((taken(k) for k in range(mix.most)), F.lit(0))
    return waiting.select("doc_id", "source", "size", "times", "source_size", "target", n.alias("copies"))


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: every taken row of docs, once per copy, with ``copy`` from 0 on.

    Also carries size, source_size and target of the row; columns of docs with these names
    are replaced.
    """
    own = ("size", "source_size", "target", "copy")
    kept = [c for c in docs.columns if c not in own]
    plan = served(docs, mix).filter("copies > 0").select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"),
        "source_size", "target", "copies",
    )
    rows = docs.select(*kept, n_words(F.col("text")).alias("size"))
    same = (
        F.col("doc_id").eqNullSafe(F.col("__id"))
        & F.col("source").eqNullSafe(F.col("__source"))
        & (F.col("size") == F.col("__size"))
    )
    copy = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
    return rows.join(plan, same).select(*kept, "size", "source_size", "target", copy)


def mix_report(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, taken, source, copies."""
    entries = served(docs, mix).select("*", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_row"))
    return entries.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies"
    )


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix' || coalesce(doc_id::VARCHAR, '-')) AS shuffle
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank
  FROM sized GROUP BY source
), ranked AS (
  SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::BIGINT] AS weight, 3 * source_size AS most FROM sources
), levels AS (
  SELECT *, most / weight AS ratio,
    (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, rank
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS candidate
  FROM ranked
), aims AS (
  SELECT *, max(CASE WHEN candidate <= ratio THEN candidate END) OVER () AS level FROM levels
), queue AS (
  SELECT d.doc_id, d.source, d.size, d.shuffle, a.rank, a.weight, a.source_size,
    least(a.weight * a.level, a.most::DOUBLE) AS target,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.shuffle, d.doc_id, d.size)::BIGINT AS until
  FROM sized d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source
), copies AS (
  SELECT *, c.copy, (c.copy * source_size + until)::DOUBLE / weight AS finish
  FROM queue, (VALUES (0), (1), (2)) AS c(copy)
), running AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, copy, shuffle, coalesce(doc_id, -1), size)::BIGINT AS total FROM copies
), taken AS (
  SELECT doc_id, source, size, source_size, target,
    sum(CASE WHEN total <= (SELECT sum(size) FROM sized) THEN 1 ELSE 0 END) AS copies,
    count(*) AS n
  FROM running GROUP BY ALL
)
SELECT doc_id, size, source_size, target, (size * copies * 3 // n)::BIGINT AS taken, source, (copies * 3 // n)::BIGINT AS copies
FROM taken, generate_series(1, n // 3)
"""
