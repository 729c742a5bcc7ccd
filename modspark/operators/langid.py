"""Language identification with a character-trigram naive Bayes model.

A trigram is one number, its three code points. Tasks count the trigrams of their texts and
hand on one packed piece per range of trigrams, so nothing that is shuffled has a row per
occurrence. The model has one row per trigram with the counts of all languages that have
it: one look-up serves all languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark.functions.language import guarded
from modspark.functions.text import content_hash, normalize
from modspark.session import work_folder

SLICE_CHARS = 1 << 18
"""Texts are taken together up to this many characters; a longer one is a slice of its own."""
HELD_GRAMS = 1 << 21
"""A task counts trigrams in memory up to this many entries before it hands them on."""


def trigrams(text: Column) -> Column:
    """Overlapping trigrams of the lower-cased, normalised text, in one linear pass.

    Looks ahead over three characters and consumes one, so no match starts inside one.
    """
    return F.regexp_extract_all(lowered(text), F.lit(r"(?s)(?=(...))."), 1)


def lowered(text: Column) -> Column:
    return F.lower(normalize(text))


@dataclass(frozen=True)
class LanguageModel:
    """``grams``: ``range, gram, places, counts``, one row per trigram.

    ``languages`` and ``costs`` hold, in the order of a place, the names and what every
    trigram of a text costs in that language: the logarithm of its smoothed total. A
    trigram adds the logarithm of its smoothed count; what no language has adds nothing.
    ``entries`` are all counts of the table, which tell its size.
    """

    languages: list[str]
    costs: list[float]
    grams: DataFrame
    ranges: int
    entries: int


def coded(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, number of texts, a text's place among them for every trigram, trigram), slice by slice.

    Only one slice at a time leaves Arrow's memory.
    """
    ends = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SLICE_CHARS, side="right")))
        part = [t or "" for t in texts.slice(at, to - at).to_pylist()]
        points = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        owner = np.repeat(np.arange(len(part)), [len(t) for t in part])
        inside = np.flatnonzero(owner[2:] == owner[:-2]) if len(owner) > 2 else np.zeros(0, np.int64)
        yield at, len(part), owner[inside], (points[inside] << 42) | (points[inside + 1] << 21) | points[inside + 2]
        at = to


def range_of(grams: np.ndarray, ranges: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        spread = (grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    return (spread % np.uint64(ranges)).astype(np.int64)


def _cuts(where: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(range, from, to) of sorted range numbers."""
    heads = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1]))) if len(where) else np.zeros(0, int)
    for a, b in zip(heads, np.append(heads[1:], len(where)), strict=True):
        yield int(where[a]), int(a), int(b)


def _ranges(df: DataFrame) -> int:
    return 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def train(df: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Count all trigrams per language, with add-one smoothing over all trigrams seen.

    The counts are written once to the shared folder; the driver sees one row per language.
    Trigrams of texts without a language count as seen only.
    """
    spark, ranges = df.sparkSession, _ranges(df)
    languages = sorted(r[0] for r in df.select(lang).filter(F.col(lang).isNotNull()).distinct().collect())
    places = {x: i for i, x in enumerate(languages)}

    def pieces(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        place, gram = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        order = np.lexsort((gram, place))
        place, gram = place[order], gram[order]
        times = np.concatenate([h[2] for h in held])[order]
        heads = np.flatnonzero(np.concatenate(([True], (gram[1:] != gram[:-1]) | (place[1:] != place[:-1]))))
        place, gram, times = place[heads], gram[heads], np.add.reduceat(times, heads)
        where = range_of(gram, ranges)
        order = np.argsort(where, kind="stable")
        place, gram, times = place[order].astype(np.int32), gram[order], times[order]
        rows = [(r, place[a:b].tobytes(), gram[a:b].tobytes(), times[a:b].tobytes()) for r, a, b in _cuts(where[order])]
        return _batch(rows, ("range", "place", "gram", "times"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            place = np.array([places.get(x, -1) for x in batch.column(1).to_pylist()])
            for first, _, owner, gram in coded(batch.column(0)):
                if not len(gram):
                    continue
                known, back = np.unique(gram, return_inverse=True)
                own = place[first + owner]
                for p in np.unique(own):
                    times = np.bincount(back[own == p], minlength=len(known))
                    seen = np.flatnonzero(times)
                    held.append((np.full(len(seen), p), known[seen], times[seen]))
                    size += len(seen)
                if size >= HELD_GRAMS:
                    yield pieces(held)
                    held, size = [], 0
        if held:
            yield pieces(held)

    def gather(table: pa.Table) -> pa.Table:
        place, gram, times = (
            np.concatenate([np.frombuffer(x, kind) for x in table.column(c).to_pylist()])
            for c, kind in (("place", np.int32), ("gram", np.int64), ("times", np.int64))
        )
        order = np.lexsort((place, gram))
        place, gram, times = place[order], gram[order], times[order]
        heads = np.flatnonzero(np.concatenate(([True], (gram[1:] != gram[:-1]) | (place[1:] != place[:-1]))))
        place, gram, times = place[heads], gram[heads], np.add.reduceat(times, heads)
        rows = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
        named = np.cumsum(place >= 0)
        ends = np.concatenate((named[rows] - (place[rows] >= 0), [named[-1]])).astype(np.int32)
        kept = place >= 0
        return pa.table(
            {
                "range": pa.array(np.full(len(rows), table.column("range")[0].as_py()), pa.int32()),
                "gram": gram[rows],
                "places": pa.ListArray.from_arrays(ends, pa.array(place[kept], pa.int32())),
                "counts": pa.ListArray.from_arrays(ends, pa.array(times[kept], pa.int64())),
            }
        )

    path = work_folder(spark, "language-model")
    counted = df.select(lowered(F.col(text)).alias("text"), F.col(lang).alias("lang")).mapInArrow(
        count, "range int, place binary, gram binary, times binary"
    )
    schema = "range int, gram long, places array<int>, counts array<long>"
    counted.groupBy("range").applyInArrow(gather, schema).write.parquet(path)
    grams = spark.read.schema(schema).parquet(path)
    size, entries = grams.agg(F.count("*"), F.coalesce(F.sum(F.size("places")), F.lit(0))).first()
    cells = grams.select(F.inline(F.arrays_zip("places", "counts"))).toDF("place", "c")
    totals = {r["place"]: r["n"] for r in cells.groupBy("place").agg(F.sum("c").alias("n")).collect()}
    costs = [float(np.log(max(1, totals.get(i, 0) + size))) for i in range(len(languages))]
    return LanguageModel(languages, costs, grams, ranges, int(entries))


def _batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.binary()] * (len(names) - 1)]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=list(names))


@dataclass
class GramTable:
    """The rows of some trigrams: entry i's cells lie from start[i] to start[i + 1]."""

    gram: np.ndarray
    start: np.ndarray
    place: np.ndarray
    weight: np.ndarray

    @staticmethod
    def of(table: pa.Table) -> GramTable:
        gram = table.column("gram").to_numpy()
        order = np.argsort(gram)
        table = table.take(pa.array(order))
        places, counts = (table.column(c).combine_chunks() for c in ("places", "counts"))
        size = np.diff(np.asarray(places.offsets))
        place, count = (x.flatten().to_numpy(zero_copy_only=False) for x in (places, counts))
        return GramTable(gram[order], np.concatenate(([0], np.cumsum(size))), place, np.log(count + 1.0))

    @staticmethod
    def empty() -> GramTable:
        return GramTable(np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0))

    def sums(self, owner: np.ndarray, gram: np.ndarray, times: np.ndarray, texts: int, languages: int) -> np.ndarray:
        """texts x languages: what the trigrams add, each as often as it occurs."""
        if not len(self.gram) or not len(gram):
            return np.zeros((texts, languages))
        at = np.minimum(np.searchsorted(self.gram, gram), len(self.gram) - 1)
        known = self.gram[at] == gram
        at, owner, times = at[known], owner[known], times[known]
        n = self.start[at + 1] - self.start[at]
        cell = np.repeat(self.start[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        seat = np.repeat(owner, n) * languages + self.place[cell]
        return np.bincount(seat, np.repeat(times, n) * self.weight[cell], texts * languages).reshape(texts, languages)


def counted_grams(owner: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, trigram, times) of distinct trigrams of each text."""
    known, back = np.unique(gram, return_inverse=True)
    seat, times = np.unique(owner * max(1, len(known)) + back, return_counts=True)
    return seat // max(1, len(known)), known[seat % max(1, len(known))], times


def identify(
    df: DataFrame, model: LanguageModel, key: str, text: str = "text", broadcast_bytes: int = 32 << 20
) -> DataFrame:
    """``key, lang``, one row per key; "unknown" without trigrams.

    A model of at most ``broadcast_bytes`` goes to every task. Beyond that the texts' packed
    counts meet the model's rows range by range. Either way only sums per text are
    shuffled on the key.
    """
    if not model.languages:
        return df.groupBy(key).agg(F.lit("unknown").alias("lang"))
    small = 24 * model.entries <= broadcast_bytes
    sums = (_sums_by_broadcast if small else _sums_by_range)(df, model, key, text)
    width = range(len(model.languages))
    total = F.sum("n").alias("n")
    if len(width) <= 64:
        added = [F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in width]
        per_text = sums.groupBy(key).agg(total, *added).select(key, "n", F.array(*[f"s{i}" for i in width]).alias("s"))
    else:
        cells = sums.select(key, "n", F.posexplode("s").alias("place", "x")).groupBy(key, "place")
        cells = cells.agg(F.sum("x").alias("x"), total)
        listed = F.array_sort(F.collect_list(F.struct("place", "x")))["x"].alias("s")
        per_text = cells.groupBy(key).agg(F.max("n").alias("n"), listed)
    return per_text.select(key, F.coalesce(_best(model), F.lit("unknown")).alias("lang"))


def _sums_by_broadcast(df: DataFrame, model: LanguageModel, key: str, text: str) -> DataFrame:
    table = model.grams.sparkSession.sparkContext.broadcast(GramTable.of(model.grams.toArrow()))
    languages = len(model.languages)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = [], []
            for _, n, owner, gram in coded(batch.column(1)):
                found.append(table.value.sums(*counted_grams(owner, gram), n, languages))
                sizes.append(np.bincount(owner, minlength=n))
            if not found:
                continue
            yield _sums_batch(batch.column(0), np.concatenate(sizes), np.concatenate(found), key)

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key), lowered(F.col(text)).alias("__text")).mapInArrow(score, f"`{key}` {kind}, n long, s array<double>")


def _sums_batch(keys: pa.Array, n: np.ndarray, sums: np.ndarray, key: str) -> pa.RecordBatch:
    ends = pa.array(np.arange(len(n) + 1) * sums.shape[1], pa.int32())
    return pa.RecordBatch.from_arrays(
        [keys, pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(sums.ravel()))], names=[key, "n", "s"]
    )


def _sums_by_range(df: DataFrame, model: LanguageModel, key: str, text: str) -> DataFrame:
    ranges, languages = model.ranges, len(model.languages)
    field = df.schema[key]
    kind = field.dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, owner, gram in coded(batch.column(1)):
                keys = batch.column(0).slice(first, n)
                owner, gram, times = counted_grams(owner, gram)
                where = range_of(gram, ranges)
                order = np.argsort(where, kind="stable")
                owner, gram, times = owner[order], gram[order], times[order]
                rows = list(_cuts(where[order])) or [(0, 0, 0)]
                given = {r for r, _, _ in rows}
                if len(np.unique(owner)) < len(keys) and 0 not in given:
                    rows.append((0, 0, 0))  # texts without trigrams have a row somewhere too
                named, spans = [], []
                for r, a, b in rows:
                    own, back = np.unique(owner[a:b], return_inverse=True)
                    if r == 0:
                        own, back = np.arange(len(keys)), owner[a:b]
                    named.append(keys.take(pa.array(own)))
                    spans.append((r, back.astype(np.int64).tobytes(), gram[a:b].tobytes(), times[a:b].tobytes()))
                ends = np.concatenate(([0], np.cumsum([len(x) for x in named]))).astype(np.int32)
                packed = _batch(spans, ("range", "owner", "gram", "times"))
                listed = pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(named))
                yield pa.RecordBatch.from_arrays([*packed.columns, listed], names=["range", "owner", "gram", "times", "keys"])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a range's trigrams come first, then its pieces: one range of the model and one batch are held
        held: list[pa.Table] = []
        known, table = None, None
        for batch in batches:
            where, piece = batch.column("range").to_numpy(), batch.column("piece").to_numpy(zero_copy_only=False)
            for r, a, b in _cuts(where):
                if r != known:
                    held, known, table = [], r, None
                cut = a + int(np.searchsorted(piece[a:b], True))
                if cut > a:
                    held.append(pa.table({c: batch.column(c).slice(a, cut - a) for c in ("gram", "places", "counts")}))
                for i in range(cut, b):
                    if table is None:
                        table = GramTable.of(pa.concat_tables(held)) if held else GramTable.empty()
                        held = []
                    keys = batch.column("keys")[i].values
                    owner, gram, times = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in ("owner", "grams", "times"))
                    n = np.bincount(owner, times, len(keys)).astype(np.int64)
                    yield _sums_batch(keys, n, table.sums(owner, gram, times, len(keys), languages), key)

    counted = df.select(F.col(key), lowered(F.col(text)).alias("__text")).mapInArrow(
        count, f"range int, owner binary, gram binary, times binary, keys array<{kind}>"
    )
    pieces = counted.withColumnRenamed("gram", "grams").withColumn("piece", F.lit(True))
    both = model.grams.withColumn("piece", F.lit(False)).unionByName(pieces, allowMissingColumns=True)
    dealt = both.repartition("range").sortWithinPartitions("range", "piece")
    return dealt.mapInArrow(met, f"`{key}` {kind}, n long, s array<double>")


def _best(model: LanguageModel) -> Column:
    """Language with the greatest sum, first in order among equals; null without trigrams."""
    known = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("cost"), F.lit(x).alias("lang"))
                      for i, (c, x) in enumerate(zip(model.costs, model.languages, strict=True))])
    ranked = F.transform(
        known,
        lambda x: F.struct(
            (F.get("s", x["i"]) - F.col("n") * x["cost"]).alias("s"),
            (-x["i"]).alias("place"),
            x["lang"].alias("lang"),
        ),
    )
    return F.when(F.col("n") > 0, F.array_max(ranked)["lang"])


def with_language(df: DataFrame, model: LanguageModel, text: str = "text", lang: str = "lang") -> DataFrame:
    """``df`` with a guarded language column; copies of a text are identified once.

    Hashes, not texts, meet the languages again.
    """
    hashed = df.drop(lang).withColumn("_hash", content_hash(F.col(text)))
    once = hashed.groupBy("_hash").agg(F.first(text, ignorenulls=True).alias("_text"))
    found = identify(once, model, "_hash", "_text").withColumnRenamed("lang", "_found")
    joined = hashed.join(found.withColumnRenamed("_hash", "_known"), F.col("_hash").eqNullSafe(F.col("_known")), "left")
    return joined.select(*[c for c in df.columns if c != lang], guarded(F.col(text), F.col("_found")).alias(lang))
