"""Language-model scoring from a log-frequency Bloom filter.

The filter holds unigrams and bigrams of the training texts with their counts on a
logarithmic scale: an n-gram of level q is entered q times, as (n-gram, 1) to (n-gram, q),
and its level is found by probing until an entry is missing. Conditional probabilities are
smoothed towards the unigram distribution with a constant mass.

Work goes in three steps. Tasks cut texts into blocks and hand on packed word lists and
word-pair lists by range of hashes. Every range sums its n-grams, fills a segment of the
filter, probes it for the blocks and replies with levels (and exact counts of words). Then
every block scores its texts with the exact counts (base) and the levels (model). A segment
has at least ``entry_bits`` bits for each of its entries and lives only in its range's task,
so the rate of false hits does not rise with the corpus and nothing is broadcast.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modspark.llm.store import saved
from modspark.llm.words import factors, mix, word_slices

BLOCK_WORDS = 1_000_000
"""Words of one block; a block ends with the text that reaches it."""
END = np.uint64(0x454E44)
"""The token that ends every text."""


@dataclass(frozen=True)
class BloomModel:
    """Parameters: least bytes of the two filters, probes per level, base of the scale,
    smoothing mass, least bits for each entry of a filter."""

    unigram_bytes: int = 16 << 20
    bigram_bytes: int = 64 << 20
    probes: int = 3
    base: float = 1.5
    mass: float = 50.0
    add: float = 0.1
    entry_bits: int = 16

    def level(self, count: np.ndarray) -> np.ndarray:
        return 1 + np.floor(np.log(count) / np.log(self.base) + 1e-9).astype(np.int64)

    def middles(self, levels: int) -> np.ndarray:
        """The count that stands for a level: the mean of the whole numbers on it."""
        ends = np.ceil(self.base ** np.arange(levels + 1) - 1e-9)
        return np.concatenate(([0.0], np.maximum((ends[:-1] + ends[1:] - 1) / 2, ends[:-1])))


MOST_LEVELS = 64


class Segment:
    """A Bloom filter of the (n-gram, level) entries of one range of hashes, one byte a bit."""

    def __init__(self, model: BloomModel, least_bytes: int, ranges: int, keys: np.ndarray, count: np.ndarray):
        """Every n-gram is entered on all levels up to its own."""
        self.model = model
        level = model.level(count)
        self.bits = max(1 << 10, least_bytes * 8 // ranges, model.entry_bits * int(level.sum()))
        self.flags = np.zeros(self.bits, bool)
        for q in range(1, int(level.max(initial=0)) + 1):
            inside = keys[level >= q]
            for i in range(model.probes):
                self.flags[probe(inside, q, self.bits, i)] = True
        self.false_rate = float(np.count_nonzero(self.flags) / self.bits) ** model.probes

    def levels(self, keys: np.ndarray) -> np.ndarray:
        level = np.zeros(len(keys), np.uint8)
        inside = np.arange(len(keys))
        for q in range(1, MOST_LEVELS):
            for i in range(self.model.probes):
                inside = inside[self.flags[probe(keys[inside], q, self.bits, i)]]
            if not len(inside):
                break
            level[inside] = q
        return level


def estimates(levels: np.ndarray, false_rate: float, model: BloomModel) -> np.ndarray:
    """Counts for found levels, each its own plus a geometric number of false ones.

    The mean over the false levels is the middle of the true one, but for n-grams never
    seen, whose estimate cannot be below zero.
    """
    middles = model.middles(MOST_LEVELS)
    return np.maximum((middles[:-1] - false_rate * middles[1:]) / (1.0 - false_rate), 0.0)[levels]


def range_bits(ranges: int) -> int:
    return ranges.bit_length() - 1


def suffixes(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The 32 bits after those of the range: sorted as the keys are."""
    return (keys << np.uint64(range_bits(ranges))) >> np.uint64(32)


def probe(suffix: np.ndarray, level: int, bits: int, i: int) -> np.ndarray:
    """The i-th place of (n-gram, level) in a segment."""
    return (mix(suffix + np.uint64((level << 40) + (i << 33))) % np.uint64(bits)).astype(np.int64)


def bigrams(tokens: np.ndarray, before: np.ndarray) -> np.ndarray:
    by = factors(2, salt=13)
    with np.errstate(over="ignore"):
        return mix(tokens * by[0] + before * by[1] + np.uint64(1))


def token_slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, token hashes with ends, bounds) slice by slice."""
    for words in word_slices(texts):
        first = words.first + np.arange(len(words.first))
        tokens = np.full(int(first[-1]), END, np.uint64)
        inside = np.ones(len(tokens), bool)
        inside[first[1:] - 1] = False
        tokens[inside] = words.hashes()
        yield words.rows.start, tokens, first


def inner(bounds: np.ndarray) -> np.ndarray:
    """Places of all tokens but the first of every text."""
    follows = np.ones(int(bounds[-1]), bool)
    follows[bounds[:-1]] = False
    return np.flatnonzero(follows)


def by_range(keys: np.ndarray, ranges: int) -> np.ndarray:
    shift = np.uint64(64 - range_bits(ranges))
    return np.searchsorted(keys >> shift, np.arange(ranges + 1, dtype=np.uint64))


def packed(array: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, then compressed: small numbers take little."""
    planes = np.ascontiguousarray(array.view(np.uint8).reshape(len(array), -1).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(raw: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    plain = pa.decompress(raw, n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(plain, np.uint8).reshape(size, n).T).view(kind).ravel()


BLOCK = "kind int, block string, range int, doc_id long, held_out boolean, n int, piece binary, counts binary"


def blocks(docs: DataFrame, ranges: int) -> DataFrame:
    """Three kinds of rows: a text as packed places in its block's sorted word list (0), a part
    of that list with the words' counts in training texts (1), and a part of the block's
    sorted word pairs, as steps between suffixes, with theirs (2)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, parts, size = [], [], [], 0
        for batch in batches:
            for row, tokens, at in token_slices(batch.column(2)):
                n = len(at) - 1
                ids += batch.column(0).slice(row, n).to_pylist()
                held += batch.column(1).slice(row, n).to_pylist()
                parts += [tokens[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]
                size += len(tokens)
                if size >= BLOCK_WORDS:
                    yield block(ids, held, parts)
                    ids, held, parts, size = [], [], [], 0
        if parts:
            yield block(ids, held, parts)

    def block(ids: list, held: list, parts: list[np.ndarray]) -> pa.RecordBatch:
        name, lengths = uuid.uuid4().hex, [len(p) for p in parts]
        words, place = np.unique(np.concatenate(parts), return_inverse=True)
        place = place.astype(np.uint32)
        training = np.repeat(~np.array(held, bool), lengths)
        count = np.bincount(place[training], minlength=len(words)).astype(np.uint32)
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        rows = [
            (0, name, None, i, h, n, packed(place[a : a + n]), None)
            for i, h, n, a in zip(ids, held, lengths, bounds[:-1], strict=True)
        ]
        cuts = by_range(words, ranges)
        rows += [
            (1, name, r, None, None, int(b - a), words[a:b].tobytes(), packed(count[a:b]))
            for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
            if b > a
        ]
        at = inner(bounds)
        pairs, which = np.unique(bigrams(words[place[at]], words[place[at - 1]]), return_inverse=True)
        count = np.bincount(which[training[at]], minlength=len(pairs)).astype(np.uint32)
        cuts, suffix = by_range(pairs, ranges), suffixes(pairs, ranges).astype(np.uint32)
        rows += [
            (2, name, r, None, None, int(b - a), packed(np.diff(suffix[a:b], prepend=np.uint32(0))), packed(count[a:b]))
            for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
            if b > a
        ]
        kinds = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.binary()]
        names = [x.split()[0] for x in BLOCK.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return saved(docs.select("doc_id", "held_out", "text").mapInArrow(cut, BLOCK))


REPLY = "block string, range int, n int, counts binary, levels binary, rate double, tokens long, vocabulary long"


def counted(parts: DataFrame, ranges: int, model: BloomModel, least_bytes: int, words: bool) -> DataFrame:
    """Replies (block, range, n, levels, rate) to every part of words or word pairs; to words also
    their exact counts, and per range one row (block null) with its totals."""

    def keys_of(piece: pa.Scalar, n: int) -> np.ndarray:
        if words:
            return np.frombuffer(piece.as_buffer(), np.uint64)
        return np.cumsum(unpacked(piece.as_py(), n, np.uint32), dtype=np.uint64)

    def count(table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_pylist()
        keys = np.concatenate([keys_of(p, n) for p, n in zip(table.column("piece"), sizes, strict=True)])
        own = np.concatenate([unpacked(c.as_py(), n, np.uint32) for c, n in zip(table.column("counts"), sizes, strict=True)])
        distinct, place = np.unique(keys, return_inverse=True)
        total = np.bincount(place, weights=own, minlength=len(distinct))
        seen = total > 0
        suffix = suffixes(distinct, ranges) if words else distinct
        part = Segment(model, least_bytes, ranges, suffix[seen], total[seen])
        level = part.levels(suffix)
        ends = np.cumsum([0, *sizes])
        cut = [place[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        name = table.column("block").to_pylist()
        extra = 1 if words else 0
        r = table.column("range")[0].as_py()
        return pa.table(
            {
                "block": pa.array([*name, *[None] * extra], pa.string()),
                "range": pa.array([r] * (len(name) + extra), pa.int32()),
                "n": pa.array([*sizes, *[0] * extra], pa.int32()),
                "counts": pa.array([packed(total[c].astype(np.uint64)) if words else None for c in cut] + [None] * extra, pa.binary()),
                "levels": pa.array([packed(level[c]) for c in cut] + [None] * extra, pa.binary()),
                "rate": pa.array([part.false_rate] * (len(name) + extra), pa.float64()),
                "tokens": pa.array([None] * len(name) + [int(total.sum())] * extra, pa.int64()),
                "vocabulary": pa.array([None] * len(name) + [int(seen.sum())] * extra, pa.int64()),
            }
        )

    return saved(parts.select("block", "range", "n", "piece", "counts").groupBy("range").applyInArrow(count, REPLY))


def scored(docs: DataFrame, held_out: F.Column, model: BloomModel = BloomModel()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs.

    Learns from the rows whose ``held_out`` is false, scores all. A null text is empty: one
    token, the end. Rows repeat as they come; equal texts get equal scores. Without any
    training row the base is uniform over the one unknown word. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "text")
    ranges = 1 << max(3, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    cut = blocks(rows, ranges)
    one = counted(cut.filter("kind = 1"), ranges, model, model.unigram_bytes, words=True)
    two = counted(cut.filter("kind = 2"), ranges, model, model.bigram_bytes, words=False)
    sums = one.filter("block is null").agg(F.sum("tokens"), F.sum("vocabulary")).first()
    n_train, vocabulary = int(sums[0] or 0), int(sums[1] or 0)
    norm = n_train + model.add * (vocabulary + 1)

    def found(replies: pa.Table) -> np.ndarray:
        parts = zip(replies.column("levels"), replies.column("n").to_pylist(), replies.column("rate").to_pylist(), strict=True)
        return np.concatenate([np.zeros(0), *(estimates(unpacked(p.as_py(), n, np.uint8), rate, model) for p, n, rate in parts)])

    def score(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        texts = table.filter(pa.array(kind == 0))
        lists, replies, both = (table.filter(pa.array(kind == k)).sort_by("range") for k in (1, 2, 3))
        word = np.concatenate([np.frombuffer(p.as_buffer(), np.uint64) for p in lists.column("piece")])
        count = np.concatenate(
            [unpacked(c.as_py(), n.as_py(), np.uint64) for c, n in zip(replies.column("counts"), replies.column("n"), strict=True)]
        )
        base = np.log10(count + model.add)
        estimate = found(replies)
        unigram = (estimate + model.add) / norm
        sizes = texts.column("n").to_numpy().astype(np.int64)
        place = np.concatenate([unpacked(p.as_py(), n, np.uint32) for p, n in zip(texts.column("piece"), sizes.tolist(), strict=True)])
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        first, at = bounds[:-1], inner(bounds)
        chance = unigram[place]
        before, now = place[at - 1], place[at]
        # the block's pairs in the order of its parts
        _, back = np.unique(bigrams(word[now], word[before]), return_inverse=True)
        # a pair can only have been seen if both its words were
        seen = np.minimum(np.minimum(estimate[now], estimate[before]), found(both)[back])
        chance[at] = (seen + model.mass * unigram[now]) / (estimate[before] + model.mass)
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "held_out": texts.column("held_out"),
                "n_tokens": pa.array(sizes),
                "n_known": pa.array(np.add.reduceat((count[place] > 0).astype(np.int64), first)),
                "train_tokens": pa.array(np.full(len(sizes), n_train, np.int64)),
                "base_score": pa.array(np.add.reduceat(base[place], first) - sizes * np.log10(norm)),
                "score": pa.array(np.add.reduceat(np.log10(chance), first)),
            }
        )

    none = lambda kind: F.lit(None).cast(kind)
    texts = cut.filter("kind < 2").select(
        "kind", "block", "range", "doc_id", "held_out", "n", "piece", none("binary").alias("counts"), none("binary").alias("levels"), none("double").alias("rate")
    )
    replies = [
        frame.filter("block is not null").select(
            F.lit(kind).alias("kind"), "block", "range", none("long").alias("doc_id"), none("boolean").alias("held_out"),
            "n", none("binary").alias("piece"), "counts", "levels", "rate",
        )
        for kind, frame in ((2, one), (3, two))
    ]
    return texts.union(replies[0]).union(replies[1]).groupBy("block").applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
