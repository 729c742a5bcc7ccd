"""Set-similarity join on word shingles with token-combination prefixes.

Two sets that are similar enough share a token near the front of any common order, so only
a prefix of each set is indexed. Tokens are ordered by class: those of one document only,
rare ones, frequent ones. Rare tokens are indexed one by one. When all that two sets share
is frequent, the prefix is extended until two common tokens must be neighbours in both
sets, and such 2-token combinations are indexed instead. Candidates pass a bound on length
and position and are then verified on their whole sets.

Classes come from exact document counts of all shingles, kept in two Bloom filters of a
fixed size. A false positive puts a token into another class, the same one everywhere: it
can cost work, never a link.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modspark.llm.components import components
from modspark.llm.store import saved
from modspark.llm.words import factors, mix, run_hashes, word_slices

FLUSH_SHINGLES = 2_000_000
"""A task counts shingles in memory up to this many before it hands them on."""
FETCHES = 4
"""The driver gets the filters' segments in so many jobs."""


@dataclass(frozen=True)
class JaccardJoin:
    """Parameters of the join.

    Similarity is at least ``at_least`` hundredths; sets are ``shingle``-word runs. Tokens
    of more than ``frequent`` documents are indexed in combinations. ``filter_bytes`` is
    the size of the broadcast token filters, whatever the size of the corpus. A set that is
    compared with more than ``pairs_a_part`` others is dealt out to several tasks. Links are
    counted in blocks of about ``block_sets`` sets and ``block_bytes`` of text at most.
    """

    at_least: int = 85
    shingle: int = 4
    frequent: int = 64
    filter_bytes: int = 16 << 20
    pairs_a_part: int = 128
    block_sets: int = 256
    block_bytes: int = 8 << 20

    def required(self, n: np.ndarray | int) -> np.ndarray | int:
        """Least overlap of a set of n tokens with any similar set."""
        return -(-self.at_least * n // 100)


class TokenFilter:
    """Two Bloom filters (several documents, frequent), one segment per range of hashes."""

    def __init__(self, bits: int, ranges: int, segments: Iterable[tuple[int, bytes]]):
        self.shift = np.uint64(64 - (ranges.bit_length() - 1)) if ranges > 1 else None
        self.bits = bits
        self.table = np.zeros(ranges * bits // 8, np.uint8)
        for at, raw in segments:
            self.table[at * bits // 8 : (at + 1) * bits // 8] = np.frombuffer(raw, np.uint8)

    @staticmethod
    def places(suffix: np.ndarray, bits: int, kind: int) -> list[np.ndarray]:
        spread = mix(suffix.astype(np.uint64) + np.uint64(kind << 40))
        return [(spread >> np.uint64(s)) % np.uint64(bits) for s in (0, 21)]

    @staticmethod
    def segment(suffix: np.ndarray, count: np.ndarray, bits: int, frequent: int) -> bytes:
        flags = np.zeros(bits, np.uint8)
        for kind, chosen in enumerate((suffix[count > 1], suffix[count > frequent])):
            for place in TokenFilter.places(chosen, bits, kind):
                flags[place] = 1
        return np.packbits(flags, bitorder="little").tobytes()

    def classes(self, tokens: np.ndarray) -> np.ndarray:
        """0 for tokens of one document, 1 for rare, 2 for frequent ones."""
        which = ranges_of(tokens, self.shift)
        out = np.zeros(len(tokens), np.int8)
        inside = np.arange(len(tokens))
        for kind in (0, 1):
            suffix, base = suffix_of(tokens[inside]), which[inside] * self.bits
            found = np.ones(len(inside), bool)
            for place in self.places(suffix, self.bits, kind):
                at = base + place.astype(np.int64)
                found &= (self.table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
            inside = inside[found]
            out[inside] = kind + 1
        return out


def ranges_of(tokens: np.ndarray, shift: np.uint64 | None) -> np.ndarray:
    return (tokens >> shift).astype(np.int64) if shift is not None else np.zeros(len(tokens), np.int64)


def suffix_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def shingle_sets(texts: pa.Array, shingle: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, tokens, bounds) slice by slice: sorted distinct shingles of every text."""
    for words in word_slices(texts):
        runs, at = run_hashes(words.hashes(), words.first, shingle)
        text = np.repeat(np.arange(len(at) - 1), np.diff(at))
        order = np.lexsort((runs, text))
        runs, text = runs[order], text[order]
        new = np.ones(len(runs), bool)
        new[1:] = (runs[1:] != runs[:-1]) | (text[1:] != text[:-1])
        yield words.rows.start, runs[new], np.searchsorted(text[new], np.arange(len(at)))


def token_filter(docs: DataFrame, settings: JaccardJoin) -> TokenFilter:
    """Count the documents of every shingle and keep the classes as fixed-size filters.

    Tasks count their own texts first and hand on one packed piece per range of hashes
    (32-bit suffixes and counts up to 255), so a shingle of a third of all documents is one
    entry per piece. Each range is summed by itself; only filter segments reach the driver.
    """
    spark = docs.sparkSession
    ranges = 1 << max(3, (2 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    bits = max(1 << 10, settings.filter_bytes * 8 // ranges // 8 * 8)
    shingle, frequent = settings.shingle, settings.frequent
    shift = np.uint64(64 - (ranges.bit_length() - 1))

    def pieces(parts: list[np.ndarray]) -> pa.RecordBatch:
        tokens, count = np.unique(np.concatenate(parts), return_counts=True)
        cut = np.searchsorted(ranges_of(tokens, shift), np.arange(ranges + 1))
        suffix, count = suffix_of(tokens), np.minimum(count, 255).astype(np.uint8)
        rows = [
            (r, suffix[i:j].tobytes() + count[i:j].tobytes())
            for r, (i, j) in enumerate(zip(cut[:-1], cut[1:], strict=True))
            if j > i
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([r for r, _ in rows], pa.int32()), pa.array([p for _, p in rows], pa.binary())],
            names=["range", "piece"],
        )

    def count_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, tokens, _ in shingle_sets(batch.column(0), shingle):
                held.append(tokens)
                size += len(tokens)
                if size >= FLUSH_SHINGLES:
                    yield pieces(held)
                    held, size = [], 0
        if size:
            yield pieces(held)

    def sum_range(table: pa.Table) -> pa.Table:
        suffixes, counts = [], []
        for piece in table.column("piece"):
            raw = np.frombuffer(piece.as_buffer(), np.uint8)
            n = len(raw) // 5
            suffixes.append(raw[: 4 * n].view(np.uint32))
            counts.append(raw[4 * n :])
        suffix, count = np.concatenate(suffixes), np.concatenate(counts)
        order = np.argsort(suffix, kind="stable")
        suffix, count = suffix[order], count[order]
        heads = np.flatnonzero(np.concatenate(([True], suffix[1:] != suffix[:-1])))
        total = np.add.reduceat(count.astype(np.int64), heads)
        segment = TokenFilter.segment(suffix[heads], total, bits, frequent)
        return pa.table({"range": table.column("range")[:1], "segment": pa.array([segment], pa.binary())})

    counted = docs.select("text").mapInArrow(count_own, "range int, piece binary")
    # written first: the driver's iterator runs a job for every partition, one after the other
    segments = saved(counted.groupBy("range").applyInArrow(sum_range, "range int, segment binary")).coalesce(FETCHES)
    return TokenFilter(bits, ranges, ((r["range"], r["segment"]) for r in segments.toLocalIterator()))


def prefix_keys(
    tokens: np.ndarray, classes: np.ndarray, settings: JaccardJoin
) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of one set and the position that each stands for.

    The position of a rare token is its rank; that of a combination is the rank of the
    first frequent token, since it only matters when nothing before is shared.
    """
    n = len(tokens)
    need = settings.required(n)
    if 100 * n < settings.at_least * (n + 1):
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)  # only an equal set is similar
    single, rare = int((classes == 0).sum()), tokens[classes == 1]
    ranks = single + np.arange(len(rare))
    inside = ranks <= n - need
    keys, places = [mix(rare[inside])], [ranks[inside]]
    frequent = tokens[classes == 2]
    if len(frequent) >= need:
        others = n - len(frequent)
        differ = n * (100 - settings.at_least) // settings.at_least - others
        far = differ + 2 + min(len(frequent) - need, differ)
        head = frequent[:far]
        by = factors(2, salt=11)
        with np.errstate(over="ignore"):
            pairs = mix(head[:-1] * by[0] + head[1:] * by[1] + np.uint64(1))
        keys.append(pairs)
        places.append(np.full(len(pairs), others))
    return np.concatenate(keys), np.concatenate(places).astype(np.int32)


def indexed(docs: DataFrame, settings: JaccardJoin) -> DataFrame:
    """doc_id, text_key, n, sig, keys, places, text: every document with its set's size, signature and keys.

    Texts stay only where a set has keys, that is, may be similar to another one.
    """
    spark = docs.sparkSession
    filters = spark.sparkContext.broadcast(token_filter(docs, settings))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = filters.value
        for batch in batches:
            texts = batch.column(1)
            for row, tokens, at in shingle_sets(texts, settings.shingle):
                n = np.diff(at)
                classes = known.classes(tokens)
                sums = [
                    np.add.reduceat(np.append(x, np.uint64(0)), at[:-1]) * (n > 0)
                    for x in (mix(tokens), mix(tokens ^ np.uint64(0x5DEECE66D)))
                ]
                keys, places, kept = [], [], []
                for i in range(len(n)):
                    part = slice(at[i], at[i + 1])
                    k, p = prefix_keys(tokens[part], classes[part], settings)
                    keys.append(k.view(np.int64))
                    places.append(p)
                    kept.append(texts[row + i].as_py() if len(k) else None)
                signs = [a.tobytes() + b.tobytes() for a, b in zip(*sums, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(n)),
                        batch.column(2).slice(row, len(n)),
                        pa.array(n, pa.int64()),
                        pa.array(signs, pa.binary()),
                        pa.array(keys, pa.list_(pa.int64())),
                        pa.array(places, pa.list_(pa.int32())),
                        pa.array(kept, pa.string()),
                    ],
                    names=["doc_id", "text_key", "n", "sig", "keys", "places", "text"],
                )

    table = saved(
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
            index, "doc_id long, text_key long, n long, sig binary, keys array<long>, places array<int>, text string"
        )
    )
    filters.destroy()
    return table


def reachable(settings: JaccardJoin, n: str, p: str, m: str, q: str) -> F.Column:
    """Whether sets of n and m tokens whose first common token has rank p and q can be similar."""
    t = settings.at_least
    return F.expr(f"(100 + {t}) * least({n} - {p}, {m} - {q}) >= {t} * ({n} + {m})")


def verified(pairs: DataFrame, texts: DataFrame, settings: JaccardJoin) -> DataFrame:
    """The pairs (a, b) of signatures whose sets are similar, compared on the whole texts."""
    t, shingle = settings.at_least, settings.shingle

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = (tokens[at[i] : at[i + 1]] for _, tokens, at in shingle_sets(batch.column(2), shingle) for i in range(len(at) - 1))
            right = (tokens[at[i] : at[i + 1]] for _, tokens, at in shingle_sets(batch.column(3), shingle) for i in range(len(at) - 1))
            alike = []
            for x, y in zip(left, right, strict=True):
                both = np.concatenate((x, y))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                alike.append(100 * common >= t * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], names=["a", "b"]
            ).filter(pa.array(alike, pa.bool_()))

    ends = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    used = texts.join(ends, "sig", "left_semi").dropDuplicates(["sig"])
    # a set that very many are compared with is dealt out in parts, its text once to each
    load = pairs.groupBy("a").agg(F.ceil(F.count("*") / settings.pairs_a_part).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part")
    dealt = pairs.join(load, "a").select("a", "b", part)
    with_b = dealt.join(used.select(F.col("sig").alias("b"), F.col("text").alias("text_b")), "b")
    centres = load.join(used.withColumnRenamed("sig", "a"), "a").select(
        "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("text").alias("text_a")
    )
    with_a = with_b.join(centres, ["a", "part"])
    return saved(with_a.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a binary, b binary"))


def links(table: DataFrame, settings: JaccardJoin) -> DataFrame:
    """(a, b): links between different sets that connect all that is connected, the first round's as stars.

    First every key's members are compared with the member whose keyed position is the
    least. Then, in keys whose members still lie in several components, the pairs across
    components that can be similar and were not compared yet. Pairs inside a component
    cannot change it, so copies of copies are not expanded.
    """
    texts = table.filter("text is not null").select("sig", "text")
    entry = F.explode(F.arrays_zip("keys", "places")).alias("e")
    index = saved(
        table.filter("text is not null")
        .select("sig", "n", entry)
        .select(F.col("e.keys").alias("key"), "sig", "n", F.col("e.places").alias("p"))
        .groupBy("key", "sig")
        .agg(F.first("n").alias("n"), F.min("p").alias("p"))
    )
    centre = (
        index.groupBy("key")
        .agg(F.min(F.struct("p", "sig", "n")).alias("c"), F.count("*").alias("members"))
        .filter("members > 1")
    )
    starred = index.join(centre, "key").filter("sig <> c.sig").filter(
        reachable(settings, "n", "p", "c.n", "c.p")
    )
    first = saved(_pairs(starred, "sig", "c.sig"))
    found = verified(first, texts, settings)
    group = components(found)

    labelled = index.join(group, index["sig"] == group["node"], "left").select(
        "key", "sig", "n", "p", F.coalesce("label", "sig").alias("label")
    )
    t = settings.at_least
    spread = labelled.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.min("n").alias("short")
    )
    # a member too far down to be similar even to the shortest other set adds nothing
    open_rows = labelled.join(spread.filter("low <> high"), "key").filter(
        F.expr(f"(100 + {t}) * (n - p) >= {t} * (n + greatest(short, n * {t} div 100))")
    )
    still = open_rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    rest = saved(
        open_rows.select("key", "sig", "n", "p", "label").join(still.filter("lo <> hi").select("key"), "key", "left_semi")
    )
    x, y = rest.alias("x"), rest.alias("y")
    crossing = x.join(y, F.expr("x.key = y.key and x.sig < y.sig and x.label <> y.label")).filter(
        reachable(settings, "x.n", "x.p", "y.n", "y.p")
    )
    second = _pairs(crossing, "x.sig", "y.sig").join(first, ["a", "b"], "left_anti")
    stars = group.filter("node <> label").select(F.col("label").alias("a"), F.col("node").alias("b"))
    return stars.union(verified(saved(second), texts, settings))


def _pairs(frame: DataFrame, a: str, b: str) -> DataFrame:
    return frame.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


COLUMNS = 4096
"""Shingles of a block that are multiplied at a time."""


def common_counts(tokens: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many tokens every left set has in common with every right one."""
    _, place, times = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(tokens)), [len(x) for x in tokens])
    shared = np.flatnonzero(times[place] > 1)
    shared = shared[np.argsort(place[shared], kind="stable")]
    owner, place = owner[shared], (np.cumsum(times > 1) - 1)[place[shared]]
    common = np.zeros((len(left), len(right)))
    for first in range(0, int(place[-1]) + 1 if len(place) else 0, COLUMNS):
        a, b = np.searchsorted(place, (first, first + COLUMNS))
        holds = np.zeros((len(tokens), COLUMNS), np.float32)
        holds[owner[a:b], place[a:b] - first] = 1
        common += holds[left] @ holds[right].T
    return common


def link_counts(group: DataFrame, texts: DataFrame, settings: JaccardJoin) -> DataFrame:
    """(sig, n_links): for every linked set the number of different sets similar to it.

    All links of a set lie in its component. Components of two sets have one; in larger ones
    all sets are compared with all, a block of sets with a block, and every block's part in
    the counts is summed. Texts travel once per block of their component, pairs never do.
    """
    t, shingle = settings.at_least, settings.shingle
    members = texts.dropDuplicates(["sig"]).join(group, F.col("sig") == F.col("node")).select("label", "sig", "text")
    load = members.groupBy("label").agg(
        F.count("*").alias("members"),
        F.greatest(F.ceil(F.count("*") / settings.block_sets), F.ceil(F.sum(F.octet_length("text")) / settings.block_bytes)).cast("int").alias("parts"),
    )
    part = F.pmod(F.xxhash64("sig"), F.col("parts")).cast("int").alias("part")
    dealt = members.join(load.filter("members > 2"), "label").select("label", "sig", "text", part, "parts")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    dealt = dealt.select("label", "sig", "text", "part", other).select(
        "label", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "sig", "text"
    )

    def count(table: pa.Table) -> pa.Table:
        i, j = (table.column(c)[0].as_py() for c in ("i", "j"))
        own = table.column("part").to_numpy()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        cut = shingle_sets(table.column("text").combine_chunks(), shingle)
        sets = [tokens[at[k] : at[k + 1]] for _, tokens, at in cut for k in range(len(at) - 1)]
        n = np.array([len(x) for x in sets])
        common = common_counts(sets, left, right)
        alike = 100 * common >= t * (n[left][:, None] + n[right][None, :] - common)
        if i == j:
            np.fill_diagonal(alike, False)
        found = np.zeros(len(sets), np.int64)
        found[left] = alike.sum(axis=1)
        if i != j:
            found[right] = alike.sum(axis=0)
        return pa.table({"sig": table.column("sig"), "n_links": pa.array(found)})

    counted = dealt.groupBy("label", "i", "j").applyInArrow(count, "sig binary, n_links long")
    pairs = group.join(load.filter("members = 2"), "label").select(F.col("node").alias("sig"), F.lit(1).cast("long").alias("n_links"))
    return counted.union(pairs).groupBy("sig").agg(F.sum("n_links").alias("n_links"))


def similar_documents(docs: DataFrame, settings: JaccardJoin = JaccardJoin(), count_links: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id, set_id, n_links, group_id, text_key for every row of docs(doc_id, text).

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. A null or blank
    text has no shingles and links with nothing; fewer words than a shingle make one
    shingle. Rows with equal sets are linked; repeated rows come out as often as they came
    in. component_id is the smallest doc_id reachable (null ids are passed over), n_links
    counts all different sets that are similar to the row's set (null if ``count_links`` is
    false), group_id names the component whatever the ids. Other columns of docs are ignored. An empty table gives an empty result.
    """
    table = indexed(docs, settings)
    group = saved(components(links(table, settings)))
    if count_links:
        degree = link_counts(group, table.filter("text is not null").select("sig", "text"), settings)
    else:
        degree = table.sparkSession.createDataFrame([], "sig binary, n_links long")
    zero = F.lit(0 if count_links else None).cast("long")
    # classes of equal sets first: a large class is one row in what follows
    classes = table.filter("n > 0").groupBy("sig").agg(F.min("doc_id").alias("least"))
    classes = classes.join(group, classes["sig"] == group["node"], "left").select(
        "sig", "least", F.coalesce("label", "sig").alias("label")
    )
    whole = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    named = classes.join(whole, "label").join(degree, "sig", "left").select(
        "sig", F.hex("label").alias("group_id"), "component_id", F.coalesce("n_links", zero).alias("n_links")
    )
    rows = table.select("doc_id", "text_key", "n", F.when(F.col("n") > 0, F.col("sig")).alias("sig"))
    empty = rows.filter("sig is null").select(
        "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.lit(None).cast("string").alias("set_id"), zero.alias("n_links"), F.lit(None).cast("string").alias("group_id"), "text_key",
    )
    full = rows.filter("sig is not null").join(named, "sig").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.hex("sig").alias("set_id"), "n_links", "group_id", "text_key"
    )
    return full.unionByName(empty)


def one_of_each(docs: DataFrame, settings: JaccardJoin = JaccardJoin()) -> DataFrame:
    """The rows of docs with one document of every component, the one with the smallest doc_id.

    Documents without words belong to no component and all stay. Of rows that agree in
    doc_id and text one stays.
    """
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    found = similar_documents(docs.filter(has_words), settings, count_links=False)
    first = found.groupBy("group_id").agg(
        F.min_by(F.struct("doc_id", "text_key"), F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)), "text_key")).alias("r")
    )
    chosen = first.select(F.col("r.doc_id").alias("__id"), F.col("r.text_key").alias("__key"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key"))
    rows = docs.filter(has_words).join(chosen, same, "left_semi")
    repeat = F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id"))
    rows = rows.withColumn("__repeat", repeat).filter("__repeat = 1").drop("__repeat")
    return rows.unionByName(docs.filter(~has_words))
