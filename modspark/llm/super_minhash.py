"""Near-duplicate groups by SuperMinHash signatures, banding, verification and union-find.

Every element of a set walks through its own random permutation of the signature's places
and offers step + random fraction at the place it reaches; a place keeps its least offer. The
places of one element are thus correlated, which lowers the variance of the estimate,
and a set is done as soon as no later step can be the least anywhere: early for large sets.
(O. Ertl, "SuperMinHash - A New Minwise Hashing Algorithm for Jaccard Similarity Estimation".)

Equal sets are one from the start. Sets that agree in a whole band are candidates: first
every band key's members with one of them, then those of a key that still lie in different
groups, block by block. All are confirmed on their full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modspark.llm.components import UnionFind
from modspark.llm.components import components as grouped
from modspark.llm.jaccard_join import common_counts, shingle_sets
from modspark.llm.store import saved
from modspark.llm.words import factors, mix

FRACTION = np.uint64(40)
"""Bits of an offer's random fraction; the step stands above them."""


@dataclass(frozen=True)
class SuperMinHash:
    """Parameters.

    Sets of ``shingle``-word runs with a similarity of at least ``at_least`` hundredths are
    linked. ``bands`` of ``rows`` places each miss a pair of similarity s with a probability
    of (1 - s^rows)^bands: 4e-7 at 0.80, less above. Candidates of the second kind are compared
    on their sets if their signatures agree in at least ``agree`` hundredths of the places
    (seven standard deviations below 0.80). Members of a key are compared in blocks of ``block``.
    """

    at_least: int = 80
    shingle: int = 2
    bands: int = 28
    rows: int = 4
    agree: int = 54
    block: int = 256

    @property
    def places(self) -> int:
        return self.bands * self.rows


def signatures(tokens: np.ndarray, at: np.ndarray, places: int) -> np.ndarray:
    """The signature of every set tokens[at[i]:at[i + 1]]; that of an empty set is all ones.

    Permutations exist only for elements of sets that the first step has not finished.
    """
    sets = len(at) - 1
    found = np.full(sets * places, ~np.uint64(0))
    owner = np.repeat(np.arange(sets), np.diff(at))
    step_factor = factors(places, salt=3)
    order = None
    for step in range(places):
        if not len(tokens):
            break
        with np.errstate(over="ignore"):
            random = mix(tokens + step_factor[step])
        pick = step + (((random & np.uint64(0xFFFFFF)) * np.uint64(places - step)) >> np.uint64(24)).astype(np.int64)
        if order is None:
            reached = pick
        else:
            rows = np.arange(len(tokens))
            reached = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[rows, step]
        offer = (np.uint64(step) << FRACTION) | (random >> np.uint64(64 - int(FRACTION)))
        np.minimum.at(found, owner * places + reached, offer)
        alive = np.unique(owner)
        highest = found.reshape(sets, places)[alive].max(axis=1)
        goes_on = np.zeros(sets, bool)
        goes_on[alive] = highest >= np.uint64(step + 1) << FRACTION
        kept = goes_on[owner]
        tokens, owner = tokens[kept], owner[kept]
        if order is None:
            kind = np.uint8 if places <= 256 else np.uint16
            order = np.tile(np.arange(places, dtype=kind), (len(tokens), 1))
            order[np.arange(len(tokens)), pick[kept]] = 0
        else:
            order = order[kept]
    return found.reshape(sets, places)


def band_keys(signature: np.ndarray, settings: SuperMinHash) -> np.ndarray:
    """One 64-bit key per set and band; keys of different bands differ."""
    by = factors(settings.places, salt=5).reshape(settings.bands, settings.rows)
    with np.errstate(over="ignore"):
        cut = signature.reshape(-1, settings.bands, settings.rows) * by
        return mix(cut.sum(axis=2, dtype=np.uint64) + np.arange(settings.bands, dtype=np.uint64))


def sketched(docs: DataFrame, settings: SuperMinHash) -> DataFrame:
    """doc_id, text_key, n, sig, keys, mini: every row's set size, identity, band keys and signature of a byte a place."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, tokens, at in shingle_sets(batch.column(1), settings.shingle):
                n = np.diff(at)
                sums = [
                    np.add.reduceat(np.append(x, np.uint64(0)), at[:-1]) * (n > 0)
                    for x in (mix(tokens), mix(tokens ^ np.uint64(0x5DEECE66D)))
                ]
                signature = signatures(tokens, at, settings.places)
                keys = band_keys(signature, settings).view(np.int64)
                flat = pa.array(keys[n > 0].ravel())
                ends = np.concatenate(([0], np.cumsum(np.where(n > 0, settings.bands, 0)))).astype(np.int32)
                low = signature.astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(n)),
                        batch.column(2).slice(row, len(n)),
                        pa.array(n, pa.int64()),
                        pa.array([a.tobytes() + b.tobytes() if k else None for a, b, k in zip(*sums, n, strict=True)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), flat),
                        pa.array([s.tobytes() for s in low], pa.binary()),
                    ],
                    names=["doc_id", "text_key", "n", "sig", "keys", "mini"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return saved(
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
            sketch, f"doc_id {kind}, text_key long, n long, sig binary, keys array<long>, mini binary"
        )
    )


MAIN_BLOCKS = 8
"""A block of a key's largest group is so many times larger than the others."""


def sizes_allow(n: str, m: str, t: int) -> F.Column:
    return F.expr(f"100 * least({n}, {m}) >= {t} * greatest({n}, {m})")


def sets_of(texts: pa.Array, shingle: int) -> list[np.ndarray]:
    return [tokens[at[i] : at[i + 1]] for _, tokens, at in shingle_sets(texts, shingle) for i in range(len(at) - 1)]


def confirmed(pairs: DataFrame, texts: DataFrame, settings: SuperMinHash) -> DataFrame:
    """The pairs (a, b) whose full sets are similar.

    ``parts`` of a pair says over how many tasks the partners of a are dealt out; a's text
    goes to each of them once.
    """
    t, shingle = settings.at_least, settings.shingle

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # partners of one set follow each other: its text is cut once
            left = batch.column(2).dictionary_encode()
            cut, which = sets_of(left.dictionary, shingle), left.indices.to_numpy()
            alike = []
            for i, y in zip(which, sets_of(batch.column(3), shingle), strict=True):
                x = cut[i]
                common = len(np.intersect1d(x, y, assume_unique=True))
                alike.append(100 * common >= t * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(alike, pa.bool_()))

    dealt = saved(
        pairs.groupBy("a", "b").agg(F.max("parts").alias("parts"))
        .select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    )
    with_b = dealt.join(texts.select(F.col("sig").alias("b"), F.col("text").alias("text_b")), "b")
    centres = dealt.select("a", "part").distinct().join(texts.select(F.col("sig").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_b.join(centres, ["a", "part"]).select("a", "b", "text_a", "text_b")
    return saved(both.mapInArrow(compare, "a binary, b binary"))


def links(table: DataFrame, texts_of, settings: SuperMinHash) -> DataFrame:
    """(a, b): confirmed links between different sets that connect all that share a band.

    ``table`` holds sig, n, keys, mini; ``texts_of`` gives one text per wanted sig. First every
    member of a key is compared with one of them. The second round looks only at keys whose members
    then lie in several groups, and at pairs of different groups: members outside a key's largest group
    meet that group and each other. Block by block signatures tell the members
    that may be similar, and only these are compared on their sets. No step has a row per pair of a block.
    """
    t = settings.at_least
    index = saved(
        table.filter("n > 0")
        .select("sig", "n", F.explode("keys").alias("key"))
        .groupBy("key", "sig")
        .agg(F.first("n").alias("n"))
    )
    shared = saved(
        index.groupBy("key").agg(F.min(F.struct("sig", "n")).alias("c"), F.count("*").alias("members")).filter("members > 1")
    )
    members = saved(index.join(shared, "key").select("key", "sig", "n", F.col("c.sig").alias("centre"), F.col("c.n").alias("m"), "members"))
    texts = saved(texts_of(members.select("sig").distinct()))
    starred = members.filter("sig <> centre").filter(sizes_allow("n", "m", t))
    parts = F.ceil(F.col("members") / settings.block).cast("int").alias("parts")
    found = confirmed(starred.select(F.col("centre").alias("a"), F.col("sig").alias("b"), parts), texts, settings)
    group = saved(grouped(found))

    labelled = saved(
        members.join(group, members["sig"] == group["node"], "left").select(
            "key", "sig", "n", F.coalesce("label", "sig").alias("label"), "members"
        )
    )
    rest = open_members(labelled, settings)
    minis = table.filter("n > 0").groupBy("sig").agg(F.min("mini").alias("mini"))
    dealt = dealt_out(rest.join(minis, "sig")).select("key", "i", "j", "own", "sig", "n", "label", "mini")
    kind = "key long, i int, j int, own int, sig binary, label binary"
    likely = saved(dealt.groupBy("key", "i", "j").applyInArrow(_likely(settings), kind))
    more = likely.join(texts, "sig").groupBy("key", "i", "j").applyInArrow(_linked(settings), "a binary, b binary")
    return found.union(more)


def open_members(labelled: DataFrame, settings: SuperMinHash) -> DataFrame:
    """Members of keys with several groups, with the key's largest group and how many blocks it and the rest make."""
    by_label = labelled.groupBy("key", "label").agg(F.count("*").alias("size"))
    main = F.max(F.struct("size", "label"))
    open_keys = by_label.groupBy("key").agg(main.alias("main"), F.sum("size").alias("members"), F.count("*").alias("labels"))
    blocks = F.ceil((F.col("members") - F.col("main.size")) / settings.block).cast("int").alias("blocks")
    mains = F.ceil(F.col("main.size") / (settings.block * MAIN_BLOCKS)).cast("int").alias("mains")
    open_keys = saved(open_keys.filter("labels > 1").select("key", F.col("main.label").alias("main"), blocks, mains))
    return labelled.join(open_keys, "key").drop("members")


def dealt_out(rest: DataFrame) -> DataFrame:
    """A row per member and pair of blocks (i, j) it is compared in.

    A key's largest group is not compared with itself: only the rest is dealt out to pairs of blocks, and
    each of its blocks meets the largest group once.
    """
    in_main, spread = F.col("label") == F.col("main"), F.xxhash64("sig", "key")
    own = F.when(in_main, -F.pmod(spread, F.col("mains")) - 1).otherwise(F.pmod(spread, F.col("blocks"))).cast("int")
    # a member of the rest meets every block of the rest, and every block of the largest group
    others = F.sequence(F.when(in_main, F.lit(0)).otherwise(1 - F.col("mains")), F.col("blocks") - 1)
    dealt = rest.select("*", own.alias("own"), F.explode(others).alias("other"))
    # the first block of the largest group meets a block of the rest where that meets itself
    i = F.when(F.col("own") == -1, F.col("other")).when(F.col("own") < 0, F.col("own") + 1).otherwise(F.least("own", "other"))
    j = F.when(F.col("own") < 0, F.col("other")).otherwise(F.greatest("own", "other"))
    return dealt.withColumns({"i": i, "j": j})


def _numbers(labels: pa.ChunkedArray) -> np.ndarray:
    return labels.combine_chunks().dictionary_encode().indices.to_numpy()


def _sides(i: int, j: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the members to compare: blocks of the rest count from 0, those of the largest group from -1 down."""
    if i == j:
        return np.flatnonzero(own == j), np.flatnonzero((own == j) | (own < 0))
    return (np.flatnonzero(own == i), np.flatnonzero(own == j)) if i >= 0 else (np.flatnonzero(own == j), np.flatnonzero(own < 0))


def _likely(settings: SuperMinHash):
    """The members of a block that may be similar to one of another group, by sizes and signatures.

    A pair that agrees in an earlier band as well is left to that band's key.
    """
    t, least = settings.at_least, settings.agree * settings.places // 100

    def likely(table: pa.Table) -> pa.Table:
        i, j = (table.column(c)[0].as_py() for c in ("i", "j"))
        own, n, label = table.column("own").to_numpy(), table.column("n").to_numpy(), _numbers(table.column("label"))
        mini = np.frombuffer(b"".join(table.column("mini").to_pylist()), np.uint8).reshape(len(n), -1)
        left, right = _sides(i, j, own)
        wanted = np.zeros(len(n), bool)
        # the band of the key is the first that all members of the block agree in
        whole = (mini == mini[0]).reshape(len(n), settings.bands, settings.rows).all(axis=2).all(axis=0)
        band = int(np.argmax(whole)) if whole.any() else 0
        for x in left:
            ys = right[(label[right] != label[x]) & (100 * np.minimum(n[right], n[x]) >= t * np.maximum(n[right], n[x]))]
            if i == j:
                ys = ys[(ys > x) | (own[ys] < 0)]
            same = mini[ys] == mini[x]
            near = same.sum(axis=1) >= least
            if band and near.any():
                near &= ~same.reshape(len(ys), settings.bands, settings.rows)[:, :band].all(axis=2).any(axis=1)
            if near.any():
                wanted[x] = True
                wanted[ys[near]] = True
        return table.filter(pa.array(wanted)).select(["key", "i", "j", "own", "sig", "label"])

    return likely


def _linked(settings: SuperMinHash):
    """Links of a block's members on their full sets, as many as it takes to join their groups."""
    t = settings.at_least

    def linked(table: pa.Table) -> pa.Table:
        i, j = (table.column(c)[0].as_py() for c in ("i", "j"))
        own, label = table.column("own").to_numpy(), _numbers(table.column("label"))
        sig = table.column("sig").to_pylist()
        sets = sets_of(table.column("text").combine_chunks(), settings.shingle)
        n = np.array([len(x) for x in sets])
        left, right = _sides(i, j, own)
        common = common_counts(sets, left, right)
        alike = 100 * common >= t * (n[left][:, None] + n[right][None, :] - common)
        alike &= label[left][:, None] != label[right][None, :]
        groups = UnionFind(int(label.max()) + 1)
        pairs = [(sig[left[x]], sig[right[y]]) for x, y in zip(*np.nonzero(alike), strict=True) if groups.union(int(label[left[x]]), int(label[right[y]]))]
        return pa.table({c: pa.array([p[k] for p in pairs], pa.binary()) for k, c in enumerate("ab")})

    return linked


def near_duplicates(docs: DataFrame, settings: SuperMinHash = SuperMinHash()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, set_id, text_key for every row of docs(doc_id, text).

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. A null or blank
    text has no shingles and links with nothing; fewer words than a shingle make one
    shingle. Rows with equal sets are linked, repeated rows come out as often as they came
    in. component_id is the smallest doc_id reachable (null ids are passed over), ``kept``
    says whether the row has it; a null id without links is kept. Other columns of docs are ignored. An empty table gives
    an empty result.
    """
    table = sketched(docs, settings)
    # equal sets are one row from here on, with one text that stands for all
    classes = saved(
        table.filter("n > 0")
        .groupBy("sig")
        .agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "text_key")).alias("first"))
    )

    def texts_of(wanted: DataFrame) -> DataFrame:
        chosen = classes.join(wanted, "sig", "left_semi").select(
            "sig", F.col("first.doc_id").alias("__id"), F.col("first.text_key").alias("__key")
        )
        same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key"))
        return docs.select("doc_id", "text").join(chosen, same).select("sig", "text").dropDuplicates(["sig"])

    group = saved(grouped(links(table, texts_of, settings)))
    labelled = classes.join(group, classes["sig"] == group["node"], "left").select(
        "sig", "least", F.coalesce("label", "sig").alias("label")
    )
    whole = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = saved(labelled.join(whole, "label").select("sig", "component_id"))
    # the written table lets adaptive execution split the rows of a set that very many documents share
    rows = table.select("doc_id", "text_key", "n", "sig").join(named, "sig", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"), F.hex("sig").alias("set_id"), "text_key",
    )
