"""Alignment of two tokenizers by products of sparse token-byte incidence matrices.

Tokens of a text are rows, its bytes columns. The product A x B' has an entry for every pair
of tokens that overlap, with the number of common bytes. Where the overlaps of neighbouring
A tokens have no B token in common, both tokenizers end a token: such places cut the text
into groups. The product of the token-group incidences has an entry for every pair of tokens
of one group. Matrices are compressed sparse rows, products go row by row in blocks of a
bounded number of terms, and the texts of a slice are blocks of one matrix.

Corpus-wide counts (documents that hold an id pair linked) never reach one place: a task
packs the pairs of its documents into dictionaries of bounded size, pieces of them are summed
by range of A ids, and the sums travel back to the dictionaries that asked for them.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modspark.llm.store import saved
from modspark.llm.words import byte_column, mix, slices


@dataclass(frozen=True)
class Alignment:
    """Where the two tokenizer files are, and how much a task holds.

    ``terms`` bounds the terms of a matrix product that are expanded at a time,
    ``dictionary`` the distinct id pairs that documents of a task collect before they are
    written (one document may hold more).
    """

    byte_level: str = "/opt/tokenizers/byte_bpe_50k.json"
    pieces: str = "/opt/tokenizers/piece_bpe_32k.model"
    terms: int = 1 << 20
    dictionary: int = 1 << 16


@dataclass
class Csr:
    """A sparse matrix: the columns and values of row i lie from row[i] to row[i + 1]."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    columns: int

    def transposed(self) -> Csr:
        order = np.argsort(self.column, kind="stable")
        owner = np.repeat(np.arange(len(self.row) - 1), np.diff(self.row))
        row = np.concatenate(([0], np.cumsum(np.bincount(self.column, minlength=self.columns))))
        return Csr(row, owner[order], self.value[order], len(self.row) - 1)

    def products(self, other: Csr, terms: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, column, value) of self x other, some entries at a time.

        Row i is the sum of other's rows k over i's entries (i, k), each times the entry. Rows are
        expanded together up to ``terms`` terms; a longer row comes in parts, whose
        entries then repeat and have to be added.
        """
        width = np.diff(other.row)[self.column]
        ends = np.cumsum(width)
        owner = np.repeat(np.arange(len(self.row) - 1), np.diff(self.row))
        at = 0
        while at < len(width):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + terms, "right")))
            if to < len(width):
                whole = int(self.row[owner[to]])  # do not cut a row unless it is a block by itself
                to = whole if whole > at else to
            part = slice(at, to)
            n = width[part]
            first = np.repeat(other.row[self.column[part]], n)
            # an entry that alone has more terms than fit comes in parts too
            for low in range(0, max(1, int(n.sum())), terms):
                step = slice(low, low + terms)
                place = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))[step] + first[step]
                i, j = np.repeat(owner[part], n)[step], other.column[place]
                yield _summed(i, j, np.repeat(self.value[part], n)[step] * other.value[place], other.columns)
            at = to

    def times(self, other: Csr, terms: int) -> Csr:
        """self x other as a whole; for products that are known to be thin."""
        parts = list(self.products(other, terms))
        i, j, v = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(3))
        i, j, v = _summed(i, j, v, other.columns)
        return Csr(np.searchsorted(i, np.arange(len(self.row))), j, v, other.columns)


def _summed(i: np.ndarray, j: np.ndarray, v: np.ndarray, columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in order of row and column, those of one place added."""
    key = i * columns + j
    if len(key) and (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, v = key[order], v[order]
    heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    total = np.add.reduceat(v, heads) if len(heads) else v
    return key[heads] // max(columns, 1), key[heads] % max(columns, 1), total


def incidences(a: np.ndarray, b: np.ndarray) -> tuple[Csr, Csr]:
    """Tokens by bytes for both tokenizers, from the tokens' lengths in order.

    Bytes between two neighbouring token ends are in the same tokens of both: they are one column,
    and A's entries say of how many bytes.
    """
    ends_a, ends_b = np.cumsum(a), np.cumsum(b)
    marks = np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, bool)
    marks[ends_a] = marks[ends_b] = True
    ends = np.flatnonzero(marks)
    width = np.diff(ends, prepend=0)
    column = np.arange(len(ends))
    upto = np.cumsum(marks)
    rows = [np.concatenate(([0], upto[e])) for e in (ends_a, ends_b)]
    return Csr(rows[0], column, width, len(ends)), Csr(rows[1], column, np.ones(len(ends), np.int64), len(ends))


def groups(overlaps: Csr) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A token and of every B token, numbered in order."""
    n_a = len(overlaps.row) - 1
    lowest, highest = overlaps.column[overlaps.row[:-1]], overlaps.column[overlaps.row[1:] - 1]
    opens = np.ones(n_a, bool)
    opens[1:] = lowest[1:] > highest[:-1]
    of_a = np.cumsum(opens) - 1
    of_b = np.zeros(overlaps.columns, np.int64)
    of_b[overlaps.column] = np.repeat(of_a, np.diff(overlaps.row))
    return of_a, of_b


@dataclass
class Bytes:
    """The bytes of every token id, one after the other."""

    data: np.ndarray
    start: np.ndarray

    @staticmethod
    def of(tokens: list[bytes]) -> Bytes:
        start = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int64)
        return Bytes(np.frombuffer(b"".join(tokens), np.uint8), start)

    def words(self) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[i:j] for i, j in zip(self.start[:-1], self.start[1:], strict=True)]

    def length(self, ids: np.ndarray) -> np.ndarray:
        return self.start[ids + 1] - self.start[ids]

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.length(ids)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return self.data[np.repeat(self.start[ids], n) + inside]


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte.

    Printable bytes stand for themselves, the others for letters from 256 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


# Fixed value: the pattern of byte-level vocabularies that cuts a text before any merge.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Tokenizers:
    """Both tokenizers, from the contents of their files, so that tasks need no files."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        self.byte_level, self.pieces = byte_level, pieces

    @staticmethod
    def read(settings: Alignment) -> Tokenizers:
        return Tokenizers(Path(settings.byte_level).read_bytes(), Path(settings.pieces).read_bytes())

    def __getstate__(self) -> tuple[bytes, bytes]:
        return self.byte_level, self.pieces

    def __setstate__(self, state: tuple[bytes, bytes]) -> None:
        self.__init__(*state)

    @cached_property
    def a(self):
        """The byte-level vocabulary in the faster of two libraries.

        It merges by the rank of the token that results, the other by the rank of the pair. These
        agree where every token is what its own bytes encode to, as the tests check.
        """
        import tiktoken

        special = {x["content"] for x in json.loads(self.byte_level)["added_tokens"]}
        words = self.a_bytes.words()
        ranks = {word: i for i, word in enumerate(words) if word and word.decode("utf-8", "replace") not in special}
        return tiktoken.Encoding(hashlib.sha256(self.byte_level).hexdigest(), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def b(self):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_proto=self.pieces)

    @cached_property
    def a_bytes(self) -> Bytes:
        table = byte_letters()
        words: dict[int, bytes] = {}
        content = json.loads(self.byte_level)
        for added in content["added_tokens"]:
            words[added["id"]] = added["content"].encode()
        for token, i in content["model"]["vocab"].items():
            words[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
        return Bytes.of([words.get(i, b"") for i in range(max(words) + 1)])

    @cached_property
    def b_bytes(self) -> Bytes:
        def raw(i: int) -> bytes:
            piece = self.b.id_to_piece(i)
            return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

        return Bytes.of([raw(i) for i in range(self.b.get_piece_size())])

    def encoded(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of every text by A (behind a space) and by B."""
        a = [self.a.encode_to_numpy(f" {t}", disallowed_special=()) for t in texts]
        b = self.b.encode(texts, num_threads=1)
        return [x.astype(np.int64) for x in a], [np.array(x, np.int64) for x in b]


DIGITS = np.arange(1 << 16).astype("S5").view(np.uint8).reshape(-1, 5)
"""Ids in decimal, filled up with zero bytes; vocabularies here have fewer than 2^16 ids."""


def _ended(ids: np.ndarray, last: np.ndarray, inner: str, outer: str) -> np.ndarray:
    """Every id in decimal, behind it a separator, as rows of bytes with zeros between."""
    rows = np.empty((len(ids), 6), np.uint8)
    rows[:, :5] = DIGITS[ids]
    rows[:, 5] = np.where(last, ord(outer), ord(inner))
    return rows


def _lasts(group: np.ndarray) -> np.ndarray:
    last = np.ones(len(group), bool)
    last[:-1] = group[1:] != group[:-1]
    return last


@dataclass
class Aligned:
    """Aligned texts of a slice; arrays run over all their tokens, in order.

    ``text`` of a token or link is the index of its text in the slice.
    """

    texts: int
    a: np.ndarray
    b: np.ndarray
    text_a: np.ndarray
    text_b: np.ndarray
    overlaps: Csr
    group_a: np.ndarray
    group_b: np.ndarray

    @property
    def n_groups(self) -> int:
        return int(self.group_a[-1]) + 1 if len(self.group_a) else 0

    def group_links(self, terms: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(A token, B token) of all pairs that share a group, some at a time."""
        ones = np.ones(len(self.a), np.int64)
        in_group = Csr(np.arange(len(self.a) + 1), self.group_a, ones, self.n_groups)
        members = Csr(np.arange(len(self.b) + 1), self.group_b, np.ones(len(self.b), np.int64), self.n_groups)
        for i, j, _ in in_group.products(members.transposed(), terms):
            yield i, j

    def pairs(self, ids_b: int, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, times): the distinct id pairs that each text links, and how often.

        Blocks of links are counted as they come, so a group of very many tokens takes
        memory for its distinct pairs only.
        """
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for i, j in self.group_links(terms):
            key = (self.text_a[i] << 32) | (self.a[i] * ids_b + self.b[j])
            held.append(np.unique(key, return_counts=True))
            size += len(held[-1][0])
            if size > 4 * terms:
                held = [_counted(held)]
                size = len(held[0][0])
        key, times = _counted(held)
        return key >> 32, key & 0xFFFFFFFF, times

    def written(self) -> list[bytes]:
        """Every text's groups as ``a1,a2|b1;a3|b2``; empty without tokens."""
        last_a, last_b = _lasts(self.group_a), _lasts(self.group_b)
        seat_a = np.arange(len(self.a)) + np.searchsorted(self.group_b, self.group_a, "left")
        seat_b = np.arange(len(self.b)) + np.searchsorted(self.group_a, self.group_b, "right")
        rows = np.zeros((len(self.a) + len(self.b), 6), np.uint8)
        owner = np.zeros(len(rows), np.int64)
        rows[seat_a], owner[seat_a] = _ended(self.a, last_a, ",", "|"), self.text_a
        rows[seat_b], owner[seat_b] = _ended(self.b, last_b, ",", ";"), self.text_b
        filled = rows > 0
        length = np.bincount(owner, filled.sum(axis=1), minlength=self.texts).astype(np.int64)
        ends = np.cumsum(length)
        line = rows[filled].tobytes()
        return [line[e - n : e - 1] if n else b"" for e, n in zip(ends, length, strict=True)]


def _counted(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, back = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([c for _, c in held]), len(keys)).astype(np.int64)


def aligned(texts: list[str], tools: Tokenizers, terms: int) -> Aligned:
    """Both tokenizers' tokens of the texts and their groups.

    A text that is empty, or whose tokens do not spell a space and the text, has no tokens.
    """
    raw = [f" {t}".encode() if t else b"" for t in texts]
    size = np.array([len(r) for r in raw], np.int64)
    ids = [[x if n else x[:0] for x, n in zip(kept, size, strict=True)] for kept in tools.encoded(texts)]
    for table, kept in zip((tools.a_bytes, tools.b_bytes), ids, strict=True):
        spelt = np.array([table.length(x).sum() for x in kept]) == size
        if spelt.any():
            good = np.flatnonzero(spelt)
            bounds = np.cumsum(size[good])
            same = table.joined(np.concatenate([kept[i] for i in good])) == np.frombuffer(b"".join(raw[i] for i in good), np.uint8)
            spelt[good[np.unique(np.searchsorted(bounds, np.flatnonzero(~same), "right"))]] = False
        for i in np.flatnonzero(~spelt):
            ids[0][i], ids[1][i], size[i] = ids[0][i][:0], ids[1][i][:0], 0
            raw[i] = b""
    a, b = (np.concatenate([np.zeros(0, np.int64), *kept]) for kept in ids)
    own_a, own_b = (np.repeat(np.arange(len(texts)), [len(x) for x in kept]) for kept in ids)
    in_a, in_b = incidences(tools.a_bytes.length(a), tools.b_bytes.length(b))
    overlaps = in_a.times(in_b.transposed(), terms)
    return Aligned(len(texts), a, b, own_a, own_b, overlaps, *groups(overlaps))


def token_links(docs: DataFrame, settings: Alignment = Alignment()) -> DataFrame:
    """doc_id, a_place, b_place, a_id, b_id, shared_bytes, group: all links of every text.

    One row per pair of token occurrences in one group; shared_bytes is 0 where the two do
    not overlap. Places and groups count from 0 in their text.
    """
    tools = docs.sparkSession.sparkContext.broadcast(Tokenizers.read(settings))
    terms = settings.terms

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(byte_column(batch.column(1))[0]):
                part = batch.slice(rows.start, rows.stop - rows.start)
                found = aligned([t or "" for t in part.column(1).to_pylist()], tools.value, terms)
                c = found.overlaps
                place = np.repeat(np.arange(len(c.row) - 1), np.diff(c.row)) * c.columns + c.column
                first_a = np.searchsorted(found.text_a, np.arange(found.texts))
                first_b = np.searchsorted(found.text_b, np.arange(found.texts))
                first_g = found.group_a[np.minimum(first_a, max(len(found.a) - 1, 0))] if len(found.a) else first_a
                for i, j in found.group_links(terms):
                    at = np.searchsorted(place, i * c.columns + j)
                    at = np.minimum(at, len(place) - 1)
                    common = np.where(place[at] == i * c.columns + j, c.value[at], 0)
                    text = found.text_a[i]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(pa.array(text)),
                            pa.array(i - first_a[text]),
                            pa.array(j - first_b[text]),
                            pa.array(found.a[i]),
                            pa.array(found.b[j]),
                            pa.array(common),
                            pa.array(found.group_a[i] - first_g[text]),
                        ],
                        names=["doc_id", "a_place", "b_place", "a_id", "b_id", "shared_bytes", "group"],
                    )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        link,
        f"doc_id {kind}, a_place long, b_place long, a_id long, b_id long, shared_bytes long, group long",
    )


def range_of(pair: np.ndarray, ids_b: int, ranges: int) -> np.ndarray:
    """Pairs of one A id are in one range."""
    return (mix(pair // ids_b) % np.uint64(ranges)).astype(np.int64)


def _packed(values: np.ndarray) -> bytes:
    """Numbers below 2^32 in 1, 2 or 4 bytes each, the width in front."""
    most = int(values.max()) if len(values) else 0
    kind = np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32
    return bytes([np.dtype(kind).itemsize]) + values.astype(kind).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    kind = {1: np.uint8, 2: np.uint16, 4: np.uint32}[raw[0]]
    return np.frombuffer(raw, kind, offset=1).astype(np.int64)


MEASURES = ("n_a", "n_b", "n_groups", "n_links")
_WRITTEN = (
    "chunk long, range int, {id} n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys binary, times binary"
)


def _documents(docs: DataFrame, settings: Alignment, ranges: int) -> DataFrame:
    """Written once: a row per document, and rows with the pieces of its dictionary.

    ``chunk`` names the dictionary. In a document's row (range is null) ``keys`` are places in it and
    ``times`` how often the document links that pair; in a piece ``keys`` are the pairs of
    one range and ``times`` the documents of the chunk that hold them.
    """
    tools = docs.sparkSession.sparkContext.broadcast(Tokenizers.read(settings))
    kind = docs.schema["doc_id"].dataType
    schema = _WRITTEN.format(id=f"doc_id {kind.simpleString()},")
    terms, most = settings.terms, settings.dictionary

    def flushed(chunk: int, ids: list, figures: list, shas: list, pairs: list, times: list) -> pa.RecordBatch:
        ids_b = tools.value.b.get_piece_size()
        known, count = np.unique(np.concatenate(pairs), return_counts=True)
        where = range_of(known, ids_b, ranges)
        order = np.lexsort((known, where))
        seat = np.empty(len(order), np.int64)
        seat[order] = np.arange(len(order))
        by_pair = known
        known, count, where = known[order], count[order], where[order]
        cuts = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1], [True]))) if len(known) else np.zeros(1, int)
        pieces = list(zip(cuts[:-1], cuts[1:], strict=True))
        doc_keys = [_packed(seat[np.searchsorted(by_pair, p)]) for p in pairs]
        n, m = len(figures), len(pieces)
        none = [None] * m
        columns = [
            pa.array([chunk] * (n + m), pa.int64()),
            pa.array([None] * n + [int(where[i]) for i, _ in pieces], pa.int32()),
            pa.concat_arrays([pa.concat_arrays(ids), pa.nulls(m, ids[0].type)]),
            *(pa.array([f[k] for f in figures] + none, pa.int64()) for k in range(len(MEASURES))),
            pa.array(shas + none, pa.string()),
            pa.array(doc_keys + [_packed(known[i:j]) for i, j in pieces], pa.binary()),
            pa.array([_packed(t) for t in times] + [_packed(count[i:j]) for i, j in pieces], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["chunk", "range", "doc_id", *MEASURES, "groups_sha256", "keys", "times"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_b = tools.value.b.get_piece_size()
        chunk = TaskContext.get().partitionId() << 32
        held: tuple[list, ...] = ([], [], [], [], [])
        size, distinct = 0, np.zeros(0, np.int64)
        for batch in batches:
            for rows in slices(byte_column(batch.column(1))[0]):
                part = batch.slice(rows.start, rows.stop - rows.start)
                found = aligned([t or "" for t in part.column(1).to_pylist()], tools.value, terms)
                text, pair, times = found.pairs(ids_b, terms)
                cut = np.searchsorted(text, np.arange(found.texts + 1))
                n_a, n_b = (np.bincount(t, minlength=found.texts) for t in (found.text_a, found.text_b))
                heads = np.flatnonzero(np.concatenate(([True], found.group_a[1:] != found.group_a[:-1]))) if len(found.a) else []
                n_groups = np.bincount(found.text_a[heads], minlength=found.texts) if len(found.a) else n_a
                n_links = np.bincount(text, times, minlength=found.texts).astype(np.int64)
                shas = [hashlib.sha256(w).hexdigest() if w else "" for w in found.written()]
                new = (
                    [part.column(0)],
                    list(zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), n_links.tolist(), strict=True)),
                    shas,
                    [pair[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)],
                    [times[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)],
                )
                for old, more in zip(held, new, strict=True):
                    old.extend(more)
                distinct = np.union1d(distinct, pair)
                size += len(pair)
                if len(distinct) >= most or size >= 16 * most:
                    yield flushed(chunk, *held)
                    chunk, held, size, distinct = chunk + 1, ([], [], [], [], []), 0, distinct[:0]
        if held[0]:
            yield flushed(chunk, *held)

    return saved(docs.select("doc_id", "text").mapInArrow(align, schema))


def alignment(docs: DataFrame, settings: Alignment = Alignment()) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of docs.

    A text that is null, empty, or not spelt by both tokenizers (docs with a literal U+2581,
    for one) has no tokens: zeros, and '' for the hash. Rows that repeat are documents of their own and come out as
    often as they came in; a null id stays null. Other columns of docs are ignored. An
    empty table gives an empty result. Texts are taken whole, however long.

    Counts of pairs are summed by range of A ids; a range's task holds the pieces of its pairs
    only, and their number follows spark.sql.shuffle.partitions. A frequent A id is one
    entry per dictionary and pair there, not one per document.
    """
    spark = docs.sparkSession
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids_b = Tokenizers.read(settings).b.get_piece_size()
    table = _documents(docs, settings, ranges)

    def summed(pieces: pa.Table) -> pa.Table:
        keys = [_unpacked(k) for k in pieces.column("keys").to_pylist()]
        counts = np.concatenate([_unpacked(c) for c in pieces.column("times").to_pylist()])
        pairs, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(back, counts, len(pairs)).astype(np.int64)
        a = pairs // ids_b
        heads = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
        highest = np.repeat(np.maximum.reduceat(total, heads), np.diff(np.append(heads, len(a))))
        best = total == highest
        cuts = np.cumsum([0, *map(len, keys)])
        spans = [back[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.table(
            {
                "chunk": pieces.column("chunk"),
                "range": pieces.column("range"),
                "totals": pa.array([total[s].astype(np.int64).tobytes() for s in spans], pa.binary()),
                "best": pa.array([np.packbits(best[s]).tobytes() for s in spans], pa.binary()),
            }
        )

    pieces = table.filter("range is not null").select("chunk", "range", "keys", "times")
    answers = pieces.groupBy("range").applyInArrow(summed, "chunk long, range int, totals binary, best binary")

    def answered(rows: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(found.column("range").to_numpy())
        totals = [np.frombuffer(t, np.int64) for t in found.column("totals").to_pylist()]
        marks = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(t)) for b, t in zip(found.column("best").to_pylist(), totals, strict=True)]
        total, best = (np.concatenate([np.zeros(0, np.int64), *(x[i] for i in order)]) for x in (totals, marks))
        n_best, count_sum = [], []
        for keys, times in zip(rows.column("keys").to_pylist(), rows.column("times").to_pylist(), strict=True):
            at, often = _unpacked(keys), _unpacked(times)
            n_best.append(int((best[at] * often).sum()))
            count_sum.append(int((total[at] * often).sum()))
        kept = {c: rows.column(c) for c in ("doc_id", *MEASURES)}
        kept |= {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.table(kept | {"groups_sha256": rows.column("groups_sha256")})

    rows = table.filter("range is null").drop("range")
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(answered, schema)


def pair_counts(docs: DataFrame, settings: Alignment = Alignment()) -> DataFrame:
    """a_id, b_id, documents: in how many documents each id pair is linked."""
    spark = docs.sparkSession
    ids_b = Tokenizers.read(settings).b.get_piece_size()
    table = _documents(docs, settings, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))

    def summed(pieces: pa.Table) -> pa.Table:
        keys = np.concatenate([_unpacked(k) for k in pieces.column("keys").to_pylist()])
        pairs, back = np.unique(keys, return_inverse=True)
        counts = np.concatenate([_unpacked(c) for c in pieces.column("times").to_pylist()])
        total = np.bincount(back, counts, len(pairs)).astype(np.int64)
        return pa.table({"a_id": pairs // ids_b, "b_id": pairs % ids_b, "documents": total})

    pieces = table.filter(F.col("range").isNotNull()).select("range", "keys", "times")
    return pieces.groupBy("range").applyInArrow(summed, "a_id long, b_id long, documents long")
