"""Token alignment, Merkle manifest and SuperMinHash against brute force, with odd inputs."""

from __future__ import annotations

import collections
import hashlib
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from modspark.llm import components, merkle, super_minhash, token_alignment
from modspark.llm.store import saved
from modspark.llm.super_minhash import SuperMinHash, UnionFind, grouped, near_duplicates, signatures
from modspark.llm.token_alignment import Alignment, Csr, Tokenizers, alignment, pair_counts, token_links
from tests.llm.test_texts import EDGES, LOWER, WORD, frame, made

CLASHING = ["chunk", "range", "keys", "times", "sig", "leaf", "no", "tree", "pos", "part", "present", "label", "n"]


def clashing(spark, rows):
    """doc_id, text, source, lang, n_chars, and columns named like those the operators make."""
    extra = ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], f"doc_id long, text string, source string, lang string, n_chars long, {extra}")


# --- sparse products ---------------------------------------------------------


def random_matrix(rng, rows, columns, filled=0.2):
    dense = rng.integers(1, 5, (rows, columns)) * (rng.random((rows, columns)) < filled)
    i, j = np.nonzero(dense)
    return dense, Csr(np.searchsorted(i, np.arange(rows + 1)), j, dense[i, j], columns)


def dense_of(matrix):
    out = np.zeros((len(matrix.row) - 1, matrix.columns), int)
    for i in range(len(out)):
        part = slice(matrix.row[i], matrix.row[i + 1])
        np.add.at(out[i], matrix.column[part], matrix.value[part])
    return out


@pytest.mark.parametrize("terms", [1, 2, 7, 1 << 20])
def test_products_are_those_of_dense_matrices(terms):
    rng = np.random.default_rng(terms)
    for shape in ((5, 7, 6), (1, 9, 1), (12, 3, 30), (4, 0, 4), (0, 3, 2)):
        a, left = random_matrix(rng, shape[0], shape[1])
        b, right = random_matrix(rng, shape[1], shape[2])
        assert (dense_of(left.times(right, terms)) == a @ b).all()
        assert (dense_of(left.transposed()) == a.T).all()
        summed = np.zeros((shape[0], shape[2]), int)
        for i, j, v in left.products(right, terms):
            assert len(i) <= max(terms, 1)
            np.add.at(summed, (i, j), v)
        assert (summed == a @ b).all()


# --- token alignment ---------------------------------------------------------

TOKEN_TEXTS = [
    None, "", " ", "one", "Two words", "a▁b", "日本語テキスト 🎉 naïve", "<|endoftext|> <s> </s> <unk> <0x41>", "=" * 700,
    "tab\tand\nlines \r\n  twice  ", "nul\0here", "é ‍ ﻿", "same text here", "same text here",
]


@pytest.fixture(scope="module")
def tools():
    return Tokenizers.read(Alignment())


@pytest.fixture(scope="module")
def library():
    """The byte-level tokenizer as its own library reads the file."""
    found = Tokenizer.from_file(Alignment().byte_level)
    found.encode_special_tokens = True
    return found


def test_both_libraries_encode_alike(tools, library):
    rng = np.random.default_rng(3)
    letters = list("aeiou thns'.,-_=\t\n  é日🎉ßЖ0123<|>") + ["'ll", "ing", " the", "http", "\r\n", "endoftext", "\u3000"]
    texts = ["".join(rng.choice(letters, rng.integers(1, 60))) for _ in range(3000)] + made(40) + ["x" * 50_000, " " * 9000, "<|endoftext|>"]
    for text in texts:
        assert tools.a.encode(text, disallowed_special=()) == library.encode(text, add_special_tokens=False).ids
    # every token is what its own bytes encode to, as far as these are a text that is not cut
    for i, word in enumerate(tools.a_bytes.words()[:50256]):
        assert tools.a.encode_single_token(word) == i
        text = word.decode("utf-8", "replace")
        if "\ufffd" not in text:
            assert tools.a.encode(text, disallowed_special=()) == library.encode(text, add_special_tokens=False).ids


def groups_by_hand(text, tools):
    if not text:
        return []
    a, b = tools.a.encode(f" {text}", disallowed_special=()), tools.b.encode(text)
    raw = [[t.data[t.start[i] : t.start[i + 1]].tobytes() for i in ids] for t, ids in ((tools.a_bytes, a), (tools.b_bytes, b))]
    if any(b"".join(r) != f" {text}".encode() for r in raw):
        return []
    ends = [np.cumsum([len(x) for x in r]).tolist() for r in raw]
    out, i, j = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        low_i, low_j = i, j
        while i < len(a) and ends[0][i] <= cut:
            i += 1
        while j < len(b) and ends[1][j] <= cut:
            j += 1
        out.append((a[low_i:i], b[low_j:j]))
    return out


def alignment_by_hand(texts, tools):
    cut = [groups_by_hand(t, tools) for t in texts]
    links = [collections.Counter((x, y) for a, b in g for x in a for y in b) for g in cut]
    count = collections.Counter(pair for found in links for pair in found)
    best = collections.defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    rows = []
    for g, found in zip(cut, links, strict=True):
        line = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        rows.append((
            sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(found.values()),
            sum(n for p, n in found.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in found.items()),
            hashlib.sha256(line.encode()).hexdigest() if g else "",
        ))
    return rows, count


def test_byte_letters_spell_all_bytes(tools):
    letters = token_alignment.byte_letters()
    assert sorted(letters.values()) == list(range(256)) and len(letters) == 256
    assert tools.a_bytes.joined(np.array(tools.a.encode(" é\n"))).tobytes() == " é\n".encode()


@pytest.mark.parametrize("settings", [Alignment(), Alignment(terms=16, dictionary=50)])
def test_alignment_by_hand(spark, tools, settings):
    texts = [*TOKEN_TEXTS, *made(60), " ".join(f"Wörter{i}" for i in range(4000))]
    docs = clashing(spark, [(i if i else None, t, None, None, None) for i, t in enumerate(texts)]).repartition(3)
    expected, count = alignment_by_hand(texts, tools)
    found = alignment(docs, settings)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = {r["doc_id"] or 0: tuple(r)[1:] for r in found.collect()}
    assert rows == dict(enumerate(expected))
    counts = {(r["a_id"], r["b_id"]): r["documents"] for r in pair_counts(docs, settings).collect()}
    assert counts == dict(count)


def test_alignment_of_nothing(spark):
    docs = clashing(spark, [(1, None, None, None, None)])
    assert alignment(docs.limit(0)).count() == 0 and token_links(docs.limit(0)).count() == 0
    assert tuple(alignment(docs).first()) == (1, 0, 0, 0, 0, 0, 0, "")


def test_links_and_their_common_bytes(spark, tools):
    texts = ["internationalization of Größe 🎉", None, "=" * 90]
    docs = clashing(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    found = collections.Counter(tuple(r)[1:] for r in token_links(docs).filter("doc_id = 0").collect())
    expected, i, j = collections.Counter(), 0, 0
    for g, (a, b) in enumerate(groups_by_hand(texts[0], tools)):
        spans = []
        for table, ids in ((tools.a_bytes, a), (tools.b_bytes, b)):
            ends = np.cumsum(table.length(np.array(ids)))
            spans.append([set(range(e - n, e)) for e, n in zip(ends, table.length(np.array(ids)), strict=True)])
        for x, own in enumerate(spans[0]):
            for y, other in enumerate(spans[1]):
                expected[i + x, j + y, a[x], b[y], len(own & other), g] += 1
        i, j = i + len(a), j + len(b)
    assert found == expected


# --- Merkle manifest ---------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row_text(row, lowered=False):
    out = ""
    for i in (0, 2, 3, 4, 1):
        value = row[i]
        if lowered and i == 1 and value is not None:
            value = value.translate(LOWER)
        out += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return out


def climb_up(nodes):
    """(root, siblings and place per node), level by level."""
    ways = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for k, place in enumerate(at):
            run = runs[place // 8]
            ways[k].append((run[: place % 8], run[place % 8 + 1 :]))
        at, nodes = [p // 8 for p in at], [sha("".join(r)) for r in runs]
    return nodes[0], ways


def manifest_by_hand(rows):
    by_lang = collections.defaultdict(list)
    for row in rows:
        by_lang[row[3]].append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        own = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, sha(row_text(r))))
        trees.append((own, *climb_up([sha(row_text(r)) for r in own])))
    root, upper = climb_up([t[1] for t in trees])
    out = []
    for (own, subroot, ways), above in zip(trees, upper, strict=True):
        for row, way in zip(own, ways, strict=True):
            hit = zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 3 == 0
            folded = sha(row_text(row, lowered=hit))
            siblings = ""
            for left, right in way + above:
                siblings += "".join(left + right)
                folded = sha("".join([*left, folded, *right]))
            out.append((row[0], sha(row_text(row)), subroot, root, sha(siblings), folded, folded == root))
    return collections.Counter(out)


def documents(n, langs):
    texts = made(n)
    return [(i * 7 % n, texts[i].title() if i % 2 else texts[i], f"s{i % 3}" if i % 5 else None, langs[i % len(langs)], i if i % 4 else None) for i in range(n)]


@pytest.mark.parametrize(
    "rows",
    [
        documents(150, ["en", "de", "en", "en", None, "Ö", ""]),
        documents(64, ["en"]),
        documents(9, ["en"]),
        documents(40, [f"l{i}" for i in range(40)]),
        [(5, "Only One", None, None, None)],
        [(0, None, None, None, None), (0, "", "", "", 0), (None, "ÄB", "ß", "", -1), (3, "Aé" * 50_000, "s", "", 1)],
        [(3, "Same", "s", "en", 4)] * 20 + [(3, "Other", "s", "en", 4), (None, "X", None, "en", None), (None, "X", None, "en", None)],
    ],
)
def test_manifest_by_hand(spark, rows):
    docs = clashing(spark, rows).repartition(3)
    found = merkle.tamper_check(docs)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert collections.Counter(map(tuple, found.collect())) == manifest_by_hand(rows)


def test_manifest_of_nothing(spark):
    empty = clashing(spark, [(1, "a", None, None, None)]).limit(0)
    assert merkle.tamper_check(empty).count() == 0
    assert merkle.manifest(empty).root is None


def test_any_change_is_found(spark):
    rows = documents(30, ["en", "de"])
    docs = clashing(spark, rows)
    settings = merkle.Manifest()
    whole = merkle.proofs(merkle.manifest(docs))
    assert whole.filter("verified").count() == 30
    changed = merkle.F.when(merkle.F.col("doc_id") == 11, merkle.F.unhex(merkle.F.lit("00" * 32))).otherwise(merkle.row_hash(settings.fields))
    wrong = merkle.proofs(merkle.manifest(docs, settings, changed)).filter("not verified").collect()
    assert [r["doc_id"] for r in wrong] == [11]
    assert spark.conf.get(merkle.ROW_LIMIT) != "-1"


# --- SuperMinHash ------------------------------------------------------------


def sets_by_hand(texts, k):
    out = []
    for t in texts:
        words = WORD.findall((t or "").translate(LOWER))
        runs = {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()
        out.append(runs)
    return out


def groups_of(texts, ids, k, at_least):
    sets = sets_by_hand(texts, k)
    groups = UnionFind(len(texts))
    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= at_least * len(x | sets[j]):
                groups.union(i, j)
    members = collections.defaultdict(list)
    for i in range(len(texts)):
        members[groups.root(i)].append(ids[i])
    least = {r: min((x for x in m if x is not None), default=None) for r, m in members.items()}
    return [(ids[i], len(sets[i]), least[groups.root(i)]) for i in range(len(texts))]


def by_definition(tokens, places):
    """SuperMinHash as published, element by element."""
    out = [1 << 64] * places
    factor = [int(f) for f in super_minhash.factors(places, salt=3)]
    for x in tokens:
        order = list(range(places))
        for step in range(places):
            random = int(super_minhash.mix(np.array([(int(x) + factor[step]) % (1 << 64)], np.uint64))[0])
            pick = step + (((random & 0xFFFFFF) * (places - step)) >> 24)
            order[step], order[pick] = order[pick], order[step]
            out[order[step]] = min(out[order[step]], (step << 40) | (random >> 24))
    return out


def test_signatures_by_definition():
    rng = np.random.default_rng(4)
    sizes = [0, 1, 2, 5, 30, 200, 3000, 0, 7]
    at = np.concatenate(([0], np.cumsum(sizes)))
    tokens = rng.integers(0, 1 << 63, int(at[-1])).astype(np.uint64)
    found = signatures(tokens, at, 28)
    for i, n in enumerate(sizes):
        if n:
            assert found[i].tolist() == by_definition(tokens[at[i] : at[i + 1]], 28)
        else:
            assert (found[i] == ~np.uint64(0)).all()


def test_estimates_vary_less_than_independent_ones():
    """Agreement of two sets' signatures is unbiased and its variance below that of single draws."""
    rng = np.random.default_rng(9)
    places, shared = [], 12
    for _ in range(400):
        tokens = rng.integers(0, 1 << 63, 16).astype(np.uint64)
        both = np.concatenate((tokens[:14], tokens[:shared], tokens[14:]))
        s = signatures(both, np.array([0, 14, 28]), 32)
        places.append((s[0] == s[1]).mean())
    j = shared / 16
    assert abs(np.mean(places) - j) < 0.02 and np.var(places) < 0.8 * j * (1 - j) / 32


@pytest.mark.parametrize("settings", [SuperMinHash(), SuperMinHash(block=3), SuperMinHash(shingle=5)])
def test_groups_by_hand(spark, settings):
    texts = made(150) + EDGES + ["lang " * 30_000, " ".join(f"u{i}" for i in range(20_000))]
    ids = [i * 37 % 1009 for i in range(len(texts))]
    ids[3] = ids[10] = None
    ids[20] = ids[21]
    docs = frame(spark, texts, ids).repartition(3)
    found = near_duplicates(docs, settings)
    rows = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect())
    expected = collections.Counter(groups_of(texts, ids, settings.shingle, settings.at_least))
    # rows without words name themselves
    assert rows == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found.collect())
    assert near_duplicates(docs.limit(0), settings).count() == 0


def test_a_large_group_of_copies(spark):
    base = [f"w{i}" for i in range(40)]
    texts = [" ".join([*base[: i % 40], f"x{i}", *base[i % 40 + 1 :]]) for i in range(400)] + [" ".join(base)] * 300
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = groups_of(texts[:401], range(401), 2, 80)
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    assert all(found[i] == c for i, _, c in expected) and all(found[i] == found[400] for i in range(400, 700))


def test_union_find_across_tasks(spark):
    pairs = [(bytes([i // 256, i % 256]), bytes([(i + 1) // 256, (i + 1) % 256])) for i in range(0, 500) if i % 50 != 49]
    links = spark.createDataFrame(pairs, "a binary, b binary").repartition(7)
    found = {bytes(r["node"]): bytes(r["label"]) for r in grouped(links).collect()}
    for i in range(500):
        low = i // 50 * 50
        assert found[bytes([i // 256, i % 256])] == bytes([low // 256, low % 256])


def chains(spark, parts):
    """Chains 0-1-..-9, 10-..-19, ... of bytes and, by brute force, the label of every node."""
    pairs = [(bytes([i]), bytes([i + 1])) if i % 3 else (bytes([i + 1]), bytes([i])) for i in range(200) if i % 10 != 9]
    frame = spark.createDataFrame(pairs, "a binary, b binary").union(spark.createDataFrame([(b"z", b"z")], "a binary, b binary"))
    return frame.repartition(parts), {bytes([i]): bytes([i // 10 * 10]) for i in range(200)}


@pytest.mark.parametrize("parts, most", [(1, 1), (5, 5), (40, 5)])
def test_components_write_few_tables(spark, monkeypatch, parts, most):
    """Links of one task need no round of joins, links of many tasks few: every round is a plan on the driver."""
    tables = []
    monkeypatch.setattr(components, "saved", lambda frame: tables.append(kept := saved(frame)) or kept)
    links, expected = chains(spark, parts)
    found = [(bytes(r["node"]), bytes(r["label"])) for r in components.components(links).collect()]
    assert len(found) == len(expected) and dict(found) == expected
    assert len(tables) <= most
    assert components.components(links.limit(0)).count() == 0


def test_small_batches_of_links(spark, monkeypatch):
    """Groups come out whole also where a task hands on its links piece by piece."""
    links, expected = chains(spark, 3)
    monkeypatch.setattr(components, "FLUSH_LINKS", 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        found = [(bytes(r["node"]), bytes(r["label"])) for r in grouped(links).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found) == len(expected) and dict(found) == expected


@pytest.mark.parametrize("main, others", [(300, 5), (20, 20), (1, 1), (2, 9)])
def test_largest_group_of_a_key_is_not_dealt_out_to_pairs_of_blocks(spark, main, others):
    """All pairs of different groups meet once; rows follow the members and not their square."""
    labels = ["m"] * main + [f"o{i // 2}" for i in range(others)]
    rows = [(7, f"s{i:03}".encode(), 1, x.encode(), len(labels)) for i, x in enumerate(labels)]
    rows += [(8, f"s{i:03}".encode(), 1, b"m", 4) for i in range(4)]
    labelled = spark.createDataFrame(rows, "key long, sig binary, n long, label binary, members long")
    settings = SuperMinHash(block=8)
    dealt = super_minhash.dealt_out(super_minhash.open_members(labelled, settings)).collect()
    groups, met = {}, {}
    for r in dealt:
        assert r["key"] == 7
        groups.setdefault((r["i"], r["j"]), []).append(r)
    for (i, j), held in groups.items():
        left, right = super_minhash._sides(i, j, np.array([r["own"] for r in held]))
        pairs = {frozenset((bytes(held[x]["sig"]), bytes(held[y]["sig"]))) for x in left for y in right if held[x]["label"] != held[y]["label"]}
        for pair in pairs:
            met[pair] = met.get(pair, 0) + 1
    sigs = [(f"s{i:03}".encode(), x) for i, x in enumerate(labels)]
    assert met == {frozenset((a, b)): 1 for a, x in sigs for b, y in sigs if a < b and x != y}
    if main == 300:
        assert len(dealt) <= main + others * (1 + main // 64)
