"""Operators on texts against brute force, with nulls, repeats, long texts and clashing columns."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from modspark.llm import decontamination, licenses, line_rules
from modspark.llm.jaccard_join import JaccardJoin, one_of_each, similar_documents, token_filter
from modspark.llm.lm_scoring import BloomModel, estimates, scored

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, source string, lang string, words string, n int, key string, label string, size int"


def made(n: int, seed: int = 3) -> list[str]:
    """Texts with near copies, shared passages, short and blank ones."""
    state = seed
    out: list[str] = []

    def pick(k: int) -> int:
        nonlocal state
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        return (state >> 33) % k

    shared = " ".join(f"p{i}" for i in range(40))
    for i in range(n):
        kind = pick(6)
        words = [f"Wort{pick(400)}é" if pick(5) == 0 else f"w{pick(60)}" for _ in range(12 + pick(70))]
        if kind == 0 and out:
            words = out[pick(len(out))].split(" ")
            for _ in range(pick(4)):
                words[pick(len(words))] = f"x{pick(999)}"
        if kind == 1:
            words[3:3] = shared.split()
        out.append(("\n" if kind == 2 else " ").join(words))
    return out


def frame(spark, texts, ids=None):
    rows = [
        (i if ids is None else ids[i], t, f"s{i % 3}" if i % 7 else None, None, "w", 1, "k", "l", 5) for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


EDGES = [None, "", " \n\t", "one", "One two", "a b c d", "A b C d", "a b c d"]


@pytest.fixture(scope="module")
def texts():
    return made(150) + EDGES + ["lang " * 30_000, " ".join(f"u{i}" for i in range(20_000))]


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def by_links(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("settings", [JaccardJoin(), JaccardJoin(frequent=2, filter_bytes=1 << 10), JaccardJoin(frequent=1)])
def test_similar_documents(spark, texts, settings):
    expected = by_links(texts)
    found = similar_documents(frame(spark, texts), settings).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]


def test_token_filter_takes_few_jobs(spark, texts):
    """Its segments come in a few jobs, not in one for every partition."""
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    spark.sparkContext.setJobGroup("token filter", "")
    try:
        known = token_filter(frame(spark, texts), JaccardJoin())
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("token filter")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in was.items():
            spark.conf.set(k, v)
    assert known.table.any() and len(jobs) < 20


def test_all_links_between_different_sets_are_counted(spark):
    base = [f"t{i}" for i in range(100)]
    family = [" ".join(base)] * 2
    for i in range(60):
        words = list(base)
        for k in range(1 + i % 3):
            words[(7 * i + 31 * k) % 100] = f"e{i}x{k}"
        family.append(" ".join(words))
    texts = [*family, "a b c d e f g h i j", "A b c d e f g h i j", *(" ".join(f"q{i}" for i in range(40 + k)) for k in (0, 1)), None, "one"]
    sets = [shingles(t) for t in texts]

    def similar(x, y):
        return 100 * len(x & y) >= 85 * len(x | y)

    different = {frozenset(x) for x in sets if x}
    expected = [sum(bool(x) and x != y and similar(x, y) for y in different) for x in sets]
    assert any(2 < n < 50 for n in expected) and expected[-1] == expected[-2] == 0
    for settings in (JaccardJoin(), JaccardJoin(frequent=8, block_sets=7)):
        found = similar_documents(frame(spark, texts), settings).collect()
        assert [r["n_links"] for r in sorted(found, key=lambda r: r["doc_id"])] == expected


def test_family_of_copies_is_one_component(spark):
    base = [f"t{i}" for i in range(200)]
    family = [" ".join(base)] * 30
    for i in range(150):
        words = list(base)
        words[i % 200] = f"e{i}"
        family.append(" ".join(words))
    found = similar_documents(frame(spark, family), JaccardJoin(frequent=8)).collect()
    assert {r["component_id"] for r in found} == {0}
    assert one_of_each(frame(spark, family), JaccardJoin(frequent=8)).count() == 1


def test_one_of_each_keeps_rows_without_words_and_odd_ids(spark):
    rows = ["a b c d e", "a b c d e", "other words are here", None, None, " ", "x y z x y z", "a b c d e"]
    ids = [5, 3, 3, 1, 1, 2, None, 3]
    kept = one_of_each(frame(spark, rows, ids)).collect()
    expected = [(1, None), (1, None), (2, " "), (3, "a b c d e"), (3, "other words are here"), (None, "x y z x y z")]
    order = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=order) == sorted(expected, key=order)
    assert kept[0].__fields__ == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    assert one_of_each(frame(spark, [])).count() == 0 and similar_documents(frame(spark, [])).count() == 0


def test_language_model(spark, texts):
    docs = frame(spark, texts)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    found = {r["doc_id"]: r for r in scored(docs, held, BloomModel(mass=50.0)).collect()}
    tokens = {i: [*WORD.findall((t or "").translate(LOWER)), "\0"] for i, t in enumerate(texts)}
    one, two = collections.Counter(), collections.Counter()
    for i, ws in tokens.items():
        if zlib.crc32(str(i).encode()) % 10:
            one.update(ws)
            two.update(zip(ws, ws[1:], strict=False))
    total, norm = one.total(), one.total() + 0.1 * (len(one) + 1)
    level = lambda c: 0 if not c else 1 + math.floor(math.log(c) / math.log(1.5) + 1e-9)
    for i, ws in tokens.items():
        r = found[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 10 == 0)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(one[w] > 0 for w in ws), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((one[w] + 0.1) / norm) for w in ws))
        # the model from exact counts, but on the filter's scale
        mid = lambda c: BloomModel().middles(64)[level(c)]
        p = lambda w: (mid(one[w]) + 0.1) / norm
        exact = math.log10(p(ws[0])) + sum(
            math.log10((min(mid(two[a, b]), mid(one[a]), mid(one[b])) + 50 * p(b)) / (mid(one[a]) + 50)) for a, b in zip(ws, ws[1:], strict=False)
        )
        assert r["score"] == pytest.approx(exact, rel=1e-3)
    assert scored(frame(spark, []), held).count() == 0


def test_language_model_with_a_filter_far_too_small(spark, texts):
    docs = frame(spark, texts)
    held = F.col("doc_id") % 5 == 0
    tiny = scored(docs, held, BloomModel(unigram_bytes=1 << 18, bigram_bytes=1)).collect()
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in tiny)
    nothing_learned = scored(docs, F.lit(True)).collect()
    assert {(r["n_known"], r["train_tokens"]) for r in nothing_learned} == {(0, 0)}


def test_language_model_is_as_good_in_a_filter_that_has_to_grow(spark, texts):
    docs = frame(spark, texts + made(300, seed=8))
    held = F.col("doc_id") % 3 == 0
    exact, grown = (
        {r["doc_id"]: r for r in scored(docs, held, model).collect()} for model in (BloomModel(), BloomModel(unigram_bytes=1, bigram_bytes=1))
    )
    off = [abs(grown[i]["score"] - exact[i]["score"]) / exact[i]["n_tokens"] for i in exact]
    assert sum(off) / len(off) < 0.02 and max(off) < 0.15


def test_estimates_are_right_on_average_for_false_levels():
    model, rate = BloomModel(), 0.2
    for true in (1, 3, 8):
        steps = [(rate**j * (1 - rate), true + j) for j in range(50)]
        mean = sum(p * estimates([level], rate, model)[0] for p, level in steps)
        assert mean == pytest.approx(model.middles(64)[true], rel=1e-3)


PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_contamination(spark, texts):
    items = [
        (1, " ".join(f"p{i}" for i in range(5, 25)), 0),
        (2, "Wort7é w3", 0),
        (10, " ".join(f"p{i}" for i in range(20)), 0),
        (4, None, 0),
        (5, "!! ..", 0),
        (6, "never seen these words at all in any of the texts", 0),
        (7, "lang " * 10, 0),
        (7, "lang " * 10, 0),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string, word int")
    texts = [*texts, None, "P5, p6; P7 p8 p9 p10 p11 p12 p13 p14 -- p15"]
    found = decontamination.contamination(frame(spark, texts), bench).collect()
    assert len(found) == len(texts)
    cut = lambda t: PLAIN.findall((t or "").translate(LOWER))
    windows = set()
    for item, text, _ in items:
        ws = cut(text)
        windows |= {(item, tuple(ws[i : i + 10])) for i in range(max(1, len(ws) - 9))} if ws else set()
    for r in found:
        ws = cut(texts[r["doc_id"]])
        hit, ids = set(), set()
        for item, w in windows:
            for i in range(len(ws) - len(w) + 1):
                if ws[i] == w[0] and tuple(ws[i : i + len(w)]) == w:
                    hit |= set(range(i, i + len(w)))
                    ids.add(str(item))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (len(ws), len(hit), len(ids), digest)
        assert r["contaminated"] == bool(hit)
    clean = decontamination.decontaminated(frame(spark, texts), bench)
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in found if not r["contaminated"]}
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(frame(spark, texts[:9]), empty).filter("contaminated").count() == 0
    assert decontamination.contamination(frame(spark, []), bench).count() == 0


def test_contamination_of_repeated_and_null_rows(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = frame(spark, ["x alpha beta gamma", "x alpha beta gamma", "clean", None], [None, None, 4, None])
    found = sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"]) for r in decontamination.contamination(docs, bench).collect())
    assert found == [(0, 0, 0), (0, 4, 3), (0, 4, 3), (4, 1, 0)]


def test_line_rules(spark, texts):
    boiler = "\n".join(["Click here to subscribe 2024", "again and again and again and again and again"])
    texts = [*texts, *[f"{boiler}\n" + " ".join("c" * i + "x" * j for j in range(1, 61)) for i in range(25)]]
    texts += [f"{boiler} \nonly {i} " + "word " * 3 + " ".join(f"v{i}x{j}" for j in range(5)) for i in range(30)]
    texts += ["\n".join(["CLICK here to   subscribe 7"] * 15 + [f"u{i}"]) for i in range(3)]
    docs = frame(spark, texts).withColumn("source", F.lit("one host"))
    found = line_rules.measured(docs).collect()
    assert len(found) == len(texts)
    normal = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]+", "0", x.lower())).strip(" ")
    seen = collections.Counter(line for t in texts for line in {normal(x) for x in (t or "").split("\n") if WORD.search(x)})
    for r in found:
        text = texts[r["doc_id"]] or ""
        words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        runs = collections.Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {i + k for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for k in range(3)}
        removed = sum(len(WORD.findall(x)) for x in lines if seen[normal(x)] > 20)
        left = len(words) - removed
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        kept = not failed and not (removed and (left < 20 or 100 * left < 30 * len(words)))
        assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert r["n_dup_lines"] == len(lines) - len(set(lines)) and r["n_repeat_words"] == len(covered)
        assert (r["base_failed"], r["kept"], r["removed_words"]) == (failed, kept, removed)
    assert any(not r["kept"] and not r["base_failed"] for r in found) and any(r["kept"] and r["removed_words"] for r in found)


def test_line_rules_count_repeated_rows_once(spark):
    text = "the same line\n" + " ".join(f"w{i}" for i in range(60))
    docs = frame(spark, [text] * 30, [1] * 15 + [None] * 15)
    found = line_rules.measured(docs.withColumn("source", F.lit(None).cast("string"))).collect()
    assert len(found) == 30 and {(r["kept"], r["removed_words"]) for r in found} == {(True, 0)}
    assert line_rules.measured(frame(spark, [])).count() == 0


def test_licenses(spark):
    words = " ".join(f"w{i}" for i in range(40))
    rows = [
        ("a/LICENSE", f"{words}\nReleased under the MIT License."),
        ("a/x/one", words),
        ("a/x/two", f"{words}\nLicensed under the Apache License, Version 2.0."),
        ("a/y/z/three", None),
        ("a/y/LICENSE.txt", "This work is licensed under the GNU General Public License, version 3."),
        ("b/four", f"{words} license of nothing that anyone knows\n"),
        ("five", "Licensed under CC BY-NC 4.0.\nmore " + words),
        ("five", "Licensed under CC BY-NC 4.0.\nmore " + words),
        (None, "Released under the MIT License."),
        (None, ""),
    ]
    files = spark.createDataFrame([(*r, "x", 1) for r in rows], "path string, text string, license string, n_terms int")
    found = licenses.scanned(files, ["path", "text"]).collect()
    told = collections.Counter((r["path"], r["own_license"], r["license"], r["inherited_from"], r["license_file"]) for r in found)
    assert told == {
        ("a/LICENSE", "MIT", "MIT", None, True): 1,
        ("a/x/one", None, "MIT", "a", False): 1,
        ("a/x/two", "Apache-2.0", "Apache-2.0", None, False): 1,
        ("a/y/z/three", None, "GPL-3.0", "a/y", False): 1,
        ("a/y/LICENSE.txt", "GPL-3.0", "GPL-3.0", None, True): 1,
        ("b/four", None, None, None, False): 1,
        ("five", "CC-BY-NC-4.0", "CC-BY-NC-4.0", None, False): 2,
        (None, "MIT", "MIT", None, True): 1,
        (None, None, None, None, False): 1,
    }
    assert all(r["cosine"] > 0.99 for r in found if r["own_license"])
    assert licenses.scanned(files.filter("1 = 0"), ["path"]).count() == 0


def test_license_lines_without_cue_words(spark):
    rows = [
        ("a", "CC BY-SA 4.0"), ("b", "Released under the MIT"), ("c", "Licensed under the MIT"), ("d", "GNU General Public, version 3"),
        ("e", "We were released under it."), ("f", "4.0"), ("g", "permit all of it"), *((f"x{i}", f"some words w{i} and the like") for i in range(50)),
    ]
    found = licenses.scanned(spark.createDataFrame(rows, "path string, text string"), ["path"]).collect()
    weight = lambda t: math.log((len(rows) + 1) / (sum(t in re.findall(licenses.TERM, x.lower()) for _, x in rows) + 1)) + 1

    def vector(text):
        return {t: n * weight(t) for t, n in collections.Counter(re.findall(licenses.TERM, text.lower())).items()}

    def cosine(a, b):
        size = lambda x: math.sqrt(sum(w * w for w in x.values()))
        return sum(w * b.get(t, 0) for t, w in a.items()) / size(a) / size(b)

    terms = {t for _, text in licenses.NOTICES for t in re.findall(licenses.TERM, text.lower())}
    told = {r["path"]: (r["own_license"], r["cosine"]) for r in found}
    for path, text in rows:
        own = {t: w if t in terms else n * (math.log(len(rows) + 1) + 1) for (t, w), n in zip(vector(text).items(), collections.Counter(re.findall(licenses.TERM, text.lower())).values(), strict=True)}
        best = max(cosine(own, vector(notice)) for _, notice in licenses.NOTICES)
        assert (told[path][0] is not None) == (best >= 0.6)
        assert best < 0.6 or told[path][1] == pytest.approx(best, abs=2e-6)
    assert told["a"][0] == "CC-BY-SA-4.0" and told["b"][0] == "MIT"
