"""The mix against resharing by hand and serving one copy at a time."""

from __future__ import annotations

import hashlib
import re

import pytest

from modspark.llm.mixing import Mix, mix_report, mixed

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, size string"


def by_hand(rows):
    """(doc_id, source, size) -> (target, copies), with the excess handed on round by round."""
    sized = [(d, s, len(WORD.findall(t or ""))) for d, t, s, _ in rows]
    sources = sorted({s for _, s, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    size = {s: sum(n for _, o, n in sized if o == s) for s in sources}
    total, full, target = sum(size.values()), set(), {}
    while True:
        left = total - sum(3 * size[s] for s in full)
        open_weight = sum(weight[s] for s in sources if s not in full)
        target = {s: 3 * size[s] if s in full else left * weight[s] / open_weight for s in sources}
        above = {s for s in sources if target[s] > 3 * size[s]}
        if not above - full:
            break
        full |= above
    key = lambda r: hashlib.md5(f"mix{'-' if r[0] is None else r[0]}".encode()).hexdigest()
    copies = []
    for s in sources:
        until = 0
        for r in sorted((r for r in sized if r[1] == s), key=key):
            until += r[2]
            copies += [((k * size[s] + until) / weight[s], sources.index(s), k, key(r), r) for k in range(3)]
    taken, spent = dict.fromkeys(sized, 0), 0
    for copy in sorted(copies):
        spent += copy[-1][2]
        if spent > total:
            break
        taken[copy[-1]] += 1
    return {r: (target[r[1]], taken[r]) for r in sized}


def corpus(sizes):
    rows, at = [], 0
    for source, counts in sizes.items():
        for n in counts:
            rows.append((at, " ".join(["w"] * n), source, "x"))
            at += 1
    return rows


CASES = {
    "hot source": {"a": [3, 40, 7] * 8, "b": [5] * 3, "c": [2, 2, 90], "d": [11] * 9, None: [6]},
    "one source": {"only": [4, 9, 2]},
    "small heavy source": {"a": [1, 2], "b": [50] * 10, "c": [30] * 10},
}


@pytest.mark.parametrize("case", CASES)
def test_report(spark, case):
    rows = corpus(CASES[case])
    found = mix_report(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = by_hand(rows)
    assert len(found) == len(rows)
    for r in found:
        target, copies = expected[r["doc_id"], r["source"], r["size"]]
        assert r["target"] == pytest.approx(target) and 0 <= r["target"] <= 3 * r["source_size"]
        assert r["copies"] == copies and r["taken"] == copies * r["size"]
    for source in {r["source"] for r in found}:
        own = [r for r in found if r["source"] == source]
        largest = max(r["size"] for r in found)
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 2 * largest


def test_mix_has_every_copy_and_own_columns(spark):
    docs = spark.createDataFrame(corpus(CASES["hot source"]), SCHEMA)
    plan = {r["doc_id"]: r["copies"] for r in mix_report(docs).collect()}
    rows = mixed(docs).collect()
    found = {}
    for r in rows:
        assert r["size"] == len(WORD.findall(r["text"]))
        found.setdefault(r["doc_id"], []).append(r["copy"])
    assert {d: len(c) for d, c in found.items()} == {d: c for d, c in plan.items() if c}
    assert all(sorted(c) == list(range(len(c))) for c in found.values())


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(None, "a b", None, None), (None, "a b", None, None), (1, None, "s", None), (1, "", "s", None), (2, "x " * 5000, "s", None)]
    found = mix_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 5 and sum(r["size"] for r in found) == 5004
    assert len({(r["copies"], r["target"]) for r in found if r["doc_id"] is None}) == 1
    assert mix_report(spark.createDataFrame([], SCHEMA)).count() == 0
    blank = mix_report(spark.createDataFrame([(1, " ", "s", None)], SCHEMA)).collect()
    assert [(r["size"], r["taken"]) for r in blank] == [(0, 0)]


def test_weights_and_budget_share(spark):
    rows = corpus({"a": [1] * 600, "b": [1] * 600, "c": [1] * 600})
    found = mix_report(spark.createDataFrame(rows, SCHEMA), Mix(weights=(3, 2, 1))).collect()
    taken = {s: sum(r["taken"] for r in found if r["source"] == s) for s in "abc"}
    assert taken == {"a": 900, "b": 600, "c": 300}


@pytest.mark.parametrize("most", [1, 2, 3])
def test_documents_taken_at_most_so_often(spark, most):
    """With one copy each the budget is all there is, and all of it is taken."""
    rows = corpus({"a": [3, 40, 7] * 4, "b": [5] * 3, None: [6, 9]})
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    found = mix_report(docs, Mix(most=most)).collect()
    total, taken = sum(r["size"] for r in found), sum(r["taken"] for r in found)
    assert all(r["taken"] <= most * r["size"] for r in found)
    assert taken == total if most == 1 else 0.8 * total <= taken <= total
