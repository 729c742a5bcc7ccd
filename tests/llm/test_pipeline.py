"""The pipeline stage by stage against brute force on each stage's own input."""

from __future__ import annotations

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from modspark.llm import quality, toxicity
from modspark.llm.queries import fold
from modspark.llm.store import saved
from tests.llm.test_mixing import by_hand
from tests.llm.test_models import INSULTS, sentence
from tests.llm.test_texts import LOWER, PLAIN, by_links

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(11)
    passage = " ".join(sentence(rng, 12) for _ in range(2))
    docs, labels = [], []
    for i in range(600):
        lines = [sentence(rng) for _ in range(rng.integers(3, 8))]
        toxic, good = i % 4 == 0, i % 5 != 1
        if toxic:
            for k in range(2):
                words = lines[k].split()
                lines[k] = " ".join([*words[:2], str(rng.choice(INSULTS)), *words[2:]])
        if i % 30 == 7:
            lines.append(passage)
        if not good:
            lines = [" ".join(w + "###" for w in line.split()) for line in lines]
        text = "\n".join(lines)
        if i % 6 == 3 and docs:
            text = docs[i - 2][1] + (" end." if i % 12 == 3 else "")
            toxic, good = labels[i - 2][1:]
        docs.append((i, text, "en", f"s{min(i % 9, 4)}" if i % 50 else None, len(text)))
        labels.append((i, int(toxic), int(good)))
    docs += [(1, docs[1][1], "en", docs[1][3], 5), (700, None, None, "s1", None), (None, docs[2][1], "en", "s1", 3)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder):
    """What every stage read, and what the last one returned."""
    read = [spark.read.parquet(f"{folder}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        read.append(saved(stage(spark, read[-1], folder)))
    return read


def ids(frame):
    return collections.Counter((r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect())


def test_columns_and_names(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights",
    ]
    assert all(frame.columns == COLUMNS for frame in stages[:-1])
    assert stages[-1].columns == [*COLUMNS, "size", "source_size", "target", "copy"]
    assert entry.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize(("at", "module", "held", "keep"), [(0, toxicity, 4, lambda s: s < 0.3), (1, quality, 5, lambda s: s >= 0.3)])
def test_rejecting_stages(spark, folder, stages, at, module, held, keep):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = module.fitted(stages[at], labels, fold(held) == {4: 2, 5: 0}[held])
    expected = collections.Counter((r["doc_id"], r["text"]) for r in module.scored(stages[at], model).collect() if keep(r["score"]))
    assert ids(stages[at + 1]) == expected
    # clean documents stay, the others go
    told = stages[at].join(labels, "doc_id").join(stages[at + 1].select("doc_id", F.lit(1).alias("kept")).distinct(), "doc_id", "left")
    clean = (F.col("toxic") == 0) if at == 0 else (F.col("quality") == 1)
    share = told.groupBy(clean.alias("clean")).agg(F.avg(F.coalesce("kept", F.lit(0))).alias("kept")).collect()
    assert {r["clean"]: round(r["kept"], 1) for r in share} == {True: 1.0, False: 0.0}


def test_one_of_each_group(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[2].select("doc_id", "text").collect()]
    groups = {}
    for row, (size, group) in zip(rows, by_links([t for _, t in rows]), strict=True):
        groups.setdefault(group if size else ("none", len(groups)), []).append(row)
    expected = [min(g, key=lambda r: (r[0] is None, r[0])) for g in groups.values()]
    assert sorted(i for i, _ in ids(stages[3]) if i is not None) == sorted(i for i, _ in expected if i is not None)
    assert stages[3].count() == len(groups)


def test_decontamination(spark, folder, stages):
    item = spark.read.parquet(f"{folder}/benchmark.parquet").filter("item_id = 1").first()["text"]
    cut = PLAIN.findall(item.translate(LOWER))
    windows = {tuple(cut[i : i + 10]) for i in range(len(cut) - 9)}

    def hit(text):
        words = PLAIN.findall((text or "").translate(LOWER))
        return any(tuple(words[i : i + 10]) in windows for i in range(len(words) - 9))

    before = ids(stages[3])
    assert ids(stages[4]) == collections.Counter({r: n for r, n in before.items() if not hit(r[1])})
    assert any(hit(t) for _, t in before)


def test_mix(stages):
    rows = [(r["doc_id"], r["text"], r["source"], None) for r in stages[4].collect()]
    expected = by_hand(rows)
    found = collections.Counter((r["doc_id"], r["source"], r["size"]) for r in stages[5].collect())
    assert found == collections.Counter({r: n for r, (_, n) in expected.items() if n})


def test_run_is_the_last_stage(spark, folder, stages):
    assert ids(corpus_pipeline.run(spark, folder)) == ids(stages[-1])
