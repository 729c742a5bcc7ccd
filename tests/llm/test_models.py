"""Learned operators on made rows: held-out accuracy, determinism, odd inputs; pages and packages."""

from __future__ import annotations

import base64
import hashlib
import io
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from modspark.llm import quality, toxicity
from modspark.llm.html_text import extracted, main_text
from modspark.llm.toxicity import kernel
from modspark.llm.warc_zip import BrokenPackage, RangeZip, WarcPackages, package, parsed, planned, read_records, record, round_trip, written
from modspark.llm.words import word_slices

INSULTS = ("idiot", "moron", "stupid", "scum")


def sentence(rng, n=9):
    syllables = ["ta", "ri", "mo", "len", "sko", "vi", "dar", "pu", "ne", "ost"]
    return " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(5)
    docs, labels = [], []
    for i in range(900):
        lines = [sentence(rng) for _ in range(rng.integers(3, 9))]
        toxic = i % 4 == 0
        if toxic:
            for k in range(2):
                words = lines[k].split()
                lines[k] = " ".join([*words[:2], str(rng.choice(INSULTS)), *words[2:]])
        good = i % 5 != 1
        if not good:
            lines = [" ".join(w + "###" for w in line.split()) for line in lines]
        docs.append((i, "\n".join(lines), 0.5, i))
        labels.append((i, int(toxic), int(good)))
    labels += [(None, 1, 1), (3, None, None), (9999, 1, 0), (4, 1, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score double, n int")
    return frame, spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def odd(spark):
    rows = [(None, None), (1, ""), (1, " \n "), (2, "### ... !!"), (3, "word " * 20_000), (3, "word " * 20_000), (4, "x" * 100_000)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize(("module", "column"), [(toxicity, "toxic"), (quality, "quality")])
def test_held_out_accuracy(spark, corpus, module, column):
    docs, labels = corpus
    held = F.col("doc_id") % 3 == 0
    model = module.fitted(docs, labels, held)
    found = module.scored(docs, model)
    assert found.columns == ["doc_id", "text", "n", "score"]
    rows = found.filter(held).join(labels.dropna().dropDuplicates(["doc_id"]), "doc_id").collect()
    right = [(r["score"] >= 0.3) == (r[column] == 1) for r in rows]
    assert np.mean(right) >= 0.95 and all(0 <= r["score"] <= 1 for r in rows)
    again = module.scored(docs, module.fitted(docs.repartition(7), labels, held)).collect()
    assert {r["doc_id"]: r["score"] for r in again} == {r["doc_id"]: r["score"] for r in found.collect()}
    strange = module.scored(odd(spark), model).collect()
    assert len(strange) == 7 and all(0 <= r["score"] <= 1 for r in strange)
    assert len({r["score"] for r in strange if r["doc_id"] == 3}) == 1
    assert module.scored(docs.limit(0), model).count() == 0
    nothing = module.scored(docs.limit(5), module.fitted(docs, labels.limit(0), held)).collect()
    assert all(0 <= r["score"] <= 1 for r in nothing)


def test_quality_is_fitted_away_from_the_driver(spark, corpus, monkeypatch):
    """The driver gets the tables of the model, no rows; they are those of the rows' own fit."""
    docs, labels = corpus
    rows = quality.described(docs).join(labels.dropna().dropDuplicates(["doc_id"]), "doc_id")
    rows = rows.orderBy(F.xxhash64("doc_id"), *quality.FEATURES).select(*quality.FEATURES, "quality").collect()
    table = np.array([tuple(r) for r in rows], float)
    expected = quality.trained(table[:, :-1], table[:, -1], quality.AdditiveFit())

    def refused(frame):
        raise AssertionError("rows on the driver")

    monkeypatch.setattr(type(docs), "toPandas", refused)
    model = quality.fitted(docs, labels, F.lit(False))
    assert model.base == expected.base and set(model.pairs) == set(expected.pairs) and model.pairs
    for found, own in ((model.cuts, expected.cuts), (model.single, expected.single)):
        assert len(found) == len(own) and all(np.array_equal(x, y) for x, y in zip(found, own, strict=True))
    assert all(np.array_equal(model.pairs[p], expected.pairs[p]) for p in expected.pairs)


def test_toxic_words_with_gaps_and_marks(corpus):
    docs, labels = corpus
    model = toxicity.fitted(docs, labels, F.lit(False))
    clean = " ".join(["ta ri moost len sko vi dar pune"] * 8)
    texts = [clean, *[f"{clean} {w} {clean} {w}" for w in ("idiot", "IDIOT!", "i.d.i.o.t", "idioot", "stupid***")]]
    scores = np.concatenate([model.score(model.text_inputs(w)) for w in word_slices(pa.array(texts))])
    assert scores[0] < 0.3 and (scores[1:] >= 0.3).all()


INSIDE = {
    "void": ("super<wbr>cali and <img src='a.png'> world, with an <input> too.", "supercali and world, with an too."),
    "phrasing": ("The <ruby>kan<rt>ji</rt></ruby>, an <acronym>HTML</acronym>, a <x-tag data-a='1'>new</x-tag> one.", "The kanji, an HTML, a new one."),
    "advert": ("Before <span class='advert'>Buy now!</span>after <em class=\"ad\">this <b>too</b></em>all, yes.", "Before after all, yes."),
    "unclosed advert": ("Before <span class='advert'>Buy now!", "Before"),
    "hidden": ("Seen <span hidden>not seen </span>again, <b style='color:red; display : none'>never</b>yes.", "Seen again, yes."),
    "hidden in a value": ("Seen <span class='a hidden b' title=' hidden '>also, yes</span>.", "Seen also, yes."),
    "link": ("A <a href='x'>link, here,</a> in the text.", "A link, here, in the text."),
}


@pytest.mark.parametrize("kind", INSIDE)
def test_pieces_of_a_line(kind):
    source, line = INSIDE[kind]
    rest = "".join(f"<p>{p}</p>" for p in ARTICLE)
    text = main_text(f"<body><article><h1>Title</h1><p>{source}</p>{rest}</article></body>").split("\n")
    assert text == ["Title", line, *PLAIN.split("\n")[1:]]


def test_hidden_blocks_own_headers_and_articles_of_links():
    rest = "".join(f"<p>{p}</p>" for p in ARTICLE)
    page = "<body><article><div class='post-header'><h1>Title here</h1></div><p hidden>Never, ever, seen.</p><div style=\"display:none\"><p>Nor, this, one.</p></div>{}</article></body>"
    assert main_text(page.format(rest)) == PLAIN
    links = "<body><ul><li><a href='/'>Home</a></li></ul><article><p><a href='x'>All of it, really, is a link.</a></p><p><a href='y'>And this.</a></p></article></body>"
    assert main_text(links) == "All of it, really, is a link.\nAnd this."
    assert main_text("<body><ul><li><a href='/'>Home</a></li></ul></body>") == ""


@pytest.mark.parametrize("length", [10, 100, 1000])
def test_insertions_are_caught_at_any_length(corpus, length):
    """Every place and several letters and marks in every trained insult; clean texts stay clean."""
    docs, labels = corpus
    model = toxicity.fitted(docs, labels, F.lit(False))
    rng = np.random.default_rng(11)

    def clean() -> str:
        return " ".join(sentence(rng, 10) for _ in range(length // 10))

    made = [w[:i] + c + w[i:] for w in INSULTS for i in range(1, len(w)) for c in "aeokxz.*"]
    texts = [f"{clean()} {w} {clean()} {w}" for w in made] + [clean() for _ in range(100)]
    scores = np.concatenate([model.score(model.text_inputs(w)) for w in word_slices(pa.array(texts))])
    assert (scores[: len(made)] >= 0.3).mean() >= 0.9 and (scores[len(made) :] < 0.3).mean() >= 0.98


@pytest.mark.parametrize("classes", [(), (0,), (1,), (0, 1), (0, 1, 1), (0, 0, 1), (0, 1, 0, 1), (1, 1, 1, 1, 0), (0, 1, 0, 1, 0, 1)])
def test_few_labels_do_not_end_the_fit(spark, classes):
    texts = ["ta ri mo. len sko", "you idiot. moron you"]
    rows = [(i, texts[y]) for i, y in enumerate(classes)]
    docs = spark.createDataFrame([*rows, (99, "vi dar")], "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(classes)), "doc_id long, toxic int")
    found = toxicity.scored(docs, toxicity.fitted(docs, labels, F.lit(False))).collect()
    assert len(found) == len(classes) + 1 and all(0 <= r["score"] <= 1 for r in found)


def test_kernel_is_that_of_subsequences():
    """The folded table equals kernel values summed over the definition."""
    words, landmarks = ["idiot", "idxiot", "abc", "a"], ["idiot", "abcd"]
    found = kernel(words, landmarks, 0.7)
    for i, w in enumerate(words):
        for j, v in enumerate(landmarks):
            a, b = by_hand(w), by_hand(v)
            dot = sum(a[k] * b.get(k, 0) for k in a)
            size = [np.sqrt(sum(c * weight**2 for (_, weight), c in many(x).items())) for x in (w, v)]
            assert found[i, j] == pytest.approx(dot / max(size[0], 1e-6) / max(size[1], 1e-6), abs=1e-4)


def many(word):
    out = {}
    padded = f"^{word}$"
    for i in range(len(padded)):
        for span in toxicity.SPANS:
            if i + span[-1] < len(padded):
                key = padded[i] + "".join(padded[i + k] for k in span)
                weight = 0.7 ** (span[-1] - len(span))
                out[key, weight] = out.get((key, weight), 0) + 1
    return out


def by_hand(word):
    out = {}
    for (key, weight), n in many(word).items():
        key = key.replace("$", "^")
        out[key] = out.get(key, 0) + weight * n
    return out


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.uniform(size=(4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.trained(x[:3000], y[:3000], quality.AdditiveFit(rounds=30))
    assert (0, 1) in model.pairs and ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


ARTICLE = [f"Paragraph {i} of the article, with commas, stops. And more words to read &amp; think about." for i in range(4)]
PLAIN = "\n".join(["Title here", *(p.replace("&amp;", "&") for p in ARTICLE)])
BODY = "<h1>Title  here</h1>" + "".join(f"<p>{p}</p>" for p in ARTICLE)
PAGES = {
    "plain": f"<html><head><title>t</title><script>var a='</p><p>no, no, no.';</script></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav>{{}}</body></html>",
    "div": "<body><div id=menu><a href=x>One</a> <a href=y>Two</a></div><div class='post'>{}</div><div class='sidebar'><p>Read this, too, please. It is long, long, long.</p></div></body>",
    "noise": "<body><header><p>Our site, the best, of all.</p></header><main>{}<aside><p>Ad, ad, ad.</p></aside><form><p>Your name, please.</p></form></main><div class=comments><p>First, I say, first!</p></div><div class='cookie-notice'>We use cookies, yes, we do.</div><footer>&copy; me, you, all.</footer></body>",
    "unclosed": "<body><article>{}<!-- <p>hidden, hidden.</p> -->",
    "cut": "<body><article>{}<p",
}


@pytest.mark.parametrize("kind", PAGES)
def test_main_text(kind):
    assert main_text(PAGES[kind].format(BODY)) == PLAIN


LEAD, LONG = "The lead, of some length, comes first. " * 8, "A longer part, with many words, follows it. " * 14
NESTED = {
    "list": f"<article><h1>The title</h1><p>{LEAD}</p><ul><li>{LONG}</li><li>{LONG}</li><li>{LONG}</li></ul></article>",
    "section": f"<article><h1>The title</h1><p>{LEAD}</p><section><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></section></article>",
    "quote": f"<article><h1>The title</h1><p>{LEAD}</p><blockquote><p>{LONG}</p><p>{LONG}</p></blockquote><p>{LEAD}</p></article>",
    "siblings": f"<h1>The title</h1><section><p>{LEAD}</p></section><div><p>{LONG}</p><p>{LONG}</p></div>",
}


@pytest.mark.parametrize("kind", NESTED)
@pytest.mark.parametrize("page", ["<body><nav><a href=x>One</a></nav>{}<footer>Us, you.</footer></body>", "<body><main>{}</main></body>"])
def test_main_text_of_several_containers(kind, page):
    lines = main_text(page.format(NESTED[kind])).split("\n")
    assert lines[:2] == ["The title", LEAD.strip()] and len(lines) == NESTED[kind].count("</p>") + NESTED[kind].count("</li>") + 1
    assert lines.count(LONG.strip()) >= 2


def test_pages_of_all_kinds(spark):
    long = "<article>" + "<p>Words, and words, and words.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None, "x"), (1, "u", "", "x"), (2, None, "no tags, only text.", "x"), (None, "u", "<a \"'<<>", "x"), (3, "u", long, "x"), (3, "u", long, "x")]
    found = extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert [r["n_chars"] for r in found if r["page_id"] == 1] == [0, 0]
    assert [r["text"] for r in found if r["page_id"] == 2] == ["no tags, only text."]
    assert [r["text"].count("\n") for r in found if r["page_id"] == 3] == [19_999] * 2
    assert len(found) == 6 and all(r["n_chars"] == len(r["text"]) for r in found)
    assert main_text("<p>a&nbsp;b<br>c &eacute;&#x41;</p>" + "<p>" + "<div>" * 5000) == "a b c éA"
    assert extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def pages(spark):
    big, other = "é" * 700 + "x" * 100, "y" * 1000
    rows = [(1, "http://a/1", big), (5, None, big), (3, "http://a\r\nX: y", big), (5, "http://a/5", big), (None, "n", big), (7, "u", other), (8, "u", "z" * 999),
            (9, "u", "z" * 999), (2, "u", None), (4, "u", ""), (None, "u", "q" * 2000), (None, "u", "q" * 2000), (11, "u", "w" * 300_000)]
    return rows, spark.createDataFrame([(*r, 0, "d") for r in rows], "page_id long, url string, html string, size int, digest string")


def test_round_trip(spark):
    rows, frame = pages(spark)
    found = sorted(map(tuple, round_trip(frame).collect()), key=str)
    expected = []
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        latest = max(same) if same and len(payload) >= 1000 else None
        again = latest is not None and page != latest
        expected.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", latest if again else None))
    assert found == sorted(expected, key=str)
    assert round_trip(frame.limit(0)).count() == 0


def test_payloads_come_back_and_packages_are_closed_by_size(spark):
    rows, frame = pages(spark)
    manifest = written(frame, WarcPackages(package_bytes=100))
    assert manifest.agg(F.sum("records")).first()[0] == len(rows) and manifest.count() == len(rows)
    back = {r["page_id"]: bytes(r["payload"]) for r in read_records(manifest).filter("record_type = 'response' and page_id is not null").collect()}
    assert back == {p: (h or "").encode() for p, _, h in rows if p in (5, 7, 8, 9, 2, 4, 11)}
    assert planned(frame, WarcPackages()).filter("refers_to is not null and payload is not null").count() == 0


def test_zip64_and_broken_packages():
    one = record(6, "u", b"abc", 3, hashlib.sha1(b"abc").hexdigest(), None, "2000-01-01T00:00:00Z")
    raw = package([one])
    assert zipfile.ZipFile(io.BytesIO(raw)).testzip() is None
    reader = lambda data: RangeZip(lambda at, n: data[at : at + n], len(data))
    start, size = reader(raw).start("archive/data.warc.gz")
    assert parsed(raw[start : start + size]) == (6, 3, hashlib.sha1(b"abc").hexdigest(), "response", None, b"abc")
    # the same directory, found through the ZIP64 records
    end = raw.rfind(b"PK\x05\x06")
    count, length, at = int.from_bytes(raw[end + 10 : end + 12], "little"), int.from_bytes(raw[end + 12 : end + 16], "little"), int.from_bytes(raw[end + 16 : end + 20], "little")
    wide = b"PK\x06\x06" + (44).to_bytes(8, "little") + bytes(12) + b"".join(x.to_bytes(8, "little") for x in (count, count, length, at))
    locator = b"PK\x06\x07" + bytes(4) + end.to_bytes(8, "little") + (1).to_bytes(4, "little")
    tail = b"PK\x05\x06" + bytes(4) + b"\xff" * 12 + (3).to_bytes(2, "little") + b"abc"
    assert reader(raw[:end] + wide + locator + tail).members == reader(raw).members
    for broken in (raw[:-30], b"", raw[:end] + tail):
        with pytest.raises((BrokenPackage, ValueError)):
            reader(broken)
    wrong = record(6, "u", b"abd", 3, hashlib.sha1(b"abc").hexdigest(), None, "2000-01-01T00:00:00Z")
    with pytest.raises(BrokenPackage):
        parsed(wrong)
    assert base64.b32encode(hashlib.sha1(b"abc").digest()) in __import__("zlib").decompress(one, 31)
