"""Text functions against plain Python on awkward inputs."""

import hashlib
import re
import string
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from modspark.functions import language, slices
from modspark.functions import text as X

TEXTS = [
    "",
    "   ",
    "plain words here",
    "a\x1cb\x1db\x1ec\x1fd",
    " lead and trail\t\r\n",
    "no break wide　space\x85end",
    "tab\tand  two  spaces \n \n mixed",
    "Émile ÉCOLE ß ǅ 1ª ²",
    "emoji 😀😀😀 !!! ??",
    "café combining",
    "line\n\n\nbreaks",
    "cr\r\r\rrun",
    "sep   run",
    "MAIL me: A.b+c@Example.CO or x@y.io1@z.com",
    "see HTTP://X.y and www.site.org/a?b, https://ok.com",
    "call +49 (030) 123 4567 or 12-34-56 now 1234567890",
    "digits ١٢ ٣٤ ٥٦ arabic",
    "é12345678 glued 123456",
    "quotes \" and '",
    string.punctuation,
    "aaa bb KKK",
]
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")
URL = re.compile(r"https?://\S+|www\.\S+")
PHONE = re.compile(
    r"\b(?:\+?\d{1,3}[\s-]?)?(?:\(\d{2,4}\)[\s-]?)?\d{2,4}[\s-]?\d{2,4}[\s-]?\d{2,4}\b"
)
PUNCT = set("!?.:,;\"'()[]{}<>/\\|@#$%^&*_+-=~`")


def expected_features(s):
    letters = [c for c in s if c.isalpha()]
    n = len(s)
    return {
        "length_chars": n,
        "length_words": len(s.split()),
        "uppercase_ratio": np.float32(sum(c.isupper() for c in letters) / len(letters)) if letters else 0,
        "punct_ratio": np.float32(sum(c in PUNCT for c in s) / n) if n else 0,
        "exclam": s.count("!"),
        "question": s.count("?"),
        "has_url": int(bool(re.search(URL.pattern, s, re.I))),
        "has_email": int(bool(re.search(EMAIL.pattern, s, re.I))),
        "has_repeat": int(bool(re.search(r"(.)\1{2,}", s))),
        "non_ascii_ratio": np.float32(sum(ord(c) > 127 for c in s) / n) if n else 0,
        "has_quote": int('"' in s or "'" in s),
    }


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_normalize(texts):
    got = by_id(texts.select("id", X.normalize(F.col("text")).alias("t")))
    for i, s in enumerate(TEXTS):
        assert got[i]["t"] == " ".join(s.split()), repr(s)


def test_normalize_null(spark):
    row = spark.range(1).select(X.normalize(F.lit(None).cast("string")).alias("t")).first()
    assert row["t"] == ""


def test_features(texts):
    got = by_id(texts.select("id", *X.all_features(F.col("text"))))
    for i, s in enumerate(TEXTS):
        for name, value in expected_features(s).items():
            assert got[i][name] == pytest.approx(value, abs=1e-7), (name, s)


def test_every_space_character(spark):
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    others = [chr(c) for c in (0x200B, 0x180E, 0xFEFF, 0x2060, 0x1B, 0x84)]
    rows = [(c, f"a{c}{c}b") for c in spaces + others]
    df = spark.createDataFrame(rows, "c string, text string")
    got = {r["c"]: r for r in df.select("c", X.normalize(F.col("text")).alias("t"), X.word_count(F.col("text")).alias("n")).collect()}
    assert all(got[c]["t"] == "a b" and got[c]["n"] == 2 for c in spaces)
    assert all(got[c]["n"] == 1 for c in others)


def test_redaction(texts):
    got = by_id(texts.select("id", X.redact_pii(F.col("text")).alias("t")))
    for i, s in enumerate(TEXTS):
        want = PHONE.sub("<PHONE>", URL.sub("<URL>", EMAIL.sub("<EMAIL>", s)))
        assert got[i]["t"] == want, s


def test_hashes(texts):
    got = by_id(texts.select("id", X.content_hash(F.col("text")).alias("h"), X.short_id(F.col("text")).alias("s")))
    for i, s in enumerate(TEXTS):
        want = hashlib.sha256(s.encode()).hexdigest()
        assert (got[i]["h"], got[i]["s"]) == (want, want[:12])


def test_slices(spark):
    groups = {"g": ["man", "wo-man"], "tag": ["#me"], "none": [" "], "k": ["KIM"]}
    samples = ["A Man!", "human", "manÉ", "éman", "wo-man x", "x#me", "x #me", "Kim here", "man_", "gay"]
    df = spark.createDataFrame([(s,) for s in samples], "text string")
    got = {r["text"]: set(r["s"]) for r in df.select("text", slices.slices_of(F.col("text"), groups).alias("s")).collect()}
    patterns = {
        g: re.compile(r"\b(" + "|".join(re.escape(t) for t in terms) + r")\b", re.I)
        for g, terms in slices.usable(groups).items()
    }
    for s in samples:
        want = {g for g, p in patterns.items() if p.search(s)}
        want |= {"any_identity_mention"} if want else {"no_identity_mention"}
        assert got[s] == want, s
    assert slices.slice_names(groups) == ["g", "tag", "k", "any_identity_mention", "no_identity_mention"]


def test_language_tests(spark):
    cases = ["en", "en-US", "English", "vi", "vi-VN", "VI Vietnamese", "fr", "", None]
    df = spark.createDataFrame([(c,) for c in cases], "lang string")
    got = df.select(language.is_english(F.col("lang")), language.is_vietnamese(F.col("lang"))).collect()
    assert [tuple(r) for r in got] == [(True, False)] * 3 + [(False, True)] * 3 + [(False, False)] * 3


def test_language_guard(spark):
    cases = [("  ab  ", "en"), ("abc", "en"), (None, "en"), ("a b", "fr"), ("long text", None), ("long", ""), (" a ", "de")]
    df = spark.createDataFrame(cases, "text string, lang string")
    got = [r[0] for r in df.select(language.guarded(F.col("text"), F.col("lang"))).collect()]
    assert got == ["unknown", "en", "unknown", "fr", "unknown", "unknown", "unknown"]


def test_patterns_take_linear_time_on_long_runs(spark):
    runs = ["a" * 1_000_000 + "@", "@" + "a" * 1_000_000, "http" * 250_000, "1" * 1_000_000, "a" * 500_000 + " x@y.io1@z.com"]
    rows = spark.createDataFrame([(t,) for t in runs], "text string").coalesce(1)
    start = time.perf_counter()
    found = [r[0] for r in rows.select(X.redact_pii(F.col("text"))).collect()]
    flags = [r[0] for r in rows.select(X.feature("has_email", F.col("text"))).collect()]
    assert time.perf_counter() - start < 20
    assert flags == [0, 0, 0, 0, 1] and found[0] == runs[0]


def test_adjacent_addresses_give_two_marks(spark):
    mark = spark.range(1).select(X.redact_pii(F.lit("x@y.io"))).first()[0]
    assert spark.range(1).select(X.redact_pii(F.lit("x@y.io1@z.com"))).first()[0].count(mark) == 2
