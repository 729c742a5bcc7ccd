"""Toxicity by a subsequence string kernel, a support vector machine and Nyström landmarks.

Two words are alike by the subsequences of three to six letters they share, gaps included:
a subsequence counts less the more characters it skips, so insertions cost little. The
kernel is approximated on landmark words; a linear machine on that map is trained on words
of labelled sentences, where a toxic sentence only says that some word of it is toxic
(the machine and the choice of these words take turns). As kernel values are sums over
subsequences, the landmarks fold into one table of weights per subsequence, and a text is
scored by look-ups. A logistic curve on a text's highest word scores gives its score.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark.llm.scores import hashed_sample, with_score
from modspark.llm.words import BLANK, LOWER, Words, word_slices

TABLE_BITS = 21
"""Subsequences are known by a hash of so many bits."""
MOST_GAPS = {3: 2, 4: 1, 5: 1, 6: 0}
"""Letters of a subsequence, and characters it may skip."""
SPANS = tuple(
    (*between, letters - 1 + gaps)
    for letters, most in MOST_GAPS.items()
    for gaps in range(most + 1)
    for between in combinations(range(1, letters - 1 + gaps), letters - 2)
)
"""Places of the later letters after the first, for every kind of subsequence."""
TAIL = max(span[-1] for span in SPANS)
SENTENCE = r"[.!?\n]+\s*"


MARK = 28
HIGHEST = 3.0
"""Word scores count up to here."""


def symbol_table() -> np.ndarray:
    """Bytes as small numbers: 0 is a word's end, letters and digits are their own, ASCII marks are one."""
    table = np.zeros(256, np.uint32)
    for byte in range(256):
        low = int(LOWER[byte])
        if 97 <= low <= 122:
            table[byte] = low - 96
        elif 48 <= low <= 57:
            table[byte] = 27
        elif low < 128:
            table[byte] = MARK
        else:
            table[byte] = 29 + low % 35
    return table


SYMBOL = symbol_table()


@dataclass(frozen=True)
class ToxicityFit:
    """Bounds of the training sample and parameters of the machine.

    At most ``documents`` labelled documents of each class and ``sentences`` of their
    sentences of each class are used, chosen by a hash.
    """

    documents: int = 3000
    sentences: int = 50_000
    landmarks: int = 256
    decay: float = 0.7
    penalty: float = 1e-4
    turns: int = 5
    beside: float = 0.5
    """Next to a document's most toxic word others count from this share of its score on."""
    spoiled: int = 5
    """Copies of every toxic word with a character put in, so that gaps are learned."""
    lengths: tuple[int, ...] = (10, 100, 1000)
    """Clean words around the made variants that the curve is fitted on."""
    made: float = 0.004
    """Weight of a made variant in that fit; a document as it is has 1."""
    variants: int = 300
    """Documents of each class that variants are made of."""
    seed: int = 7


@dataclass
class ToxicityModel:
    weights: np.ndarray
    """Weight of every subsequence, by its hash."""
    bias: float
    decay: float
    curve: np.ndarray
    """Intercept and coefficients over the inputs of a text."""

    def word_scores(self, words: Words) -> np.ndarray:
        return subsequence_sums(words, self.weights, self.decay) + self.bias

    def text_inputs(self, words: Words) -> np.ndarray:
        """Per text: the two highest word scores, and how many words are toxic (as a logarithm)."""
        n = len(words.first) - 1
        out = np.tile(np.array([-3.0, -3.0, 0.0]), (n, 1))
        if not len(words.start):
            return out
        score = np.clip(self.word_scores(words), -3.0, HIGHEST)
        full = np.flatnonzero(np.diff(words.first) > 0)
        heads = words.first[:-1][full]
        top = np.maximum.reduceat(score, heads)
        text = words.text_of_word()
        best = np.zeros(n)
        best[full] = top
        rest = score.copy()
        at_top = np.flatnonzero(score == best[text])
        rest[at_top[np.unique(text[at_top], return_index=True)[1]]] = -3.0  # one of them only
        out[full, 0] = top
        out[full, 1] = np.maximum.reduceat(rest, heads)
        out[full, 2] = np.log1p(np.add.reduceat((score > 0).astype(float), heads))
        return out

    def score(self, inputs: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.curve[0] + inputs @ self.curve[1:], -30, 30)))


def letters(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, start, length): the words' letters with an end mark before and after, one after another.

    ASCII marks inside or around a word are passed over.
    """
    inside = SYMBOL[words.data[words.is_word]]
    counts = inside != MARK
    begins = np.zeros(len(words.start), np.int64)
    np.cumsum((words.end - words.start)[:-1], out=begins[1:])
    length = np.add.reduceat(counts.astype(np.int64), begins) + 2
    start = np.zeros(len(length), np.int64)
    np.cumsum(length[:-1], out=start[1:])
    symbols = np.zeros(int(length.sum()) + TAIL, np.uint32)
    letter = np.ones(len(symbols), bool)
    letter[start] = False
    letter[start + length - 1] = False
    letter[-TAIL:] = False
    symbols[letter] = inside[counts]
    return symbols, start, length


def stretch(span: tuple[int, ...], decay: float) -> float:
    return decay ** (span[-1] - len(span))


def hashed(symbols: np.ndarray, n: int, span: tuple[int, ...]) -> np.ndarray:
    """The hash of one kind of subsequence at each of the first n places."""
    key = symbols[:n] + np.uint32(64 * len(span))
    with np.errstate(over="ignore"):
        for k in span:
            key = key * np.uint32(0x01000193) + symbols[k : n + k]
        key *= np.uint32(0x9E3779B1)
    return key >> np.uint32(32 - TABLE_BITS)


def norms(length: np.ndarray, decay: float) -> np.ndarray:
    """Size of a word's map: all its stretched subsequences, each by itself."""
    total = np.zeros(len(length))
    for span in SPANS:
        total += np.maximum(length - span[-1], 0) * stretch(span, decay) ** 2
    return np.sqrt(np.maximum(total, 1e-12))


def subsequence_sums(words: Words, weights: np.ndarray, decay: float) -> np.ndarray:
    """For every word the weights of its subsequences, stretched ones decayed, over its norm."""
    symbols, start, length = letters(words)
    n = len(symbols) - TAIL
    room = (np.repeat(start + length, length) - np.arange(n)).astype(np.int32)
    total = np.zeros(n, np.float32)
    for span in SPANS:
        value = weights[hashed(symbols, n, span)] * np.float32(stretch(span, decay))
        value[room <= span[-1]] = 0
        total += value
    return np.add.reduceat(total, start) / norms(length, decay)


def word_map(words: list[str], decay: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, value) of the normalised maps of a list of words."""
    cut = next(word_slices(pa.array([" ".join(words)]), BLANK, most=1 << 40))
    symbols, start, length = letters(cut)
    n = len(symbols) - TAIL
    owner = np.repeat(np.arange(len(length)), length)
    room = np.repeat(start + length, length) - np.arange(n)
    size = norms(length, decay)
    rows, keys, values = [], [], []
    for span in SPANS:
        at = np.flatnonzero(room > span[-1])
        rows.append(owner[at])
        keys.append(hashed(symbols, n, span)[at].astype(np.int64))
        values.append(stretch(span, decay) / size[owner[at]])
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(values)


def kernel(words: list[str], landmarks: list[str], decay: float) -> np.ndarray:
    """Kernel values of words against landmarks, through a dense table of the landmarks."""
    r, k, v = word_map(landmarks, decay)
    used, k = np.unique(k, return_inverse=True)
    table = np.zeros((len(used) + 1, len(landmarks)), np.float32)
    np.add.at(table, (k, r), v)
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for at in range(0, len(words), 100):
        part = words[at : at + 100]
        r, k, v = word_map(part, decay)
        place = np.minimum(np.searchsorted(used, k), len(used) - 1)
        known = used[place] == k
        r, place, v = r[known], place[known], v[known].astype(np.float32)
        order = np.argsort(r, kind="stable")
        r, rows = r[order], table[place[order]] * v[order][:, None]
        if len(r):
            heads = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
            out[at + r[heads]] = np.add.reduceat(rows, heads, axis=0)
    return out


def stretched(word: str, rng: np.random.Generator) -> str:
    """The word with a letter put somewhere inside."""
    at = int(rng.integers(1, max(2, len(word))))
    return word[:at] + chr(97 + int(rng.integers(26))) + word[at:]


def landmark_map(landmarks: list[str], decay: float) -> tuple[list[str], np.ndarray]:
    """The landmarks and the inverse root of their kernel, which turns kernel values into coordinates."""
    gram = kernel(landmarks, landmarks, decay).astype(np.float64)
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    return landmarks, vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-2))) @ vector.T


def linear_machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """Squared hinge and a quadratic penalty, by Newton steps on the active rows."""
    z = np.hstack((x, np.ones((len(x), 1), x.dtype)))
    weight, y = weight.astype(z.dtype), y.astype(z.dtype)
    w = np.zeros(z.shape[1])
    ridge = penalty * np.eye(len(w))
    ridge[-1, -1] = 1e-9
    total = weight.sum()
    for _ in range(8):
        active = y * (z @ w.astype(z.dtype)) < 1
        a, wa = z[active], weight[active] / total
        new = np.linalg.solve((a.T @ (a * wa[:, None])).astype(float) + ridge, (a.T @ (wa * y[active])).astype(float))
        if np.abs(new - w).max() < 1e-4:
            break
        w = new
    return w[:-1], float(w[-1])


def labelled_sentences(docs: DataFrame, labels: DataFrame, fit: ToxicityFit) -> DataFrame:
    """doc_id, sentence, toxic: the bounded training sample.

    Labels are one row per document; the sample of them is bounded by a parameter, so it
    may be broadcast.
    """
    truth = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = []
    for toxic in (0, 1):
        chosen.append(hashed_sample(truth.filter(F.col("toxic") == toxic), "doc_id", fit.documents))
    sample = F.broadcast(chosen[0].union(chosen[1]))
    cut = docs.join(sample, "doc_id").select(
        "doc_id", "toxic", F.explode(F.split(F.coalesce("text", F.lit("")), SENTENCE)).alias("sentence")
    )
    cut = cut.filter(F.col("sentence").rlike(r"[^\x20\x09-\x0D]"))
    picked = [
        cut.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id", "sentence"), "doc_id", "sentence").limit(fit.sentences)
        for toxic in (0, 1)
    ]
    return picked[0].union(picked[1]).select("doc_id", "sentence", F.col("toxic").cast("int").alias("toxic"))


def word_list(sentence: str) -> list[str]:
    """The words of a sentence; equal words are one object, so that a sample is small."""
    return [sys.intern(w) for w in re.findall(r"[^\x20\x09-\x0D]+", sentence.translate(_LOWER))]


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def trained(sample: list[tuple[int, str, int]], share: float, fit: ToxicityFit) -> ToxicityModel:
    """Fit landmarks, machine and curve; ``share`` is that of toxic documents among all labelled ones.

    Without both classes every text scores the base rate."""
    both = {y for _, _, y in sample}
    empty = ToxicityModel(np.zeros(1 << TABLE_BITS, np.float32), -1.0, fit.decay, np.zeros(4))
    if both != {0, 1}:
        empty.curve[0] = -3.0 if 1 not in both else 3.0
        return empty
    texts: dict[int, list[str]] = {}
    label: dict[int, int] = {}
    for doc, sentence, y in sample:
        texts.setdefault(doc, []).extend(word_list(sentence))
        label[doc] = y
    every_text, (kept_back, taught) = texts, parted(label)
    texts = {d: texts[d] for d in taught}
    number = {w: i for i, w in enumerate(sorted({w for ws in texts.values() for w in ws}))}
    names = list(number)
    seen = np.zeros((2, len(names)))
    bags = {d: np.unique([number[w] for w in ws]) for d, ws in texts.items()}
    for d, bag in bags.items():
        seen[label[d], bag] += 1
    n = [max(1, sum(label[d] == c for d in texts)) for c in (0, 1)]
    lift = seen[1] / n[1] - seen[0] / n[0]
    spread = np.sqrt(seen.sum(0) + 1) / min(n)
    rng = np.random.default_rng(fit.seed)
    standing = lift / spread
    third = fit.landmarks // 3
    clean = np.flatnonzero(seen[0] > 0)
    marks = np.argsort(-standing, kind="stable")[:third]
    marks = np.union1d(marks, rng.choice(clean, min(third, len(clean)), replace=False))
    landmarks, root = landmark_map([names[i] for i in marks], fit.decay)

    def folded(w: np.ndarray, b: float) -> ToxicityModel:
        """The landmarks as one weight per subsequence."""
        r, k, v = word_map(landmarks, fit.decay)
        table = np.zeros(1 << TABLE_BITS)
        np.add.at(table, k, v * (root @ w)[r])
        return ToxicityModel(table.astype(np.float32), b, fit.decay, np.zeros(4))

    every = [pa.array([" ".join(names[i : i + 5000])]) for i in range(0, len(names), 5000)]
    toxic_docs = [d for d in texts if label[d] == 1]
    clean_pool = np.concatenate(
        (clean[np.argsort(-seen[0][clean], kind="stable")[:3000]], rng.choice(clean, min(3000, len(clean)), replace=False))
    )
    only = np.unique(np.concatenate([bags[d] for d in toxic_docs]))
    only = only[np.argsort(-standing[only], kind="stable")][:3000]
    pool = np.unique(np.concatenate((clean_pool, only)))
    # at first only words that several toxic documents share can be the toxic ones
    shared = seen[1] > 1
    score = np.where(shared, standing, -1.0) if shared.any() else standing.copy()
    model = folded(np.zeros(len(landmarks)), -1.0)
    for turn in range(fit.turns):
        # the toxic words of a toxic document are those that stand out most just now
        weight = np.zeros(len(names))
        for d in toxic_docs:
            best = bags[d][np.argsort(-score[bags[d]], kind="stable")[:3]]
            weight[best[score[best] > fit.beside * max(0.0, score[best[0]])]] += 1
        toxic = (weight > 0) & (seen[0] / n[0] < 0.2 * seen[1] / n[1])
        rows = np.union1d(pool, np.flatnonzero(toxic))
        rows = rows[toxic[rows] | (seen[0][rows] > 0)]
        spoiled = [stretched(names[i], rng) for i in rows[toxic[rows]] for _ in range(fit.spoiled)]
        x = kernel([names[i] for i in rows] + spoiled, landmarks, fit.decay) @ root.astype(np.float32)
        y = np.append(np.where(toxic[rows], 1.0, -1.0), np.ones(len(spoiled)))
        cost = np.where(toxic[rows], np.sqrt(weight[rows]), np.sqrt(seen[0][rows] + 1))
        cost = np.append(cost, np.repeat(cost[toxic[rows]], fit.spoiled) / max(1, fit.spoiled))
        if toxic.any():
            cost[y > 0] *= 0.5 * cost[y < 0].sum() / cost[y > 0].sum()
        w, b = linear_machine(x, y, cost, fit.penalty)
        model = folded(w, b)
        score = np.concatenate([model.word_scores(words) for part in every for words in word_slices(part)])
        # clean words that look most toxic join the next turn
        look_alike = clean[np.argsort(-score[clean], kind="stable")]
        pool = np.union1d(pool, look_alike[:2000])
        if turn == 0:
            marks = np.union1d(marks, look_alike[:third])
            landmarks, root = landmark_map([names[i] for i in marks], fit.decay)
    model.curve = fitted_curve(model, [(every_text[d], label[d]) for d in kept_back], share, fit, rng)
    return model


def parted(label: dict[int, int]) -> tuple[list[int], list[int]]:
    """(documents for the curve, documents for the machine): a third and the rest of each class.

    With so few labels that a class would be missing on a side, all documents are on both.
    """
    members = [sorted(d for d, y in label.items() if y == c) for c in (0, 1)]
    if min(map(len, members)) < 3:
        return (everyone := sorted(label)), everyone
    back = [d for m in members for d in m[2::3]]
    return back, sorted(set(label) - set(back))


def fitted_curve(
    model: ToxicityModel, docs: list[tuple[list[str], int]], share: float, fit: ToxicityFit, rng: np.random.Generator
) -> np.ndarray:
    """The curve over a text's inputs, from documents as they are and from made variants of them.

    The words that make a toxic document toxic are put, as they are and with a character put
    in, among clean words of several lengths; as many texts of these lengths are clean. So
    neither a spoiled word nor a long text around it lowers a score.
    """
    clean = [w for words, y in docs if not y for w in words]
    pool: list[list[str]] = []
    inputs: list[np.ndarray] = []
    truth, weight, held = [], [], 0

    def flush() -> None:
        nonlocal held
        if pool:
            inputs.extend(model.text_inputs(c) for c in word_slices(pa.array([" ".join(t) for t in pool])))
        pool.clear()
        held = 0

    def add(words: list[str], y: int, w: float) -> None:
        nonlocal held
        pool.append(words)
        truth.append(y)
        weight.append(w)
        held += len(words)
        if held > FLUSH_WORDS:
            flush()

    left = [fit.variants, fit.variants]
    for words, y in docs:
        add(words, y, 1.0)
        left[y] -= 1
        if left[y] < 0 or not clean:
            continue
        toxic = []
        if y:
            own = np.concatenate([model.word_scores(c) for c in word_slices(pa.array([" ".join(words)]))])
            toxic = [words[i] for i in np.flatnonzero(own > 0)]
        for length in fit.lengths:
            first = int(rng.integers(len(clean)))
            around = [clean[(first + i) % len(clean)] for i in range(length)]
            if not y:
                add(around, 0, fit.made)
            elif toxic:
                for chosen in (toxic[:1], [stretched(w, rng) for w in toxic[:2]], [stretched(toxic[-1], rng)] * 2):
                    add(around + chosen, 1, fit.made / 3)
    flush()
    return logistic(np.vstack(inputs), np.array(truth, float), share, np.array(weight))


FLUSH_WORDS = 1 << 16
"""Texts of so many words are measured at a time when the curve is fitted."""


def logistic(x: np.ndarray, y: np.ndarray, share: float, weight: np.ndarray, ridge: float = 1e-4) -> np.ndarray:
    """Logistic regression with the positive class weighted to its share, by Newton steps."""
    z = np.hstack((np.ones((len(x), 1)), x))
    total = [max(1e-9, weight[y == c].sum()) for c in (0, 1)]
    weight = weight * np.where(y > 0, share / total[1], (1 - share) / total[0])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = z.T @ (z * (weight * p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, z.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fitted(docs: DataFrame, labels: DataFrame, held_out: Column, fit: ToxicityFit = ToxicityFit()) -> ToxicityModel:
    """The model learned from labels of the documents that are not held out."""
    known = labels.filter(~held_out)
    share = known.filter("toxic is not null and doc_id is not null").agg(F.avg("toxic")).first()[0] or 0.0

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the bounded sample is one task's: the driver sees the finished model alone
        sample = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        model = trained(sample, share, fit)
        parts = [model.weights.tobytes(), model.bias, model.curve.tolist()]
        kinds = [pa.binary(), pa.float64(), pa.list_(pa.float64())]
        columns = [pa.array([x], kind) for x, kind in zip(parts, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["weights", "bias", "curve"])

    sample = labelled_sentences(docs, known, fit).repartition(1)
    row = sample.mapInArrow(train, "weights binary, bias double, curve array<double>").first()
    if row is None:  # a partition without rows may not run at all
        return trained([], share, fit)
    return ToxicityModel(np.frombuffer(row["weights"], np.float32), row["bias"], fit.decay, np.array(row["curve"]))


def scored(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """docs with ``score`` from 0 to 1 for every row; a null or blank text has no toxic word.

    Rows repeat as they come, equal texts score equally, whole texts count whatever their
    length. A column named score is replaced; all others stay.
    """
    return with_score(docs, model, lambda known, words: known.score(known.text_inputs(words)), lower=True)
