"""TF-IDF features and one logistic regression per label, as Spark ML stages.

The classifiers are fitted by ``newton``: their intercept is penalised like a weight, and all
labels, and all settings that share features, are fitted in the same passes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import islice, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from modspark import constants as K
from modspark.operators import newton
from modspark.operators.metrics import evaluate_labels, positive_weights, summarize, to_long
from modspark.operators.scoring import Scorer

_TEXT, _FEATURES = "_tfidf_text", "_tfidf"

SLICE_WORDS = 1 << 21
"""A task counts terms of texts taken together up to this many words; a longer text is a slice of its own."""
ROWS = 1 << 17
"""Counted terms that leave a task in one batch."""


@dataclass(frozen=True)
class TfidfSettings:
    max_features: int = 80_000
    ngram_range: tuple[int, int] = (1, 2)
    c: float = 4.0
    max_iter: int = 200
    use_pos_weight: bool = False


def _term_stages(ngram_range: tuple[int, int]) -> tuple[list[Transformer], str]:
    """Words of two or more word characters, lower-cased, and their n-grams."""
    words = RegexTokenizer(
        inputCol=_TEXT, outputCol="_words", pattern=f"[{K.WORD_CHARS}]{{2,}}", gaps=False, toLowercase=True
    )
    low, high = ngram_range
    stages: list[Transformer] = [words]
    parts = []
    for n in range(low, high + 1):
        if n == 1:
            parts.append("_words")
            continue
        stages.append(NGram(n=n, inputCol="_words", outputCol=f"_grams{n}"))
        parts.append(f"_grams{n}")
    stages.append(
        SQLTransformer(statement=f"SELECT *, concat({', '.join(parts)}) AS _terms FROM __THIS__")
    )
    return stages, "_terms"


def _through(stages: Sequence[Transformer], df: DataFrame) -> DataFrame:
    for stage in stages:
        df = stage.transform(df)
    return df


def _empty_text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


@dataclass(frozen=True)
class TfidfModel(Scorer):
    """Fitted stages; scores are the positive-class probabilities in label order."""

    labels: Sequence[str]
    stages: PipelineModel = field(repr=False)
    name: str = "tfidf_lr"

    def score(self, df, text, out, where=None):
        wanted = _empty_text(text) if where is None else F.when(where, _empty_text(text)).otherwise("")
        kept = df.columns
        scored = self.stages.transform(df.withColumn(_TEXT, wanted))
        probs = F.array(
            *[
                F.coalesce(F.get(vector_to_array(F.col(f"_prob_{x}")), F.lit(1)), F.lit(0.0)).cast("float")
                for x in self.labels
            ]
        )
        return scored.select(*kept, (probs if where is None else F.when(where, probs)).alias(out))

    def save(self, path: str) -> None:
        self.stages.write().overwrite().save(path)

    @staticmethod
    def load(path: str) -> "TfidfModel":
        stages = PipelineModel.load(path)
        columns = [s.getProbabilityCol() for s in stages.stages if isinstance(s, LogisticRegressionModel)]
        return TfidfModel([c.removeprefix("_prob_") for c in columns], stages)


def _levels(words: pa.Array, ngram_range: tuple[int, int]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(terms, occurrences, texts) of a list of words per text, n-gram length by length.

    A longer n-gram is numbered by the shorter one it begins with and its last word, so only
    distinct ones become strings.
    """
    known = words.flatten().dictionary_encode()
    place = np.asarray(known.indices).astype(np.int64)
    owner = np.repeat(np.arange(len(words)), np.diff(np.asarray(words.offsets)))
    number, names = place, known.dictionary
    low, high = ngram_range
    for n in range(1, high + 1):
        if n > 1:
            inside = np.flatnonzero(owner[n - 1 :] == owner[: len(owner) - n + 1]) if len(owner) >= n else np.zeros(0, int)
            code = number[inside] * len(known.dictionary) + place[inside + n - 1]
        else:
            inside, code = np.arange(len(place)), place
        if not len(code):
            return
        order = np.argsort(code, kind="stable")
        found, own = code[order], owner[inside][order]
        new = np.concatenate(([True], found[1:] != found[:-1]))
        other = new | np.concatenate(([True], own[1:] != own[:-1]))
        heads = np.flatnonzero(new)
        if n > 1:
            first, last = np.divmod(found[heads], len(known.dictionary))
            names = pc.binary_join_element_wise(names.take(pa.array(first)), known.dictionary.take(pa.array(last)), " ")
        else:
            names = names.take(pa.array(found[heads]))
        if n >= low:
            yield names, np.diff(np.append(heads, len(found))), np.add.reduceat(other.astype(np.int64), heads)
        number = np.zeros(len(owner), np.int64)
        number[inside[order]] = np.cumsum(new) - 1


def _slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Array]:
    """Lists of words, taken together until they hold ``most`` words; a longer text is a slice of its own."""
    held, size = [], 0
    for batch in batches:
        ends = np.asarray(batch.column(0).offsets)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most - size, side="right")) - 1)
            to = min(to, batch.num_rows)
            held.append(batch.column(0).slice(at, to - at))
            size += int(ends[to] - ends[at])
            at = to
            if size >= most or at < batch.num_rows:
                yield pa.concat_arrays(held)
                held, size = [], 0
    if held:
        yield pa.concat_arrays(held)


def _counted(words: DataFrame, ngram_range: tuple[int, int]) -> DataFrame:
    """term, n, texts: occurrences and texts of every term of words(array<string>).

    Tasks count slices of their texts, so what is shuffled has a row per distinct term of a slice
    and not one per occurrence. The null term has the number of all texts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _slices(batches, SLICE_WORDS):
            total = (pa.array([None], pa.string()), np.zeros(1, np.int64), np.array([len(texts)]))
            for found in (total, *_levels(texts, ngram_range)):
                for at in range(0, len(found[0]), ROWS):
                    term, n, held = (x[at : at + ROWS] for x in found)
                    yield pa.RecordBatch.from_arrays(
                        [term.cast(pa.string()), pa.array(n, pa.int64()), pa.array(held, pa.int64())], names=["term", "n", "texts"]
                    )

    counted = words.mapInArrow(count, "term string, n long, texts long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))


def _commonest(words: DataFrame, ngram_range: tuple[int, int], most: int) -> tuple[list[tuple[str, int]], int]:
    """The commonest terms with the number of their texts, and the number of all texts.

    Terms are taken by their occurrences, by name among equals, so that two fits agree. A
    table of how many terms have which count finds the least count that can stay; rarer
    terms are filtered out before the rest is put in order.
    """
    counted = _counted(words, ngram_range).persist(StorageLevel.DISK_ONLY)
    try:
        by_count = counted.filter("term IS NOT NULL").groupBy("n").agg(F.count("*").alias("terms"))
        down = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
        cut = by_count.withColumn("upto", F.sum("terms").over(down)).filter(F.col("upto") >= most)
        least = cut.agg(F.max("n")).first()[0] or 1
        top = counted.filter((F.col("n") >= least) & F.col("term").isNotNull()).orderBy(F.desc("n"), "term").limit(most)
        texts = counted.filter("term IS NULL").first()
        return [(r["term"], r["texts"]) for r in top.collect()], texts["texts"] if texts else 0
    finally:
        counted.unpersist()


def fit_features(df: DataFrame, text: str, settings: TfidfSettings) -> list[Transformer]:
    """Stages from text to unit-length TF-IDF vectors.

    The smoothed inverse document frequency plus one is a scaling vector; the vocabulary is
    the only thing the driver holds, limited by ``max_features``.
    """
    stages, terms_column = _term_stages(settings.ngram_range)
    words = stages[0].transform(df.select(_empty_text(text).alias(_TEXT))).select("_words")
    vocabulary, texts = _commonest(words, settings.ngram_range, settings.max_features)
    if not vocabulary:
        raise ValueError("no text has a term")
    counter = CountVectorizerModel.from_vocabulary([t for t, _ in vocabulary], inputCol=terms_column, outputCol="_tf")
    idf = [math.log((1 + texts) / (1 + n)) + 1.0 for _, n in vocabulary]
    scale = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_scaled")
    return [*stages, counter, scale, Normalizer(p=2.0, inputCol="_scaled", outputCol=_FEATURES)]


def _cells(vector: str) -> Column:
    """The non-zero cells of a sparse vector, one row each: place and value."""
    cut = F.unwrap_udt(vector)
    return F.inline(F.arrays_zip(cut["indices"].alias("place"), cut["values"].alias("value")))


def weighted_terms(df: DataFrame, stages: Sequence[Transformer], keys: Sequence[str], text: str) -> DataFrame:
    """``keys, term, weight``: the non-zero TF-IDF weights of every text."""
    counter = next(s for s in stages if isinstance(s, CountVectorizerModel))
    names = df.sparkSession.createDataFrame(list(enumerate(counter.vocabulary)), "place int, term string")
    vectors = _through(stages, df.select(*keys, _empty_text(text).alias(_TEXT)))
    cells = vectors.select(*keys, _cells(_FEATURES)).toDF(*keys, "place", "weight")
    return cells.filter("weight > 0").join(names, "place").select(*keys, "term", "weight")


def term_weights(model: "TfidfModel") -> DataFrame:
    """``term, label, weight`` of a fitted model, zeros left out; the intercept's term is null."""
    spark = SparkSession.getActiveSession()
    counter = next(s for s in model.stages.stages if isinstance(s, CountVectorizerModel))
    rows = []
    for stage in model.stages.stages:
        if isinstance(stage, LogisticRegressionModel):
            name = stage.getProbabilityCol().removeprefix("_prob_")
            found = stage.coefficients.toArray()
            rows.append((None, name, float(stage.intercept)))
            rows += [(counter.vocabulary[i], name, float(found[i])) for i in np.flatnonzero(found)]
    return spark.createDataFrame(rows, "term string, label string, weight double")


def gradient_size(
    model: "TfidfModel", df: DataFrame, settings: TfidfSettings, text: str = "text", labels: str = "labels"
) -> DataFrame:
    """``label, size``: the largest slope of each classifier's objective where training stopped.

    The objective is the mean weighted log loss plus the squared weights, intercept included,
    over twice C times the rows. A size near zero says that it has been minimised.
    """
    rows = _through(model.stages.stages, df.select(_empty_text(text).alias(_TEXT), labels))
    weights = _positive_weights(df, model.labels, labels, settings)
    misses = []
    for i, name in enumerate(model.labels):
        y = F.coalesce(F.get(F.col(labels), F.lit(i)), F.lit(0.0))
        w = F.when(y > 0, weights[name]).otherwise(1.0)
        misses.append((w * (F.get(vector_to_array(F.col(f"_prob_{name}")), F.lit(1)) - F.when(y > 0, 1.0).otherwise(0.0))).alias(f"m{i}"))
    # every row has one more cell of 1, for the intercept; it counts the rows as well
    cut = F.unwrap_udt(_FEATURES)
    one = F.array(F.struct(F.lit(-1).alias("place"), F.lit(1.0).alias("value")))
    held = F.arrays_zip(cut["indices"].alias("place"), cut["values"].alias("value"))
    cells = rows.select(*misses, F.inline(F.concat(one, held))).withColumnsRenamed({"value": "x"})
    added = [F.sum(F.col(f"m{i}") * F.col("x")).alias(f"g{i}") for i in range(len(misses))]
    slopes = {r["place"]: r for r in cells.groupBy("place").agg(F.count("*").alias("n"), *added).collect()}
    n = max(1, slopes[-1]["n"] if slopes else 0)
    penalty = 1.0 / (settings.c * n)
    fitted = {s.getProbabilityCol(): s for s in model.stages.stages if isinstance(s, LogisticRegressionModel)}
    found = []
    for i, name in enumerate(model.labels):
        classifier = fitted[f"_prob_{name}"]
        theta, intercept = classifier.coefficients.toArray(), classifier.intercept
        slope = {place: (r[f"g{i}"] or 0.0) / n for place, r in slopes.items()}
        sizes = [abs(slope.get(k, 0.0) + penalty * t) for k, t in enumerate(theta)]
        # a label that is the same in all rows has a constant classifier, without an objective
        sizes.append(abs(slope.get(-1, 0.0) + penalty * intercept) if math.isfinite(intercept) else 0.0)
        found.append((name, float(max(sizes))))
    return df.sparkSession.createDataFrame(found, "label string, size double")


def _positive_weights(rows: DataFrame, label_fields: Sequence[str], labels: str, settings: TfidfSettings) -> dict[str, float]:
    if not settings.use_pos_weight:
        return dict.fromkeys(label_fields, 1.0)
    return {r["label"]: float(r["pos_weight"]) for r in positive_weights(rows, label_fields, labels).collect()}


def _constant(data: newton.Data, width: int) -> dict[int, float]:
    """Places of the labels that all rows agree on, with the intercept that says so."""
    counts = data.blocks.map(lambda b: (b.target > 0).sum(axis=0)).fold(np.zeros(width), np.add)
    return {i: math.inf if k == data.rows and k else -math.inf for i, k in enumerate(counts) if k in (0, data.rows)}


def fitted_weights(
    features: DataFrame, size: int, trials: Sequence[TfidfSettings], weights: Mapping[str, float],
    label_fields: Sequence[str], labels: str,
) -> np.ndarray:
    """(trials x labels) x (features + intercept), all fitted in the same passes over the rows.

    ``weights`` are those of trials that weigh positive rows. A label that all rows agree on is
    not fitted; its intercept says so.
    """
    data = newton.Data.of(newton.blocks(features, _FEATURES, labels, len(label_fields)))
    try:
        constant = _constant(data, len(label_fields))
        return _fitted(data, size, trials, weights, label_fields, constant)
    finally:
        data.close()


def _fitted(
    data: newton.Data, size: int, trials: Sequence[TfidfSettings], weights: Mapping[str, float],
    label_fields: Sequence[str], constant: Mapping[int, float],
) -> np.ndarray:
    columns = [
        newton.Column(i, settings.c, weights[name] if settings.use_pos_weight else 1.0)
        for settings in trials
        for i, name in enumerate(label_fields)
    ]
    found = np.zeros((len(columns), size + 1))
    for k, column in enumerate(columns):
        found[k, -1] = constant.get(column.label, 0.0)
    open_columns = [k for k, column in enumerate(columns) if column.label not in constant]
    limits = {settings.max_iter for settings in trials}
    for limit in sorted(limits):
        own = [k for k in open_columns if trials[k // len(label_fields)].max_iter == limit]
        if own:
            found[own] = newton.minimised(data, size, [columns[k] for k in own], limit)
    return found


def _classifier(name: str, weights: np.ndarray) -> LogisticRegressionModel:
    """A Spark ML classifier with the given weights, the intercept last."""
    spark_context = SparkSession.getActiveSession().sparkContext
    uid = LogisticRegressionModel().uid
    vector = _py2java(spark_context, Vectors.dense(weights[:-1].tolist()))
    kind = "org.apache.spark.ml.classification.LogisticRegressionModel"
    model = LogisticRegressionModel(LogisticRegressionModel._new_java_obj(kind, uid, vector, float(weights[-1])))
    model._resetUid(uid)
    for setter, column in (
        (model.setFeaturesCol, _FEATURES),
        (model.setPredictionCol, f"_pred_{name}"),
        (model.setProbabilityCol, f"_prob_{name}"),
        (model.setRawPredictionCol, f"_raw_{name}"),
    ):
        setter(column)
    return model


def fit_classifiers(
    features: DataFrame, label_fields: Sequence[str], labels: str, settings: TfidfSettings, size: int
) -> list[LogisticRegressionModel]:
    """One classifier per label on a frame with vectors of ``size`` features and a label array.

    A label that all rows agree on gets a classifier that always says so.
    """
    weights = _positive_weights(features, label_fields, labels, settings)
    found = fitted_weights(features, size, [settings], weights, label_fields, labels)
    return [_classifier(name, found[i]) for i, name in enumerate(label_fields)]


def _size(stages: Sequence[Transformer]) -> int:
    return len(next(s for s in stages if isinstance(s, CountVectorizerModel)).vocabulary)


def train_tfidf_lr(
    df: DataFrame,
    label_fields: Sequence[str],
    settings: TfidfSettings = TfidfSettings(),
    text: str = "text",
    labels: str = "labels",
) -> TfidfModel:
    stages = fit_features(df, text, settings)
    features = _through(stages, df.select(_empty_text(text).alias(_TEXT), labels)).select(_FEATURES, labels)
    classifiers = fit_classifiers(features, label_fields, labels, settings, _size(stages))
    return TfidfModel(list(label_fields), PipelineModel([*stages, *classifiers]))


def trial_key(params: Mapping[str, object]) -> str:
    return ",".join(f"{k}={params[k]}" for k in sorted(params))


TRIALS = "params string, f1_micro double, f1_macro double, auc_macro double"


def finished_trials(spark: SparkSession, store: str | None) -> dict[str, Row]:
    """What a store of trials holds, by parameters; a store that is not there yet holds nothing."""
    if store is None:
        return {}
    try:
        return {r["params"]: r for r in spark.read.schema(TRIALS).parquet(store).collect()}
    except AnalysisException:
        return {}


def tune(
    train: DataFrame,
    validation: DataFrame,
    label_fields: Sequence[str],
    grid: Mapping[str, Sequence],
    max_trials: int = 6,
    done: DataFrame | None = None,
    threshold: float = 0.5,
    text: str = "text",
    labels: str = "labels",
    store: str | None = None,
) -> DataFrame:
    """``trial, params, f1_micro, f1_macro, auc_macro, best`` for the first combinations of a grid.

    Trials that share features are fitted together, in the same passes over the rows, and
    measured in one job. Finished trials are taken over from ``done`` and from the folder
    ``store``, to which every group of trials is appended when it is measured: a run that was
    ended goes on from there. The best trial has the highest micro F1, the earliest among equals.
    """
    names = list(grid)
    combos = [dict(zip(names, values)) for values in islice(product(*grid.values()), max_trials)]
    spark = train.sparkSession
    finished = {r["params"]: r for r in done.collect()} if done is not None else {}
    finished |= finished_trials(spark, store)
    groups: dict[tuple, list[int]] = {}
    for number, params in enumerate(combos):
        if trial_key(params) not in finished:
            settings = TfidfSettings(**params)
            groups.setdefault((settings.max_features, settings.ngram_range), []).append(number)
    for numbers in groups.values():
        trials = [TfidfSettings(**combos[k]) for k in numbers]
        found = _measured(train, validation, label_fields, trials, threshold, text, labels)
        rows = [(trial_key(combos[k]), *found[i]) for i, k in enumerate(numbers)]
        if store is not None:
            spark.createDataFrame(rows, TRIALS).coalesce(1).write.mode("append").parquet(store)
        finished |= {r[0]: Row(params=r[0], f1_micro=r[1], f1_macro=r[2], auc_macro=r[3]) for r in rows}
    results = []
    for number, params in enumerate(combos, 1):
        r = finished[trial_key(params)]
        results.append((number, r["params"], r["f1_micro"], r["f1_macro"], r["auc_macro"]))
    best = max(results, key=lambda r: (r[2], -r[0]))[0] if results else None
    return spark.createDataFrame(
        [(*r, r[0] == best) for r in results],
        "trial int, params string, f1_micro double, f1_macro double, auc_macro double, best boolean",
    )


def _measured(
    train: DataFrame, validation: DataFrame, label_fields: Sequence[str], trials: Sequence[TfidfSettings],
    threshold: float, text: str, labels: str,
) -> list[tuple[float, float, float]]:
    """f1_micro, f1_macro and auc_macro of trials that share their features."""
    stages = fit_features(train, text, trials[0])
    features = _through(stages, train.select(_empty_text(text).alias(_TEXT), labels)).select(_FEATURES, labels)
    weighing = next((settings for settings in trials if settings.use_pos_weight), trials[0])
    weights = _positive_weights(train, label_fields, labels, weighing)
    found = fitted_weights(features, _size(stages), trials, weights, label_fields, labels)
    rows = _through(stages, validation.select(_empty_text(text).alias(_TEXT), labels)).select(_FEATURES, labels)
    scored = newton.probabilities(newton.blocks(rows, _FEATURES, labels, len(label_fields)), found, len(trials))
    long = to_long(scored, label_fields, ["trial"], "labels")
    by_trial = {r["trial"]: r for r in summarize(evaluate_labels(long, ["trial"], threshold), ["trial"]).collect()}
    return [(by_trial[k]["f1_micro"], by_trial[k]["f1_macro"], by_trial[k]["auc_macro"]) for k in range(len(trials))]
