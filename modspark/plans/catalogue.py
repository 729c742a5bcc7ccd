"""The registered queries: each reads the given tables and returns one result table.

Doubles are rounded to six digits, since sums are formed in no fixed order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modspark import constants as K
from modspark.config import LogSettings, SplitSettings
from modspark.functions import labels as L
from modspark.functions import text as X
from modspark.functions.language import is_english, is_vietnamese
from modspark.functions.numbers import at_least, sigmoid
from modspark.functions.slices import slices_of
from modspark.operators import (
    errors,
    fairness,
    governance,
    identity,
    langid,
    metrics,
    monitoring,
    moderation,
    order_stats,
    prepare,
    sampling,
    tfidf,
    thresholds,
)
from modspark.operators.moderation import moderate
from modspark.operators.scoring import BatchScorer, MapScorer
from modspark.plans import reports as reports_plan
from modspark.plans import standins as S
from modspark.session import work_folder
from modspark.sources import datasets, logs, reports, requests, settings_files, shards
from modspark.streaming import daily
from modspark.streaming import moderation as stream_moderation
from modspark.streaming import quality as stream_quality

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


ERROR_LAYOUT = {
    "overall": ([], ["n", "f1_micro", "f1_macro", "auc_macro"]),
    "confusion": (["label"], ["n", "tp", "fp", "fn", "tn"]),
    "features": (["grp", "feature"], ["n", "mean", "median", "p90"]),
    "cases": (["sha256"], ["max_abs_error", "length_chars"]),
}
FAIRNESS_LAYOUT = {
    "labels": (["slice", "label"], ["n", "prevalence", "tpr", "fpr"]),
    "slices": (["slice"], ["n", "f1_micro", "f1_macro", "auc_macro"]),
    "label_gaps": (["slice", "label"], ["tpr_gap", "fpr_gap"]),
    "metric_gaps": (["slice"], ["f1_micro_gap", "auc_macro_gap"]),
}
"""Key and value columns of the parts of a report."""


def r6(c: Column | str) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), 6)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.texts(spark, sf_dir)


# --- sources, cleaning, labels ---------------------------------------------


@register
def load_splits(spark, sf_dir):
    """Train from one file; the missing split and the one without labels drop out."""
    found = datasets.load_splits(
        spark,
        {
            "train": f"{sf_dir}/labels.parquet",
            "validation": f"{sf_dir}/no_such_split.parquet",
            "test": f"{sf_dir}/documents.parquet",
        },
        S.LABELS,
    )
    parts = [d.select(F.lit(s).alias("split"), "doc_id", *S.LABELS) for s, d in found.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@register
def export_splits(spark, sf_dir):
    """Random split written by split and read back, every part from its folder."""
    rows = sampling.random_split(S.table(spark, sf_dir, "labels"), ["doc_id"], method="sha256")
    path = work_folder(spark, "splits")
    datasets.export_splits(rows, path, id_columns=["doc_id"])
    return spark.read.parquet(path).select("doc_id", "quality", "toxic", "split")


@register
def prepare_normalize(spark, sf_dir):
    clean = docs(spark, sf_dir).select("doc_id", X.normalize(F.col("text")).alias("t"))
    return clean.select(
        "doc_id", F.sha2("t", 256).alias("norm_sha256"), F.length("t").alias("norm_length")
    )


def _signed_labels(spark, sf_dir) -> DataFrame:
    """Labels as they come: text, a negative mark, or missing for unlabelled documents."""
    truth = S.table(spark, sf_dir, "labels").select(
        "doc_id",
        F.col("toxic").cast("string").alias("toxic"),
        (F.col("quality") - F.col("toxic")).alias("margin"),
    )
    return docs(spark, sf_dir).select("doc_id", "text").join(truth, "doc_id", "left")


@register
def prepare_label_vector(spark, sf_dir):
    """A field the table lacks and unparsable values count as 0."""
    rows = _signed_labels(spark, sf_dir)
    v = L.label_vector(rows, ["toxic", "margin", "text", "threat"])
    return rows.select("doc_id", v.alias("v")).select(
        "doc_id", *[F.get("v", F.lit(i)).alias(f"v{i}") for i in range(4)]
    )


@register
def prepare_labeled_only(spark, sf_dir):
    rows = prepare.prepare_labelled(_signed_labels(spark, sf_dir), "text", ["toxic", "margin"], "doc_id")
    return rows.select(
        F.col("id").alias("doc_id"),
        F.sha2("text", 256).alias("text_sha256"),
        F.get("labels", F.lit(0)).alias("y_toxic"),
        F.get("labels", F.lit(1)).alias("y_margin"),
        L.any_positive(F.col("labels")).alias("any_positive"),
        L.all_zero(F.col("labels")).alias("all_zero"),
    )


@register
def class_parse_multi_hot(spark, sf_dir):
    rows = prepare.prepare_three_class(S.class_rows(spark, sf_dir))
    return rows.select(
        "id",
        "class_id",
        "class_name",
        "split",
        "char_len",
        F.get("labels", F.lit(0)).alias("y_offensive"),
        F.get("labels", F.lit(1)).alias("y_hate"),
    )


@register
def split_alias(spark, sf_dir):
    name = L.split_name(F.col("type")).alias("split")
    return S.class_rows(spark, sf_dir).groupBy(name).agg(F.count("*").alias("n"))


@register
def split_filter(spark, sf_dir):
    rows = prepare.prepare_three_class(S.class_rows(spark, sf_dir))
    return rows.filter(F.col("split") == "validation").select("id", "class_name")


@register
def short_id(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", X.short_id(X.normalize(F.col("text"))).alias("short_id"))


@register
def cap_rows(spark, sf_dir):
    """The first 100 rows in hash order."""
    rows = S.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return sampling.cap_rows(rows, 100, ["doc_id"], method="sha256")


@register
def label_rekey(spark, sf_dir):
    """Scores under a model's own names, brought to the canonical labels."""

    def own_names(text: Column) -> Column:
        h = X.content_hash(text)
        names = ["toxic", "obscene", "threat", "insult", "identity_attack"]
        return F.create_map(*[c for n in names for c in (F.lit(n), S.uniform(h, n, "map"))])

    scorer = MapScorer("map", K.ENGLISH_LABELS, own_names, K.SCORER_LABEL_RENAMES)
    rows = scorer.score(docs(spark, sf_dir).select("doc_id", "text"), "text", "probs")
    return rows.select(
        "doc_id", *[r6(F.get("probs", F.lit(i))).alias(x) for i, x in enumerate(K.ENGLISH_LABELS)]
    )


@register
def sigmoid_scores(spark, sf_dir):
    logit = (F.col("n_chars") - 2000) / 1000.0
    return S.table(spark, sf_dir, "documents").select("doc_id", r6(sigmoid(logit)).alias("p"))


# --- sampling and splitting -------------------------------------------------


def _labelled(spark, sf_dir) -> DataFrame:
    rows = S.table(spark, sf_dir, "labels")
    return rows.select("doc_id", L.label_vector(rows, ["toxic"]).alias("labels"))


@register
def downsample_negatives(spark, sf_dir):
    rows = sampling.downsample_negatives(_labelled(spark, sf_dir), 0.37, ["doc_id"], method="sha256")
    return rows.select("doc_id", F.get("labels", F.lit(0)).alias("toxic"))


@register
def hash_split(spark, sf_dir):
    rows = S.table(spark, sf_dir, "documents").select("doc_id")
    return sampling.random_split(rows, ["doc_id"], method="sha256")


@register
def hash_split_no_test(spark, sf_dir):
    rows = S.table(spark, sf_dir, "documents").select("doc_id")
    return sampling.random_split(rows, ["doc_id"], SplitSettings(0.9, 0.1, 0.0), method="sha256")


@register
def supplied_splits(spark, sf_dir):
    """Validation and test are supplied, labelled and not empty, so they are used."""
    rows = _labelled(spark, sf_dir).join(docs(spark, sf_dir).select("doc_id", "lang"), "doc_id")
    lang = F.coalesce("lang", F.lit(""))
    parts = [rows.filter(~lang.isin("fr", "de")), rows.filter(lang == "fr"), rows.filter(lang == "de")]
    out = sampling.supplied_or_resplit(*parts, ["doc_id"], method="sha256")
    return out.select("doc_id", "split")


@register
def eval_split_fallback(spark, sf_dir):
    """The supplied test split is empty, so train is split anew, without test rows."""
    rows = _labelled(spark, sf_dir)
    nothing = rows.filter(F.size("labels") > 1)
    out = sampling.supplied_or_resplit(
        rows, rows, nothing, ["doc_id"], SplitSettings(0.9, 0.1, 0.0), method="sha256"
    )
    return sampling.evaluation_split(out).select("doc_id", "split")


@register
def class_split_fallback(spark, sf_dir):
    """Without test rows the whole table is split 80/10/10."""
    rows = prepare.prepare_three_class(S.class_rows(spark, sf_dir))
    given = rows.withColumn("split", F.when(F.col("split") == "test", "train").otherwise(F.col("split")))
    out = sampling.class_splits(given, ["id"], method="sha256")
    return out.groupBy("id", "split").agg(F.count("*").alias("n"))


@register
def seeded_shuffle(spark, sf_dir):
    rows = S.table(spark, sf_dir, "documents").select("doc_id")
    key = sampling.hash_key(["doc_id"], 42, "sha256")
    return sampling.shuffled(rows, ["doc_id"], method="sha256").select("doc_id", key.alias("order_key"))


@register
def export_shards(spark, sf_dir):
    """Documents exported in seeded order as sixteen files; the place of every row in the whole order."""
    path = work_folder(spark, "shards")
    manifest = shards.export_shards(S.table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"], path, 16, method="sha256")
    rows = spark.read.parquet(f"{path}/rows")
    return shards.positions(rows, manifest, ["doc_id"]).select("doc_id", F.col("position").cast("long").alias("position"))


@register
def load_prepared(spark, sf_dir):
    """Filter, normalise, down-sample and split in one job."""
    splits = {"train": _signed_labels(spark, sf_dir)}
    rows = datasets.load_prepared(
        splits, "text", ["toxic", "margin"], "doc_id", negative_ratio=0.5, method="sha256"
    )
    return rows.select(
        F.col("id").alias("doc_id"),
        F.sha2("text", 256).alias("text_sha256"),
        F.get("labels", F.lit(0)).alias("y_toxic"),
        F.get("labels", F.lit(1)).alias("y_margin"),
        "split",
    )


# --- text features ----------------------------------------------------------


@register
def text_features(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", *X.all_features(F.col("text")))
    return rounded(rows.drop("has_repeat"), "uppercase_ratio", "punct_ratio", "non_ascii_ratio")


@register
def feature_repeat(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", X.feature("has_repeat", F.col("text")).alias("has_repeat"))


@register
def redact_pii(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", X.redact_pii(F.col("text")).alias("t"))
    return rows.select("doc_id", F.sha2("t", 256).alias("sha256"), F.length("t").alias("length"))


@register
def redact_pages(spark, sf_dir):
    """Web pages hold the links that the documents lack."""
    text = F.concat("url", F.lit(" "), "html")
    rows = S.texts(spark, sf_dir, "pages", "page_id").select("page_id", X.redact_pii(text).alias("t"))
    return rows.select("page_id", F.sha2("t", 256).alias("sha256"), F.length("t").alias("length"))


@register
def content_hash(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", X.content_hash(F.col("text")).alias("sha256"))


@register
def slice_membership(spark, sf_dir):
    rows = fairness.slice_rows(docs(spark, sf_dir).select("doc_id", "text"), S.TERM_GROUPS)
    return rows.select("doc_id", "slice")


@register
def slice_membership_terms(spark, sf_dir):
    """The same slices by one automaton over all terms."""
    rows = identity.term_slice_rows(docs(spark, sf_dir).select("doc_id", "text"), S.TERM_GROUPS)
    return rows.select("doc_id", "slice")


@register
def language_rules(spark, sf_dir):
    rows = S.messages(spark, sf_dir)
    return rows.select(
        "doc_id",
        "lang",
        is_english(F.col("lang")).alias("is_english"),
        is_vietnamese(F.col("lang")).alias("is_vietnamese"),
    )


@register
def language_id(spark, sf_dir):
    """Trigram model trained on the labelled language, applied to every document."""
    rows = docs(spark, sf_dir).select("doc_id", "text", "lang")
    return langid.identify(rows, langid.train(rows), "doc_id").withColumnRenamed("lang", "detected")


@register
def language_id_in_place(spark, sf_dir):
    """The same model as a column ahead of routing, with the guard for short texts."""
    rows = docs(spark, sf_dir).select("doc_id", "text", "lang")
    return langid.with_language(rows, langid.train(rows), lang="detected").select("doc_id", "detected")


# --- moderation -------------------------------------------------------------


@register
def batch_scorer(spark, sf_dir):
    """The Pandas UDF contract with a scorer that hashes; only English texts reach it."""

    def load():
        def predict(texts: list[str]) -> np.ndarray:
            return np.array([[_hash_score(t, x) for x in S.LABELS] for t in texts], dtype=np.float32)

        return predict

    scorer = BatchScorer("hash", S.LABELS, load, batch_size=64)
    rows = docs(spark, sf_dir).select("doc_id", "lang", "text")
    rows = scorer.score(rows, "text", "probs", where=F.col("lang") == "en")
    return rows.select(
        "doc_id",
        *[r6(F.get("probs", F.lit(i))).alias(f"p_{x}") for i, x in enumerate(S.LABELS)],
    )


def _hash_score(text: str, label: str) -> float:
    inner = hashlib.sha256(text.encode("utf-8")).hexdigest()
    digest = hashlib.sha256(f"{inner}|batch|{label}".encode()).hexdigest()
    return int(digest[:6], 16) / 16777216.0


@register
def moderate_batch(spark, sf_dir):
    """The whole decision per document."""
    rows = S.decisions(spark, sf_dir)
    return rows.select(
        "doc_id",
        "action",
        r6("overall_score").alias("overall_score"),
        F.size("label_scores").alias("n_labels"),
        "model_used",
        "language",
        "policy_message",
        "request_human_review",
    )


@register
def moderate_routes(spark, sf_dir):
    rows = moderation.route_texts(S.messages(spark, sf_dir), S.scorers(), S.AGENT)
    return rows.groupBy("language", "route", "model_used", "is_borderline").agg(
        F.count("*").alias("n"), r6(F.avg("overall_fast")).alias("mean_fast")
    )


@register
def label_scores(spark, sf_dir):
    rows = S.decisions(spark, sf_dir).select("doc_id", F.explode("label_scores").alias("label", "score"))
    return rounded(rows, "score")


@register
def explanations(spark, sf_dir):
    return S.decisions(spark, sf_dir).select("doc_id", "explanation")


@register
def review_queue(spark, sf_dir):
    """Queue written and read back."""
    path = work_folder(spark, "queue")
    rows = S.decisions(spark, sf_dir)
    logs.append_json(logs.review_records(rows, F.lit("2024-01-01").cast("timestamp")), path)
    back = logs.read_review_queue(spark, path)
    return back.select(
        "ts_utc",
        "text_sha256",
        "language",
        r6("overall_score").alias("overall_score"),
        "model_used",
        F.size("label_scores").alias("n_labels"),
    )


@register
def prediction_log(spark, sf_dir):
    """Log written and read back, without any text."""
    path = work_folder(spark, "log")
    stamp = F.lit("2024-01-02 03:04:05.678").cast("timestamp")
    logs.append_json(logs.prediction_records(S.decisions(spark, sf_dir), stamp), path)
    log, _ = logs.read_prediction_log(spark, path)
    return log.select(
        "ts_utc",
        "text_sha256",
        "action",
        r6("overall_score").alias("overall_score"),
        "language",
        "request_human_review",
        F.col("text").isNotNull().alias("has_text"),
    )


@register
def prediction_log_redacted(spark, sf_dir):
    """The same log with the redacted text switched on."""
    path = work_folder(spark, "log")
    stamp = F.lit("2024-01-02 03:04:05.678").cast("timestamp")
    rows = moderation.moderate(S.messages(spark, sf_dir), S.scorers(), S.AGENT, with_redaction=True)
    records = logs.prediction_records(rows, stamp, LogSettings(store_redacted_text=True))
    logs.append_json(records, path)
    log, _ = logs.read_prediction_log(spark, path)
    return log.select("text_sha256", F.sha2("text_redacted", 256).alias("redacted_sha256"))


@register
def committed_log(spark, sf_dir):
    """Two runs over one table, one of them repeated under its name, and one that never committed."""
    path = work_folder(spark, "log")
    stamp = F.lit("2024-01-02 03:04:05.678").cast("timestamp")
    rows = logs.prediction_records(S.decisions(spark, sf_dir), stamp)
    for run in ("monday", "tuesday", "tuesday"):
        logs.append_json(rows, path, run)
    rows.write.partitionBy("dt").json(f"{path}/attempt=a-killed")
    log, _ = logs.read_prediction_log(spark, path)
    return log.groupBy("action").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@register
def request_texts(spark, sf_dir):
    """Conversation turns as requests: a single text, a batch that wins over it, or neither."""
    turns = S.table(spark, sf_dir, "conversations")
    batch = F.array("text", F.concat("role", F.lit(": "), "text"))
    asked = turns.select(
        "conv_id",
        "turn",
        F.when(F.col("role") != "system", F.col("text")).alias("text"),
        F.when(F.col("role") == "assistant", batch).alias("texts"),
    )
    rows = requests.request_texts(asked)
    return rows.select("conv_id", "turn", "pos", X.content_hash(F.col("text")).alias("sha256"))


# --- metrics ----------------------------------------------------------------


def _long(spark, sf_dir) -> DataFrame:
    return metrics.to_long(S.scored(spark, sf_dir), S.LABELS)


@register
def binarize(spark, sf_dir):
    rows = metrics.to_long(S.scored(spark, sf_dir), S.LABELS, ["id"])
    hit = at_least(F.col("p"), 0.5).cast("int")
    return rows.select(F.col("id").alias("doc_id"), "label", hit.alias("pred"))


@register
def confusion(spark, sf_dir):
    return metrics.confusion(_long(spark, sf_dir))


@register
def f1(spark, sf_dir):
    return rounded(metrics.f1_scores(metrics.confusion(_long(spark, sf_dir))), "f1_micro", "f1_macro")


@register
def auc(spark, sf_dir):
    rows = metrics.evaluate_labels(_long(spark, sf_dir))
    return rounded(rows.select("label", "n", "positives", "auc"), "auc")


@register
def evaluate(spark, sf_dir):
    rows = metrics.summarize(metrics.evaluate_labels(_long(spark, sf_dir)))
    return rounded(rows, "f1_micro", "f1_macro", "auc_macro")


@register
def compare_models(spark, sf_dir):
    found = [
        metrics.to_long(S.scored(spark, sf_dir, salt=m), S.LABELS).withColumn("model", F.lit(m))
        for m in ("baseline", "finetuned")
    ]
    listed = spark.createDataFrame([("baseline",), ("off_the_shelf",), ("finetuned",)], "model string")
    rows = metrics.compare_models(found[0].unionByName(found[1]), listed)
    return rounded(rows, "f1_micro", "f1_macro", "auc_macro")


@register
def prevalence(spark, sf_dir):
    rows = S.table(spark, sf_dir, "labels")
    rows = rows.select(L.label_vector(rows, S.LABELS).alias("labels"))
    return rounded(metrics.label_prevalence(rows, S.LABELS), "positive_rate")


@register
def split_summary(spark, sf_dir):
    rows = prepare.prepare_three_class(S.class_rows(spark, sf_dir))
    return rounded(metrics.split_summary(rows), "avg_char_len")


@register
def threshold_per_label(spark, sf_dir):
    return rounded(thresholds.best_per_label(thresholds.grid_counts(_long(spark, sf_dir))), "f1")


@register
def threshold_global(spark, sf_dir):
    rows = thresholds.best_global(thresholds.grid_counts(_long(spark, sf_dir)))
    return rounded(rows, "f1_micro", "f1_macro")


@register
def threshold_apply(spark, sf_dir):
    """Confusion counts at the threshold found for each label."""
    long = _long(spark, sf_dir)
    best = thresholds.best_per_label(thresholds.grid_counts(long))
    applied = thresholds.apply_thresholds(long, best)
    return metrics.confusion(applied, threshold=F.col("threshold"))


@register
def threshold_apply_global(spark, sf_dir):
    long = _long(spark, sf_dir)
    best = thresholds.best_global(thresholds.grid_counts(long))
    applied = thresholds.apply_thresholds(long, best, on=())
    return applied.groupBy("label", "threshold").agg(F.sum("pred").alias("predicted"))


# --- error analysis ---------------------------------------------------------


@register
def error_groups(spark, sf_dir):
    groups = F.explode(errors.error_groups(S.LABELS, 0.5)).alias("grp")
    return S.scored(spark, sf_dir).select(F.col("id").alias("doc_id"), groups)


@register
def error_feature_summary(spark, sf_dir):
    rows = errors.feature_summary(S.scored(spark, sf_dir, with_text=True), S.LABELS, 0.5)
    return rounded(rows, "mean", "median", "p90")


@register
def worst_cases(spark, sf_dir):
    rows = errors.worst_cases(S.scored(spark, sf_dir, with_text=True), S.LABELS, 0.5)
    maps = {"true": "true_labels", "pred": "pred_labels", "prob": "pred_probs"}
    return rows.select(
        "sha256",
        *[r6(c).alias(c) if c == "uppercase_ratio" else F.col(c) for c in errors.CASE_FEATURES],
        r6("max_abs_error").alias("max_abs_error"),
        *[
            r6(F.try_element_at(m, F.lit(x))).alias(f"{k}_{x}")
            for k, m in maps.items()
            for x in S.LABELS
        ],
    )


# --- fairness ---------------------------------------------------------------


def _slice_labels(spark, sf_dir) -> DataFrame:
    return fairness.slice_labels(S.scored(spark, sf_dir, with_text=True), S.TERM_GROUPS, S.LABELS)


@register
def slice_metrics(spark, sf_dir):
    rows = fairness.slice_metrics(_slice_labels(spark, sf_dir))
    return rounded(rows, "f1_micro", "f1_macro", "auc_macro")


@register
def slice_rates(spark, sf_dir):
    rows = _slice_labels(spark, sf_dir).select("slice", "label", "n", "prevalence", "tpr", "fpr")
    return rounded(rows, "prevalence", "tpr", "fpr")


@register
def slice_gaps(spark, sf_dir):
    return rounded(fairness.label_gaps(_slice_labels(spark, sf_dir)), "tpr_gap", "fpr_gap")


@register
def slice_metric_gaps(spark, sf_dir):
    rows = fairness.metric_gaps(fairness.slice_metrics(_slice_labels(spark, sf_dir)))
    return rounded(rows, "f1_micro_gap", "auc_macro_gap")


def tidy(section: str, rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """``section, name, measure, value``: a result table as one value per row."""
    name = F.concat_ws("/", *keys).alias("name") if keys else F.lit("").alias("name")
    cells = F.explode(F.array(*[F.struct(F.lit(v).alias("m"), r6(v).alias("v")) for v in values])).alias("c")
    return rows.select(F.lit(section).alias("section"), name, cells).select(
        "section", "name", F.col("c.m").alias("measure"), F.col("c.v").alias("value")
    )


def tidy_report(report: reports_plan.Report, layout: dict[str, tuple[list[str], list[str]]]) -> DataFrame:
    parts = [tidy(part, report[part], *layout[part]) for part in layout]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@register
def whole_error_report(spark, sf_dir):
    """Every part of the error report as one table."""
    report = reports_plan.error_report(S.scored(spark, sf_dir, with_text=True), S.LABELS)
    return tidy_report(report, ERROR_LAYOUT)


@register
def whole_fairness_report(spark, sf_dir):
    """Every part of the fairness report as one table; the groups come from a settings file."""
    report = reports_plan.fairness_report(S.scored(spark, sf_dir, with_text=True), S.stored_groups(), S.LABELS)
    return tidy_report(report, FAIRNESS_LAYOUT)


@register
def identity_groups(spark, sf_dir):
    """Documents that mention each group of a settings file, groups without terms included."""
    groups = S.stored_groups()
    members = fairness.slice_rows(docs(spark, sf_dir).select("doc_id", "text"), groups).groupBy("slice").agg(F.count("*").alias("n"))
    listed = settings_files.groups_frame(spark, groups)
    return listed.join(members, F.col("grp") == F.col("slice"), "left").select(
        "grp", F.size("terms").cast("long").alias("n_terms"), F.coalesce("n", F.lit(0)).alias("n")
    )


@register
def policy_messages(spark, sf_dir):
    """Decisions by the message that a stored policy gives them."""
    policy = S.stored_policy()
    decided = moderate(S.messages(spark, sf_dir), S.scorers(), S.AGENT, policy)
    return decided.groupBy("action", "policy_message").agg(F.count("*").alias("n"))


# --- monitoring -------------------------------------------------------------


@register
def action_counts(spark, sf_dir):
    return monitoring.action_counts(S.decision_log(spark, sf_dir))


@register
def language_counts(spark, sf_dir):
    return monitoring.language_counts(S.decision_log(spark, sf_dir))


@register
def score_means(spark, sf_dir):
    """Mean of the overall score and of each label, in one table."""
    log = S.decision_log(spark, sf_dir)
    overall = monitoring.mean_overall_score(log).withColumn("label", F.lit("(overall)"))
    return rounded(monitoring.mean_label_scores(log).unionByName(overall), "mean_score")


@register
def daily_report(spark, sf_dir):
    return rounded(monitoring.report(S.decision_log(spark, sf_dir), ["day"]), "mean")


@register
def whole_report(spark, sf_dir):
    """The report over the whole log, saved as JSON lines and read back."""
    path = work_folder(spark, "report")
    reports.save_report(monitoring.report(S.decision_log(spark, sf_dir)), path)
    back = spark.read.schema("section string, name string, n long, mean double").json(path)
    return rounded(back, "mean")


@register
def latency_summary(spark, sf_dir):
    rows = monitoring.latency_summary(S.table(spark, sf_dir, "events"), "value")
    return rounded(rows, "p50_ms", "p95_ms", "p99_ms", "mean_ms")


@register
def latency_by_kind(spark, sf_dir):
    rows = monitoring.latency_summary(S.table(spark, sf_dir, "events"), "value", ["event_type"])
    return rounded(rows, "p50_ms", "p95_ms", "p99_ms", "mean_ms")


@register
def latency_sketched(spark, sf_dir):
    """Percentiles from stored daily sketches, and whether their ranks are within the stated error."""
    events = S.table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"), "value")
    path = work_folder(spark, "sketches")
    monitoring.latency_sketches(events, "value", ["event_type", "day"]).write.parquet(path)
    found = monitoring.sketched_latency(spark.read.parquet(path), ["event_type"])
    points = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
    ranks = events.filter("value IS NOT NULL").join(found, "event_type").groupBy("event_type").agg(
        *[(F.count_if(F.col("value") <= F.col(c)) / F.count("*")).alias(f"r_{c}") for c in points]
    )
    error = monitoring.sketch_rank_error()
    near = [(F.abs(F.col(f"r_{c}") - q) <= error).alias(f"{c}_near") for c, q in points.items()]
    return found.join(ranks, "event_type").select("event_type", "n", r6("mean_ms").alias("mean_ms"), *near)


@register
def drift_distances(spark, sf_dir):
    """Distances of each day's text lengths and scores from the first week's, without bins."""
    log = S.decision_log(spark, sf_dir).select("day", "n_chars", "overall_score")
    first_week = F.col("day") < "2024-01-08"
    parts = [
        monitoring.sample_distances(log, "day", column, first_week).withColumn("signal", F.lit(column))
        for column in ("n_chars", "overall_score")
    ]
    return rounded(parts[0].unionByName(parts[1]), "ks", "wasserstein")


@register
def drift(spark, sf_dir):
    """Each day against the first week."""
    counts = monitoring.signal_counts(S.decision_log(spark, sf_dir), "day", monitoring.log_signals())
    return rounded(monitoring.drift(counts, "day", F.col("day") < "2024-01-08"), "psi")


@register
def drift_lengths(spark, sf_dir):
    """The binned counts behind the drift figures."""
    return monitoring.signal_counts(S.decision_log(spark, sf_dir), "day", monitoring.log_signals())


def _truth_by_hash(spark, sf_dir) -> DataFrame:
    rows = docs(spark, sf_dir).select("doc_id", X.content_hash(F.col("text")).alias("text_sha256"))
    rows = rows.join(S.table(spark, sf_dir, "labels"), "doc_id")
    one = rows.groupBy("text_sha256").agg(F.min_by("toxic", "doc_id").alias("toxic"))
    return one.select("text_sha256", F.array(F.col("toxic").cast("double")).alias("labels"))


@register
def rolling_f1(spark, sf_dir):
    log = S.decision_log(spark, sf_dir)
    rows = monitoring.rolling_f1(log, _truth_by_hash(spark, sf_dir), "day", ["toxic"], 0.5)
    return rounded(rows, "f1")


@register
def retrain_set(spark, sf_dir):
    """Queue items with labels, added to the labelled documents of good quality."""
    queue = logs.review_records(S.decisions(spark, sf_dir), F.lit("2024-01-01").cast("timestamp"))
    rows = docs(spark, sf_dir).select("doc_id", "text", X.content_hash(F.col("text")).alias("text_sha256"))
    rows = rows.join(S.table(spark, sf_dir, "labels"), "doc_id")
    labels = F.array(*[F.col(x).cast("double") for x in S.LABELS]).alias("labels")
    reviewed = rows.select("text_sha256", "text", labels)
    train = rows.filter(F.col("quality") == 1).select("text_sha256", "text", labels)
    merged = monitoring.retraining_set(queue, reviewed, train)
    return merged.select("text_sha256", "origin", *[F.get("labels", F.lit(i)).alias(x) for i, x in enumerate(S.LABELS)])


# --- models -----------------------------------------------------------------


@register
def pos_weight(spark, sf_dir):
    rows = S.table(spark, sf_dir, "labels")
    rows = rows.select(L.label_vector(rows, S.LABELS).alias("labels"))
    return rounded(metrics.positive_weights(rows, S.LABELS), "pos_weight")


def _train_and_test(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = S.scored(spark, sf_dir, with_text=True).select("id", "text", "labels")
    rows = sampling.random_split(rows, ["id"], SplitSettings(0.8, 0.1, 0.1), method="sha256")
    return rows.filter("split = 'train'"), rows.filter("split <> 'train'")


@register
def tfidf_lr_scores(spark, sf_dir):
    """Classifiers fitted on train, saved, loaded, and applied to the other rows."""
    train, test = _train_and_test(spark, sf_dir)
    path = work_folder(spark, "model")
    tfidf.train_tfidf_lr(train, S.LABELS, tfidf.TfidfSettings()).save(path)
    scored = tfidf.TfidfModel.load(path).score(test, "text", "probs")
    return scored.select(
        F.col("id").alias("doc_id"),
        *[r6(F.get("probs", F.lit(i))).alias(f"p_{x}") for i, x in enumerate(S.LABELS)],
    )


@register
def tfidf_features(spark, sf_dir):
    """TF-IDF weights of every document over the commonest terms of all of them."""
    rows = docs(spark, sf_dir).select("doc_id", "text")
    stages = tfidf.fit_features(rows, "text", tfidf.TfidfSettings())
    return rounded(tfidf.weighted_terms(rows, stages, ["doc_id"], "text"), "weight")


@register
def tfidf_stationary(spark, sf_dir):
    """Whether training has minimised each label's objective on the training rows."""
    train, _ = _train_and_test(spark, sf_dir)
    settings = tfidf.TfidfSettings()
    sizes = tfidf.gradient_size(tfidf.train_tfidf_lr(train, S.LABELS, settings), train, settings)
    return sizes.select("label", (F.col("size") < 1e-4).alias("minimised"))


@register
def tfidf_save_load(spark, sf_dir):
    """How many scores of the other rows change when the model is saved and loaded."""
    train, test = _train_and_test(spark, sf_dir)
    path = work_folder(spark, "model")
    model = tfidf.train_tfidf_lr(train, S.LABELS, tfidf.TfidfSettings())
    model.save(path)
    both = tfidf.TfidfModel.load(path).score(model.score(test, "text", "a"), "text", "b")
    return both.agg(F.count_if(F.col("a") != F.col("b")).alias("differing"), F.count("*").alias("n"))


@register
def tune_agrees(spark, sf_dir):
    """The trial that tuning calls best against the arg-max of its own results."""
    trials = tune_grid(spark, sf_dir)
    top = F.max_by("trial", F.struct("f1_micro", -F.col("trial")))
    return trials.agg(
        (F.max(F.when(F.col("best"), F.col("trial"))) == top).alias("agrees"), F.count_if("best").alias("bests")
    )


@register
def tfidf_evaluation(spark, sf_dir):
    """The fitted classifiers and the stand-in scores, compared on the same rows."""
    train, test = _train_and_test(spark, sf_dir)
    model = tfidf.train_tfidf_lr(train, S.LABELS, tfidf.TfidfSettings(use_pos_weight=True))
    ours = metrics.to_long(model.score(test, "text", "probs"), S.LABELS).withColumn("model", F.lit("tfidf_lr"))
    other = S.scored(spark, sf_dir).join(test.select("id"), "id", "left_semi")
    other = metrics.to_long(other, S.LABELS).withColumn("model", F.lit("stand_in"))
    listed = spark.createDataFrame([("tfidf_lr",), ("stand_in",), ("finetuned",)], "model string")
    return rounded(
        metrics.compare_models(ours.unionByName(other), listed), "f1_micro", "f1_macro", "auc_macro"
    )


@register
def tune_grid(spark, sf_dir):
    train, test = _train_and_test(spark, sf_dir)
    grid = {"c": [1.0, 4.0, 16.0], "use_pos_weight": [False, True]}
    return rounded(tfidf.tune(train, test, S.LABELS, grid), "f1_micro", "f1_macro", "auc_macro")


# --- governance -------------------------------------------------------------


@register
def latest_artifacts(spark, sf_dir):
    runs = S.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("kind"),
        F.concat(F.col("event_type"), F.lit("-"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("run_name"),
        F.col("props").alias("payload"),
    )
    return governance.latest_artifacts(runs, ["view", "click", "purchase", "benchmark"])


@register
def leak_scan(spark, sf_dir):
    """Reports that nest text in structs, arrays and maps."""
    case = F.struct(X.content_hash(F.col("text")).alias("sha256"), F.col("text").alias("content"))
    rows = docs(spark, sf_dir).select(
        "doc_id",
        F.struct("lang", F.col("source").alias("message")).alias("meta"),
        F.array(case).alias("cases"),
        F.create_map(F.lit("raw_text"), F.when(F.col("lang") == "en", F.col("text")).otherwise("  ")).alias("extra"),
        F.lit(" ").alias("text"),
    )
    return governance.leak_scan(rows)


@register
def overfit_flags(spark, sf_dir):
    rows = governance.overfit_flags(S.training_log(spark, sf_dir))
    values = [c for c, t in rows.dtypes if t == "double"]
    return rounded(rows, *values)


# --- streams ----------------------------------------------------------------


def _turn_language() -> Column:
    return F.when(F.col("role") == "user", "en").when(F.col("role") == "assistant", "vi").otherwise("unknown")


def _conversation_messages(rows: DataFrame) -> DataFrame:
    return rows.select("text", _turn_language().alias("lang"))


@register
def stream_moderate(spark, sf_dir):
    """Conversation turns moderated as a stream; log and queue read back."""
    schema = "conv_id long, turn long, role string, text string"
    texts = stream_moderation.read_table_stream(spark, sf_dir, "conversations.parquet", schema)
    root = work_folder(spark, "stream")
    targets = stream_moderation.StreamTargets(f"{root}/log", f"{root}/queue", f"{root}/checkpoint")
    stream_moderation.moderate_stream(
        _conversation_messages(texts), S.scorers(), targets, S.AGENT
    ).awaitTermination()
    log, _ = logs.read_prediction_log(spark, targets.log)
    queue = logs.read_review_queue(spark, targets.queue).withColumn("target", F.lit("queue"))
    both = log.withColumn("target", F.lit("log")).select(
        "target", "text_sha256", "model_used", "language", r6("overall_score").alias("overall_score")
    )
    return both.unionByName(queue.select("target", "text_sha256", "model_used", "language", r6("overall_score").alias("overall_score")))


@register
def stream_moderate_once(spark, sf_dir):
    """Conversation turns sent twice, the second time in a later micro-batch; the log has each once."""
    root = work_folder(spark, "requests")
    turns = S.table(spark, sf_dir, "conversations").select(
        F.concat_ws("|", "conv_id", "turn", F.sha2("text", 256)).alias("request_id"), "role", "text", F.timestamp_seconds(1_704_067_200 + F.col("conv_id") % 3000).alias("ts")
    )
    for _ in range(2):
        turns.coalesce(1).write.mode("append").parquet(f"{root}/in")
    texts = spark.readStream.schema(turns.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    texts = texts.withColumn("lang", _turn_language())
    targets = stream_moderation.StreamTargets(f"{root}/log", f"{root}/queue", f"{root}/checkpoint")
    stream_moderation.moderate_stream(
        texts, S.scorers(), targets, S.AGENT, once=stream_moderation.OncePerRequest(horizon="1 hour")
    ).awaitTermination()
    log, _ = logs.read_prediction_log(spark, targets.log)
    return log.groupBy("text_sha256", "language").agg(F.count("*").alias("n"))


@register
def stream_rolling_f1(spark, sf_dir):
    """Decisions and later labels as two streams: the rolling F1 once all labels are in."""
    root = work_folder(spark, "judged")
    log = S.decision_log(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"), "text_sha256", "label_scores")
    log.write.parquet(f"{root}/log")
    log = spark.read.parquet(f"{root}/log")
    first = log.groupBy("text_sha256").agg(F.min("ts").alias("first"))
    delay = F.make_dt_interval(days=F.pmod(F.xxhash64("text_sha256"), F.lit(5)).cast("int"))
    truth = _truth_by_hash(spark, sf_dir).join(first, "text_sha256")
    truth = truth.select("text_sha256", "labels", (F.col("first") + delay).alias("labelled_at"))
    truth.write.parquet(f"{root}/truth")
    sides = [spark.readStream.schema(d.schema).parquet(f"{root}/{n}") for d, n in ((log, "log"), (truth, "truth"))]
    wide = stream_quality.LabelDelay(before="400 days", after="400 days")
    rows = stream_quality.judged(*sides, ["toxic"], wide)
    stream_quality.append_counts(rows, ["toxic"], f"{root}/counts", f"{root}/checkpoint").awaitTermination()
    return rounded(stream_quality.current_f1(spark, f"{root}/counts"), "f1")


def _log_stream(spark, sf_dir) -> DataFrame:
    """The decision log, written by day and read as a stream of files."""
    path = work_folder(spark, "log")
    columns = ["ts", "action", "language", "overall_score"]
    S.decision_log(spark, sf_dir).select(*columns).write.parquet(path)
    schema = "ts timestamp, action string, language string, overall_score double"
    return spark.readStream.schema(schema).parquet(path)


@register
def stream_daily(spark, sf_dir):
    """Closed days only: those whose end the watermark has passed."""
    root = work_folder(spark, "daily")
    counts = daily.daily_counts(_log_stream(spark, sf_dir))
    daily.append_closed_days(counts, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return rounded(spark.read.schema(counts.schema).parquet(f"{root}/table"), "mean_score")


@register
def stream_daily_live(spark, sf_dir):
    """All days, the open one included: the newest update of every row."""
    root = work_folder(spark, "daily")
    counts = daily.daily_counts(_log_stream(spark, sf_dir))
    daily.update_open_days(counts, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return rounded(daily.latest_days(spark.read.parquet(f"{root}/table")), "mean_score")
