"""Command line: ``spark-submit`` or ``python -m modspark COMMAND ...``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from modspark import constants as K
from modspark.config import AgentSettings, LogSettings, PolicyRules
from modspark.operators.tfidf import TfidfSettings
from modspark.plans import jobs, reports
from modspark.sources.settings_files import load_agent, load_groups, load_policy


def _pairs(text: str) -> dict[str, str]:
    return dict(item.split("=", 1) for item in text.split(","))


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="modspark")
    commands = parser.add_subparsers(dest="command", required=True)

    def add(name: str, text: str, *required: str) -> argparse.ArgumentParser:
        command = commands.add_parser(name, help=text)
        for option in (*required, "out"):
            command.add_argument(f"--{option}", required=True)
        command.add_argument("--labels", default=",".join(jobs.default_labels()))
        return command

    c = add("prepare", "labelled splits to a prepared table", "splits")
    c.add_argument("--text-field", default="comment_text")
    c.add_argument("--id-field", default="id")
    c.add_argument("--format", default="parquet")
    c.add_argument("--negative-ratio", type=float, default=1.0)
    c.add_argument("--split-csv", action="store_true", help="CSV files have no line ends inside quotes: read a file in parts")
    c = add("train", "fit the TF-IDF classifiers", "data")
    c.add_argument("--max-features", type=int, default=80_000)
    c.add_argument("--c", type=float, default=4.0)
    c.add_argument("--max-iter", type=int, default=200)
    c.add_argument("--use-pos-weight", action="store_true")
    c = add("tune", "try a grid of settings", "data")
    c.add_argument("--grid", required=True, help="JSON object of value lists")
    c.add_argument("--max-trials", type=int, default=6)
    c.add_argument("--store", help="folder of finished trials; a run that was ended goes on from there")
    c = add("eval", "compare models", "data", "models")
    c.add_argument("--threshold", type=float, default=0.5)
    for name, text, split in (
        ("threshold-search", "best thresholds on a split", "validation"),
        ("error-analysis", "error report without text", "test"),
        ("fairness", "metrics per identity slice", "test"),
    ):
        c = add(name, text, "data", "model")
        c.add_argument("--split", default=split)
        c.add_argument("--threshold", type=float, default=0.5)
        c.add_argument("--max-samples", type=int)
        c.add_argument("--groups", help="YAML or JSON file of identity terms")
    c = add("moderate", "decide over a table of texts or requests", "data", "model")
    c.add_argument("--language-table")
    c.add_argument("--policy", help="YAML or JSON file of policy rules")
    c.add_argument("--agent", help="YAML or JSON file of cut-offs and routing switches")
    for route in ("multilingual", "finetuned", "vi"):
        c.add_argument(f"--{route}", help="a further scorer: model folder, column:NAME or MODULE:FUNCTION")
    c.add_argument("--run", help="name of this run; started again, it replaces what it added")
    c.add_argument("--store-raw-text", action="store_true")
    c.add_argument("--store-redacted-text", action="store_true")
    c = add("report", "monitoring report of a prediction log", "log")
    c.add_argument("--daily", action="store_true")
    c = add("prepare-classes", "three-class rows to a prepared table", "data")
    c.add_argument("--format", default="parquet")
    c = add("apply-thresholds", "counts at the thresholds of a search", "data", "model", "thresholds")
    c.add_argument("--split", default="test")
    add("drift", "daily drift of a prediction log", "log", "reference-until")
    add("retrain-set", "the next training set", "queue", "reviewed", "train")
    add("leak-scan", "raw text in JSON reports", "data")
    add("benchmark", "percentiles of measured latencies", "data", "column")
    return parser


def main(argv: list[str] | None = None) -> None:
    o = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"modspark {o.command}").getOrCreate()
    labels = o.labels.split(",")
    if o.command == "prepare":
        jobs.prepare(
            spark, _pairs(o.splits), o.out, o.text_field, labels, o.id_field, o.format, o.negative_ratio, split_csv=o.split_csv
        )
    elif o.command == "train":
        settings = TfidfSettings(o.max_features, c=o.c, max_iter=o.max_iter, use_pos_weight=o.use_pos_weight)
        jobs.train(spark, o.data, o.out, labels, settings)
    elif o.command == "tune":
        jobs.tune(spark, o.data, o.out, labels, json.loads(o.grid), o.max_trials, o.store)
    elif o.command == "eval":
        jobs.evaluate(spark, o.data, _pairs(o.models), o.out, labels, o.threshold)
    elif o.command in ("threshold-search", "error-analysis", "fairness"):
        groups = load_groups(o.groups) if o.groups else K.IDENTITY_TERMS
        build = {
            "threshold-search": {"thresholds": lambda d: reports.threshold_report(d, labels)},
            "error-analysis": {"errors": lambda d: reports.error_report(d, labels, o.threshold)},
            "fairness": {"fairness": lambda d: reports.fairness_report(d, groups, labels, o.threshold)},
        }[o.command]
        jobs.analyse(spark, o.data, o.model, o.out, labels, build, o.split, o.max_samples)
    elif o.command == "moderate":
        jobs.moderate_table(
            spark,
            o.data,
            o.model,
            o.out,
            o.language_table,
            load_agent(o.agent) if o.agent else AgentSettings(),
            policy=load_policy(o.policy) if o.policy else PolicyRules(),
            run=o.run,
            others={r: getattr(o, r) for r in ("multilingual", "finetuned", "vi") if getattr(o, r)},
            logging=LogSettings(o.store_raw_text, o.store_redacted_text),
        )
    elif o.command == "report":
        jobs.report(spark, o.log, o.out, o.daily)
    elif o.command == "prepare-classes":
        jobs.prepare_classes(spark, o.data, o.out, o.format)
    elif o.command == "apply-thresholds":
        jobs.apply_stored_thresholds(spark, o.data, o.model, o.thresholds, o.out, labels, o.split)
    elif o.command == "drift":
        jobs.drift(spark, o.log, o.out, o.reference_until)
    elif o.command == "retrain-set":
        jobs.retrain(spark, o.queue, o.reviewed, o.train, o.out)
    elif o.command == "leak-scan":
        jobs.scan_for_leaks(spark, o.data, o.out)
    elif o.command == "benchmark":
        jobs.latency(spark, o.data, o.column, o.out)


if __name__ == "__main__":
    main()
