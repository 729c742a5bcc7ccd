"""Routing, actions and explanations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from modspark.config import AgentSettings, PolicyRules
from modspark.constants import ENGLISH_LABELS, VIETNAMESE_LABELS
from modspark.operators.moderation import ScorerSet, explanation, moderate
from modspark.operators.scoring import BatchScorer, constant_scorer

POLICY = PolicyRules(
    {"ALLOW": "ok", "WARN": "warn", "REVIEW": "review", "BLOCK": "block"},
    {"toxic": "tox", "offensive": "offensive", "hate": "hate"},
    top_k=2,
)
FORCED = AgentSettings(forced_languages=("vi",))


def scorers(fast, multi=None, finetuned=None, vi=None):
    def make(values, labels=ENGLISH_LABELS, name="dummy"):
        return None if values is None else constant_scorer(name, labels, values)

    return ScorerSet(make(fast), make(multi), make(finetuned), make(vi, VIETNAMESE_LABELS))


def decide(spark, lang, found, settings=AgentSettings(), text="some text"):
    df = spark.createDataFrame([(text, lang)], "text string, lang string")
    return moderate(df, found, settings, POLICY).first()


CASES = [
    # lang, scorers, settings, action, overall, model, review
    ("en", dict(fast=[0.1], multi=[0.1]), AgentSettings(), "ALLOW", 0.1, "detoxify:dummy", False),
    ("en", dict(fast=[0.5, 0.1], multi=[0.2], finetuned=[0.9, 0.2]), AgentSettings(), "REVIEW", 0.9, "finetuned:dummy", True),
    ("en", dict(fast=[0.05]), AgentSettings(), "ALLOW", 0.05, "detoxify:dummy", False),
    ("vi", dict(fast=[0.5], multi=[0.1]), AgentSettings(), "ALLOW", 0.1, "detoxify:dummy", False),
    ("vi", dict(fast=[0.05], vi=[0.85, 0.10]), FORCED, "BLOCK", 0.85, "vi_finetuned:dummy", False),
    ("en", dict(fast=[0.05], vi=[0.99, 0.99]), FORCED, "ALLOW", 0.05, "detoxify:dummy", False),
    ("vi", dict(fast=[0.01], vi=[0.4, 0.05]), FORCED, "WARN", 0.4, "vi_finetuned:dummy", False),
    ("vi", dict(fast=[0.01], vi=[0.1, 0.8]), FORCED, "BLOCK", 0.8, "vi_finetuned:dummy", False),
    ("vi", dict(fast=[0.01], multi=[0.7]), FORCED, "BLOCK", 0.7, "detoxify:dummy", False),
    ("unknown", dict(fast=[0.01], multi=[0.02]), AgentSettings(), "REVIEW", 0.02, "detoxify:dummy", True),
    (None, dict(fast=[0.01], multi=[0.02]), AgentSettings(), "REVIEW", 0.02, "detoxify:dummy", True),
    ("fr", dict(fast=[0.9], multi=[0.2]), AgentSettings(), "ALLOW", 0.2, "detoxify:dummy", False),
    ("fr", dict(fast=[0.9], multi=[0.2]), AgentSettings(prefer_multilingual=False), "BLOCK", 0.9, "detoxify:dummy", False),
    ("fr", dict(fast=[0.7], multi=[0.2]), AgentSettings(), "BLOCK", 0.7, "detoxify:dummy", False),
    ("en", dict(fast=[0.95], finetuned=[0.4]), AgentSettings(), "WARN", 0.4, "finetuned:dummy", False),
    ("en", dict(fast=[0.3]), AgentSettings(), "WARN", 0.3, "detoxify:dummy", False),
]


@pytest.mark.parametrize("lang,found,settings,action,overall,model,review", CASES)
def test_routes(spark, lang, found, settings, action, overall, model, review):
    row = decide(spark, lang, scorers(**found), settings)
    assert (row["action"], row["model_used"], row["request_human_review"]) == (action, model, review)
    assert row["overall_score"] == pytest.approx(overall, abs=1e-6)
    labels = VIETNAMESE_LABELS if model.startswith("vi") else ENGLISH_LABELS
    assert set(row["label_scores"]) == set(labels)
    assert row["language"] == (lang or "unknown")
    assert row["policy_message"] == POLICY.action_messages[action]


def test_double_thresholds(spark):
    """The 32-bit 0.35 lies below 0.35, the 32-bit 0.6 above 0.6."""
    assert float(np.float32(0.35)) < 0.35 and float(np.float32(0.6)) > 0.6
    assert decide(spark, "en", scorers([0.35]))["action"] == "WARN"
    assert decide(spark, "en", scorers([0.6], finetuned=[0.6]))["action"] == "REVIEW"
    assert decide(spark, "fr", scorers([0.9], multi=[0.6]))["action"] == "BLOCK"


def test_nan_score(spark):
    row = decide(spark, "en", scorers([float("nan")], finetuned=[0.1]))
    assert (row["action"], row["model_used"]) == ("BLOCK", "detoxify:dummy")


def test_explanation(spark):
    row = decide(spark, "en", scorers([0.125, 0.2, 0.2]))
    assert row["explanation"] == "Top signals -> severe_toxic: 0.20, obscene: 0.20"
    df = spark.range(1).select(F.array(F.lit("toxic")).alias("l"), F.array(F.lit(0.5)).alias("s"))
    plain = PolicyRules(POLICY.action_messages, POLICY.label_names, 2, include_scores=False)
    assert df.select(explanation(F.col("l"), F.col("s"), plain)).first()[0] == "Top signals -> tox"
    none = PolicyRules(POLICY.action_messages, POLICY.label_names, 0)
    assert df.select(explanation(F.col("l"), F.col("s"), none)).first()[0] == "No strong toxicity signals."


def test_redaction_on_request(spark):
    df = spark.createDataFrame([("mail a@b.co", "en")], "text string, lang string")
    row = moderate(df, scorers([0.1]), with_redaction=True).first()
    assert row["text_redacted"] == "mail <EMAIL>"
    assert "text_redacted" not in moderate(df, scorers([0.1])).columns


def make_load():
    """A loader that workers get by value: test modules are not on their path."""

    def load():
        def predict(texts):
            assert len(texts) <= 3 and all(t is not None for t in texts)
            return np.array([[len(t), 1.0] for t in texts])

        return predict

    return load


def test_batch_scorer(spark):
    rows = [(i, "x" * i if i else None, "en" if i % 2 else "fr") for i in range(20)]
    df = spark.createDataFrame(rows, "id int, text string, lang string").repartition(3)
    scorer = BatchScorer("m", ["a", "b"], make_load(), batch_size=3)
    got = {r["id"]: r["p"] for r in scorer.score(df, "text", "p").collect()}
    assert got == {i: [float(i), 1.0] for i in range(20)}
    some = {r["id"]: r["p"] for r in scorer.score(df, "text", "p", where=F.col("lang") == "en").collect()}
    assert some == {i: [float(i), 1.0] if i % 2 else None for i in range(20)}
    assert scorer.score(df.limit(0), "text", "p").collect() == []


def test_batch_scorer_width(spark):
    df = spark.createDataFrame([("t",)], "text string")
    with pytest.raises(Exception, match="expected"):
        BatchScorer("m", ["a", "b", "c"], make_load()).score(df, "text", "p").collect()


def test_each_text_scored_once(spark):
    """A filter on the decision does not run the scorer a second time."""
    df = spark.createDataFrame([("t", "en")], "text string, lang string")
    scorer = BatchScorer("m", ENGLISH_LABELS, lambda: lambda ts: np.zeros((len(ts), 6)))
    plan = moderate(df, ScorerSet(scorer)).filter("request_human_review or action = 'ALLOW'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1
