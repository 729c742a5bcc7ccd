"""From texts to decisions: route, score, act, explain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark import constants as K
from modspark.config import AgentSettings, PolicyRules
from modspark.functions.labels import look_up
from modspark.functions.language import UNKNOWN, is_english, is_vietnamese
from modspark.functions.numbers import two_decimals
from modspark.functions.text import redact_pii
from modspark.operators.scoring import Scorer

DECISION_COLUMNS = (
    "action",
    "overall_score",
    "label_scores",
    "model_used",
    "language",
    "policy_message",
    "explanation",
    "request_human_review",
)


@dataclass(frozen=True)
class ScorerSet:
    """The fast scorer sees every text; the others only the texts routed to them."""

    fast: Scorer
    multilingual: Scorer | None = None
    finetuned: Scorer | None = None
    vi: Scorer | None = None

    def present(self) -> dict[str, Scorer]:
        named = {
            "fast": self.fast,
            "multilingual": self.multilingual,
            "finetuned": self.finetuned,
            "vi": self.vi,
        }
        return {route: scorer for route, scorer in named.items() if scorer is not None}


def borderline(overall: Column, settings: AgentSettings) -> Column:
    return (overall >= settings.borderline_low) & (overall <= settings.borderline_high)


def needs_second_pass(overall: Column, lang: Column, settings: AgentSettings) -> Column:
    """Borderline, high risk, unknown language or a language that always gets one."""
    high = (overall >= settings.high_risk) & ~F.isnan(overall)
    need = borderline(overall, settings) | high | (lang == UNKNOWN)
    forced = [x.lower() for x in settings.forced_languages]
    return need | F.lower(lang).isin(*forced) if forced else need


def choose_route(need: Column, lang: Column, scorers: ScorerSet, settings: AgentSettings) -> Column:
    route = F.when(F.lit(False), F.lit(""))
    if scorers.vi is not None:
        route = route.when(is_vietnamese(lang), F.lit("vi"))
    if scorers.multilingual is not None and settings.prefer_multilingual:
        route = route.when(need & ~is_english(lang), F.lit("multilingual"))
    if scorers.finetuned is not None:
        route = route.when(need & is_english(lang), F.lit("finetuned"))
    return route.otherwise(F.lit("fast"))


def base_action(overall: Column, settings: AgentSettings) -> Column:
    return (
        F.when(overall < settings.allow_below, F.lit("ALLOW"))
        .when(overall < settings.warn_below, F.lit("WARN"))
        .otherwise(F.lit("BLOCK"))
    )


def wants_review(action: Column, is_borderline: Column, lang: Column) -> Column:
    """Unknown language always; a borderline first pass unless the text is allowed."""
    return (lang == UNKNOWN) | (is_borderline & (action != "ALLOW"))


def top_labels(labels: Column, scores: Column, k: int) -> Column:
    """The k best ``(score, label)`` pairs, ties in label order."""
    ranked = F.array_sort(
        F.transform(
            scores,
            lambda s, i: F.struct(
                (-s).alias("down"), i.alias("place"), F.get(labels, i).alias("label"), s.alias("score")
            ),
        )
    )
    return F.slice(ranked, 1, k)


def explanation(labels: Column, scores: Column, policy: PolicyRules) -> Column:
    def line(entry: Column) -> Column:
        name = look_up(policy.label_names, entry["label"], entry["label"])
        if not policy.include_scores:
            return name
        return F.concat(name, F.lit(": "), two_decimals(entry["score"]))

    parts = F.transform(top_labels(labels, scores, policy.top_k), line)
    return F.when(
        F.size(parts) > 0, F.concat(F.lit(K.EXPLANATION_PREFIX), F.array_join(parts, ", "))
    ).otherwise(F.lit(K.EXPLANATION_EMPTY))


def route_texts(
    df: DataFrame,
    scorers: ScorerSet,
    settings: AgentSettings = AgentSettings(),
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Add ``language, overall_fast, is_borderline, route, final_labels, final_scores, model_used``.

    One pass over the texts: each further scorer gets its rows only, so no text is read
    twice and no branch is unioned back. The policy compares 64-bit values, unlike the
    metrics, hence the cast of the scores.
    """
    out = df.withColumn("language", F.coalesce(F.col(lang), F.lit(UNKNOWN)))
    out = scorers.fast.score(out, text, "_fast")
    out = out.withColumn("overall_fast", F.array_max(F.col("_fast").cast("array<double>")))
    need = needs_second_pass(F.col("overall_fast"), F.col("language"), settings)
    out = out.withColumn("is_borderline", borderline(F.col("overall_fast"), settings))
    out = out.withColumn("route", choose_route(need, F.col("language"), scorers, settings))

    labels = F.when(F.lit(False), F.array(F.lit("")))
    scores = F.when(F.lit(False), F.array(F.lit(0.0)))
    model = F.when(F.lit(False), F.lit(""))
    for route, scorer in scorers.present().items():
        here = F.col("route") == route
        if route != "fast":
            out = scorer.score(out, text, f"_{route}", where=here)
        labels = labels.when(here, F.array(*[F.lit(x) for x in scorer.labels]))
        scores = scores.when(here, F.col(f"_{route}").cast("array<double>"))
        model = model.when(here, F.lit(f"{K.ROUTE_KINDS[route]}:{scorer.name}"))
    out = out.withColumns({"final_labels": labels, "final_scores": scores, "model_used": model})
    return out.drop(*[f"_{route}" for route in scorers.present()])


def moderate(
    df: DataFrame,
    scorers: ScorerSet,
    settings: AgentSettings = AgentSettings(),
    policy: PolicyRules = PolicyRules(),
    text: str = "text",
    lang: str = "lang",
    with_redaction: bool = False,
) -> DataFrame:
    """The input columns plus ``DECISION_COLUMNS`` (and ``text_redacted`` on request)."""
    routed = route_texts(df, scorers, settings, text, lang)
    routed = routed.withColumn("overall_score", F.array_max("final_scores"))
    routed = routed.withColumn("_base", base_action(F.col("overall_score"), settings))
    review = wants_review(F.col("_base"), F.col("is_borderline"), F.col("language"))
    routed = routed.withColumn("request_human_review", review)
    action = F.when(F.col("request_human_review"), F.lit("REVIEW")).otherwise(F.col("_base"))
    routed = routed.withColumn("action", action)
    labels, scores = F.col("final_labels"), F.col("final_scores")
    decided = {
        "label_scores": F.map_from_arrays(labels, scores),
        "policy_message": look_up(policy.action_messages, F.col("action"), F.lit("")),
        "explanation": explanation(labels, scores, policy),
    }
    if with_redaction:
        decided["text_redacted"] = redact_pii(F.coalesce(F.col(text), F.lit("")))
    inputs = [c for c in df.columns if c not in DECISION_COLUMNS]
    return routed.withColumns(decided).select(
        *inputs,
        *DECISION_COLUMNS,
        "route",
        *(["text_redacted"] if with_redaction else []),
    )
