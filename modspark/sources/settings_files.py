"""Policy rules and identity terms from YAML or JSON files."""

from __future__ import annotations

import json
from dataclasses import fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from modspark.config import AgentSettings, PolicyRules


def _read(path: str) -> dict:
    """Settings files are a few lines and belong to the driver program."""
    content = Path(path).read_text(encoding="utf-8")
    if Path(path).suffix.lower() in {".yaml", ".yml"}:
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("reading YAML needs PyYAML; use a JSON file instead") from error
        return yaml.safe_load(content) or {}
    return json.loads(content)


def load_policy(path: str) -> PolicyRules:
    rules = _read(path)
    explain = rules.get("explanations", {})
    return PolicyRules(
        {a: str(v.get("user_message", "")) for a, v in rules.get("actions", {}).items()},
        {x: str(v.get("display_name", x)) for x, v in rules.get("labels", {}).items()},
        int(explain.get("top_k_labels", 3)),
        bool(explain.get("include_scores", True)),
    )


def load_agent(path: str) -> AgentSettings:
    """Cut-offs and routing switches; settings that are not given keep their defaults."""
    given = _read(path)
    known = {f.name for f in fields(AgentSettings)}
    if set(given) - known:
        raise ValueError(f"unknown agent settings: {sorted(set(given) - known)}")
    if "forced_languages" in given:
        given["forced_languages"] = tuple(given["forced_languages"])
    return AgentSettings(**given)


def load_groups(path: str) -> dict[str, list[str]]:
    """Identity-term groups; terms are trimmed and blank ones dropped."""
    groups = _read(path).get("groups")
    if not isinstance(groups, dict):
        raise ValueError("expected a mapping under 'groups'")
    for name, terms in groups.items():
        if not isinstance(terms, list):
            raise ValueError(f"group '{name}' must be a list of terms")
    return {str(g): [str(t).strip() for t in terms if str(t).strip()] for g, terms in groups.items()}


def groups_frame(spark: SparkSession, groups: dict[str, list[str]]) -> DataFrame:
    """The groups as a dimension table ``grp, terms``."""
    return spark.createDataFrame(list(groups.items()), "grp string, terms array<string>")
