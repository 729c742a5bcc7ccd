"""Settings objects handed to the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

from modspark import constants as K


@dataclass(frozen=True)
class AgentSettings:
    """Cut-offs and routing switches of the moderation decision."""

    borderline_low: float = 0.35
    borderline_high: float = 0.65
    high_risk: float = 0.85
    allow_below: float = 0.30
    warn_below: float = 0.60
    prefer_multilingual: bool = True
    forced_languages: tuple[str, ...] = ()


@dataclass(frozen=True)
class PolicyRules:
    """Messages per action, display names per label, explanation format."""

    action_messages: dict[str, str] = field(default_factory=lambda: dict(K.ACTION_MESSAGES))
    label_names: dict[str, str] = field(default_factory=lambda: dict(K.LABEL_DISPLAY_NAMES))
    top_k: int = 3
    include_scores: bool = True


@dataclass(frozen=True)
class LogSettings:
    """What the prediction log may hold besides the hash of the text."""

    store_raw_text: bool = False
    store_redacted_text: bool = False


@dataclass(frozen=True)
class SplitSettings:
    """Ratios of a random split; they must add up to one."""

    train: float = K.SPLIT_RATIOS[0]
    validation: float = K.SPLIT_RATIOS[1]
    test: float = K.SPLIT_RATIOS[2]
    seed: int = K.DEFAULT_SEED

    def __post_init__(self) -> None:
        if abs(self.train + self.validation + self.test - 1.0) >= 1e-6:
            raise ValueError("split ratios must sum to 1.0")
