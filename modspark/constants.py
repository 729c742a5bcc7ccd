"""Fixed values that results depend on: label names, word lists, messages, patterns."""

# --- fixed values: label taxonomies, in array order ------------------------
ENGLISH_LABELS = ("toxic", "severe_toxic", "obscene", "threat", "insult", "identity_hate")
VIETNAMESE_LABELS = ("offensive", "hate")

# --- fixed values: canonical label -> key used by the off-the-shelf scorer -
SCORER_LABEL_RENAMES = {"identity_hate": "identity_attack"}

# --- fixed values: actions and policy texts --------------------------------
ACTIONS = ("ALLOW", "WARN", "REVIEW", "BLOCK")
ACTION_MESSAGES = {
    "ALLOW": "Thanks for your message.",
    "WARN": (
        "Your message may be interpreted as offensive. "
        "Please rephrase to keep the conversation respectful."
    ),
    "REVIEW": "This message is under review due to potential policy concerns.",
    "BLOCK": "This message violates our community guidelines and cannot be posted.",
}
LABEL_DISPLAY_NAMES = {
    "toxic": "toxicity",
    "severe_toxic": "severe toxicity",
    "obscene": "obscenity",
    "threat": "threat",
    "insult": "insult",
    "identity_hate": "identity-based hate",
    "offensive": "offensive",
    "hate": "hate speech",
}
EXPLANATION_PREFIX = "Top signals -> "
EXPLANATION_EMPTY = "No strong toxicity signals."

# --- fixed values: `kind` part of the model_used text, per route -----------
ROUTE_KINDS = {
    "fast": "detoxify",
    "multilingual": "detoxify",
    "finetuned": "finetuned",
    "vi": "vi_finetuned",
}

# --- fixed values: identity terms per fairness slice -----------------------
IDENTITY_TERMS = {
    "gender": [
        "woman", "women", "man", "men", "girl", "girls", "boy", "boys", "female", "male",
    ],
    "religion": [
        "muslim", "christian", "jew", "jewish", "hindu", "buddhist", "catholic", "protestant",
    ],
    "race_ethnicity": [
        "black", "white", "asian", "latino", "latina", "hispanic", "african", "european",
    ],
    "nationality_immigration": [
        "immigrant", "refugee", "foreigner", "american", "chinese", "vietnamese",
    ],
    "lgbtq": ["gay", "lesbian", "bisexual", "transgender", "queer"],
    "disability": ["disabled", "disability", "blind", "deaf"],
}
ANY_SLICE = "any_identity_mention"
REFERENCE_SLICE = "no_identity_mention"

# --- fixed values: split aliases and three-class label names ---------------
SPLIT_ALIASES = {
    "train": "train",
    "training": "train",
    "val": "validation",
    "valid": "validation",
    "dev": "validation",
    "validation": "validation",
    "test": "test",
    "testing": "test",
}
CLASS_NAMES = ("CLEAN", "OFFENSIVE", "HATE")
CLASS_ALIASES = {
    0: ("CLEAN", "NON_TOXIC", "SAFE"),
    1: ("OFFENSIVE", "TOXIC"),
    2: ("HATE", "HATE_SPEECH"),
}
CLASS_TEXT_COLUMNS = ("text", "free_text", "comment", "comment_text")
CLASS_LABEL_COLUMNS = ("label", "label_id")
CLASS_SPLIT_COLUMN = "type"

# --- fixed values: keys that must never carry text in a report -------------
RAW_TEXT_KEYS = ("text", "raw_text", "comment_text", "message", "content")

# --- fixed values: character sets and patterns (Java regex syntax) ---------
# Whitespace as str.split() sees it; Java's own \s is ASCII only.
SPACE_CHARS = (
    r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Word characters: letters, numbers and the underscore.
WORD_CHARS = r"\p{L}\p{N}_"
PUNCTUATION = "!?.:,;\"'()[]{}<>/\\|@#$%^&*_+-=~`"
# Starts only where a run of such characters starts or the last match ended: trying every
# place of a long run would take quadratic time.
EMAIL_PATTERN = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
URL_PATTERN = rf"https?://[^{SPACE_CHARS}]+|www\.[^{SPACE_CHARS}]+"
WORD_EDGE = (
    rf"(?:(?<=[{WORD_CHARS}])(?![{WORD_CHARS}])|(?<![{WORD_CHARS}])(?=[{WORD_CHARS}]))"
)
PHONE_PATTERN = (
    WORD_EDGE
    + rf"(?:\+?\p{{Nd}}{{1,3}}[{SPACE_CHARS}-]?)?(?:\(\p{{Nd}}{{2,4}}\)[{SPACE_CHARS}-]?)?"
    + rf"\p{{Nd}}{{2,4}}[{SPACE_CHARS}-]?\p{{Nd}}{{2,4}}[{SPACE_CHARS}-]?\p{{Nd}}{{2,4}}"
    + WORD_EDGE
)
REPEAT_PATTERN = r"([^\n])\1{2,}"

# --- fixed values: agent and evaluation defaults ---------------------------
THRESHOLD_GRID = tuple(round(0.05 * i, 2) for i in range(1, 20))
SPLIT_RATIOS = (0.9, 0.05, 0.05)
CLASS_SPLIT_RATIOS = (0.8, 0.1, 0.1)
DEFAULT_SEED = 42
