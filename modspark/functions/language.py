"""Language tests and the guard around a language detector."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from modspark import constants as K

UNKNOWN = "unknown"


def guarded(text: Column, detected: Column) -> Column:
    """Detector output, or "unknown" for texts under three characters or failed detection."""
    # two visible characters with something between them: three or more after trimming
    visible = rf"(?s)[^{K.SPACE_CHARS}].+[^{K.SPACE_CHARS}]"
    return (
        F.when(~F.coalesce(text, F.lit("")).rlike(visible), F.lit(UNKNOWN))
        .when(detected.isNull() | (detected == ""), F.lit(UNKNOWN))
        .otherwise(detected)
    )


def _starts_with(lang: Column, prefix: str) -> Column:
    return F.startswith(F.lower(F.coalesce(lang, F.lit(""))), F.lit(prefix))


def is_english(lang: Column) -> Column:
    return _starts_with(lang, "en")


def is_vietnamese(lang: Column) -> Column:
    return _starts_with(lang, "vi")
