"""Explicit schemas used at read and write boundaries."""

from pyspark.sql import types as T

SCORE_MAP = T.MapType(T.StringType(), T.DoubleType())

# Scores are read as text: a log line may hold a number written as a string, and a value
# that does not parse must not make the whole line unreadable.
PREDICTION_LOG_READ = T.StructType(
    [
        T.StructField("ts_utc", T.StringType()),
        T.StructField("text_sha256", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("overall_score", T.StringType()),
        T.StructField("label_scores", T.StringType()),
        T.StructField("model_used", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("request_human_review", T.BooleanType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("text_redacted", T.StringType()),
        T.StructField("_bad", T.StringType()),
    ]
)

REVIEW_QUEUE = T.StructType(
    [
        T.StructField("ts_utc", T.StringType()),
        T.StructField("text_sha256", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("overall_score", T.DoubleType()),
        T.StructField("label_scores", SCORE_MAP),
        T.StructField("model_used", T.StringType()),
    ]
)

REQUEST = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("texts", T.ArrayType(T.StringType())),
    ]
)
