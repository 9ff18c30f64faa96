"""Schemas at the boundaries between stages."""

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


MESSAGES_RAW = _schema(
    ("tweet_id", T.LongType()),
    ("author_id", T.StringType()),
    ("inbound", T.BooleanType()),
    ("created_at", T.StringType()),
    ("text", T.StringType()),
    ("response_tweet_id", T.StringType()),
    ("in_response_to_tweet_id", T.LongType()),
)

COMPONENTS = _schema(("tweet_id", T.LongType()), ("component_id", T.LongType()))

MESSAGES = _schema(
    ("tweet_id", T.LongType()),
    ("component_id", T.LongType()),
    ("author_id", T.StringType()),
    ("inbound", T.BooleanType()),
    ("created_at", T.TimestampType()),
    ("text", T.StringType()),
    ("turn_index", T.LongType()),
)

ASSIGNMENT = _schema(
    ("component_id", T.LongType()),
    ("heuristic_intent", T.StringType()),
    ("is_non_english", T.BooleanType()),
    ("split", T.StringType()),
)

GOLDEN = _schema(
    ("golden_id", T.StringType()),
    ("source_tweet_id", T.LongType()),
    ("component_id", T.LongType()),
    ("text", T.StringType()),
    ("heuristic_intent", T.StringType()),
    ("human_intent", T.StringType()),
    ("difficulty", T.StringType()),
    ("language_scope", T.StringType()),
    ("annotator_notes", T.StringType()),
)

LABELS = _schema(
    ("golden_id", T.StringType()),
    ("human_intent", T.StringType()),
    ("difficulty", T.StringType()),
    ("note", T.StringType()),
)

CORPUS = _schema(
    ("case_id", T.StringType()),
    ("component_id", T.LongType()),
    ("customer_text", T.StringType()),
    ("cleaned_customer_text", T.StringType()),
    ("agent_reply", T.StringType()),
    ("intent", T.StringType()),
)
