"""The fixed table schemas.  Readers use them; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_STR, _INT, _LONG, _DBL, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()

FEEDBACK = _table(
    ("feedback_id", _STR, False), ("feedback_text", _STR, False), ("feedback_source", _STR, False),
    ("created_at", _TS, False), ("sku", _STR, True), ("category", _STR, True),
    ("rating", _INT, True), ("cluster_id", _STR, True),
)
CLUSTERS = _table(
    ("cluster_id", _STR, False), ("cluster_label", _STR, False), ("cluster_description", _STR, True),
    ("sample_feedback_ids", _STR, True), ("record_count", _LONG, False),
    ("period_start", _TS, False), ("period_end", _TS, False), ("created_at", _TS, False),
    ("style", _STR, True), ("source", _STR, False), ("cluster_depth", _INT, False),
)
TAGS = _table(
    ("feedback_id", _STR, False), ("tag_name", _STR, False),
    ("confidence_score", _DBL, False), ("created_at", _TS, False),
)
EMBEDDED_ITEMS = _table(("feedback_id", _STR, False), ("embedded_at", _TS, False))
ASSIGNED = _table(("feedback_id", _STR, False), ("cluster_id", _STR, True), ("assigned_at", _TS, False))
INVENTORY = _table(("sku", _STR, False), ("style", _STR, True))
EMBEDDINGS = _table(
    ("feedback_id", _STR, False), ("vector", T.ArrayType(T.FloatType()), False), ("model", _STR, False),
    ("source", _STR, False), ("style", _STR, True), ("feedback_text", _STR, True), ("created_at", _TS, False),
)

# Columns that must be present and non-null, per record type.
REQUIRED = {
    "feedback": ("feedback_id", "feedback_text", "feedback_source", "created_at"),
    "embedding": ("feedback_id", "vector", "source", "model", "created_at"),
    "cluster": ("cluster_id", "cluster_label", "source", "record_count", "cluster_depth",
                "period_start", "period_end", "created_at"),
    "tag": ("feedback_id", "tag_name", "confidence_score", "created_at"),
}
