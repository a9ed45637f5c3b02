"""Declared schemas of every layer; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of the raw files. In a reading history the last six columns are parallel comma-separated lists.
HISTORY_LISTS = (
    "history", "timestampHistory", "numberOfClicksHistory", "timeOnPageHistory",
    "scrollPercentageHistory", "pageVisitsCountHistory",
)
RAW_HISTORY = T.StructType([T.StructField(n, T.StringType()) for n in ("userId", "userType", *HISTORY_LISTS)])

RAW_ARTICLES = T.StructType([
    T.StructField(n, T.StringType()) for n in ("page", "url", "issued", "modified", "title", "body", "caption")
])

# Held-out readers of a later period: the articles to be predicted.
RAW_VALIDATION = T.StructType([T.StructField(n, T.StringType()) for n in ("userId", "userType", "history")])

INTERACTIONS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("user_type", T.StringType()),
    T.StructField("page", T.StringType()),
    T.StructField("ts", T.DoubleType()),
    T.StructField("clicks", T.IntegerType()),
    T.StructField("time_on_page_ms", T.LongType()),
    T.StructField("scroll_pct", T.DoubleType()),
    T.StructField("visits", T.IntegerType()),
])

MATRIX = T.StructType([
    T.StructField("user_idx", T.LongType()),
    T.StructField("item_idx", T.LongType()),
    T.StructField("score", T.DoubleType()),
])


def factor_schema(id_col: str) -> T.StructType:
    return T.StructType([
        T.StructField(id_col, T.StringType()),
        T.StructField("factors", T.ArrayType(T.DoubleType())),
        T.StructField("bias", T.DoubleType()),
    ])


_METRICS = T.MapType(T.StringType(), T.DoubleType())
_COUNTS = T.MapType(T.StringType(), T.LongType())

RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("model_summary", T.MapType(T.StringType(), T.StringType())),
    T.StructField("hyperparameters", _METRICS),
    T.StructField("performance_metrics", _METRICS),
    T.StructField("interaction_distribution", _METRICS),
    T.StructField("model_stability", _METRICS),
    T.StructField("embedding_stats", _METRICS),
    T.StructField("feature_importance", _METRICS),
    T.StructField("dataset_info", _COUNTS),
    T.StructField("sample_size", T.DoubleType()),
    T.StructField("score_stability", _METRICS),
    T.StructField("user_interactions", _METRICS),
    T.StructField("item_interactions", _METRICS),
    T.StructField("user_histogram", T.ArrayType(T.LongType())),
    T.StructField("item_histogram", T.ArrayType(T.LongType())),
    T.StructField("component_means", _METRICS),
])
