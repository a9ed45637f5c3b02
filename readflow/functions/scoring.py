"""Engagement and recency scores of one interaction."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from readflow.functions.columns import epoch_seconds

# Weights of clicks, time on page and scroll in the engagement score.
ENGAGEMENT_WEIGHTS = (0.5, 0.3, 0.2)
SECONDS_PER_DAY = 86400


def interaction_score(clicks="clicks", time_on_page="time_on_page_ms", scroll="scroll_pct",
                      weights=ENGAGEMENT_WEIGHTS) -> Column:
    """Weighted engagement; NULL when a part is NULL."""
    w_clicks, w_time, w_scroll = (F.lit(float(w)) for w in weights)
    return F.col(clicks) * w_clicks + F.col(time_on_page) * w_time + F.col(scroll) * w_scroll


def recency_weight(ts="ts", as_of=None) -> Column:
    """Hyperbolic decay ``1 / (1 + age in days)``."""
    age = (epoch_seconds(as_of) - F.col(ts)) / F.lit(SECONDS_PER_DAY)
    return F.try_divide(F.lit(1.0), F.lit(1.0) + age)


def days_since(t: Column, as_of=None) -> Column:
    """Whole days from ``t`` to ``as_of``, cut toward zero; negative for later dates."""
    return ((epoch_seconds(as_of) - F.unix_seconds(t.cast("timestamp"))) / SECONDS_PER_DAY).cast("int")


def event_time(ts="ts") -> Column:
    """Epoch seconds to timestamp, to the second."""
    return F.timestamp_seconds(F.floor(ts))
