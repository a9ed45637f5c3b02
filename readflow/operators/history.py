"""From raw reading histories to enriched interactions, one row per (user, article read)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from readflow.functions.columns import epoch_seconds, lenient_long
from readflow.functions.scoring import ENGAGEMENT_WEIGHTS, event_time, interaction_score, recency_weight
from readflow.operators.skew import in_range_parts
from readflow.sources.schemas import HISTORY_LISTS

TIE_BREAK = ("page", "clicks", "time_on_page_ms", "scroll_pct", "visits")


def explode_history(raw: DataFrame) -> DataFrame:
    """Split the six parallel lists, zip them by position and emit one row per position.

    Short lists are padded with NULL; a row with a NULL list yields nothing. Ids are trimmed here,
    once, so every later key is clean. Values that do not parse become NULL.
    """
    lists = raw.select(
        F.trim("userId").alias("user_id"),
        F.col("userType").alias("user_type"),
        *[F.split(c, r",\s*").alias(c) for c in HISTORY_LISTS],
    )
    rows = lists.select("user_id", "user_type", F.explode(F.arrays_zip(*HISTORY_LISTS)).alias("e"))
    return rows.select(
        "user_id",
        "user_type",
        F.trim("e.history").alias("page"),
        (lenient_long(F.col("e.timestampHistory")) / 1000).alias("ts"),
        lenient_long(F.col("e.numberOfClicksHistory")).try_cast("int").alias("clicks"),
        lenient_long(F.col("e.timeOnPageHistory")).alias("time_on_page_ms"),
        F.col("e.scrollPercentageHistory").try_cast("double").alias("scroll_pct"),
        lenient_long(F.col("e.pageVisitsCountHistory")).try_cast("int").alias("visits"),
    )


def explode_validation(raw: DataFrame) -> DataFrame:
    """Held-out readers: one row per article of the ``history`` list, ids trimmed, blanks left out."""
    pages = raw.select(F.trim("userId").alias("user_id"), F.col("userType").alias("user_type"), F.explode(F.split("history", r",\s*")).alias("page"))
    return pages.withColumn("page", F.trim("page")).filter("page != ''")


def history_quality(raw: DataFrame) -> DataFrame:
    """One row: histories, and how many are lost to a NULL list or hold lists of unequal length."""
    lengths = [F.size(F.split(c, r",\s*")) for c in HISTORY_LISTS]
    any_null = F.greatest(*[F.col(c).isNull().cast("int") for c in HISTORY_LISTS]) == 1
    return raw.agg(
        F.count(F.lit(1)).alias("histories"),
        F.count_if(any_null).alias("dropped"),
        F.count_if(~any_null & (F.greatest(*lengths) != F.least(*lengths))).alias("padded"),
    )


def with_temporal(df: DataFrame) -> DataFrame:
    """Hour, weekday (1 = Sunday) and date parts of the reading time."""
    t = event_time()
    return df.withColumns({
        "hour": F.hour(t), "dayofweek": F.dayofweek(t),
        "year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t),
    })


def with_user_times(df: DataFrame, as_of=None) -> DataFrame:
    """Seconds since the user's previous reading, first reading, and seconds since it.

    Rows are cut into parts along (user, time), so a user with very many rows, and the readers
    without an id, are spread like all others. Inside a part each user is a window group; one row per
    user and part carries the last and the first time over from the parts before.
    """
    ties = [c for c in TIE_BREAK if c in df.columns]
    parts = in_range_parts(df, "user_id", "ts", *ties, name="user-times")
    by_user = W.partitionBy("user_id")
    ends = parts.groupBy("user_id", "_part").agg(F.min("ts").alias("_first"), F.max("ts").alias("_last"))
    # One further row per user and part, ahead of the others: it holds what the parts before say.
    heads = ends.select(
        "user_id", "_part", F.lag("_last").over(by_user.orderBy("_part")).alias("ts"),
        F.min("_first").over(by_user).alias("_first"), F.lit(True).alias("_head"))
    rows = parts.withColumn("_head", F.lit(False)).unionByName(heads, allowMissingColumns=True)
    group = W.partitionBy("_part", "user_id")
    rows = rows.withColumns({
        "_previous": F.lag("ts").over(group.orderBy(F.desc("_head"), "ts", *ties)), "_first": F.max("_first").over(group)})
    return rows.filter("not _head").select(
        *df.columns,
        F.coalesce(F.col("ts") - F.col("_previous"), F.lit(0.0)).alias("time_since_last"),
        F.col("_first").alias("first_interaction"),
        (epoch_seconds(as_of) - F.col("_first")).alias("time_since_first"),
    )


def with_time_weight(df: DataFrame) -> DataFrame:
    """Mean time on page of the article, and that mean over the largest mean of all articles."""
    means = df.groupBy("page").agg(F.avg("time_on_page_ms").alias("avg_time_on_page"))
    top = means.agg(F.max("avg_time_on_page")).scalar()
    means = means.withColumn("time_weight", F.try_divide(F.col("avg_time_on_page"), top))
    return df.join(means, "page", "left")


def with_adjusted_score(df: DataFrame, as_of=None, weights=ENGAGEMENT_WEIGHTS) -> DataFrame:
    """Engagement times recency times time weight; expects ``time_weight``."""
    return df.withColumns({
        "interaction_score": interaction_score(weights=weights),
        "recency_weight": recency_weight("ts", as_of),
    }).withColumn("adjusted_score", F.col("interaction_score") * F.col("recency_weight") * F.col("time_weight"))


def enrich(df: DataFrame, as_of=None, weights=ENGAGEMENT_WEIGHTS) -> DataFrame:
    """The whole silver layer of interactions."""
    return with_adjusted_score(with_time_weight(with_user_times(with_temporal(df), as_of)), as_of, weights)
