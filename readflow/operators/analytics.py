"""The exploratory analyses: each returns a table of chart size or one row per key asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

MS_PER_MINUTE = 60_000
# Upper limits and labels of the popularity bands.
POPULARITY_BANDS = [(10, "1-10"), (100, "11-100"), (1000, "101-1000"), (10000, "1001-10000")]
LAST_BAND = "10001+"
# Articles outside these limits are left out of the engagement analysis.
MAX_AVG_TIME_MS = 500_000
MAX_AVG_CLICKS = 500


def _count(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def reads_per_user(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("user_id").agg(F.count("page").alias("reads"))


def reads_by_hour(interactions: DataFrame) -> DataFrame:
    return _count(interactions, "hour").orderBy("hour")


def reads_by_weekday_hour(interactions: DataFrame) -> DataFrame:
    return _count(interactions, "dayofweek", "hour").orderBy("dayofweek", "hour")


def reads_by_day(interactions: DataFrame) -> DataFrame:
    label = F.concat_ws("-", F.col("year").cast("string"), F.col("month").cast("string"), F.col("day").cast("string"))
    return _count(interactions, "year", "month", "day").withColumn("label", label).orderBy("year", "month", "day")


def visits_per_user_day(interactions: DataFrame) -> DataFrame:
    return _count(interactions, "year", "month", "day", "user_id", name="visits")


def daily_active_users(interactions: DataFrame) -> DataFrame:
    users = interactions.groupBy("year", "month", "day").agg(F.countDistinct("user_id").alias("unique_users"))
    return users.withColumn("date", F.make_date("year", "month", "day")).orderBy("date")


def user_type_by_day(interactions: DataFrame) -> DataFrame:
    """Reads per day and user type, with the type's share of the day."""
    counts = _count(interactions, "year", "month", "day", "user_type")
    date = F.concat(
        F.col("year").cast("string"), F.lit("-"), F.lpad(F.col("month").cast("string"), 2, "0"),
        F.lit("-"), F.lpad(F.col("day").cast("string"), 2, "0"))
    share = F.col("count") / F.sum("count").over(W.partitionBy("year", "month", "day"))
    return counts.select(date.alias("date"), "user_type", "count", share.alias("share")).orderBy("date", "user_type")


def recency_access(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """Reads by issue date and age of the article; reads are counted per page before the join."""
    return recency_of_counts(_count(interactions, "page", name="reads"), items)


def recency_of_counts(reads: DataFrame, items: DataFrame) -> DataFrame:
    """``recency_access`` from reads (page, reads). Tables bucketed alike by page join without a shuffle."""
    return (
        reads.join(items.select("page", "year", "month", "day", "days_since_published"), "page")
        .groupBy(
            F.col("year").alias("item_year"), F.col("month").alias("item_month"), F.col("day").alias("item_day"),
            "days_since_published")
        .agg(F.sum("reads").alias("access_count"))
    )


def recency_curve(access: DataFrame) -> DataFrame:
    return access.groupBy("days_since_published").agg(F.sum("access_count").alias("access_count"))


def users_per_item(interactions: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct("user_id") if approximate else F.countDistinct("user_id")
    return interactions.groupBy("page").agg(count.alias("unique_users"))


def users_per_item_exploded(histories: DataFrame) -> DataFrame:
    """Unique users per article straight from the comma-separated lists."""
    pages = histories.select(F.trim("userId").alias("user_id"), F.explode(F.split("history", r",\s*")).alias("page"))
    return users_per_item(pages.withColumn("page", F.trim("page")))


def popularity_bands(item_users: DataFrame) -> DataFrame:
    """Number of articles per band of unique users, in band order."""
    users = F.col("unique_users")
    label, order = None, None
    for i, (limit, name) in enumerate(POPULARITY_BANDS):
        label = F.when(users <= limit, name) if label is None else label.when(users <= limit, name)
        order = F.when(users <= limit, i) if order is None else order.when(users <= limit, i)
    banded = item_users.select(label.otherwise(LAST_BAND).alias("band"), order.otherwise(len(POPULARITY_BANDS)).alias("band_order"))
    return _count(banded, "band_order", "band").orderBy("band_order")


def engagement_by_item(interactions: DataFrame, fraction: float | None = None, seed: int = 42) -> DataFrame:
    """Mean time, clicks, scroll and score per article within the fixed limits; optionally a sample."""
    means = interactions.groupBy("page").agg(
        F.avg("time_on_page_ms").alias("avg_time_ms"), F.avg("clicks").alias("avg_clicks"),
        F.avg("scroll_pct").alias("avg_scroll_pct"), F.avg("interaction_score").alias("avg_score"))
    kept = means.filter(
        (F.col("avg_time_ms") > 0) & (F.col("avg_time_ms") < MAX_AVG_TIME_MS) & (F.col("avg_clicks") < MAX_AVG_CLICKS))
    kept = kept.withColumn("avg_time_min", F.col("avg_time_ms") / MS_PER_MINUTE)
    return kept if fraction is None else kept.sample(fraction=fraction, seed=seed)


def clicks_time_sample(interactions: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """A random share of (clicks, time on page) for the scatter chart."""
    return interactions.select("clicks", "time_on_page_ms").sample(fraction=fraction, seed=seed)


def clicks_time_corr(interactions: DataFrame) -> DataFrame:
    return interactions.agg(F.corr("clicks", "time_on_page_ms").alias("correlation"))


def distinct_users_items(interactions: DataFrame) -> DataFrame:
    """Every user and every page once, as (kind, id)."""
    kinds = F.explode(F.array(
        F.struct(F.lit("user").alias("kind"), F.col("user_id").alias("id")),
        F.struct(F.lit("page").alias("kind"), F.col("page").alias("id")))).alias("e")
    return interactions.select(kinds).select("e.*").filter("id is not null").distinct()


def preview(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """The first ``n`` distinct values in order."""
    return df.select(column).distinct().orderBy(column).limit(n)


def top_pages(interactions: DataFrame, score: str = "adjusted_score", n: int = 10) -> DataFrame:
    """Each user's best pages by total score."""
    totals = interactions.groupBy("user_id", "page").agg(F.sum(score).alias("score"))
    place = F.row_number().over(W.partitionBy("user_id").orderBy(F.desc("score"), "page"))
    return totals.withColumn("rank", place).filter(F.col("rank") <= n).select("user_id", "rank", "page", "score")
