"""Silver layer of articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from readflow.functions.scoring import days_since

# The suffix removed from article dates and the format of what is left.
DATE_SUFFIX = r"\+00:00"
DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"
UNUSED_COLUMNS = ("url", "body", "caption")


def with_item_dates(articles: DataFrame, as_of=None) -> DataFrame:
    """Parse issue and change dates; add whole days since each and the date parts of the issue date."""
    def parsed(name):
        return F.try_to_timestamp(F.regexp_replace(name, DATE_SUFFIX, ""), F.lit(DATE_FORMAT))

    dated = articles.withColumns({"issued": parsed("issued"), "modified": parsed("modified")})
    return dated.withColumns({
        "days_since_published": days_since(F.col("issued"), as_of),
        "days_since_modified": days_since(F.col("modified"), as_of),
        "year": F.year("issued"), "month": F.month("issued"), "day": F.dayofmonth("issued"),
    })


def silver_items(articles: DataFrame, as_of=None) -> DataFrame:
    """Trimmed ids, parsed dates, unused columns dropped."""
    return with_item_dates(articles.withColumn("page", F.trim("page")), as_of).drop(*UNUSED_COLUMNS)
