"""log1p, min-max scaling and label indexing by expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from readflow.functions.columns import apply_present, with_row

# The columns each scaling applies to.
LOG_COLUMNS = (
    "time_on_page_ms", "time_since_last", "time_since_first", "interaction_score",
    "recency_weight", "avg_time_on_page", "time_weight", "adjusted_score",
)
MINMAX_COLUMNS = ("clicks", "scroll_pct", "visits", "hour", "dayofweek", "first_interaction")
ITEM_COLUMNS = ("days_since_published", "days_since_modified")
USER_VECTOR_COLUMNS = (
    "user_type", "avg_time_on_page", "clicks", "time_on_page_ms",
    "interaction_score", "time_since_last", "recency_weight",
)


def log_scale(df: DataFrame, columns: Iterable[str] = LOG_COLUMNS) -> DataFrame:
    """``log1p`` of the columns present; NULL at or below -1."""
    return apply_present(df, columns, lambda c: F.log1p(c.cast("double")))


def scaled(c: Column, lo: Column, hi: Column) -> Column:
    """Min-max to [0, 1]; a constant becomes 0.5 and NULL stays NULL."""
    return F.when(c.isNull(), F.lit(None)).when(hi == lo, F.lit(0.5)).otherwise((c - lo) / (hi - lo))


def minmax_scale(df: DataFrame, columns: Iterable[str] = MINMAX_COLUMNS) -> DataFrame:
    """Scale all columns present from one aggregate row, read as a scalar subquery."""
    names = [n for n in columns if n in df.columns]
    if not names:
        return df
    bounds = df.agg(*[
        f(F.col(n).cast("double")).alias(f"{tag}_{n}") for n in names for tag, f in (("lo", F.min), ("hi", F.max))])
    return with_row(df, bounds, "_bounds").withColumns({
        n: scaled(F.col(n).cast("double"), F.col(f"_bounds.lo_{n}"), F.col(f"_bounds.hi_{n}")) for n in names
    }).drop("_bounds")


MAX_LABELS = 65_536


def label_index(df: DataFrame, column: str) -> DataFrame:
    """Labels numbered by falling frequency, ties in alphabetical order, as (label, index).

    Labels are categories: more than ``MAX_LABELS`` of them are an error, told from one label more, so
    that what is gathered in one row is bounded beforehand.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    first = counts.orderBy(F.desc("n"), column).limit(MAX_LABELS + 1)
    listed = first.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), F.col(column).alias("label")))).alias("l"))
    few = F.when(F.size("l") <= MAX_LABELS, F.col("l")).otherwise(F.raise_error(F.lit(f"more than {MAX_LABELS} labels in {column}")))
    ranked = listed.select(F.posexplode(few).alias("index", "e"))
    return ranked.select(F.col("e.label").alias(column), F.col("index").cast("double").alias("index"))


def index_labels(df: DataFrame, column: str = "user_type", labels: DataFrame | None = None) -> DataFrame:
    """Replace a label column by its index; NULL and labels not in ``labels`` get the index after the last label.

    The labels are read as one map, a scalar subquery: the rows are neither shuffled nor joined.
    """
    labels = label_index(df, column) if labels is None else labels
    known = labels.agg(F.map_from_entries(F.collect_list(F.struct(column, "index"))).alias("m"))
    out = with_row(df, known, "_labels").withColumn(column, F.coalesce(F.try_element_at("_labels.m", F.col(column)), F.size("_labels.m").cast("double")))
    return out.select(df.columns)


def normalize_interactions(df: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """User type to index, log1p of the long-tailed columns, min-max of the others."""
    return index_labels(minmax_scale(log_scale(df)), "user_type", labels)


def normalize_items(df: DataFrame) -> DataFrame:
    return minmax_scale(log_scale(df, ITEM_COLUMNS), ITEM_COLUMNS)
