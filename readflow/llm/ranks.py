"""Gapless numbers inside large groups, without a task that sees a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

BUCKETS = 1024


def with_rank(df: DataFrame, group: str, order: list[Column], spread: Column, name: str, buckets: int = BUCKETS) -> DataFrame:
    """Add ``name``: 0, 1, … without gaps inside each ``group``, ordered by (bucket of ``spread``, ``order``).

    A group is cut into ``buckets`` parts by a hash; rows are numbered inside each part, and a small
    table with one row per part (at most ``buckets`` per group) shifts them. Rows equal in ``order``
    and ``spread`` may swap numbers; that is no difference if they are equal in all columns.
    """
    part, size, first = "_bucket_", "_size_", "_first_"
    rows = df.withColumn(part, F.pmod(spread, F.lit(buckets)).cast("int"))
    sizes = rows.groupBy(group, part).agg(F.count(F.lit(1)).alias(size))
    before = W.partitionBy(group).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    shifts = sizes.select(
        F.col(group).alias("_group_"), F.col(part).alias("_part_"), F.coalesce(F.sum(size).over(before), F.lit(0)).alias(first))
    inside = F.row_number().over(W.partitionBy(group, part).orderBy(*order))
    return (
        rows.withColumn(name, inside)
        .join(shifts, F.col(group).eqNullSafe(F.col("_group_")) & (F.col(part) == F.col("_part_")))
        .withColumn(name, (F.col(name) - 1 + F.col(first)).cast("bigint"))
        .drop(part, first, "_group_", "_part_")
    )
