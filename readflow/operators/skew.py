"""Building blocks that keep work balanced when a key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from readflow.functions.columns import md5_number, with_row
from readflow.session import materialize

def dense_index(df: DataFrame, key: str, index: str) -> DataFrame:
    """Map the distinct non-empty keys to 0..n-1.

    Keys go to one of 65,536 buckets by a prefix of their MD5, so buckets are even and the result is
    the same on every run; the index is the bucket's offset plus the rank inside it. The table of
    offsets has one row per bucket, which bounds both its window and its broadcast.
    """
    keys = df.select(key).filter(F.col(key).isNotNull() & (F.col(key).cast("string") != "")).distinct()
    keys = keys.withColumn("_bucket", md5_number(F.col(key).cast("string"), 4))
    sizes = keys.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(W.partitionBy("_bucket").orderBy(key))
    return (
        keys.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_bucket")
        .select(key, (F.col("_offset") + F.col("_rank") - 1).cast("bigint").alias(index))
    )


def ordered_index(df: DataFrame, key: str, index: str) -> DataFrame:
    """Map the distinct keys to 0..n-1 in the order of the key (NULL first), whatever its type and its gaps."""
    counted = running_totals(df.select(key).distinct().withColumn("_one", F.lit(1)), key, ["_one"])
    return counted.select(key, (F.col("cum__one") - 1).cast("bigint").alias(index))


def in_range_parts(df: DataFrame, *order: str, name: str = "ranged") -> DataFrame:
    """Rows range-partitioned by ``order`` and written once, with the number of their part as ``_part``.

    Parts follow each other in that order and hold about the same number of rows, so a group of
    rows with one key is spread over as many parts as its size asks for.
    """
    return materialize(df.repartitionByRange(*[F.col(c) for c in order]).withColumn("_part", F.spark_partition_id()), name)


def running_totals(df: DataFrame, value: str, amounts: list[str]) -> DataFrame:
    """Add ``cum_<amount>``: totals over all rows up to and including each ``value`` (values distinct).

    Rows are range-partitioned by value and written once, so that partition totals and row totals
    come from the same split. The offsets have one row per partition.
    """
    table = in_range_parts(df, value, name="running-totals")
    parts = table.groupBy("_part").agg(*[F.sum(a).alias(a) for a in amounts])
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select("_part", *[F.coalesce(F.sum(a).over(before), F.lit(0)).alias(f"_before_{a}") for a in amounts])
    inside = W.partitionBy("_part").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = {f"cum_{a}": F.sum(a).over(inside) + F.col(f"_before_{a}") for a in amounts}
    return (
        table.join(F.broadcast(offsets), "_part").withColumns(totals)
        .drop("_part", *[f"_before_{a}" for a in amounts])
    )
