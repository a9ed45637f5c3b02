"""Distinct readers as states that are stored per day and merged over any window."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SKETCH_PRECISION = 12


def daily_readers(temporal: DataFrame, reader_index: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, day, bucket, readers): per day a bitmap of the dense ids of those who read, in buckets of 32,768 ids.

    ``reader_index``: (user_id, user_idx) as ``dense_index`` gives; ids must stay as they are while states
    are merged. A state's size depends on the ids, not on how often they read; rows are set in a
    bitmap where they are read, before the shuffle. Readers without an id are not counted.
    """
    day = F.make_date("year", "month", "day").alias("day")
    rows = temporal.select(*keys, day, "user_id").join(reader_index, "user_id")
    return rows.groupBy(*keys, "day", F.bitmap_bucket_number("user_idx").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_idx")).alias("readers"))


def merged_readers(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of longer windows: ``keys`` name what stays apart, such as a page and a week."""
    return states.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("readers").alias("readers"))


def count_readers(states: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, unique_users), exactly: buckets hold different ids, so their counts add up."""
    return states.groupBy(*keys).agg(F.sum(F.bitmap_count("readers")).alias("unique_users"))


def readers_per_window(states: DataFrame, keys: list[str], window: str) -> DataFrame:
    """(keys, start, unique_users) of daily states merged to weeks (from Monday), months or years."""
    start = F.trunc("day", window).alias("start")
    return count_readers(merged_readers(states.select(*keys, start, "bucket", "readers"), [*keys, "start"]), [*keys, "start"])


def daily_sketches(temporal: DataFrame, keys: list[str], precision: int = SKETCH_PRECISION) -> DataFrame:
    """(keys, day, sketch): the same for approximate counts, in states of bounded size that need no ids."""
    day = F.make_date("year", "month", "day").alias("day")
    return temporal.groupBy(*keys, day).agg(F.hll_sketch_agg("user_id", F.lit(precision)).alias("sketch"))


def estimated_readers(sketches: DataFrame, keys: list[str], window: str) -> DataFrame:
    """(keys, start, unique_users), to within a few percent."""
    start = F.trunc("day", window).alias("start")
    merged = sketches.groupBy(*keys, start).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*keys, "start", F.hll_sketch_estimate("sketch").alias("unique_users"))
