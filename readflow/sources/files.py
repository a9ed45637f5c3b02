"""CSV and Parquet sources and sinks."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from readflow.sources import schemas

DATE_PARTITIONS = ("year", "month", "day")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV with header, ``"`` as quote and escape; broken rows keep NULLs instead of failing.

    Large files are split over many tasks. With ``multi_line`` quoted values may hold line breaks,
    and a file is one task: only articles, whose texts may, are read so by default.
    """
    return (
        spark.read.schema(schema)
        .option("header", True).option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line).option("mode", "PERMISSIVE").option("enforceSchema", False)
        .csv(path)
    )


def read_history(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_csv(spark, path, schemas.RAW_HISTORY, multi_line)


def read_articles(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return read_csv(spark, path, schemas.RAW_ARTICLES, multi_line)


def read_validation(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_csv(spark, path, schemas.RAW_VALIDATION, multi_line)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet layer, without merging the schemas of its files."""
    return spark.read.option("mergeSchema", False).parquet(path)


def date_range(start: str | None = None, end: str | None = None, seconds: str = "ts") -> Column:
    """True for rows from ``start`` up to but not including ``end`` (UTC, ISO format), of a layer partitioned by date.

    The bounds are said of year, month and day as well, so that Spark reads the folders in between only.
    """
    def day(text: str) -> tuple[datetime, list[Column]]:
        t = datetime.fromisoformat(text)
        t = t.replace(tzinfo=timezone.utc) if t.tzinfo is None else t.astimezone(timezone.utc)
        return t, [F.lit(v) for v in (t.year, t.month, t.day)]

    parts, out = [F.col(c) for c in DATE_PARTITIONS], F.lit(True)
    if start is not None:
        at, (y, m, d) = day(start)
        out = out & ((parts[0] > y) | ((parts[0] == y) & ((parts[1] > m) | ((parts[1] == m) & (parts[2] >= d))))) & (F.col(seconds) >= at.timestamp())
    if end is not None:
        at, (y, m, d) = day(end)
        out = out & ((parts[0] < y) | ((parts[0] == y) & ((parts[1] < m) | ((parts[1] == m) & (parts[2] <= d))))) & (F.col(seconds) < at.timestamp())
    return out


def write_table(df: DataFrame, path: str, records_per_file: int = 0) -> None:
    """Unpartitioned Parquet, replacing what was there."""
    df.write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", records_per_file).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    partitions: Iterable[str] = DATE_PARTITIONS,
    records_per_file: int = 1_000_000,
    replace: str = "static",
) -> None:
    """Parquet partitioned by date.

    The ``rebalance`` hint gathers each date into as few tasks as its size asks for and splits
    large dates over many, so there are neither tiny files nor one task per hot date. ``replace``
    is ``static`` (the whole table) or ``dynamic`` (only the dates present in ``df``).
    """
    partitions = list(partitions)
    (
        df.hint("rebalance", *partitions).write.mode("overwrite")
        .option("partitionOverwriteMode", replace).option("compression", "snappy")
        .option("maxRecordsPerFile", records_per_file).partitionBy(*partitions).parquet(path)
    )


def write_bucketed(df: DataFrame, name: str, path: str, keys: Iterable[str], buckets: int) -> DataFrame:
    """A catalogue table of ``buckets`` buckets by ``keys`` at ``path``, replacing one of that name.

    Grouping by the keys, and joining with another table of as many buckets by the same keys, needs
    no shuffle. Rows go to their bucket's task before they are written, so a bucket is one file; all
    rows of one key are in one bucket, so hot keys belong in ``write_partitioned``.
    """
    keys = list(keys)
    (
        df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("compression", "snappy")
        .option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    )
    return df.sparkSession.table(name)


def register_views(interactions: DataFrame, items: DataFrame) -> None:
    """Names under which SQL users find the two silver layers."""
    interactions.createOrReplaceTempView("interactions")
    items.createOrReplaceTempView("items")


def is_complete(spark: SparkSession, *paths: str) -> bool:
    """True when every output was fully written; goes through Hadoop, so object stores work too."""
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        marker = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
        if not marker.getFileSystem(conf).exists(marker):
            return False
    return True
