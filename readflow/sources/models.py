"""Stored factor models and the table of monitoring runs."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from readflow.sources import schemas


def save_factors(user_factors: DataFrame, item_factors: DataFrame, path: str) -> None:
    user_factors.select("user_id", "factors", "bias").write.mode("overwrite").parquet(f"{path}/users")
    item_factors.select("page", "factors", "bias").write.mode("overwrite").parquet(f"{path}/items")


def load_factors(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    users = spark.read.schema(schemas.factor_schema("user_id")).parquet(f"{path}/users")
    items = spark.read.schema(schemas.factor_schema("page")).parquet(f"{path}/items")
    return users, items


def append_run(run: DataFrame, path: str) -> bool:
    """Add one run document (a JSON line) under its ``run_id``; False if that run was there already.

    The document is written aside and read back, then moved to a name that follows from the run's id:
    readers see it whole or not at all, and a retry adds no second copy.
    """
    spark = run.sparkSession
    named = run.select([(F.col(f.name) if f.name in run.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.RUNS])
    aside = f"{path}/_aside/{uuid.uuid4().hex}"
    named.coalesce(1).write.json(aside)
    try:
        written = read_runs(spark, aside).select("run_id").take(2)
        if len(written) != 1 or written[0]["run_id"] is None:
            raise ValueError("a run is one document with a run_id")
        hadoop = spark._jvm.org.apache.hadoop.fs
        place = hadoop.Path(f"{path}/run-{hashlib.sha256(written[0]['run_id'].encode()).hexdigest()[:32]}.json")
        system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if system.exists(place):
            return False
        document = next(s.getPath() for s in system.listStatus(hadoop.Path(aside)) if s.getPath().getName().startswith("part-") and s.getLen())
        return system.rename(document, place)
    finally:
        where = spark._jvm.org.apache.hadoop.fs.Path(aside)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RUNS).json(path)


def list_runs(runs: DataFrame) -> DataFrame:
    """Runs that succeeded, newest first."""
    return runs.filter("status = 'ok'").orderBy(F.desc("created_at"), F.desc("run_id"))


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest successful run by its own timestamp, whatever order the files were written in."""
    whole = F.struct(*runs.columns)
    newest = runs.filter("status = 'ok'").agg(F.max_by(whole, F.struct("created_at", "run_id")).alias("r"))
    return newest.filter("r is not null").select("r.*")


def select_run(runs: DataFrame, run_id: str) -> DataFrame:
    return runs.filter(F.col("run_id") == run_id)
