"""Layers that grow batch by batch: silver interactions by date, and the counts behind the text features.

A batch carries a name; loading a batch again replaces what it left the first time.
Names of batches are text that does not read as a number or a date (Spark would turn it into one).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from readflow.functions.columns import epoch_seconds
from readflow.operators.history import with_temporal, with_user_times
from readflow.operators.tfidf import idf
from readflow.session import materialize
from readflow.sources import files


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def save_part(df: DataFrame, path: str, batch: str) -> None:
    """What a batch adds to a mergeable table; the same batch replaces its own part only."""
    if df.isEmpty():
        remove(df.sparkSession, f"{path}/batch={batch}")
    files.write_partitioned(df.withColumn("batch", F.lit(batch)), path, ["batch"], replace="dynamic")


def load_parts(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], without: str | None = None) -> DataFrame | None:
    """The parts of all batches (but ``without``), merged; None if nothing was saved yet."""
    if not exists(spark, path):
        return None
    parts = spark.read.parquet(path).withColumn("batch", F.col("batch").cast("string"))
    return merge(parts.filter(F.col("batch") != without) if without is not None else parts)


# --- silver interactions ----------------------------------------------------------------------

def reader_times(parts: DataFrame) -> DataFrame:
    """(user_id, first, last) over all batches: minima and maxima merge."""
    return parts.groupBy("user_id").agg(F.min("first").alias("first"), F.max("last").alias("last"))


def load_readings(new: DataFrame, layer: str, state: str, batch: str) -> None:
    """Add a batch of readings to the silver layer at ``layer``, partitioned by date, and to the table of readers' times at ``state``.

    A reader whose new readings all lie behind those already stored needs nothing but the last stored
    time. Readers with late readings are taken up again with all their rows. Only dates that hold new
    rows, or rows of such readers after their first new one, are written again; the others stay
    untouched. First readings change with every late row, so they are added on reading (``read_readings``).
    """
    spark = new.sparkSession
    new = materialize(with_temporal(new).withColumn("batch", F.lit(batch)), "new-readings")
    own = materialize(new.groupBy("user_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last")), "new-times")
    known = load_parts(spark, state, reader_times, without=batch)
    stored = stored_readings(spark, layer)
    if stored is None or known is None:
        times = with_user_times(new).drop("first_interaction", "time_since_first")
        files.write_partitioned(times, layer, replace="dynamic")
        save_part(own, state, batch)
        return
    again = stored.filter(F.col("batch") == batch).select("user_id").distinct().withColumn("again", F.lit(True))
    stored = stored.filter(F.col("batch") != batch)
    known = known.select(F.col("user_id").alias("known_user"), F.col("last").alias("stored_last"))
    met = own.join(known, F.col("user_id").eqNullSafe(F.col("known_user")))
    late = met.filter("first <= stored_last").select(F.col("user_id").alias("u"), F.col("first").alias("since"))
    lost = again.select(F.col("user_id").alias("u"), F.lit(float("-inf")).alias("since"))
    late = materialize(late.unionByName(lost).groupBy("u").agg(F.min("since").alias("since")), "late-readers")
    taken_up = stored.join(late, F.col("user_id").eqNullSafe(F.col("u")))
    before = met.filter("first > stored_last").select("user_id", F.col("stored_last").alias("ts"), F.lit(True).alias("only_before"))
    rows = new.withColumn("changed", F.lit(True)).unionByName(
        taken_up.select(*stored.columns, (F.col("ts") >= F.col("since")).alias("changed")).drop("time_since_last"))
    before = before.join(late, F.col("user_id").eqNullSafe(F.col("u")), "left_anti")
    rows = rows.withColumn("only_before", F.lit(False)).unionByName(before, allowMissingColumns=True)
    timed = with_user_times(rows).filter("not only_before").drop("only_before", "first_interaction", "time_since_first")
    timed = materialize(timed, "timed-readings")
    dates = list(files.DATE_PARTITIONS)
    stale = spark.read.parquet(layer).filter(F.col("batch") == batch).select(*dates)
    touched = materialize(timed.filter("changed").select(*dates).unionByName(stale).distinct(), "touched-dates")
    kept = stored.join(late, F.col("user_id").eqNullSafe(F.col("u")), "left_anti")
    whole = timed.drop("changed").unionByName(kept).join(F.broadcast(touched), dates, "left_semi")
    whole = materialize(whole, "touched-readings")
    files.write_partitioned(whole, layer, replace="dynamic")
    for r in touched.join(whole.select(*dates).distinct(), dates, "left_anti").collect():  # dates that hold nothing any more
        remove(spark, layer + "".join(f"/{c}={r[c]}" for c in dates))
    save_part(own, state, batch)


def stored_readings(spark: SparkSession, layer: str) -> DataFrame | None:
    return files.read_table(spark, layer) if exists(spark, layer) else None


def read_readings(spark: SparkSession, layer: str, state: str, as_of=None) -> DataFrame:
    """The silver layer with ``first_interaction`` and ``time_since_first``, as ``with_user_times`` gives them on all batches at once."""
    first = load_parts(spark, state, reader_times).select(F.col("user_id").alias("_reader"), F.col("first").alias("first_interaction"))
    rows = files.read_table(spark, layer).join(first, F.col("user_id").eqNullSafe(F.col("_reader")), "left").drop("_reader", "batch")
    return rows.withColumn("time_since_first", epoch_seconds(as_of) - F.col("first_interaction"))


# --- document frequencies ---------------------------------------------------------------------

ALL_DOCUMENTS = -1


def document_counts(frequencies: DataFrame, vector: str = "raw_features") -> DataFrame:
    """(feature_idx, n): articles with each feature, and under ``ALL_DOCUMENTS`` how many articles there are; counts add up over batches."""
    one = frequencies.groupBy(F.lit(True).alias("all")).agg(Summarizer.numNonZeros(F.col(vector)).alias("v"), F.count(F.lit(1)).alias("n"))
    entries = one.select(F.posexplode(vector_to_array("v")).alias("feature_idx", "x")).select("feature_idx", F.col("x").cast("bigint").alias("n"))
    return entries.filter("n > 0").unionByName(one.select(F.lit(ALL_DOCUMENTS).alias("feature_idx"), "n"))


def total_counts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("feature_idx").agg(F.sum("n").alias("n"))


def weigh(frequencies: DataFrame, counts: DataFrame, n_features: int, vector: str = "raw_features") -> DataFrame:
    """Add ``features``: hashed frequencies weighted by the document frequencies of ``counts``, at most one row per feature."""
    every = counts.filter(F.col("feature_idx") == ALL_DOCUMENTS).select("n").scalar()
    weights = {r["feature_idx"]: r["w"] for r in counts.select("feature_idx", idf(every, F.col("n")).alias("w")).collect()}
    unseen = counts.sparkSession.range(1).select(idf(every, F.lit(0)).alias("w")).first()["w"] if weights else 0.0
    scaling = Vectors.dense([weights.get(i, unseen) for i in range(n_features)])
    return ElementwiseProduct(scalingVec=scaling, inputCol=vector, outputCol="features").transform(frequencies)
