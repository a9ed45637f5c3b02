"""Session settings and shared scratch storage.

Library code never sets a master, memory or core count; those belong to the cluster.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import get_ident

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

SCRATCH_KEY = "spark.checkpoint.dir"
_blocks: dict[int, list[list[str]]] = {}  # per thread of the driver, the tables of its open blocks


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables made inside the block when it ends.

    A block belongs to its own thread of the driver and may be nested; frames built inside it must be
    stored or collected before it ends. Without a block tables stay until the folder is cleaned.
    """
    own = _blocks.setdefault(get_ident(), [])
    own.append([])
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for name in own.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)


def configure(spark: SparkSession) -> SparkSession:
    """Pin the SQL settings that results or skew handling depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Split a hot join key even when the join's output partitioning is used later on.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # Long texts: what goes to a Python worker at once is bounded in bytes, not only in rows.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the cluster's shared checkpoint folder.

    The folder is read from the session. A session in one process (``local``) that names none gets a
    temporary folder of this machine; on a cluster that is an error, as executors would each write
    to their own disk.
    """
    base = spark.conf.get(SCRATCH_KEY, None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set {SCRATCH_KEY} to a folder that all executors share (master is {master!r})")
        base = tempfile.mkdtemp(prefix="readflow-")
        spark.conf.set(SCRATCH_KEY, base)
    path = f"{base.rstrip('/')}/readflow/{name}-{uuid.uuid4().hex}"
    if own := _blocks.get(get_ident()):
        own[-1].append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in shared storage and read it back, which cuts its lineage.

    The table outlives executors, and every later scan of it sees the same rows in the same files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of text that a task of a spread scan takes, about: its words, each with a count, take some twenty times as much memory.
SPREAD_BYTES = 16 << 20


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Deal a scan's rows out evenly, for per-row work such as text cleaning that costs more than a shuffle of its input.

    The number of parts follows the bytes of the scan's texts, which are summed first, so that a task's share stays as it
    is when the input grows; a small scan is cut into as many parts as the session shuffles to, of a megabyte or more.
    """
    sizes = [F.sum(F.octet_length(f.name)) for f in scan.schema if isinstance(f.dataType, T.StringType)]
    size = sum(n or 0 for n in scan.agg(*sizes).first()) if sizes else 0
    few = min(int(scan.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // (1 << 20)))
    return scan.repartition(max(1, few, -(-size // SPREAD_BYTES)), *keys)
