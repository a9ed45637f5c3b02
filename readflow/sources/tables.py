"""Adapters from the benchmark tables to the shapes the operators take.

Every adapter reads whole tables. Raw histories come in blocks of event ids, so that no list is
longer than ``EVENTS_PER_HISTORY`` however much one user reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from readflow.session import spread

EVENTS_PER_HISTORY = 1024
AS_OF = 1706745600  # 2024-02-01 00:00:00 UTC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event_columns():
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return {
        "user_id": F.col("user_id").cast("string"),
        "user_type": F.when(F.col("user_id") % 3 == 0, "Logged").otherwise("Non-Logged"),
        "page": F.get_json_object("props", "$.k"),
        "ts": micros / F.lit(1e6),
        "clicks": (F.col("event_id") % 7).cast("int"),
        "time_on_page_ms": (F.round(F.col("value") * 100) * 10).cast("bigint"),
        "scroll_pct": F.least(F.col("value"), F.lit(100.0)),
        "visits": (1 + F.col("event_id") % 3).cast("int"),
    }


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-grain readings from ``events``."""
    return table(spark, sf_dir, "events").select(*[c.alias(n) for n, c in _event_columns().items()])


def raw_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze histories from ``events``: lists of values as text, in order of time and event id."""
    c = _event_columns()
    millis = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("string")
    rows = table(spark, sf_dir, "events").select(
        c["user_id"].alias("userId"), c["user_type"].alias("userType"),
        F.floor(F.col("event_id") / EVENTS_PER_HISTORY).alias("part"),
        F.struct(
            "ts", "event_id", c["page"].alias("history"), millis.alias("timestampHistory"),
            *[c[n].cast("string").alias(out) for n, out in (
                ("clicks", "numberOfClicksHistory"), ("time_on_page_ms", "timeOnPageHistory"),
                ("scroll_pct", "scrollPercentageHistory"), ("visits", "pageVisitsCountHistory"))],
        ).alias("e"))
    lists = rows.groupBy("userId", "userType", "part").agg(F.sort_array(F.collect_list("e")).alias("l"))
    names = ("history", "timestampHistory", "numberOfClicksHistory", "timeOnPageHistory", "scrollPercentageHistory", "pageVisitsCountHistory")
    return lists.select("userId", "userType", *[F.array_join(F.col(f"l.{n}"), ", ").alias(n) for n in names])


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze articles from ``documents``, dates as text; the title is the whole text. Rows are dealt out by page, so groups of a page need no shuffle."""
    hours = F.col("doc_id") % 720
    start = F.to_timestamp_ntz(F.lit("2023-12-01 00:00:00"))

    def stamp(h):
        t = start + F.make_dt_interval(F.lit(0), h.cast("int"))
        return F.concat(F.date_format(t, "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00"))

    documents = spread(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("page"), "doc_id", "text", "source", "lang"), "page")
    return documents.select(
        "page", F.concat(F.lit("https://"), F.col("source")).alias("url"),
        stamp(hours).alias("issued"), stamp(hours + F.col("doc_id") % 48).alias("modified"),
        F.col("text").alias("title"), F.col("text").alias("body"), F.col("lang").alias("caption"))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of all documents."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("page"))


def labelled_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of the documents that carry labels: a catalogue with holes."""
    return table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("page"))


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A larger, sparser set of interactions from ``orders`` and ``lineitem``."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.when(F.col("o_custkey") % 3 == 0, "Logged").otherwise("Non-Logged").alias("user_type"),
        F.col("l_partkey").cast("string").alias("page"),
        (F.unix_micros(F.col("o_orderdate").cast("timestamp")) / F.lit(1e6)).alias("ts"),
        F.col("l_quantity").cast("int").alias("clicks"),
        (F.col("l_linenumber") * 1000).cast("bigint").alias("time_on_page_ms"),
        (F.col("l_discount") * 1000).alias("scroll_pct"),
        F.lit(1).alias("visits"))


def factor_model(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A fixed factor model over all ``embeddings``: each vector is an item, and reversed a user."""
    e = table(spark, sf_dir, "embeddings")
    factors = F.col("embedding").cast("array<double>")
    key = F.col("vec_id").cast("string")
    users = e.select(key.alias("user_id"), F.reverse(factors).alias("factors"), F.lit(0.0).alias("bias"))
    items = e.select(key.alias("page"), factors.alias("factors"), (F.col("label") * F.lit(0.01)).alias("bias"))
    return users, items


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per customer, asking for 1 to 10 items; most customers are unknown to the model."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id"), (1 + F.col("c_nationkey") % 10).cast("int").alias("n"))
