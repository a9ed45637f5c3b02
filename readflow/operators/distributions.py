"""Histograms, quantile bins, box plots, trends and two-sample tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from readflow.functions.columns import with_row
from readflow.operators.selection import select_quantiles, stored_values
from readflow.operators.skew import running_totals

DECILES = [i / 10 for i in range(11)]


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed and empty bins are listed.

    A constant input gets a range of one around its value.
    """
    x = F.col("_x")
    values = df.select(F.col(value).cast("double").alias("_x")).filter("_x is not null")
    half = F.when(F.min(x) == F.max(x), F.lit(0.5)).otherwise(F.lit(0.0))
    ends = values.agg((F.min(x) - half).alias("lo"), (F.max(x) + half).alias("hi"))
    ends = ends.select("lo", ((F.col("hi") - F.col("lo")) / F.lit(float(bins))).alias("width"))
    lo, width = F.col("_e.lo"), F.col("_e.width")

    guess = F.least(F.floor((x - lo) / width), F.lit(bins - 1))
    low_edge, high_edge = lo + guess * width, lo + (guess + 1) * width
    bin_no = guess - F.when(x < low_edge, 1).otherwise(0) + F.when((x >= high_edge) & (guess < bins - 1), 1).otherwise(0)
    counts = with_row(values, ends, "_e").groupBy(bin_no.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))

    every_bin = with_row(df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")), ends, "_e")
    return every_bin.join(F.broadcast(counts), "bin", "left").select(
        "bin", (lo + F.col("bin") * width).alias("low"), (lo + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("count"))


def box_plot(df: DataFrame, value: str) -> DataFrame:
    """One row: quartiles, fences at 1.5 IQR, whiskers inside them, number of points outside. No values, no row."""
    values = stored_values(df, value)
    q1, median, q3 = select_quantiles(values, [0.25, 0.5, 0.75])
    row = {"q1": q1, "median": median, "q3": q3, "fence_low": None, "fence_high": None}
    if values.rows:
        row |= {"fence_low": q1 - 1.5 * (q3 - q1), "fence_high": q3 + 1.5 * (q3 - q1)}
    known = {name: F.lit(x).cast("double") for name, x in row.items()}
    inside = F.col("value").between(known["fence_low"], known["fence_high"])
    return values.table.agg(
        F.sum("n").alias("n"),
        F.min("value").cast("double").alias("minimum"), F.max("value").cast("double").alias("maximum"),
        F.min(F.when(inside, F.col("value"))).cast("double").alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).cast("double").alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
    ).filter(F.col("n") > 0).withColumns(known)


def quantile_bins(df: DataFrame, value: str, probabilities: list[float] = DECILES) -> DataFrame:
    """Bins between the distinct quantiles, right-closed, the lowest value included in the first.

    Returns (bin, low, high, count) with bins from 1. A constant input gives one bin.
    """
    values = stored_values(df, value)
    edges = list(dict.fromkeys(select_quantiles(values, probabilities)))
    lows, highs = (edges[:-1], edges[1:]) if len(edges) > 1 else (edges, edges)
    inner = F.array(*[F.lit(x).cast("double") for x in lows[1:]]) if len(lows) > 1 else F.array().cast("array<double>")
    bin_no = F.lit(1) + F.size(F.filter(inner, lambda x: x < F.col("value")))
    filled = values.table.groupBy(bin_no.alias("bin")).agg(F.sum("n").alias("n"))
    ends = F.array(*[F.struct(F.lit(a).cast("double").alias("low"), F.lit(b).cast("double").alias("high")) for a, b in zip(lows, highs)])
    bins = df.sparkSession.range(1).select(F.posexplode(ends).alias("at", "e")).select((F.col("at") + 1).alias("bin"), "e.*")
    return bins.join(F.broadcast(filled), "bin", "left").select("bin", "low", "high", F.coalesce("n", F.lit(0)).alias("count"))


def cumulative_share(bins: DataFrame) -> DataFrame:
    """Add the bin label and the running share of the count in percent; one row per bin goes in."""
    running = F.sum("count").over(W.orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow))
    total = F.sum("count").over(W.partitionBy())
    return bins.withColumns({
        "label": F.concat_ws("-", F.col("low").cast("bigint").cast("string"), F.col("high").cast("bigint").cast("string")),
        "cumulative_pct": running / total * 100.0,
    })


def linear_trend(df: DataFrame, x: str, ys: list[str]) -> DataFrame:
    """Least-squares line of each y over x, as (y, slope, intercept, r2, n)."""
    fits = [F.struct(
        F.lit(y).alias("y"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n")) for y in ys]
    return df.agg(F.array(*fits).alias("f")).select(F.inline("f"))


def median_of(df: DataFrame, value: str) -> DataFrame:
    """Exact median of any number of distinct doubles."""
    median, = select_quantiles(stored_values(df, value), [0.5])
    return df.sparkSession.range(1).select(F.lit(median).cast("double").alias("median"))


def two_sample_ks(a: DataFrame, b: DataFrame, value: str) -> DataFrame:
    """Largest distance of the two empirical distribution functions, with mean and deviation of each."""
    both = a.select(value, F.lit(1).alias("in_a")).unionByName(b.select(value, F.lit(0).alias("in_a")))
    counts = both.filter(F.col(value).isNotNull()).groupBy(value).agg(
        F.sum("in_a").alias("a"), F.sum(1 - F.col("in_a")).alias("b"))
    steps = running_totals(counts, value, ["a", "b"])
    def mean(n: str) -> Column:
        return F.sum(F.col(value) * F.col(n)) / F.sum(n)

    whole = steps.agg(F.sum("a").alias("a"), F.sum("b").alias("b"), mean("a").alias("mean_a"), mean("b").alias("mean_b"))
    distance = F.abs(F.col("cum_a") / F.col("_w.a") - F.col("cum_b") / F.col("_w.b"))

    def deviation(n: str) -> Column:
        return F.sqrt(F.sum(F.pow(F.col(value) - F.col(f"_w.mean_{n}"), 2) * F.col(n)) / F.sum(n))

    return with_row(steps, whole, "_w").agg(
        F.sum("a").alias("n_a"), mean("a").alias("mean_a"), deviation("a").alias("std_a"),
        F.sum("b").alias("n_b"), mean("b").alias("mean_b"), deviation("b").alias("std_b"), F.max(distance).alias("ks"))
