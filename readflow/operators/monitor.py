"""Monitoring of interactions, splits and factor models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from readflow.functions.vectors import norm
from readflow.operators.distributions import histogram, two_sample_ks
from readflow.operators.recommend import score_pairs
from readflow.operators.selection import select_quantiles, stored_values
from readflow.operators.skew import running_totals

TOTAL_DIGITS = 6


def totals_per_key(scores: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Total score of every id of the id map; ids without interactions count as 0."""
    totals = scores.groupBy(key).agg(F.sum("score").alias("total"))
    return ids.select(key).join(totals, key, "left").select(key, F.round(F.coalesce("total", F.lit(0.0)), TOTAL_DIGITS).alias("total"))


def total_statistics(totals: DataFrame, side: str) -> DataFrame:
    """Mean, exact median, population deviation, smallest and largest total, over totals that are computed once."""
    values = stored_values(totals, "total", counted=False)
    median, = select_quantiles(values, [0.5])
    return values.table.agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    ).select(F.lit(side).alias("side"), "mean", F.lit(median).cast("double").alias("median"), "std", "min", "max")


def interaction_distribution(scores: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """One row for users and one for items."""
    return total_statistics(totals_per_key(scores, users, "user_id"), "user").unionByName(
        total_statistics(totals_per_key(scores, items, "page"), "item"))


def interaction_histograms(scores: DataFrame, users: DataFrame, items: DataFrame, bins: int = 50) -> DataFrame:
    parts = [
        histogram(totals_per_key(scores, ids, key), "total", bins).withColumn("side", F.lit(side))
        for ids, key, side in ((users, "user_id", "user"), (items, "page", "item"))
    ]
    return parts[0].unionByName(parts[1]).select("side", "bin", "low", "high", "count")


def split_stats(marked: DataFrame, n_users: Column, n_items: Column) -> DataFrame:
    """Sizes of a split (pairs with ``is_test``) over an id space of n_users × n_items."""
    total, test = F.count(F.lit(1)), F.count_if("is_test")
    train = (total - test).cast("double")
    return marked.agg(total.alias("total"), test.alias("test")).select(
        F.col("total").alias("total_interactions"),
        (F.col("total") - F.col("test")).alias("train_interactions"),
        F.col("test").alias("test_interactions"),
        n_users.alias("n_users"), n_items.alias("n_items"),
    ).withColumns({
        "interactions_per_user": F.try_divide(F.col("train_interactions").cast("double"), F.col("n_users")),
        "interactions_per_item": F.try_divide(F.col("train_interactions").cast("double"), F.col("n_items")),
        "sparsity": F.lit(1.0) - F.try_divide(
            F.col("train_interactions").cast("double"), F.col("n_users").cast("double") * F.col("n_items")),
    })


def coverage_stats(train: DataFrame, n_users: Column, n_items: Column) -> DataFrame:
    """Users and items met in training, as shares, and how many never are."""
    return train.agg(F.countDistinct("user_id").alias("u"), F.countDistinct("page").alias("i")).select(
        F.try_divide(F.col("u").cast("double"), n_users).alias("user_coverage"),
        F.try_divide(F.col("i").cast("double"), n_items).alias("item_coverage"),
        (n_users - F.col("u")).alias("cold_start_users"), (n_items - F.col("i")).alias("cold_start_items"))


def embedding_stats(user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """Mean and population deviation of the vector lengths, per side."""
    both = user_factors.select(F.lit("user").alias("side"), norm(F.col("factors")).alias("length")).unionByName(
        item_factors.select(F.lit("item").alias("side"), norm(F.col("factors")).alias("length")))
    return both.groupBy("side").agg(F.avg("length").alias("norm_mean"), F.stddev_pop("length").alias("norm_std"))


def mean_abs_components(factors: DataFrame) -> DataFrame:
    """(component, value): mean absolute value of each factor component."""
    long = factors.select(F.posexplode("factors").alias("component", "v"))
    return long.groupBy("component").agg(F.avg(F.abs(F.col("v").cast("double"))).alias("value"))


def feature_importance(item_factors: DataFrame) -> DataFrame:
    """Mean absolute components scaled to sum 1."""
    means = mean_abs_components(item_factors)
    total = means.agg(F.sum("value")).scalar()
    return means.select(
        F.concat(F.lit("feature_"), F.col("component").cast("string")).alias("feature"), (F.col("value") / total).alias("importance"))


def top_features(importance: DataFrame, n: int = 20) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def abs_mean_columns(long: DataFrame, n_rows: Column) -> DataFrame:
    """|mean| of each feature column, from non-zero entries (feature_idx, value) of ``n_rows`` rows."""
    return long.groupBy("feature_idx").agg(F.sum("value").alias("s")).select(
        F.col("feature_idx").alias("component"), F.abs(F.col("s") / n_rows).alias("value"))


def feature_column_means(
    user_factors: DataFrame, item_factors: DataFrame, item_long: DataFrame, n_items: Column, user_long: DataFrame, n_users: Column,
) -> DataFrame:
    """All four kinds of column means as (source, component, value)."""
    parts = {
        "item_embeddings": mean_abs_components(item_factors), "user_embeddings": mean_abs_components(user_factors),
        "item_features": abs_mean_columns(item_long, n_items), "user_features": abs_mean_columns(user_long, n_users),
    }
    out = None
    for source, part in parts.items():
        part = part.select(F.lit(source).alias("source"), "component", "value")
        out = part if out is None else out.unionByName(part)
    return out


def score_stability(train: DataFrame, test: DataFrame, user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """Mean, deviation and KS distance of the model's scores of train and test pairs."""
    def scores(pairs):
        return score_pairs(pairs.select("user_id", "page"), user_factors, item_factors).select("score")

    return two_sample_ks(scores(train), scores(test), "score").withColumnsRenamed({
        "n_a": "n_train", "mean_a": "train_mean", "std_a": "train_std",
        "n_b": "n_test", "mean_b": "test_mean", "std_b": "test_std"})


def gini(counts: DataFrame, count: str) -> DataFrame:
    """Gini coefficient of item counts.

    Items with equal counts are handled as one row with multiplicity c: ranks before + 1 .. before + c
    sum to c·before + c(c+1)/2.
    """
    groups = counts.groupBy(F.col(count).cast("double").alias("v")).agg(F.count(F.lit(1)).cast("double").alias("c"))
    ranks = running_totals(groups, "v", ["c"])
    ranks = ranks.withColumn("rank_sum", F.col("c") * (F.col("cum_c") - F.col("c")) + F.col("c") * (F.col("c") + 1) / 2)
    n, total = F.sum("c"), F.sum(F.col("v") * F.col("c"))
    value = F.try_divide(2 * F.sum(F.col("v") * F.col("rank_sum")), n * total) - F.try_divide(n + 1, n)
    return ranks.agg(n.cast("bigint").alias("n_items"), F.coalesce(value, F.lit(0.0)).alias("gini"))


def item_gini(interactions: DataFrame) -> DataFrame:
    """Gini coefficient of reads per article."""
    return gini(interactions.groupBy("page").agg(F.count(F.lit(1)).alias("reads")), "reads")


def dashboard_ratios(stats: DataFrame) -> DataFrame:
    """The dashboard's ratios of a split under their own names: interaction counts over ids, not shares of ids."""
    both = (F.col("train_interactions") + F.col("test_interactions")).cast("double")
    test = F.col("test_interactions").cast("double")
    return stats.select(
        F.try_divide(both, F.col("n_users")).alias("interactions_over_users"),
        F.try_divide(both, F.col("n_items")).alias("interactions_over_items"),
        F.try_divide(test, F.col("n_users")).alias("test_over_users"),
        F.when(F.col("total_interactions") == 0, F.lit(0.0)).otherwise(F.lit(1.0) - 2 * F.col("interactions_per_item")).alias("density_index"),
        F.coalesce(F.try_divide(test, F.col("train_interactions")), F.lit(0.0)).alias("test_over_train"))
