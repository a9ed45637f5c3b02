"""Gold layer: interaction matrix, id maps, user features, samples and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from readflow.functions.columns import hash_share, with_row
from readflow.operators.scaling import USER_VECTOR_COLUMNS, minmax_scale
from readflow.operators.skew import dense_index, ordered_index


def id_maps(interactions: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(user_id, user_idx) and (page, item_idx)."""
    return dense_index(interactions, "user_id", "user_idx"), dense_index(items, "page", "item_idx")


def user_item_scores(interactions: DataFrame, items: DataFrame, score: str = "adjusted_score") -> DataFrame:
    """Total score of every (user, known page) pair.

    Only rows with a user, a catalogue page and a score above 0 count. Pairs are summed before
    the join with the catalogue, so a viral page meets it as one row per reader.
    """
    pairs = (
        interactions.select("user_id", F.trim("page").alias("page"), F.col(score).cast("double").alias("score"))
        .filter((F.col("user_id") != "") & (F.col("page") != "") & (F.col("score") > 0))
        .groupBy("user_id", "page").agg(F.sum("score").alias("score"))
    )
    return pairs.join(items.select("page").distinct(), "page", "left_semi").select("user_id", "page", "score")


def interaction_matrix(interactions: DataFrame, items: DataFrame, score: str = "adjusted_score") -> DataFrame:
    """(user_id, page, user_idx, item_idx, score) in place of a sparse matrix."""
    users, pages = id_maps(interactions, items)
    scores = user_item_scores(interactions, items, score)
    return scores.join(users, "user_id").join(pages, "page").select("user_id", "page", "user_idx", "item_idx", "score")


def interaction_profile(interactions: DataFrame, items: DataFrame, score: str = "adjusted_score") -> DataFrame:
    """One row of sizes: input rows, users, pages, stored pairs, score range, density."""
    pairs = user_item_scores(interactions, items, score)
    rows = interactions.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("user_id").alias("n_users"))
    pages = items.agg(F.countDistinct("page").alias("n_items"))
    found = pairs.agg(
        F.count(F.lit(1)).alias("n_pairs"), F.min("score").alias("min_score"), F.max("score").alias("max_score"))
    density = F.try_divide(F.col("n_pairs").cast("double"), F.col("_rows.n_users").cast("double") * F.col("_pages.n_items"))
    return with_row(with_row(found, rows, "_rows"), pages, "_pages").select(
        "_rows.*", "_pages.*", "n_pairs", "min_score", "max_score", density.alias("density"))


def page_coverage(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """Pages read, how many of them the catalogue knows, and the share."""
    read = interactions.select("page").filter("page is not null").distinct()
    known = items.select("page").distinct().withColumn("_known", F.lit(1))
    return read.join(known, "page", "left").agg(
        F.count(F.lit(1)).alias("pages_read"),
        F.count("_known").alias("pages_known"),
        F.avg(F.coalesce("_known", F.lit(0))).alias("coverage"),
    )


def uncovered_items(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """Pages read but missing from the catalogue."""
    return interactions.select("page").filter("page is not null").distinct().join(items.select("page"), "page", "left_anti")


def items_with_interactions(items: DataFrame, interactions: DataFrame) -> DataFrame:
    """Catalogue rows of pages that were read."""
    return items.join(interactions.select("page").distinct(), "page", "left_semi")


def compact_items(interactions: DataFrame, item_features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Long tables with gaps in ``item_idx`` → the same with items renumbered 0..n-1 in order.

    Features of items without interactions are dropped. The user count is ``max(user_idx) + 1``.
    """
    new = ordered_index(interactions, "item_idx", "new_idx")
    def renumber(df):
        return df.join(new, "item_idx").withColumn("item_idx", F.col("new_idx")).drop("new_idx")
    return renumber(interactions), renumber(item_features)


def user_features(normalized: DataFrame) -> DataFrame:
    """First user type and six means of every user. The type is that of the earliest reading."""
    means = [F.avg(c).alias(c) for c in USER_VECTOR_COLUMNS if c != "user_type"]
    first = F.min(F.struct("ts", "user_type")).alias("_first")
    return (
        normalized.groupBy("user_id").agg(first, *means)
        .select("user_id", F.col("_first.user_type").alias("user_type"), *[c for c in USER_VECTOR_COLUMNS if c != "user_type"])
    )


def user_feature_vectors(features: DataFrame) -> DataFrame:
    """(user_id, user_features array<double>), every column min-max scaled over all users."""
    columns = list(USER_VECTOR_COLUMNS)
    return minmax_scale(features, columns).select("user_id", F.array(*columns).alias("user_features"))


def hash_sample(pairs: DataFrame, ratio: float, seed: int = 42, purpose: str = "sample") -> DataFrame:
    """A share of the pairs chosen by hash: the same rows on any partitioning, other rows for another purpose."""
    if not 0 < ratio <= 1:
        raise ValueError("ratio must be in (0, 1]")
    return pairs.filter(hash_share(ratio, "user_id", "page", purpose=purpose, seed=seed))


def with_split(pairs: DataFrame, test_ratio: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``."""
    if not 0 < test_ratio < 1:
        raise ValueError("test_ratio must be in (0, 1)")
    return pairs.withColumn("is_test", hash_share(test_ratio, "user_id", "page", purpose="split", seed=seed))


def train_test_split(pairs: DataFrame, test_ratio: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Disjoint train and test parts that together are all pairs."""
    marked = with_split(pairs, test_ratio, seed)
    return marked.filter("not is_test").drop("is_test"), marked.filter("is_test").drop("is_test")


def temporal_split(interactions: DataFrame, cutoff) -> tuple[DataFrame, DataFrame]:
    """Readings before the cutoff (epoch seconds) and from it on."""
    return interactions.filter(F.col("ts") < cutoff), interactions.filter(F.col("ts") >= cutoff)
