"""The batch job: raw CSV → silver → normalised → TF-IDF → gold → model → monitoring run.

Each layer is one Spark job whose result is written as Parquet; the next layer reads the table.
Every write replaces its table, so running twice gives the same rows. With ``rebuild=False`` layers
whose output is complete are kept: a job that died goes on where it stopped.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from readflow.operators import analytics, distributions, gold, history, items as articles, recommend, scaling, tfidf
from readflow.plans import training
from readflow.session import configure, scratch
from readflow.sources import files, models


@dataclass(frozen=True)
class Layout:
    """Where the layers lie under one root."""

    root: str

    def __getattr__(self, name: str) -> str:
        places = {
            "interactions": "silver/interactions", "items": "silver/items",
            "interactions_normalized": "silver/interactions_normalized", "items_normalized": "silver/items_normalized",
            "tfidf": "silver/tfidf", "matrix": "gold/matrix", "user_features": "gold/user_features",
            "item_features": "gold/item_features", "model": "models/factors", "runs": "models/runs", "analyses": "analyses",
        }
        if name not in places:
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{places[name]}"


def _layer(spark: SparkSession, path: str, build: Callable[[], DataFrame], dated: bool, rebuild: bool) -> DataFrame:
    if rebuild or not files.is_complete(spark, path):
        (files.write_partitioned if dated else files.write_table)(build(), path)
    return files.read_table(spark, path)


def build_silver(spark, history_path, articles_path, layout, as_of=None, rebuild=True, multi_line=False, articles_multi_line=True):
    """Exploded, enriched interactions and dated items.

    Histories are lists of numbers and ids without line breaks, so their files are split by default;
    article texts may hold quoted line breaks.
    """
    raw = files.read_history(spark, history_path, multi_line)
    interactions = _layer(spark, layout.interactions, lambda: history.enrich(history.explode_history(raw), as_of), True, rebuild)
    items = _layer(spark, layout.items, lambda: articles.silver_items(files.read_articles(spark, articles_path, articles_multi_line), as_of), True, rebuild)
    return interactions, items


def build_normalized(spark, interactions, items, layout, rebuild=True):
    return (
        _layer(spark, layout.interactions_normalized, lambda: scaling.normalize_interactions(interactions), True, rebuild),
        _layer(spark, layout.items_normalized, lambda: scaling.normalize_items(items), True, rebuild),
    )


def build_tfidf(spark, items, layout, rebuild=True, stop_words=tfidf.PORTUGUESE_STOP_WORDS, n_features=tfidf.N_FEATURES):
    """TF-IDF of the titles in one partitioned write; items without a date are kept."""
    build = lambda: tfidf.hashed_tfidf(tfidf.with_clean_text(items), stop_words=stop_words, n_features=n_features)
    return _layer(spark, layout.tfidf, build, True, rebuild)


def build_gold(spark, normalized, with_tfidf, layout, rebuild=True):
    """Interaction matrix, user vectors and item vectors."""
    return (
        _layer(spark, layout.matrix, lambda: gold.interaction_matrix(normalized, with_tfidf), False, rebuild),
        _layer(spark, layout.user_features, lambda: gold.user_feature_vectors(gold.user_features(normalized)), False, rebuild),
        _layer(spark, layout.item_features, lambda: tfidf.item_features(with_tfidf), False, rebuild),
    )


def train(
    spark, matrix, item_features, layout, run_id: str, created_at: str, sample_ratio: float = 1.0, test_ratio: float = 0.2,
    rank: int = recommend.N_COMPONENTS, iterations: int = recommend.EPOCHS, reg: float = recommend.REGULARISATION, seed: int = recommend.SEED,
    evaluation_ratio: float = 1.0, alpha: float = recommend.ALPHA,
):
    """Sample, split, fit, save, evaluate; the run is recorded whether it succeeds or fails.

    The model knows every user of ``matrix`` and every article of ``item_features``, also those that
    the sample or the split leaves without a pair to learn from.
    """
    try:
        used = gold.hash_sample(matrix, sample_ratio, seed) if sample_ratio < 1 else matrix
        fit_part = gold.train_test_split(used, test_ratio, seed)[0]
        began = time.monotonic()
        factors = recommend.train_factors(
            fit_part, rank, iterations, reg, alpha, seed, matrix.select("user_id").distinct(), item_features.select("page").distinct())
        models.save_factors(*factors, layout.model)
        took = time.monotonic() - began
        users, items = models.load_factors(spark, layout.model)
        sizes = training.model_sizes(users, items)
        run = training.run_document(
            used.select("user_id", "page"), item_features, users, items, run_id, created_at,
            model_summary={"model_type": "ALS", "loss_function": "implicit least squares", "embedding_dim": str(rank), "epochs": str(iterations),
                           "training_time": f"{took:.3f}"},
            hyperparameters={"rank": float(rank), "iterations": float(iterations), "reg": reg, "alpha": alpha, "seed": float(seed)},
            test_ratio=test_ratio, seed=seed, sample_size=sample_ratio * 100.0, evaluation_ratio=evaluation_ratio,
            n_features=training.width_of(item_features, "features"), sizes=sizes)
        scores = used.select("user_id", "page", "score")
        run = training.with_full_monitoring(run, scores, item_features, users, items, test_ratio, seed)
        models.append_run(run, layout.runs)
    except Exception as error:
        models.append_run(training.failed_run(spark, run_id, created_at, str(error)), layout.runs)
        raise
    return users, items


def analyses(interactions: DataFrame, items: DataFrame) -> dict[str, DataFrame]:
    """The tables behind the dashboard."""
    reads = analytics.reads_per_user(interactions)
    access = analytics.recency_access(interactions, items)
    item_users = analytics.users_per_item(interactions)
    engagement = analytics.engagement_by_item(interactions)
    return {
        "reads_per_user": reads,
        "reads_histogram": distributions.histogram(reads, "reads", 30),
        "reads_box": distributions.box_plot(reads, "reads"),
        "interaction_deciles": distributions.cumulative_share(distributions.quantile_bins(reads, "reads")),
        "reads_by_hour": analytics.reads_by_hour(interactions),
        "reads_by_weekday_hour": analytics.reads_by_weekday_hour(interactions),
        "reads_by_day": analytics.reads_by_day(interactions),
        "engagement_by_item": engagement,
        "engagement_trend": distributions.linear_trend(engagement, "avg_time_min", ["avg_clicks", "avg_scroll_pct", "avg_score"]),
        "visits_per_user_day": analytics.visits_per_user_day(interactions),
        "daily_active_users": analytics.daily_active_users(interactions),
        "user_type_by_day": analytics.user_type_by_day(interactions),
        "recency_access": access,
        "recency_curve": analytics.recency_curve(access),
        "users_per_item": item_users,
        "popularity_deciles": distributions.quantile_bins(item_users, "unique_users").filter("count > 0"),
        "popularity_bands": analytics.popularity_bands(item_users),
        "clicks_time_corr": analytics.clicks_time_corr(interactions),
        "clicks_time_trend": distributions.linear_trend(interactions, "clicks", ["time_on_page_ms"]),
    }


def write_analyses(interactions: DataFrame, items: DataFrame, layout: Layout) -> list[str]:
    """Write every analysis as a table; the columns they need are cached once for all of them."""
    needed = ["user_id", "user_type", "page", "clicks", "time_on_page_ms", "scroll_pct", "interaction_score", "hour", "dayofweek", "year", "month", "day"]
    cached = interactions.select(needed).persist()
    try:
        tables = analyses(cached, items)
        for name, df in tables.items():
            files.write_table(df, f"{layout.analyses}/{name}")
    finally:
        cached.unpersist()
    return list(tables)


def run(
    spark: SparkSession, history_path: str, articles_path: str, root: str, run_id: str, created_at: str,
    as_of=None, rebuild: bool = True, multi_line: bool = False, articles_multi_line: bool = True, **training_options,
) -> Layout:
    """All steps in order; scratch tables are removed at the end."""
    configure(spark)
    layout = Layout(root)
    with scratch(spark):
        _run_steps(spark, history_path, articles_path, layout, run_id, created_at, as_of, rebuild, multi_line, articles_multi_line, training_options)
    return layout


def _run_steps(spark, history_path, articles_path, layout, run_id, created_at, as_of, rebuild, multi_line, articles_multi_line, training_options):
    interactions, items = build_silver(spark, history_path, articles_path, layout, as_of, rebuild, multi_line, articles_multi_line)
    normalized, items_normalized = build_normalized(spark, interactions, items, layout, rebuild)
    with_tfidf = build_tfidf(spark, items_normalized, layout, rebuild)
    matrix, _, item_features = build_gold(spark, normalized, with_tfidf, layout, rebuild)
    train(spark, matrix, item_features, layout, run_id, created_at, **training_options)
    write_analyses(interactions, items, layout)
